"""Kernels and operators over page images."""

import numpy as np
import pytest

from docmill.functions import raster
from docmill.operators import images
from docmill.plans.images import drawn

SCHEMA = "id int, width int, height int, pixels binary"


def page(width=800, height=600, *dark):
    out = np.full((height, width), 255, np.uint8)
    for left, top, right, bottom in dark:
        out[top:bottom, left:right] = 0
    return out


def lines(angle=0.0):
    p = page(500, 700)
    for y in range(80, 620, 20):
        for x in range(50, 440, 39):
            p[y : y + 7, x : x + 30] = 20
    return raster.turned(p, angle, 255) if angle else p


def table(spark, *pages):
    return spark.createDataFrame([(k, p.shape[1], p.shape[0], bytearray(p.tobytes())) if p is not None else (k, None, None, None) for k, p in enumerate(pages)], SCHEMA)


def plain_mask(p):
    """A cell is set if any pixel that falls to it is dark, pixel by pixel."""
    height, width = (max(1, round(n * 0.25)) for n in p.shape)
    out = np.zeros((height, width), bool)
    for y, x in zip(*np.nonzero(p < 200)):
        at = [max(k for k in range(n) if int(k * size / n + 0.5) <= v) for v, n, size in ((y, height, p.shape[0]), (x, width, p.shape[1]))]
        out[at[0], at[1]] = True
    return out


@pytest.mark.parametrize("width,height", [(1, 1), (2, 3), (41, 30), (64, 53)])
def test_mask_equals_pixel_by_pixel(width, height):
    p = np.where(np.random.default_rng(width).random((height, width)) < 0.05, 0, 255).astype(np.uint8)
    assert (raster.ink_mask(p) == plain_mask(p)).all()


def test_parts_equal_a_walk_over_the_profile():
    rng = np.random.default_rng(3)
    for _ in range(200):
        profile = rng.random(rng.integers(1, 60)) < rng.choice([0.05, 0.3, 0.9])
        gap, least = int(rng.integers(1, 8)), int(rng.integers(1, 8))
        cuts, start = [], None
        for k, v in enumerate([*profile, True]):
            if v and start is not None:
                cuts += [(start + k) // 2] if k - start >= gap else []
            start = None if v else k if start is None else start
        edges = [0, *cuts, len(profile)]
        want = [(a, b) for a, b in zip(edges, edges[1:]) if b - a >= least and any(profile[a:b])]
        assert raster.parts(profile, gap, least) == want


def test_columns_and_blocks(spark):
    two = page(800, 600, (60, 50, 340, 200), (60, 260, 340, 540), (460, 50, 740, 540))
    one = page(800, 600, (60, 50, 740, 540))
    found = {r.id: r.boxes for r in images.columns(table(spark, two, one, page(), None), "id").collect()}
    assert [len(found[k]) for k in range(4)] == [2, 1, 1, 0]
    blocks = {r.id: [tuple(b) for b in r.boxes] for r in images.regions(table(spark, two, page(640, 480), page(5, 1)), "id").collect()}
    assert len(blocks[0]) == 3 and blocks[1] == [(0, 0, 640, 480)] and blocks[2] == []
    for (a, b), (left, top, right, bottom) in zip([((60, 50), (340, 200)), ((60, 260), (340, 540)), ((460, 50), (740, 540))], blocks[0]):
        assert left <= a[0] and top <= a[1] and right >= b[0] and bottom >= b[1]


def test_reading_order_is_tolerant_and_first_copies_stay():
    below, above, other = (100, 300, 300, 400), (112, 100, 300, 200), (500, 100, 700, 400)
    assert raster.readable([below, other, above, below, (0, 0, 9000, 50), (0, 0, 10, 10)], 800, 600) == [above, below, other]


@pytest.mark.parametrize("angle", [0.0, -1.5, 2.0])
def test_skew_is_found_and_undone(angle):
    p = lines(angle)
    assert abs(raster.skew(p) + angle) <= 0.5
    out, applied = raster.straightened(p)
    assert abs(raster.skew(out)) < 0.5 and (applied != 0) == (angle != 0)


def test_turning():
    p = np.arange(48, dtype=np.uint8).reshape(6, 8)
    assert (raster.turned(p, 90, 0, True) == np.rot90(p)).all()
    assert (raster.turned(p, 180, 0) == np.rot90(p, 2)).all()
    assert raster.contrasted(np.array([[50, 101, 152]], np.uint8)).tolist() == [[0, 127, 255]]
    assert raster.contrasted(np.array([[7, 7]], np.uint8)).tolist() == [[7, 7]]


def test_drawing_and_measures(spark, tmp_path):
    long = "ab c\n" * 300
    spark.createDataFrame([(1, None), (2, ""), (3, "x " * 26), (4, long)], "doc_id int, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in drawn(spark, str(tmp_path)).collect()}
    for r in rows.values():
        assert len(r.pixels) == r.width * r.height
    ink = {r.doc_id: r.ink for r in images.ink(drawn(spark, str(tmp_path)), "doc_id").collect()}
    assert ink[1] == ink[2] == 0 and ink[3] == 26 * 32 / (256 * 8) and ink[4] > 0
    out = {r.doc_id: r for r in images.straighten(drawn(spark, str(tmp_path)), "doc_id").collect()}
    assert len(out[4].pixels) == out[4].width * out[4].height


def word_table(conf, words):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    return "\n".join([head, *[f"5\t1\t1\t1\t{k // 8 + 1}\t{k + 1}\t0\t0\t9\t9\t{conf}\t{w}" for k, w in enumerate(words)]])


def test_transcription_of_blocks(spark, tmp_path):
    strong, weak = "la salud de los niños es una cuestión que no se puede dejar para más tarde".split(), "salud niños cuestión dejar tarde madre".split()

    answers = [(word_table(90, strong), "plain"), (word_table(30, weak), None), (word_table(10, ["x"]), None)]

    def engine():
        def read(part):
            return answers[0 if part.shape[1] > 500 else 1 if part.shape[1] > 300 else 2]

        return read

    pages = table(spark, page(800, 600, (60, 50, 740, 540)), page(400, 300, (40, 40, 360, 260)), page(200, 150, (20, 20, 180, 130)), None)
    read = images.read_regions(pages, engine, "id")
    got = {r.id: r for r in images.transcribe(read, "id").collect()}
    assert (got[0].text, got[0].conf, got[0].words, got[0].non_text) == ("plain", 90.0, len(strong), 0)
    assert got[1].text == " ".join(weak) and not got[1].vlm and 3 not in got
    assert got[2].text.startswith("[región") and (got[2].non_text, got[2].words, got[2].conf) == (1, 0, 0.0)

    def vision():
        def look(part):
            if part.shape[1] < 300:
                raise OSError("gone")
            return "salud de los niños, cuestión que dejar tarde"

        return look

    seen = {r.id: r for r in images.transcribe(read, "id", vision=vision, store=str(tmp_path)).collect()}
    assert (seen[0].vlm, seen[0].text) == (False, "plain")
    assert (seen[1].vlm, seen[1].vlm_rejected, seen[1].text) == (True, False, "salud de los niños, cuestión que dejar tarde")
    assert (seen[2].vlm, seen[2].vlm_rejected, seen[2].reason, seen[2].text) == (False, True, "vacio", "x")
