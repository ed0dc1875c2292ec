"""Faults that showed on larger tables only, on small tables that hold their cause."""

import os
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.functions import fixed, raster
from docmill.functions.text import first_phrase, lexical_overlap
from docmill.functions.unicode import nfc, nfd
from docmill.operators import images, summarize
from docmill.plans import ORACLE_SQL, QUERIES
from docmill.plans.images import DRAWING, drawn
from oracle import TABLES, differences

SF = "/root/testdata/sf0.001"


def differs(spark, place, name, table, rows, schema):
    """What a query over one table of ``rows`` beside the smallest others differs in from its SQL."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(place / "made"))
    made = next(f for f in os.listdir(place / "made") if f.endswith(".parquet"))
    for t in TABLES:
        os.symlink(str(place / "made" / made) if t == table else f"{SF}/{t}.parquet", str(place / f"{t}.parquet"))
    return differences(spark, str(place), QUERIES[name], ORACLE_SQL[name])


def test_equal_boxes_of_one_page_are_read_once(spark, tmp_path):
    rows = [(7, n, part, 3, 20.0, price) for n, part, price in ((1, 12, 5.0), (2, 12, 9.0), (3, 62, 1.0))]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double"
    assert differs(spark, tmp_path, "reading_order", "lineitem", rows, schema) == ""


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_blank_lines_before_a_heading_take_nothing_of_its_window(spark, tmp_path):
    texts = {1: "a" * 399 + "\n" + "b " * 2500, 16: "a" * 396 + " \n \n" + "b" * 5000, 31: "a" * 400 + "b" * 5000}
    rows = [(k, t, "es", "s", len(t)) for k, t in texts.items()]
    assert differs(spark, tmp_path, "excerpt_plan", "documents", rows, DOCUMENTS) == ""


DRAWN = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, greatest(1, cast(ceil(length(coalesce(text, '')) / 52.0) as int)) AS n FROM documents),
 e AS (SELECT doc_id, n, rpad(regexp_replace(regexp_replace(regexp_replace(text, '[^\\x20\\x09-\\x0D]', '#'), '[\\x20\\x09-\\x0D]', 'FFFFFFFF'), '#', '00000000'), n * 416, 'F') AS h FROM d)
 SELECT doc_id, 256 AS width, cast(8 * n + 32 * floor(n / 8) as int) AS height, unhex(array_join(transform(sequence(0, n - 1),
  r -> repeat(substring(h, r * 416 + 1, 208) || repeat('F', 96) || substring(h, r * 416 + 209, 208), 8) || if(r % 8 = 7, repeat('F', 16384), '')), '')) AS pixels FROM e"""


def test_pages_are_drawn_where_they_are_measured(spark, tmp_path):
    texts = [None, "", " ", "x " * 26, "ab c\n" * 300, "é\U0001f600\t\x0b\x1f\xa0" * 90, "w" * 416, "w" * 417]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(str(tmp_path / "documents.parquet")).createOrReplaceTempView("documents")
    want = {tuple(r) for r in spark.sql(DRAWN).collect()}
    assert {tuple(r) for r in drawn(spark, str(tmp_path)).collect()} == want
    for measure in (images.ink, images.skew, images.regions, images.columns):
        pixels = measure(drawn(spark, str(tmp_path)), "doc_id")
        texts = measure(spark.table("documents"), "doc_id", source=DRAWING)
        assert sorted(texts.collect()) == sorted(pixels.collect())
        assert "pixels" not in texts._jdf.queryExecution().toString()
    for name in ("page_ink", "page_skew", "page_regions"):
        assert "pixels" not in QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().toString()


@pytest.mark.parametrize("height,width", [(1, 1), (2, 64), (3, 64), (90, 64), (601, 64), (77, 33), (40, 300)])
def test_turns_by_tables_equal_turns_of_the_page(height, width):
    rng = np.random.default_rng(height)
    mask = rng.random((height, width)) < 0.6
    guard = 2 * width
    for degrees in (-3.25, -0.5, 0.25, 3.0):
        want = raster.turned(np.where(mask, 255, 0).astype(np.uint8), degrees, 0).sum(1)
        for rows in (0, 512):  # tables that are made for the page, and such that are kept
            turns = raster._Turns(width, height % 2, degrees)
            turns.grow(rows)
            assert (turns.sums(raster._codes(mask, guard), height, guard) == want).all()


def test_equal_cells_of_the_mask_equal_others():
    page = np.where(np.random.default_rng(5).random((96, 64)) < 0.03, 0, 255).astype(np.uint8)
    starts = np.arange(0, 96, 4), np.arange(0, 64, 4)
    want = np.logical_or.reduceat(np.logical_or.reduceat(page < 200, starts[0], 0), starts[1], 1)
    assert (raster.ink_mask(page) == want).all()


@pytest.mark.parametrize("strategy", ["blocks", "hierarchical"])
def test_parts_are_planned_once_for_a_document(spark, strategy):
    docs = spark.createDataFrame([(1, "Capítulo\n\n3\nTITULO\n" + "x " * 90, 1)], "doc_id int, text string, pages int")
    rows = summarize.plan_parts(docs, strategy, 100)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # the lines above the first explode, which are worked out for each of its rows, split no text
    above = plan[: plan.rindex("Generate")]
    assert "Generate" in above and "regexp_extract_all" not in above and "split(" not in above
    assert rows.count() == len({(r.chapter, r.block) for r in rows.collect()}) > 0


def test_chapters_are_covered_once_for_a_document(spark):
    plan = QUERIES["chapter_split"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan[: plan.index("Generate")]


def test_model_calls_hold_few_rows(spark):
    def factory():
        return lambda text, lang, template: {"k": text}

    rows = spark.range(3 * summarize.ROWS + 1).selectExpr("id", "cast(id as string) AS text", "'es' AS lang", "'C' AS template").coalesce(1)
    done = summarize.call_model(rows, factory).collect()
    assert len(done) == 3 * summarize.ROWS + 1 and all(r.sections == {"k": str(r.id)} and r.attempts == 1 for r in done)


def test_clusters_that_are_alike_are_worked_out_once(spark):
    texts = ["éạ̇ é 한글 " * 40 + "q̣̇", "한" * 30 + "ÅÅÅ" * 9, "plain", ""]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", nfc(F.col("t")).alias("c"), nfd(F.col("t")).alias("d"))
    for r in found.collect():
        assert (r.c, r.d) == (unicodedata.normalize("NFC", r.t), unicodedata.normalize("NFD", r.t))
    assert "array_distinct(" in found._jdf.queryExecution().analyzed().toString()


def test_base_words_are_folded_once(spark):
    rows = [("Ação rápida", ["acao", "AÇÃO", "ação", "rápida", "ção", "lento"]), ("x", ["abc"]), ("x", []), ("", ["abcd", "abcd"])]
    found = spark.createDataFrame(rows, "v string, b array<string>").select(lexical_overlap(F.col("v"), F.col("b")).alias("o"))
    assert [r.o for r in found.collect()] == [2 / 3, 1.0, 1.0, 0.0]
    assert "transform(array_distinct(filter(" in found._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", ["result_gates", "vlm_verify"])
def test_phrases_in_other_words_are_no_refusals(spark, tmp_path, name):
    texts = {7: "a pas an aienè des", 17: "was an ai queen", 18: "als as an aide he", 19: "as an aïeul", 20: "x_as an ai", 27: unicodedata.normalize("NFD", "Łódź as an aï")}
    rows = [(k, t, "fr", "s", len(t)) for k, t in texts.items()]
    assert differs(spark, tmp_path, name, "documents", rows, DOCUMENTS) == ""


def test_words_hold_numbers_and_no_joiners(spark, tmp_path):
    texts = {3: "caso³ ceso dado", 13: "km²a km²e abcd", 23: "nar\u200cam ner\u200cam ner", 33: "a‿bcd e‿bcd ebcd", 43: "ⒶBCD ⒺBCD abcd", 53: "casa½ cesa½x tres"}
    rows = [(k, t, "es", "s", len(t)) for k, t in texts.items()]
    assert differs(spark, tmp_path, "vlm_verify", "documents", rows, DOCUMENTS) == ""


def test_phrases_as_words_are_refusals(spark):
    texts = ["As an AI, no", "was an ai; as an ai", "(AS AN AI-based)", "as an ai", "Uma imagem mostra", "¿cómo puedo ayudarte", "your questions"]
    phrase = first_phrase(F.col("t"), tuple(dict.fromkeys((*fixed.REFUSALS, *fixed.CHATTER))))
    found = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(phrase.alias("p")).collect()]
    assert found == ["as an ai"] * 4 + ["a imagem mostra", "¿cómo puedo ayudar", "your question"]
