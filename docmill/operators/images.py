"""Page images: ink, columns, blocks, skew, recognition of blocks by engines that the caller brings.

Images are rows with ``width``, ``height`` and ``pixels`` (gray bytes, rows first). Each function is
a map over Arrow batches without a shuffle; pages are independent, and one page at a time is held as an
array. A row without pixels gives null measures and no boxes.

Measures also take a ``Source`` in place of pixels: a column and what makes the gray page of its value (a
decoder, a drawing). Such pages are made where they are measured and never cross to a worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import fixed as X
from ..functions import raster
from ..functions import text as T
from .ocr import confidence, text_lines, tsv_words

BOX = "array<struct<left:int,top:int,right:int,bottom:int>>"
#: Gives (word table, text) of a gray page part; the text may be None.
Engine = Callable[["raster.np.ndarray"], tuple[str, str | None]]


#: Rows, and bytes of their pixels, that one batch of results has at most; a larger page is a batch of its own.
ROWS, BYTES = 256, 4 << 20


class Source(NamedTuple):
    """A column, and the function that makes the gray page of its value; that gives None where there is no page."""

    column: str
    page: Callable[[Any], raster.np.ndarray | None]


def _pixels(pixels: bytes | None, width: int | None, height: int | None) -> raster.np.ndarray | None:
    return raster.gray(pixels, width, height) if pixels is not None and width and height else None


def _pages(df: DataFrame, keys: list[str], fields: str, each: Callable, source: Source | None = None) -> DataFrame:
    """Rows that ``each`` gives for every image, behind the image's keys; ``each`` gets None for a row without pixels."""
    columns, made = ([source.column], source.page) if source else (["pixels", "width", "height"], _pixels)
    kept = df.select(*keys, *columns)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = df.sparkSession.createDataFrame([], f"{kinds}, {fields}").schema
    arrow, n = to_arrow_schema(schema), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for k in range(b.num_rows):
                row = [b.column(c)[k].as_py() for c in range(b.num_columns)]
                for out in each(made(*row[n:])):
                    size = sum(len(v) for v in out if isinstance(v, bytes))
                    if rows and (len(rows) >= ROWS or held + size > BYTES):
                        yield _batch(rows, arrow)
                        rows, held = [], 0
                    rows.append([*row[:n], *out])
                    held += size
        if rows:
            yield _batch(rows, arrow)

    return kept.mapInArrow(run, schema)


def _batch(rows: list[list], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)


def paged(df: DataFrame, source: Source, *keys: str) -> DataFrame:
    """(keys, width, height, pixels): the pages of a source as a table."""
    each = lambda p: [(None, None, None) if p is None else (p.shape[1], p.shape[0], p.tobytes())]
    return _pages(df, list(keys), "width int, height int, pixels binary", each, source)


def _structs(found) -> list[dict[str, int]]:
    return [dict(zip(("left", "top", "right", "bottom"), map(int, b))) for b in found]


def ink(df: DataFrame, *keys: str, source: Source | None = None) -> DataFrame:
    """(keys, ink): share of dark pixels."""
    return _pages(df, list(keys), "ink double", lambda p: [(None if p is None else raster.ink_fraction(p),)], source)


def columns(df: DataFrame, *keys: str, source: Source | None = None) -> DataFrame:
    """(keys, boxes): the page's columns."""
    return _pages(df, list(keys), f"boxes {BOX}", lambda p: [(_structs([] if p is None else raster.boxes(p, True)),)], source)


def regions(df: DataFrame, *keys: str, source: Source | None = None) -> DataFrame:
    """(keys, boxes): valid blocks of the page in reading order."""

    def each(page):
        return [(_structs([] if page is None else raster.readable(raster.boxes(page), page.shape[1], page.shape[0])),)]

    return _pages(df, list(keys), f"boxes {BOX}", each, source)


def skew(df: DataFrame, *keys: str, source: Source | None = None) -> DataFrame:
    """(keys, angle): degrees to turn the page by."""
    return _pages(df, list(keys), "angle double", lambda p: [(None if p is None else raster.skew(p),)], source)


def straighten(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, width, height, pixels, angle): contrast stretched, and turned where lines are not level."""

    def each(page):
        if page is None:
            return [(None, None, None, None)]
        out, angle = raster.straightened(page)
        return [(out.shape[1], out.shape[0], out.tobytes(), angle)]

    return _pages(df, list(keys), "width int, height int, pixels binary, angle double", each)


def read_regions(df: DataFrame, factory: Callable[[], Engine], *keys: str) -> DataFrame:
    """(keys, ord, width, height, pixels, ink, tsv, text): each block in reading order, as the engine reads it.

    Write the result to a table before ``transcribe``, which uses it several times.
    """

    def each(page, engine=[]):  # noqa: B006 - one engine for each worker process
        if page is None:
            return
        engine or engine.append(factory())
        for k, (left, top, right, bottom) in enumerate(raster.readable(raster.boxes(page), page.shape[1], page.shape[0])):
            part = page[top:bottom, left:right]
            yield (k, right - left, bottom - top, part.tobytes(), raster.ink_fraction(part), *engine[0](part))

    return _pages(df, list(keys), "ord int, width int, height int, pixels binary, ink double, tsv string, text string", each)


def _second_opinion(rows: DataFrame, factory: Callable[[], Callable]) -> DataFrame:
    """(rid, candidate) of a vision model; a failing call is an empty candidate."""

    def each(page, model=[]):  # noqa: B006 - one model for each worker process
        model or model.append(factory())
        try:
            return [(model[0](page) or "",)]
        except Exception:  # a region's failure is data, not the job's failure
            return [("",)]

    return _pages(rows, ["rid"], "candidate string", each)


def transcribe(
    read: DataFrame, *keys: str, vision: Callable[[], Callable] | None = None, pack: str = "por+eng+spa", attempts: int = 2, store: str | None = None
) -> DataFrame:
    """(keys, text, conf, words, regions, non_text, vlm, vlm_rejected, reason) of pages read by ``read_regions``.

    Blocks of low confidence go to the vision model, whose transcriptions are verified against the
    engine's words and asked for again once; rejected twice, the engine's lines stay. Without such a model,
    blocks with ink but hardly a word are marked as figures. Confidence is weighted by words. With a vision
    model, its answers are written to tables below ``store``, a folder that all executors share, so no call
    is made twice, even if an executor is lost.
    """
    read = read.withColumn("rid", F.struct(*keys, "ord"))
    found = tsv_words(read, "rid", "tsv")
    base = found.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"]).alias("base"))
    rows = (
        read.join(confidence(found, "rid"), "rid", "left")
        .join(base, "rid", "left")
        .join(text_lines(found, "rid").withColumnRenamed("text", "lines"), "rid", "left")
        .fillna({"conf": 0.0, "words": 0, "lines": ""})
        .withColumn("base", F.coalesce("base", F.array().cast("array<string>")))
        .withColumn("weak", ~((F.col("conf") >= X.OCR_MIN_CONF) & (F.col("words") >= X.OCR_MIN_WORDS)))
        .withColumn("plain", F.coalesce("text", "lines"))
    )
    if vision is None:
        figure = (F.col("words") < X.NON_TEXT_WORDS) & (F.col("conf") < X.NON_TEXT_CONF) & (F.col("ink") > X.NON_TEXT_INK)
        done = rows.withColumn("figure", figure).select(
            *keys, "ord", "conf", "words", "figure", F.when(figure, X.NON_TEXT_MARKER).otherwise(F.col("plain")).alias("out"), F.lit(False).alias("vlm"), F.lit(None).cast("string").alias("reason")
        )
    else:
        if store is None:
            raise ValueError("a vision model needs a folder for its answers")
        asked, tries = rows.filter("weak"), None
        for _ in range(attempts):
            path = f"{store.rstrip('/')}/answers-{uuid.uuid4().hex}"
            _second_opinion(asked, vision).write.parquet(path)
            answers = read.sparkSession.read.parquet(path)
            judged = asked.drop("candidate", "reason").join(answers, "rid").withColumn("reason", T.verify_vlm(F.col("candidate"), F.col("base"), F.lit(pack)))
            accepted, asked = judged.filter("reason is null"), judged.filter("reason is not null")
            tries = accepted if tries is None else tries.unionByName(accepted)
        shape = lambda d, out, vlm: d.select(*keys, "ord", "conf", "words", F.lit(False).alias("figure"), out, F.lit(vlm).alias("vlm"), "reason")
        strong = rows.filter("not weak").withColumn("reason", F.lit(None).cast("string"))
        done = shape(strong, F.col("plain").alias("out"), False).unionByName(shape(tries, F.col("candidate").alias("out"), True)).unionByName(shape(asked, F.col("lines").alias("out"), False))
    counted = F.when(~F.col("figure"), F.col("words"))
    part = F.when(T.strip(F.col("out")) != "", F.struct("ord", "out"))
    rejected = F.col("reason").isNotNull()
    return done.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["out"]), "\n").alias("text"),
        F.round(F.coalesce(F.try_divide(F.sum(F.col("conf") * counted), F.sum(counted)), F.lit(0.0)), 2).alias("conf"),
        F.coalesce(F.sum(counted), F.lit(0)).alias("words"),
        F.count("*").alias("regions"),
        F.count_if("figure").alias("non_text"),
        F.bool_or("vlm").alias("vlm"),
        F.bool_or(rejected).alias("vlm_rejected"),
        F.min_by("reason", F.when(rejected, F.col("ord"))).alias("reason"),
    )
