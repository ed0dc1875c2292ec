"""Transcribers of PDFs: native text, recognition and vision model, page by page, by tools on the executors.

PDFs and images reach the tools through their standard input, so no executor needs a folder. The tools are
commands of a ``Tools`` value; ``{dpi}``, ``{page}`` and ``{lang}`` are filled in. What a tool made is written to a
table below ``store`` before it is used, so it runs once a page, whatever is made of it and whichever
executor is lost later.
"""

from __future__ import annotations

import shutil
import subprocess
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import raster
from ..functions import text as T
from . import images

PAGE = "doc_id string, page int, source string, text string, conf double, words bigint, chars int, vlm_rejected boolean"
PARTS = "doc_id string, page int, state string, ord int, width int, height int, pixels binary, ink double, tsv string, text string"


@dataclass(frozen=True)
class Tools:
    """Commands that read a PDF or an image from standard input."""

    pdfinfo: tuple[str, ...] = ("pdfinfo", "-")
    pdftotext: tuple[str, ...] = ("pdftotext", "-", "-")
    pdftoppm: tuple[str, ...] = ("pdftoppm", "-gray", "-r", "{dpi}", "-f", "{page}", "-l", "{page}", "-")
    recognise: tuple[str, ...] = ("tesseract", "stdin", "stdout", "-l", "{lang}", "--psm", "1")
    words: tuple[str, ...] = ("tesseract", "stdin", "stdout", "-l", "{lang}", "--psm", "1", "tsv")
    timeout: int = 120

    def run(self, tool: str, given: bytes, **values) -> bytes:
        """What a tool writes; nothing if it takes too long or cannot run."""
        command = [part.format(**values) for part in getattr(self, tool)]
        try:
            return subprocess.run(command, input=given, capture_output=True, timeout=self.timeout, check=False).stdout
        except (OSError, subprocess.SubprocessError):
            return b""

    def need(self, *tools: str) -> None:
        for tool in tools:
            if not self.has(tool):
                raise RuntimeError(f"missing tool: {getattr(self, tool)[0]}")

    def has(self, tool: str) -> bool:
        return shutil.which(getattr(self, tool)[0]) is not None

    def info(self, content: bytes) -> str:
        return self.run("pdfinfo", content).decode("utf-8", "replace")

    def pages(self, content: bytes) -> int:
        """Number of pages, 0 if it cannot be read."""
        for line in self.info(content).splitlines():
            name, _, value = line.partition(":")
            if name == "Pages" and value.strip().isdigit():
                return int(value)
        return 0


def pgm(page: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (page.shape[1], page.shape[0]) + page.tobytes()


def read_pgm(data: bytes) -> np.ndarray | None:
    """The gray page of a binary PGM file, None if it is none."""
    fields, at = [], 0
    while len(fields) < 4:
        end = at
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        if end > at and data[at : at + 1] != b"#":
            fields.append(data[at:end])
        elif data[at : at + 1] == b"#":
            end = data.find(b"\n", at) % (len(data) + 1)
        if end >= len(data):
            return None
        at = end + 1
    if fields[0] != b"P5" or not all(f.isdigit() for f in fields[1:]):
        return None
    width, height = int(fields[1]), int(fields[2])
    return np.frombuffer(data, np.uint8, width * height, at).reshape(height, width) if 0 < width * height <= len(data) - at else None


def _mapped(df: DataFrame, fields: str, each: Callable[..., Iterator[tuple]]) -> DataFrame:
    """The rows that ``each`` gives for every row of ``df``, one row at a time in memory."""
    schema = df.sparkSession.createDataFrame([], fields).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                for out in each(*[c[k].as_py() for c in b.columns]):
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def _stored(df: DataFrame, store: str, name: str) -> DataFrame:
    path = f"{store.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pdf_properties(pdfs: DataFrame, tools: Tools = Tools()) -> DataFrame:
    """(doc_id, info) of pdfs (doc_id, content): the properties as ``sources.pdf_info`` reads them."""
    return _mapped(pdfs.select(F.col("doc_id").cast("string"), "content"), "doc_id string, info string", lambda i, c: [(i, tools.info(c or b""))])


def native_text(pdfs: DataFrame, tools: Tools) -> DataFrame:
    """(doc_id, pages, text): number of pages and native text, pages behind form feeds."""

    def each(doc_id: str, content: bytes) -> Iterator[tuple]:
        tools.need("pdfinfo", "pdftotext")
        yield doc_id, tools.pages(content or b""), tools.run("pdftotext", content or b"").decode("utf-8", "replace")

    return _mapped(pdfs.select(F.col("doc_id").cast("string"), "content"), "doc_id string, pages int, text string", each)


def read_pages(asked: DataFrame, tools: Tools, lang: str, dpi: int, segment: bool) -> DataFrame:
    """PARTS of asked (doc_id, content, numbers): a row of state for each page (``ocr``, ``sin_imagen``, ``sin_ocr``; ord -1), and one for each block.

    With ``segment``, pages are straightened and cut into blocks in reading order, each with its word table;
    else a page is one block without a word table. Blocks of high confidence are recognised once more for their plain text.
    """

    def each(doc_id: str, content: bytes, numbers: list[int]) -> Iterator[tuple]:
        nothing = (None,) * 6
        for number in numbers:
            if not (tools.has("pdftoppm") and tools.has("recognise")):
                yield doc_id, number, "sin_ocr", -1, *nothing
                continue
            page = read_pgm(tools.run("pdftoppm", content, dpi=dpi, page=number))
            if page is None:
                yield doc_id, number, "sin_imagen", -1, *nothing
                continue
            yield doc_id, number, "ocr", -1, *nothing
            if not segment:
                text = tools.run("recognise", pgm(page), lang=lang).decode("utf-8", "replace")
                yield doc_id, number, "ocr", 0, page.shape[1], page.shape[0], None, None, None, text
                continue
            page, _ = raster.straightened(page)
            for k, (left, top, right, bottom) in enumerate(raster.readable(raster.boxes(page), page.shape[1], page.shape[0])):
                part = np.ascontiguousarray(page[top:bottom, left:right])
                tsv = tools.run("words", pgm(part), lang=lang).decode("utf-8", "replace")
                text = tools.run("recognise", pgm(part), lang=lang).decode("utf-8", "replace")
                yield doc_id, number, "ocr", k, right - left, bottom - top, part.tobytes(), raster.ink_fraction(part), tsv, text

    return _mapped(asked.select("doc_id", "content", "numbers"), PARTS, each)


def transcriber(
    store: str,
    tools: Tools = Tools(),
    lang: str = "por+eng+spa",
    dpi: int = 300,
    vision: Callable[[], Callable] | None = None,
    segment: bool = True,
) -> Callable[[DataFrame], DataFrame]:
    """A transcriber for the engine: pdfs (doc_id, content) to PAGE rows; tables are written below ``store``.

    A page with enough native text keeps it; the others are drawn and read, by blocks, with the vision model where the
    engine's confidence is low. Without ``segment``, the document as a whole is native or not, and its pages are read
    as they are. A page that cannot be drawn has the source ``sin_imagen``; where no engine is installed, the native
    text stays with the source ``sin_ocr``.
    """

    def transcribe(pdfs: DataFrame) -> DataFrame:
        pdfs = pdfs.select(F.col("doc_id").cast("string").alias("doc_id"), "content")
        native = _stored(native_text(pdfs, tools), store, "native")
        cut = native.withColumn("bodies", T.native_pages(F.col("text"), F.col("pages"))).withColumn("chars", F.transform("bodies", T.page_chars))
        if segment:
            decided = T.route_pages(F.col("chars"))
        else:
            kind = T.source_kind(F.aggregate("chars", F.lit(0), lambda a, n: a + n), F.col("pages"))
            decided = F.transform("chars", lambda _: F.when(kind == "nativo", "nativo").otherwise("ocr"))
        cut = cut.withColumn("decided", decided).withColumn("mixed", F.exists("decided", lambda d: d == "ocr"))
        # a document whose pages cannot be counted is asked for its first page
        pages = F.arrays_zip("bodies", "chars", "decided")
        each = cut.select("doc_id", "mixed", F.posexplode(pages).alias("at", "p")).select("doc_id", "mixed", (F.col("at") + 1).alias("page"), "p.*")
        each = each.unionByName(cut.filter("pages <= 0").select("doc_id", F.lit(False).alias("mixed"), F.lit(1).alias("page"), F.col("text").alias("bodies"), F.lit(0).alias("chars"), F.lit("ocr").alias("decided")))
        body = F.when(F.col("mixed"), F.regexp_replace("bodies", r"^\n+|\n+$", "")).otherwise(F.col("bodies"))
        kept = each.filter("decided = 'nativo'").withColumn("text", body)
        none = lambda kind: F.lit(None).cast(kind)
        length = F.when(F.col("mixed"), F.length("text")).otherwise(F.col("chars"))
        out = kept.select("doc_id", "page", F.lit("nativo").alias("source"), "text", none("double").alias("conf"), none("bigint").alias("words"), length.alias("chars"), F.lit(False).alias("vlm_rejected"))
        poor = each.filter("decided = 'ocr'")
        numbers = poor.groupBy("doc_id").agg(F.array_sort(F.collect_list("page")).alias("numbers"))
        parts = _stored(read_pages(pdfs.join(numbers, "doc_id"), tools, lang, dpi, segment), store, "parts")
        blocks = parts.filter("ord >= 0")
        if segment:
            read = images.transcribe(blocks.drop("state"), "doc_id", "page", vision=vision, pack=lang, store=store)
        else:
            read = blocks.select("doc_id", "page", "text", none("double").alias("conf"), none("bigint").alias("words"), F.lit(False).alias("vlm"), F.lit(False).alias("vlm_rejected"))
        state = parts.filter("ord < 0").select("doc_id", "page", "state").join(poor.select("doc_id", "page", "bodies"), ["doc_id", "page"])
        found = state.join(read.select("doc_id", "page", "text", "conf", "words", "vlm", "vlm_rejected"), ["doc_id", "page"], "left")
        source = F.when(F.col("state") != "ocr", F.col("state")).when(F.col("vlm"), "vlm").otherwise("tesseract")
        text = F.when(F.col("state") == "sin_ocr", F.col("bodies")).otherwise(F.coalesce("text", F.lit("")))
        measured = F.col("state") == "ocr"
        unread = 0 if segment else None
        done = found.select(
            "doc_id",
            "page",
            source.alias("source"),
            text.alias("text"),
            F.when(measured, F.coalesce("conf", F.lit(unread).cast("double"))).alias("conf"),
            F.when(measured, F.coalesce("words", F.lit(unread).cast("bigint"))).alias("words"),
            F.length(text).alias("chars"),
            F.coalesce("vlm_rejected", F.lit(False)).alias("vlm_rejected"),
        )
        return out.unionByName(done)

    return transcribe
