"""File readers and writers: texts, PDFs, summaries, control sets, uploads."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..places import opened
from . import schemas

#: Bytes of a PDF that the service and the worker take.
UPLOAD_LIMIT = 100 * 1024 * 1024


def _stem(path: str):
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")


def text_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text): one row for each .txt file, named by its stem; bytes that are no UTF-8 become U+FFFD.

    Spark's file listing leaves out files of zero bytes, so they give no row.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return found.select(_stem("path").alias("doc_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, path, length, content, pdf_sha256) of the PDF files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    return files.select(_stem("path").alias("doc_id"), "path", "length", "content", F.sha2("content", 256).alias("pdf_sha256"))


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Summary records of a folder, one JSON file each; reports and job files are left out, absent optional fields get defaults."""
    rows = spark.read.schema(schemas.SUMMARY).option("pathGlobFilter", "*.json").option("multiLine", True).json(path)
    rows = rows.filter(~F.col("_metadata.file_name").isin("report.json", "_jobs.json"))
    return (
        rows.withColumn("secciones", F.coalesce("secciones", F.create_map().cast("map<string,string>")))
        .withColumn("idiomas_resumo_origem", F.coalesce("idiomas_resumo_origem", F.array().cast("array<string>")))
        .withColumn("abstracts_origem", F.coalesce("abstracts_origem", F.array().cast(f"array<{schemas.ABSTRACT}>")))
    )


def read_ocr_meta(spark: SparkSession, path: str) -> DataFrame:
    """OCR metadata of a folder, one ``.meta.json`` file each or as ``write_ocr_meta`` leaves it, with ``readable``: false for a file that is no JSON object."""
    files = spark.read.schema(f"{schemas.OCR_META}, _corrupt_record string").option("pathGlobFilter", "{*.meta.json,part-*.json}").option("recursiveFileLookup", True)
    rows = files.option("multiLine", True).json(path)
    named = rows.withColumn("file", F.regexp_replace(F.col("_metadata.file_name"), r"\.meta\.json$", ""))
    kept = named.withColumn("doc_id", F.coalesce("doc_id", "file")).withColumn("readable", F.col("_corrupt_record").isNull()).withColumn("legacy", F.coalesce("legacy", F.lit(False)))
    return kept.withColumnRenamed("ocr_pipeline_version", "pipeline_version").drop("_corrupt_record", "file")


def write_ocr_meta(meta: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The metadata of documents as one JSON file each, below a folder for each document."""
    named = meta.withColumnRenamed("pipeline_version", "ocr_pipeline_version")
    named.withColumn("doc", F.col("doc_id")).repartition("doc").write.mode(mode).partitionBy("doc").json(path)


def read_control_set(spark: SparkSession, path: str) -> DataFrame:
    """Control cases from a JSON array; absent expectations are empty."""
    rows = spark.read.schema(schemas.CONTROL_CASE).option("multiLine", True).json(path)
    return rows.select(
        "doc_id",
        F.coalesce("expected_lang", F.lit("")).alias("expected_lang"),
        F.coalesce("expected_type", F.lit("")).alias("expected_type"),
        F.coalesce("expected_terms", F.array().cast("array<string>")).alias("terms"),
    )


def pdf_info(df: DataFrame, key: str, info: str) -> DataFrame:
    """(key, title, subject, author, keywords, creation_date, pages) from ``Name: value`` lines; blank values are null."""
    pairs = F.transform(F.split(info, "\n"), lambda x: F.split(x, ":", 2))
    entries = F.filter(pairs, lambda p: (F.size(p) == 2) & (F.btrim(F.get(p, F.lit(1))) != ""))

    def value(name: str):
        return F.btrim(F.get(F.try_element_at(F.filter(entries, lambda p: F.btrim(F.get(p, F.lit(0))) == name), F.lit(1)), F.lit(1)))

    return df.select(
        key,
        *[value(n).alias(c) for n, c in (("Title", "title"), ("Subject", "subject"), ("Author", "author"), ("Keywords", "keywords"), ("CreationDate", "creation_date"))],
        value("Pages").try_cast("int").alias("pages"),
    )


def screen_uploads(files: DataFrame, max_bytes: int) -> DataFrame:
    """``files`` with status 413 (too large), 415 (no PDF) or 202, and the id that its content gives."""
    magic = F.substring("content", 1, 5) == F.lit(b"%PDF-")
    return files.withColumn("status", F.when(F.col("length") > max_bytes, 413).when(~magic, 415).otherwise(202)).withColumn(
        "content_id", F.substring(F.sha2("content", 256), 1, 12)
    )


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON line for each record; the commit protocol makes the write atomic."""
    df.write.mode(mode).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """The records as the elements of one JSON array, in one file; the writer streams them, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for b in batches:
            lines = [("," if k or not first else "[") + r for k, r in enumerate(b.column(0).to_pylist())]
            first = first and not lines
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], ["value"])

    df.select(F.to_json(F.struct("*")).alias("value")).repartition(1).mapInArrow(run, "value string").write.text(path)


def write_json_file(df: DataFrame, path: str) -> None:
    """The records as the elements of one JSON array, in the one file ``path``, which is there whole or not at all.

    Tasks write their records, a comma behind each, as files of their own; the sizes of those give each its place in the array, and
    where the file system allows it, tasks copy them there side by side. Elsewhere one task streams them one after the other. Only sizes pass through the driver.
    """
    spark, draft = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    df.select(F.to_json(F.struct("*")).alias("value")).write.option("lineSep", ",\n").text(f"{draft}-parts")
    store, whole = opened(draft)
    parts = sorted((f.path, f.size) for f in store.get_file_info(fs.FileSelector(f"{whole}-parts")) if f.is_file and f.size and "/part-" in f.path)
    places = list(accumulate((size for _, size in parts), initial=2))
    try:
        if isinstance(store, fs.LocalFileSystem):
            _place_parts(spark, whole, parts, places)
        else:
            _stream_parts(spark, draft, parts)
        store.move(whole, opened(path)[1])
    finally:
        store.delete_dir(f"{whole}-parts")


def _place_parts(spark: SparkSession, whole: str, parts: list[tuple[str, int]], places: list[int]) -> None:
    end = places[-1] - 2 if parts else 2  # the last comma and line end go
    with open(whole, "wb") as out:
        out.write(b"[\n")
        out.truncate(end)

    def copy(rows: Iterator) -> None:
        for r in rows:
            with open(r["part"], "rb") as part, open(whole, "r+b") as out:
                out.seek(r["place"])
                left = r["size"]
                while left:
                    got = part.read(min(left, 1 << 20))
                    out.write(got)
                    left -= len(got)

    sizes = [size - (2 if k + 1 == len(parts) else 0) for k, (_, size) in enumerate(parts)]
    if parts:
        asked = [(p, at, size) for (p, _), at, size in zip(parts, places, sizes)]
        spark.createDataFrame(asked, "part string, place long, size long").repartition(min(len(asked), spark.sparkContext.defaultParallelism)).foreachPartition(copy)
    with open(whole, "ab") as out:
        out.write(b"\n]\n" if parts else b"]\n")


def _stream_parts(spark: SparkSession, draft: str, parts: list[tuple[str, int]]) -> None:
    def copy(rows: Iterator) -> None:
        for r in rows:
            store, whole = opened(r["draft"])
            with store.open_output_stream(whole) as out:
                out.write(b"[\n")
                for k, (part, size) in enumerate(parts):
                    left = size - (2 if k + 1 == len(parts) else 0)
                    with store.open_input_stream(part) as given:
                        while left:
                            got = given.read(min(left, 1 << 20))
                            out.write(got)
                            left -= len(got)
                out.write(b"\n]\n" if parts else b"]\n")

    spark.createDataFrame([(draft,)], "draft string").coalesce(1).foreachPartition(copy)
