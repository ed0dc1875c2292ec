"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from ._store import materialize, remove, run_dir
from .decontaminate import find_leaks
from .exact_dedup import exact_dedup
from .filter_audit import filter_audit
from .line_dedup import repeated_lines
from .mixing import mix_sources, words_taken
from .near_dup import near_duplicates
from .quality import fit_quality, score_quality
from .secrets import BASE, joined, scan_secrets
from .token_count import count_tokens
from .toxicity import toxicity
from .url_filter import filter_urls, host_path
from .variants import letter_runs, spelling_variants, without
from .warc import assemble, page_captures, read_warc, resolved, value_of, write_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that leak a benchmark item: (doc_id, item_id, score, question_overlap, answer_overlap)."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("score", F.round("score", 6))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit)."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, class_id, n_links, rep_id)."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken)."""
    return words_taken(mix_sources(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, low_quality, toxic)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity(table(spark, sf_dir, "documents"), labels, ["low_quality", "toxic"])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped): the places of the dropped lines, comma-joined."""
    return repeated_lines(table(spark, sf_dir, "documents")).withColumn("dropped", F.array_join("dropped", ","))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256)."""
    return exact_dedup(table(spark, sf_dir, "documents")).drop("hash")


def shown_document(url: Column) -> Column:
    """Number that ends the path, before an optional suffix and slash; query and fragment do not count."""
    _, path = host_path(url)
    return F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[^/]*|[^/0-9]*)/*$", 1).try_cast("bigint")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity).

    A page carries the number of the document that it shows as the last number of its path;
    that document's quality label is the page's label.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    shown = shown_document(F.col("url"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("long").alias("good"))
    marks = pages.select("page_id", shown.alias("doc_id")).join(labels, "doc_id").select(F.col("page_id").alias("id"), "good")
    return filter_urls(pages, marks)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in BASE], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), all from the archives as read back."""
    pages, path = table(spark, sf_dir, "pages"), f"{run_dir(spark)}/archives-{uuid.uuid4().hex}"
    write_warc(page_captures(pages), path)
    records = materialize(read_warc(spark, path, payload=False), "warc-records")
    remove(spark, path)
    captures = resolved(materialize(assemble(records), "warc-captures", records)).filter("response is not null")
    page = lambda metadata: value_of(F.flatten(F.transform(metadata, lambda m: m["fields"])), "pageId").cast(pages.schema["page_id"].dataType)
    of = lambda name: F.coalesce(F.col(f"original.response.{name}"), F.col(f"response.{name}"))
    return captures.select(
        page(F.col("metadata")).alias("page_id"),
        of("payload_bytes").alias("payload_bytes"),
        of("payload_sha1").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        page(F.col("original.metadata")).alias("refers_to"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, form, root, n, n_near, form_n).

    Runs whose checksum with the document's id is a multiple of 31 lose one letter, which plants misspellings; a null id counts as empty.
    """
    runs = letter_runs(table(spark, sf_dir, "documents"), 7)
    sum_of = F.crc32(F.encode(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "run"), "UTF-8"))
    runs = runs.select("run", sum_of.alias("h"))
    planted = F.when(F.col("h") % 31 == 0, without(F.col("run"), (F.col("h") % F.length("run")).cast("int"))).otherwise(F.col("run"))
    counts = runs.groupBy(planted.alias("word")).agg(F.count("*").alias("n")).filter((F.col("n") >= 2) & (F.length("word") >= 7))
    return spelling_variants(counts)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_token_count,
        op3_quality,
        op4_near_duplicates,
        op5_mixing,
        op6_toxicity,
        op7_line_dedup,
        op8_exact_dedup,
        op9_url_filter,
        op10_secrets,
        op11_warc,
        op12_spelling_variants,
        op13_filter_audit,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": oracles.LEAKS,
    "op4_near_duplicates": oracles.NEAR,
    "op7_line_dedup": oracles.LINES,
    "op8_exact_dedup": oracles.EXACT,
    "op9_url_filter": oracles.URLS,
    "op10_secrets": oracles.SECRETS,
    "op11_warc": oracles.PAGES,
    "op12_spelling_variants": oracles.VARIANTS,
    "op13_filter_audit": oracles.AUDIT,
}
