"""Exact dedup by content hash, made of DataFrame functions only.

Rows are grouped by the 128-bit hash of their normalised text (runs of blanks become one space, null
counts as empty), and the smallest id of each group stays. The texts of groups with more than one
row are then grouped by their very bytes, so that a hash collision can never join two texts: where
one hash has several texts, each is a group of its own, told apart by its SHA-256, and the query
fails rather than join two texts that agree in both.

Scale: (hash, id) pairs are shuffled, 60 bytes a row, with counts combined before that. Texts are
shuffled only if their id is in a group (or, with more ids than are broadcast, passes a sieve of them), and equal texts of a task collapse before the shuffle, so a hot
group costs one text for each task. Rows find their groups by an equi-join on the hash, which adaptive
execution can split, or by a broadcast where the groups are counted to be few. The hash of a text is
computed once; a second time only for rows whose ids are among those of groups.

Defined cases: null text equals empty text; texts of any length are compared whole; a null id sorts behind all
others and stays only in a group without any id; every input row gives one output row, and of rows that
repeat both id and text all carry the same result (``kept`` speaks of the id and text; ``drop_exact_copies``
leaves one row); ids may be of any type that sorts; an empty table gives an empty result; other
columns are ignored, or passed through by ``drop_exact_copies``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import discard, matched, materialize, small


def normalised(text: Column) -> Column:
    """Text with each run of blanks (space, tab to carriage return) as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(norm: Column) -> Column:
    """128-bit hash as 16 bytes."""
    return F.unhex(F.md5(F.encode(norm, "UTF-8")))


def content_digest(norm: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(norm, 256))


def hashed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, sha) of every row."""
    slim = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return materialize(slim.select("id", content_hash(F.col("norm")).alias("hash"), content_digest(F.col("norm")).alias("sha")), "exact-hashes")


def equal_texts(docs: DataFrame, hashed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(hash, sha, keep, n) of the texts that have the hash of another row: the id that stays, and the rows of the text."""
    groups = hashed.groupBy("hash").agg(F.count("*").alias("rows")).filter("rows > 1").select("hash")
    groups = small(materialize(groups, "exact-groups"))
    ids = materialize(hashed.join(groups, "hash", "left_semi").filter("id is not null").select(F.col("id").alias("__of")).distinct(), "exact-ids")
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    some = matched(slim, F.col("id"), ids, "__of", "left_semi").unionByName(slim.filter("id is null"))
    members = some.select("id", normalised(F.col("text")).alias("norm")).withColumn("hash", content_hash(F.col("norm"))).join(groups, "hash", "left_semi")
    texts = members.groupBy("hash", "norm").agg(F.min("id").alias("keep"), F.count("*").alias("n"))
    told = texts.select("hash", content_digest(F.col("norm")).alias("sha"), "keep", "n").groupBy("hash", "sha").agg(F.min("keep").alias("keep"), F.sum("n").alias("n"), F.count("*").alias("texts"))
    collided = F.raise_error("two texts agree in MD5 and SHA-256")
    out = materialize(told.select("hash", "sha", "keep", F.when(F.col("texts") > 1, collided.cast("long")).otherwise(F.col("n")).alias("n")).filter("n > 1"), "exact-texts")
    discard(groups, ids)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``."""
    hashed = hashed_rows(docs, id_col, text_col)
    texts = small(equal_texts(docs, hashed, id_col, text_col))
    joined = hashed.join(texts, ["hash", "sha"], "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias(id_col),
        "hash",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the smallest id (null only if it has no other); all columns stay as they are.

    Rows that no group holds pass without a shuffle where the groups are few. Only where the id
    that stays comes in several rows of its text, those rows are shuffled to leave one.
    """
    hashed = hashed_rows(docs, id_col, text_col)
    found = equal_texts(docs, hashed, id_col, text_col)
    stays = hashed.alias("h").join(small(found).alias("t"), ["hash", "sha"]).filter(F.col("h.id").eqNullSafe(F.col("t.keep"))).groupBy("hash", "sha").agg(F.count("*").alias("again"))
    texts = materialize(found.join(stays, ["hash", "sha"]).select(F.struct("hash", "sha").alias("__key"), F.col("keep").alias("__keep"), F.col("again").alias("__again")), "exact-stays", hashed)
    norm = normalised(F.col(text_col))
    marked = matched(docs.withColumn("__own", F.struct(content_hash(norm).alias("hash"), content_digest(norm).alias("sha"))), F.col("__own"), texts, "__key", "left")
    stay = marked.filter(F.col("__again").isNull() | F.col("__keep").eqNullSafe(F.col(id_col)))
    once = stay.filter(F.coalesce("__again", F.lit(1)) == 1)
    if not texts.filter("__again > 1").isEmpty():
        once = once.unionByName(stay.filter("__again > 1").dropDuplicates(["__own"]))
    return once.select(*docs.columns)
