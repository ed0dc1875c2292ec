"""Corpus pipeline: documents through five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the
stage before it kept. All but the last return the columns of documents, whatever further columns there are.

Every stage takes an empty table (and gives one), null texts (as empty ones), null and repeated ids, repeated rows and texts
of any length; what each makes of them stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.llm._store import settled
from docmill.llm.decontaminate import drop_leaks
from docmill.llm.exact_dedup import drop_exact_copies
from docmill.llm.mixing import mix_sources, words_taken
from docmill.llm.near_dup import keep_one_of_each
from docmill.llm.quality import fit_quality, keep_good


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Empty texts are judged by the intercept; rows without an id are judged like others, but never learned from; repeated rows
    share a fate; a score on the border is accepted; without any label all documents stay.
    """
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return keep_good(docs, fit_quality(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, white space aside.

    The smallest id stays, null only if a group has no other; of rows that repeat id and text one stays; null and
    empty texts are one group.
    """
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates.

    The smallest id of a class stays, null only if it has no other; of equal rows one stays; texts without words are one class.
    """
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows go by themselves, so a leak without an id or with the id of a clean document goes and that one stays; empty
    texts stay; repeated rows share a fate; without items all stay.
    """
    return drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): what the mixture takes of each document, one row for each.

    Documents of size 0 take 0; a null source is one more source; rows without an id or with a repeated one are documents of
    their own; ties in the random order are broken by id and size.
    """
    return words_taken(mix_sources(docs)).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("mix", mix)]
#: A trained classifier and a similarity join have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(lambda given=docs, stage=stage: stage(spark, given, sf_dir), f"stage-{name}", docs)
    return STAGES[-1][1](spark, docs, sf_dir)
