"""Audit of how five document filters interact, by Walsh-Hadamard sums.

Every document has a mask of the filters that it fails. For each part (language) and label, 32 signed parity sums are
aggregated, one for each set S of filters: the sum over documents of +1 where the number of failed filters in S is even,
else -1. The Walsh-Hadamard transform is its own inverse but for the factor 32, so the sums give back the exact number of
documents with each mask (a cell). All that an order of filters does follows from the cells: the step of filter f, after the
filters P, removes the cells that fail f and none of P. The Shapley column is closed too: of the 120 orders, a document
that fails k filters is removed by each of those in 120 / k.

Scale: a text is read once, where it stands; 45 bytes a row are written. Rows of equal texts meet in partial minima, never as
rows; only texts with several ids are joined back, by broadcast where they are counted to be few, else by an equi-join that adaptive
execution can split. The sums are combined before their shuffle, four rows a part and task at most. Nothing is collected, and no
group holds more than the four label groups of a part.

Defined cases: a null text is empty, a null part is the empty string; texts are identical if their SHA-256 digests are; a null
id is neither smaller nor larger than another, so its row neither fails nor lets another fail the copy filter; rows that
repeat an id and a text do not fail by each other; several labels of one id count as their largest, and an id
without a label, or null, is neither good nor toxic; an empty table has no parts and gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize, small

#: Bit k of a mask is filter FILTERS[k].
FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the mask of the filters A to D that its text fails, as __mask."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " ", -1), "")
    counted = docs.select("*", text.alias("__t"), words.alias("__w"))
    n, upper = F.size("__w"), F.length("__t") - F.length(F.translate("__t", UPPER, ""))
    fails = [n < 200, 100 * F.size(F.array_distinct("__w")) < 50 * n, 100 * upper > 3 * F.length("__t"), F.col("__t").rlike(r"[#$%&*|]")]
    return counted.withColumn("__mask", sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))).drop("__t", "__w")


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic) of every row of ``docs``; ``labels`` has (id, quality, toxic)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    read = text_failures(slim, F.col("text"))
    rows = materialize(read.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.col("__mask").cast("tinyint").alias("mask")), "audit-rows")
    copies = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("digest", "first")
    marks = labels.groupBy(F.col(id_col).alias("id")).agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")).filter("id is not null and (good or toxic)")
    joined = rows.join(small(materialize(copies, "audit-copies")), "digest", "left").join(small(materialize(marks, "audit-marks")), "id", "left")
    mask = F.col("mask") + F.when(F.col("id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    return joined.select("part", mask.alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def _sign(a: Column, b: Column) -> Column:
    """1 if the sets have an even number of filters in common, else -1."""
    return 1 - 2 * (F.bit_count(a.bitwiseAND(b)) % 2)


def parity_sums(masks: DataFrame) -> DataFrame:
    """(part, good, toxic, sums): the 32 signed sums of each part and label."""
    sums = masks.groupBy("part", "good", "toxic").agg(*[F.sum(_sign(F.col("mask"), F.lit(s))).alias(f"s{s}") for s in range(MASKS)])
    return sums.select("part", "good", "toxic", F.array(*[f"s{s}" for s in range(MASKS)]).alias("sums"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def mask_cells(sums: DataFrame) -> DataFrame:
    """(part, good, toxic, cells): the documents with each mask, from the sums."""
    inverse = F.transform(F.sequence(F.lit(0), F.lit(MASKS - 1)), lambda m: _total(F.transform("sums", lambda x, s: x * _sign(m, s))))
    return sums.select("part", "good", "toxic", F.transform(inverse, lambda x: F.shiftright(x, len(FILTERS))).alias("cells"))


def _bit(letter: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, f in enumerate(FILTERS) for x in (f, 1 << k)]), letter)


def audit_orders(cells: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows a part."""
    labelled = cells.groupBy("part").agg(F.collect_list(F.struct("good", "toxic", "cells")).alias("by"))  # four at most
    zero = F.array_repeat(F.lit(0).cast("long"), MASKS)
    added = lambda which: F.aggregate(F.filter("by", which), zero, lambda a, x: F.zip_with(a, x["cells"], lambda p, q: p + q))
    parts = labelled.select("part", added(lambda x: F.lit(True)).alias("n"), added(lambda x: x["good"]).alias("g"), added(lambda x: x["toxic"]).alias("t"))
    orders = F.lit(" ".join(map("".join, permutations(FILTERS))))
    turns = parts.select("*", F.explode(F.split(orders, " ")).alias("filter_order")).select("*", F.explode(F.lit(list(range(1, len(FILTERS) + 1)))).alias("step"))
    letter = lambda k: F.substring("filter_order", k, 1)
    before = sum((F.when(F.col("step") > k, _bit(letter(k))).otherwise(0) for k in range(1, len(FILTERS))), F.lit(0))
    turns = turns.select("*", _bit(F.expr("substring(filter_order, step, 1)")).alias("own"), before.alias("before"))
    own, before = F.col("own"), F.col("before")

    def over(counts: str, where) -> Column:
        return _total(F.transform(counts, lambda x, m: F.when(where(m), x).otherwise(F.lit(0).cast("long"))))

    fails = lambda m: m.bitwiseAND(own) != 0
    earlier = lambda m: m.bitwiseAND(before) != 0
    first = lambda m: fails(m) & ~earlier(m)
    share = F.transform("n", lambda x, m: F.when(fails(m), x * F.try_divide(F.lit(120), F.bit_count(m)).cast("long")).otherwise(F.lit(0).cast("long")))
    return turns.select(
        "part", "filter_order", "step",
        over("n", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        over("n", first).alias("removed"),
        over("n", lambda m: fails(m) & earlier(m)).alias("redundant"),
        over("n", lambda m: m == own).alias("unique_fails"),
        over("g", first).alias("good_lost"),
        over("t", first).alias("toxic_lost"),
        _total(share).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """All 120 orders of the five filters, step by step, for each part of ``docs``."""
    return audit_orders(mask_cells(parity_sums(failure_masks(docs, labels, id_col, text_col, part_col))))
