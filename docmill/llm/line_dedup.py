"""Line dedup by a suffix array over line-ID sequences, built by distributed prefix doubling.

A text is the sequence of its non-blank lines. Level 0 ranks every line that occurs more than
once; level k ranks prefixes of 2^k lines: a suffix's rank at level k + 1 follows from its rank
at level k and that of the suffix 2^k lines on, so the ranks order the suffixes by
their first 2^(k+1) lines. Suffixes whose prefix occurs only once leave the array, as
they can start no longer repeat. The suffixes that share their first m lines are an
interval of the array; the pair of ranks (level k at i, level k at i + m - 2^k, with 2^k <= m)
names the interval of depth m that holds suffix i.

What is deleted: a repeated run is a sequence of lines with ``min_words`` words or more that occurs
at more than one place. Its first occurrence, in the order of ids (null last), rows and lines, stays
for its sake; a line of a later occurrence goes unless it also stands in the first one, which
happens where a run overlaps itself. So twenty equal lines of ten words keep five of them, and A B A B A
with long lines keeps A B, as its third line repeats the first.

Only least intervals need to be formed. Each line has two least windows that reach ``min_words``:
one that starts and one that ends with it. A later occurrence [i, i + m) of a run whose first one starts
at f is covered by least windows inside it, and each of those occurs inside [f, f + m) too. A line of the
former outside the latter lies behind it or in another text, hence outside the first copy of its least
window as well. So intervals deeper than the least windows delete nothing more, and doubling
ends at the lines that ``min_words`` words can span.

Scale: lines are reduced to those that repeat before the first level, and there are at most
log2(min_words) + 1 levels. Ranks are grouped counts, a range partitioning of the distinct keys, and
joins on the keys, which adaptive execution can split where a line is in a third of all texts.

Defined cases: null and empty texts have no lines; blank lines never count and are never
deleted; repeated rows (same id and text, or null ids) are texts of their own, of which the first stays;
texts of any length are whole; an empty table gives an empty result; further columns of any name are
ignored, or passed through by ``cut_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize
from .quality import texts_of

LINES = "lines int, hash array<binary>, place array<int>, ahead array<int>, back array<int>"


def line_table(rows: DataFrame, min_words: int) -> DataFrame:
    """(uid, id, lines, hash, place, ahead, back) of rows (uid, id, text): arrays over the non-blank lines of each.

    ahead and back are the numbers of lines of the least windows that start and end with the
    line, 0 if the text ends before ``min_words`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, cols = [], [[], [], [], []]
            for t in texts_of(b, 2):
                lines = t.split("\n") if t else []
                place = [k for k, x in enumerate(lines) if x and not x.isspace()]
                words = np.array([len(lines[k].split()) for k in place], np.int64)
                upto = np.concatenate([[0], np.cumsum(words)])
                n = len(place)
                end = np.searchsorted(upto, upto[:-1] + min_words)
                begin = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
                total.append(len(lines))
                cols[0].append([xxhash.xxh3_128_digest(lines[k]) for k in place])
                cols[1].append(place)
                cols[2].append(np.where(end <= n, end - np.arange(n), 0).tolist())
                cols[3].append(np.where(upto[1:] >= min_words, np.arange(n) - begin + 1, 0).tolist())
            arrays = [pa.array(cols[0], pa.list_(pa.binary()))] + [pa.array(c, pa.list_(pa.int32())) for c in cols[1:]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(total, pa.int32()), *arrays], ["uid", "id", "lines", "hash", "place", "ahead", "back"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("uid", "id", "text").mapInArrow(run, f"uid long, id {kind}, {LINES}")


def ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct ``keys`` with ``rank``, a number in the order of ``by``."""
    ordered = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(ordered.withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def later_copies(suffixes: DataFrame, windows: DataFrame, levels: int) -> list[DataFrame]:
    """(uid, pos, m, first_uid, first_pos) of the windows that repeat an earlier one, the first of its interval; a table for each level.

    ``suffixes`` has (uid, pos, rank) at level 0, ``windows`` (uid, pos, m, ord).
    """
    out = []
    for k in range(levels):
        width = 1 << k
        here = windows.filter((F.col("m") >= width) & (F.col("m") < 2 * width)).join(suffixes.withColumnRenamed("rank", "r1"), ["uid", "pos"])
        tail = suffixes.select("uid", F.col("pos").alias("tail"), F.col("rank").alias("r2"))
        if k:
            here = here.withColumn("tail", F.col("pos") + F.col("m") - width).join(tail, ["uid", "tail"])
        else:
            here = here.withColumn("r2", F.col("r1"))
        interval = here.groupBy("m", "r1", "r2").agg(F.min("ord").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
        later = here.join(interval, ["m", "r1", "r2"]).filter(F.col("ord") > F.col("first"))
        out.append(materialize(later.select("uid", "pos", "m", F.col("first.uid").alias("first_uid"), F.col("first.pos").alias("first_pos")), "line-later"))
        if k + 1 < levels:
            pairs = suffixes.join(suffixes.select("uid", (F.col("pos") - width).alias("pos"), F.col("rank").alias("next")), ["uid", "pos"])
            keys = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).filter("n > 1").select("rank", "next")
            order = ranked(keys.withColumnRenamed("rank", "r"), ["r", "next"])
            deeper = pairs.withColumnRenamed("rank", "r").join(order, ["r", "next"]).select("uid", "pos", "rank")
            suffixes = materialize(deeper, "line-suffixes", order, *([suffixes] if k else []))
    return out


def repeats(rows: DataFrame, min_words: int) -> DataFrame:
    """(uid, id, lines, dropped) of rows (uid, id, text), whose uids are unique: places of the lines that go, in order."""
    texts = materialize(line_table(rows, min_words), "line-texts")
    lines = texts.select("uid", "id", F.posexplode(F.arrays_zip("hash", "ahead", "back")).alias("pos", "x")).select(
        "uid", "id", "pos", "x.hash", "x.ahead", "x.back"
    )
    often = lines.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    order = ranked(often, ["hash"])
    active = materialize(lines.join(order, "hash").select("uid", "id", "pos", "rank", "ahead", "back"), "line-active", order)

    def at(pos: Column) -> Column:
        return F.struct(F.col("id").isNull().alias("none"), "id", "uid", pos.alias("pos"))

    both = F.array(F.struct("pos", F.col("ahead").alias("m")), F.struct((F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("m")))
    windows = (
        active.select("uid", "id", F.explode(both).alias("w"))
        .filter("w.m > 0")
        .select("uid", F.col("w.pos").alias("pos"), F.col("w.m").alias("m"), at(F.col("w.pos")).alias("ord"))
        .distinct()
    )
    levels = later_copies(active.select("uid", "pos", "rank"), windows, max(1, int(min_words).bit_length()))
    later = levels[0]
    for level in levels[1:]:
        later = later.unionByName(level)
    in_first = (F.col("first_uid") == F.col("uid")) & F.col("at").between(F.col("first_pos"), F.col("first_pos") + F.col("m") - 1)
    gone = (
        later.withColumn("at", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("m") - 1)))
        .filter(~in_first)
        .groupBy("uid")
        .agg(F.array_sort(F.collect_set("at")).alias("gone"))
    )
    gone = materialize(gone, "line-gone", active, *levels)
    dropped = F.coalesce(F.transform("gone", lambda p: F.get("place", p)), F.array().cast("array<int>"))
    return texts.select("uid", "id", "lines", "place").join(gone, "uid", "left").select("uid", "id", "lines", dropped.alias("dropped"))


def repeated_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, dropped) for every row: places of the lines that belong to later copies."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = repeats(rows, min_words)
    return found.select(F.col("id").alias(id_col), F.col("lines").alias("n_lines"), F.size("dropped").alias("n_dropped"), "dropped")


def cut_repeats(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies cut out of the texts; every row stays, in all its columns, and ids need not be unique.

    Rows are told apart by a key of their own, written with them.
    """
    keyed = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "line-rows")
    rows = keyed.select(F.col("__row").alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = materialize(repeats(rows, min_words).filter(F.size("dropped") > 0).select(F.col("uid").alias("__row"), F.col("dropped").alias("__dropped")), "line-found")
    # the lines are a column of their own, so that a text is split once
    lines = keyed.join(found, "__row", "left").withColumn("__lines", F.when(F.col("__dropped").isNotNull(), F.split(text_col, "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__dropped")
    cut = F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stay, lambda k: F.get("__lines", k)), "\n"))
    return lines.withColumn(text_col, cut).select(*docs.columns)
