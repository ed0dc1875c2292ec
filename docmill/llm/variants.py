"""Spelling variants of a vocabulary, grouped without making pairs of words.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its near word
of largest count, if that is ``factor`` times its own or more; following forms to the last gives its root.

Words are numbered in the order (count falling, word rising), so that the best of some words is the one with the smallest number.

* Replacements: a word is in one group (position, prefix, suffix) for each of its code points. A group keeps its size and its
  two best words; a member counts size - 1 near words, and its best is the first of the two, or the second if it is the first itself.
  Two words that differ by a replacement share exactly one group.
* Insertions and deletions: the distinct strings that a word leaves when one code point is deleted (of a run of equal ones,
  only the last is tried) are joined with the vocabulary. A match counts for both sides at once and is added up before it is shuffled.

Scale: a word of L code points makes at most 2 L + 1 short rows. A group holds at most as many words as the alphabet has code
points, a word meets at most L deletions, so no group is hot, however frequent a word is; counts of words are combined before their
shuffle. Groups and joins are shuffled by key; the vocabulary is broadcast to the deletions only where it is counted to be small. Up to
``SHORT`` code points the keys are the strings themselves. Longer words would make L strings of length L; their keys are the
position and 128-bit digests of prefix and suffix, built in one pass over the word, hence linear in its length. Roots come by
doubling: each round follows twice as many forms, and a form's count is ``factor`` times higher, so rounds stay few.

Defined cases: null words and counts are left out, repeated words have their counts added; ties of counts go to the smaller word in
code-point order; words of any length are whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import materialize, small

#: Code points up to which a key is the string itself.
SHORT = 64


def letter_runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): the maximal runs of Latin letters of at least ``least`` code points in whole texts, A-Z lower-cased."""
    text = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))


def without(word: Column, at: Column) -> Column:
    """``word`` without its code point ``at`` (from 0)."""
    return F.overlay(word, F.lit(""), at + 1, F.lit(1))


def numbered(counts: DataFrame) -> DataFrame:
    """(wid, word, n, len): wid rises as n falls, and among equal n with the word."""
    given = materialize(counts.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n")), "variant-counts")
    order = [F.col("n").desc(), F.col("word")]
    placed = given.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(placed.select(F.monotonically_increasing_id().alias("wid"), "word", "n", F.length("word").alias("len")), "variant-words", given)


def long_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(wid, kind, key) for words above SHORT: ``any`` one code point replaced, ``cut`` one deleted, ``own`` every place to insert one."""
    rows: list[tuple[int, str, str]] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, ["wid", "kind", "key"])

    for b in batches:
        for wid, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            n, tail = len(word), hashlib.blake2b(digest_size=16)
            ends = bytearray(16 * (n + 1))  # digest of the reversed suffix that starts at each place
            ends[16 * n :] = tail.digest()
            for i in range(n - 1, -1, -1):
                tail.update(word[i].encode("utf-32-le"))
                ends[16 * i : 16 * i + 16] = tail.digest()
            head = hashlib.blake2b(digest_size=16)
            for i in range(n + 1):
                start = f"{i}:{head.hexdigest()}:"
                rows.append((wid, "own", start + ends[16 * i : 16 * i + 16].hex()))
                if i < n:
                    gap = start + ends[16 * i + 16 : 16 * i + 32].hex()
                    rows.append((wid, "any", gap))
                    if n > SHORT + 1 and word[i : i + 1] != word[i + 1 : i + 2]:
                        rows.append((wid, "cut", gap))
                    head.update(word[i].encode("utf-32-le"))
                if len(rows) >= 4096:
                    yield batch()
    if rows:
        yield batch()


def keys(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(wid, key) of the replacement groups, of the deletions, and of the vocabulary that deletions are joined with."""
    places = F.sequence(F.lit(0), F.col("len") - 1)
    word = F.col("word")
    gaps = words.filter(f"len between 1 and {SHORT}").select("wid", F.explode(F.transform(places, lambda i: F.concat_ws(":", i, without(word, i)))).alias("key"))
    last = lambda i: F.substring(word, i + 1, F.lit(1)) != F.substring(word, i + 2, F.lit(1))
    cuts = words.filter(f"len between 1 and {SHORT + 1}").select("wid", F.explode(F.transform(F.filter(places, last), lambda i: without(word, i))).alias("key"))
    own = words.filter(f"len <= {SHORT}").select("wid", word.alias("key"))
    long = words.filter(f"len > {SHORT}")
    if not long.isEmpty():
        made = long.select("wid", "word").mapInArrow(long_keys, "wid long, kind string, key string")
        gaps, cuts, own = (x.unionByName(made.filter(F.col("kind") == k).select("wid", "key")) for x, k in ((gaps, "any"), (cuts, "cut"), (own, "own")))
    return gaps, cuts, own


def near_words(words: DataFrame) -> DataFrame:
    """(wid, n_near, best): of each word with near words, their number and the smallest of their numbers."""
    gaps, cuts, own = keys(words)
    group = Window.partitionBy("key").orderBy("wid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = gaps.select("wid", F.count("*").over(group).alias("size"), F.nth_value("wid", 1).over(group).alias("first"), F.nth_value("wid", 2).over(group).alias("second"))
    best = F.when(F.col("wid") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    replaced = kept.filter("size > 1").select("wid", (F.col("size") - 1).alias("near"), best.alias("best"))
    shorter = small(materialize(own.select(F.col("wid").alias("short"), "key"), "variant-own"))
    met = cuts.join(shorter, "key").select(F.explode(F.array(F.struct("wid", F.col("short").alias("best")), F.struct(F.col("short").alias("wid"), F.col("wid").alias("best")))).alias("x"))
    indels = met.select("x.wid", F.lit(1).cast("long").alias("near"), "x.best")
    return replaced.unionByName(indels).groupBy("wid").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(wid, root) from (wid, form): forms followed to the last, twice as far in each round."""
    hop = materialize(forms.select("wid", F.col("form").alias("root")), "variant-hops")
    while True:
        ahead = small(hop.select(F.col("wid").alias("root"), F.col("root").alias("ahead")))
        step = hop.join(ahead, "root", "left").select("wid", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        step = materialize(step, "variant-hops", hop)
        if step.filter("moved").isEmpty():
            return step.select("wid", "root")
        hop = step


def spelling_variants(counts: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``counts`` (word, n)."""
    words = numbered(counts)
    near = materialize(near_words(words), "variant-near")
    own = words.select("wid", F.col("n").alias("own_n"))
    other = words.select(F.col("wid").alias("best"), F.col("n").alias("best_n"))
    judged = near.join(own, "wid").join(other, "best").withColumn("form", F.when(F.col("best_n") >= factor * F.col("own_n"), F.col("best")))
    judged = materialize(judged.select("wid", "n_near", "form"), "variant-forms", near)
    roots = last_forms(judged.filter("form is not null"))
    named = lambda key, *names: words.select(F.col("wid").alias(key), *[F.col(c).alias(a) for c, a in names])
    out = words.join(judged, "wid", "left").join(roots, "wid", "left")
    out = out.join(named("form", ("word", "form_word"), ("n", "form_n")), "form", "left").join(named("root", ("word", "root_word")), "root", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_word").alias("form"), "form_n", F.coalesce("root_word", "word").alias("root"))
