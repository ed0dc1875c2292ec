"""Many terms in many texts: an automaton for terms that fit into memory, and a join on q-grams for two tables of any size.

``term_matches`` goes through each text once for all terms, by an Aho-Corasick automaton that every Python worker builds from a broadcast
list. The list is bounded: terms with more than ``chars`` characters in all are cut into shards by a hash, and there is a pass for each.

``containing`` finds the pairs of strings of which one contains the other, without comparing all with all. A string that is contained must
have its rarest q-gram in the other, so each asks for that one gram: an equi-join, whose candidates are then verified. Strings are
compared once however often they come. A frequent gram is asked for only by strings that have no rarer one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the terms of one automaton (about 100 bytes of memory each).
TERM_CHARS = 2_000_000
#: Code points of a gram.
Q = 3
#: The 32 bits of a gram's code.
LOW = (1 << 32) - 1


def term_matches(texts: DataFrame, terms: DataFrame, key: str, text: str = "text", chars: int = TERM_CHARS) -> DataFrame:
    """(key, term_id, term, first): the terms (term_id long, term) that each row of ``texts`` holds, in lower case, and the place of the first hit, from 1.

    A null text is empty; null terms are left out; an empty term is in every text; terms that repeat an id and a string count once,
    an id may name several terms.
    Rows of ``texts`` that repeat a key have rows of their own.
    """
    known = terms.select(F.col("term_id").cast("long"), F.lower("term").alias("term")).filter("term is not null and term_id is not null").distinct()
    total = known.agg(F.coalesce(F.sum(F.length("term")), F.lit(0))).first()[0]
    shards = max(1, -(-total // chars))
    low = texts.select(F.col(key), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    kind = low.schema[key].dataType.simpleString()
    spark, found = texts.sparkSession, None
    for k in range(shards):
        own = known.filter(F.pmod(F.xxhash64("term"), F.lit(shards)) == k) if shards > 1 else known
        shared = spark.sparkContext.broadcast([(r["term"], r["term_id"]) for r in own.collect()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            by_term: dict[str, list[int]] = {}
            for term, i in shared.value:
                by_term.setdefault(term, []).append(i)
            everywhere = [(i, "") for i in by_term.pop("", [])]
            machine = ahocorasick.Automaton()
            for term, ids in by_term.items():
                machine.add_word(term, (len(term), [(i, term) for i in ids]))
            machine.make_automaton()
            for b in batches:
                for at in range(0, b.num_rows, 64):
                    part = b.slice(at, 64)
                    rows, hits, places = [], [], []
                    for n, t in enumerate(part.column(1).to_pylist()):
                        seen = dict.fromkeys(everywhere, 1)
                        if by_term:
                            for end, (size, own) in machine.iter(t):
                                for hit in own:
                                    seen.setdefault(hit, end - size + 2)
                        rows += [n] * len(seen)
                        hits += seen
                        places += seen.values()
                    ids, words = pa.array([i for i, _ in hits], pa.int64()), pa.array([w for _, w in hits], pa.string())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int32())), ids, words, pa.array(places, pa.int32())], ["key", "term_id", "term", "first"])

        one = low.mapInArrow(run, f"key {kind}, term_id long, term string, first int").withColumnRenamed("key", key)
        found = one if found is None else found.unionByName(one)
    return found


def grams(s: Column, size: int) -> Column:
    """The distinct strings of ``size`` code points in a string."""
    return F.array_distinct(F.regexp_extract_all(s, F.lit(rf"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _inside(needles: DataFrame, hay: DataFrame) -> DataFrame:
    """(needle, hay): distinct strings of ``needles`` (s) that are contained in others of ``hay`` (s)."""
    few = [r[0] for r in needles.filter(F.length("s") < Q).select(F.length("s")).distinct().collect()]  # Q - 1 numbers at most
    sizes = [*sorted(few), Q]
    # grams by 32 bits of a hash, so that what aggregates keep has a fixed size and nothing is sorted; equal codes only give more to verify
    code = F.xxhash64("gram").bitwiseAND(F.lit(LOW)).alias("code")
    held = hay.select(F.col("s").alias("hay"), F.explode(F.array_distinct(F.concat(*[grams(F.col("s"), n) for n in sizes]))).alias("gram")).select("hay", code)
    own = F.when(F.length("s") < Q, F.array(F.col("s"))).otherwise(grams(F.col("s"), Q))
    asked = needles.select(F.col("s").alias("needle"), F.explode(own).alias("gram")).select("needle", code)
    # a gram that no other string holds rules its string out; of the others the rarest is asked for
    often = held.groupBy("code").agg(F.least(F.count("*"), F.lit(LOW >> 1)).alias("n"))
    rarest = F.min(F.coalesce("n", F.lit(0)) * (LOW + 1) + F.col("code")).alias("rarest")
    rated = asked.join(often, "code", "left").groupBy("needle").agg(rarest).filter(F.col("rarest") > LOW).select("needle", F.col("rarest").bitwiseAND(F.lit(LOW)).alias("code"))
    return rated.join(held, "code").filter(F.contains("hay", F.col("needle"))).select("needle", "hay")


def containing(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label): pairs of the distinct strings of texts (text) and labels (label) of which one contains the other, case aside.

    Null and empty strings are in no pair.
    """
    low = lambda df, c: df.select(F.col(c).alias("own"), F.lower(c).alias("s")).filter("own <> ''").distinct()
    t, b = low(texts, "text"), low(labels, "label")
    # a string gives tens of grams: as many tasks as shuffles have, for adaptive execution would put the short strings into one
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ts, bs = (x.select("s").repartition(parts, "s").distinct() for x in (t, b))
    pairs = _inside(bs, ts).select(F.col("hay").alias("ts"), F.col("needle").alias("bs")).unionByName(_inside(ts, bs).select(F.col("needle").alias("ts"), F.col("hay").alias("bs"))).distinct()
    return pairs.join(t.select(F.col("own").alias("text"), F.col("s").alias("ts")), "ts").join(b.select(F.col("own").alias("label"), F.col("s").alias("bs")), "bs").select("text", "label")


def closest_label(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``texts`` (text, ...) with label: the one that equals the text, else the first by ``place`` of which one contains the other, else null.

    ``labels`` has (label, place); of labels that share a place the smaller string is the first.
    """
    pairs = containing(texts.select("text"), labels.select("label"))
    placed = labels.groupBy("label").agg(F.min("place").alias("place"))
    best = pairs.join(placed, "label").groupBy("text").agg(F.min_by("label", F.struct(F.col("label") != F.col("text"), F.col("place"), F.col("label"))).alias("label"))
    return texts.join(best, "text", "left")
