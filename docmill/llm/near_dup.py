"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of 5-word shingles (lower case, split at white space; a text of fewer
words is one shingle). Two different texts link when the sets' Jaccard similarity is at least
``threshold`` (0.8).

1. Rows with the same words collapse into one text, named by the 128-bit hash of its words, with
   a count and its smallest id; so thousands of copies cost one row, and ids need not be unique.
2. MinHash values (``BANDS`` x ``ROWS``) give buckets; buckets with one member go. At 0.8 a
   pair shares no bucket with probability (1 - 0.8^4)^30 = 1.4e-7.
3. Inside a bucket, MinHash values (8 bits each) are compared ``STEP`` by ``STEP``; a pair is
   dropped as soon as the posterior probability that its similarity reaches the threshold
   (uniform prior) falls below ``TOLERANCE``. Pairs that are already connected need no
   comparison. What remains is a forest of at most one link for each member.
4. The forest's components are verified exactly: shingle sets of each component meet in
   blocks, and all pairs of two blocks are intersected at once by a matrix product. Each
   block pair gives counts by text and a forest, never a list of pairs.
5. The components of the verified links are the classes.

Scale: large buckets and components are cut into blocks (``BUCKET`` members; ``BLOCK`` texts and
``BLOCK_SHINGLES`` shingles), and block pairs are spread over tasks. No task holds a whole
group. Only texts that pass step 3 are read again and made into shingle sets: their ids choose the rows,
by a broadcast where they are counted to be few, else by a shuffle. The work for a group of m *different*
near copies stays m^2 intersections (a link count needs them), spread over (m / BLOCK)^2 tasks, and
each of its shingle sets travels m / BLOCK times.

Defined cases: null and empty texts have no words and are copies of each other; rows with null ids take
part like others, but name a class only if it has no other id; repeated rows are copies of each other; ids
may be of any type that sorts; very long texts are whole; an empty table gives an empty result; other columns
are ignored, or passed through by ``keep_one_of_each``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ._store import map_texts, matched, materialize, small
from .components import components
from .linear import LONG
from .quality import texts_of

N = 5
BANDS, ROWS = 30, 4
STEP = 12
TOLERANCE = 1e-7
BUCKET = 2048
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20
MEMO = 300_000


class Shingler:
    """Shingle hashes and MinHash values of a text."""

    def __init__(self) -> None:
        rng = np.random.RandomState(20240229)
        self.a = (rng.randint(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.randint(0, 1 << 31, BANDS * ROWS).astype(np.uint32)[:, None]
        self.memo: dict[str, int] = {}

    def shingles(self, words: list[str]) -> np.ndarray:
        """Distinct 64-bit hashes, in order."""
        if not words:
            return np.empty(0, np.uint64)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        new = set(words).difference(memo)
        for w in new:
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        for w in new:
            if len(w) > LONG:  # not remembered
                del memo[w]
        n = max(1, len(h) - N + 1)
        x = np.zeros(n, np.uint64)
        for k in range(min(N, len(h))):
            x = (x ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        return np.unique(x)

    def minhash(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 2048):
            np.minimum(out, (self.a * x[at : at + 2048] + self.b).min(1), out=out)
        return out


def least_matches(threshold: float, step: int, total: int, tolerance: float) -> dict[int, int]:
    """For each number of compared 8-bit values, the least matches with which a pair stays.

    With a uniform prior the match probability has a Beta(m + 1, n - m + 1) posterior, which
    exceeds s with the probability that a Binomial(n + 1, s) is at most m.
    """
    s = threshold + (1 - threshold) / 256
    out = {}
    for n in range(step, total + 1, step):
        tail, m = 0.0, 0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out[n] = m
    return out


def word_key(words: list[str]) -> bytes:
    """128-bit hash that names a text by its words."""
    return xxhash.xxh3_128_digest(" ".join(words))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n, sketch, bands): words' 128-bit hash, shingles, 8-bit MinHash values, bucket hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler()
        for b in batches:
            keys, sizes, sketches, bands = [], [], [], []
            for t in texts_of(b, 1):
                words = t.lower().split()
                x = s.shingles(words)
                m = s.minhash(x)
                keys.append(word_key(words))
                sizes.append(len(x))
                sketches.append(((m * np.uint32(0x85EBCA6B)) >> np.uint32(24)).astype(np.uint8).tobytes())
                y = np.zeros(BANDS, np.uint64)
                for k in range(ROWS):
                    y = (y ^ m.reshape(BANDS, ROWS)[:, k]) * np.uint64(0xC2B2AE3D27D4EB4F)
                    y ^= y >> np.uint64(31)
                bands.append((y ^ (np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64) if len(x) else np.empty(0, np.int64))
            flat = pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64))
            cuts = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(cuts, flat)],
                ["id", "key", "n", "sketch", "bands"],
            )

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_texts(rows, run, f"id {kind}, key binary, n int, sketch binary, bands array<long>")


def _labels(lab: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the labels of linked rows, in place."""
    while len(a):
        m = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, lab[a], m)
        np.minimum.at(lab, lab[b], m)
        while not np.array_equal(lab, lab[lab]):
            lab[:] = lab[lab]
        left = lab[a] != lab[b]
        a, b = a[left], b[left]


def bucket_forest(bucket: np.ndarray, block: np.ndarray, cross: np.ndarray, sketch: np.ndarray, stays: dict[int, int]) -> np.ndarray:
    """Labels of the rows (sorted by bucket) after comparing the pairs inside each bucket.

    ``cross`` marks buckets that hold two blocks, of which only pairs between them count.
    """
    n = len(bucket)
    lab = np.arange(n)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    widest = int(np.diff(np.append(cuts, n)).max()) if n else 0
    for d in range(1, widest):
        a = np.flatnonzero(bucket[d:] == bucket[:-d])
        a = a[(lab[a] != lab[a + d]) & (~cross[a] | (block[a] != block[a + d]))]
        b, got, done = a + d, np.zeros(len(a), np.int32), 0
        while len(a) and done < sketch.shape[1]:
            got = got + (sketch[a, done : done + STEP] == sketch[b, done : done + STEP]).sum(1, dtype=np.int32)
            done += STEP
            stay = got >= stays[done]
            a, b, got = a[stay], b[stay], got[stay]
        _labels(lab, a, b)
    return lab


def paired(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Each row once for every pair of blocks of its group that holds its own: block, lo, hi."""
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node", group), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
    )


def candidate_links(reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a forest over the texts (node) whose pruned pairs connect them."""
    bands = reps.select("node", F.explode("bands").alias("bucket"))
    size = bands.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    placed = (
        paired(bands.join(size, "bucket"), "bucket", F.ceil(F.col("members") / BUCKET).cast("int"))
        .join(reps.select("node", "sketch"), "node")
        .select(F.xxhash64("bucket", "lo", "hi").alias("part"), "block", (F.col("lo") != F.col("hi")).alias("crossed"), "node", "sketch")
    )
    sorted_rows = placed.repartition("part").sortWithinPartitions("part")
    stays = least_matches(threshold, STEP, BANDS * ROWS, TOLERANCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks()
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
            lab = bucket_forest(t.column("part").to_numpy(), t.column("block").to_numpy(), t.column("crossed").to_numpy(zero_copy_only=False), sketch, stays)
            linked = np.flatnonzero(lab != np.arange(len(lab)))
            node = t.column("node").to_numpy()
            return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[lab[linked]])], ["a", "b"])

        for b in batches:
            part = b.column(0).to_numpy()
            last = int(np.searchsorted(part, part[-1]))
            if held and held[-1].column(0)[-1].as_py() != part[0]:
                yield flush(held)
                held = []
            if last > 0:
                yield flush([*held, b.slice(0, last)])
                held = []
            held.append(b.slice(last))
        if held:
            yield flush(held)

    return sorted_rows.mapInArrow(run, "a long, b long")


def rows_with(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (one column, distinct) or null."""
    return matched(docs, F.col(id_col), ids.toDF("__of"), "__of", "left_semi").unionByName(docs.filter(F.col(id_col).isNull()))


def shingle_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, shingles) of texts that may be among the members (key, rep): the rows with their ids, and those without an id."""
    ids = materialize(members.select("rep").filter("rep is not null").distinct(), "near-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                words = [t.lower().split() for t in texts_of(b.slice(at, 512), 0)]
                yield pa.RecordBatch.from_arrays([pa.array(map(word_key, words), pa.binary()), pa.array([s.shingles(w).tobytes() for w in words], pa.binary())], ["key", "shingles"])

    some = rows_with(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", ids)
    return map_texts(some.select("text"), run, "key binary, shingles binary").dropDuplicates(["key"])


def block_links(sets: list[np.ndarray], block: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Link matrix of the texts (pairs between blocks only, if there are two), and their labels."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, value, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    often = count[value] > 1
    column = np.cumsum(count > 1) - 1
    value, owner = column[value[often]], owner[often]
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    common = np.zeros((n, n))
    wide = int(value[-1]) + 1 if len(value) else 0
    for at in range(0, wide, 4096):
        lo, hi = np.searchsorted(value, [at, at + 4096])
        m = np.zeros((n, min(4096, wide - at)), np.float32)
        m[owner[lo:hi], value[lo:hi] - at] = 1
        common += m @ m.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if len(np.unique(block)) > 1:
        linked &= block[:, None] != block[None, :]
    lab = np.arange(n)
    a, b = np.nonzero(np.triu(linked))
    _labels(lab, a, b)
    return linked, lab


def verified_links(sets: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): counts of linked rows by text and block pair, and a forest.

    ``members`` has (node, key, root, n, copies).
    """
    size = members.groupBy("root").agg(F.count("*").alias("texts"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("texts") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    placed = paired(members.join(size, "root").join(sets, "key"), "root", blocks).select("root", "lo", "hi", "block", "node", "copies", "shingles")

    def run(table: pa.Table) -> pa.Table:
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        block = table.column("block").to_numpy()
        node = table.column("node").to_numpy()
        if len(block) < 2 or (lo != hi and len(np.unique(block)) < 2):
            return pa.table({"node": node[:0], "links": node[:0], "root": node[:0]})
        linked, lab = block_links([np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()], block, threshold)
        some = np.flatnonzero(linked.any(1))
        counts = (linked[some] @ table.column("copies").to_numpy().astype(np.float64)).astype(np.int64)
        return pa.table({"node": node[some], "links": counts, "root": node[lab[some]]})

    return placed.groupBy("root", "lo", "hi").applyInArrow(run, "node long, links long, root long")


def classes(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, key, ...) of every row, and (key, rep, links, class_id, first, rows) of every text.

    rep is the text's smallest id, links the number of other rows that a row of it links to, class_id the
    smallest id of its class, first (none, id, key) the row of the class that stays, rows the class's rows.
    """
    signed = materialize(signatures(docs, id_col, text_col), "near-signed")
    same = [F.first(c).alias(c) for c in ("n", "sketch", "bands")]  # equal in all rows of a key
    texts = signed.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), *same)
    reps = materialize(texts.withColumn("node", F.monotonically_increasing_id()), "near-reps")  # numbers sort and hash faster than keys
    roots = components(candidate_links(reps, threshold), "a", "b")
    members = materialize(roots.join(reps.select("node", "key", "rep", "n", "copies"), "node"), "near-members")
    checked = materialize(verified_links(shingle_sets(docs, members, id_col, text_col), members, threshold), "near-checked", members)
    linked = checked.groupBy("node").agg(F.sum("links").alias("links"))
    named = reps.select("node", "key", "rep", "copies")
    texts = components(checked, "node", "root").join(named, "node")
    whole = texts.groupBy("root").agg(
        F.min("rep").alias("class_id"), F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), "key")).alias("first"), F.sum("copies").alias("rows")
    )
    by_key = named.join(texts.select("node", "root").join(whole, "root"), "node", "left").join(linked, "node", "left")
    alone = F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), "key")
    by_key = by_key.select(
        "key",
        "rep",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links"),
        F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("first", alone).alias("first"),
        F.coalesce("rows", "copies").alias("rows"),
    )
    return signed.select("id", "key"), materialize(by_key, "near-texts", checked, reps)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, n_links, rep_id) for every row: its class, the other rows it links to, its representative.

    class_id is the smallest id of the class; a row without links is its own class. Rows with
    the same words link to each other.
    """
    rows, texts = classes(docs, threshold, id_col, text_col)
    return rows.join(texts, "key").select(F.col("id").alias(id_col), "class_id", F.col("links").alias("n_links"), F.col("rep").alias("rep_id"))


def keep_one_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class (its smallest id, null only if it has no other); all columns stay as they are.

    Rows whose ids no class of several rows holds pass as they are. Only the others, and those without an id,
    are told apart by their texts, and of equal rows one stays.
    """
    rows, texts = classes(docs, threshold, id_col, text_col)
    several = texts.filter("rows > 1").select(F.col("key").alias("__of_key"), F.col("first").alias("__first"))
    several = small(materialize(several, "near-classes"))
    ids = materialize(rows.join(several, F.col("key") == F.col("__of_key"), "left_semi").filter("id is not null").select("id").distinct().toDF("__of"), "near-touched")
    others = matched(docs, F.col(id_col), ids, "__of", "left_anti").filter(F.col(id_col).isNotNull())
    at, names = docs.columns.index(text_col), [*docs.columns, "__key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = pa.array([word_key(t.lower().split()) for t in texts_of(b, at)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, keys], names)

    touched = map_texts(rows_with(docs, id_col, ids), run, StructType([*docs.schema, StructField("__key", BinaryType())]))
    judged = touched.join(several, F.col("__key") == F.col("__of_key"), "left")
    first = F.col("__first.id").eqNullSafe(F.col(id_col)) & (F.col("__first.key") == F.col("__key"))
    single = judged.filter("__first is null").select(*docs.columns)
    chosen = judged.filter(F.col("__first").isNotNull() & first).dropDuplicates(["__key"]).select(*docs.columns)
    return others.unionByName(single).unionByName(chosen)
