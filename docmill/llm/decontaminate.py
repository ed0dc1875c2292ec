"""Benchmark decontamination: BM25 inverted index of the test items, searched by block-max WAND, then verification.

The index has a posting list of (item, weight) for each term. Weights are BM25, divided by the item's
score with itself, so that a score is the share (0 to 1) of an item that a passage holds. Posting lists are
cut into blocks of ``BLOCK`` postings, each with its largest weight.

Every passage of every training text is a query. Passages are windows of twice ``half`` words, each half
overlapping the next; ``half`` is ``HALF``, and for longer items the next power of two, so any stretch of an item's
own length (and of ``HALF`` words at least) lies whole in one passage. It depends on the item alone, not on what else
is in the index. For each passage:

1. Essential postings: an item's heaviest terms, such that the others together weigh at most half the threshold. A
   passage whose essential postings leave every item below the threshold even with all its other terms
   can hold none; this is added up for many passages at once, and most end here.
2. Block-max WAND over the passage's posting lists: lists stand in the order of their next item, the pivot is the
   first item at which the lists' largest weights can reach the threshold, and the blocks that hold it are tested before
   anything is scored; where they cannot reach it, all lists skip to the end of the nearest block. Every item
   at or above the threshold is retrieved, none is cut off.

A retrieved item is verified on word shingles (5): its question part and its answer part
must each be held to ``overlap`` (0.8) by the passage. A part of fewer words is one shingle.

Scale: a map over the texts without a shuffle. Items are split into words, and document frequencies and the mean length
counted, in tables; ``SHARD_WORDS`` words of items (about 100 MB of index) are broadcast in one pass over the
texts, so one pass serves all but the largest benchmarks, and results do not depend on the number of passes.

Defined cases: null and empty texts hold nothing; rows with null ids are searched like others; an item without words is
never found; repeated document rows give repeated results, items repeated in id and text count once, equal texts under
several ids are found under each; a term that ties with another in weight is ordered by its number; items and
texts of any length are whole; ids may be of any type; an empty table on either side gives an empty result; other
columns are ignored, or passed through by ``drop_leaks``, whatever their names.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._store import discard, map_texts, materialize
from .quality import texts_of

SHARD_WORDS = 2_000_000
HALF = 64
BLOCK = 32
K1, B = 1.2, 0.75
N = 5
GROUP = 48
EPS = 1e-6
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def parts(text: str) -> tuple[list[str], list[str]]:
    """Words of an item's question and answer.

    The answer is what follows the last question mark, else the last line, else the last
    sentence; where that leaves a side without words, the last quarter of the words.
    """
    for cut in (text.rfind("?") + 1, text.rstrip().rfind("\n") + 1, max(text.rstrip(" .!\n").rfind(c) for c in ".!") + 1):
        question, answer = words_of(text[:cut]), words_of(text[cut:])
        if question and answer:
            return question, answer
    words = words_of(text)
    cut = max(1, len(words) - max(1, len(words) // 4))
    return words[:cut], words[cut:]


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n > 0 else set()


def held(part: list[str], passage: list[str]) -> float:
    """Share of the part's shingles that the passage holds; 1 for an empty part."""
    if not part:
        return 1.0
    n = min(N, len(part))
    own = shingles(part, n)
    return len(own & shingles(passage, n)) / len(own)


class Postings:
    """Inverted index of the items of one passage length: posting lists in item order with block maxima, and essential postings."""

    def __init__(self, half: int, items: list[int], weights: list[dict[int, float]], n_terms: int, threshold: float) -> None:
        self.half, self.items, self.threshold = half, items, threshold
        triples = sorted((t, i, w) for i, of in enumerate(weights) for t, w in of.items())
        self.item = array("i", [i for _, i, _ in triples])
        self.weight = array("d", [w for _, _, w in triples])
        lengths = np.bincount([t for t, _, _ in triples], minlength=n_terms) if triples else np.zeros(n_terms, np.int64)
        self.start = array("q", np.concatenate([[0], np.cumsum(lengths)]).tolist())
        self.best = array("d", bytes(8 * n_terms))
        self.block_start, self.block_last, self.block_max = array("q", [0]), array("i"), array("d")
        for t in range(n_terms):
            a, z = self.start[t], self.start[t + 1]
            for at in range(a, z, BLOCK):
                self.block_last.append(self.item[min(at + BLOCK, z) - 1])
                self.block_max.append(max(self.weight[at : min(at + BLOCK, z)]))
            self.block_start.append(len(self.block_last))
            if z > a:
                self.best[t] = max(self.block_max[self.block_start[t] : self.block_start[t + 1]])
        needed, essential = [], []
        for i, of in enumerate(weights):
            rest = sum(of.values())
            for t, w in sorted(of.items(), key=lambda x: (-x[1], x[0])):
                if rest <= threshold / 2:
                    break
                rest -= w
                essential.append((t, i, w))
            needed.append(threshold - rest)
        essential.sort()
        self.needed = np.array(needed)
        self.e_start = np.concatenate([[0], np.cumsum(np.bincount([t for t, _, _ in essential], minlength=n_terms))]).astype(np.int64) if essential else np.zeros(n_terms + 1, np.int64)
        self.e_item = np.array([i for _, i, _ in essential], np.int64)
        self.e_weight = np.array([w for _, _, w in essential])

    def candidates(self, win: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Passages whose essential postings leave some item within reach; ``win`` and ``term`` are distinct pairs."""
        n = self.e_start[term + 1] - self.e_start[term]
        some = n > 0
        win, term, n = win[some], term[some], n[some]
        if not len(n):
            return np.empty(0, np.int64)
        at = np.repeat(self.e_start[term] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        key, inverse = np.unique(np.repeat(win, n) * len(self.items) + self.e_item[at], return_inverse=True)
        reached = np.bincount(inverse, self.e_weight[at]) >= self.needed[key % len(self.items)] - EPS
        return np.unique(key[reached] // len(self.items))

    def _seek(self, cursor: list, item: int) -> bool:
        """Move a cursor [item, place, term] to the first posting at or behind ``item``; False at the end of its list."""
        end = self.start[cursor[2] + 1]
        cursor[1] = bisect_left(self.item, item, cursor[1], end)
        if cursor[1] == end:
            return False
        cursor[0] = self.item[cursor[1]]
        return True

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """(item, score) of all items at or above the threshold, by block-max WAND."""
        low = self.threshold - EPS
        cursors = [[self.item[self.start[t]], self.start[t], t] for t in terms if self.start[t] < self.start[t + 1]]
        found = []
        while cursors:
            cursors.sort()
            reach, p = 0.0, 0
            while p < len(cursors):
                reach += self.best[cursors[p][2]]
                if reach >= low:
                    break
                p += 1
            else:
                break
            pivot = cursors[p][0]
            while p + 1 < len(cursors) and cursors[p + 1][0] == pivot:
                p += 1
            reach, beyond = 0.0, 1 << 31
            for c in cursors[: p + 1]:
                block = bisect_left(self.block_last, pivot, self.block_start[c[2]], self.block_start[c[2] + 1])
                if block < self.block_start[c[2] + 1]:
                    reach += self.block_max[block]
                    beyond = min(beyond, self.block_last[block] + 1)
            if reach < low:
                if p + 1 < len(cursors):
                    beyond = min(beyond, cursors[p + 1][0])
                goal = max(beyond, pivot + 1)
            elif cursors[0][0] < pivot:
                goal = pivot
            else:
                score = sum(self.weight[c[1]] for c in cursors[: p + 1])
                if score >= low:
                    found.append((self.items[pivot], score))
                goal = pivot + 1
            live = [c for c in cursors[: p + 1] if c[0] >= goal or self._seek(c, goal)]
            cursors = live + cursors[p + 1 :]
        return found


class Index:
    """The items of one pass: their ids, parts and postings by passage length."""

    def __init__(self, rows: list[tuple], df: dict[str, int], n_items: int, mean_len: float, threshold: float) -> None:
        ids = defaultdict(list)
        for i, text in rows:
            ids[text].append(i)
        texts = sorted(ids, key=lambda t: (len(words_of(t)), t))
        self.ids, self.parts = [ids[t] for t in texts], [parts(t) for t in texts]
        words = [words_of(t) for t in texts]
        self.term = {w: k for k, w in enumerate(sorted({w for x in words for w in x}))}
        by_half = defaultdict(list)
        for k, x in enumerate(words):
            by_half[max(HALF, 1 << (len(x) - 1).bit_length())].append(k)
        self.postings = []
        for half, items in sorted(by_half.items()):
            weights = []
            for k in items:
                of = {}
                for t, tf in Counter(words[k]).items():
                    idf = math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5))
                    of[self.term[t]] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words[k]) / mean_len))
                whole = max(sum(of.values()), 1e-9)
                weights.append({t: w / whole for t, w in of.items()})
            self.postings.append(Postings(half, items, weights, len(self.term), threshold))

    def search(self, texts: list[str]) -> Iterator[tuple[int, int, float, list[str]]]:
        """(text, item, score, passage) of every passage and item at or above the threshold."""
        if not texts:
            return
        get = self.term.get
        words = [words_of(t) for t in texts]
        found = [np.fromiter((get(w, -1) for w in x), np.int64, len(x)) for x in words]
        for of in self.postings:
            half = of.half
            n_half = [max(1, -(-len(x) // half)) for x in words]
            first = np.concatenate([[0], np.cumsum(n_half)])
            terms = np.concatenate(found)
            part = np.concatenate([np.arange(len(x)) // half for x in words])
            seg = np.repeat(first[:-1], [len(x) for x in words]) + part
            last = np.repeat(n_half, [len(x) for x in words]) - 1 == part
            known = terms >= 0
            terms, seg, last, begin = terms[known], seg[known], last[known], part[known] == 0
            n_terms = max(1, len(self.term))
            # a passage is two neighbouring halves; a text of one half is one passage
            key = np.unique(np.concatenate([(seg * n_terms + terms)[~last | begin], (seg * n_terms + terms - n_terms)[~begin]]))
            win, term = key // n_terms, key % n_terms
            for w in of.candidates(win, term).tolist():
                lo, hi = np.searchsorted(win, [w, w + 1])
                doc = int(np.searchsorted(first, w, "right")) - 1
                s = (w - int(first[doc])) * half
                for item, score in of.search(term[lo:hi].tolist()):
                    yield doc, item, score, words[doc][s : s + 2 * half]

    def leaks(self, texts: Iterator[str], overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, question_overlap, answer_overlap) of verified items, the best passage of each text and item."""
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        group: list[str] = []

        def flush(end: int) -> None:
            for doc, item, score, passage in self.search(group):
                q, a = (held(p, passage) for p in self.parts[item])
                if q >= overlap and a >= overlap:
                    key = (end - len(group) + doc, item)
                    best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (round(score, 9), q, a))
            group.clear()

        size, k = 0, -1
        for k, t in enumerate(texts):
            group.append(t)
            size += len(t)
            if len(group) >= GROUP or size > 200_000:
                flush(k + 1)
                size = 0
        flush(k + 1)
        for (doc, item), found in sorted(best.items()):
            yield doc, item, *found


def item_words(items: DataFrame) -> DataFrame:
    """(item, text, words) of items with words, each pair of id and text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = pa.array([words_of(t) for t in texts_of(b, 1)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), words], ["item", "text", "words"])

    kind = items.schema["item"].dataType.simpleString()
    return items.distinct().mapInArrow(run, f"item {kind}, text string, words array<string>").filter("size(words) > 0")


def indexes(benchmark: DataFrame, threshold: float, item_col: str, item_text: str) -> Iterator[Index]:
    """The index of each pass; frequencies and lengths are those of all items."""
    found = materialize(item_words(benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))), "leak-items")
    sizes = found.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words")).first()
    shards = math.ceil(sizes["words"] / SHARD_WORDS)
    df = found.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for s in range(shards):
        shard = found.filter(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == s)
        own = shard.select(F.explode("words").alias("term")).distinct()
        counts = {r["term"]: r["df"] for r in df.join(own, "term").collect()}
        rows = [(r["item"], r["text"]) for r in shard.select("item", "text").collect()]
        yield Index(rows, counts, sizes["items"], sizes["words"] / sizes["items"], threshold)
    discard(found)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    overlap: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item, score, question_overlap, answer_overlap) of each text and item it leaks."""
    spark = docs.sparkSession
    id_field, item_field = docs.select(id_col).schema[0], benchmark.select(item_col).schema[0]
    item_type = to_arrow_type(item_field.dataType)
    names = ["id", "item", "score", "question_overlap", "answer_overlap"]
    schema = f"id {id_field.dataType.simpleString()}, item {item_field.dataType.simpleString()}, score double, question_overlap double, answer_overlap double"
    out = spark.createDataFrame([], schema)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    for index in indexes(benchmark, threshold, item_col, item_text):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [(k, i, *f) for k, item, *f in shared.value.leaks(texts_of(b, 1), overlap) for i in shared.value.ids[item]]
                at, items, *figures = zip(*found) if found else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(items, item_type), *[pa.array(f, pa.float64()) for f in figures]], names)

        out = out.unionByName(map_texts(rows, run, schema))
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    overlap: float = 0.8,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without the rows that leak an item; all columns stay as they are, and no id is needed."""
    at = docs.columns.index(text_col)
    for index in indexes(benchmark, threshold, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                gone = {k for k, *_ in shared.value.leaks(texts_of(b, at), overlap)}
                yield b.filter(pa.array([k not in gone for k in range(b.num_rows)], pa.bool_()))

        docs = map_texts(docs, run, docs.schema)
    return docs
