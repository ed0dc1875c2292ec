"""Bounded memory, joins of texts through a sieve, parting levels, and the classifier chain against a plain one."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.llm import _store, exact_dedup, near_dup, quality, warc
from docmill.llm.decontaminate import drop_leaks
from docmill.llm.linear import DIM, Ftrl, QualityFeatures, TermFeatures, summed
from docmill.llm.near_dup import Shingler, keep_one_of_each, near_duplicates
from docmill.llm.quality import fit_quality, keep_good, labelled_sample
from docmill.llm.toxicity import FOLDS, PASSES, best_threshold, fit_chain, toxicity
from docmill.llm.url_filter import filter_urls


def test_long_words_are_not_remembered():
    words = [chr(97 + k % 26) * 1_000_000 for k in range(20)]
    s, t, q = Shingler(), TermFeatures(), QualityFeatures()
    for w in words:
        s.shingles([w, "short"])
        t(f"{w} short")
        q(f"{w} short")
    assert set(s.memo) == set(t.memo) == set(q.memo) == {"short"}


@pytest.mark.parametrize("n", [0, 1, 300])
def test_sieve(spark, n):
    keys = spark.range(n).select((F.col("id") * 7).alias("k"))
    rows = spark.range(5000).select(F.when(F.col("id") % 11 > 0, F.col("id")).alias("x"), F.lit("t").alias("text"), F.lit(1).alias("uid"))
    got = {(r.x, r.may) for r in _store.sieved(rows, F.col("x"), keys, "k", n).select("x", F.col("__may").alias("may")).collect()}
    own = {7 * k for k in range(n)}
    assert all(may for x, may in got if x in own) and not any(may for x, may in got if x is None)
    assert sum(may for _, may in got) <= 2 * n + 1  # few others pass


def test_joins_through_a_sieve_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(_store, "BROADCAST_ROWS", 3)
    rows = spark.createDataFrame([(None if k % 9 == 0 else k % 40, f"t{k}") for k in range(200)], "i int, text string")
    keys = spark.createDataFrame([(k, k * k) for k in range(0, 60, 5)], "of int, v int")
    for how in ("left", "left_semi", "left_anti"):
        got = _store.matched(rows, F.col("i"), keys, "of", how)
        want = rows.join(keys, rows.i == keys.of, how)
        assert got.columns == want.columns and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_operators_through_a_sieve(spark, monkeypatch):
    r = random.Random(2)
    base = [" ".join(f"w{r.randrange(500)}" for _ in range(40)) for _ in range(30)]
    rows = [(k, r.choice(base) + r.choice(["", "", " x"])) for k in range(90)] + [(None, base[0]), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pages = docs.selectExpr("doc_id AS page_id", "concat('http://h/', doc_id) AS url", "repeat(text, 9) AS html")

    def all_of():
        return [
            Counter(map(tuple, exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept").collect())),
            Counter(map(tuple, near_duplicates(docs).select("doc_id", "class_id", "n_links").collect())),
            Counter(x.doc_id for x in keep_one_of_each(docs).collect()),
            Counter(x.doc_id for x in exact_dedup.drop_exact_copies(docs).collect()),
            Counter(map(str, warc.page_captures(pages).select("target_uri", "refers").collect())),
        ]

    plain = all_of()
    monkeypatch.setattr(_store, "BROADCAST_ROWS", 0)
    assert all_of() == plain


def parted(levels, spark):
    """Pages of one host whose labelled paths part at every level; at one of them the share of good labels differs."""
    rows = [(k, "http://h.test/" + "/".join(f"{'ab'[k >> 1 & 1]}{d}" if d != 2 else ("spam" if k % 2 else "good") for d in range(levels))) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    return filter_urls(pages, spark.createDataFrame([(k, 1 - k % 2) for k in range(60)], "id long, good long"))


def test_parting_levels_cost_no_rounds(spark):
    jobs = spark.sparkContext.statusTracker()
    counted = []
    for levels in (5, 60):
        group = f"levels-{levels}"
        spark.sparkContext.setJobGroup(group, group)
        got = {r.page_id: r.verdict for r in parted(levels, spark).collect()}
        counted.append(len(jobs.getJobIdsForGroup(group)))
        assert got == {k: "block" if k % 2 else "allow" for k in range(60)}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counted[1] <= counted[0] + 4


class PlainModel:
    """Follow-the-regularised-leader over dictionaries."""

    def __init__(self):
        self.z, self.n = Counter(), Counter()

    def weight(self, i):
        z = self.z[i]
        return 0.0 if abs(z) <= 8.0 else -(z - math.copysign(8.0, z)) / ((1.0 + math.sqrt(self.n[i])) / 1.0 + 0.1)

    def p(self, x):
        s = sum(np.float32(self.weight(i)) * v for i, v in x.items())
        return 1 / (1 + math.exp(-min(max(s, -30), 30)))

    def fit(self, rows, y):
        for _ in range(PASSES):
            for x, label in zip(rows, y):
                p = 1 / (1 + math.exp(-min(max(sum(self.weight(i) * v for i, v in x.items()), -30), 30)))
                for i, v in x.items():
                    w, g = self.weight(i), (p - label) * v
                    n = self.n[i]
                    self.z[i] += g - (math.sqrt(n + g * g) - math.sqrt(n)) / 1.0 * w
                    self.n[i] = n + g * g
        return self


def plain_chain(rows, marks, folds, new, inside=False):
    """Probabilities of two categories for ``new``; with ``inside``, the links are learned from predictions on the learned rows themselves."""
    features = TermFeatures()
    terms = lambda t: {int(i): 1.0 for i in features(t)[0]} | {"one": 1.0}
    given, asked = [terms(t) for t in rows], [terms(t) for t in new]
    out = []
    for k in range(2):
        y = [m[k] for m in marks]
        whole = PlainModel().fit(given, y)
        p = [whole.p(x) for x in asked]
        if inside:
            links = [whole.p(x) for x in given]
        else:
            parts = [PlainModel().fit([x for x, f in zip(given, folds) if f != g], [v for v, f in zip(y, folds) if f != g]) for g in range(FOLDS)]
            links = [parts[f].p(x) for x, f in zip(given, folds)]
        given = [x | {DIM + k: e} for x, e in zip(given, links)]
        asked = [x | {DIM + k: e} for x, e in zip(asked, p)]
        out.append(p)
    return out


def test_chain_against_a_plain_one_with_out_of_fold_links(spark):
    r = random.Random(6)
    rows = []
    for k in range(260):
        low = r.random() < 0.4
        words = [f"w{r.randrange(60)}" for _ in range(6)] + ["junk"] * (low and r.random() < 0.8) + ["idiot"] * (low and r.random() < 0.5)
        rows.append((k, " ".join(words), int(low), int("idiot" in words or (low and r.random() < 0.4))))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, a, b) for i, _, a, b in rows], "doc_id long, a int, b int")
    order = spark.createDataFrame(rows, "id long, text string, a int, b int").filter(F.crc32(F.col("id").cast("string").cast("binary")) % 3 != 1)
    learned = order.orderBy(F.xxhash64("id"), "id").select("text", "a", "b", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).alias("f")).collect()
    new = [t for _, t, _, _ in rows]
    got = {x.doc_id: x for x in toxicity(docs, labels, ["a", "b"]).collect()}
    args = [x.text for x in learned], [(x.a, x.b) for x in learned], [x.f for x in learned], new
    want = plain_chain(*args)
    assert max(abs(got[i].p_a - p) for i, p in zip(range(260), want[0])) < 1e-4 and max(abs(got[i].p_b - p) for i, p in zip(range(260), want[1])) < 1e-4
    wrong = plain_chain(*args, inside=True)
    assert max(abs(a - b) for a, b in zip(want[1], wrong[1])) > 1e-3  # links from within the folds would show
    chain = fit_chain(docs, labels, ["a", "b"])
    assert all(got[i].b == int(got[i].p_b >= chain[1].threshold) for i in range(260))


def test_threshold_against_every_cut():
    r = random.Random(1)
    for _ in range(200):
        p = np.array([r.choice([0.1, 0.2, 0.5, r.random()]) for _ in range(r.randint(1, 30))])
        y = np.array([r.randint(0, 1) for _ in p])
        f1 = lambda t: 2 * ((p >= t) & (y == 1)).sum() / ((p >= t).sum() + y.sum())  # noqa: B023, E731
        t = best_threshold(p, y)
        assert t == 0.5 if y.sum() in (0, len(y)) else abs(f1(t) - max(f1(x) for x in p)) < 1e-12


def test_workers_get_texts_in_small_batches(spark, monkeypatch, tmp_path):
    rows = [(k, f"w{k} " * 30_000, k % 2) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").coalesce(1)
    frame, given = type(docs), type(docs).mapInArrow

    def noted(self, run, *rest):
        def watched(batches):
            def each():
                for b in batches:
                    with open(tmp_path / "sizes", "a") as f:
                        f.write(f"{b.nbytes}\n")
                    yield b

            return run(each())

        return given(self, watched, *rest)

    monkeypatch.setattr(frame, "mapInArrow", noted)
    monkeypatch.setattr(_store, "BATCH_BYTES", 1 << 20)
    spark.conf.unset(_store._BATCH)
    try:
        weights = fit_quality(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
        keep_good(docs, weights).count()
        keep_one_of_each(docs).count()
        drop_leaks(docs, spark.createDataFrame([(1, "an item")], "item_id long, text string")).count()
        sizes = [int(x) for x in (tmp_path / "sizes").read_text().split()]
        assert sum(sizes) > 25_000_000 and max(sizes) < 1_400_000
        spark.conf.set(_store._BATCH, "300000")
        keep_good(docs, weights).count()
        assert spark.conf.get(_store._BATCH) == "300000"
    finally:
        spark.conf.unset(_store._BATCH)


def test_fit_equals_passes_over_a_held_sample(spark):
    r = random.Random(5)
    rows = [(k, " ".join(f"{'Ab'[k % 2]}{r.randrange(60)}" for _ in range(r.randrange(0, 50))), k % 2) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    sample = labelled_sample(docs, docs, 100, 10**6, "doc_id", "text", ["quality"]).collect()
    features, model = QualityFeatures(), Ftrl(alpha=0.5, l1=0.1, l2=0.1)
    for row in [*sample] * quality.PASSES:
        model.learn(*summed(*features(row.text)), row.quality)
    assert len(sample) == 100 and np.array_equal(fit_quality(docs, docs, sample=100), model.weights())
