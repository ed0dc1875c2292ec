"""Carries, runs and ranks over cells against plain versions, with hot and null keys, ties and borders."""

import math
import random

import pytest
from pyspark.sql import functions as F

from docmill.operators.carry import carried, nearest_rank, runs
from docmill.operators.reports import asof_context


@pytest.mark.parametrize("before", [False, True])
def test_carried(spark, before):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2, None]), r.choice([None, *range(-50, 400)]), k, r.choice([None, None, k]), "x") for k in range(500)]
    df = spark.createDataFrame(rows, "key int, t int, seq int, v int, out int".replace("out int", "other string"))
    got = {x.seq: x.out for x in carried(df, "key", ["t", "seq"], F.col("v"), "out", 10, before).collect()}
    order = lambda x: (x[1] is not None, x[1] or 0, x[2])
    for row in rows:
        past = [x for x in rows if x[0] == row[0] and x[3] is not None and (order(x) < order(row) or (not before and x is row))]
        assert got[row[2]] == (max(past, key=order)[3] if past else None), row
    assert len(got) == 500


def test_contexts_in_time(spark):
    samples = spark.createDataFrame([(1, k, k * 1000) for k in range(20)] + [(2, 99, 5)], "key int, id int, s long").withColumn("ts", F.timestamp_seconds("s"))
    contexts = spark.createDataFrame([(1, 3000, "a"), (1, 9500, "b"), (1, 9999, None), (3, 0, "z")], "key int, s long, context string").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    got = {r.id: r.context for r in asof_context(samples, contexts, "key", "ts", "context").collect()}
    assert got == {k: None if k < 3 else "a" if k < 10 else "b" for k in range(20)} | {99: None}


def test_runs(spark):
    r = random.Random(2)
    keys = {1: set(range(0, 100)), 2: {p for p in range(-40, 300) if r.random() < 0.9}, None: {p for p in range(200) if r.random() < 0.5}, 4: {7, 8, 15, 16, 23}}
    df = spark.createDataFrame([(k, p) for k, ps in keys.items() for p in [*ps, *list(ps)[:5]]], "key int, pos int")
    got = sorted((tuple(x) for x in runs(df, "key", "pos", 8).collect()), key=str)
    want = [(k, p, next(q for q in range(p, 10_000) if q not in ps)) for k, ps in keys.items() for p in ps if p - 1 not in ps]
    assert got == sorted(want, key=str)


def test_nearest_rank(spark):
    r = random.Random(3)
    groups = {"a": [r.random() for _ in range(300)], "b": [5.0] * 200 + [1e18], "c": [1.0], "d": [None, None], None: [r.choice([1.0, 2.0, -3.0, math.inf, -math.inf]) for _ in range(50)], "e": [math.nan, 1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "g string, v double")
    for share in (0.01, 0.5, 0.95, 1.0):
        got = {x.g: x.rank_value for x in nearest_rank(df, ["g"], "v", share, 7).collect()}
        for g, vs in groups.items():
            vs = sorted((v for v in vs if v is not None), key=lambda v: (math.isnan(v), v))
            if not vs:
                assert g not in got
                continue
            want = vs[max(1, math.ceil(len(vs) * share)) - 1]
            assert got[g] == want or math.isnan(want) and math.isnan(got[g]), (g, share)
    assert nearest_rank(df, [], "v", 0.5).count() == 1 and nearest_rank(df.limit(0), ["g"], "v", 0.5).count() == 0
