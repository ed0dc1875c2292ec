"""Job states in the state store of a stream: against the table, against a plain queue, over restarts and with timers."""

import random

from pyspark.sql import functions as F

from docmill.streaming import job_changes, job_table, keep_jobs, latest_jobs

EVENT = "key string, n int, kind string, at timestamp, error string"


def plain_queue(events, max_retries):
    """States of a queue that looks at one job's events again whenever one comes."""
    out = {}
    for key in {e[0] for e in events if e[0] is not None}:
        own = [e for e in events if e[0] == key and e[2] in ("submitted", "started", "succeeded", "failed")]
        if not own:
            continue
        own = [e for e in own if e[1] is not None and 0 < e[1] <= max_retries + 1]
        won = [e[1] for e in own if e[2] == "succeeded"]
        failed = [(e[1], e[4] or "") for e in own if e[2] == "failed"]
        started = [e[1] for e in own if e[2] == "started"]
        last = max(started + [n for n, _ in failed], default=0)
        if won:
            out[key] = ("done", min(won), None, False)
        elif failed and max(failed)[0] == last:
            out[key] = ("failed", last, max(failed)[1], last == max_retries + 1)
        else:
            out[key] = ("running" if started else "pending", last, None, False)
    return out


def written(spark, events, path):
    spark.createDataFrame(events, "key string, n int, kind string, at string, error string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(path)


def states(df):
    return {r.key: (r.state, r.attempts, r.error or None if r.state == "failed" else r.error, r.exhausted) for r in df.collect()}


def test_stream_table_and_queue_agree_and_a_restart_loses_and_repeats_nothing(spark, tmp_path):
    r = random.Random(1)
    kinds = ["submitted", "started", "started", "succeeded", "failed", "failed", "odd"]
    events = [(r.choice([None, *"abcdefghijkl"]), r.choice([None, 0, 1, 1, 2, 2, 3, 3, 4, 9]), r.choice(kinds), "2024-01-01 00:00:00", r.choice(["e1", "e2"])) for _ in range(90)]
    events += [("hot", 1, "started", "2024-01-01 00:00:00", None)] * 300 + [("hot", k % 4, "failed", "2024-01-01 00:00:00", "x") for k in range(300)]
    box, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    for k in range(3):
        written(spark, events[k::3], box)
        # a new query each time: what is known of a key comes from the checkpoint
        keep_jobs(job_changes(stream(spark, box)), out, check).awaitTermination()
        seen = [e for j in range(k + 1) for e in events[j::3]]
        want = plain_queue(seen, 2)
        assert states(latest_jobs(spark, out)) == want
        assert states(job_table(spark.read.schema(EVENT).parquet(box))) == want
    rows = spark.read.option("basePath", out).parquet(out)
    assert rows.groupBy("key", "version").count().filter("count > 1").isEmpty() and rows.agg(F.max("version")).first()[0] > 1
    last = rows.agg(F.max("batch")).first()[0]
    # the last micro-batch was written but its commit was lost: it is written again, and nothing else
    before = sorted(map(tuple, rows.select("key", "state", "version", "batch").collect()), key=str)
    (tmp_path / "check/commits" / str(last)).unlink()
    (tmp_path / "check/commits" / f".{last}.crc").unlink(missing_ok=True)
    keep_jobs(job_changes(stream(spark, box)), out, check).awaitTermination()
    rows = spark.read.option("basePath", out).parquet(out)
    assert sorted(map(tuple, rows.select("key", "state", "version", "batch").collect()), key=str) == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_timers_fail_lost_attempts_and_give_failed_jobs_back(spark, tmp_path):
    box, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    day = "2024-01-01 00:{}"
    steps = [
        [("lost", 1, "started", day.format("00:00"), None), ("again", 1, "started", day.format("00:00"), None), ("again", 1, "failed", day.format("00:10"), "e"), ("good", 1, "started", day.format("00:00"), None)],
        [("good", 1, "succeeded", day.format("00:40"), None), ("clock", 0, "submitted", day.format("05:00"), None)],
        [("clock", 1, "started", day.format("30:00"), None)],
        [("again", 2, "started", day.format("30:30"), None), ("again", 2, "failed", day.format("30:40"), "f"), ("again", 3, "failed", day.format("30:50"), "g")],
        [("clock", 1, "succeeded", day.format("59:00"), None)],
    ]
    seen = []
    for step in steps:
        written(spark, step, box)
        keep_jobs(job_changes(stream(spark, box), 2, lease=60, backoff=120), out, check).awaitTermination()
        seen.append(states(latest_jobs(spark, out)))
    assert seen[0] == {"lost": ("running", 1, None, False), "again": ("failed", 1, "e", False), "good": ("running", 1, None, False)}
    lost = "lost: no outcome within the lease"
    found = [s["lost"] for s in seen]
    assert ("failed", 1, lost, False) in found and found[-1] == ("pending", 1, lost, False)
    assert ("pending", 1, "e", False) in [s["again"] for s in seen] and seen[-1]["again"] == ("failed", 3, "g", True)
    assert seen[-1]["good"] == ("done", 1, None, False) and seen[-1]["clock"] == ("done", 1, None, False)
    rows = spark.read.option("basePath", out).parquet(out)
    assert rows.groupBy("key", "version").count().filter("count > 1").isEmpty()


def test_without_timers_no_key_is_handled_in_python_and_only_changes_are_written(spark, tmp_path):
    box, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    day = "2024-01-01 00:00:00"
    steps = [
        [("a", 0, "submitted", day, None), ("b", 2, "started", day, None), ("c", 1, "failed", day, "e1"), ("d", 1, "succeeded", day, None), ("e", 1, "failed", day, "w")],
        [("a", 0, "submitted", day, None), ("b", 1, "started", day, None), ("b", 1, "failed", day, "x"), ("c", 1, "failed", day, "e0"), ("d", 2, "failed", day, "x"), ("d", 1, "succeeded", day, None), ("e", 1, "failed", day, "w"), ("a", 9, "started", day, None)],
        [("a", 1, "started", day, None), ("b", 2, "failed", day, "y"), ("c", 1, "failed", day, "e2"), ("e", 3, "failed", day, "z")],
        [("d", 3, "started", day, None), ("e", 2, "succeeded", day, None), ("e", 3, "failed", day, "zz")],
    ]
    written(spark, steps[0], box)
    changes = job_changes(stream(spark, box))
    assert "TransformWithState" not in changes._jdf.queryExecution().analyzed().toString()
    for k, step in enumerate(steps):
        if k:
            written(spark, step, box)
        keep_jobs(job_changes(stream(spark, box)), out, check).awaitTermination()
        assert states(latest_jobs(spark, out)) == plain_queue([e for s in steps[: k + 1] for e in s], 2)
    rows = spark.read.option("basePath", out).parquet(out).orderBy("key", "version").collect()
    assert [(r.key, r.state, r.attempts, r.error, r.exhausted) for r in rows] == [
        *[("a", "pending", 0, None, False), ("a", "running", 1, None, False)],
        *[("b", "running", 2, None, False), ("b", "failed", 2, "y", False)],
        *[("c", "failed", 1, "e1", False), ("c", "failed", 1, "e2", False)],
        ("d", "done", 1, None, False),
        *[("e", "failed", 1, "w", False), ("e", "failed", 3, "z", True), ("e", "done", 2, None, False)],
    ]
