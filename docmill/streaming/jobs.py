"""Job states kept by key in the state store of a stream, and the same rules over a table.

Events are (key, n, kind, at, error): ``submitted`` (n is 0), ``started``, ``succeeded`` and ``failed`` for attempt n. Only attempts up
to ``max_retries`` + 1 count. A job is ``done`` from its first success on, whatever comes later; else the last attempt that is known decides:
``failed`` when that has failed, ``running`` when it has started, ``pending`` before any. A failed job without attempts left is
``exhausted``. Nothing but least and greatest attempts is kept of a key, so the order of events, and events that come twice, change nothing,
and a key may have any number of events.

With ``lease``, an attempt that neither succeeds nor fails within so many seconds of its start fails as lost. With ``backoff``, a failed job
that has attempts left becomes ``pending`` after so many seconds times its attempts. Both are timers in event time, which the state store
keeps over restarts.

Without timers a job is one streaming aggregate of native functions. It also keeps the time of the micro-batch that first brought each of these
attempts, so a job whose state, attempts and error are as before gives no row. With timers a processor in Python handles each key.

Every change of a job is a row with the job's ``version``, ascending: the processor counts the changes of the job, the aggregate's are the numbers of
the micro-batches. A restart from the checkpoint may write a micro-batch again, with the
same versions; the view of the latest version of each key is then the same. A checkpoint goes on only in the way it was begun, with timers or without.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

#: What is kept of a key.
STATE = "submitted boolean, started int, started_at long, failed int, failed_at long, won int, error string, waiting boolean, timer long, version int, state string"
CHANGE = "key string, state string, attempts int, error string, exhausted boolean, version int"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KINDS = ("submitted", "started", "succeeded", "failed")
# the process that prepares the operator on the driver does not look where this module stands
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def state_of(s: dict, limit: int) -> tuple[str, int, str | None, bool]:
    """(state, attempts, error, exhausted) of what is kept of a key."""
    last = max(s["started"], s["failed"])
    if s["won"]:
        return "done", s["won"], None, False
    if s["failed"] and s["failed"] == last:
        waits = s["waiting"] and last < limit
        return "pending" if waits else "failed", last, s["error"], last >= limit
    return ("running" if s["started"] else "pending"), last, None, False


class JobProcessor(StatefulProcessor):
    def __init__(self, max_retries: int, lease: float | None, backoff: float | None) -> None:
        self.limit, self.lease, self.backoff = max_retries + 1, lease, backoff

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("job", STATE)

    def _load(self) -> dict:
        names = [f.split()[0] for f in STATE.split(", ")]
        found = self.kept.get() if self.kept.exists() else None
        return dict(zip(names, found)) if found else {"submitted": False, "started": 0, "started_at": 0, "failed": 0, "failed_at": 0, "won": 0, "error": None, "waiting": False, "timer": 0, "version": 0, "state": ""}

    def _turn(self, key: str, s: dict) -> Iterator[Row]:
        """Store ``s`` with the timer that it needs; a row if the job has changed."""
        state, attempts, error, exhausted = state_of(s, self.limit)
        due = 0
        if state == "running" and self.lease is not None:
            due = s["started_at"] + int(self.lease * 1000)
        if state == "failed" and not exhausted and self.backoff is not None:
            due = s["failed_at"] + int(self.backoff * 1000 * attempts)
        if due != s["timer"]:
            if s["timer"]:
                self.handle.deleteTimer(s["timer"])
            if due:
                self.handle.registerTimer(due)
        now = f"{state}:{attempts}"
        changed = now != s["state"]
        s |= {"timer": due, "state": now, "version": s["version"] + changed}
        self.kept.update(tuple(s.values()))
        if changed:
            yield Row(key=key, state=state, attempts=attempts, error=error, exhausted=exhausted, version=s["version"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s = self._load()
        for r in rows:
            n, at = r["n"], r["at_ms"]
            if r["kind"] == "submitted":
                s["submitted"] = True
            elif n is None or not 0 < n <= self.limit:
                continue
            elif r["kind"] == "succeeded":
                s["won"] = min(s["won"] or n, n)
            elif r["kind"] == "started" and n > s["started"]:
                s |= {"started": n, "started_at": at, "waiting": False}
            elif r["kind"] == "failed" and (n, r["error"] or "") > (s["failed"], s["error"] or ""):
                s |= {"failed": n, "failed_at": at, "error": r["error"], "waiting": s["waiting"] and n == s["failed"]}
        yield from self._turn(key[0], s)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self._load()
        due, s["timer"] = s["timer"], 0
        state, attempts, _, exhausted = state_of(s, self.limit)
        if due and state == "running":
            s |= {"failed": attempts, "failed_at": due, "error": "lost: no outcome within the lease"}
        elif due and state == "failed" and not exhausted:
            s["waiting"] = True
        yield from self._turn(key[0], s)

    def close(self) -> None:
        pass


def job_changes(events: DataFrame, max_retries: int = 2, lease: float | None = None, backoff: float | None = None, late: str = "0 seconds") -> DataFrame:
    """The changes of jobs, a stream, from a stream of events (key, n, kind, at, error); with timers it needs the RocksDB state store.

    Without timers the rows have no ``version`` yet; ``keep_jobs`` puts the number of the micro-batch, from 1.
    """
    if lease is None and backoff is None:
        # the same time for all rows of a micro-batch, also when it is run again
        now = F.unix_micros(F.current_timestamp())
        # the sorts before the aggregate hold a share of each file's part only, and a key of many events stays in as many tasks as read it
        events = events.select("key", "n", "kind", "error", F.spark_partition_id().alias("split")).repartition("key", "split")
        return _folded(events, max_retries, now).filter(F.col("since") == now).drop("since")
    known = events.filter(F.col("kind").isin(*KINDS) & F.col("key").isNotNull()).withWatermark("at", late)
    slim = known.select(F.col("key").cast("string").alias("key"), "n", "kind", F.unix_millis("at").alias("at_ms"), "error", "at")
    return slim.groupBy("key").transformWithState(JobProcessor(max_retries, lease, backoff), CHANGE, "Update", "EventTime")


def _folded(events: DataFrame, max_retries: int, time: Column) -> DataFrame:
    """(key, state, attempts, error, exhausted, since) of a table or stream of events that came at ``time``, long: since when the rest holds."""
    limit = max_retries + 1
    known = events.filter(F.col("kind").isin(*KINDS) & F.col("key").isNotNull()).select(F.col("key").cast("string").alias("key"), "n", "kind", "error", time.alias("t"))
    counts = F.col("n").between(1, limit)
    of = lambda kind, *kept: F.when(counts & (F.col("kind") == kind), F.struct("n", *kept))
    early = (-F.col("t")).alias("t")  # the first of the times at which a greatest one came
    kept = known.groupBy("key").agg(
        F.min("t").alias("known"),
        F.min(of("succeeded", "t")).alias("won"),
        F.max(of("started", early)).alias("started"),
        F.max(of("failed", F.coalesce("error", F.lit("")).alias("e"), "error", early)).alias("f"),
    )
    last = F.greatest(F.coalesce("started.n", F.lit(0)), F.coalesce("f.n", F.lit(0)))
    won, lost = F.col("won").isNotNull(), F.col("won").isNull() & F.coalesce(F.col("f.n") == last, F.lit(False))
    chosen = lambda done, failed, running, pending: F.when(won, done).when(lost, failed).when(F.col("started").isNotNull(), running).otherwise(pending)
    return kept.select(
        "key",
        chosen("done", "failed", "running", "pending").alias("state"),
        F.coalesce("won.n", last).cast("int").alias("attempts"),
        F.when(lost, F.col("f.error")).alias("error"),
        (lost & (last >= limit)).alias("exhausted"),
        chosen(F.col("won.t"), -F.col("f.t"), -F.col("started.t"), F.col("known")).alias("since"),
    )


def job_table(events: DataFrame, max_retries: int = 2) -> DataFrame:
    """(key, state, attempts, error, exhausted) of a table of events by the same rules, without timers: one grouped aggregate."""
    return _folded(events, max_retries, F.lit(0).cast("long")).drop("since")


def keep_jobs(changes: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the changes to a table below ``path``, a folder for each micro-batch, which a repeated one replaces."""

    def write(batch: DataFrame, number: int) -> None:
        if "version" not in batch.columns:
            batch = batch.withColumn("version", F.lit(number + 1).cast("int"))
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    writer = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    conf, name = changes.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKS)  # a query takes the setting that holds when it starts
    try:
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        conf.set(name, before) if before else conf.unset(name)


def latest_jobs(spark: SparkSession, path: str) -> DataFrame:
    """(key, state, attempts, error, exhausted): the last version of each job below ``path``."""
    rows = spark.read.schema(f"{CHANGE}, batch long").parquet(path)
    return rows.groupBy("key").agg(F.max_by(F.struct("state", "attempts", "error", "exhausted"), "version").alias("r")).select("key", "r.*")
