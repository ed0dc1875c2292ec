"""Phases of runs as intervals, and the samples taken within each: one expression for streams and tables.

``intervals`` closes the start of a span by its end, if that comes within ``longest`` seconds; else the span stays open, and counts as
that long. ``samples_within`` gives each interval the samples of its run from its start up to before its end. Both are outer joins: an
interval without an end or without a sample is a row with nulls. In a stream such a row comes once the watermark shows that
nothing can follow, and rows behind the watermark are dropped and counted in the query's progress.

Spans are joined by their own names. Samples meet intervals by run and by cells of ``longest`` seconds, of which an interval touches two, so
a run with very many samples is spread over its cells and no run is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _after(ts: Column, seconds: float) -> Column:
    return ts + F.expr(f"interval {seconds} seconds")  # a literal, which a watermark can reason with


def _bare(ts: str) -> Column:
    """The time without its watermark: a stream may have one event time."""
    return F.timestamp_micros(F.unix_micros(ts)).alias(ts)


def _marked(df: DataFrame, ts: str, late: str) -> DataFrame:
    return df.withWatermark(ts, late) if df.isStreaming else df


def intervals(starts: DataFrame, ends: DataFrame, longest: float = 3600.0, late: str = "10 minutes") -> DataFrame:
    """(span, run_id, phase, start, end) from starts (span, run_id, phase, start) and ends (span, end); null ends for spans that stay open.

    Spans have one start and one end; an end before its start, or more than ``longest`` after it, closes nothing.
    """
    a = _marked(starts.select("span", "run_id", "phase", F.col("start").cast("timestamp").alias("start")), "start", late)
    b = _marked(ends.select(F.col("span").alias("__span"), F.col("end").cast("timestamp").alias("end")), "end", late)
    joined = a.join(b, (F.col("span") == F.col("__span")) & (F.col("end") >= F.col("start")) & (F.col("end") <= _after(F.col("start"), longest)), "left_outer")
    return joined.select("span", "run_id", "phase", "start", _bare("end"))


def samples_within(found: DataFrame, samples: DataFrame, longest: float = 3600.0, late: str = "10 minutes") -> DataFrame:
    """(span, run_id, phase, start, end, at, value): the samples (run_id, at, value) of each interval; null at and value where a cell of it has none.

    An interval has a row for each sample, and at least one for each of its cells; ``summed`` counts them together.
    """
    cell = lambda ts: F.floor(F.unix_micros(ts) / F.lit(int(longest * 1e6)))
    until = F.coalesce(F.col("end"), _after(F.col("start"), longest))
    cut = found.withColumn("__cell", F.explode(F.sequence(cell(F.col("start")), cell(until))))
    s = _marked(samples.select(F.col("run_id").alias("__run"), F.col("at").cast("timestamp").alias("at"), "value"), "at", late).withColumn("__in", cell(F.col("at")))
    near = (F.col("at") >= F.col("start")) & (F.col("at") <= _after(F.col("start"), longest))
    joined = cut.join(s, (F.col("run_id") == F.col("__run")) & (F.col("__cell") == F.col("__in")) & near & (F.col("at") < until), "left_outer")
    return joined.select("span", "run_id", "phase", "start", "end", _bare("at"), "value")


def summed(rows: DataFrame) -> DataFrame:
    """(span, run_id, phase, start, end, n, low, high, mean) of the rows that ``samples_within`` gave, a table."""
    return rows.groupBy("span", "run_id", "phase", "start", "end").agg(F.count("at").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.avg("value"), 6).alias("mean"))
