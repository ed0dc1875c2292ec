"""Phase intervals and their samples: streams against a table and a plain version, with late rows and rows on timeout."""

import random

from pyspark.sql import functions as F

from docmill.streaming import intervals, samples_within, summed

SCHEMA = "kind string, span long, run_id long, phase string, ts timestamp, value double"


def cut(e):
    return (
        e.filter("kind = 'start'").select("span", "run_id", "phase", F.col("ts").alias("start")),
        e.filter("kind = 'end'").select("span", F.col("ts").alias("end")),
        e.filter("kind = 'sample'").select("run_id", F.col("ts").alias("at"), "value"),
    )


def plain(rows, longest):
    out = {}
    for kind, span, run, phase, t, _ in rows:
        if kind != "start":
            continue
        end = next((u for k, s, _, _, u, _ in rows if k == "end" and s == span and t <= u <= t + longest), None)
        seen = [v for k, _, r, _, u, v in rows if k == "sample" and r == run and t <= u < (t + longest if end is None else end)]
        out[span] = (run, phase, t, end, len(seen), min(seen, default=None), max(seen, default=None))
    return out



def test_streams_equal_the_table_and_late_rows_are_counted(spark, tmp_path):
    r = random.Random(7)
    rows = []
    for span in range(60):
        run, t = r.choice([1, 1, 1, 2, 3]), r.randrange(0, 20_000)
        rows.append(("start", span, run, f"p{span % 3}", t, None))
        if r.random() < 0.8:
            rows.append(("end", span, None, None, t + r.choice([0, 5, 300, 900, 1000, 1001, -5]), None))
    rows += [("sample", None, r.choice([1, 1, 2, 3, 4]), None, r.randrange(0, 21_000), float(k)) for k in range(600)]
    rows.sort(key=lambda x: x[4])
    late = [("start", 900, 1, "late", 10, None), ("sample", None, 1, None, 11, 5.0), ("end", 900, None, None, 12, None)]
    beat = [("start", 901, 9, "beat", 90_000, None), ("end", 902, None, None, 90_000, None), ("sample", None, 9, None, 95_000, 0.0)]
    last = [("start", 903, 9, "beat", 190_000, None), ("end", 904, None, None, 190_000, None), ("sample", None, 9, None, 195_000, 0.0)]
    box = str(tmp_path / "in")
    frame = lambda some: spark.createDataFrame([(k, s, n, p, t, v) for k, s, n, p, t, v in some], "kind string, span long, run_id long, phase string, t long, value double").select("kind", "span", "run_id", "phase", F.timestamp_seconds("t").alias("ts"), "value")
    third = len(rows) // 3
    dropped, n_dropped = str(tmp_path / "out"), 0
    for part in (rows[:third], rows[third : 2 * third], rows[2 * third :], beat, late, last):
        frame(part).coalesce(1).write.mode("append").parquet(box)
        stream = spark.readStream.schema(SCHEMA).parquet(box)
        a, b, s = cut(stream)
        q = samples_within(intervals(a, b, 1000, "100 seconds"), s, 1000, "100 seconds").writeStream.format("parquet").option("path", dropped).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        q.awaitTermination()
        n_dropped += sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
    keep = lambda df: {x.span: (x.run_id, x.phase, x.s, x.e, x.n, x.low, x.high) for x in df.select("span", "run_id", "phase", F.unix_seconds("start").alias("s"), F.unix_seconds("end").alias("e"), "n", "low", "high").collect() if x.span < 900}
    want = plain(rows, 1000)
    a, b, s = cut(frame(rows))
    assert keep(summed(samples_within(intervals(a, b, 1000), s, 1000))) == want
    found = summed(spark.read.parquet(dropped))
    assert keep(found) == want
    assert n_dropped >= 3 and found.filter("phase = 'late'").isEmpty()
