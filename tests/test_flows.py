"""Sources, streaming and model calls end to end."""

from pyspark.sql import functions as F

from docmill import sources, streaming
from docmill.operators import summarize


def test_sources(spark, tmp_path):
    (tmp_path / "b.txt").write_text("dos\nlíneas", "utf-8")
    (tmp_path / "e.txt").write_bytes(b"a\xffb")
    (tmp_path / "z.txt").write_bytes(b"")
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "c.pdf").write_bytes(b"nothing")
    (tmp_path / "report.json").write_text("{}")
    (tmp_path / "s.json").write_text('{"doc_id": "s", "plantilla": "C", "secciones": {"titulo": "t"}}')
    assert sorted(map(tuple, sources.text_documents(spark, str(tmp_path)).collect())) == [("b", "dos\nlíneas"), ("e", "a\ufffdb")]
    screened = {r.doc_id: r.status for r in sources.screen_uploads(sources.pdf_files(spark, str(tmp_path)), 9_000).collect()}
    assert screened == {"a": 202, "c": 415}
    assert [(r.doc_id, r.abstracts_origem) for r in sources.read_summaries(spark, str(tmp_path)).collect()] == [("s", [])]
    info = spark.createDataFrame([(1, "Title: A: b\nPages: x\nAuthor:  \nCreationDate: Tue 2012")], "id int, info string")
    got = sources.pdf_info(info, "id", "info").first()
    assert (got.title, got.pages, got.author, got.creation_date) == ("A: b", None, None, "Tue 2012")


def test_inbox_runs_once_over_new_files(spark, tmp_path):
    box, seen = tmp_path / "in", []
    box.mkdir()
    (box / "a.pdf").write_bytes(b"%PDF-1")
    work = lambda df, _: seen.extend(r.length for r in df.select("length").collect())
    streaming.run_once(streaming.inbox(spark, str(box)), work, str(tmp_path / "cp"))
    (box / "b.pdf").write_bytes(b"%PDF-12")
    streaming.run_once(streaming.inbox(spark, str(box)), work, str(tmp_path / "cp"))
    assert seen == [6, 7]


def test_windows_of_a_stream_equal_those_of_a_table(spark, tmp_path):
    rows = spark.range(200).select(F.timestamp_seconds(F.col("id") * 300).alias("ts"), (F.col("id") % 3).alias("kind"), F.col("id").alias("v"))
    rows.write.parquet(str(tmp_path / "e"))
    stream = streaming.events_by_window(streaming.event_stream(spark, str(tmp_path / "e"), rows.schema), "ts", "kind", "v")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, streaming.events_by_window(rows, "ts", "kind", "v").collect()))


def test_blocks_are_summarised_once_each_and_once_together(spark):
    docs = spark.createDataFrame([(1, "uno dos\n\n" * 40, 1), (2, "corto", 1)], "doc_id int, text string, pages int")
    got = {r.doc_id: r for r in summarize.summarize(docs, lambda: summarize.first_words, "blocks", 100).collect()}
    n = summarize.plan_parts(docs, "blocks", 100).filter("doc_id = 1").count()
    assert got[1].calls == n + 1 and got[2].calls == 1 and got[2].sections["titulo"].endswith("corto")

    def broken():
        def fail(*_):
            raise ValueError("no")

        return fail

    assert {r.error for r in summarize.summarize(docs, broken).collect()} == {"ValueError: no"}
