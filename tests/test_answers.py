"""Answers of a model: paid for once, whatever is lost; documents that share an id, or have none."""

import json
import os
import subprocess
import sys
import textwrap
import uuid

from pyspark.sql import functions as F

from conftest import ROOT
from docmill import Engine, blank_pages, summary_records
from docmill.operators import summarize
from docmill.operators.answers import Answers, question


def counting(folder):
    """Factory of a summariser that leaves a file for each call."""

    def factory():
        def call(text, lang, template):
            open(f"{folder}/{uuid.uuid4()}", "w").close()
            if "mal" in text:
                raise ValueError("no")
            return {"titulo": text[:30], "terminos": "- b\n- a"}

        return call

    return factory


def test_equal_questions_are_asked_once(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    rows = [(1, "uno"), (2, "uno"), (None, "dos"), (3, "mal"), (4, None), (1, "uno")]
    docs = spark.createDataFrame(rows, "n int, text string").withColumn("lang", F.lit("es")).withColumn("template", F.lit("C"))
    answers = Answers(spark, str(tmp_path / "a"), "m")
    got = sorted(((r.n or 0, r.error, r.attempts, r.sections and r.sections["titulo"]) for r in summarize.call_model(docs, counting(folder), 1, answers).collect()), key=str)
    assert got == sorted([(1, None, 1, "uno"), (1, None, 1, "uno"), (2, None, 1, "uno"), (0, None, 1, "dos"), (3, "ValueError: no", 2, None), (4, None, 0, None)], key=str)
    assert len(list(folder.iterdir())) == 4
    again = summarize.call_model(docs, counting(folder), 0, answers).collect()
    assert len(list(folder.iterdir())) == 5 and {r.attempts for r in again} == {0, 1}  # only the one that failed
    assert summarize.call_model(docs, counting(folder), 0, Answers(spark, str(tmp_path / "a"), "other")).count() == 6 and len(list(folder.iterdir())) == 8
    answers.tidy()
    assert not (tmp_path / "a/journal").exists() and answers.known().count() == 4


def test_questions_differ_where_a_part_does(spark):
    rows = [("a", "b", "c"), ("ab", "", "c"), ("a", "bc", ""), ("a", "b", ""), ("", "ab", "c"), ("1:a", "b", "c"), ("a", None, None), (None, "b", "c")]
    df = spark.createDataFrame(rows, "text string, lang string, template string")
    keys = [r[0] for r in df.select(question("m", F.col("text"), F.col("lang"), F.col("template"))).collect()]
    assert keys[-1] is None and len(set(keys)) == len(rows)


def test_documents_without_an_id_or_with_a_common_one(spark):
    rows = [("x", "alfa beta gamma", 1), ("x", "delta epsilon", 1), (None, "zeta", 1), (None, "eta", 1), ("y", "theta", 1), ("y", "theta", 1), ("z", None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, pages int")
    got = sorted((str(r.doc_id), r.secciones["titulo"]) for r in summary_records(docs, lambda: summarize.first_words).collect())
    assert got == sorted((str(i), f"[pt] {t or ''}") for i, t, _ in rows)
    long = spark.createDataFrame([(None, "uno dos\n\n" * 40, 1), (None, "tres\n\n" * 60, 1), ("a", "uno dos\n\n" * 40, 1)], "doc_id string, text string, pages int")
    parts = summarize.plan_parts(long, "blocks", 100)
    assert {r.calls for r in summary_records(long, lambda: summarize.first_words, "blocks", 100).collect()} == {r["count"] + 1 for r in parts.groupBy("row_key").count().collect()}


def test_the_engine_keeps_rows_apart_and_sends_equal_ones_once(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    engine = Engine(spark, str(tmp_path / "o"), counting(folder), max_retries=0)
    docs = spark.createDataFrame([("x", "uno", 1), ("x", "uno", 1), ("x", "dos", 1), (None, "tres", 1), ("w", "uno", 1)], "doc_id string, text string, pages int")
    engine.run(docs)
    assert sorted((str(r.doc_id), r.secciones["titulo"]) for r in engine.log().collect()) == [("None", "tres"), ("w", "uno"), ("x", "dos"), ("x", "uno")]
    assert len(list(folder.iterdir())) == 3 and not (tmp_path / "o/answers/journal").exists()
    engine.run(docs)
    assert engine.log().count() == 4 and len(list(folder.iterdir())) == 3


def test_what_was_given_to_the_model_stands_in_the_record(spark, tmp_path):
    chapter = "Capítulo\n\n{}\n\nTITULO DO CAPITULO\n\n" + "linha de texto\n\n" * 12
    docs = spark.createDataFrame([("h", chapter.format(1) + chapter.format(2), 1), ("s", "corto", 1)], "doc_id string, text string, pages int")
    fed = lambda **k: {r.doc_id: r.fed for r in summary_records(docs, lambda: summarize.first_words, max_chars=100, **k).collect()}
    got = fed(strategy="hierarchical")
    assert (got["h"].strategy, got["h"].parts, got["h"].truncated) == ("hierarchical", ["cap_1", "cap_2"], False) and (got["s"].strategy, got["s"].parts, got["s"].chars) == ("full", ["completo"], 5)
    got = fed(strategy="blocks")
    n = summarize.plan_parts(docs, "blocks", 100).filter("doc_id = 'h'").count()
    assert (got["h"].strategy, got["h"].parts, got["h"].chars) == ("blocks", [f"bloque_{k + 1}" for k in range(n)], len(docs.first().text))
    got = fed(strategy="excerpt")
    assert got["h"].truncated and got["h"].chars <= 100 and got["h"].strategy == "divulgacion"
    forced = summary_records(docs, lambda: summarize.first_words, lang="en", doc_type="articulo", max_chars=100).collect()
    assert {(r.idioma_principal, r.tipo_documento, r.plantilla) for r in forced} == {("en", "articulo", "A")} and {r.fed.strategy for r in forced} == {"articulo", "full"}
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words, max_chars=100, lang="es")
    engine.run(docs)
    record = next(json.loads(r) for r in engine.records().toJSON().collect() if '"h"' in r)
    assert record["idioma_principal"] == "es" and record["meta"]["excerpt_strategy"] == "divulgacion" and record["meta"]["excerpt_truncated"] is True


def test_no_upload_is_lost(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "large.pdf").write_bytes(b"%PDF-" + b"x" * 2000)
    (box / "good.pdf").write_bytes(b"%PDF-1")
    (box / "odd.pdf").write_bytes(b"text")
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    for _ in range(2):
        engine.watch(str(box), blank_pages, str(tmp_path / "c"), 1000)
    found = {r.doc_id.split("-")[0]: (r.state, r.error) for r in engine.jobs().collect()}
    assert found == {"large": ("rejected", "larger than 1000 bytes: 2005"), "odd": ("rejected", "no PDF"), "good": ("done", None)} and engine.jobs().count() == 3
    assert {r.state: r.n for r in engine.health().collect()} == {"rejected": 2, "done": 1}


def test_one_id_has_one_transcript(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    found = spark.createDataFrame([("p", b"%PDF-1", "s1"), ("p", b"%PDF-2", "s2")], "doc_id string, content binary, pdf_sha256 string")
    engine.pdfs(found, blank_pages)
    assert [r.pdf_sha256 for r in engine.transcripts().collect()] == ["s2"] and engine.log().count() == 1


def test_a_lost_task_pays_for_nothing_twice(tmp_path):
    """The Python worker ends itself after its last call; the task is run again and finds the answers of its first attempt."""
    (tmp_path / "calls").mkdir()
    script = f"""
        import os, uuid
        from pyspark.sql import SparkSession
        from docmill.operators import summarize
        from docmill.operators.answers import Answers
        spark = SparkSession.builder.master("local[2,3]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        def factory():
            n = 0
            def call(text, lang, template):
                nonlocal n
                n += 1
                open(f"{tmp_path}/calls/{{uuid.uuid4()}}", "w").close()
                return {{"titulo": text}}
            class Lost:
                def __call__(self, *a):
                    nonlocal n
                    if n >= 3 and not os.path.exists("{tmp_path}/lost"):
                        open("{tmp_path}/lost", "w").close()
                        os._exit(1)
                    return call(*a)
            return Lost()
        docs = spark.range(12).selectExpr("concat('texto ', id) as text", "'es' as lang", "'C' as template").repartition(2)
        rows = summarize.call_model(docs, factory, 0, Answers(spark, "{tmp_path}/a")).collect()
        assert len(rows) == 12 and all(r.sections["titulo"].startswith("texto") and r.attempts == 1 for r in rows)
        assert os.path.exists("{tmp_path}/lost")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], cwd=ROOT, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ROOT}, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(os.listdir(tmp_path / "calls")) == 12
