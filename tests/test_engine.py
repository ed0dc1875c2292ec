"""Runs over folders, their views, model services, and the rules on workers."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from docmill import Engine, blank_pages, sources
from docmill.__main__ import main
from docmill.operators import backends, environment, metadata, sections, summarize

ARTICLE = "RESUMO\n" + "estudo sobre a saúde da população que foi feito em muitos lugares. " * 4 + "\nPalavras-chave: a; b\n"


def test_texts_are_done_once(spark, tmp_path):
    box, out = tmp_path / "in", str(tmp_path / "out")
    box.mkdir()
    (box / "a.txt").write_text(ARTICLE, "utf-8")
    (box / "b.txt").write_text("\n", "utf-8")
    engine = Engine(spark, out, lambda: summarize.first_words)
    run = engine.texts(str(box))
    assert engine.progress(run, 2).first().asDict() == {"discovered": 2, "processed": 2, "completed": 2, "failed": 0, "remaining": 0, "status": "completed"}
    assert engine.progress(engine.texts(str(box)), 2).first().processed == 0
    a = engine.summary("a").first()
    assert (a.idioma_principal, a.attempts, a.idiomas_resumo_origem) == ("pt", 1, ["pt"]) and "RESUMO estudo" in a.secciones["titulo"]
    (box / "b.txt").write_text("texto nuevo", "utf-8")
    engine.texts(str(box))
    assert engine.summaries().count() == 2 and engine.jobs().count() == 3
    assert engine.health().first().asDict() == {"state": "done", "n": 3}
    assert engine.metrics().filter("level = 3").first().total == 2
    engine.export_records(str(tmp_path / "json"))
    assert sorted(r.doc_id for r in sources.read_summaries(spark, str(tmp_path / "json")).collect()) == ["a", "b"]
    engine.export_lilacs(str(tmp_path / "lilacs"))
    assert len(json.loads((tmp_path / "lilacs").read_text())) == 2
    info = spark.createDataFrame([("a", "Title: T")], "doc_id string, info string")
    engine.export_bibframe(str(tmp_path / "bib"), sources.pdf_info(info, "doc_id", "info"))
    assert any(json.loads(r.value)["work"][0].get("bf:title") == "T" for r in spark.read.text(str(tmp_path / "bib")).collect())


def test_failed_documents_are_recorded_and_not_tried_again(spark, tmp_path):
    def broken():
        def fail(*_):
            raise ValueError("no")

        return fail

    engine = Engine(spark, str(tmp_path / "o"), broken, max_retries=2)
    docs = spark.createDataFrame([("x", "texto", 1)], "doc_id string, text string, pages int")
    run = engine.run(docs)
    row = engine.jobs().first()
    assert (row.state, row.attempts, row.error) == ("failed", 3, "ValueError: no")
    assert engine.progress(run, 1).first().status == "completed_with_errors" and engine.summaries().isEmpty()
    engine.run(docs)
    assert engine.jobs().count() == 1


def test_pdfs_are_transcribed_once(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "p.pdf").write_bytes(b"%PDF-1 a")
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    engine.pdfs(sources.pdf_files(spark, str(box)), blank_pages)
    engine.pdfs(sources.pdf_files(spark, str(box)), blank_pages)
    t = spark.read.parquet(str(tmp_path / "o/transcripts"))
    assert [(r.doc_id, r.pages, r.source_kind, r.pipeline_version) for r in t.collect()] == [("p", 1, "nativo", "3")]
    assert engine.summary("p").first().source_kind == "nativo"
    engine.pdfs(sources.pdf_files(spark, str(box)), blank_pages, again=True)
    assert engine.transcripts().count() == 1 and spark.read.parquet(str(tmp_path / "o/transcripts")).count() == 2


def test_worker_screens_uploads(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "p q.pdf").write_bytes(b"%PDF-1 a")
    (box / "bad.pdf").write_bytes(b"x")
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    for _ in range(2):
        engine.watch(str(box), blank_pages, str(tmp_path / "c"))
    assert [r.doc_id[:4] for r in engine.summaries().collect()] == ["p_q-"]


def test_each_part_is_sent_once(spark, tmp_path):
    """Files that the model writes count its calls: parts, then one over each merged text."""
    folder = str(tmp_path)

    def counting():
        import uuid

        def call(text, lang, template):
            open(f"{folder}/{uuid.uuid4()}", "w").close()
            return {"titulo": text[:20], "terminos": "- b\n- a"}

        return call

    chapter = "Capítulo\n\n{}\n\nTITULO DO CAPITULO\n\n" + "linha de texto\n\n" * 12
    docs = spark.createDataFrame([(1, chapter.format(1) + chapter.format(2), 1)], "doc_id int, text string, pages int")
    n = summarize.plan_parts(docs, "hierarchical", 100)
    parts, chapters = n.count(), n.select("chapter").distinct().count()
    row = summarize.summarize(docs, counting, "hierarchical", 100).collect()[0]
    assert chapters == 2 and parts > 2
    assert row.calls == row.attempts == len(list(tmp_path.iterdir())) == parts + chapters + 1
    assert row.sections["titulo"].startswith("titulo:")


def test_prompts_and_answers_equal_the_native_ones(spark):
    md = "antes\n## Título\nuno\n\n##  Otra cosa \ndos\n## TITULO x título\ntres\n## Autores\nA"
    rows = spark.createDataFrame([(1, md, "A", "es"), (2, "", "C", "en")], "id int, md string, template string, lang string")
    native = {(r.id, r.section): r.content for r in sections.parse_sections(rows, "id", "md", "template", "lang").collect()}
    assert native == {(i, k): v for i, m, t, g in rows.collect() for k, v in summarize.answer_sections(m, g, t).items()}
    for r in rows.withColumn("p", sections.prompt(F.col("md"), F.col("lang"), F.col("template"))).collect():
        assert r.p == summarize.prompt_text(r.md, r.lang, r.template)


def test_services(spark, monkeypatch):
    seen = []

    class Host(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            text = "<think>x</think>## Título\nhola"
            body = json.dumps({"response": text, "choices": [{"message": {"content": text}}], "content": [{"text": text}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Host)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    monkeypatch.setenv("OPENAI_API_KEY", "k")
    monkeypatch.setenv("ANTHROPIC_API_KEY", "k")
    for name in ("ollama", "openai", "anthropic"):
        assert backends.summarizer(name, "m", url=url)()("texto", "es", "C") == {"titulo": "hola"}
    assert [p for p, _ in seen] == ["/api/generate", "/chat/completions", "/"]
    server.shutdown()
    monkeypatch.delenv("OPENAI_API_KEY")
    with pytest.raises(RuntimeError):
        backends.summarizer("openai", "m")


def test_choice_of_services(monkeypatch, tmp_path):
    monkeypatch.delenv("DOCMILL_BACKEND", raising=False)
    assert backends.choose(config={}) == ("ollama", "qwen2.5:7b")
    assert backends.choose(config={"summarizer_backend": "openai", "cloud_model": "m"}) == ("openai", "m")
    monkeypatch.setenv("DOCMILL_BACKEND", "anthropic")
    assert backends.choose(model="z", config={"summarizer_backend": "openai"}) == ("anthropic", "z")
    with pytest.raises(ValueError):
        backends.choose("none", config={})
    (tmp_path / ".docmill.json").write_text('{"model": 1}')
    assert backends.settings([tmp_path / "no", tmp_path]) == {"model": 1}


def test_readiness_and_throttling(spark):
    tools = [("pdftotext", True), ("pdfinfo", True), ("pdftoppm", True)]
    rows = [("a", n, ok, True) for n, ok in tools] + [("a", "ollama", True, False), ("a", "model:qwen2.5", True, False), ("b", "pdfinfo", False, True), ("b", "openai_api_key", True, False)]
    got = {r.host: tuple(r)[1:] for r in environment.readiness(spark.createDataFrame(rows, "host string, name string, ok boolean, hard boolean"), "host").collect()}
    assert got == {"a": (True, True, False, True, False), "b": (False, False, False, True, False)}
    s = spark.createDataFrame([(0, "x", "Active"), (0, "y", " N/A"), (1, "x", "0")], "gpu int, reason string, value string")
    assert sorted(map(tuple, environment.throttling(s, "gpu").collect())) == [(0, True, "x"), (1, False, "")]


def test_legacy_meta(spark):
    t = spark.createDataFrame([("a", "s", "=== pág 1 ===\nx\n=== pág 2 ===\ny"), ("b", "s", None)], "doc_id string, pdf_sha256 string, text string")
    assert [(r.doc_id, r.pages, r.legacy) for r in metadata.legacy_meta(t).collect()] == [("a", 2, True), ("b", 1, True)]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text(ARTICLE, "utf-8")
    out = str(tmp_path / "o")
    assert main(["batch", str(tmp_path / "in"), out, "--dry-run"], spark) == 0
    assert main(["report", out], spark) == 0 and main(["export", out, str(tmp_path / "l")], spark) == 0
    (tmp_path / "cases.json").write_text('[{"doc_id": "a", "expected_lang": "pt", "expected_terms": ["estudo"]}]')
    assert main(["verify", out, str(tmp_path / "cases.json")], spark) == 0

