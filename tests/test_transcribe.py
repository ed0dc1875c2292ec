"""Transcribers over fake tools, the HTTP service, events and commands."""

import json
import sys
import threading
import urllib.error
import urllib.request

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill import service, sources
from docmill.__main__ import main
from docmill.engine import Engine, blank_pages
from docmill.operators import backends, environment, summarize
from docmill.operators.transcribe import Tools, pgm, pdf_properties, read_pgm, transcriber

TOOL = '''
import json, sys
data = sys.stdin.buffer.read()
what, args = sys.argv[1], sys.argv[2:]
if what == "recognise" or what == "words":
    low = int(data.split()[1]) < 480  # narrow pages are hard to read
    words = ["borroso"] if low else "la salud de los ninos es una cuestion que no se puede dejar para mas tarde".split()
    if what == "recognise":
        print(" ".join(words))
    else:
        print("level\\tpage_num\\tblock_num\\tpar_num\\tline_num\\tword_num\\tleft\\ttop\\twidth\\theight\\tconf\\ttext")
        for k, w in enumerate(words):
            print(f"5\\t1\\t1\\t1\\t1\\t{k}\\t0\\t0\\t9\\t9\\t{10 if low else 95}\\t{w}")
    sys.exit()
pdf = json.loads(data[5:]) if data[5:] else {}
pages = pdf.get("pages", [])
if what == "pdfinfo":
    if pages: print("Title: T\\nPages:", len(pages))
elif what == "pdftotext":
    sys.stdout.write("\\f".join(p if isinstance(p, str) else "" for p in pages))
else:
    size = pages[int(args[0]) - 1] if pages else None
    size = [600, 300] if isinstance(size, str) else size  # pages of text are drawn too
    if isinstance(size, list):
        w, h = size
        rows = bytearray(b"\\xff" * (w * h))
        for y in range(40, h - 40):
            for x in range(40, w - 40):
                if y % 12 < 6: rows[y * w + x] = 0
        sys.stdout.buffer.write(b"P5\\n%d %d\\n255\\n" % (w, h) + bytes(rows))
'''


def pdf(*pages):
    return b"%PDF-" + json.dumps({"pages": pages}).encode()


@pytest.fixture
def tools(tmp_path):
    path = tmp_path / "tool.py"
    path.write_text(TOOL)
    run = lambda *a: (sys.executable, str(path), *a)
    return Tools(pdfinfo=run("pdfinfo"), pdftotext=run("pdftotext"), pdftoppm=run("pdftoppm", "{page}"), recognise=run("recognise"), words=run("words"))


def test_pgm():
    page = np.arange(6, dtype=np.uint8).reshape(2, 3)
    assert (read_pgm(pgm(page)) == page).all() and (read_pgm(b"P5\n# c\n3 2\n255\n" + page.tobytes()) == page).all()
    assert all(read_pgm(x) is None for x in (b"", b"P5", b"P5 3 2 255\nab", b"P6\n1 1\n255\nabc", b"P5\n0 0\n255\n", b"P5 x 1 255\na"))


def test_pages_are_routed(spark, tools, tmp_path):
    long = "texto nativo " * 20
    rows = [("native", pdf(long, long)), ("mixed", pdf(long + "\n", [600, 300], "poco")), ("scanned", pdf([600, 300], [500, 300])), ("broken", b"%PDF-"), ("none", None)]
    docs = spark.createDataFrame(rows, "doc_id string, content binary")
    read = transcriber(str(tmp_path / "s"), tools)
    got = {(r.doc_id, r.page): r for r in read(docs).collect()}
    assert {k: r.source for k, r in got.items()} == {
        ("native", 1): "nativo", ("native", 2): "nativo", ("mixed", 1): "nativo", ("mixed", 2): "tesseract", ("mixed", 3): "tesseract",
        ("scanned", 1): "tesseract", ("scanned", 2): "tesseract", ("broken", 1): "sin_imagen", ("none", 1): "sin_imagen",
    }
    assert got["mixed", 1].text == long and got["mixed", 2].conf == 95.0 and got["mixed", 2].words == 16 and got["mixed", 2].text.startswith("la salud")
    assert got["scanned", 2].words == 0 and got["scanned", 2].text.startswith("[región") and got["mixed", 3].text == got["mixed", 2].text and got["broken", 1].chars == 0
    seen = transcriber(str(tmp_path / "v"), tools, vision=lambda: lambda page: "texto que vio el modelo, borroso")
    found = {(r.doc_id, r.page): (r.source, r.text) for r in seen(docs.filter("doc_id = 'scanned'")).collect()}
    assert found["scanned", 2] == ("vlm", "texto que vio el modelo, borroso")
    whole = {(r.doc_id, r.page): r.source for r in transcriber(str(tmp_path / "w"), tools, segment=False)(docs).collect()}
    assert whole["native", 1] == "nativo" and whole["scanned", 2] == "tesseract" and whole["mixed", 1] == "tesseract"
    no_engine = Tools(tools.pdfinfo, tools.pdftotext, tools.pdftoppm, ("no-such-tool",), ("no-such-tool",))
    kept = {(r.doc_id, r.page): (r.source, r.text) for r in transcriber(str(tmp_path / "n"), no_engine)(docs).collect()}
    assert kept["mixed", 3] == ("sin_ocr", "poco")
    assert {r.doc_id: r.info for r in pdf_properties(docs, tools).collect()}["native"] == "Title: T\nPages: 2\n"


def test_engine_with_tools_writes_phases(spark, tools, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "a.pdf").write_bytes(pdf("texto nativo " * 20, [600, 300]))
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    engine.pdfs(sources.pdf_files(spark, str(box)), transcriber(f"{engine.out}/ocr", tools))
    row = engine.transcripts().first()
    assert (row.source_kind, row.pages) == ("mixto", 2) and "=== pág 2 ===\nla salud" in row.text
    events = [(r.event, r.phase) for r in engine.events().filter("doc_id is null").collect()]
    assert sorted(events) == sorted((e, p) for p in ("transcripcion", "resumen") for e in ("run_started", "phase", "run_completed"))
    assert [(r.phase, r.tiempo_total >= 0) for r in engine.phase_times().collect()] == [("resumen", True)]
    assert [r.sample_count for r in engine.infrastructure().collect()] == [2, 2]
    with pytest.raises(Exception):
        engine.run(spark.createDataFrame([("x", "t")], "doc_id string, text string").select("doc_id", F.raise_error(F.col("text")).cast("string").alias("text"), F.lit(1).alias("pages")))
    assert engine.events().filter("event = 'run_interrupted'").count() == 1


def ask(url, token=None, data=None, headers=None):
    request = urllib.request.Request(url, data, {**(headers or {}), **({"Authorization": f"Bearer {token}"} if token else {})})
    try:
        with urllib.request.urlopen(request, timeout=60) as answer:
            return answer.status, json.load(answer)
    except urllib.error.HTTPError as refused:
        return refused.code, json.load(refused)


def test_service(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    with pytest.raises(ValueError):
        service.handler(engine, " ", tmp_path)
    server = service.server(engine, port=0, token="t", inbox=str(tmp_path / "box"), limit=100)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}/api"
    assert ask(f"{base}/health")[0] == 401 and ask(f"{base}/report", "t")[0] == 404 and ask(f"{base}/summaries", "t") == (200, [])
    assert ask(f"{base}/documents", "t", b"no pdf")[0] == 415 and ask(f"{base}/documents", "t", b"%PDF-" + b"x" * 200)[0] == 413
    code, job = ask(f"{base}/documents", "t", b"%PDF-1 a", {"X-Filename": "my file.pdf"})
    assert code == 202 and ask(f"{base}/jobs/{job['doc_id']}", "t")[1]["status"] == "pending"
    form = b'--b\r\nContent-Disposition: form-data; name="file"; filename="my file.pdf"\r\n\r\n%PDF-1 a\r\n--b--\r\n'
    assert ask(f"{base}/documents", "t", form, {"Content-Type": "multipart/form-data; boundary=b"})[1] == job
    engine.watch(str(tmp_path / "box"), blank_pages, str(tmp_path / "c"))
    assert ask(f"{base}/jobs/{job['doc_id']}", "t")[1]["summary_url"] == f"/api/summaries/{job['doc_id']}"
    assert [r["doc_id"] for r in ask(f"{base}/summaries", "t")[1]] == [job["doc_id"]]
    assert ask(f"{base}/summaries/{job['doc_id']}", "t")[1]["_qa"]["ok"] in (True, False)
    assert ask(f"{base}/summaries/no", "t")[0] == 404 and ask(f"{base}/summaries/a%2Fb", "t")[0] == 400
    assert ask(f"{base}/report", "t")[1]["processed"] == 1 and ask(f"{base}/health", "t")[1]["queue"] == {"done": 1}
    server.shutdown()


def test_ids_agree_with_the_columns(spark):
    from docmill.functions import text as T

    names = ["my file", "..", "a/b", "x" * 60, "ñ é", "a%2Fb", " ", "\x01", "_a_"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", T.safe_stem(F.col("n")).alias("s"), T.valid_id(F.col("n")).alias("v")).collect()
    for r in rows:
        assert service.valid(r.n) == r.v, r.n
        if "/" not in r.n and "." not in r.n:
            assert service.stem(r.n) == r.s, r.n


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_text("Um texto em português que não é curto para você")
    assert main(["summarize", str(tmp_path / "a.txt"), "--dry-run"], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["doc_id"] == "a"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/p.pdf").write_bytes(b"%PDF-1 a")
    assert main(["transcribe", str(tmp_path / "in"), str(tmp_path / "o"), "--fake"], spark) == 0
    assert Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words).transcripts().count() == 1
    assert main(["run", str(tmp_path / "in"), str(tmp_path / "o"), "--fake", "--dry-run"], spark) == 0
    assert main(["api", str(tmp_path / "o"), str(tmp_path / "box")], spark) == 2
    assert main(["doctor"], spark) in (0, 1)


def test_probe_and_vision_choice(spark):
    found = {r.name: r.hard for r in environment.probe(spark, 2, "http://127.0.0.1:9").collect()}
    assert found["pdfinfo"] and not found["ollama"]
    assert backends.choose_vision(config={}) == "qwen3-vl:8b-instruct" and backends.choose_vision("m") == "m" and backends.choose_vision(config={"vlm_model": "v"}) == "v"
    assert backends.png(np.zeros((2, 3), np.uint8)).startswith(b"\x89PNG")


def test_workspace(spark, tmp_path):
    from docmill.functions.text import valid_id
    from docmill.workspace import place, valid

    assert place(tmp_path, "summary", "a b") == tmp_path / "summaries/a b.json" and place(tmp_path, "text", "x").name == "x.txt" and place(tmp_path, "bibframe", "x").name == "x.bibframe.json"
    ids = ["", " ", ".", "..", "a/b", "a\\b", "%2e%2e", "A%2Fb", "a\x00b", "a", "a.b", "ñ", "\u00a0", "a\x7f", "%5C"]
    native = {r.i: r.ok for r in spark.createDataFrame([(i,) for i in ids], "i string").select("i", valid_id(F.col("i")).alias("ok")).collect()}
    assert native == {i: valid(i) for i in ids} and not native["A%2Fb"] and native["ñ"]
    with pytest.raises(ValueError):
        place(tmp_path, "text", "..")


def test_json_array_and_going_worker(spark, tmp_path):
    import time

    for n in (0, 1, 700):
        sources.write_json_array(spark.range(n), str(tmp_path / f"j{n}"))
        text = "".join(p.read_text() for p in (tmp_path / f"j{n}").glob("part-*"))
        assert sorted(r["id"] for r in json.loads(text)) == list(range(n))
    (tmp_path / "box").mkdir()
    engine = Engine(spark, str(tmp_path / "o"), lambda: summarize.first_words)
    query = engine.watch(str(tmp_path / "box"), blank_pages, str(tmp_path / "c"), every=0.2)
    (tmp_path / "box/p.pdf").write_bytes(b"%PDF-1 a")
    until = time.time() + 120
    while engine.summaries().count() == 0 and time.time() < until:
        time.sleep(1)
    query.stop()
    assert engine.summaries().count() == 1


def test_monitor(spark):
    from datetime import datetime, timedelta

    from docmill.operators import monitor

    start = datetime(2024, 1, 1)
    gpu = lambda power, mem, hot: {"index": 0, "uuid": "u", "name": "g", "power_draw_w": power, "memory_used_mb": mem, "throttling_active": hot, "throttling_reasons": ["sw_power_cap"] if hot else []}
    models = [{"name": "m", "size_vram_mb": 10.5, "context_length": 4096}]
    rows = [("r", "w", start, {"rss_mb": 100.0, "cpu_seconds": 1.0}, {"load_1m": 1.0, "temperature_max_c": 40.0}, [gpu(200.0, 5000.0, False)], None)]
    rows += [("r", "w", start + timedelta(seconds=1), {"rss_mb": 120.0, "cpu_seconds": 3.5}, {"load_1m": 2.0}, [gpu(215.5, 5120.0, True)], {"available": True, "models": models})]
    samples = spark.createDataFrame(rows, monitor.SAMPLE)
    one = monitor.run_summary(samples).first()
    assert (one.sample_count, one.process_rss_peak_mb, one.process_cpu_seconds, one.load_1m_avg, one.host_temperature_p95_c) == (2, 120.0, 2.5, 1.5, 40.0)
    assert (one.gpu_power_draw_max_w, one.gpu_memory_peak_mb, one.throttling_detected, one.ollama_vram_loaded_peak_mb, one.swap_free_min_mb) == (215.5, 5120.0, True, 10.5, None)
    device = monitor.device_summary(samples).first()
    assert (device.id, device.throttling_detected, device.throttling_reasons_seen, device.memory_peak_mb) == ("u", True, ["sw_power_cap"], 5120.0)
    assert [(r.model, r.vram_peak_mb, r.context_length_max) for r in monitor.model_summary(samples).collect()] == [("m", 10.5, 4096)]
    live = monitor.sample(spark, "x", 2).collect()
    assert len(live) == 2 and live[0].process.rss_mb > 0 and monitor.run_summary(monitor.sample(spark, "x", 1)).first().sample_count == 1


def test_meta_files(spark, tmp_path):
    folder = tmp_path / "ocr"
    folder.mkdir()
    (folder / "a.meta.json").write_text('{"meta_version": "1.0", "ocr_pipeline_version": "3", "doc_id": "a", "pdf_sha256": "s", "pages": 2, "pages_detail": [{"page": 1, "source": "vlm"}], "quality": {"conf_media": 9.5}}')
    (folder / "b.meta.json").write_text('{"meta_version": "1.0", "legacy": true, "doc_id": "b"}')
    (folder / "c.meta.json").write_text("{broken")
    got = {r.doc_id: r for r in sources.read_ocr_meta(spark, str(folder)).collect()}
    assert (got["a"].pipeline_version, got["a"].legacy, got["a"].readable, got["a"].quality.conf_media, got["a"].pages_detail[0].source) == ("3", False, True, 9.5, "vlm")
    assert got["b"].legacy and not got["c"].readable
    sources.write_ocr_meta(sources.read_ocr_meta(spark, str(folder)).filter("readable").drop("readable"), str(tmp_path / "out"))
    assert sorted(p.parent.name for p in (tmp_path / "out").glob("*/*.json")) == ["doc=a", "doc=b"]
