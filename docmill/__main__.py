"""Command line: ``python -m docmill COMMAND ...``; exit code 0 done, 1 with failures, 2 wrong use."""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import service, sources
from .engine import Engine, blank_pages, summary_records
from .operators import backends, environment, reports
from .operators import transcribe as tools

TOKEN_VARIABLE = "DOCMILL_API_TOKEN"


def _plug(name: str):
    """The object named ``module:attribute``."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _transcriber(a: argparse.Namespace, engine: Engine):
    """The transcriber that the arguments name; by default that of the tools on the executors."""
    if a.transcriber:
        return _plug(a.transcriber)
    if a.fake:
        return blank_pages
    vision = backends.vision(backends.choose_vision(a.vlm_model), a.lang) if a.vlm_model else None
    return tools.transcriber(f"{engine.out}/ocr", lang=a.lang, vision=vision)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docmill")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *places: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=text)
        for place in places:
            c.add_argument(place)
        return c

    for c in (
        command("batch", "summarise a folder of texts", "inputs", "out"),
        command("run", "transcribe and summarise a folder of PDFs", "inputs", "out"),
        command("worker", "process what came into an inbox", "inputs", "out"),
    ):
        c.add_argument("--backend")
        c.add_argument("--model")
        c.add_argument("--dry-run", action="store_true")
        c.add_argument("--strategy", default="excerpt", choices=("excerpt", "blocks", "hierarchical"))
        c.add_argument("--transcriber", help="module:callable from PDFs (doc_id, content) to pages")
        c.add_argument("--checkpoint", help="checkpoint folder of the worker")
        c.add_argument("--retranscribe", action="store_true")
        c.add_argument("--max-upload-mb", type=int, default=100, help="largest PDF that the worker takes")
        c.add_argument("--text-lang", help="language of all texts; found for each without it")
        c.add_argument("--doc-type", choices=("articulo", "manual", "divulgacion"), help="type of all documents; found for each without it")
        c.add_argument("--interval", type=float, help="seconds between looks into the inbox; without it the worker stops when the inbox is done")
        c.add_argument("--vlm-model", help="vision model of the local model host for pages of low confidence")
        c.add_argument("--lang", default="por+eng+spa")
        c.add_argument("--fake", action="store_true", help="transcribe without tools, for trying things out")
    c = command("transcribe", "only transcribe a folder of PDFs", "inputs", "out")
    c.add_argument("--transcriber")
    c.add_argument("--retranscribe", action="store_true")
    c.add_argument("--vlm-model")
    c.add_argument("--lang", default="por+eng+spa")
    c.add_argument("--fake", action="store_true")
    c = command("summarize", "summarise one text and print its record", "text")
    c.add_argument("--doc-id")
    c.add_argument("--pages", type=int, default=1)
    c.add_argument("--backend")
    c.add_argument("--model")
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--out", help="folder to write the record to")
    for c in (command("serve", "answer read-only queries over HTTP", "out"), command("api", "the same, and take uploads into the worker's inbox", "out", "inbox")):
        c.add_argument("--host", default="127.0.0.1")
        c.add_argument("--port", type=int, default=8765)
        c.add_argument("--max-upload-mb", type=int, default=100)
    command("export", "write LILACS drafts", "out", "target")
    command("bibframe", "write BIBFRAME drafts; info is a JSON table (doc_id, info) of PDF properties", "out", "info", "target").add_argument("--pdfs", action="store_true", help="info is a folder of PDFs")
    command("report", "print progress, metrics and gates", "out")
    command("verify", "judge the summaries by a control set", "out", "cases").add_argument("--min-coverage", type=float, default=0.6)
    command("doctor", "print readiness by worker, from a JSON table (host, name, ok, hard) if one is given").add_argument("checks", nargs="?")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("docmill").getOrCreate()
    if a.command == "doctor":
        checks = spark.read.schema("host string, name string, ok boolean, hard boolean").json(a.checks) if a.checks else environment.probe(spark)
        ready = environment.readiness(checks, "host")
        ready.show(truncate=False)
        return int(not ready.filter("not environment_ok").isEmpty())
    if a.command == "summarize":
        factory = backends.summarizer(*(("", "") if a.dry_run else backends.choose(a.backend, a.model)), dry_run=a.dry_run)
        name = a.doc_id or Path(a.text).stem
        text = spark.createDataFrame([(name, Path(a.text).read_text("utf-8", "replace"), a.pages)], "doc_id string, text string, pages int")
        made = summary_records(text, factory)
        made.write.json(a.out) if a.out else print(made.toJSON().first())
        return 0 if a.out else int(made.filter("state = 'failed'").count() > 0)
    if a.command in ("serve", "api"):
        engine = Engine(spark, a.out, backends.summarizer("", "", dry_run=True))
        token = os.environ.get(TOKEN_VARIABLE)
        if a.command == "api" and not token:
            print(f"{TOKEN_VARIABLE} is not set", file=sys.stderr)
            return 2
        service.server(engine, a.host, a.port, token if a.command == "api" else None, getattr(a, "inbox", None), a.max_upload_mb * 1024 * 1024).serve_forever()
        return 0
    if a.command == "transcribe":
        engine = Engine(spark, a.out, backends.summarizer("", "", dry_run=True))
        found = engine.transcribed(sources.pdf_files(spark, a.inputs), _transcriber(a, engine), a.lang, a.retranscribe)
        found.select("doc_id", "pages", "source_kind", "conf_media").show(truncate=False)
        return 0
    if a.command in ("batch", "run", "worker"):
        dry = a.dry_run
        factory = backends.summarizer(*(("", "") if dry else backends.choose(a.backend, a.model)), dry_run=dry)
        model = "dry-run" if dry else "/".join(backends.choose(a.backend, a.model))
        engine = Engine(spark, a.out, factory, a.strategy, model=model, lang=a.text_lang, doc_type=a.doc_type)
        transcribe = _transcriber(a, engine)
        if a.command == "worker":
            query = engine.watch(a.inputs, transcribe, a.checkpoint or f"{engine.out}/checkpoint", a.max_upload_mb * 1024 * 1024, a.interval)
            if query:
                query.awaitTermination()
            return 0
        run_id = engine.texts(a.inputs) if a.command == "batch" else engine.pdfs(sources.pdf_files(spark, a.inputs), transcribe, a.lang, a.retranscribe)
        return int(not engine.log().filter((F.col("run_id") == run_id) & (F.col("state") == "failed")).isEmpty())
    engine = Engine(spark, a.out, backends.summarizer("", "", dry_run=True))
    if a.command == "export":
        engine.export_lilacs(a.target)
    elif a.command == "bibframe":
        info = tools.pdf_properties(sources.pdf_files(spark, a.info)) if a.pdfs else spark.read.schema("doc_id string, info string").json(a.info)
        engine.export_bibframe(a.target, sources.pdf_info(info, "doc_id", "info")).show(truncate=False)
    elif a.command == "report":
        for table in (engine.health(), engine.metrics(), engine.gate_counts()):
            table.show(truncate=False)
    else:
        results = engine.summaries().selectExpr("doc_id", "idioma_principal AS lang", "tipo_documento AS type", "array_join(map_values(secciones), '\\n') AS text")
        verdict = reports.acceptance(reports.control_report(reports.judge_cases(sources.read_control_set(spark, a.cases), results, "doc_id")), a.min_coverage)
        verdict.show(truncate=False)
        return int(verdict.filter("not accepted").count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
