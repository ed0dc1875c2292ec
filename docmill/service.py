"""HTTP service over an engine's folder: read-only queries, and uploads into the inbox of its worker.

Every answer is a query over the engine's tables; lists are streamed row by row, never collected. Uploads need a
token. An uploaded PDF is published under its final name only when it is whole, so the worker never reads a part.
"""

from __future__ import annotations

import hashlib
import hmac
import json
import os
import re
import uuid
from email.parser import BytesParser
from email.policy import default as mail_policy
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .engine import Engine
from .functions import fixed as X
from .sources.files import UPLOAD_LIMIT
from .workspace import valid



def listed(engine: Engine) -> DataFrame:
    """(doc_id, tipo, idioma, qa_ok, transcript_ok) of every summary."""
    return engine.summaries().select("doc_id", F.col("tipo_documento").alias("tipo"), F.col("idioma_principal").alias("idioma"), "qa_ok", "transcript_ok").orderBy("doc_id")


def report(engine: Engine) -> DataFrame:
    """One row: documents by state, and the run with the last document."""
    log = engine.log()
    return log.agg(F.count("*").alias("processed"), F.count_if(F.col("state") == "done").alias("completed"), F.count_if(F.col("state") == "failed").alias("failed"), F.max_by("run_id", "finished_at").alias("run_id"))


def handler(engine: Engine, token: str | None = None, inbox: Path | None = None, limit: int = UPLOAD_LIMIT) -> type[BaseHTTPRequestHandler]:
    """Handler of GET /api/summaries[/id], /api/report, /api/health, /api/jobs/id and, with an inbox, POST /api/documents."""
    if inbox is not None and not (token or "").strip():
        raise ValueError("uploads need a token")

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_) -> None:
            pass

        def say(self, code: int, value) -> None:
            self.stream(code, iter([json.dumps(value, ensure_ascii=False, default=str)]))

        def stream(self, code: int, parts) -> None:
            self.send_response(code)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.end_headers()
            for part in parts:
                self.wfile.write(part.encode())

        def rows(self, df: DataFrame) -> None:
            def parts():
                yield "["
                for k, row in enumerate(df.toJSON().toLocalIterator()):
                    yield (",\n" if k else "") + row
                yield "]"

            self.stream(200, parts())

        def one(self, df: DataFrame, missing: str) -> None:
            found = df.toJSON().take(1)
            self.stream(200, iter(found)) if found else self.say(404, {"error": missing})

        def allowed(self) -> bool:
            if token and not hmac.compare_digest((self.headers.get("Authorization") or "").encode("utf-8", "replace"), f"Bearer {token}".encode()):
                self.say(401, {"error": "invalid token"})
                return False
            return True

        def do_GET(self) -> None:
            if not self.allowed():
                return
            path = unquote(self.path.partition("?")[0]).rstrip("/")
            if path == "/api/summaries":
                self.rows(listed(engine))
            elif path.startswith("/api/summaries/"):
                doc_id = path.removeprefix("/api/summaries/")
                if not valid(doc_id):
                    self.say(400, {"error": "invalid id"})
                else:
                    self.one(engine.records().filter(F.col("doc_id") == doc_id), "not found")
            elif path == "/api/report":
                self.one(report(engine).filter("processed > 0"), "no report")
            elif path == "/api/health":
                self.say(200, {"status": "ok", "contract_version": X.CONTRACT_VERSION, "queue": {r.state: r.n for r in engine.health().collect()}})
            elif path.startswith("/api/jobs/"):
                self.job(path.removeprefix("/api/jobs/"))
            else:
                self.say(404, {"error": "unknown endpoint", "path": path})

        def job(self, doc_id: str) -> None:
            found = engine.jobs().filter(F.col("doc_id") == doc_id).orderBy(F.col("at").desc(), "key").select("doc_id", F.col("state").alias("status"), "attempts", "error").toJSON().take(1)
            if found:
                done = json.loads(found[0])
                self.say(200, done | ({"summary_url": f"/api/summaries/{doc_id}"} if done["status"] == "done" else {}))
            elif inbox is not None and valid(doc_id) and (inbox / doc_id).is_dir():
                self.say(200, {"doc_id": doc_id, "status": "pending", "attempts": 0})
            else:
                self.say(404, {"error": "unknown job"})

        def do_POST(self) -> None:
            if not self.allowed():
                return
            if inbox is None or self.path.rstrip("/") != "/api/documents":
                self.say(404, {"error": "unknown endpoint"})
                return
            size = int(self.headers.get("Content-Length") or 0)
            if size > limit + 4096:
                self.say(413, {"error": "too large"})
                return
            name, data = uploaded(self.headers, self.rfile.read(size))
            if len(data) > limit:
                self.say(413, {"error": "too large"})
            elif not data.startswith(b"%PDF-"):
                self.say(415, {"error": "no PDF"})
            else:
                # the worker makes the same id of the file's name and content
                doc_id = f"{stem(name)}-{hashlib.sha256(data).hexdigest()[:12]}"
                place = inbox / doc_id / f"{stem(name)}.pdf"
                if not place.exists():
                    place.parent.mkdir(parents=True, exist_ok=True)
                    part = place.with_suffix(f".{uuid.uuid4().hex}.part")
                    part.write_bytes(data)
                    os.replace(part, place)
                self.say(202, {"doc_id": doc_id, "status": "pending", "job_url": f"/api/jobs/{doc_id}"})

    return Handler


def stem(name: str) -> str:
    """``functions.text.safe_stem`` for one file name, without Spark."""
    return re.sub("[^A-Za-z0-9_-]+", "_", re.sub(r"\.[^.]*$", "", name.rpartition("/")[2])).strip("_")[:40] or "doc"


def uploaded(headers, body: bytes) -> tuple[str, bytes]:
    """(file name, content) of a request: the first file of a form, or the body as it is."""
    kind = headers.get("Content-Type") or ""
    if kind.startswith("multipart/form-data"):
        mail = BytesParser(policy=mail_policy).parsebytes(f"Content-Type: {kind}\r\n\r\n".encode() + body)
        for part in mail.iter_parts():
            if part.get_filename():
                return part.get_filename(), part.get_payload(decode=True) or b""
        return "doc", b""
    return headers.get("X-Filename") or "doc", body


def server(engine: Engine, host: str = "127.0.0.1", port: int = 8765, token: str | None = None, inbox: str | None = None, limit: int = UPLOAD_LIMIT) -> ThreadingHTTPServer:
    """A server that the caller starts with ``serve_forever``."""
    return ThreadingHTTPServer((host, port), handler(engine, token, Path(inbox) if inbox else None, limit))
