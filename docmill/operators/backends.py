"""Choice of a model service: settings in order of precedence, and the summariser of each service."""

from __future__ import annotations

import base64
import json
import os
import re
import struct
import urllib.request
import zlib
from collections.abc import Callable
from pathlib import Path

from ..functions import fixed as X
from .summarize import Summarizer, first_words, http_summarizer

CONFIG_NAME, BACKEND_VARIABLE = ".docmill.json", "DOCMILL_BACKEND"


def settings(folders: list[Path] | None = None) -> dict:
    """The first readable settings file of the working folder, then of the home folder; empty without one."""
    for folder in folders or [Path.cwd(), Path.home()]:
        try:
            found = json.loads((folder / CONFIG_NAME).read_text("utf-8"))
        except (OSError, ValueError):
            continue
        if isinstance(found, dict):
            return found
    return {}


def choose(backend: str | None = None, model: str | None = None, config: dict | None = None) -> tuple[str, str]:
    """(backend, model): arguments, then the environment, then settings, then defaults."""
    config = settings() if config is None else config
    backend = backend or os.environ.get(BACKEND_VARIABLE) or config.get("summarizer_backend") or "ollama"
    if backend not in X.DEFAULT_MODELS:
        raise ValueError(f"unknown backend {backend!r}; one of {', '.join(X.DEFAULT_MODELS)}")
    return backend, model or config.get("model" if backend == "ollama" else "cloud_model") or X.DEFAULT_MODELS[backend]


def summarizer(backend: str, model: str, dry_run: bool = False, url: str | None = None) -> Callable[[], Summarizer]:
    """Factory of the summariser of a backend; the key is read here, on the driver."""
    if dry_run:
        return lambda: first_words
    if backend == "ollama":
        options = {"num_ctx": X.LOCAL_CONTEXT, "temperature": X.TEMPERATURE}
        base = (url or os.environ.get("OLLAMA_HOST") or X.LOCAL_URL).rstrip("/")
        return http_summarizer(f"{base}/api/generate", lambda p: {"model": model, "prompt": p, "stream": False, "options": options}, lambda r: r.get("response", ""))
    if backend not in X.KEY_VARIABLES:
        raise ValueError(f"unknown backend {backend!r}")
    secret = os.environ.get(X.KEY_VARIABLES[backend], "")
    if not secret:
        raise RuntimeError(f"{X.KEY_VARIABLES[backend]} is not set")
    said = lambda p: [{"role": "user", "content": p}]
    if backend == "anthropic":
        return http_summarizer(
            url or X.MESSAGES_URL,
            lambda p: {"model": model, "max_tokens": X.MESSAGES_TOKENS, "messages": said(p)},
            lambda r: "".join(b.get("text", "") for b in r.get("content", [])),
            {"x-api-key": secret, "anthropic-version": X.MESSAGES_VERSION},
        )
    return http_summarizer(
        f"{(url or X.CHAT_URLS[backend]).rstrip('/')}/chat/completions",
        lambda p: {"model": model, "messages": said(p), "temperature": X.TEMPERATURE},
        lambda r: r["choices"][0]["message"]["content"],
        {"Authorization": f"Bearer {secret}"},
    )


def choose_vision(model: str | None = None, config: dict | None = None) -> str:
    """The vision model: argument, then settings, then the default."""
    return model or (settings() if config is None else config).get("vlm_model") or X.DEFAULT_VISION


def png(page) -> bytes:
    """A gray page (rows of bytes) as a PNG file."""
    height, width = page.shape
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    rows = b"".join(b"\0" + row.tobytes() for row in page)
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def vision(model: str, lang: str = "por+eng+spa", url: str | None = None, timeout: float = 240.0) -> Callable[[], Callable]:
    """Factory of a vision model behind the local model host: a gray page in, its text out; thoughts are left out."""
    base = (url or os.environ.get("OLLAMA_HOST") or X.LOCAL_URL).rstrip("/")
    prompt = X.VISION_PROMPTS.get(lang, X.VISION_PROMPTS["por"])

    def factory() -> Callable:
        def look(page) -> str:
            body = {"model": model, "prompt": prompt, "stream": False, "images": [base64.b64encode(png(page)).decode()]}
            request = urllib.request.Request(f"{base}/api/generate", json.dumps(body).encode(), {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                said = json.load(answer).get("response", "")
            return re.sub(r"</?think>", "", re.sub(r"(?s)<think>.*?</think>", "", said)).strip()

        return look

    return factory
