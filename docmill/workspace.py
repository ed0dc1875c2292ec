"""Places of a workspace's files; ids that could leave it are refused."""

from __future__ import annotations

import re
from pathlib import Path

#: kind of file: its folder and suffix
KINDS = {"text": ("ocr", ".txt"), "summary": ("summaries", ".json"), "bibframe": ("bibframe", ".bibframe.json")}


def valid(doc_id: str) -> bool:
    """``functions.text.valid_id`` for one id, without Spark."""
    return bool(doc_id.strip()) and doc_id not in (".", "..") and not re.search(r"[/\\\x00-\x1f\x7f]", doc_id) and not re.search("%2e|%2f|%5c", doc_id.lower())


def place(root: str | Path, kind: str, doc_id: str) -> Path:
    """Where the file of a document stands."""
    if not valid(doc_id):
        raise ValueError(f"invalid id: {doc_id!r}")
    folder, suffix = KINDS[kind]
    return Path(root) / folder / f"{doc_id}{suffix}"
