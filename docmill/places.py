"""Folders that tasks open themselves, on any file system that Arrow knows."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a place; ``file:`` in any spelling is this machine's."""
    local = re.match(r"file:/*(/.*)", path)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new place for checkpoints and tables, which all executors share; a folder of this machine only where no shared one is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return f"{(shared or tempfile.gettempdir()).rstrip('/')}/docmill-{name}-{uuid.uuid4().hex}"
