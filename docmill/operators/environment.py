"""Checks of workers, readiness rules over them, and throttling of their devices."""

from __future__ import annotations

import json
import os
import shutil
import socket
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as X


def probe(spark: SparkSession, tasks: int | None = None, url: str | None = None) -> DataFrame:
    """(host, name, ok, hard): what each worker that runs one of ``tasks`` tasks finds; a worker that runs several says it once.

    Tools in the search path, the local model host and its models, and the API keys of the driver's environment.
    """
    base = (url or os.environ.get("OLLAMA_HOST") or X.LOCAL_URL).rstrip("/")
    secrets = [(v.lower(), bool(os.environ.get(v))) for v in X.KEY_VARIABLES.values()]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            found = [(t, shutil.which(t) is not None, True) for t in X.HARD_TOOLS]
            found += [("tesseract", shutil.which("tesseract") is not None, False)] + [(n, ok, False) for n, ok in secrets]
            try:
                with urllib.request.urlopen(f"{base}/api/tags", timeout=3) as answer:
                    models = [m.get("name", "") for m in json.load(answer).get("models", [])]
                found += [("ollama", True, False)] + [(f"model:{m}", True, False) for m in models]
            except (OSError, ValueError):
                found.append(("ollama", False, False))
            names, oks, hards = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array([socket.gethostname()] * len(found)), pa.array(names), pa.array(oks), pa.array(hards)], ["host", "name", "ok", "hard"])

    n = tasks or spark.sparkContext.defaultParallelism
    return spark.range(n, numPartitions=n).mapInArrow(check, "host string, name string, ok boolean, hard boolean").distinct()


def readiness(checks: DataFrame, key: str) -> DataFrame:
    """(key, environment_ok, extraer_nativo, ocr_imagen, resumen, ocr_vlm) of checks (key, name, ok, hard).

    All hard checks must hold. A summary needs an API key, or the local model host and a text model; names of
    vision models hold ``vl``.
    """
    name, ok = F.col("name"), F.coalesce("ok", F.lit(False))

    def have(which: Column) -> Column:
        return F.coalesce(F.bool_or(ok & which), F.lit(False))

    tools = [have(name == t) for t in X.HARD_TOOLS]
    native = tools[0] & tools[1] & tools[2]
    host, model = have(name == "ollama"), name.startswith("model:")
    return checks.groupBy(key).agg(
        F.coalesce(F.bool_and(F.when(F.col("hard"), ok)), F.lit(True)).alias("environment_ok"),
        native.alias("extraer_nativo"),
        (native & have(name == "tesseract")).alias("ocr_imagen"),
        (have(name.endswith("_api_key")) | (host & have(model & ~name.contains("vl")))).alias("resumen"),
        (host & have(model & name.contains("vl"))).alias("ocr_vlm"),
    )


def throttling(samples: DataFrame, key: str) -> DataFrame:
    """(key, active, reasons): the throttling reasons that were active on a device in any sample (reason, value)."""
    active = ~F.lower(F.btrim("value")).isin(*X.NOT_THROTTLED)
    return samples.groupBy(key).agg(
        F.coalesce(F.bool_or(active), F.lit(False)).alias("active"), F.array_join(F.array_sort(F.collect_set(F.when(active, F.col("reason")))), ",").alias("reasons")
    )
