"""Answers of a model that are kept before they are used, so that none is paid for twice.

A question is named by the SHA-256 of the model's name, language, template and text. ``Answers.ask`` sends each distinct question
that has no answer yet, once. Inside a task every answer is written to a journal, a file named by its question, as soon as it is there;
a task that runs again after its executor was lost, and a run after one that broke off, find the answers there and send only the rest.
What a call gives becomes one more Parquet table in ``calls``, and only then do the rows that asked read it. Errors are outcomes of their
call, but no answers: the next run asks again.

Rows with a null text ask nothing. Two attempts of one task at the same time may both send the question that neither has answered yet.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..places import opened

Summarizer = Callable[[str, str, str], dict[str, str]]
CALL = "ask string, sections map<string,string>, error string, attempts int, seconds double"
_MAP = pa.map_(pa.string(), pa.string())
_ARROW = pa.schema([("ask", pa.string()), ("sections", _MAP), ("error", pa.string()), ("attempts", pa.int32()), ("seconds", pa.float64())])


def question(model: str, text: Column, lang: Column, template: Column) -> Column:
    """Name of a question; null for a null text."""
    parts = [F.lit(model), F.coalesce(lang, F.lit("")), F.coalesce(template, F.lit("")), text]
    # lengths before the parts, so that no two lists of parts look alike
    return F.when(text.isNotNull(), F.sha2(F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)]), 256))


def tried(summarize: Summarizer, text: str, lang: str, template: str, retries: int) -> dict:
    """One question with up to ``retries`` further tries; a failure is data."""
    out, began = {"sections": None, "error": None, "attempts": 0, "seconds": 0.0}, time.perf_counter()
    for _ in range(retries + 1):
        out["attempts"] += 1
        try:
            out["sections"], out["error"] = dict(summarize(text, lang, template)), None
            break
        except Exception as error:  # a document's failure, not the job's
            out["error"] = f"{type(error).__name__}: {error}"[:2000]
    return out | {"seconds": time.perf_counter() - began}


class Journal:
    """Answers of a running call: one file for each, seen by every task."""

    def __init__(self, path: str) -> None:
        self.store, self.path = opened(path)

    def _file(self, ask: str) -> str:
        return f"{self.path}/{ask[:2]}/{ask}.json"

    def find(self, ask: str) -> dict | None:
        try:
            with self.store.open_input_stream(self._file(ask)) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def keep(self, ask: str, answer: dict) -> None:
        """A whole file or none: it is moved to its name when it is written."""
        self.store.create_dir(f"{self.path}/{ask[:2]}", recursive=True)
        draft = f"{self._file(ask)}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as f:
            f.write(json.dumps(answer).encode())
        self.store.move(draft, self._file(ask))

    def drop(self) -> None:
        if self.store.get_file_info(self.path).type != fs.FileType.NotFound:
            self.store.delete_dir(self.path)


class Answers:
    """The answers below one folder; ``model`` names what gives them."""

    def __init__(self, spark: SparkSession, path: str, model: str = "") -> None:
        self.spark, self.path, self.model = spark, path.rstrip("/"), model
        spark.createDataFrame([], CALL).write.mode("ignore").parquet(f"{self.path}/calls/none")

    def known(self) -> DataFrame:
        """(ask, sections): every answer, one for each question."""
        made = self.spark.read.schema(CALL).option("recursiveFileLookup", True).parquet(f"{self.path}/calls")
        return made.filter("error is null").dropDuplicates(["ask"]).select("ask", "sections")

    def ask(self, rows: DataFrame, factory: Callable[[], Summarizer], retries: int = 0) -> DataFrame:
        """``rows`` (text, lang, template, ...) with __outcome, a struct of CALL; null where the text is. Answers of earlier runs have no attempts."""
        named = rows.withColumn("__ask", question(self.model, F.col("text"), F.col("lang"), F.col("template")))
        known = self.known()
        open_ = named.filter("__ask is not null").select(F.col("__ask").alias("ask"), "text", "lang", "template").join(known.select("ask"), "ask", "left_anti").dropDuplicates(["ask"])
        call, journal = f"{self.path}/calls/{uuid.uuid4().hex}", f"{self.path}/journal"
        self._send(open_, factory, retries, journal).write.parquet(call)
        made = self.spark.read.schema(CALL).parquet(call)
        before = self.known().join(made.select("ask"), "ask", "left_anti").select("ask", "sections", F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"), F.lit(0.0).alias("seconds"))
        outcome = made.unionByName(before)
        return named.join(outcome.select(F.col("ask").alias("__ask"), F.struct("sections", "error", "attempts", "seconds").alias("__outcome")), "__ask", "left").drop("__ask")

    def _send(self, asked: DataFrame, factory: Callable[[], Summarizer], retries: int, journal: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            summarize, kept = factory(), Journal(journal)
            for b in batches:
                out = []
                for r in b.to_pylist():
                    answer = kept.find(r["ask"])
                    if answer is None:
                        answer = tried(summarize, r["text"], r["lang"], r["template"], retries)
                        if answer["error"] is None:
                            kept.keep(r["ask"], answer)
                    sections = answer["sections"]
                    out.append(answer | {"ask": r["ask"], "sections": None if sections is None else list(sections.items())})
                yield pa.RecordBatch.from_pylist(out, _ARROW)

        return asked.mapInArrow(run, CALL)

    def tidy(self) -> None:
        """Drop the journal, whose answers stand in ``calls``; for when no run is under way."""
        Journal(f"{self.path}/journal").drop()
