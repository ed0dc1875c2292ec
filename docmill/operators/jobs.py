"""OCR cache decisions, job states and the review log."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from .gates import result_gates


def cache_decision(pdfs: DataFrame, meta: DataFrame, key: str, version: str = X.PIPELINE_VERSION) -> DataFrame:
    """``pdfs`` (sha, retranscribe) with the decision about the cached transcript in ``meta``.

    ``meta`` has (cached, readable, legacy, pipeline_version, pdf_sha256); no row means no cache.
    """
    m = meta.select(key, "cached", "readable", "legacy", "pipeline_version", F.col("pdf_sha256").alias("meta_sha"))
    same = F.col("meta_sha") == F.col("sha")
    legacy = F.coalesce("legacy", F.lit(False))
    decision = (
        F.when(~F.coalesce("cached", F.lit(False)), "transcribe")
        .when(F.col("retranscribe"), "forced")
        .when(F.col("readable") & ~legacy & (F.col("pipeline_version") == version) & same, "reuse")
        .when(~F.coalesce("readable", F.lit(False)), "legacy_unreadable")
        .when(legacy & same, "legacy_same")
        .otherwise("stale")
    )
    return pdfs.join(m, key, "left").withColumn("decision", decision)


def pending(inputs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Inputs whose job is not done."""
    return inputs.join(jobs.filter("state = 'done'").select("key"), "key", "left_anti")


def job_states(attempts: DataFrame, max_retries: int = 2) -> DataFrame:
    """State of each job from its attempts (key, n, ok): the first success counts, else at most max_retries + 1 failures."""
    used = attempts.filter(F.col("n") <= max_retries + 1)
    first = used.groupBy("key").agg(F.min(F.when(F.col("ok"), F.col("n"))).alias("won"), F.max("n").alias("last"))
    return first.select("key", F.when(F.col("won").isNotNull(), "done").otherwise("failed").alias("state"), F.coalesce("won", "last").alias("attempts"))


def counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("state").agg(F.count("*").alias("n"))


def review_state(events: DataFrame) -> DataFrame:
    """Latest valid review action of each document.

    ``events`` has (doc_id, action, reviewer, note, ts, seq, force, errors); an approval over errors needs force,
    and its note then names them.
    """
    errors = F.size("errors") > 0
    allowed = (F.col("action") != "approved") | ~errors | F.col("force")
    forced = F.btrim(F.concat("note", F.lit(" [FORZADO pese a: "), F.array_join("errors", ", "), F.lit("]")))
    note = F.when((F.col("action") == "approved") & errors & F.col("force"), forced).otherwise(F.col("note"))
    last = F.max_by(F.struct(F.col("action").alias("state"), "reviewer", note.alias("note")), F.struct("ts", "seq")).alias("r")
    return events.filter(allowed).groupBy("doc_id").agg(last, F.count("*").alias("actions")).select("doc_id", "r.state", "r.reviewer", "r.note", "actions")


def edit_sections(results: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """``results`` (sections map) with the sections of ``edits`` (changes map, reviewer) put over them."""
    joined = results.join(edits.select(key, "changes", "reviewer"), key, "left")
    kept = F.map_filter("sections", lambda k, _: ~F.array_contains(F.map_keys("changes"), k))
    return joined.withColumn("sections", F.when(F.col("changes").isNull(), F.col("sections")).otherwise(F.map_concat(kept, "changes"))).withColumnRenamed(
        "reviewer", "edited_by"
    ).drop("changes")


FOLDED = "doc_id string, ts timestamp, seq long, action string, reviewer string, note string, force boolean, changes map<string,string>, sections map<string,string>, edited_by string"


def reviewed(results: DataFrame, events: DataFrame) -> DataFrame:
    """The valid and refused review actions of documents in order: (doc_id, ts, seq, action, reviewer, note, sections, errors, allowed, edited_by).

    ``results`` has one row (doc_id, sections map, template, lang, declared, present) for each document, ``events`` (doc_id, ts, seq, action, reviewer, note,
    force, changes map): ``approved``, ``rejected`` or ``edited``. An edit puts its changes over the sections. An approval is judged by the
    result gates on the sections as they are by then: over errors it is refused, or with ``force`` allowed, and its note names the gates.
    Events of unknown documents and other actions are left out; a null note is empty.

    Sections are carried along the sorted events of a document, one row at a time, so a document may have any number of them.
    """
    doc = F.col("doc_id").cast("string").alias("doc_id")
    none = lambda kind: F.lit(None).cast(kind)
    first = results.select(doc, none("timestamp").alias("ts"), none("long").alias("seq"), none("string").alias("action"), none("string").alias("reviewer"), none("string").alias("note"), F.lit(False).alias("force"), none("map<string,string>").alias("changes"), "sections")
    known = events.filter(F.col("action").isin("approved", "rejected", "edited")).select(doc, "ts", F.col("seq").cast("long").alias("seq"), "action", "reviewer", F.coalesce("note", F.lit("")).alias("note"), F.coalesce("force", F.lit(False)).alias("force"), "changes", none("map<string,string>").alias("sections"))
    rows = first.unionByName(known).filter("doc_id is not null").repartition("doc_id").sortWithinPartitions("doc_id", F.col("action").isNotNull(), "ts", "seq", "action")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_id, sections, editor = None, None, None
        for b in batches:
            keep, held, editors = [], [], []
            for k, (i, action, reviewer, changes, given) in enumerate(zip(*[b.column(c).to_pylist() for c in ("doc_id", "action", "reviewer", "changes", "sections")])):
                if i != doc_id:
                    doc_id, sections, editor = i, None, None
                if action is None:
                    sections = dict(given or [])
                    continue
                if sections is None:
                    continue
                if action == "edited":
                    sections, editor = sections | dict(changes or []), reviewer
                keep.append(k)
                held.append(list(sections.items()))
                editors.append(editor)
            out = b.drop_columns(["sections"]).take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(held, pa.map_(pa.string(), pa.string())), pa.array(editors, pa.string())], [*out.schema.names, "sections", "edited_by"])

    folded = rows.mapInArrow(run, FOLDED)
    facts = results.select(doc, "template", "lang", "declared", "present")
    judged = folded.join(facts, "doc_id")
    failures = F.filter(result_gates(F.col("sections"), F.col("template"), F.col("lang"), F.col("declared"), F.col("present")), lambda f: f["severity"] == "error")
    judged = judged.withColumn("errors", F.when(F.col("action") == "approved", F.transform(failures, lambda f: f["gate"])))
    bad = F.coalesce(F.size("errors") > 0, F.lit(False)) & (F.col("action") == "approved")
    forced = F.btrim(F.concat("note", F.lit(" [FORZADO pese a: "), F.array_join("errors", ", "), F.lit("]")))
    edited = F.concat("note", F.lit(" (secciones: ["), F.array_join(F.transform(F.array_sort(F.map_keys("changes")), lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", "), F.lit("])"))
    log = F.when(bad & F.col("force"), forced).when(F.col("action") == "edited", F.coalesce(edited, F.concat("note", F.lit(" (secciones: [])")))).otherwise(F.col("note"))
    return judged.select("doc_id", "ts", "seq", "action", "reviewer", F.when(bad & F.col("force"), forced).otherwise(F.col("note")).alias("note"), log.alias("logged"), "sections", "errors", (~bad | F.col("force")).alias("allowed"), "edited_by")


def review_records(actions: DataFrame) -> DataFrame:
    """(doc_id, state, reviewer, note, sections, edited_by, actions): each document after the last allowed one of its actions, as ``reviewed`` gives them."""
    last = F.max_by(F.struct(F.col("action").alias("state"), "reviewer", "note", "sections", "edited_by"), F.struct("ts", "seq", "action")).alias("r")
    return actions.filter("allowed").groupBy("doc_id").agg(last, F.count("*").alias("actions")).select("doc_id", "r.*", "actions")
