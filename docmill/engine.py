"""Runs over folders of texts or PDFs, the inbox worker, and views over what they wrote.

Every run appends its documents to one Parquet table, ``log``: a record, its gates, its attempts. The commit
of that append is the checkpoint. Job states, summaries, reports and exports are queries over the log, so
nothing else has to be kept in step, and a repeated run or micro-batch skips what the log already has.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .functions import fixed as X
from .functions import structure as S
from .functions import text as T
from .operators import catalog, gates, jobs, metadata, monitor, pages, reports
from .operators.answers import Answers
from .operators.summarize import FED, Summarizer, described, summarize, with_key
from .sources import files
from .sources.schemas import ABSTRACT
from .streaming import inbox, run_always, run_once

FAILURES = "array<struct<gate:string,detail:string,severity:string>>"
LOG = (
    "key string, doc_id string, run_id string, state string, attempts int, calls int, error string, seconds double, idioma_principal string, tipo_documento string, "
    f"plantilla string, secciones map<string,string>, idiomas_resumo_origem array<string>, abstracts_origem array<{ABSTRACT}>, pages int, text_chars int, "
    f"source_kind string, failures {FAILURES}, transcript_failures {FAILURES}, fed {FED}, finished_at timestamp"
)
TRANSCRIPTS = (
    "meta_version string, pipeline_version string, legacy boolean, doc_id string, pdf_sha256 string, pages int, source_kind string, lang_ocr string, paginas_vlm bigint, "
    f"paginas_vacias bigint, paginas_vlm_rechazado bigint, conf_media double, text string, failures {FAILURES}, at timestamp"
)
STARTED = "key string, doc_id string, run_id string, at timestamp"
EVENTS = "timestamp timestamp, run_id string, event string, doc_id string, phase string, seconds double"
#: Takes PDFs (doc_id, content), gives pages (doc_id, page, source, text, conf, words, chars, vlm_rejected).
Transcriber = Callable[[DataFrame], DataFrame]


def blank_pages(pdfs: DataFrame) -> DataFrame:
    """Transcriber for dry runs: one native page that names its document."""
    return pdfs.selectExpr(
        "doc_id", "1 AS page", "'nativo' AS source", "concat('Texto de ', doc_id) AS text", "cast(null AS double) AS conf", "cast(null AS bigint) AS words", "cast(9 + length(doc_id) AS int) AS chars", "false AS vlm_rejected"
    )


def summary_records(
    docs: DataFrame, factory: Callable[[], Summarizer], strategy: str = "excerpt", max_chars: int = X.MAX_CHARS, retries: int = 0,
    answers: Answers | None = None, lang: str | None = None, doc_type: str | None = None,
) -> DataFrame:
    """Result records of docs (doc_id, text, pages, further columns) with their gates; failed documents have an error and no sections.

    One record for each row: rows that repeat id, text and pages share one answer, rows with a null or repeated id and another text have their own.
    ``lang`` and ``doc_type`` hold for all documents where they are given. Texts stay out of the join with the answers: what is taken
    from them is extracted before it.
    """
    docs = with_key(docs)
    found = S.abstracts(F.col("text")).cast(f"array<{ABSTRACT}>")
    facts = described(docs, lang, doc_type).withColumn("abstracts_origem", found).withColumn("text_chars", F.length("text")).drop("text")
    made = facts.join(summarize(docs, factory, strategy, max_chars, retries, answers, lang, doc_type).drop("doc_id"), "row_key")
    langs = F.array_distinct(F.transform("abstracts_origem", lambda a: a["lang"]))
    r = made.withColumnsRenamed({"lang": "idioma_principal", "tipo": "tipo_documento", "template": "plantilla", "sections": "secciones"}).withColumn("idiomas_resumo_origem", langs)
    judged = gates.result_gates(F.col("secciones"), F.col("plantilla"), F.col("idioma_principal"), F.col("idiomas_resumo_origem"), langs)
    return r.withColumn("failures", F.when(F.col("error").isNull(), judged).cast(FAILURES)).withColumn("state", F.when(F.col("error").isNull(), "done").otherwise("failed"))


class Engine:
    """The runs of one output folder.

    ``factory`` builds the summariser on executors; ``max_retries`` further tries follow a failed model call. At the
    ends of each phase, ``probes`` tasks measure the workers that run them. ``model`` names what the summariser asks: its answers are
    kept under that name and used again. ``lang`` and ``doc_type`` hold for all documents where they are given.
    """

    def __init__(
        self, spark: SparkSession, out_dir: str, factory: Callable[[], Summarizer], strategy: str = "excerpt", max_chars: int = X.MAX_CHARS, max_retries: int = 2,
        probes: int = 1, model: str = "", lang: str | None = None, doc_type: str | None = None,
    ):
        self.probes, self.lang, self.doc_type = probes, lang, doc_type
        self.answers = Answers(spark, f"{out_dir.rstrip('/')}/answers", model)
        self.spark, self.out, self.factory = spark, out_dir.rstrip("/"), factory
        self.strategy, self.max_chars, self.max_retries = strategy, max_chars, max_retries
        for name, schema in (("log", LOG), ("transcripts", TRANSCRIPTS), ("events", EVENTS), ("samples", monitor.SAMPLE), ("started", STARTED)):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.out}/{name}")

    # Runs

    def run(self, docs: DataFrame) -> str:
        """Process docs (doc_id, text, pages, and source_kind, transcript_failures where known) whose job is neither done nor exhausted; the run's id."""
        run_id = str(uuid.uuid4())
        with self._phase(run_id, "resumen"):
            self._summarize(docs, run_id)
        return run_id

    def _summarize(self, docs: DataFrame, run_id: str) -> None:
        for name, kind in (("source_kind", "string"), ("transcript_failures", FAILURES)):
            if name not in docs.columns:
                docs = docs.withColumn(name, F.lit(None).cast(kind))
        text = F.coalesce("text", F.lit(""))
        keyed = docs.withColumn("text", text).withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("key", T.job_key(F.col("doc_id"), F.col("text")))
        # one row for each job: a key names an id and a text
        todo = keyed.join(self.log().select("key").distinct(), "key", "left_anti").dropDuplicates(["key"])
        todo.select("key", "doc_id", F.lit(run_id).alias("run_id"), F.current_timestamp().alias("at")).write.mode("append").parquet(f"{self.out}/started")
        made = summary_records(todo, self.factory, self.strategy, self.max_chars, self.max_retries, self.answers, self.lang, self.doc_type)
        self._append(made.withColumn("run_id", F.lit(run_id)).withColumn("finished_at", F.current_timestamp()))
        self.answers.tidy()

    def _append(self, made: DataFrame) -> None:
        """Rows with some of the log's columns; the others are null."""
        schema = self.spark.createDataFrame([], LOG).schema
        made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(f"{self.out}/log")

    def _mark(self, run_id: str, event: str, phase: str | None = None, seconds: float | None = None) -> None:
        self.spark.createDataFrame([(datetime.now(timezone.utc), run_id, event, None, phase, seconds)], EVENTS).write.mode("append").parquet(f"{self.out}/events")

    @contextmanager
    def _phase(self, run_id: str, phase: str) -> Iterator[None]:
        """Events of a run's phase: run_started, then phase and run_completed with its seconds, or run_interrupted."""
        self._mark(run_id, "run_started", phase)
        self._sample(run_id)
        began = time.monotonic()
        try:
            yield
        except BaseException:
            self._mark(run_id, "run_interrupted", phase, time.monotonic() - began)
            raise
        self._mark(run_id, "phase", phase, time.monotonic() - began)
        self._sample(run_id)
        self._mark(run_id, "run_completed", phase)

    def _sample(self, run_id: str) -> None:
        monitor.sample(self.spark, run_id, self.probes).write.mode("append").parquet(f"{self.out}/samples")

    def texts(self, in_dir: str) -> str:
        """One run over the .txt files of a folder."""
        return self.run(files.text_documents(self.spark, in_dir).withColumn("pages", T.inferred_pages(F.col("text")).cast("int")))

    def pdfs(self, found: DataFrame, transcribe: Transcriber, lang: str = "por+eng+spa", again: bool = False) -> str:
        """One run over PDFs (doc_id, content, pdf_sha256): cached transcripts are reused while they are valid."""
        return self.run(self.transcribed(found, transcribe, lang, again).select("doc_id", "text", "pages", "source_kind", F.col("failures").alias("transcript_failures")))

    def transcribed(self, found: DataFrame, transcribe: Transcriber, lang: str = "por+eng+spa", again: bool = False) -> DataFrame:
        """The transcripts of PDFs (doc_id, content, pdf_sha256), made where no valid one is cached."""
        keys = found.select("doc_id", F.col("pdf_sha256").alias("sha"), F.lit(again).alias("retranscribe"))
        meta = self.transcripts().select("doc_id", F.lit(True).alias("cached"), F.lit(True).alias("readable"), "legacy", "pipeline_version", "pdf_sha256")
        fresh = jobs.cache_decision(keys, meta, "doc_id").filter("decision in ('transcribe', 'forced', 'stale')").select("doc_id")
        with self._phase(str(uuid.uuid4()), "transcripcion"):
            self._transcribe(found.join(fresh, "doc_id", "left_semi"), transcribe, lang)
        return self.transcripts().join(found.select("doc_id"), "doc_id", "left_semi")

    def _transcribe(self, pdfs: DataFrame, transcribe: Transcriber, lang: str) -> None:
        # The engines run once: their pages are a table before quality, text and gates are taken from it.
        store = f"{self.out}/pages/{uuid.uuid4()}"
        transcribe(pdfs.select("doc_id", "content")).write.parquet(store)
        page = self.spark.read.parquet(store)
        native = F.when(F.col("source") == "nativo", "nativo").otherwise("ocr")
        kind = page.groupBy("doc_id").agg(T.combined_source(F.collect_list(native)).alias("source_kind"))
        meta = metadata.ocr_meta(pdfs.select("doc_id", "pdf_sha256").join(kind, "doc_id"), page, lang)
        details = page.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "source", "conf", "words", "chars", "vlm_rejected"))).alias("pages_detail"))
        full = meta.join(pages.assemble_pages(page, "doc_id", marked=True), "doc_id").join(details, "doc_id")
        judged = gates.transcript_gates(F.col("text"), self._gate_meta()).cast(FAILURES)
        rows = full.withColumn("failures", judged).withColumn("at", F.current_timestamp())
        schema = self.spark.createDataFrame([], TRANSCRIPTS).schema
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(f"{self.out}/transcripts")

    @staticmethod
    def _gate_meta() -> Column:
        rejected = F.transform(F.filter("pages_detail", lambda p: p["vlm_rejected"]), lambda p: p["page"])
        return F.struct("pages_detail", "conf_media", F.size(rejected).alias("vlm_rejected"), F.lit(False).alias("legacy"))

    def watch(self, box: str, transcribe: Transcriber, checkpoint: str, max_bytes: int = files.UPLOAD_LIMIT, every: float | None = None) -> StreamingQuery | None:
        """Process the PDFs that came into ``box`` since the last call; files that are too large or no PDF get a job in the state ``rejected``.

        With ``every``, go on looking each so many seconds, until the returned query is stopped.
        """

        def work(batch: DataFrame, _: int) -> None:
            named = batch.select(T.safe_stem(F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.[^.]*$", "")).alias("stem"), "length", "content")
            screened = files.screen_uploads(named, max_bytes).withColumn("doc_id", F.concat_ws("-", "stem", "content_id"))
            reason = F.when(F.col("status") == 413, F.concat(F.lit("larger than "), F.lit(max_bytes), F.lit(" bytes: "), "length")).otherwise("no PDF")
            bad = screened.filter("status <> 202").select(F.concat_ws(":", "doc_id", "content_id").alias("key"), "doc_id", F.lit("rejected").alias("state"), reason.alias("error"), F.current_timestamp().alias("finished_at"))
            self._append(bad.join(self.log().select("key").distinct(), "key", "left_anti").dropDuplicates(["key"]))
            self.pdfs(screened.filter("status = 202").select("doc_id", "content", F.sha2("content", 256).alias("pdf_sha256")).dropDuplicates(["doc_id"]), transcribe)

        if every is not None:
            return run_always(inbox(self.spark, box), work, checkpoint, every)
        run_once(inbox(self.spark, box), work, checkpoint)
        return None

    # Views

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.out}/log")

    def transcripts(self) -> DataFrame:
        """The latest transcript of each document, one for each id; of one run's, that with the largest digest."""
        every = self.spark.read.schema(TRANSCRIPTS).parquet(f"{self.out}/transcripts")
        last = every.groupBy("doc_id").agg(F.max(F.struct("at", "pdf_sha256")).alias("last")).select("doc_id", "last.*")
        return every.join(last, ["doc_id", "at", "pdf_sha256"], "left_semi").dropDuplicates(["doc_id"])

    def jobs(self) -> DataFrame:
        """(key, doc_id, state, attempts, error, at) of every job; one that has no record yet is running, or its run broke off and the next takes it up."""
        ended = self.log().select("key", "doc_id", "state", "attempts", "error", F.col("finished_at").alias("at"))
        started = self.spark.read.schema(STARTED).parquet(f"{self.out}/started").groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max("at").alias("at"))
        running = started.join(ended.select("key"), "key", "left_anti").select("key", "doc_id", F.lit("running").alias("state"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("error"), "at")
        return ended.unionByName(running)

    def health(self) -> DataFrame:
        return jobs.counts(self.jobs())

    def summaries(self) -> DataFrame:
        """The latest done record of each document, with qa_ok."""
        done = self.log().filter("state = 'done'")
        last = done.groupBy("doc_id").agg(F.max_by("key", F.struct("finished_at", "key")).alias("key"))
        ok = lambda c: F.coalesce(gates.no_errors(F.col(c)), F.lit(True))
        return done.join(last, ["doc_id", "key"], "left_semi").withColumn("qa_ok", ok("failures")).withColumn("transcript_ok", ok("transcript_failures"))

    def summary(self, doc_id: str) -> DataFrame:
        return self.summaries().filter(F.col("doc_id") == doc_id)

    def progress(self, run_id: str, discovered: int) -> DataFrame:
        """One row: documents found, processed, completed, failed and remaining, and the run's status."""
        n = F.count("*")
        failed = F.count_if(F.col("state") == "failed")
        return self.log().filter((F.col("run_id") == run_id) & (F.col("state") != "rejected")).agg(
            F.lit(discovered).cast("bigint").alias("discovered"), n.alias("processed"), (n - failed).alias("completed"), failed.alias("failed"),
            F.greatest(F.lit(0), F.lit(discovered) - n).alias("remaining"), F.when(failed > 0, "completed_with_errors").otherwise("completed").alias("status"),
        )

    def _items(self) -> DataFrame:
        return self.summaries().select(F.col("tipo_documento").alias("tipo"), F.col("idioma_principal").alias("idioma"), "seconds", "failures")

    def metrics(self) -> DataFrame:
        return reports.batch_metrics(self._items())

    def gate_counts(self) -> DataFrame:
        return reports.failed_gates(self._items())

    def events(self) -> DataFrame:
        """(timestamp, run_id, event, doc_id, phase, seconds): what happened to each run, its phases and each document."""
        name = F.when(F.col("state") == "done", "document_completed").when(F.col("state") == "rejected", "document_rejected").otherwise("document_failed")
        runs = self.spark.read.schema(EVENTS).parquet(f"{self.out}/events")
        return runs.unionByName(self.log().select(F.col("finished_at").alias("timestamp"), "run_id", name.alias("event"), "doc_id", F.lit("resumen").alias("phase"), "seconds"))

    def infrastructure(self) -> DataFrame:
        """One row for each run: what its workers used."""
        return monitor.run_summary(self.spark.read.schema(monitor.SAMPLE).parquet(f"{self.out}/samples"))

    def phase_times(self) -> DataFrame:
        """(phase, tiempo_total, tiempo_medio) of the documents: seconds of the model's calls."""
        return reports.phase_times(self.events().filter("doc_id is not null"), F.count("*"))

    # Exports

    def _results(self) -> DataFrame:
        return self.summaries().select(
            "doc_id", F.col("idioma_principal").alias("idioma"), F.col("tipo_documento").alias("tipo"), "plantilla", F.col("secciones").alias("sections"), F.col("abstracts_origem").alias("abstracts"), "pages"
        )

    def records(self) -> DataFrame:
        """The latest summary of each document, its gates under _qa."""
        qa = F.struct(F.col("qa_ok").alias("ok"), "failures")
        meta = F.struct("pages", "text_chars", *[F.col(f"fed.{c}").alias(f"excerpt_{c}") for c in ("strategy", "parts", "truncated", "chars")])
        kept = ["doc_id", "idioma_principal", "tipo_documento", "plantilla", "secciones", "idiomas_resumo_origem", "abstracts_origem"]
        return self.summaries().select(F.lit(X.CONTRACT_VERSION).alias("contract_version"), *kept, meta.alias("meta"), qa.alias("_qa"))

    def export_records(self, path: str) -> None:
        """One JSON line for each summary."""
        files.write_records(self.records(), path)

    def export_lilacs(self, path: str) -> None:
        """The records as one JSON array in the file ``path``."""
        files.write_json_file(catalog.lilacs(self._results()).select("record.*"), path)

    def export_bibframe(self, path: str, pdf: DataFrame) -> DataFrame:
        """Write the records, merged with PDF metadata (see sources.pdf_info); (doc_id, motivo) of the documents without one."""
        made = catalog.bibframe(catalog.merge_sources(self._results(), pdf.withColumnRenamed("pages", "pdf_pages")))
        made.filter("record is not null").select(F.col("record").alias("value")).write.text(path)
        return made.filter("record is null").select("doc_id", "motivo")
