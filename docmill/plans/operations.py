"""Queries over events, orders and line items in the roles of pages, jobs, reviews, samples and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import engine, streaming
from ..functions import fixed as X
from ..functions.text import route_ocr
from ..places import scratch
from ..operators import catalog, environment, gates, jobs, matching, metadata, monitor, ocr, regions, reports, summarize
from . import derive as D
from .documents import BEST, HITS, TOKENS, docs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tsv(spark, sf_dir):
    """(page, tsv): word tables as an OCR engine writes them, built from line items."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    cells = ["5", "1", (F.col("l_partkey") % 2).cast("string"), "0", (F.col("l_linenumber") % 3).cast("string"), F.col("l_linenumber").cast("string"), "0", "0", "0", "0", (F.col("l_quantity") * 2 - 10).cast("string"), F.concat(F.lit("w"), F.col("l_partkey").cast("string"))]
    row = F.concat_ws("\t", *[F.lit(c) if isinstance(c, str) else c for c in cells])
    rows = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", row.alias("row")))), lambda x: x["row"])
    return li.groupBy(F.col("l_orderkey").alias("page")).agg(F.concat(F.lit("\t".join(ocr.FIELDS) + "\n"), F.array_join(rows, "\n")).alias("tsv"))


def tsv_confidence(spark, sf_dir):
    pages = _tsv(spark, sf_dir)
    found = pages.select("page").join(ocr.confidence(ocr.tsv_words(pages, "page", "tsv"), "page"), "page", "left")
    conf, words = F.coalesce("conf", F.lit(0.0)), F.coalesce("words", F.lit(0))
    return found.select("page", conf.alias("conf"), words.cast("long").alias("words"), route_ocr(conf, words).alias("route"))


TSV_SQL = """WITH w AS (SELECT l_orderkey AS page, l_partkey % 2 AS block, l_linenumber % 3 AS line, l_linenumber AS pos, l_partkey AS part, l_quantity AS q, l_quantity * 2 - 10 AS conf, 'w' || l_partkey AS word FROM lineitem) """


def tsv_lines(spark, sf_dir):
    return ocr.text_lines(ocr.tsv_words(_tsv(spark, sf_dir), "page", "tsv"), "page")


def _page_details(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("doc_id"),
        F.when(F.col("l_returnflag") == "R", "vlm").otherwise("tesseract").alias("source"),
        F.when(F.col("l_linenumber") % 5 != 0, 100 * (1 - F.col("l_discount"))).alias("conf"),
        F.col("l_quantity").cast("long").alias("words"),
        F.when(F.col("l_linenumber") % 4 == 0, F.lit(0)).when(F.col("l_linenumber") % 4 == 1, F.col("l_quantity").cast("int")).alias("chars"),
        (F.col("l_returnflag") == "A").alias("vlm_rejected"),
    )


def ocr_quality(spark, sf_dir):
    return reports.ocr_quality(_page_details(spark, sf_dir), "doc_id")


OCR_SQL = """WITH p AS (SELECT l_orderkey AS doc_id, l_returnflag AS f, l_linenumber AS n, CASE WHEN l_linenumber % 5 <> 0 THEN 100 * (1 - l_discount) END AS conf, CAST(l_quantity AS BIGINT) AS words FROM lineitem),
 q AS (SELECT doc_id, count(*) FILTER (WHERE f = 'R') AS paginas_vlm, count(*) FILTER (WHERE n % 4 = 0 OR (n % 4 = 1 AND words = 0)) AS paginas_vacias, count(*) FILTER (WHERE f = 'A') AS paginas_vlm_rechazado,
 round(sum(conf * words) / nullif(sum(words) FILTER (WHERE conf IS NOT NULL), 0), 2) AS conf_media FROM p GROUP BY doc_id) """


def transcript_quality(spark, sf_dir):
    q = ocr_quality(spark, sf_dir)
    gates = F.filter(F.array(F.when(F.col("paginas_vacias") > 0, "paginas"), F.when(F.col("conf_media") < 94.0, "conf_baja")), lambda g: g.isNotNull())
    return reports.transcription_summary(q.withColumn("gates", gates).withColumn("passed", F.col("paginas_vacias") < 2).withColumn("legacy", F.col("doc_id") % 7 == 0))


def cache_decision(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("sha"), (F.col("doc_id") % 10 == 9).alias("retranscribe"))
    k = F.col("doc_id") % 8
    meta = d.filter(k != 0).select("doc_id", F.lit(True).alias("cached"), (k != 1).alias("readable"), k.isin(2, 3).alias("legacy"), F.when(k == 4, "2").when(~k.isin(2, 3), "3").alias("pipeline_version"), F.when(k.isin(3, 5), "old").otherwise(F.col("sha")).alias("pdf_sha256"))
    return jobs.cache_decision(d, meta, "doc_id").groupBy("decision").agg(F.count("*").alias("n"))


CACHE_SQL = """SELECT CASE WHEN doc_id % 8 = 0 THEN 'transcribe' WHEN doc_id % 10 = 9 THEN 'forced' WHEN doc_id % 8 IN (6, 7) THEN 'reuse' WHEN doc_id % 8 = 1 THEN 'legacy_unreadable'
 WHEN doc_id % 8 = 2 THEN 'legacy_same' ELSE 'stale' END AS decision, count(*) AS n FROM documents GROUP BY 1"""


def skip_done(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    states = o.select("key", F.when(F.col("o_orderstatus") == "F", "done").otherwise("failed").alias("state"))
    return jobs.pending(o.select("key"), states)


def _attempts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("n")).agg(F.bool_or(F.col("l_quantity") > 40).alias("ok"))


def job_counts(spark, sf_dir):
    return jobs.counts(jobs.job_states(_attempts(spark, sf_dir)))


JOB_SQL = """WITH a AS (SELECT l_orderkey AS key, l_linenumber AS n, bool_or(l_quantity > 40) AS ok FROM lineitem GROUP BY ALL), s AS (SELECT key, bool_or(ok) AS won FROM a WHERE n <= 3 GROUP BY key)
 SELECT CASE WHEN won THEN 'done' ELSE 'failed' END AS state, count(*) AS n FROM s GROUP BY 1"""


def _job_events(lines):
    """Line items as attempts of their order's job: each starts, large ones succeed, middling ones fail."""
    kind = F.array_compact(F.array(F.lit("started"), F.when(F.col("l_quantity") > 40, "succeeded").when(F.col("l_quantity") > 10, "failed")))
    at = F.timestamp_seconds(F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber"))
    return lines.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("n"), F.explode(kind).alias("kind"), at.alias("at"), F.concat(F.lit("E"), F.col("l_partkey").cast("string")).alias("error"))


def _streamed(spark, sf_dir, name):
    """A table as a stream of its files; a pattern, as a stream takes a single file only by one."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def job_states(spark, sf_dir):
    """Each job's last state, kept in the state store of a stream over all line items."""
    stream = _streamed(spark, sf_dir, "lineitem")
    place = scratch(spark, "jobs")
    streaming.keep_jobs(streaming.job_changes(_job_events(stream)), f"{place}/changes", f"{place}/checkpoint").awaitTermination()
    return streaming.latest_jobs(spark, f"{place}/changes")


JOB_STATES_SQL = """WITH a AS (SELECT CAST(l_orderkey AS VARCHAR) AS key, l_linenumber AS n, l_quantity AS q, 'E' || l_partkey AS e FROM lineitem WHERE l_linenumber BETWEEN 1 AND 3),
 s AS (SELECT key, min(n) FILTER (WHERE q > 40) AS won, max(n) AS last, max((n, e)) FILTER (WHERE q > 10 AND q <= 40) AS f FROM a GROUP BY key),
 k AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS key FROM lineitem)
 SELECT key, CASE WHEN won IS NOT NULL THEN 'done' WHEN f[1] = last THEN 'failed' WHEN last IS NOT NULL THEN 'running' ELSE 'pending' END AS state, CAST(coalesce(won, last, 0) AS INT) AS attempts,
  CASE WHEN won IS NULL AND f[1] = last THEN f[2] END AS error, coalesce(won IS NULL AND f[1] = last AND last >= 3, false) AS exhausted FROM k LEFT JOIN s USING (key)"""


def review_state(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    action = F.when(F.col("event_type") == "purchase", "approved").when(F.col("event_type") == "error", "rejected").when(F.col("event_type") == "signup", "edited")
    rows = e.select(F.col("user_id").alias("doc_id"), action.alias("action"), F.concat(F.lit("r"), (F.col("event_id") % 3).cast("string")).alias("reviewer"), F.lit("n").alias("note"), "ts", F.col("event_id").alias("seq"), (F.col("event_id") % 5 == 0).alias("force"), F.when(F.col("event_id") % 2 == 0, F.array(F.lit("schema"))).otherwise(F.array().cast("array<string>")).alias("errors"))
    return jobs.review_state(rows.filter("action is not null"))


REVIEW_SQL = """WITH e AS (SELECT user_id AS doc_id, ts, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' WHEN 'signup' THEN 'edited' END AS state, 'r' || event_id % 3 AS reviewer, event_id % 2 = 0 AS err, event_id % 5 = 0 AS force FROM events),
 k AS (SELECT *, CASE WHEN state = 'approved' AND err AND force THEN 'n [FORZADO pese a: schema]' ELSE 'n' END AS note FROM e WHERE state IS NOT NULL AND (state <> 'approved' OR NOT err OR force))
 SELECT doc_id, arg_max(state, (ts, seq)) AS state, arg_max(reviewer, (ts, seq)) AS reviewer, arg_max(note, (ts, seq)) AS note, count(*) AS actions FROM k GROUP BY doc_id"""


def _items(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang AS idioma", f"{D.TYPE} AS tipo", "n_chars / 1000.0 AS seconds")
    fail = lambda g, n: F.when(F.col("doc_id") % n == 0, F.struct(F.lit(g).alias("gate")))
    return d.withColumn("failures", F.filter(F.array(fail("schema", 6), fail("schema", 12), fail("lang", 9)), lambda f: f.isNotNull()))


def batch_metrics(spark, sf_dir):
    return reports.batch_metrics(_items(spark, sf_dir)).drop("level")


def failed_gates(spark, sf_dir):
    return reports.failed_gates(_items(spark, sf_dir))


BATCH_SQL = f"""WITH i AS (SELECT lang AS idioma, {D.TYPE} AS tipo, n_chars / 1000.0 AS seconds, doc_id % 6 <> 0 AND doc_id % 9 <> 0 AS ok FROM documents)
 SELECT tipo, idioma, count(*) AS total, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS con_fallos, round(CAST(sum(seconds) AS DOUBLE), 6) AS tiempo_total, round(CAST(avg(seconds) AS DOUBLE), 6) AS tiempo_medio FROM i GROUP BY GROUPING SETS ((tipo), (idioma), ())"""


def phase_times(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("phase"), F.round("value", 3).cast("decimal(18,3)").alias("seconds"), "user_id")
    total = e.agg(F.countDistinct("user_id").alias("documents"))
    return reports.phase_times(e.withColumn("one", F.lit(1)).join(F.broadcast(total.withColumn("one", F.lit(1))), "one"), F.max("documents")).select("phase", F.col("tiempo_total").cast("double"), F.col("tiempo_medio").cast("double"))


PHASE_SQL = "SELECT event_type AS phase, round(CAST(sum(CAST(round(value, 3) AS DECIMAL(18,3))) AS DOUBLE), 6) AS tiempo_total, round(CAST(sum(CAST(round(value, 3) AS DECIMAL(18,3))) AS DOUBLE) / (SELECT count(DISTINCT user_id) FROM events), 6) AS tiempo_medio FROM events GROUP BY 1"


def infra_summary(spark, sf_dir):
    return reports.series_summary(table(spark, sf_dir, "events"), ["event_type"], "value").withColumn("mean", F.round("mean", 4))


INFRA_SQL = "SELECT event_type, count(value) AS n, round(min(value), 6) AS low, round(max(value), 6) AS high, round(round(avg(value), 6), 4) AS mean, round(quantile_disc(value, 0.95), 6) AS p95, round(arg_max(value, (ts, event_id)), 6) AS last FROM events GROUP BY 1"


def cpu_delta(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return reports.rate(e, "user_id", ["ts", "event_id"], "value", "ts").select("event_id", "percent")


CPU_SQL = """WITH d AS (SELECT event_id, value - lag(value) OVER w AS grown, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS gone FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
 SELECT event_id, CASE WHEN gone > 0 THEN round(grown * 100.0 / (gone / 1e6), 6) END AS percent FROM d"""


def asof_context(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    contexts = e.filter("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max("event_id").alias("context"))
    return reports.asof_context(e.filter("event_type <> 'signup'").select("event_id", "user_id", "ts"), contexts, "user_id", "ts", "context").select("event_id", "context")


ASOF_SQL = """WITH c AS (SELECT user_id, ts, max(event_id) AS context FROM events WHERE event_type = 'signup' GROUP BY ALL), s AS (SELECT * FROM events WHERE event_type <> 'signup')
 SELECT s.event_id, c.context FROM s ASOF LEFT JOIN c ON s.user_id = c.user_id AND s.ts >= c.ts"""


def lilacs(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang AS idioma", "text", f"{D.TYPE} AS tipo").withColumn("plantilla", F.when(F.col("tipo") == "articulo", "A").when(F.col("tipo") == "manual", "B").otherwise("C"))
    sections = F.create_map(F.lit("titulo"), F.col("text"), F.lit("objetivo"), F.lit(" obj "), F.lit("terminos"), F.concat(F.lit("a; b.,, "), "idioma"))
    r = d.withColumn("sections", sections).withColumn("abstracts", F.array(F.struct(F.col("idioma").alias("lang"), F.lit("x").alias("text")), F.struct(F.lit("en").alias("lang"), F.lit("y").alias("text"))))
    lil = catalog.lilacs(r).select("doc_id", "record.lilacs")
    return lil.select("doc_id", F.col("lilacs.05_tipo_documento").alias("doctype"), "lilacs.titulo", F.array_join("lilacs.descritores_candidatos", "|").alias("terms"), F.array_join("lilacs.idiomas_resumo_origem", ",").alias("langs"), F.array_join(F.transform("lilacs.resumos", lambda a: F.concat_ws(":", a["lang"], a["source"], a["text"])), "|").alias("resumos"))


LILACS_SQL = rf"""WITH d AS (SELECT *, {D.TYPE} AS tipo FROM documents) SELECT doc_id, CASE tipo WHEN 'articulo' THEN 'S' ELSE 'M' END AS doctype, regexp_replace(text, '^\s+|\s+$', '', 'g') AS titulo,
 CASE tipo WHEN 'articulo' THEN '' ELSE 'a|b|' || lang END AS terms, CASE lang WHEN 'en' THEN 'en' ELSE lang || ',en' END AS langs,
 lang || ':generated:' || CASE tipo WHEN 'articulo' THEN 'obj' ELSE '' END || '|' || lang || ':origin:x|en:origin:y' AS resumos FROM d"""


def _bib(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang AS idioma", "text", "'C' AS plantilla", "CAST(doc_id % 9 AS INT) AS pages")
    sections = F.create_map(F.lit("titulo"), F.when(F.col("doc_id") % 6 == 0, F.lit(" ")).otherwise(F.col("text")), F.lit("autores"), F.lit("Ana e Luis; Eva"), F.lit("entidad"), F.when(F.col("doc_id") % 2 == 0, "No se especifica").otherwise("OPS"), F.lit("terminos"), F.lit("- uno\n• dos\n"))
    pdf = d.filter("doc_id % 3 = 0").select("doc_id", F.when(F.col("doc_id") % 12 != 0, F.concat(F.lit("Libro "), F.col("doc_id").cast("string"))).alias("title"), F.lit("Parte").alias("subject"), F.lit("Ivo and Bia").alias("author"), F.lit("x; z").alias("keywords"), F.lit("Tue Mar 6 2012").alias("creation_date"), F.lit(7).alias("pdf_pages"))
    return catalog.merge_sources(d.withColumn("sections", sections), pdf)


def bib_merge(spark, sf_dir):
    b = _bib(spark, sf_dir)
    return b.select("doc_id", "title", "src_title", "section_title", "src_section_title", F.array_join("authors", "|").alias("authors"), "src_authors", "publisher", "date", "pages", F.array_join("subjects", "|").alias("subjects"), "src_subjects")


BIB_SQL = r"""WITH d AS (SELECT doc_id, doc_id % 3 = 0 AS pdf, doc_id % 3 = 0 AND doc_id % 12 <> 0 AS pt, CASE WHEN doc_id % 6 = 0 THEN '' ELSE regexp_replace(text, '^\s+|\s+$', '', 'g') END AS own FROM documents)
 SELECT doc_id, CASE WHEN pt THEN 'Libro ' || doc_id ELSE own END AS title, CASE WHEN pt THEN 'pdf_metadata' WHEN own <> '' THEN 'summary' END AS src_title, CASE WHEN pdf THEN 'Parte' ELSE '' END AS section_title, CASE WHEN pdf THEN 'pdf_metadata' END AS src_section_title,
 CASE WHEN pdf THEN 'Ivo|Bia' ELSE 'Ana|Luis|Eva' END AS authors, CASE WHEN pdf THEN 'pdf_metadata' ELSE 'summary' END AS src_authors, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'OPS' END AS publisher, CASE WHEN pdf THEN '2012' ELSE '' END AS date,
 CASE WHEN pdf THEN 7 ELSE CAST(doc_id % 9 AS INT) END AS pages, CASE WHEN pdf THEN 'x|z' ELSE 'uno|dos' END AS subjects, CASE WHEN pdf THEN 'pdf_metadata' ELSE 'summary' END AS src_subjects FROM d"""


def bibframe(spark, sf_dir):
    b = catalog.bibframe(_bib(spark, sf_dir))
    title = F.get_json_object("record", "$.work[0]['bf:title']")
    return b.select("doc_id", "motivo", title.alias("title"), F.get_json_object("record", "$.instance[0]['bf:publisher']").alias("publisher"), F.get_json_object("record", "$.work[0]['bf:language']").alias("language"))


BIBFRAME_SQL = r"""WITH d AS (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 AND doc_id % 12 <> 0 THEN 'Libro ' || doc_id WHEN doc_id % 6 = 0 THEN '' ELSE regexp_replace(text, '^\s+|\s+$', '', 'g') END AS t FROM documents)
 SELECT doc_id, CASE WHEN t = '' THEN 'sin título' END AS motivo, nullif(t, '') AS title, CASE WHEN t <> '' AND doc_id % 2 = 1 THEN 'OPS' END AS publisher, CASE WHEN t <> '' THEN CASE lang WHEN 'es' THEN 'spa' WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fre' END END AS language FROM d"""


def _regions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    left, top = (F.col("l_partkey") % 120).cast("int"), (F.col("l_suppkey") * 7 % 90).cast("int")
    return li.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("ord"), left.alias("left"), top.alias("top"), (left + F.col("l_quantity").cast("int")).alias("right"), (top + (F.col("l_partkey") % 50).cast("int")).alias("bottom"), "l_extendedprice")


REGIONS_SQL = """WITH b AS (SELECT l_orderkey AS page, l_linenumber AS ord, l_extendedprice AS price, CAST(l_partkey % 120 AS INT) AS "left", CAST(l_suppkey * 7 % 90 AS INT) AS top, CAST(l_quantity AS INT) AS w, CAST(l_partkey % 50 AS INT) AS h FROM lineitem),
 r AS (SELECT page, ord, price, "left", top, "left" + w AS "right", top + h AS bottom FROM b) """


def region_valid(spark, sf_dir):
    v = regions.valid_regions(_regions(spark, sf_dir), "page", "ord", F.lit(150), F.lit(110))
    a, b = regions.project(F.col("left"), F.col("right"), F.lit(800), F.lit(150), 6)
    return v.select("page", "left", "top", "right", "bottom", a.cast("int").alias("full_left"), b.cast("int").alias("full_right"))


def reading_order(spark, sf_dir):
    boxes = _regions(spark, sf_dir).select("page", "left", "top", "right", "bottom").distinct()
    r = regions.reading_order(boxes, "page")
    return r.select("page", F.array_join(F.transform("regions", lambda x: F.concat_ws(":", x["left"], x["top"])), ",").alias("order"))


ORDER_SQL = (
    REGIONS_SQL.replace("WITH b", "WITH RECURSIVE b")
    + """, s AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY "left", top, "right", bottom) AS k FROM (SELECT DISTINCT page, "left", top, "right", bottom FROM r)),
 f AS (SELECT page, k, "left", top, "right", bottom, "left" AS anchor, 1 AS col FROM s WHERE k = 1 UNION ALL
 SELECT s.page, s.k, s."left", s.top, s."right", s.bottom, CASE WHEN s."left" - anchor > 20 THEN s."left" ELSE anchor END, CASE WHEN s."left" - anchor > 20 THEN col + 1 ELSE col END
 FROM f JOIN s ON s.page = f.page AND s.k = f.k + 1)
 SELECT page, string_agg("left" || ':' || top, ',' ORDER BY col, top, "left", "right", bottom) AS "order" FROM f GROUP BY page"""
)


def gap_islands(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 500).alias("pos"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("value"))
    cells = e.groupBy("user_id", "pos").agg(F.max("value").alias("value"))
    return regions.zero_runs(cells, "user_id", "pos", "value", 2)


GAPS_SQL = """WITH c AS (SELECT user_id, event_id % 500 AS pos, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS v FROM events GROUP BY ALL), z AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS island FROM c WHERE v = 0)
 SELECT user_id, min(pos) AS start, max(pos) + 1 AS "end" FROM z GROUP BY user_id, island HAVING max(pos) + 1 - min(pos) >= 2"""


def bench_delta(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_returnflag").alias("technique"), F.round(100 * (1 - F.col("l_discount"))).cast("long").alias("conf"), F.col("l_quantity").cast("long").alias("words"), (F.col("l_linenumber") * 10).cast("long").alias("seconds"))
    return reports.compare_techniques(rows, "N")


BENCH_SQL = """WITH a AS (SELECT l_returnflag AS technique, sum(CAST(round(100 * (1 - l_discount)) AS BIGINT) * CAST(l_quantity AS BIGINT)) * 1.0 / sum(CAST(l_quantity AS BIGINT)) AS conf, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS words, sum(l_linenumber * 10) AS seconds FROM lineitem GROUP BY 1), b AS (SELECT * FROM a WHERE technique = 'N')
 SELECT a.technique, a.words, round(a.conf, 4) AS conf, round(a.conf - b.conf, 4) AS d_conf, round((a.words - b.words) * 100.0 / b.words, 4) AS d_words_pct, round(CAST((a.seconds - b.seconds) * 100.0 / b.seconds AS DOUBLE), 4) AS d_seconds_pct FROM a LEFT JOIN b ON true"""

QUERIES = {
    f.__name__: f
    for f in (tsv_confidence, tsv_lines, ocr_quality, transcript_quality, cache_decision, skip_done, job_counts, review_state, batch_metrics, failed_gates, phase_times, infra_summary, cpu_delta, asof_context, lilacs, bib_merge, bibframe, region_valid, reading_order, gap_islands, bench_delta)
}
ORACLE_SQL = {
    "tsv_confidence": TSV_SQL + "SELECT page, round(coalesce(avg(conf) FILTER (WHERE conf >= 0), 0), 6) AS conf, count(*) FILTER (WHERE conf >= 0) AS words, CASE WHEN coalesce(avg(conf) FILTER (WHERE conf >= 0), 0) >= 75 AND count(*) FILTER (WHERE conf >= 0) >= 15 THEN 'tesseract' ELSE 'vlm' END AS route FROM w GROUP BY page",
    "tsv_lines": TSV_SQL + ", l AS (SELECT page, block, line, string_agg(word, ' ' ORDER BY pos, part, q) AS t FROM w WHERE conf >= 0 GROUP BY ALL) SELECT page, string_agg(t, chr(10) ORDER BY block, line) AS text FROM l GROUP BY page",
    "ocr_quality": OCR_SQL + "SELECT * FROM q",
    "transcript_quality": OCR_SQL
    + """SELECT count(*) AS docs_evaluados, count(*) FILTER (WHERE paginas_vacias >= 2) AS docs_con_error, count(*) FILTER (WHERE paginas_vacias > 0 OR conf_media < 94.0) AS docs_con_warnings, count(*) FILTER (WHERE doc_id % 7 = 0) AS docs_legacy,
     CAST(sum(paginas_vlm) AS BIGINT) AS paginas_vlm, CAST(sum(paginas_vacias) AS BIGINT) AS paginas_vacias, round(avg(conf_media), 2) AS conf_media FROM q""",
    "cache_decision": CACHE_SQL,
    "skip_done": "SELECT o_orderkey AS key FROM orders WHERE o_orderstatus <> 'F'",
    "job_counts": JOB_SQL,
    "review_state": REVIEW_SQL,
    "batch_metrics": BATCH_SQL,
    "failed_gates": "SELECT 'schema' AS gate, count(*) FILTER (WHERE doc_id % 6 = 0) + count(*) FILTER (WHERE doc_id % 12 = 0) AS n FROM documents UNION ALL SELECT 'lang', count(*) FILTER (WHERE doc_id % 9 = 0) FROM documents",
    "phase_times": PHASE_SQL,
    "infra_summary": INFRA_SQL,
    "cpu_delta": CPU_SQL,
    "asof_context": ASOF_SQL,
    "lilacs": LILACS_SQL,
    "bib_merge": BIB_SQL,
    "bibframe": BIBFRAME_SQL,
    "region_valid": REGIONS_SQL + """, v AS (SELECT *, row_number() OVER (PARTITION BY page, "left", top, "right", bottom ORDER BY ord) AS nth FROM r WHERE "left" < "right" AND "right" <= 150 AND top < bottom AND bottom <= 110 AND bottom - top >= 20)
      SELECT page, "left", top, "right", bottom, CAST(greatest(0, floor("left" * 800 / 150.0) - 6) AS INT) AS full_left, CAST(least(800, ceil("right" * 800 / 150.0) + 6) AS INT) AS full_right FROM v WHERE nth = 1""",
    "gap_islands": GAPS_SQL,
    "bench_delta": BENCH_SQL,
}


def readiness(spark, sf_dir):
    """Line items as checks of workers (orders): nine names in turn, the first three of them hard."""
    names = [*X.HARD_TOOLS, "tesseract", "ollama", "model:t", "model:vl", "openai_api_key", "tesseract-por"]
    li = table(spark, sf_dir, "lineitem")
    turn = F.col("l_partkey") % 9
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (turn + 1).cast("int"))
    return environment.readiness(li.select(F.col("l_orderkey").alias("host"), name.alias("name"), (F.col("l_quantity") > 10).alias("ok"), (turn < 3).alias("hard")), "host")


READY_SQL = """WITH c AS (SELECT l_orderkey AS host, l_partkey % 9 AS n, l_quantity > 10 AS ok FROM lineitem),
 h AS (SELECT host, coalesce(bool_and(ok) FILTER (WHERE n < 3), true) AS environment_ok, list(DISTINCT n) FILTER (WHERE ok) AS have FROM c GROUP BY host),
 k AS (SELECT host, environment_ok, coalesce(have, []) AS have FROM h)
 SELECT host, environment_ok, list_has_all(have, [0, 1, 2]) AS extraer_nativo, list_has_all(have, [0, 1, 2, 3]) AS ocr_imagen,
 list_contains(have, 7) OR list_has_all(have, [4, 5]) AS resumen, list_has_all(have, [4, 6]) AS ocr_vlm FROM k"""


def throttling(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 3 == 0, " Not Active").when(F.col("event_id") % 3 == 1, "0").otherwise("Active")
    return environment.throttling(e.select(F.col("user_id").alias("gpu"), F.col("event_type").alias("reason"), value.alias("value")), "gpu")


THROTTLE_SQL = """SELECT user_id AS gpu, bool_or(event_id % 3 = 2) AS active, coalesce(array_to_string(list_sort(list(DISTINCT event_type) FILTER (WHERE event_id % 3 = 2)), ','), '') AS reasons
 FROM events GROUP BY user_id"""


def ocr_meta(spark, sf_dir):
    page = _page_details(spark, sf_dir).withColumn("page", F.lit(1))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("pdf_sha256"), F.lit("escaneado").alias("source_kind"))
    return metadata.ocr_meta(o, page, "por")


META_SQL = f"""{OCR_SQL}, n AS (SELECT l_orderkey AS doc_id, CAST(count(*) AS INT) AS pages FROM lineitem GROUP BY 1)
 SELECT '1.0' AS meta_version, '3' AS pipeline_version, false AS legacy, o_orderkey AS doc_id, sha256(CAST(o_orderkey AS VARCHAR)) AS pdf_sha256, coalesce(pages, 0) AS pages, 'escaneado' AS source_kind,
 'por' AS lang_ocr, paginas_vlm, paginas_vacias, paginas_vlm_rechazado, conf_media FROM orders LEFT JOIN q ON q.doc_id = o_orderkey LEFT JOIN n ON n.doc_id = o_orderkey"""


def legacy_meta(spark, sf_dir):
    marked = F.expr("'=== pág 1 ===' || chr(10) || replace(text, chr(10), chr(10) || '=== pág 2 ===' || chr(10))")
    d = docs(spark, sf_dir, "doc_id", "text").select("doc_id", marked.alias("text"), F.sha2("text", 256).alias("pdf_sha256"))
    return metadata.legacy_meta(d).select("doc_id", "legacy", "pages", "pdf_sha256", "source_kind")


LEGACY_SQL = """SELECT doc_id, true AS legacy, CAST(1 + len(text) - len(replace(text, chr(10), '')) AS INT) AS pages, sha256(text) AS pdf_sha256, 'cached' AS source_kind FROM documents"""


def summary_records(spark, sf_dir):
    """Result records of the dry run over all documents, with the number of failed gates."""
    d = docs(spark, sf_dir, "doc_id", "text").withColumn("pages", F.expr(D.PAGES))
    made = engine.summary_records(d, lambda: summarize.first_words, "blocks", 2000)
    return made.select("doc_id", "idioma_principal", "tipo_documento", "plantilla", "calls", "state", "text_chars", F.size("failures").alias("n_failures"), F.element_at("secciones", F.lit("titulo")).alias("titulo"))


def _samples(spark, sf_dir):
    """Events as samples of runs (users): one value in every series, shifted; every third with a device, every fourth with a loaded model."""
    v, n = F.col("value") / 7, F.col("event_id")
    none = F.lit(None)
    process = F.struct(v * 10, F.when(n % 2 == 1, v), n.cast("double"))
    host = F.struct(v + 1, v + 2, v + 3, v + 4, v + 5, F.when(n % 2 == 0, v + 6), v + 7)
    gpu = F.struct((n % 2).cast("int"), none, F.lit("g"), v, v + 1, v + 100, v + 2, v + 3, none, v + 4, none, none, F.lit("P0"), n % 5 == 0, F.when(n % 5 == 0, F.array(F.col("event_type"))))
    model = F.struct(F.col("event_type"), v, n, none, none)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.lit("w").alias("worker"), "ts", process.alias("process"), host.alias("host"),
        F.when(n % 3 == 0, F.array(gpu)).alias("gpus"), F.when(n % 4 == 0, F.struct(F.lit(True), F.lit(False), none, none, F.array(model, model))).alias("ollama"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], monitor.SAMPLE).schema])


def monitor_summary(spark, sf_dir):
    return monitor.run_summary(_samples(spark, sf_dir))


def device_summary(spark, sf_dir):
    found = monitor.device_summary(_samples(spark, sf_dir))
    return found.select("run_id", "id", "index", "throttling_detected", F.array_join("throttling_reasons_seen", ",").alias("reasons"), "utilization_max_percent", "memory_peak_mb", "temperature_max_c", "power_draw_max_w", "fan_speed_max_percent")


def model_summary(spark, sf_dir):
    return monitor.model_summary(_samples(spark, sf_dir)).select("run_id", "model", "vram_peak_mb", "context_length_max")


MONITOR_SQL = """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS run_id, value / 7 AS v, event_id AS n FROM events),
 h AS (SELECT run_id, count(*) AS sample_count, round(max(v * 10), 3) AS process_rss_peak_mb, round(avg(v) FILTER (WHERE n % 2 = 1), 3) AS process_cpu_percent_avg, round(max(v) FILTER (WHERE n % 2 = 1), 3) AS process_cpu_percent_max,
  CASE WHEN count(*) >= 2 THEN CAST(max(n) - min(n) AS DOUBLE) END AS process_cpu_seconds, round(avg(v + 1), 3) AS memory_available_avg_mb, round(min(v + 1), 3) AS memory_available_min_mb, round(min(v + 2), 3) AS swap_free_min_mb,
  round(min(v + 3), 3) AS disk_free_min_gb, round(max(v + 4), 3) AS disk_used_percent_max, round(avg(v + 5), 3) AS load_1m_avg, round(max(v + 5), 3) AS load_1m_max, round(avg(v + 6) FILTER (WHERE n % 2 = 0), 3) AS host_cpu_percent_avg,
  round(max(v + 6) FILTER (WHERE n % 2 = 0), 3) AS host_cpu_percent_max, round(avg(v + 7), 3) AS host_temperature_avg_c, round(quantile_disc(v + 7, 0.95), 3) AS host_temperature_p95_c, round(max(v + 7), 3) AS host_temperature_max_c,
  bool_or(n % 4 = 0) AS ollama_api_available, round(max(v + v) FILTER (WHERE n % 4 = 0), 3) AS ollama_vram_loaded_peak_mb FROM e GROUP BY run_id),
 g AS (SELECT run_id, round(avg(v), 3) AS gpu_utilization_avg_percent, round(quantile_disc(v, 0.95), 3) AS gpu_utilization_p95_percent, round(max(v), 3) AS gpu_utilization_max_percent, round(max(v + 1), 3) AS gpu_memory_peak_mb,
  round(avg(v + 2), 3) AS gpu_temperature_avg_c, round(max(v + 2), 3) AS gpu_temperature_max_c, round(avg(v + 3), 3) AS gpu_power_draw_avg_w, round(max(v + 3), 3) AS gpu_power_draw_max_w, round(max(v + 4), 3) AS gpu_fan_speed_max_percent,
  bool_or(n % 5 = 0) AS throttling_detected FROM e WHERE n % 3 = 0 GROUP BY run_id)
 SELECT * FROM h LEFT JOIN g USING (run_id)"""
DEVICE_SQL = """SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(event_id % 2 AS VARCHAR) AS id, CAST(event_id % 2 AS INT) AS "index", bool_or(event_id % 5 = 0) AS throttling_detected,
 coalesce(array_to_string(list_sort(list(DISTINCT event_type) FILTER (WHERE event_id % 5 = 0)), ','), '') AS reasons, round(max(value / 7), 3) AS utilization_max_percent, round(max(value / 7 + 1), 3) AS memory_peak_mb,
 round(max(value / 7 + 2), 3) AS temperature_max_c, round(max(value / 7 + 3), 3) AS power_draw_max_w, round(max(value / 7 + 4), 3) AS fan_speed_max_percent FROM events WHERE event_id % 3 = 0 GROUP BY ALL"""
MODEL_SQL = "SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS model, round(max(value / 7), 3) AS vram_peak_mb, max(event_id) AS context_length_max FROM events WHERE event_id % 4 = 0 GROUP BY ALL"

QUERIES |= {f.__name__: f for f in (monitor_summary, device_summary, model_summary)}
ORACLE_SQL |= {"monitor_summary": MONITOR_SQL, "device_summary": DEVICE_SQL, "model_summary": MODEL_SQL}
#: The dry run's answers: words of each block of 2,000 code points; with several blocks, those of the text that the last call is given.
RECORDS_SQL = rf"""WITH t AS (SELECT doc_id, text, {D.PAGES} AS pages, {TOKENS} AS toks FROM documents), h AS (SELECT *, {HITS} FROM t), b AS (SELECT *, {BEST} AS det FROM h),
 k AS (SELECT doc_id, text, CASE WHEN det = 'unknown' THEN 'pt' ELSE det END AS lg, regexp_replace(text, '^\s+|\s+$', '', 'g') AS w,
  CASE WHEN regexp_matches(text, '(?im)^\s*({X.CONTENTS})([^\p{{L}}\p{{N}}_]|$)') AND pages >= 10 THEN 'manual'
   WHEN len(regexp_extract_all(text, '(?im)^\s*({X.IMRAD})([^\p{{L}}\p{{N}}_]|$)')) >= 2 AND regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])({X.KEYWORDS})([^\p{{L}}\p{{N}}_]|$)') AND pages <= 15 THEN 'articulo' ELSE 'divulgacion' END AS tipo FROM b),
 n AS (SELECT *, CASE WHEN length(text) > 2000 THEN CAST(ceil(length(w) / 2000.0) AS INT) ELSE 1 END AS n FROM k),
 p AS (SELECT *, list_transform(range(n), lambda i: list_filter(regexp_split_to_array(substr(w, i * 2000 + 1, 2000), '\s+'), lambda x: x <> '')[1:12]) AS heads FROM n),
 s AS (SELECT *, '[' || lg || '] ' || array_to_string(CASE WHEN n = 1 THEN heads[1] ELSE (['titulo:'] || flatten(list_transform(heads, lambda x: ['[' || lg || ']'] || x)))[1:12] END, ' ') AS titulo FROM p),
 g AS (SELECT * EXCLUDE (text), length(text) AS text_chars, titulo AS text FROM s), q AS (SELECT *, {TOKENS} AS toks FROM g), r AS (SELECT *, {HITS} FROM q), f AS (SELECT *, {BEST} AS said FROM r)
 SELECT doc_id, lg AS idioma_principal, tipo AS tipo_documento, CASE tipo WHEN 'articulo' THEN 'A' WHEN 'manual' THEN 'B' ELSE 'C' END AS plantilla, CAST(n + CAST(n > 1 AS INT) AS INT) AS calls, 'done' AS state, CAST(text_chars AS INT) AS text_chars,
  CAST(said <> 'unknown' AND said <> lg AND NOT (said IN ('pt', 'es') AND lg IN ('pt', 'es')) AS INT) AS n_failures, titulo FROM f"""


QUERIES |= {f.__name__: f for f in (readiness, throttling, ocr_meta, legacy_meta, summary_records)}
ORACLE_SQL |= {"reading_order": ORDER_SQL, "readiness": READY_SQL, "throttling": THROTTLE_SQL, "ocr_meta": META_SQL, "legacy_meta": LEGACY_SQL, "summary_records": RECORDS_SQL}
QUERIES["job_states"] = job_states
ORACLE_SQL["job_states"] = JOB_STATES_SQL


def term_matches(spark, sf_dir):
    """Which words of the benchmark each document contains, wherever they stand: their number and a digest of their numbers and places."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))).alias("term")).distinct()
    # a word's number is made of its own letters
    terms = words.withColumn("term_id", F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 15), 16, 10).cast("long"))
    found = matching.term_matches(docs(spark, sf_dir, "doc_id", "text"), terms, "doc_id")
    each = F.array_sort(F.collect_list(F.struct("term_id", "first")))
    told = found.groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.sha2(F.array_join(F.transform(each, lambda x: F.concat_ws(":", x["term_id"], x["first"])), ","), 256).alias("digest"))
    return docs(spark, sf_dir, "doc_id").join(told, "doc_id", "left").select("doc_id", F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"), "digest")


TERM_SQL = """WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term FROM benchmark), t AS (SELECT term, CAST('0x' || left(md5(term), 15) AS BIGINT) AS term_id FROM w),
 d AS (SELECT doc_id, lower(coalesce(text, '')) AS text FROM documents), m AS (SELECT doc_id, term_id, instr(text, term) AS first FROM d JOIN t ON contains(text, term)),
 g AS (SELECT doc_id, count(*) AS n_terms, sha256(string_agg(term_id || ':' || first, ',' ORDER BY term_id)) AS digest FROM m GROUP BY doc_id)
 SELECT doc_id, coalesce(n_terms, 0) AS n_terms, digest FROM documents LEFT JOIN g USING (doc_id)"""


def label_join(spark, sf_dir):
    """Short lines of documents as headings, and for each the first benchmark word of which one contains the other."""
    lines = docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    headings = lines.filter(F.length("text") <= 60)
    words = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit("[A-Za-z]{5,}"), F.lit(0))).alias("k", "label"))
    return matching.closest_label(headings, words.select("label", (F.col("item_id") * 1_000_000 + F.col("k")).alias("place"))).select("doc_id", "line", "text", "label")


LABEL_SQL = """WITH h AS (SELECT doc_id, CAST(k - 1 AS INT) AS line, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents) WHERE length(text) <= 60),
 b AS (SELECT item_id, regexp_extract_all(text, '[A-Za-z]{5,}') AS ws FROM benchmark), w AS (SELECT item_id, unnest(ws) AS label, generate_subscripts(ws, 1) - 1 AS k FROM b), l AS (SELECT label, min(item_id * 1000000 + k) AS place FROM w GROUP BY label),
 t AS (SELECT DISTINCT text, lower(text) AS low FROM h WHERE text <> ''), p AS (SELECT t.text, arg_min(label, (label <> text, place, label)) AS label FROM t JOIN l ON contains(low, lower(label)) OR contains(lower(label), low) GROUP BY t.text)
 SELECT h.doc_id, h.line, h.text, p.label FROM h LEFT JOIN p USING (text)"""


def _reviews(spark, sf_dir):
    """(results, events): users as documents whose sections lack some keys, their events as edits, approvals and rejections."""
    e = table(spark, sf_dir, "events")
    keys = F.array(*[F.lit(k) for k in X.TEMPLATES["C"]])
    users = e.select(F.col("user_id").alias("doc_id")).distinct()
    filled = F.filter(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))), lambda x: (F.col("doc_id") + x["i"]) % 3 != 0)
    sections = F.map_from_entries(F.transform(filled, lambda x: F.struct(x["k"], F.lit("x"))))
    empty = F.array().cast("array<string>")
    results = users.select("doc_id", sections.alias("sections"), F.lit("C").alias("template"), F.lit("es").alias("lang"), empty.alias("declared"), empty.alias("present"))
    action = F.when(F.col("event_type") == "purchase", "approved").when(F.col("event_type") == "error", "rejected").otherwise("edited")
    changed = F.create_map(F.get(keys, (F.col("event_id") % len(X.TEMPLATES["C"])).cast("int")), F.when(F.col("event_id") % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("e"), F.col("event_id").cast("string"))))
    events = e.select(F.col("user_id").alias("doc_id"), "ts", F.col("event_id").alias("seq"), action.alias("action"), F.concat(F.lit("r"), (F.col("event_id") % 3).cast("string")).alias("reviewer"), F.lit("n").alias("note"), (F.col("event_id") % 10 == 0).alias("force"), F.when(action == "edited", changed).alias("changes"))
    return results, events


def review_fold(spark, sf_dir):
    """Every document after its reviews, approvals judged on the sections as edited by then."""
    done = jobs.review_records(jobs.reviewed(*_reviews(spark, sf_dir)))
    told = F.array_join(F.transform(F.array_sort(F.map_entries("sections")), lambda x: F.concat_ws("=", x["key"], x["value"])), ";")
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), "state", "reviewer", "note", told.alias("sections"), "edited_by", "actions")


_KEYS = X.TEMPLATES["C"]
REVIEW_FOLD_SQL = f"""WITH e AS (SELECT user_id AS doc_id, ts, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' ELSE 'edited' END AS action, 'r' || event_id % 3 AS reviewer, event_id % 10 = 0 AS force,
   CAST(event_id % {len(_KEYS)} AS INT) AS slot, CASE WHEN event_id % 4 = 0 THEN ' ' ELSE 'e' || event_id END AS value FROM events),
 s AS (SELECT *, {", ".join(f"coalesce(last_value(CASE WHEN action = 'edited' AND slot = {k} THEN value END IGNORE NULLS) OVER w, CASE WHEN (doc_id + {k}) % 3 <> 0 THEN 'x' END) AS s{k}" for k in range(len(_KEYS)))},
   last_value(CASE WHEN action = 'edited' THEN reviewer END IGNORE NULLS) OVER w AS edited_by FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
 n AS (SELECT *, {" + ".join(f"(trim(coalesce(s{k}, '')) = '')::INT" for k in range(len(_KEYS)))} AS bad, array_to_string(list_sort([x FOR x IN [{", ".join(f"'{key}=' || s{k}" for k, key in enumerate(_KEYS))}] IF x IS NOT NULL]), ';') AS sections FROM s),
 a AS (SELECT *, CASE WHEN action = 'approved' AND bad > 0 THEN 'n [FORZADO pese a: ' || array_to_string(list_transform(range(bad), lambda i: 'schema'), ', ') || ']' ELSE 'n' END AS note FROM n WHERE action <> 'approved' OR bad = 0 OR force)
 SELECT doc_id, arg_max(action, (ts, seq)) AS state, arg_max(reviewer, (ts, seq)) AS reviewer, arg_max(note, (ts, seq)) AS note, arg_max(sections, (ts, seq)) AS sections, arg_max(coalesce(edited_by, '-'), (ts, seq)) AS edited_by, count(*) AS actions FROM a GROUP BY doc_id"""

QUERIES |= {f.__name__: f for f in (term_matches, label_join, review_fold)}
ORACLE_SQL |= {"term_matches": TERM_SQL, "label_join": LABEL_SQL, "review_fold": REVIEW_FOLD_SQL.replace("arg_max(coalesce(edited_by, '-'), (ts, seq))", "nullif(arg_max(coalesce(edited_by, '-'), (ts, seq)), '-')")}


def phase_samples(spark, sf_dir):
    """Events as starts, ends and samples of users' phases, joined as streams: samples of each interval that the watermark has settled."""
    e = _streamed(spark, sf_dir, "events")
    span = F.expr("event_id div 2").alias("span")
    starts = e.filter("event_id % 2 = 0").select(span, F.col("user_id").alias("run_id"), F.col("event_type").alias("phase"), F.col("ts").alias("start"))
    ends = e.filter("event_id % 2 = 1 and event_id % 10 <> 1").select(span, F.col("ts").alias("end"))
    samples = e.select(F.col("user_id").alias("run_id"), F.col("ts").alias("at"), "value")
    rows, place = streaming.samples_within(streaming.intervals(starts, ends), samples), scratch(spark, "phases")
    rows.writeStream.format("parquet").option("path", f"{place}/rows").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = streaming.summed(spark.read.schema(rows.schema).parquet(f"{place}/rows"))
    us = lambda c: F.unix_micros(c).alias(f"{c}_us")
    return found.select("span", "run_id", "phase", us("start"), us("end"), "n", "low", "high", "mean")


PHASE_SAMPLES_SQL = """WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(CAST(ts AS TIMESTAMP)) AS t FROM events),
 a AS (SELECT event_id // 2 AS span, user_id AS run_id, event_type AS phase, t AS s FROM e WHERE event_id % 2 = 0), b AS (SELECT event_id // 2 AS span, t AS f FROM e WHERE event_id % 2 = 1 AND event_id % 10 <> 1),
 w AS (SELECT least((SELECT max(s) FROM a), (SELECT max(f) FROM b), (SELECT max(t) FROM e)) // 1000 * 1000 - 600000000 AS w),
 i AS (SELECT a.*, f FROM a LEFT JOIN b ON a.span = b.span AND f >= s AND f <= s + 3600000000),
 k AS (SELECT * FROM i, w WHERE f IS NOT NULL OR s + 3600000000 < w)
 SELECT k.span, k.run_id, phase, s AS start_us, f AS end_us, count(t) AS n, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean
 FROM k LEFT JOIN e ON e.user_id = k.run_id AND t >= s AND t < coalesce(f, s + 3600000000) GROUP BY ALL"""
QUERIES["phase_samples"], ORACLE_SQL["phase_samples"] = phase_samples, PHASE_SAMPLES_SQL


def meta_gates(spark, sf_dir):
    """Gates over what a transcript's pages were read with: empty pages, low confidence, rejected vision pages, old caches."""
    d = docs(spark, sf_dir, "doc_id")
    page = lambda k: F.struct(k.cast("int").alias("page"), F.when((F.col("doc_id") * 7 + k) % 5 == 0, 0).when((F.col("doc_id") + k) % 13 > 0, 100).alias("chars"), ((F.col("doc_id") + k) % 6 == 0).alias("vlm_rejected"))
    detail = F.transform(F.sequence(F.lit(1).cast("long"), F.col("doc_id") % 60 + 1), page)
    found = d.withColumn("pages_detail", detail).withColumn("vlm_rejected", F.size(F.filter("pages_detail", lambda p: p["vlm_rejected"])))
    conf = F.when(F.col("doc_id") % 11 > 0, (F.col("doc_id") % 100).cast("double"))
    meta = F.struct("pages_detail", conf.alias("conf_media"), "vlm_rejected", (F.col("doc_id") % 3 == 0).alias("legacy"))
    told = gates.transcript_gates(F.lit(""), meta)
    return found.select("doc_id", F.array_join(F.transform(told, lambda g: F.concat_ws("|", g["gate"], g["severity"], g["detail"])), "\n").alias("failures"))


META_GATES_SQL = """WITH d AS (SELECT doc_id, unnest(range(1, doc_id % 60 + 2)) AS k FROM documents), p AS (SELECT doc_id, k, CASE WHEN (doc_id * 7 + k) % 5 = 0 THEN 0 WHEN (doc_id + k) % 13 > 0 THEN 100 END AS chars, (doc_id + k) % 6 = 0 AS bad FROM d),
 g AS (SELECT doc_id, count(chars) AS n, count(*) FILTER (WHERE chars = 0) AS empty, list(k ORDER BY k) FILTER (WHERE chars = 0) AS e, count(*) FILTER (WHERE bad) AS rejected, list(k ORDER BY k) FILTER (WHERE bad) AS r FROM p GROUP BY doc_id)
 SELECT doc_id, concat_ws(chr(10), CASE WHEN empty > 0 THEN 'paginas|' || CASE WHEN empty / n > 0.2 THEN 'error' ELSE 'warning' END || '|' || empty || '/' || n || ' páginas sin texto: [' || array_to_string(e[:10], ', ') || ']' END,
  CASE WHEN doc_id % 11 > 0 AND doc_id % 100 < 60 THEN 'conf_baja|warning|' || printf('confianza OCR media %.1f < 60.0', CAST(doc_id % 100 AS DOUBLE)) END,
  CASE WHEN rejected > 0 THEN 'vlm_rechazado|warning|' || rejected || ' página(s) con VLM rechazado (degradadas a Tesseract): [' || array_to_string(r[:10], ', ') || '] — revisar transcripción' END,
  CASE WHEN doc_id % 3 = 0 THEN 'legacy_cache|warning|transcript de caché legacy (sin métricas de OCR persistidas); usar --retranscribe para regenerar con métricas' END) AS failures FROM g"""


def hierarchical_records(spark, sf_dir):
    """Dry-run summaries of documents by chapters: sections, calls, and what was given to the model."""
    d = docs(spark, sf_dir, "doc_id", f"{D.CHAPTERED} AS text").withColumn("pages", F.lit(1))
    made = engine.summary_records(d, lambda: summarize.first_words, "hierarchical", 2000)
    return made.select("doc_id", "calls", "fed.strategy", F.array_join("fed.parts", ",").alias("parts"), "fed.chars", F.element_at("secciones", F.lit("titulo")).alias("titulo"))


QUERIES |= {"meta_gates": meta_gates, "hierarchical_records": hierarchical_records}
ORACLE_SQL["meta_gates"] = META_GATES_SQL
