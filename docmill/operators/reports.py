"""Aggregate reports: batches, control suites, OCR quality, infrastructure, technique comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .carry import carried, nearest_rank


def ocr_quality(pages: DataFrame, key: str) -> DataFrame:
    """Quality of each document's pages (source, conf, words, chars, vlm_rejected); null means the value is absent."""
    weight = F.when(F.col("conf").isNotNull(), F.coalesce("words", F.lit(0)))
    return pages.groupBy(key).agg(
        F.count_if(F.col("source") == "vlm").alias("paginas_vlm"),
        F.count_if(F.col("chars") == 0).alias("paginas_vacias"),
        F.count_if(F.coalesce("vlm_rejected", F.lit(False))).alias("paginas_vlm_rechazado"),
        F.round(F.try_divide(F.sum(F.col("conf") * weight), F.nullif(F.sum(weight), F.lit(0))), 2).alias("conf_media"),
    )


def batch_metrics(items: DataFrame) -> DataFrame:
    """One pass over items (tipo, idioma, seconds, failures): totals, and counts by type and language."""
    ok = F.size("failures") == 0
    grouped = items.withColumn("ok", ok).groupingSets([[F.col("tipo")], [F.col("idioma")], []], "tipo", "idioma")
    return grouped.agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("total"),
        F.count_if(F.col("ok")).alias("ok"),
        F.count_if(~F.col("ok")).alias("con_fallos"),
        F.round(F.sum("seconds"), 6).alias("tiempo_total"),
        F.round(F.avg("seconds"), 6).alias("tiempo_medio"),
    )


def failed_gates(items: DataFrame) -> DataFrame:
    """Number of failures (not documents) of each gate."""
    return items.select(F.explode("failures.gate").alias("gate")).groupBy("gate").agg(F.count("*").alias("n"))


def phase_times(phases: DataFrame, documents: Column | int) -> DataFrame:
    """Seconds by phase, and their mean over all documents."""
    total = F.sum("seconds")
    return phases.groupBy("phase").agg(F.round(total, 6).alias("tiempo_total"), F.round(total / documents, 6).alias("tiempo_medio"))


def transcription_summary(docs: DataFrame) -> DataFrame:
    """One row over documents (passed, gates, legacy, paginas_vlm, paginas_vacias, conf_media)."""
    return docs.agg(
        F.count("*").alias("docs_evaluados"),
        F.count_if(~F.col("passed")).alias("docs_con_error"),
        F.count_if(F.size("gates") > 0).alias("docs_con_warnings"),
        F.count_if(F.coalesce("legacy", F.lit(False))).alias("docs_legacy"),
        F.sum(F.coalesce("paginas_vlm", F.lit(0))).alias("paginas_vlm"),
        F.sum(F.coalesce("paginas_vacias", F.lit(0))).alias("paginas_vacias"),
        F.round(F.avg("conf_media"), 2).alias("conf_media"),
    )


def term_coverage(text: Column, terms: Column) -> tuple[Column, Column]:
    """Share of the expected terms in the text (1 without any), and the missing ones."""
    missing = F.filter(terms, lambda t: ~F.contains(F.lower(text), F.lower(t)))
    share = F.when(F.size(terms) == 0, F.lit(1.0)).otherwise(F.try_divide((F.size(terms) - F.size(missing)).cast("double"), F.size(terms)))
    return share, missing


def judge_cases(cases: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Verdict of each control case (expected_lang, expected_type, terms) on its result (lang, type, text); null without one."""
    joined = cases.join(results, key, "left")
    share, missing = term_coverage(F.col("text"), F.col("terms"))
    there = F.col("text").isNotNull()
    lang_ok = (F.col("expected_lang") == "") | (F.col("lang") == F.col("expected_lang"))
    type_ok = (F.col("expected_type") == "") | (F.col("type") == F.col("expected_type"))
    return joined.select(
        key,
        F.when(there, share).alias("coverage"),
        F.when(there, lang_ok).alias("lang_ok"),
        F.when(there, type_ok).alias("type_ok"),
        F.when(there, missing).alias("missing_terms"),
        F.when(there, lang_ok & type_ok & (F.size(missing) == 0)).alias("passed"),
    )


def control_report(verdicts: DataFrame) -> DataFrame:
    """One row; the mean coverage is over all cases, those without a result count 0."""
    n = F.count("*")
    return verdicts.agg(
        n.alias("total"),
        F.count_if("passed").alias("passed"),
        F.round(F.coalesce(F.try_divide(F.coalesce(F.sum("coverage"), F.lit(0.0)), n), F.lit(0.0)), 3).alias("coverage_media"),
        F.count_if("lang_ok").alias("lang_aciertos"),
        F.count_if("type_ok").alias("type_aciertos"),
    )


def acceptance(report: DataFrame, min_coverage: float = 0.6) -> DataFrame:
    passed = (
        (F.col("total") > 0) & (F.col("coverage_media") >= min_coverage) & (F.col("lang_aciertos") == F.col("total")) & (F.col("type_aciertos") == F.col("total"))
    )
    return report.withColumn("accepted", passed)


def series_summary(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    """min, max, mean, nearest-rank 95th percentile and last value of a series."""
    sums = samples.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.round(F.min(value), 6).alias("low"),
        F.round(F.max(value), 6).alias("high"),
        F.round(F.avg(value), 6).alias("mean"),
        F.round(F.max_by(value, F.struct("ts", "event_id")), 6).alias("last"),
    )
    ranks = nearest_rank(samples, by, value, 0.95).withColumnsRenamed({c: f"__by{k}" for k, c in enumerate(by)})
    same = [F.col(c).eqNullSafe(F.col(f"__by{k}")) for k, c in enumerate(by)]
    return sums.join(ranks, same, "left").select(*by, "n", "low", "high", "mean", F.round("rank_value", 6).alias("p95"), "last")


def rate(samples: DataFrame, by: str, order: list[str], counter: str, ts: str, width: float = 3600.0) -> DataFrame:
    """``samples`` with the counter's growth a second since the sample before, in percent; null where time stands still."""
    now = samples.withColumn("__at", F.unix_micros(F.col(ts).cast("timestamp")))
    both = carried(now, by, order, F.struct("__at", F.col(counter).alias("c")), "__past", width, before=True)
    gone, grown = F.col("__at") - F.col("__past.__at"), F.col(counter) - F.col("__past.c")
    return both.withColumn("percent", F.when(gone > 0, F.round(grown * 100.0 / (gone / 1e6), 6))).drop("__at", "__past")


def asof_context(samples: DataFrame, contexts: DataFrame, key: str, ts: str, context: str, width: float = 3600.0) -> DataFrame:
    """``samples`` with the latest context set at or before each, by one ordered pass over the cells of both."""
    both = samples.withColumn("__c", F.lit(None).cast(contexts.schema[context].dataType)).withColumn("__s", F.lit(1)).unionByName(
        contexts.select(key, ts, F.col(context).alias("__c"), F.lit(0).alias("__s")), allowMissingColumns=True
    )
    return carried(both, key, [ts, "__s"], F.col("__c"), context, width).filter("__s = 1").drop("__c", "__s")


def compare_techniques(rows: DataFrame, baseline: str) -> DataFrame:
    """Word-weighted confidence, words and seconds of each technique, and how they differ from the baseline's."""
    agg = rows.groupBy("technique").agg(
        F.try_divide(F.sum(F.col("conf") * F.col("words")), F.sum("words")).alias("conf"), F.sum("words").alias("words"), F.sum("seconds").alias("seconds")
    )
    base = agg.filter(F.col("technique") == baseline).select(F.col("conf").alias("b_conf"), F.col("words").alias("b_words"), F.col("seconds").alias("b_seconds"), F.lit(1).alias("one"))
    return (
        agg.withColumn("one", F.lit(1))
        .join(F.broadcast(base), "one", "left")
        .select(
            "technique",
            "words",
            F.round("conf", 4).alias("conf"),
            F.round(F.col("conf") - F.col("b_conf"), 4).alias("d_conf"),
            F.round(F.try_divide((F.col("words") - F.col("b_words")) * 100.0, "b_words"), 4).alias("d_words_pct"),
            F.round(F.try_divide((F.col("seconds") - F.col("b_seconds")) * 100.0, "b_seconds"), 4).alias("d_seconds_pct"),
        )
    )
