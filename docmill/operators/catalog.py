"""Catalogue exports: LILACS drafts, bibliographic data and BIBFRAME records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import bullet_terms, candidate_terms, pick, split_names, strip, year


def section(key: Column | str) -> Column:
    k = F.lit(key) if isinstance(key, str) else key
    return strip(F.coalesce(F.try_element_at("sections", k), F.lit("")))


def lilacs(results: DataFrame) -> DataFrame:
    """``results`` with the draft record as a nested column (use to_json for a file)."""
    summary = section(pick(X.SUMMARY_KEY, F.col("plantilla"), "resumen_ejecutivo"))
    terms = candidate_terms(F.coalesce(F.try_element_at("sections", pick(X.TERMS_KEY, F.col("plantilla"), "terminos")), F.lit("")))
    own = F.struct(F.col("idioma").alias("lang"), summary.alias("text"), F.lit("generated").alias("source"))
    origin = F.transform("abstracts", lambda a: F.struct(a["lang"].alias("lang"), a["text"].alias("text"), F.lit("origin").alias("source")))
    record = F.struct(
        F.lit("draft").alias("status"),
        F.lit(X.LILACS_NOTE).alias("_note"),
        F.struct(
            pick(X.LILACS_TYPE, F.col("tipo"), "M").alias("05_tipo_documento"),
            section("titulo").alias("titulo"),
            F.col("idioma").alias("idioma_texto"),
            F.concat(F.array(own), origin).alias("resumos"),
            terms.alias("descritores_candidatos"),
            F.array_distinct(F.transform("abstracts", lambda a: a["lang"])).alias("idiomas_resumo_origem"),
        ).alias("lilacs"),
        F.struct("doc_id", F.col("tipo").alias("tipo_interno"), "plantilla", F.lit("1.0").alias("contract_version")).alias("origen"),
    )
    return results.withColumn("record", record)


def merge_sources(results: DataFrame, pdf: DataFrame) -> DataFrame:
    """Bibliographic data: the PDF's own metadata first, the summary where it has none; src_* names the source."""
    j = results.join(pdf, "doc_id", "left")
    blank = lambda c: strip(F.coalesce(F.col(c), F.lit("")))

    def chosen(name: str, a: Column, b: Column, there=lambda c: c != "") -> list[Column]:
        return [F.when(there(a), a).otherwise(b).alias(name), F.when(there(a), "pdf_metadata").when(there(b), "summary").alias(f"src_{name}")]

    some = lambda c: F.size(c) > 0
    title, own_title = blank("title"), section("titulo")
    final = F.when(title != "", title).otherwise(own_title)
    part = F.when(blank("subject") != "", blank("subject")).when(title != "", own_title).otherwise("")
    part = F.when(part == final, "").otherwise(part)
    publisher = F.when(F.lower(section("entidad")).startswith("no se"), "").otherwise(section("entidad"))
    terms = bullet_terms(F.coalesce(F.try_element_at("sections", pick(X.TERMS_KEY, F.col("plantilla"), "terminos")), F.lit("")))
    return j.select(
        "doc_id",
        *chosen("title", title, own_title),
        part.alias("section_title"),
        F.when(part != "", F.when(blank("subject") != "", "pdf_metadata").otherwise("summary")).alias("src_section_title"),
        *chosen("authors", split_names(F.coalesce("author", F.lit(""))), split_names(F.coalesce(F.try_element_at("sections", F.lit("autores")), F.lit(""))), some),
        *chosen("publisher", F.lit(""), publisher),
        *chosen("date", year(F.coalesce("creation_date", F.lit(""))), F.lit("")),
        *chosen("language", F.lit(""), F.col("idioma")),
        *chosen("pages", F.coalesce("pdf_pages", F.lit(0)), F.coalesce("pages", F.lit(0)), lambda c: c > 0),
        *chosen("subjects", split_names(F.coalesce("keywords", F.lit(""))), terms, some),
    )


def bibframe(bib: DataFrame) -> DataFrame:
    """(doc_id, record, motivo): a JSON record of a work and its instance; a reason instead where the title is missing."""
    full = lambda c: F.when(F.col(c) != "", F.col(c))
    several = lambda c: F.when(F.size(c) > 0, F.col(c))
    work = F.struct(
        F.lit("bf:Work").alias("@type"),
        full("title").alias("bf:title"),
        F.transform(several("authors"), lambda a: F.struct(F.lit("bf:Contribution").alias("@type"), a.alias("bf:agent"))).alias("bf:contribution"),
        pick(X.LOC_LANG, F.col("language")).alias("bf:language"),
        several("subjects").alias("bf:subject"),
    )
    instance = F.struct(
        F.lit("bf:Instance").alias("@type"),
        full("section_title").alias("bf:part"),
        full("publisher").alias("bf:publisher"),
        full("date").alias("bf:date"),
        F.when(F.col("pages") > 0, F.concat(F.col("pages").cast("string"), F.lit(" p."))).alias("bf:extent"),
    )
    record = F.to_json(F.struct(F.lit("draft").alias("status"), F.lit(X.BIB_NOTE).alias("_note"), F.array(work).alias("work"), F.array(instance).alias("instance")))
    ok = strip(F.col("title")) != ""
    return bib.select("doc_id", F.when(ok, record).alias("record"), F.when(~ok, "sin título").alias("motivo"))
