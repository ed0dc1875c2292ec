"""Quality gates over transcripts and results: array<struct<gate, detail, severity>> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import detect_language, first_phrase, garbage_ratio, language_hits, let, strip, tokens
from .sections import keys


def failure(gate: str, detail: Column, severity: str | Column = "error") -> Column:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return F.struct(F.lit(gate).alias("gate"), detail.alias("detail"), level.alias("severity"))


def all_of(*gates: Column) -> Column:
    """Gates that found something, in order."""
    return F.filter(F.array(*gates), lambda g: g.isNotNull())


def no_errors(failures: Column) -> Column:
    return ~F.exists(failures, lambda f: f["severity"] == "error")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def transcript_gates(text: Column, meta: Column | None = None) -> Column:
    """Gates of a transcript; ``meta`` is struct<pages_detail, conf_media, vlm_rejected, legacy> or null."""
    enough = word_count(text) >= X.MIN_TOKENS

    def garbage(ratio: Column) -> Column:
        return F.when(ratio > X.GARBAGE_MAX, failure("garbage", F.format_string("ratio de caracteres basura %.3f > 0.15", ratio)))

    def signal(toks: Column) -> Column:
        return F.coalesce(F.try_divide(F.greatest(*language_hits(toks).values()) * 100.0, F.size(toks)), F.lit(0.0))

    def odd(best: Column) -> Column:
        return F.when(best < X.STOPWORD_MIN, failure("stopword_ratio", F.format_string("señal de idioma %.2f < 2.0 (texto posiblemente ilegible)", best), "warning"))

    gates = [F.when(enough, let(garbage_ratio(text), garbage)), F.when(enough, let(let(tokens(text), signal), odd))]
    if meta is not None:
        pages = F.filter(meta["pages_detail"], lambda p: p["chars"].isNotNull())
        empty = F.transform(F.filter(pages, lambda p: p["chars"] == 0), lambda p: p["page"])
        rejected = F.transform(F.filter(meta["pages_detail"], lambda p: p["vlm_rejected"]), lambda p: p["page"])

        def listed(x: Column) -> Column:
            return F.concat(F.lit("["), F.array_join(F.slice(x, 1, 10).cast("array<string>"), ", "), F.lit("]"))

        level = F.when(F.try_divide(F.size(empty).cast("double"), F.size(pages)) > X.EMPTY_PAGES_ERROR, "error").otherwise("warning")
        gates += [
            F.when(F.size(empty) > 0, failure("paginas", F.concat(F.size(empty), F.lit("/"), F.size(pages), F.lit(" páginas sin texto: "), listed(empty)), level)),
            F.when(meta["conf_media"] < X.CONF_MIN, failure("conf_baja", F.format_string("confianza OCR media %.1f < 60.0", meta["conf_media"]), "warning")),
            F.when(
                meta["vlm_rejected"] > 0,
                failure(
                    "vlm_rechazado",
                    F.concat(meta["vlm_rejected"], F.lit(" página(s) con VLM rechazado (degradadas a Tesseract): "), listed(rejected), F.lit(" — revisar transcripción")),
                    "warning",
                ),
            ),
            F.when(
                meta["legacy"],
                failure(
                    "legacy_cache",
                    F.lit("transcript de caché legacy (sin métricas de OCR persistidas); usar --retranscribe para regenerar con métricas"),
                    "warning",
                ),
            ),
        ]
    return all_of(*gates)


def result_gates(sections: Column, template: Column, lang: Column, declared: Column, present: Column) -> Column:
    """Gates of a result: sections map, template, main language, declared and present abstract languages."""
    values = F.map_values(sections)
    required = F.filter(keys(template), lambda k: ~k.isin(*X.OPTIONAL_KEYS))
    missing = F.filter(required, lambda k: strip(F.coalesce(F.try_element_at(sections, k), F.lit(""))) == "")
    schema = F.transform(missing, lambda k: failure("schema", F.concat(F.lit("sección obligatoria vacía o ausente: "), k)))
    blob = F.array_join(values, " ")
    said, got = F.array_sort(F.array_distinct(declared)), F.array_sort(F.array_distinct(present))

    def quoted(x: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(F.transform(x, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))

    def other(found: Column) -> Column:
        near = found.isin("pt", "es") & lang.isin("pt", "es")
        detail = F.concat(F.lit("idioma del resumen '"), found, F.lit("' != principal '"), lang, F.lit("'"))
        return F.when((found != "unknown") & (found != lang) & ~near, failure("lang", detail, "warning"))

    def refusal(phrase: Column) -> Column:
        return F.when(phrase.isNotNull(), failure("refusal", F.concat(F.lit("marca de refusal/dirigido al usuario: '"), phrase, F.lit("'"))))

    rest = all_of(
        let(first_phrase(F.array_join(values, "\n"), X.REFUSALS), refusal),
        let(blob, lambda text: F.when(word_count(text) >= 8, let(detect_language(text), other))),
        F.when((F.size(said) > 0) & (said != got), failure("abstracts", F.concat(F.lit("abstracts declarados "), quoted(said), F.lit(" != preservados "), quoted(got)))),
    )
    return F.concat(schema, rest)
