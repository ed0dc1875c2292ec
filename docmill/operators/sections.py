"""Prompts, section parsing, deterministic summaries and their consolidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import pick, strip


def labels(template: Column, lang: Column) -> Column:
    """Section labels of a template, in Portuguese for other languages than es and en."""
    by_lang = {lg: {t: [X.LABELS[k][i] for k in keys] for t, keys in X.TEMPLATES.items()} for i, lg in enumerate(X.LABEL_LANGS)}

    def array(names: list[str]) -> Column:
        return F.array(*[F.lit(n) for n in names])

    def of(table: dict) -> Column:
        return F.when(template == "A", array(table["A"])).when(template == "B", array(table["B"])).otherwise(array(table["C"]))

    return F.when(lang == "es", of(by_lang["es"])).when(lang == "en", of(by_lang["en"])).otherwise(of(by_lang["pt"]))


def keys(template: Column) -> Column:
    arrays = {t: F.array(*[F.lit(k) for k in ks]) for t, ks in X.TEMPLATES.items()}
    return F.when(template == "A", arrays["A"]).when(template == "B", arrays["B"]).otherwise(arrays["C"])


def prompt(text: Column, lang: Column, template: Column, max_chars: int = X.MAX_CHARS) -> Column:
    schema = F.array_join(F.transform(labels(template, lang), lambda n: F.concat(F.lit("## "), n)), "\n")
    asked = pick(X.INSTRUCTIONS, lang, X.INSTRUCTIONS["pt"])
    return F.concat(asked, F.lit("\n\n"), schema, F.lit('\n\nTEXTO:\n"""\n'), F.substring(text, 1, max_chars), F.lit('\n"""'))


def fake_summary(text: Column, lang: Column, template: Column) -> Column:
    """map<label, text> as the dry run makes it: the first twelve words under each Portuguese label."""
    head = F.array_join(F.slice(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""), 1, 12), " ")
    names = labels(template, F.lit("pt"))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.concat(F.lit("[fake:"), lang, F.lit("] "), n, F.lit(": "), head)))


def parse_sections(df: DataFrame, key: str, markdown: str, template: str, lang: str) -> DataFrame:
    """(key, section, content): blocks under ``##`` headings, the last of a repeated one.

    A heading names the section whose label it equals, else the first whose label contains
    it or is contained in it, else itself.
    """
    head = r"(?dmU)^[^\S\n]*##[^\S\n]+(.*?)[^\S\n]*$"
    names, ks = labels(F.col(template), F.col(lang)), keys(F.col(template))
    found = df.withColumn("__md", F.regexp_replace(F.col(markdown), r"\r\n|\r", "\n")).select(
        key,
        F.arrays_zip(names.alias("n"), ks.alias("k")).alias("known"),
        F.regexp_extract_all("__md", F.lit(head), F.lit(1)).alias("heads"),
        F.slice(F.split("__md", head, -1), 2, 1 << 30).alias("bodies"),
    )

    def named(head: Column, body: Column) -> Column:
        label = strip(head)
        low = F.lower(label)
        equal = F.filter("known", lambda p: p["n"] == label)
        close = F.filter("known", lambda p: F.contains(low, F.lower(p["n"])) | F.contains(F.lower(p["n"]), low))
        section = F.coalesce(F.get(equal, F.lit(0))["k"], F.get(close, F.lit(0))["k"], label)
        return F.struct(section.alias("section"), strip(body).alias("content"))

    blocks = F.transform(F.zip_with("heads", "bodies", named), lambda x, k: F.struct(x["section"].alias("section"), k.alias("k"), x["content"].alias("content")))
    # sorted by section and place, the last block of a section is the one before another section
    ordered = found.withColumn("ordered", F.array_sort(blocks))
    last = F.filter("ordered", lambda x, k: ~F.get("ordered", k + 1)["section"].eqNullSafe(x["section"]))
    return ordered.select(key, F.inline(last)).select(key, "section", "content")


def dedup_lines(values: Column) -> Column:
    """Distinct lines of the values without bullets, in code-point order, each behind ``- ``."""

    def bare(line: Column) -> Column:
        x = strip(line)
        for bullet in ("- ", "• "):
            x = F.when(x.startswith(bullet), strip(F.substring(x, F.lit(3), F.length(x)))).otherwise(x)
        return x

    lines = F.filter(F.transform(F.flatten(F.transform(values, lambda v: F.split(v, "\n", -1))), bare), lambda x: x != "")
    return F.array_join(F.transform(F.array_sort(F.array_distinct(lines)), lambda x: F.concat(F.lit("- "), x)), "\n")


def consolidate(partials: DataFrame, key: str, dedup: tuple[str, ...] = X.DEDUP_KEYS) -> DataFrame:
    """(key, section, content) of partial summaries (key, ord, section, content)."""
    part = F.when(strip(F.col("content")) != "", F.struct("ord", "content"))
    values = F.transform(F.array_sort(F.collect_list(part)), lambda x: x["content"])
    grouped = partials.groupBy(key, "section").agg(values.alias("parts"))
    return grouped.select(key, "section", F.when(F.col("section").isin(*dedup), dedup_lines(F.col("parts"))).otherwise(F.array_join("parts", "\n\n")).alias("content"))
