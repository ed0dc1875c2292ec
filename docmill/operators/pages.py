"""Page operators: splitting, repeated headers and footers, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import MARKER, dehyphenate, edge_form, let, strip

ROMAN_OR_NUMBER = r"(?iU)^\s*(\d{1,4}|[ivxlcdm]{1,7})\s*$"


def split_pages(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with kind (formfeed, marker or null) and pages (null without page borders)."""
    t = F.col(text)
    bodies = F.split(t, r"(?dm)^=== pág \d+ ===$\n?", -1)
    marks = F.regexp_extract_all(t, F.lit(MARKER), F.lit(0))
    marked = F.zip_with(marks, F.slice(bodies, 2, 1 << 30), lambda m, b: F.concat(m, F.lit("\n"), F.coalesce(b, F.lit(""))))
    kind = F.when(F.contains(t, F.lit("\f")), "formfeed").when(F.size(marks) >= 2, "marker")
    return df.withColumn("kind", kind).withColumn("pages", F.when(F.col("kind") == "formfeed", F.split(t, "\f", -1)).when(F.col("kind") == "marker", marked))


def page_edges(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with kind, n_pages, lines, edges and forms: lines of each page, places of its edge lines, and their forms.

    A row is worked on by itself; rows without page borders have nulls.
    """
    lines = F.transform("pages", lambda p: F.split(p, "\n", -1))

    def near(full: Column) -> Column:
        marked = (F.col("kind") == "marker") & F.coalesce(F.get(full, F.lit(0))["x"].rlike(MARKER), F.lit(False))
        first = F.when(marked, 1).otherwise(0)
        kept = F.filter(full, lambda s, i: (i >= first) & ((i < first + X.EDGE_LINES) | (i >= F.size(full) - X.EDGE_LINES)))
        return F.transform(kept, lambda s: s["k"])

    def places(of: Column) -> Column:
        # bound once: each line of a page would work them out again
        return let(F.filter(F.transform(of, lambda x, k: F.struct(k.alias("k"), x.alias("x"))), lambda s: strip(s["x"]) != ""), near)

    split = split_pages(df, text).withColumn("n_pages", F.size("pages")).withColumn("lines", lines).drop("pages")
    placed = split.withColumn("edges", F.transform("lines", places))
    return placed.withColumn("forms", F.zip_with("lines", "edges", lambda of, at: F.transform(at, lambda k: edge_form(F.get(of, k)))))


def repeated_forms(n_pages: Column, ordered: Column) -> Column:
    """Edge forms on enough pages of a document of three pages or more; ``ordered`` has each page's distinct forms, sorted over all pages."""
    least = F.greatest(F.lit(X.MIN_PAGES), F.floor(n_pages * X.REPEAT_RATIO).cast("int"))
    often = F.filter(ordered, lambda form, i: F.get(ordered, i + least - 1) == form)
    return F.when(n_pages >= X.MIN_PAGES, F.array_distinct(often)).otherwise(F.array().cast("array<string>"))


def with_repeated(df: DataFrame, text: str = "text") -> DataFrame:
    """``page_edges`` with ordered (every page's distinct edge forms, sorted) and repeated (those on enough pages)."""
    each = F.transform("forms", lambda of: F.array_distinct(F.filter(of, lambda form: form != "")))
    return page_edges(df, text).withColumn("ordered", F.array_sort(F.flatten(each))).withColumn("repeated", repeated_forms(F.col("n_pages"), F.col("ordered")))


def repeated_edges(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, form, n): edge forms on enough pages of a document, and the number of pages."""
    counted = F.transform("repeated", lambda form: F.struct(form.alias("form"), F.size(F.filter("ordered", lambda x: x == form)).cast("long").alias("n")))
    return with_repeated(df, text).select(key, F.inline(counted))


def clean_text(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, cleaned): texts without repeated headers, footers and page numbers, words joined at line ends."""

    def body(of: Column, at: Column) -> Column:
        drop = lambda x, k: F.when(F.array_contains(at, k), F.array_contains("repeated", edge_form(x)) | x.rlike(ROMAN_OR_NUMBER)).otherwise(False)
        return F.array_join(F.filter(of, lambda x, k: ~drop(x, k)), "\n")

    kept = with_repeated(df, text).withColumn("kept", F.zip_with("lines", "edges", body))
    return kept.withColumn("joined", F.when(F.col("kind") == "formfeed", F.array_join("kept", "\f")).otherwise(F.array_join("kept", "\n"))).select(key, dehyphenate(F.coalesce("joined", text)).alias("cleaned"))


def assemble_pages(pages: DataFrame, key: str, marked: bool = True) -> DataFrame:
    """(key, text): page texts in order, each behind its marker; pages without an image are left out."""
    text = F.concat(F.format_string("=== pág %d ===\n", "page"), "text") if marked else F.col("text")
    part = F.when(F.col("source").isNull() | (F.col("source") != "sin_imagen"), F.struct("page", text.alias("t")))
    return pages.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["t"]), "\n").alias("text"))
