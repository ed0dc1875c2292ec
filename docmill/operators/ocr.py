"""OCR output: word tables, lines and page text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

FIELDS = "level page_num block_num par_num line_num word_num left top width height conf text".split()


def tsv_words(df: DataFrame, key: str, tsv: str) -> DataFrame:
    """(key, pos, block, par, line, conf, word): rows of a tab-separated word table with a confidence and a text."""
    rows = df.select(key, F.split(F.element_at(F.split(tsv, "\n", -1), 1), "\t", -1).alias("head"), F.posexplode(F.split(tsv, "\n", -1)).alias("pos", "row")).filter("pos > 0 and row != ''")
    cells = F.split("row", "\t", -1)
    field = lambda n: F.get(cells, (F.array_position("head", F.lit(n)) - 1).cast("int"))
    number = lambda n: F.coalesce(field(n).try_cast("int"), F.lit(0))
    out = rows.select(
        key,
        "pos",
        number("block_num").alias("block"),
        number("par_num").alias("par"),
        number("line_num").alias("line"),
        field("conf").try_cast("double").alias("conf"),
        strip(F.coalesce(field("text"), F.lit(""))).alias("word"),
    )
    return out.filter("conf >= 0 and word != ''")


def confidence(words: DataFrame, key: str) -> DataFrame:
    """(key, conf, words): mean confidence and number of words."""
    return words.groupBy(key).agg(F.round(F.coalesce(F.avg("conf"), F.lit(0.0)), 6).alias("conf"), F.count("*").alias("words"))


def text_lines(words: DataFrame, key: str) -> DataFrame:
    """(key, text): words joined to lines in the order of block, paragraph and line."""
    line = F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"])
    lines = words.groupBy(key, "block", "par", "line").agg(F.array_join(line, " ").alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block", "par", "line", "t"))), lambda x: x["t"])
    return lines.groupBy(key).agg(F.array_join(ordered, "\n").alias("text"))
