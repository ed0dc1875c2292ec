"""Geometry of page regions: gaps, validity, projection and reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import GUTTER, REGION_HEIGHT
from ..functions.text import scan
from .carry import runs


def zero_runs(cells: DataFrame, key: str, pos: str, value: str, min_run: int = 8) -> DataFrame:
    """(key, start, end) of runs of zeros of at least ``min_run`` cells (gaps and islands)."""
    return runs(cells.filter(F.col(value) == 0), key, pos).filter(F.col("end") - F.col("start") >= min_run)


def valid_regions(regions: DataFrame, key: str, order: str, width: Column, height: Column) -> DataFrame:
    """Regions inside the page and high enough; the first of equal ones."""
    inside = (
        (F.col("left") >= 0) & (F.col("left") < F.col("right")) & (F.col("right") <= width) & (F.col("top") >= 0) & (F.col("top") < F.col("bottom")) & (F.col("bottom") <= height)
    )
    w = Window.partitionBy(key, "left", "top", "right", "bottom").orderBy(order)
    return regions.filter(inside & (F.col("bottom") - F.col("top") >= REGION_HEIGHT)).withColumn("nth", F.row_number().over(w)).filter("nth = 1").drop("nth")


def project(low: Column, high: Column, size: Column, scaled: Column, margin: int = 0) -> tuple[Column, Column]:
    """A reduced interval at full size: rounded outwards, with a margin, inside the page."""
    a = F.greatest(F.lit(0), F.floor(low * size / scaled) - margin)
    b = F.least(size, F.ceil(high * size / scaled) + margin)
    return a, b


def reading_order(regions: DataFrame, key: str) -> DataFrame:
    """(key, regions): array<struct<left,top,right,bottom>> of each page, by column and then from the top.

    A column begins with a region more than half a gutter right of the first region of the column
    before it, so the scan carries that first edge.
    """
    def step(state: Column, r: Column) -> Column:
        new = state["anchor"].isNull() | (r["left"] - state["anchor"] > GUTTER // 2)
        return F.struct(F.when(new, r["left"]).otherwise(state["anchor"]).alias("anchor"), (state["column"] + F.when(new, 1).otherwise(0)).alias("column"))

    start = F.struct(F.lit(None).cast(regions.schema["left"].dataType).alias("anchor"), F.lit(0).alias("column"))
    rows = regions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("left", "top", "right", "bottom"))).alias("all"))
    columns = rows.withColumn("columns", scan(F.col("all"), start, step, lambda s: s["column"]))
    placed = F.zip_with("all", "columns", lambda r, c: F.struct(c.alias("column"), r["top"].alias("top"), r["left"].alias("left"), r["right"].alias("right"), r["bottom"].alias("bottom")))
    return columns.select(key, F.transform(F.array_sort(placed), lambda r: F.struct(r["left"].alias("left"), r["top"].alias("top"), r["right"].alias("right"), r["bottom"].alias("bottom"))).alias("regions"))
