"""Values carried along an order, in two levels, so that no key is one task.

Rows of a key are cut into cells of their order (an hour, some thousand places). A window runs inside each cell; what a cell begins with is
carried over from the cells before it, of which one short row each is left. A key with a third of all rows is as many tasks as it has cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_


def cell(df: DataFrame, order: str, width: float) -> Column:
    """Number of the cell of a time (``width`` in seconds) or of a number; null for null."""
    if isinstance(df.schema[order].dataType, (T_.TimestampType, T_.TimestampNTZType, T_.DateType)):
        return F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(int(width * 1e6)))
    return F.floor(F.col(order) / F.lit(width))


def carried(df: DataFrame, key: str, order: list[str], value: Column, out: str, width: float, before: bool = False) -> DataFrame:
    """``df`` with ``out``: the last value that is not null at or before each row of its key, or only ``before`` it.

    The first column of ``order`` makes the cells; rows equal in all of ``order`` stand in no certain order. Null keys are one key; rows
    whose first order is null come first.
    """
    rows = df.withColumn("__v", value).withColumn("__cell", F.coalesce(cell(df, order[0], width), F.lit(-(1 << 62))))
    inside = Window.partitionBy(key, "__cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    last = rows.filter("__v is not null").groupBy(F.col(key).alias("__key"), F.col("__cell").alias("__of_cell")).agg(F.max_by("__v", F.struct(*order)).alias("__last"))
    # cells without a value take what came before them, so all cells stand in the order
    cells = rows.select(F.col(key).alias("__key"), F.col("__cell").alias("__of_cell")).distinct()
    known = cells.alias("a").join(last.alias("b"), F.expr("a.__key <=> b.__key AND a.__of_cell = b.__of_cell"), "left").select("a.__key", "a.__of_cell", "__last")
    along = Window.partitionBy("__key").orderBy("__of_cell").rowsBetween(Window.unboundedPreceding, -1)
    begins = known.select("__key", "__of_cell", F.last("__last", ignorenulls=True).over(along).alias("__begin"))
    found = rows.withColumn("__in", F.last("__v", ignorenulls=True).over(inside))
    joined = found.join(begins, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__cell") == F.col("__of_cell")), "left")
    return joined.withColumn(out, F.coalesce("__in", "__begin")).drop("__v", "__cell", "__in", "__key", "__of_cell", "__begin")


def runs(rows: DataFrame, key: str, pos: str, width: int = 4096) -> DataFrame:
    """(key, start, end) of the maximal runs of successive whole numbers ``pos`` in the rows of each key; end is exclusive.

    Runs inside a cell are done there. Only those that touch a border, two a cell at most, are put together over cells.
    """
    cut = rows.select(F.col(key).alias("__key"), F.col(pos).cast("long").alias("p")).distinct().withColumn("c", F.floor(F.col("p") / width))
    island = F.col("p") - F.row_number().over(Window.partitionBy("__key", "c").orderBy("p"))
    each = cut.withColumn("i", island).groupBy("__key", "c", "i").agg(F.min("p").alias("start"), (F.max("p") + 1).alias("end"))
    touches = (F.col("start") == F.col("c") * width) | (F.col("end") == (F.col("c") + 1) * width)
    along = Window.partitionBy("__key").orderBy("start")
    new = F.when(F.lag("end").over(along) == F.col("start"), 0).otherwise(1)
    edge = each.filter(touches).withColumn("new", new).withColumn("g", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edge.groupBy("__key", "g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return each.filter(~touches).select("__key", "start", "end").unionByName(joined.select("__key", "start", "end")).withColumnRenamed("__key", key)


def nearest_rank(samples: DataFrame, by: list[str], value: str, share: float, cells: int = 1024) -> DataFrame:
    """(*by, rank_value): the smallest value of each group that at least ``share`` of its values do not exceed; nulls do not count.

    Values are counted in ``cells`` ranges between the least and the greatest of their group; only the range that holds the rank
    is then ordered, with equal values as one row. So no group is gathered in one place. NaN is greater than all numbers.
    """
    keys = [F.col(c).alias(f"__{k}") for k, c in enumerate(by)]
    names = [f"__{k}" for k in range(len(by))]
    counted = samples.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    finite = ~F.isnan("v") & (F.abs("v") < float("inf"))
    ends = counted.groupBy(*names).agg(F.min(F.when(finite, F.col("v"))).alias("low"), F.max(F.when(finite, F.col("v"))).alias("high"), F.sum("n").alias("all"))
    null_safe = lambda a, b: " AND ".join([f"{a}.{x} <=> {b}.{x}" for x in names] or ["true"])
    ranked = counted.alias("a").join(ends.alias("b"), F.expr(null_safe("a", "b"))).select("a.*", "low", "high", F.greatest(F.lit(1), F.ceil(F.col("all") * share)).cast("long").alias("rank"))
    inside = F.least(F.floor(F.try_divide((F.col("v") - F.col("low")) * cells, F.col("high") - F.col("low"))), F.lit(cells - 1))
    spot = F.when(F.isnan("v") | (F.col("v") == float("inf")), cells).when(F.col("v") == float("-inf"), -1).otherwise(F.coalesce(inside, F.lit(0)))
    placed = ranked.withColumn("cell", spot.cast("int"))
    sums = placed.groupBy(*names, "rank", "cell").agg(F.sum("n").alias("held"))
    upto = F.sum("held").over(Window.partitionBy(*names).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    chosen = sums.withColumn("upto", upto).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("held") < F.col("rank"))).select(*names, "cell", (F.col("rank") - F.col("upto") + F.col("held")).alias("left"))
    near = placed.alias("a").join(chosen.alias("b"), F.expr(null_safe("a", "b") + " AND a.cell = b.cell")).select(*[f"a.{x}" for x in names], "v", "n", "left")
    within = F.sum("n").over(Window.partitionBy(*names).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    found = near.withColumn("within", within).filter("within >= left").groupBy(*names).agg(F.min("v").alias("rank_value"))
    return found.select(*[F.col(x).alias(c) for x, c in zip(names, by)], "rank_value")
