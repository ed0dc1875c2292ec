"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a grouped minimum, combined before it is shuffled, and joined back on its key. Where the links
are counted to be few, the minima are broadcast and links stay where they are, so a hub with a third of
them is no task of its own; beyond that an equi-join finds them, which adaptive execution can split. Links are
written to the shared folder after each round; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import BROADCAST_ROWS, materialize


def _stars(pairs: DataFrame, few: bool) -> DataFrame:
    """(u, v) with the smallest v of each u added as m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(F.broadcast(least) if few else least, "u")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link to another; root is the component's smallest node.

    Links to itself and repeated links are allowed; null nodes have no links.
    """
    state = None
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = materialize(e, "links")
    # a link names two nodes, and no step adds one, so there are at most as many minima
    few = 2 * e.count() <= BROADCAST_ROWS
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, few).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _stars(large, few)
        next_links = small.select("u", F.col("m").alias("v")).unionByName(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        e = materialize(next_links, "links", e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
