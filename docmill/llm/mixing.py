"""Mixing sources to target weights, made of DataFrame functions only.

The words of each source form one stream (documents in a pseudorandom order), cut into
blocks of ``block_words``. The mixture is a sequence of slots in output shards. Each
shard's source counts are multinomial: every slot draws its source from the target shares.
Draws beyond what a source is to give are handed to the sources that drew too few, so that
each source's total meets its target. The k-th slot of a source, counted over all shards,
takes block ``perm(k)`` of the stream, where ``perm`` is a keyed permutation of the source's
full blocks for each pass over it (swap-or-not: a bijection for any length); the short last
block comes at the end of each pass. Blocks are joined to slots, and documents to blocks,
by their index.

Scale: stream offsets are prefix sums over buckets of about ``bucket_docs`` documents inside a source,
and the buckets' own offsets, the shards' offsets and the numbers of surplus slots are prefix sums in
runs of ``RUN`` (``before``), so no task sees more of a source than a bucket, or than one run, or one row for
each run. Draws look their source up by an equi-join on a grid of cells; slot numbers are counts by
shard, summed over shards. Windows without a partition run over the sources only.

Defined cases: null text has size 0; a null source is one more source, last in order; a
document of size 0 takes 0; texts of any length are counted whole, and a long one is cut into blocks like
any other stretch of its source; repeated rows and null ids are documents of their own; an empty table gives
an empty result; ties in the random order are broken by id and size; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import materialize

WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 40
CELLS = 4096
RUN = 4096
#: Rows of one task where rows are small and work on each is not.
TASK_SLOTS = 20_000


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(src, null_src, source_size, docs, weight, target): shares of all words by weight, capped.

    A source stops at ``cap`` times its size and the excess is shared again by weight. The
    end of that process has a closed form: with sources in order of cap / weight, those
    before the first whose cap is not below its part of what is left stop at their caps.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    numbered = sources.withColumn("src", F.row_number().over(ordered) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", "src")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    x = (
        numbered.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(cap))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left_words", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left_words") / F.col("left_weight"))
        .withColumn("final", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "src", "level"))).over(everything))
    )
    target = F.when(F.col("final").isNull() | (F.col("ratio") < F.col("final.level")), F.col("cap")).otherwise(
        F.col("final.level") * F.col("weight")
    )
    return x.select("source", "src", "source_size", "docs", "weight", target.alias("target"))


def permuted(x: Column, n: Column, key: Column) -> Column:
    """Swap-or-not permutation of 0..n-1 at ``x``."""

    def swap(acc: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - acc, n)
        return F.when(F.pmod(F.xxhash64(key, r, F.greatest(acc, other)), F.lit(2)) == 1, other).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swap)


def before(rows: DataFrame, by: list[str], at: str, value: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the sum of ``value`` over the rows of the same ``by`` at smaller ``at`` (a number from 0, once in each).

    Rows are summed in runs of ``RUN`` numbers, and the runs again until few are left.
    """
    run = rows.withColumn("__run", F.floor(F.col(at) / RUN).cast("long"))
    runs = run.groupBy(*by, "__run").agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*by).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("__base", F.coalesce(F.sum("__sum").over(over), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(*by, "__run").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return (
        run.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, [*by, "__run"])
        .withColumn(out, F.col(out) + F.col("__base"))
        .drop("__run", "__base")
    )


def in_tasks(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """Small rows dealt out by ``by`` to as many tasks as costly work on ``n`` of them needs."""
    return rows.repartition(max(1, n // TASK_SLOTS), *by)


@dataclass
class Mixture:
    """spans: the documents' places in their sources' streams; slots: the mixture itself."""

    spans: DataFrame
    targets: DataFrame
    slots: DataFrame
    block_words: int


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 256,
    slots_per_shard: int = 1024,
    bucket_docs: int = 4096,
    seed: int = 17,
) -> Mixture:
    """Spans (id, source, src, size, start), targets, and slots (shard, slot, src, block, words)."""
    sized = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "mix-sizes"
    )
    targets = materialize(source_targets(sized), "mix-targets")
    spans = stream_spans(sized, targets, bucket_docs, seed)
    plan = (
        targets.filter("source_size > 0")
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("full", F.floor(F.col("source_size") / block_words).cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("passes", F.floor(F.col("words") / F.col("source_size")).cast("long"))
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
        .withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("long"))
        .filter("quota > 0")
    )
    plan = materialize(plan, "mix-plan")
    drawn = drawn_slots(plan, slots_per_shard, seed)
    total = plan.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    slots = in_tasks(drawn, total, "slot")  # the permutation is the costly part
    k, n, full = F.col("k"), F.col("blocks"), F.col("full")
    inner, turn = F.pmod(k, n), F.floor(k / n).cast("long")
    block = F.when(inner >= full, full).otherwise(permuted(inner, full, F.xxhash64(F.lit(seed), "src", turn)))
    length = F.when(inner >= full, F.col("source_size") - full * block_words).otherwise(F.lit(block_words))
    words = F.when(turn == F.col("passes"), F.least(length, F.col("rest") - inner * block_words)).otherwise(length)
    placed = slots.join(plan, "src").select("shard", "slot", "src", block.cast("long").alias("block"), words.cast("long").alias("words"))
    return Mixture(spans, targets, placed, block_words)


def stream_spans(sized: DataFrame, targets: DataFrame, bucket_docs: int, seed: int) -> DataFrame:
    """Each document's place in its source's stream; the order is pseudorandom."""
    t = targets.select(F.col("source").alias("t_source"), "src", "docs")
    spread = F.greatest(F.ceil(F.col("docs") / bucket_docs), F.lit(1)).cast("long")
    order = F.xxhash64(F.lit(seed), "id")
    x = (
        sized.join(t, sized.source.eqNullSafe(t.t_source))
        .withColumn("order", order)
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "id", "size"), spread))
        .select("id", "source", "src", "size", "order", "bucket")
    )
    inside = Window.partitionBy("src", "bucket").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sums = x.groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size"))
    base = before(sums, ["src"], "bucket", "bucket_size", "base").drop("bucket_size")
    return (
        x.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(base, ["src", "bucket"])
        .select("id", "source", "src", "size", (F.col("base") + F.col("inner")).alias("start"))
    )


def drawn_slots(plan: DataFrame, slots_per_shard: int, seed: int) -> DataFrame:
    """(shard, slot, src, k): multinomial draws by shard, then surplus handed over; k is 0..quota-1."""
    spark = plan.sparkSession
    total = plan.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    shares = Window.partitionBy()
    running = Window.orderBy("src")
    cdf = (
        plan.withColumn("high", F.sum("quota").over(running) / F.sum("quota").over(shares))
        .withColumn("low", F.lag("high", 1, 0.0).over(running))
        .select("src", "low", "high")
    )
    grid = cdf.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))))
    )
    u = F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "slot"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    draws = (
        spark.range(total)
        .select(F.col("id").alias("slot"), F.floor(F.col("id") / slots_per_shard).cast("long").alias("shard"))
        .withColumn("u", u)
        .withColumn("cell", F.floor(F.col("u") * CELLS))
        .join(grid, "cell")
        .filter("u >= low and u < high")
        .select("shard", "slot", "src")
    )
    draws = materialize(draws, "mix-draws")
    within = Window.partitionBy("shard", "src").orderBy("slot")
    counts = draws.groupBy("shard", "src").agg(F.count("*").alias("n"))
    counts = materialize(counts, "mix-counts")
    starts = before(counts, ["src"], "shard", "n", "begin").drop("n")
    numbered = (
        draws.withColumn("r", F.row_number().over(within) - 1)
        .join(starts, ["shard", "src"])
        .withColumn("k", F.col("begin") + F.col("r"))
        .join(plan.select("src", "quota"), "src")
        .select("shard", "slot", "src", "k", "quota")
    )
    numbered = materialize(numbered, "mix-numbered", draws)
    one = numbered.filter("k >= quota").select("shard", "slot", F.lit(0).alias("all"), F.lit(1).alias("one"))
    surplus = before(one, ["all"], "slot", "one", "free").select("shard", "slot", "free")
    drawn = counts.groupBy("src").agg(F.sum("n").alias("n"))
    lacks = plan.select("src", "quota").join(drawn, "src", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < quota")
    earlier = F.coalesce(F.sum(F.col("quota") - F.col("n")).over(Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    missing = lacks.withColumn("earlier", earlier).select("src", "n", "earlier", F.explode(F.sequence(F.col("n"), F.col("quota") - 1)).alias("k"))
    missing = missing.select("src", "k", (F.col("earlier") + F.col("k") - F.col("n")).alias("free"))
    handed = surplus.join(missing, "free").select("shard", "slot", "src", "k")
    return numbered.filter("k < quota").select("shard", "slot", "src", "k").unionByName(handed)


def words_taken(mix: Mixture) -> DataFrame:
    """(id, source, size, source_size, target, taken): what the mixture takes of each document."""
    b = mix.block_words
    used = mix.slots.groupBy("src", "block").agg(
        F.sum(F.when(F.col("words") >= b, 1).otherwise(0)).alias("whole"), F.collect_list(F.when(F.col("words") < b, F.col("words"))).alias("parts")
    )
    s = mix.spans.filter("size > 0").withColumn("uid", F.monotonically_increasing_id())
    s = materialize(s, "mix-spans")
    pieces = s.select(
        "uid",
        "src",
        F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))).alias("block"),
        "start",
        "size",
    )
    low = F.greatest(F.col("start") - F.col("block") * b, F.lit(0))
    high = F.least(F.col("start") + F.col("size") - F.col("block") * b, F.lit(b))
    part = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + F.greatest(F.least(p, high) - low, F.lit(0)))
    got = (
        pieces.join(used, ["src", "block"])
        .groupBy("uid")
        .agg(F.sum((high - low) * F.col("whole") + part).alias("taken"))
    )
    t = mix.targets.select("src", "source_size", "target")
    whole = s.join(got, "uid", "left").select("id", "source", "src", "size", "taken")
    empty = mix.spans.filter("size = 0").select("id", "source", "src", "size", F.lit(0).cast("long").alias("taken"))
    return (
        whole.unionByName(empty)
        .join(t, "src")
        .select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
