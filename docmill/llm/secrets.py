"""Secret scan with multipart credential linking, made of DataFrame functions only.

Base spans are found by pattern (``assign``, ``access``, ``hex``) and are always reported.
Weak candidates (``weak_id``, ``weak_secret``, ``endpoint``) mean little alone: each is
reported only when its complementary parts lie within ``scope`` code points of it, end to start:

* a weak secret needs an identifier nearby, a weak identifier needs a secret nearby;
* an endpoint needs both an identifier and a secret nearby;
* base ``access`` spans are identifiers, base ``assign`` and ``hex`` spans are secrets.

Nearness is the gap between two spans, whatever their lengths. The link is an interval join by
an equi-join on (document, cell of ``scope`` code points). A part is in every cell that it touches, a
weak candidate in every cell that it touches when widened by ``scope``. Before the join, the parts of a
cell are reduced to their smallest and largest point, which decide whether any part lies near enough; so
a document full of candidates makes rows in proportion to their number and length, never one for each pair.
Overlaps of weak candidates with base spans are settled by one sweep over both in order.

Scale: a text is scanned where it is read, and only spans travel. Work in one text is linear in its
length and n log n in its spans: offsets are running sums in two levels, never a growing array copied for
each match.

Defined cases: null text is empty; texts of any length are whole; offsets are code points, ends
exclusive; a weak candidate that overlaps a base span is dropped, the base span covers it; spans that start
together stand in the order of their kinds; repeated rows and null ids give results of their own, row by
row; further columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import materialize

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{32,})"
WEAK_ID = r"""((?i:access_?key(?:_?id)?|client_?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,})"""
WEAK_SECRET = r"((?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=]))"
ENDPOINT = r"""((?i:https?|ftp|jdbc:[a-z]+|s3|redis|mongodb|amqp)://[^\s"'<>]+)"""
#: kind: pattern, group whose length counts, least length, quick test, part
KINDS = {
    "assign": (ASSIGN, 2, 8, r"(?i:password|passwd|secret|token|api_?key)", "secret"),
    "access": (ACCESS, 1, 16, None, "id"),
    "hex": (HEX, 1, 32, r"[0-9a-f]{32}", "secret"),
    "weak_id": (WEAK_ID, 1, 0, r"(?i:access_?key|client_?id|user|login)", "id"),
    "weak_secret": (WEAK_SECRET, 1, 0, r"[A-Za-z0-9+/]{40}", "secret"),
    "endpoint": (ENDPOINT, 1, 0, None, "endpoint"),
}
BASE = ("assign", "access", "hex")
WEAK = tuple(k for k in KINDS if k not in BASE)
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"
#: Elements that a running sum adds up before it starts another array.
RUN = 256


def matches_of(text: Column, kind: str) -> Column:
    """array<struct<gap, len, n>> of one kind: code points before a match since the last one, its own, and those that count; null without any."""
    pattern, group, _, quick, _ = KINDS[kind]
    test = F.contains(text, F.lit("AKIA")) if kind == "access" else F.contains(text, F.lit("://")) if quick is None else text.rlike(quick)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    counted = whole if group == 1 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # split cuts at the same matches, so its parts are the gaps; the last one, behind all matches, has no match of its own
    found = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(whole, F.length).alias("len"), F.transform(counted, F.length).alias("n"))
    return F.when(test, F.filter(found, lambda x: x["len"].isNotNull()))


def running(sums: Column, of: Column) -> Column:
    """Running sums over the array ``of``, given the running sums before each run of RUN elements; linear but for the number of runs."""
    zero = F.expr("cast(array() as array<int>)")

    def inside(k: Column) -> Column:
        begin = F.get(sums, k)
        part = F.slice(of, k * RUN + 1, RUN)
        return F.aggregate(part, F.struct(begin.alias("at"), zero.alias("ends")), lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["ends"], F.array(acc["at"] + x)).alias("ends")))["ends"]

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(sums) - 2), inside))


def run_sums(of: Column) -> Column:
    """Sums of the array ``of`` before each run of RUN elements, and over all of it."""
    runs = F.sequence(F.lit(0), F.floor((F.size(of) - 1) / RUN).cast("int"))
    each = F.transform(runs, lambda k: F.aggregate(F.slice(of, k * RUN + 1, RUN), F.lit(0), lambda a, x: a + x))
    return F.aggregate(each, F.expr("array(0)"), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def placed(kind: str, matches: Column, ends: Column) -> Column:
    """Spans of one kind from its matches and where they end; those that are too short are left out."""
    least, rank = KINDS[kind][2], list(KINDS).index(kind)
    span = lambda m, e: F.struct((e - m["len"]).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), F.lit(kind).alias("kind"), m["n"].alias("n"))
    long = F.filter(F.zip_with(matches, ends, span), lambda s: s["n"] >= least)
    kept = F.transform(long, lambda s: F.struct(*[s[f].alias(f) for f in ("start", "rank", "end", "kind")]))
    return F.coalesce(kept, F.expr(f"cast(array() as {SPANS})"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, uid, base, weak): the spans of every row, sorted by start and kind; uid tells rows with any span apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # each step is a projection of its own, as the next one uses its columns several times
    x = docs.select(F.col(id_col).alias("id"), text.alias("t")).select("id", *[matches_of(F.col("t"), k).alias(f"m_{k}") for k in KINDS])
    steps = [F.transform(f"m_{k}", lambda m: m["gap"] + m["len"]).alias(f"s_{k}") for k in KINDS]
    x = x.select("*", *steps)
    x = x.select("*", *[F.when(F.size(f"s_{k}") > 0, run_sums(F.col(f"s_{k}"))).alias(f"r_{k}") for k in KINDS])
    x = x.select("id", *[f"m_{k}" for k in KINDS], *[running(F.col(f"r_{k}"), F.col(f"s_{k}")).alias(f"e_{k}") for k in KINDS])
    found = {k: placed(k, F.col(f"m_{k}"), F.col(f"e_{k}")) for k in KINDS}
    base, weak = (F.array_sort(F.concat(*[found[k] for k in kinds])) for kinds in (BASE, WEAK))
    return x.select("id", F.monotonically_increasing_id().alias("uid"), base.alias("base"), weak.alias("weak"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 400) -> DataFrame:
    """(id, base, spans): arrays of struct<start, rank, end, kind>, sorted by start and rank."""
    arrays = materialize(all_spans(docs, id_col, text_col), "secret-spans")
    linked = link_parts(arrays, scope)
    return (
        arrays.join(linked, "uid", "left")
        .withColumn("spans", F.array_sort(F.concat("base", F.coalesce("linked", F.expr(f"cast(array() as {SPANS})")))))
        .select(F.col("id").alias(id_col), "base", "spans")
    )


def clear_of_base(some: DataFrame) -> DataFrame:
    """(uid, s): base spans, and the weak ones that overlap none of them.

    A weak span overlaps a base span if, of the base spans that start before its end, the one that reaches
    farthest ends behind its start; a sweep over base starts and weak ends keeps that point.
    """
    s = some.select("uid", F.explode(F.concat("base", "weak")).alias("s"))
    is_base = F.col("s.kind").isin(*BASE)
    # at one point, weak ends come first: a base span that starts there does not overlap
    sweep = Window.partitionBy("uid").orderBy(F.when(is_base, F.col("s.start")).otherwise(F.col("s.end")), is_base).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(is_base, F.col("s.end"))).over(sweep)
    return s.withColumn("reach", reach).filter(is_base | F.col("reach").isNull() | (F.col("reach") <= F.col("s.start"))).select("uid", "s")


def link_parts(arrays: DataFrame, scope: int) -> DataFrame:
    """(uid, linked): the weak candidates whose complementary parts lie within ``scope``."""
    part = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[4])])
    some = materialize(clear_of_base(arrays.filter(F.size("weak") > 0)), "secret-parts")
    cell = lambda x: F.floor(x / scope)
    cells = lambda lo, hi: F.sequence(cell(lo), cell(hi))
    start, end = F.col("s.start"), F.col("s.end")
    # both ends of a part, and where it enters a cell: any range of two cells' length that it meets holds one of them
    points = F.concat(F.transform(cells(start, end), lambda c: F.greatest(start.cast("long"), c * scope)), F.array(end.cast("long")))
    parts = (
        some.select("uid", part[F.col("s.kind")].alias("part"), points.alias("points"))
        .filter("part != 'endpoint'")
        .select("uid", "part", F.explode("points").alias("point"))
        .groupBy("uid", "part", cell(F.col("point")).alias("cell"))
        .agg(F.min("point").alias("first"), F.max("point").alias("last"))
    )
    lo, hi = F.col("w.start") - scope, F.col("w.end") + scope
    weak = some.filter(F.col("s.kind").isin(*WEAK)).select("uid", F.col("s").alias("w")).select("uid", "w", F.explode(cells(lo, hi)).alias("cell"))
    near = (F.col("first") <= hi) & (F.col("last") >= lo)
    seen = (
        weak.join(parts, ["uid", "cell"])
        .filter(near)
        .groupBy("uid", "w")
        .agg(F.bool_or(F.col("part") == "id").alias("has_id"), F.bool_or(F.col("part") == "secret").alias("has_secret"))
    )
    kind = F.col("w.kind")
    complete = (
        F.when(kind == "weak_secret", F.col("has_id")).when(kind == "weak_id", F.col("has_secret")).otherwise(F.col("has_id") & F.col("has_secret"))
    )
    return seen.filter(complete).groupBy("uid").agg(F.collect_list("w").alias("linked"))
