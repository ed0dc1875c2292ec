"""URL filter: explicit rules, then a path-template tree judged by smoothed labelled purity.

Each host has a tree of path segments. Numbers and long hexadecimal segments are
wildcards from the start. Literal siblings whose share of good labels does not differ from that of their
siblings' labels by a two-proportion z-test (or that have no labels at all) are merged into a
wildcard. Then, from the top down, the segments behind each wildcard are tested again over all that was
merged with them, and those that differ come back. How many siblings there are, or how deep a path
is, decides nothing. A template is blocked when its purity, smoothed towards its host's and the corpus'
share of good labels, is below ``min_purity``.

Rules come first: a rule (host, path, verdict) fits its host and all subdomains if the
url's path starts with the rule's path; the longest fitting rule decides.

Scale: a segment can only differ from its siblings where two labelled paths of one host and length part, so only
those levels are tested, and all other levels are wildcards at once. Tests are grouped counts over labelled
paths, with partial aggregation: all levels in one pass for the first test; for the second a pass for each level at which some host has
segments to take back, all other levels in the same pass. Distinct paths are joined with the segments that stay by equi-joins on
(host, prefix, segment); a host with a third of all pages is split by its prefixes and, where one prefix is hot, by
the adaptive skew join. Nothing is broadcast but what adaptive execution measures to be small. Rules are a
short literal list.

Defined cases: a null url or one without ``://`` has empty host and path and one template
of its own; paths of any length are whole; labels may be absent (all templates then carry the prior and are
allowed), several labels of one id count as their largest, null ids have none; pages that share an id share its
label, and repeated rows are judged alike; on a tie no share differs; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import discard, materialize

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
WILD = "*"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for a null url or one without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest fitting rule, null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r_host, r_path, r_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        name = F.when(fits, F.lit(r_host + r_path)).otherwise(name)
        verdict = F.when(fits, F.lit(r_verdict)).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Path segments with numbers and long hexadecimal strings as wildcards, suffix kept."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    return F.transform(parts, lambda s: F.regexp_replace(s, r"^(?:[0-9]+|[0-9a-fA-F-]{16,})(?=$|\.)", WILD))


def prefix(seg: Column, level: Column) -> Column:
    """128-bit hash of the segments above a level; no segment holds a slash."""
    return F.md5(F.array_join(F.slice(seg, F.lit(1), level), "/"))


def parting_levels(marked: DataFrame) -> list[int]:
    """Levels at which labelled paths of one host and length have different segments; at most as many as the deepest path has."""
    at = marked.select("host", F.size("seg").alias("levels"), F.posexplode("seg").alias("level", "child"))
    parts = at.groupBy("host", "levels", "level").agg(F.min("child").alias("lo"), F.max("child").alias("hi")).filter("lo != hi")
    return sorted(r[0] for r in parts.select("level").distinct().collect())


def path_templates(pages: DataFrame, labels: DataFrame, z: float) -> DataFrame:
    """(id, host, template, n, labelled, good) by page; ``labels`` has (id, good)."""
    rows = pages.select("id", "host", segments(F.col("path")).alias("seg"))
    marks = labels.groupBy("id").agg(F.max("good").alias("good"))
    paths = (
        rows.join(marks, "id", "left")
        .groupBy("host", "seg")
        .agg(F.count("*").alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    paths = materialize(paths, "url-paths")
    levels = parting_levels(paths.filter("labelled > 0"))
    wild = paths.withColumn("cur", F.transform("seg", lambda _: F.lit(WILD)))
    if not levels:
        tree = wild
    else:
        tested = F.filter(F.array(*[F.lit(d) for d in levels]), lambda d: d < F.size("seg"))
        place = [F.size("seg").alias("levels"), F.explode(tested).alias("level")]
        at = paths.select("*", *place).withColumn("prefix", prefix(F.col("seg"), F.col("level"))).withColumn("child", F.get("seg", F.col("level")))
        node = ["host", "levels", "level", "prefix"]
        stay = siblings(at.filter("labelled > 0"), node, z).filter("differs").select(*node, "child")
        kept = at.join(stay, [*node, "child"], "left_semi").groupBy("host", "seg").agg(F.collect_set("level").alias("kept"))
        literal = F.transform("seg", lambda s, i: F.when(F.array_contains("kept", i), s).otherwise(WILD))
        first = paths.join(kept, ["host", "seg"], "left").withColumn("cur", F.when(F.col("kept").isNull(), F.transform("seg", lambda _: F.lit(WILD))).otherwise(literal))
        tree = restored(materialize(first.drop("kept").withColumn("next", F.lit(0)), "url-merged"), levels, z)
    tree = tree.withColumn("template", F.concat(F.lit("/"), F.array_join("cur", "/")))
    sums = tree.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    judged = tree.select("host", "seg", "template").join(sums, ["host", "template"])
    return rows.join(judged, ["host", "seg"]).select("id", "host", "template", "n", "labelled", "good")


def restored(tree: DataFrame, levels: list[int], z: float) -> DataFrame:
    """``tree`` with those segments back that differ from what their template merges with them, from the top down.

    All levels from ``next`` on are tested at once. Paths of one host and length take the topmost level at which something comes back, and go
    on behind it; levels at which nothing does cost no round.
    """
    group = ["host", "levels"]
    while True:
        open_ = F.filter(F.array(*[F.lit(d) for d in levels]), lambda d: (d >= F.col("next")) & (d < F.size("seg")) & (F.get("cur", d) == WILD))
        at = tree.filter("labelled > 0").select("host", F.size("seg").alias("levels"), F.col("cur").alias("all"), "seg", "labelled", "good", F.explode(open_).alias("level"))
        parts = at.withColumn("child", F.get("seg", F.col("level")))
        back = siblings(parts, [*group, "all", "level"], z).filter(F.col("differs") & (F.col("child") != WILD))
        back = materialize(back.select(*group, "level", F.col("all").alias("cur"), F.col("child").alias("__child")), "url-back")
        if back.isEmpty():
            discard(back)
            return tree
        top = back.groupBy(*group).agg(F.min("level").alias("__top"))
        here = back.join(top, group).filter("level = __top").select(*group, "cur", "__child", F.lit(True).alias("__back"))
        placed = tree.withColumn("levels", F.size("seg")).join(top, group, "left").withColumn("__child", F.get("seg", F.col("__top")))
        found = placed.join(here, [*group, "cur", "__child"], "left")
        cur = F.when(F.col("__back").isNull(), F.col("cur")).otherwise(F.transform("cur", lambda s, i: F.when(i == F.col("__top"), F.col("__child")).otherwise(s)))
        later = F.coalesce(F.col("__top") + 1, F.lit(1 << 30))  # nothing comes back for the others
        tree = materialize(found.select("host", "seg", "n", "labelled", "good", cur.alias("cur"), later.alias("next")), "url-restored", tree, back)


def siblings(parts: DataFrame, node: list[str], z: float) -> DataFrame:
    """(*node, child, differs): whether a child's share of good labels differs from that of its siblings' labels."""
    child = parts.groupBy(*node, "child").agg(F.sum("labelled").alias("c_n"), F.sum("good").alias("c_good"))
    parent = child.groupBy(*node).agg(F.sum("c_n").alias("p_n"), F.sum("c_good").alias("p_good"))
    o_n, o_good = F.col("p_n") - F.col("c_n"), F.col("p_good") - F.col("c_good")
    pooled = F.col("p_good") / F.col("p_n")
    gap = F.abs(F.col("c_good") / F.col("c_n") - o_good / o_n)
    differs = F.when(
        (F.col("c_n") > 0) & (o_n > 0), gap > z * F.sqrt(pooled * (1 - pooled) * (1 / F.col("c_n") + 1 / o_n)) + 1e-12
    ).otherwise(False)
    return child.join(parent, node).select(*node, "child", differs.alias("differs"))


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    min_purity: float = 0.5,
    strength: float = 20.0,
    z: float = 2.58,
) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) for every page; ``labels``: (id, good 0/1)."""
    host, path = host_path(F.col(url_col))
    own = materialize(
        pages.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), host.alias("host"), path.alias("path")), "url-pages"
    )
    tagged = own.select(F.struct("uid").alias("u"), "id", "host", "path")
    by_page = path_templates(
        tagged.select(F.col("u.uid").alias("id"), "host", "path"),
        tagged.select(F.col("u.uid").alias("uid"), "id").join(labels.groupBy("id").agg(F.max("good").alias("good")), "id").select(F.col("uid").alias("id"), "good"),
        z,
    )
    by_page = materialize(by_page, "url-templates")
    whole = by_page.select("host", "template", "labelled", "good").distinct()
    hosts = whole.groupBy("host").agg(F.sum("labelled").alias("h_n"), F.sum("good").alias("h_good"))
    totals = whole.agg(F.sum("labelled").alias("n"), F.sum("good").alias("good")).first()
    prior = (totals["good"] + 1.0) / (totals["n"] + 1.0) if totals["n"] else 1.0
    host_purity = (F.col("h_good") + strength * prior) / (F.col("h_n") + strength)
    purity = (F.col("good") + strength * host_purity) / (F.col("labelled") + strength)
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = by_page.join(hosts, "host").select(F.col("id").alias("uid"), "template", purity.alias("purity"))
    return own.join(judged, "uid").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
        F.round("purity", 9).alias("purity"),
    )
