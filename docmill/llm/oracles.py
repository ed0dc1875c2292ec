"""DuckDB SQL for the registered queries that SQL can express, each by exhaustive means: all pairs, all items, all windows."""

from __future__ import annotations

from .secrets import BASE, KINDS
from .url_filter import RULES

#: White space as Python splits at it.
BLANK = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"


def _words(text: str, pattern: str = r"[\p{L}\p{N}_]+") -> str:
    return f"regexp_extract_all(lower({text}), '{pattern}')"


EXACT = r"""
    WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY norm)
"""


def _spans(kind: str) -> str:
    """(doc_id, start, rank, end, kind): matches are placed by the lengths of what stands between them."""
    pattern, group, least, _, part = KINDS[kind]
    rank = list(KINDS).index(kind)
    if kind == "weak_secret":  # no look-around here: whole runs of the signs, of forty characters and without =
        pattern, keep = "([A-Za-z0-9+/=]+)", "length(m) = 40 AND NOT contains(m, '=')"
    else:
        keep = f"length(regexp_extract(m, '{_quoted(pattern)}', {group})) >= {least}"
    p = _quoted(pattern)
    return f"""SELECT doc_id, e - length(m) AS s, {rank} AS rank, e, '{kind}' AS kind, '{part}' AS part FROM (
      SELECT doc_id, m, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS BIGINT) AS e FROM (
       SELECT doc_id, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(regexp_split_to_array(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) AS gap,
        generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS k FROM d)) WHERE {keep}"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


SECRETS = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS MATERIALIZED ({" UNION ALL ".join(_spans(k) for k in KINDS)}),
    base AS (SELECT * FROM found WHERE kind IN {BASE}),
    weak AS (SELECT * FROM found w WHERE kind NOT IN {BASE} AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.s < w.e AND w.s < b.e)),
    parts AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
    near AS (SELECT w.doc_id, w.s, w.rank, w.e, w.kind, bool_or(p.part = 'id') AS has_id, bool_or(p.part = 'secret') AS has_secret
      FROM weak w JOIN parts p ON p.doc_id = w.doc_id AND p.s - w.e <= 400 AND w.s - p.e <= 400 GROUP BY ALL),
    linked AS (SELECT doc_id, s, rank, e, kind FROM near WHERE CASE kind WHEN 'weak_secret' THEN has_id WHEN 'weak_id' THEN has_secret ELSE has_id AND has_secret END),
    spans AS (SELECT doc_id, s, rank, e, kind, true AS own FROM base UNION ALL SELECT doc_id, s, rank, e, kind, false FROM linked),
    texts AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
      coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE own), '') AS base,
      {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)} FROM spans GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN texts USING (doc_id)
"""

NEAR = rf"""
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{BLANK}'), lambda w: w <> '') AS w FROM documents),
    k AS (SELECT doc_id, array_to_string(w, ' ') AS key, w FROM d),
    t AS MATERIALIZED (SELECT key, min(doc_id) AS rep, count(*) AS copies, any_value(w) AS w FROM k GROUP BY key),
    s AS MATERIALIZED (SELECT rep, unnest(list_distinct(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: md5(array_to_string(w[i:i + 4], ' '))))) AS sh FROM t WHERE len(w) > 0),
    n AS MATERIALIZED (SELECT rep, count(*) AS n FROM s GROUP BY rep),
    p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS both_hold FROM s a JOIN s b ON a.sh = b.sh AND a.rep < b.rep GROUP BY ALL),
    l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.rep = a JOIN n y ON y.rep = b WHERE both_hold >= 0.8 * (x.n + y.n - both_hold) - 1e-9),
    e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT rep AS a, rep AS b FROM t UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
    c AS (SELECT a AS rep, min(b) AS class_id FROM r GROUP BY a),
    g AS (SELECT e.a AS rep, sum(copies) AS links FROM e JOIN t ON t.rep = e.b GROUP BY e.a)
    SELECT doc_id, class_id, CAST(coalesce(links, 0) + copies - 1 AS BIGINT) AS n_links, t.rep AS rep_id
    FROM k JOIN t USING (key) JOIN c ON c.rep = t.rep LEFT JOIN g ON g.rep = t.rep
"""

LINES = rf"""
    WITH d AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents),
    u AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS place FROM d),
    f AS (SELECT doc_id, line, place, len(list_filter(regexp_split_to_array(line, '{BLANK}'), lambda w: w <> '')) AS words FROM u WHERE regexp_matches(line, '[^\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}]')),
    o AS MATERIALIZED (SELECT doc_id, line, place, row_number() OVER w - 1 AS pos, sum(words) OVER w - words AS before, sum(words) OVER w AS upto FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    a AS (SELECT x.doc_id, x.pos, min(y.pos) AS last FROM o x JOIN o y ON y.doc_id = x.doc_id AND y.pos >= x.pos AND y.upto - x.before >= 50 GROUP BY ALL),
    z AS (SELECT x.doc_id, max(y.pos) AS pos, x.pos AS last FROM o x JOIN o y ON y.doc_id = x.doc_id AND y.pos <= x.pos AND x.upto - y.before >= 50 GROUP BY x.doc_id, x.pos),
    v AS MATERIALIZED (SELECT w.doc_id, w.pos, w.last, md5(string_agg(o.line, chr(10) ORDER BY o.pos)) AS content FROM (SELECT * FROM a UNION SELECT doc_id, pos, last FROM z) w JOIN o ON o.doc_id = w.doc_id AND o.pos BETWEEN w.pos AND w.last GROUP BY ALL),
    q AS (SELECT content, min((doc_id, pos)) AS first FROM v GROUP BY content),
    gone AS (SELECT DISTINCT v.doc_id, unnest(range(v.pos, v.last + 1)) AS pos, q.first, v.last - v.pos AS more FROM v JOIN q USING (content) WHERE (v.doc_id, v.pos) > q.first),
    x AS (SELECT doc_id, list_sort(list(DISTINCT place)) AS dropped FROM gone JOIN o USING (doc_id, pos) WHERE NOT (first[1] = doc_id AND pos BETWEEN first[2] AND first[2] + more) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(lines) AS INT) AS n_lines, CAST(coalesce(len(dropped), 0) AS INT) AS n_dropped, coalesce(array_to_string(dropped, ','), '') AS dropped FROM d LEFT JOIN x USING (doc_id)
"""

LEAKS = rf"""
    WITH i AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
    c AS (SELECT item_id, text, {_words("text")} AS words, regexp_replace(text, '[\s]+$', '') AS r, rtrim(text, ' .!' || chr(10)) AS z FROM i),
    cuts AS (SELECT *, [CASE WHEN contains(text, '?') THEN length(text) - strpos(reverse(text), '?') + 1 ELSE 0 END,
       CASE WHEN contains(r, chr(10)) THEN length(r) - strpos(reverse(r), chr(10)) + 1 ELSE 0 END,
       greatest(CASE WHEN contains(z, '.') THEN length(z) - strpos(reverse(z), '.') + 1 ELSE 0 END, CASE WHEN contains(z, '!') THEN length(z) - strpos(reverse(z), '!') + 1 ELSE 0 END)] AS cut
      FROM c WHERE len(words) > 0),
    sides AS (SELECT *, list_filter(list_transform(cut, lambda x: {{'q': {_words("substr(text, 1, x)")}, 'a': {_words("substr(text, x + 1)")}}}), lambda s: len(s.q) > 0 AND len(s.a) > 0) AS found,
       greatest(1, len(words) - greatest(1, len(words) // 4)) AS most FROM cuts),
    it AS MATERIALIZED (SELECT item_id, text, words, greatest(64, CAST(pow(2, ceil(log2(len(words)))) AS INT)) AS half,
       CASE WHEN len(found) > 0 THEN found[1].q ELSE words[1:most] END AS q, CASE WHEN len(found) > 0 THEN found[1].a ELSE words[most + 1:] END AS a FROM sides),
    tf AS (SELECT item_id, text, half, len(words) AS n, term, count(*) AS tf FROM (SELECT *, unnest(words) AS term FROM it) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    size AS (SELECT count(*) AS items, avg(len(words)) AS mean FROM it),
    raw AS (SELECT item_id, text, half, term, ln(1 + (items - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) AS w FROM tf JOIN df USING (term), size),
    weight AS MATERIALIZED (SELECT item_id, text, half, term, w / sum(w) OVER (PARTITION BY item_id, text) AS w FROM raw),
    d AS MATERIALIZED (SELECT doc_id, {_words("text")} AS words FROM documents WHERE text IS NOT NULL),
    h AS (SELECT DISTINCT half FROM it),
    win AS MATERIALIZED (SELECT doc_id, half, k, words[k * half + 1:(k + 2) * half] AS passage FROM (SELECT doc_id, words, half, unnest(range(greatest(1, CAST(ceil(len(words) / half) AS INT) - 1))) AS k FROM d, h)),
    terms AS (SELECT doc_id, half, k, unnest(list_distinct(passage)) AS term FROM win),
    score AS (SELECT doc_id, item_id, text, half, k, round(sum(w), 9) AS score FROM terms JOIN weight USING (half, term) GROUP BY ALL HAVING sum(w) >= 0.6 - 1e-6),
    pairs AS (SELECT doc_id, item_id, text, score, passage, [q, a] AS parts FROM score JOIN win USING (doc_id, half, k) JOIN it USING (item_id, text)),
    held AS (SELECT doc_id, item_id, text, score, list_transform(parts, lambda p: CASE WHEN len(p) = 0 THEN 1.0 ELSE
        len(list_intersect(list_distinct(list_transform(range(1, greatest(2, len(p) - 3)), lambda x: array_to_string(p[x:x + least(5, len(p)) - 1], ' '))),
          list_distinct(list_transform(range(1, len(passage) - least(5, len(p)) + 2), lambda x: array_to_string(passage[x:x + least(5, len(p)) - 1], ' '))))) * 1.0
        / len(list_distinct(list_transform(range(1, greatest(2, len(p) - 3)), lambda x: array_to_string(p[x:x + least(5, len(p)) - 1], ' ')))) END) AS o FROM pairs),
    best AS (SELECT doc_id, item_id, text, max((score, o[1], o[2])) AS b FROM held WHERE o[1] >= 0.8 AND o[2] >= 0.8 GROUP BY ALL)
    SELECT doc_id, item_id, round(b[1], 6) AS score, CAST(b[2] AS DOUBLE) AS question_overlap, CAST(b[3] AS DOUBLE) AS answer_overlap FROM best
"""


def _siblings(name: str, source: str, node: str) -> str:
    """CTEs ending in ``name`` (node, child): children whose share of good labels differs from that of their siblings."""
    return f"""{name}_c AS (SELECT {node}, child, sum(labelled) AS cn, sum(good) AS cg FROM {source} WHERE labelled > 0 GROUP BY ALL),
    {name}_p AS (SELECT *, sum(cn) OVER (PARTITION BY {node}) AS pn, sum(cg) OVER (PARTITION BY {node}) AS pg FROM {name}_c),
    {name} AS MATERIALIZED (SELECT {node}, child FROM {name}_p WHERE pn > cn AND abs(cg / cn - (pg - cg) / (pn - cn))
      > 2.58 * sqrt((pg / pn) * (1 - pg / pn) * (1 / cn + 1 / (pn - cn))) + 1e-12)"""


def _levels(depth: int) -> str:
    """Restoring from the top down, a table t1..t<depth> after each level."""
    steps = []
    for d in range(depth):
        steps.append(f"m{d} AS (SELECT *, seg[{d + 1}] AS child FROM t{d} WHERE len(cur) > {d} AND cur[{d + 1}] = '*')")
        steps.append(_siblings(f"b{d}", f"m{d}", "host, cur"))
        steps.append(f"""t{d + 1} AS MATERIALIZED (SELECT t.host, seg, n, labelled, good, CASE WHEN b.child IS NULL THEN t.cur ELSE list_transform(t.cur, lambda s, i: CASE WHEN i = {d + 1} THEN b.child ELSE s END) END AS cur
      FROM t{d} t LEFT JOIN b{d} b ON b.host = t.host AND b.cur = t.cur AND b.child = seg[{d + 1}] AND b.child <> '*')""")
    return ", ".join(steps)


def _rule(what: int) -> str:
    fits = lambda r: f"(host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}')"
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r[0] + r[1] if what == 0 else r[2]}'" for r in ordered) + " END"


#: Paths of more levels than the restoring steps written out here do not occur in the tables that are compared.
DEPTH = 8
URLS = rf"""
    WITH r AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
    u AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM r),
    s AS MATERIALIZED (SELECT *, list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda x: regexp_replace(x, '^(?:[0-9]+|[0-9a-fA-F-]{{16,}})($|\.)', '*\1')) AS seg,
      TRY_CAST(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[^/]*|[^/0-9]*)/*$', 1), '') AS BIGINT) AS doc_id FROM u),
    l AS (SELECT doc_id, max(quality) AS mark FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    paths AS MATERIALIZED (SELECT host, seg, count(*) AS n, CAST(count(mark) AS DOUBLE) AS labelled, CAST(coalesce(sum(mark), 0) AS DOUBLE) AS good FROM s LEFT JOIN l USING (doc_id) GROUP BY host, seg),
    lv AS (SELECT *, len(seg) AS levels, unnest(range(len(seg))) AS level FROM paths),
    node AS MATERIALIZED (SELECT *, array_to_string(seg[1:level], '/') AS prefix, seg[level + 1] AS child FROM lv),
    {_siblings("k", "node", "host, levels, level, prefix")},
    kept AS (SELECT host, seg, list(level) AS kept FROM node JOIN k USING (host, levels, level, prefix, child) GROUP BY host, seg),
    t0 AS MATERIALIZED (SELECT host, seg, n, labelled, good, list_transform(seg, lambda x, i: CASE WHEN kept IS NOT NULL AND list_contains(kept, i - 1) THEN x ELSE '*' END) AS cur FROM paths LEFT JOIN kept USING (host, seg)),
    {_levels(DEPTH)},
    f AS (SELECT host, seg, '/' || array_to_string(cur, '/') AS template, labelled, good FROM t{DEPTH}),
    g AS (SELECT host, template, sum(labelled) AS labelled, sum(good) AS good FROM f GROUP BY ALL),
    hosts AS (SELECT host, sum(labelled) AS hn, sum(good) AS hg FROM g GROUP BY host),
    p AS (SELECT CASE WHEN sum(labelled) > 0 THEN (sum(good) + 1) / (sum(labelled) + 1) ELSE 1.0 END AS prior FROM g),
    j AS (SELECT host, template, (good + 20 * ((hg + 20 * prior) / (hn + 20))) / (labelled + 20) AS purity FROM g JOIN hosts USING (host), p)
    SELECT page_id, host, path, {_rule(0)} AS rule, coalesce({_rule(1)}, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, round(purity, 9) AS purity
    FROM (SELECT page_id, s.host AS host, path, j.template AS template, purity FROM s JOIN f ON f.host = s.host AND f.seg = s.seg JOIN j ON j.host = f.host AND j.template = f.template)
"""


def _crc_table() -> list[int]:
    table = list(range(256))
    for _ in range(8):
        table = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return table


# every pair of near words is written out, from the strings that words leave with one code point replaced or deleted
VARIANTS = f"""
    WITH runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents),
    d AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
    b AS (SELECT *, flatten(list_transform(list_transform(regexp_extract_all(id || ':' || run, '.'), lambda c: unicode(c)), lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END)) AS bytes FROM d),
    h AS (SELECT run, n, length(run) AS len, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, ({_crc_table()}::UBIGINT[])[CAST(xor(a, x::UBIGINT) & 255 AS BIGINT) + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) AS h FROM b),
    p AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % len AS BIGINT)) || substr(run, CAST(h % len AS BIGINT) + 2) ELSE run END AS word, n FROM h),
    w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM p WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    g AS (SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM w)),
    near AS (
      SELECT a.word AS a, c.word AS b, c.n AS bn FROM g a JOIN g c ON a.k = c.k AND a.rest = c.rest AND a.word <> c.word
      UNION SELECT a.word, w.word, w.n FROM g a JOIN w ON a.rest = w.word UNION SELECT w.word, a.word, a.n FROM g a JOIN w ON a.rest = w.word),
    best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-bn, b)) AS best, max(bn) AS best_n FROM near GROUP BY a),
    f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN best USING (word)),
    r AS (WITH RECURSIVE s AS (SELECT word, word AS here, 0 AS k FROM f UNION ALL SELECT s.word, f.form, k + 1 FROM s JOIN f ON f.word = s.here WHERE f.form IS NOT NULL) SELECT word, arg_max(here, k) AS root FROM s GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM f JOIN r USING (word)
"""


# every document goes through every order
AUDIT = r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
    l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
    m AS (SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
            {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), 'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(first < w.doc_id, false)} AS x
          FROM w LEFT JOIN l USING (doc_id)),
    f AS (SELECT part, good, toxic, concat(CASE WHEN x.A THEN 'A' END, CASE WHEN x.B THEN 'B' END, CASE WHEN x.C THEN 'C' END, CASE WHEN x.D THEN 'D' END, CASE WHEN x.E THEN 'E' END) AS fails FROM m),
    s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || e.x || g.x AS filter_order FROM s a, s b, s c, s e, s g WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
    t AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
    j AS (SELECT part, filter_order, CAST(step AS INT) AS step, filter_order[step] AS own, good, toxic, fails, contains(fails, filter_order[step]) AS fail,
            fails <> '' AND regexp_matches(filter_order[:step - 1], '[' || CASE WHEN fails = '' THEN '-' ELSE fails END || ']') AS gone FROM f, t),
    k AS (SELECT part, filter_order, step, own, count(*) FILTER (NOT fail AND NOT gone) AS kept, count(*) FILTER (fail AND NOT gone) AS removed, count(*) FILTER (fail AND gone) AS redundant,
            count(*) FILTER (fails = own) AS unique_fails, count(*) FILTER (fail AND NOT gone AND good) AS good_lost, count(*) FILTER (fail AND NOT gone AND toxic) AS toxic_lost FROM j GROUP BY ALL)
    SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM k
"""


PAGES = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
    k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS keep FROM p)
    SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
           CASE WHEN keep IS DISTINCT FROM page_id AND keep IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN keep IS DISTINCT FROM page_id THEN keep END AS refers_to FROM k
"""
