"""Queries over documents: languages, types, pages, cleaning, excerpts, chapters, prompts, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import structure as S
from ..functions import text as T
from ..functions.unicode import nfc, nfd
from ..operators import gates, pages, reports, sections
from . import derive as D


def docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(*(columns or ("*",))))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give fewer partitions than there are; larger tables are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


TOKENS = f"regexp_extract_all(lower(text), '{X.TOKEN}')"
HITS = ", ".join(f"len(list_filter(toks, lambda w: list_contains({sql_list(ws)}, w))) AS {lang}" for lang, ws in X.STOPWORDS.items())
TOP = "greatest(" + ", ".join(X.STOPWORDS) + ")"
BEST = f"CASE WHEN {TOP} <= 0 THEN 'unknown' " + " ".join(f"WHEN {x} = {TOP} THEN '{x}'" for x in X.STOPWORDS) + " END"


def hits_sql(select: str, source: str = "documents") -> str:
    """SQL over (doc_id, lang, toks, hits by language, detected)."""
    return f"""WITH t AS (SELECT doc_id, d.lang AS own, {TOKENS} AS toks FROM {source} d), h AS (SELECT doc_id, own, toks, {HITS} FROM t),
    b AS (SELECT *, {BEST} AS detected FROM h) {select}"""


def lang_scores(spark, sf_dir):
    toks = docs(spark, sf_dir, "doc_id", "text").select("doc_id", T.tokens(F.col("text")).alias("toks"))
    hits = T.language_hits(F.col("toks"))
    n = F.size("toks")
    return toks.select("doc_id", n.cast("long").alias("n_tokens"), *[F.round(F.try_divide(h * 100.0, n), 4).alias(f"score_{k}") for k, h in hits.items()])


def lang_detect(spark, sf_dir):
    return docs(spark, sf_dir, "doc_id", "text").select("doc_id", T.detect_language(F.col("text")).alias("detected"))


def unicode_forms(spark, sf_dir):
    """Digests and languages of texts taken apart into base letters and marks: they must be those of the texts as they were."""
    apart = docs(spark, sf_dir, "doc_id", "text").select("doc_id", nfd(F.col("text")).alias("text"))
    return apart.select("doc_id", F.sha2(nfc(F.col("text")), 256).alias("composed"), F.sha2(T.fold(F.col("text")), 256).alias("folded"), F.coalesce(T.detect_language(F.col("text")), F.lit("unknown")).alias("detected"))


UNICODE_SQL = hits_sql("SELECT doc_id, sha256(nfc_normalize(d.text)) AS composed, sha256(strip_accents(lower(d.text))) AS folded, coalesce(detected, 'unknown') AS detected FROM b JOIN documents d USING (doc_id)")


def lang_audit(spark, sf_dir):
    found = docs(spark, sf_dir, "lang", "text").select("lang", T.detect_language(F.col("text")).alias("detected"))
    hit = F.count_if(F.col("lang") == F.col("detected"))
    return found.groupBy("lang").agg(F.count("*").alias("n"), hit.alias("n_match"), F.round(hit * 100.0 / F.count("*"), 4).alias("accuracy"))


def doc_type(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.STRUCTURED} AS text", f"{D.PAGES} AS pages")
    kind = T.document_type(F.col("text"), F.col("pages"))
    return d.select("doc_id", "pages", kind.alias("doc_type")).withColumn("template", T.template_of(F.col("doc_type")))


DOC_TYPE_SQL = f"""WITH d AS (SELECT doc_id, {D.STRUCTURED} AS text, {D.PAGES} AS pages FROM documents),
 m AS (SELECT *, len(regexp_extract_all(text, '(?im)^\\s*({X.IMRAD})([^\\p{{L}}\\p{{N}}_]|$)')) AS imrad,
   regexp_matches(text, '(?im)^\\s*({X.CONTENTS})([^\\p{{L}}\\p{{N}}_]|$)') AS toc,
   regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({X.KEYWORDS})([^\\p{{L}}\\p{{N}}_]|$)') AS kw FROM d),
 k AS (SELECT doc_id, pages, CASE WHEN toc AND pages >= 10 THEN 'manual' WHEN imrad >= 2 AND kw AND pages <= 15 THEN 'articulo' ELSE 'divulgacion' END AS doc_type FROM m)
 SELECT doc_id, pages, doc_type, CASE doc_type WHEN 'articulo' THEN 'A' WHEN 'manual' THEN 'B' ELSE 'C' END AS template FROM k"""


def source_route_pages(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"replace(text, {D.NL}, chr(12)) AS text")
    chars = F.transform(T.native_pages(F.col("text"), F.size(F.split("text", "\f", -1))), T.page_chars)
    routed = d.select("doc_id", chars.alias("chars")).withColumn("decisions", T.route_pages(F.col("chars")))
    total = F.aggregate("chars", F.lit(0), lambda a, x: a + x)
    return routed.select(
        "doc_id",
        F.size("chars").cast("long").alias("n_pages"),
        total.cast("long").alias("n_chars"),
        F.array_join("decisions", ",").alias("decisions"),
        T.combined_source(F.col("decisions")).alias("kind"),
        T.source_kind(total, F.size("chars")).alias("kind_by_mean"),
    )


ROUTED_SQL = f"""WITH p AS (SELECT doc_id, string_split(replace(text, {D.NL}, chr(12)), chr(12)) AS pages FROM documents),
 c AS (SELECT doc_id, list_transform(pages, lambda x: length(replace(replace(x, ' ', ''), {D.NL}, ''))) AS chars FROM p),
 r AS (SELECT doc_id, chars, list_transform(chars, lambda x: CASE WHEN x >= 100 THEN 'nativo' ELSE 'ocr' END) AS d FROM c),
 k AS (SELECT doc_id, len(chars) AS n_pages, CAST(list_sum(chars) AS BIGINT) AS n_chars, array_to_string(d, ',') AS decisions,
  CASE WHEN NOT list_contains(d, 'nativo') THEN 'escaneado' WHEN NOT list_contains(d, 'ocr') THEN 'nativo' ELSE 'mixto' END AS kind,
  CASE WHEN list_sum(chars) * 1.0 / len(chars) >= 100 THEN 'nativo' ELSE 'escaneado' END AS kind_by_mean FROM r) """


def source_aggregate(spark, sf_dir):
    return source_route_pages(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"), F.sum("n_pages").alias("n_pages"))


def dehyphenate(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.HYPHENED} AS text")
    return d.select("doc_id", F.length("text").cast("long").alias("n_before"), T.dehyphenate(F.col("text")).alias("t")).select(
        "doc_id", "n_before", F.length("t").cast("long").alias("n_after"), F.sha2("t", 256).alias("digest")
    )


DEHYPHEN = r"regexp_replace(regexp_replace({}, '([\p{{L}}\p{{N}}_])-\n\s*([a-záàâãéêíóôõúüçñèìòù])', '\1\2', 'g'), '([\p{{L}}\p{{N}}_])-\n\s*([A-ZÁÀÂÃÉÊÍÓÔÕÚÜÇÑ0-9])', '\1-\2', 'g')"


def page_split(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"'x' || {D.NL} || '=== pág 1 ===' || {D.NL} || replace(text, {D.NL}, {D.NL} || '=== pág 2 ===' || {D.NL}) AS text")
    x = pages.split_pages(d)
    return x.select("doc_id", "kind", F.coalesce(F.size("pages"), F.lit(0)).cast("long").alias("n_pages"), F.sha2(F.array_join("pages", "|"), 256).alias("digest"), T.inferred_pages(F.col("text")).cast("long").alias("inferred"))


PAGE_SPLIT_SQL = f"""WITH p AS (SELECT doc_id, string_split(text, {D.NL}) AS lines FROM documents), n AS (SELECT doc_id, lines, len(lines) AS n FROM p)
 SELECT doc_id, CASE WHEN n >= 2 THEN 'marker' END AS kind, CASE WHEN n >= 2 THEN n ELSE 0 END AS n_pages, n AS inferred,
  CASE WHEN n >= 2 THEN sha256(array_to_string(list_transform(lines, lambda x, i: CASE WHEN i = 1 THEN '=== pág 1 ===' ELSE '=== pág 2 ===' END || {D.NL} || x || CASE WHEN i < n THEN {D.NL} ELSE '' END), '|')) END AS digest FROM n"""

EDGE_SQL = rf"""WITH d AS (SELECT doc_id, {D.PAGED} AS text FROM documents), k AS (SELECT * FROM d WHERE contains(text, chr(12))),
 p AS (SELECT doc_id, len(string_split(text, chr(12))) AS n_pages, unnest(string_split(text, chr(12))) AS body, generate_subscripts(string_split(text, chr(12)), 1) AS page FROM k),
 l AS (SELECT doc_id, n_pages, page, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM p),
 f AS (SELECT *, regexp_matches(line, '[^\s]') AS full_line FROM l),
 r AS (SELECT *, sum(CAST(full_line AS INT)) OVER (PARTITION BY doc_id, page ORDER BY pos) AS nth, sum(CAST(full_line AS INT)) OVER (PARTITION BY doc_id, page) AS total FROM f),
 e AS (SELECT *, full_line AND (nth <= 3 OR nth > total - 3) AS edge, lower(regexp_replace(regexp_replace(line, '^[\s\d]+|[\s\d]+$', '', 'g'), '\s+', ' ', 'g')) AS form FROM r),
 s AS (SELECT doc_id, n_pages, form, count(DISTINCT page) AS n FROM e WHERE edge AND form <> '' GROUP BY ALL),
 rep AS (SELECT doc_id, form, n FROM s WHERE n_pages >= 3 AND n >= greatest(3, CAST(floor(n_pages * 0.4) AS INT))) """


def repeated_edges(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.PAGED} AS text")
    return pages.repeated_edges(d, "doc_id")


def clean_text(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.PAGED} AS text")
    return pages.clean_text(d, "doc_id").select("doc_id", F.length("cleaned").cast("long").alias("n_chars"), F.sha2("cleaned", 256).alias("digest"))


CLEAN_SQL = (
    EDGE_SQL
    + r""", kept AS (SELECT e.doc_id, e.page, e.pos, e.line FROM e LEFT JOIN rep USING (doc_id, form)
   WHERE NOT e.edge OR (rep.n IS NULL AND NOT regexp_matches(e.line, '(?i)^\s*(\d{1,4}|[ivxlcdm]{1,7})\s*$'))),
 b AS (SELECT doc_id, page, string_agg(line, chr(10) ORDER BY pos) AS body FROM kept GROUP BY ALL),
 a AS (SELECT p.doc_id, string_agg(coalesce(b.body, ''), chr(12) ORDER BY p.page) AS text FROM p LEFT JOIN b USING (doc_id, page) GROUP BY ALL),
 c AS (SELECT d.doc_id, """
    + DEHYPHEN.format("coalesce(a.text, d.text)")
    + """ AS t FROM d LEFT JOIN a USING (doc_id)) SELECT doc_id, length(t) AS n_chars, sha256(t) AS digest FROM c"""
)


def excerpt_plan(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.STRUCTURED} AS text", f"{D.TYPE} AS kind")
    x = d.select("doc_id", S.excerpt(F.col("text"), F.col("kind"), 4000).alias("x"))
    return x.select("doc_id", "x.strategy", "x.truncated", F.array_join("x.parts", ",").alias("parts"), F.length("x.text").cast("long").alias("n_chars"), F.sha2("x.text", 256).alias("digest"))


TRIM = r"'^\s+|\s+$', '', 'g'"
#: What the headings that STRUCTURED adds give; the texts have none of their own.
EXCERPT_SQL = rf"""WITH d AS (SELECT doc_id, doc_id % 5 AS m, {D.STRUCTURED} AS text, {D.TYPE} AS kind,
   length('RESUMO' || {D.NL} || substr(text, 1, 600) || {D.NL} || 'Palavras-chave: a; b' || {D.NL} || 'ABSTRACT' || {D.NL} || substr(text, 601, 600) || {D.NL} || 'Keywords: c' || {D.NL}) AS ends,
   length('SUMÁRIO' || {D.NL} || substr(text, 1, 400) || {D.NL}) AS preface FROM documents),
 c AS (SELECT *, length(text) <= 4000 AS fits, [regexp_replace(substr(text, 1, 1600), {TRIM}), regexp_replace(substr(text, ends + 1, 1200), {TRIM})] AS art,
   [regexp_replace(substr(text, 1, 1000), {TRIM}), regexp_replace(substr(text, preface + 1, 1000), {TRIM}), regexp_replace(substr(text, 1, 1000), {TRIM})] AS man FROM d),
 x AS (SELECT doc_id, CASE WHEN fits THEN 'full' WHEN kind = 'articulo' THEN 'articulo' WHEN kind = 'manual' THEN 'manual' ELSE 'divulgacion' END AS strategy, NOT fits AS truncated,
  CASE WHEN fits THEN 'completo' WHEN kind = 'articulo' AND m = 0 THEN 'abstract,conclusao' WHEN kind = 'manual' AND m = 1 THEN 'portada,apresentacao,sumario' WHEN kind = 'manual' THEN 'portada' ELSE 'prefijo' END AS parts,
  CASE WHEN fits THEN regexp_replace(text, {TRIM}) WHEN kind = 'articulo' AND m = 0 THEN art[1] || {D.NL} || {D.NL} || art[2]
   WHEN kind = 'manual' AND m = 1 THEN array_to_string(man, {D.NL} || {D.NL}) WHEN kind = 'manual' THEN man[1] ELSE regexp_replace(substr(text, 1, 4000), {TRIM}) END AS t FROM c)
 SELECT doc_id, strategy, truncated, parts, length(t) AS n_chars, sha256(t) AS digest FROM x"""
ABSTRACT_SQL = rf"""WITH c AS (SELECT doc_id, 0 AS o, 'pt' AS lang, 'RESUMO' AS header, substr(text, 1, 600) AS chunk, 'a; b' AS keywords FROM documents WHERE doc_id % 5 = 0 UNION ALL
  SELECT doc_id, 1, 'en', 'ABSTRACT', substr(text, 601, 600), regexp_replace(regexp_extract('c' || {D.NL} || 'Conclusiones' || {D.NL} || substr(text, 1201), '(?s)^(.*?)(\n\s*\n|\z)', 1), {TRIM}) FROM documents WHERE doc_id % 5 = 0),
 b AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(chunk, '^\s*[:.\-]?\s*', ''), {TRIM}), '\s+', ' ', 'g') AS body FROM c)
 SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY o) - 1 AS INT) AS ord, lang, header, length(body) AS n_chars, keywords FROM b WHERE length(body) >= 40"""


def abstract_blocks(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.STRUCTURED} AS text")
    return d.select("doc_id", F.posexplode_outer(S.abstracts(F.col("text"))).alias("ord", "a")).filter("ord is not null").select("doc_id", "ord", "a.lang", "a.header", F.length("a.text").cast("long").alias("n_chars"), "a.keywords")


def chapter_split(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", f"{D.CHAPTERED} AS text").withColumn("found", S.chapters(F.col("text")))
    d = d.select("doc_id", S.covered(F.col("text"), F.col("found")).alias("covered"), "found")
    return d.select("doc_id", "covered", F.posexplode("found").alias("ord", "c")).select(
        "doc_id", "ord", "c.number", "c.title", F.length("c.text").cast("long").alias("n_chars"), "covered"
    )


CHAPTER_SQL = rf"""WITH d AS (SELECT doc_id, {D.CHAPTERED} AS text, string_split(text, chr(10)) AS lines FROM documents),
 k AS (SELECT doc_id, text, list_transform(lines[2:], lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS bodies FROM d WHERE len(lines) >= 3 AND length(text) >= 100)
 SELECT doc_id, unnest(range(len(bodies)))::INT AS ord, '3' AS number, 'TITULO' AS title, length(unnest(bodies)) AS n_chars,
  list_sum(list_transform(bodies, lambda x: length(x))) * 1.0 / length(text) >= 0.8 AS covered FROM k"""


def block_pack(spark, sf_dir):
    x = docs(spark, sf_dir, "doc_id", f"replace(text, '. ', '.' || {D.NL} || {D.NL}) AS text").select("doc_id", S.blocks(F.col("text"), 1500).alias("b"))
    longest = F.array_max(F.transform("b", F.length))
    return x.select("doc_id", F.size("b").cast("long").alias("n_blocks"), F.coalesce(longest, F.lit(0)).cast("long").alias("longest"), F.sha2(F.regexp_replace(F.array_join("b", ""), r"\s", ""), 256).alias("content"))


# RE2 repeats at most 1,000 times, hence two halves.
PACK_SQL = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_replace(replace(text, '. ', '.' || {D.NL} || {D.NL}), '^\s+|\s+$', '', 'g') AS w FROM documents),
 p AS (SELECT doc_id, flatten(list_transform(regexp_extract_all(w, '(?s)(.+?(?:\n\s*\n|\z))', 1), lambda x: regexp_extract_all(x, '(?s)(.{{1,750}}.{{0,750}})', 1))) AS ps FROM d WHERE length(w) > 1500),
 u AS MATERIALIZED (SELECT doc_id, unnest(ps) AS s, generate_subscripts(ps, 1) AS k FROM p),
 f AS (SELECT doc_id, k, 0 AS block, length(s) AS n FROM u WHERE k = 1 UNION ALL
 SELECT u.doc_id, u.k, CASE WHEN n + length(s) <= 1500 THEN block ELSE block + 1 END, CASE WHEN n + length(s) <= 1500 THEN n + length(s) ELSE length(s) END FROM f JOIN u ON u.doc_id = f.doc_id AND u.k = f.k + 1),
 b AS (SELECT doc_id, block, regexp_replace(string_agg(s, '' ORDER BY k), '^\s+|\s+$', '', 'g') AS t FROM f JOIN u USING (doc_id, k) GROUP BY ALL UNION ALL SELECT doc_id, 0, w FROM d WHERE length(w) <= 1500),
 g AS (SELECT doc_id, count(*) AS n_blocks, max(length(t)) AS longest FROM b WHERE t <> '' GROUP BY doc_id)
 SELECT doc_id, coalesce(n_blocks, 0) AS n_blocks, coalesce(longest, 0) AS longest, sha256(regexp_replace(w, '[\s\x0B]', '', 'g')) AS content FROM d LEFT JOIN g USING (doc_id)"""


def prompt_build(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text", f"{D.TYPE} AS kind")
    p = sections.prompt(F.col("text"), F.col("lang"), T.template_of(F.col("kind")))
    return d.select("doc_id", p.alias("p")).select("doc_id", F.length("p").cast("long").alias("n_chars"), F.sha2("p", 256).alias("digest"))


def _labels_case(lang: str) -> str:
    i = X.LABEL_LANGS.index(lang)
    whens = " ".join(f"WHEN '{t}' THEN '" + "\n".join("## " + X.LABELS[k][i] for k in ks) + "'" for t, ks in X.TEMPLATES.items())
    return f"CASE template {whens} END"


PROMPT_SQL = f"""WITH d AS (SELECT doc_id, lang, text, CASE {D.TYPE} WHEN 'articulo' THEN 'A' WHEN 'manual' THEN 'B' ELSE 'C' END AS template FROM documents),
 p AS (SELECT doc_id, CASE lang WHEN 'es' THEN '{X.INSTRUCTIONS["es"].replace("'", "''")}' WHEN 'en' THEN '{X.INSTRUCTIONS["en"].replace("'", "''")}' ELSE '{X.INSTRUCTIONS["pt"].replace("'", "''")}' END
  || chr(10) || chr(10) || CASE lang WHEN 'es' THEN {_labels_case("es")} WHEN 'en' THEN {_labels_case("en")} ELSE {_labels_case("pt")} END
  || chr(10) || chr(10) || 'TEXTO:' || chr(10) || '\"\"\"' || chr(10) || substr(text, 1, {X.MAX_CHARS}) || chr(10) || '\"\"\"' AS p FROM d)
 SELECT doc_id, length(p) AS n_chars, sha256(p) AS digest FROM p"""


def fake_summary(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text", f"{D.TYPE} AS kind")
    m = d.select("doc_id", F.posexplode(F.map_entries(sections.fake_summary(F.col("text"), F.col("lang"), T.template_of(F.col("kind"))))).alias("ord", "e"))
    return m.select("doc_id", "ord", F.col("e.key").alias("label"), F.col("e.value").alias("content"))


def _keys_case(values) -> str:
    return "CASE template " + " ".join(f"WHEN '{t}' THEN {sql_list(values(ks))}" for t, ks in X.TEMPLATES.items()) + " END"


FAKE_SQL = rf"""WITH d AS (SELECT doc_id, lang, CASE {D.TYPE} WHEN 'articulo' THEN 'A' WHEN 'manual' THEN 'B' ELSE 'C' END AS template,
  array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')[1:12], ' ') AS head FROM documents),
 l AS (SELECT *, {_keys_case(lambda ks: [X.LABELS[k][0] for k in ks])} AS names FROM d)
 SELECT doc_id, unnest(range(len(names)))::INT AS ord, unnest(names) AS label, '[fake:' || lang || '] ' || unnest(names) || ': ' || head AS content FROM l"""

MARKDOWN = f"'skipped' || {D.NL} || '## ' || CASE WHEN lang = 'en' THEN 'Title' ELSE 'Título' END || {D.NL} || text || {D.NL} || '##  The Público' || {D.NL} || 'all' || {D.NL} || '## Other' || {D.NL} || source || {D.NL} || '## Other' || {D.NL} || lang"


def section_parse(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "CASE WHEN lang = 'en' THEN 'en' ELSE 'pt' END AS lang", "'C' AS template", f"{MARKDOWN} AS md")
    return sections.parse_sections(d, "doc_id", "md", "template", "lang")


SECTION_SQL = r"""SELECT doc_id, 'titulo' AS section, regexp_replace(text, '^\s+|\s+$', '', 'g') AS content FROM documents
 UNION ALL SELECT doc_id, CASE WHEN lang = 'en' THEN 'The Público' ELSE 'The Público' END, 'all' FROM documents
 UNION ALL SELECT doc_id, 'Other', lang FROM documents"""


def consolidate(spark, sf_dir):
    """Partial summaries of a document, one for each of its lines; some have a blank section."""
    d = docs(spark, sf_dir, "doc_id", f"'- ' || lang || {D.NL} || 'all ' || {D.NL} || '• ' || source AS publico", "text")
    lines = d.select("doc_id", "publico", F.posexplode(F.split("text", "\n", -1)).alias("ord", "line"))
    titulo = F.when(F.col("ord") % 7 == 3, F.lit(" ")).otherwise(F.col("line"))
    parts = lines.select("doc_id", "ord", F.explode(F.create_map(F.lit("publico"), "publico", F.lit("titulo"), titulo)).alias("section", "content"))
    out = sections.consolidate(parts, "doc_id")
    return out.select("doc_id", "section", F.when(F.col("section") == "publico", F.col("content")).alias("content"), F.sha2("content", 256).alias("digest"))


CONSOLIDATE_SQL = rf"""WITH p AS (SELECT doc_id, array_to_string(list_transform(list_sort(list_distinct(['all', lang, source])), lambda x: '- ' || x), {D.NL}) AS content FROM documents),
 l AS (SELECT doc_id, unnest(string_split(text, {D.NL})) AS line, generate_subscripts(string_split(text, {D.NL}), 1) - 1 AS k FROM documents),
 t AS (SELECT doc_id, string_agg(line, {D.NL} || {D.NL} ORDER BY k) FILTER (WHERE k % 7 <> 3 AND regexp_matches(line, '[^\s]')) AS content FROM l GROUP BY doc_id)
 SELECT doc_id, 'publico' AS section, content, sha256(content) AS digest FROM p UNION ALL SELECT doc_id, 'titulo', NULL, sha256(coalesce(content, '')) FROM t"""


def _results(spark, sf_dir):
    """Results with sections by key: some blank, some with a refusal, abstracts declared by language."""
    d = docs(spark, sf_dir, "doc_id", "lang", "text", f"{D.TYPE} AS kind")
    t = T.template_of(F.col("kind"))
    value = F.when(F.col("doc_id") % 11 == 0, F.lit(" ")).when(F.col("doc_id") % 13 == 0, F.lit("I'm sorry, your question")).otherwise(F.col("text"))
    return d.select("doc_id", "lang", t.alias("template"), F.map_from_arrays(sections.keys(t), F.transform(sections.keys(t), lambda k: F.when(k == "titulo", F.lit("T")).otherwise(value))).alias("sections"))


def result_gates(spark, sf_dir):
    r = _results(spark, sf_dir)
    declared = F.when(F.col("doc_id") % 4 == 0, F.array(F.lit("pt"), F.lit("en"))).otherwise(F.array().cast("array<string>"))
    g = gates.result_gates(F.col("sections"), F.col("template"), F.col("lang"), declared, F.array(F.lit("en")))
    # outer, as a filter on the number of gates would work them out twice
    return r.select("doc_id", F.posexplode_outer(g).alias("ord", "g")).filter("ord is not null").select("doc_id", "ord", "g.gate", "g.detail", "g.severity")


RESULT_GATES_SQL = rf"""WITH d AS (SELECT doc_id, lang AS own, CASE {D.TYPE} WHEN 'articulo' THEN 'A' WHEN 'manual' THEN 'B' ELSE 'C' END AS template,
   CASE WHEN doc_id % 11 = 0 THEN ' ' WHEN doc_id % 13 = 0 THEN 'I''m sorry, your question' ELSE text END AS v FROM documents),
 k AS (SELECT *, {_keys_case(lambda ks: ks)} AS keys, {_keys_case(lambda ks: [k for k in ks if k not in X.OPTIONAL_KEYS])} AS req FROM d),
 s AS (SELECT *, array_to_string(list_transform(keys, lambda x: CASE WHEN x = 'titulo' THEN 'T' ELSE v END), ' ') AS text FROM k),
 t AS (SELECT *, {TOKENS} AS toks FROM s), h AS (SELECT *, {HITS} FROM t), b AS (SELECT *, {BEST} AS det FROM h),
 f AS (SELECT doc_id, CASE WHEN trim(v) = '' THEN list_transform(list_filter(req, lambda x: x <> 'titulo'), lambda x: {{'gate': 'schema', 'detail': 'sección obligatoria vacía o ausente: ' || x, 'severity': 'error'}}) ELSE [] END
  || CASE WHEN doc_id % 11 <> 0 AND doc_id % 13 = 0 THEN [{{'gate': 'refusal', 'detail': 'marca de refusal/dirigido al usuario: ''i''m sorry''', 'severity': 'error'}}] ELSE [] END
  || CASE WHEN len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) >= 8 AND det <> 'unknown' AND det <> own AND NOT (det IN ('pt', 'es') AND own IN ('pt', 'es'))
     THEN [{{'gate': 'lang', 'detail': 'idioma del resumen ''' || det || ''' != principal ''' || own || '''', 'severity': 'warning'}}] ELSE [] END
  || CASE WHEN doc_id % 4 = 0 THEN [{{'gate': 'abstracts', 'detail': 'abstracts declarados [''en'', ''pt''] != preservados [''en'']', 'severity': 'error'}}] ELSE [] END AS g FROM b)
 SELECT doc_id, unnest(range(len(g)))::INT AS ord, unnest(g).gate AS gate, unnest(g).detail AS detail, unnest(g).severity AS severity FROM f"""


def transcript_gates(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "CASE WHEN doc_id % 9 = 0 THEN replace(text, 'e', '¤') ELSE text END AS text")
    g = gates.transcript_gates(F.col("text"))
    return d.select("doc_id", F.round(T.garbage_ratio(F.col("text")), 6).alias("ratio"), g.alias("g")).select(
        "doc_id", "ratio", F.array_join(F.transform("g", lambda x: F.concat_ws(":", x["gate"], x["severity"])), ",").alias("gates"), gates.no_errors(F.col("g")).alias("passed")
    )


LEGIBLE_SQL = X.LEGIBLE.replace("'", "''")
TRANSCRIPT_SQL = rf"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN replace(text, 'e', '¤') ELSE text END AS text FROM documents),
 t AS (SELECT *, {TOKENS} AS toks, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS n,
   CASE WHEN regexp_matches(text, '[^\s]') THEN length(regexp_replace(text, '[{LEGIBLE_SQL}]', '', 'g')) * 1.0 / length(text) ELSE 0 END AS ratio FROM d),
 h AS (SELECT *, {HITS} FROM t),
 g AS (SELECT *, n >= 40 AND ratio > 0.15 AS bad, n >= 40 AND coalesce({TOP} * 100.0 / nullif(len(toks), 0), 0) < 2.0 AS odd FROM h)
 SELECT doc_id, round(ratio, 6) AS ratio, array_to_string(list_filter([CASE WHEN bad THEN 'garbage:error' END, CASE WHEN odd THEN 'stopword_ratio:warning' END], lambda x: x IS NOT NULL), ',') AS gates, NOT bad AS passed FROM g"""


def vlm_verify(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "CASE WHEN doc_id % 10 = 0 THEN '  ' WHEN doc_id % 10 = 1 THEN 'The image shows ' || text ELSE text END AS vlm", "CASE WHEN doc_id % 10 = 2 THEN 'uno dos tres cuatro cinco seises sietes ochos nueves diez once' WHEN doc_id % 10 = 3 THEN replace(text, 'a', 'e') ELSE text END AS base")
    d = d.withColumn("words", T.words(F.col("base"))).withColumn("overlap", T.lexical_overlap(F.col("vlm"), F.col("words")))
    d = d.withColumn("reason", T.verify_vlm(F.col("vlm"), F.col("words"), F.lit("por+eng+spa"), F.col("overlap")))
    return d.select("doc_id", F.col("reason").isNull().alias("accepted"), F.coalesce(F.regexp_extract("reason", "^[a-z]+", 0), F.lit("")).alias("reason"), F.round("overlap", 6).alias("overlap"))


FOLD_SQL = "strip_accents(lower(w))"
VLM_SQL = rf"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '  ' WHEN doc_id % 10 = 1 THEN 'The image shows ' || text ELSE text END AS text,
   CASE WHEN doc_id % 10 = 2 THEN 'uno dos tres cuatro cinco seises sietes ochos nueves diez once' WHEN doc_id % 10 = 3 THEN replace(text, 'a', 'e') ELSE text END AS base FROM documents),
 w AS (SELECT *, regexp_extract_all(base, '[\p{{L}}\p{{N}}_]+') AS bw, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS vw, {TOKENS} AS toks FROM d), h AS (SELECT *, {HITS} FROM w),
 o AS (SELECT *, {BEST} AS det, len(list_filter(bw, lambda w: length(w) >= 4)) AS useful, list_distinct(list_transform(list_filter(bw, lambda w: length(w) >= 4), lambda w: {FOLD_SQL})) AS own, list_distinct(list_transform(vw, lambda w: {FOLD_SQL})) AS seen FROM h),
 v AS (SELECT *, CASE WHEN len(own) = 0 THEN 1.0 ELSE len(list_intersect(own, seen)) * 1.0 / len(own) END AS overlap FROM o),
 r AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\s]') THEN 'vacio' WHEN contains(lower(text), 'the image shows') THEN 'chachara' WHEN useful >= 5 AND overlap < 0.3 THEN 'solape'
   WHEN len(vw) >= 40 AND det NOT IN ('pt', 'en', 'es', 'unknown') THEN 'idioma' WHEN length(text) > 3000 AND useful < 10 THEN 'explosion' ELSE '' END AS reason FROM v)
 SELECT doc_id, reason = '' AS accepted, reason, round(overlap, 6) AS overlap FROM r"""


def control_suite(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "lang", "text")
    cases = d.select("doc_id", F.col("lang").alias("expected_lang"), F.lit("divulgacion").alias("expected_type"), F.array(F.lit("THE"), F.lit("de "), F.lit("xyz")).alias("terms"))
    results = d.filter("doc_id % 12 <> 0").select("doc_id", T.detect_language(F.col("text")).alias("lang"), F.lit("divulgacion").alias("type"), "text")
    return reports.control_report(reports.judge_cases(cases, results, "doc_id"))


CONTROL_SQL = hits_sql(
    """, c AS (SELECT b.doc_id, own, detected, text FROM b JOIN documents USING (doc_id)),
 v AS (SELECT doc_id % 12 <> 0 AS there, (CAST(contains(lower(text), 'the') AS INT) + CAST(contains(lower(text), 'de ') AS INT) + CAST(contains(lower(text), 'xyz') AS INT)) / 3.0 AS cov, detected = own AS lang_ok FROM c),
 s AS (SELECT count(*) AS total, count(*) FILTER (WHERE there AND lang_ok AND cov = 1) AS passed, round(coalesce(sum(cov) FILTER (WHERE there), 0) / count(*), 3) AS coverage_media,
  count(*) FILTER (WHERE there AND lang_ok) AS lang_aciertos, count(*) FILTER (WHERE there) AS type_aciertos FROM v) SELECT * FROM s"""
)


def acceptance(spark, sf_dir):
    return reports.acceptance(control_suite(spark, sf_dir))


def doc_ids(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text", "source")
    name = F.concat("source", F.lit(" ñ.v"), F.col("doc_id").cast("string"), F.lit("..pdf!"))
    odd = F.when(F.col("doc_id") % 5 == 0, F.lit("a%2Fb")).when(F.col("doc_id") % 5 == 1, F.lit("..")).when(F.col("doc_id") % 5 == 2, F.lit("a/b")).otherwise(name)
    return d.select("doc_id", T.safe_stem(name).alias("stem"), T.content_id(F.col("text")).alias("content_id"), T.job_key(F.col("doc_id").cast("string"), F.col("text")).alias("job_key"), T.valid_id(odd).alias("valid"))


DOC_IDS_SQL = r"""SELECT doc_id, substr(trim(regexp_replace(source || ' ñ.v' || doc_id || '..pdf!', '[^A-Za-z0-9_-]+', '_', 'g'), '_'), 1, 40) AS stem, substr(sha256(text), 1, 12) AS content_id,
 doc_id || ':' || substr(sha256(text), 1, 12) AS job_key, doc_id % 5 > 2 AS valid FROM documents"""

QUERIES = {
    f.__name__: f
    for f in (lang_audit, lang_scores, lang_detect, doc_type, source_route_pages, source_aggregate, dehyphenate, page_split, repeated_edges, clean_text, excerpt_plan, abstract_blocks, chapter_split, block_pack, prompt_build, fake_summary, section_parse, consolidate, result_gates, transcript_gates, vlm_verify, control_suite, acceptance, doc_ids)
}
ORACLE_SQL = {
    "lang_audit": hits_sql("SELECT own AS lang, count(*) AS n, count(*) FILTER (WHERE own = detected) AS n_match, round(count(*) FILTER (WHERE own = detected) * 100.0 / count(*), 4) AS accuracy FROM b GROUP BY own"),
    "lang_scores": hits_sql("SELECT doc_id, len(toks) AS n_tokens, " + ", ".join(f"round({x} * 100.0 / nullif(len(toks), 0), 4) AS score_{x}" for x in X.STOPWORDS) + " FROM b"),
    "lang_detect": hits_sql("SELECT doc_id, detected FROM b"),
    "doc_type": DOC_TYPE_SQL,
    "source_route_pages": ROUTED_SQL + "SELECT * FROM k",
    "source_aggregate": ROUTED_SQL + "SELECT kind, count(*) AS n, CAST(sum(n_pages) AS BIGINT) AS n_pages FROM k GROUP BY kind",
    "dehyphenate": f"WITH d AS (SELECT doc_id, {D.HYPHENED} AS text FROM documents), x AS (SELECT doc_id, length(text) AS n_before, {DEHYPHEN.format('text')} AS t FROM d) SELECT doc_id, n_before, length(t) AS n_after, sha256(t) AS digest FROM x",
    "page_split": PAGE_SPLIT_SQL,
    "repeated_edges": EDGE_SQL + "SELECT doc_id, form, n FROM rep",
    "clean_text": CLEAN_SQL,
    "excerpt_plan": EXCERPT_SQL,
    "abstract_blocks": ABSTRACT_SQL,
    "chapter_split": CHAPTER_SQL,
    "block_pack": PACK_SQL,
    "prompt_build": PROMPT_SQL,
    "fake_summary": FAKE_SQL,
    "section_parse": SECTION_SQL,
    "consolidate": CONSOLIDATE_SQL,
    "result_gates": RESULT_GATES_SQL,
    "transcript_gates": TRANSCRIPT_SQL,
    "vlm_verify": VLM_SQL,
    "control_suite": CONTROL_SQL,
    "acceptance": CONTROL_SQL.replace("SELECT * FROM s", "SELECT *, total > 0 AND coverage_media >= 0.6 AND lang_aciertos = total AND type_aciertos = total AS accepted FROM s"),
    "doc_ids": DOC_IDS_SQL,
}
QUERIES["unicode_forms"], ORACLE_SQL["unicode_forms"] = unicode_forms, UNICODE_SQL
