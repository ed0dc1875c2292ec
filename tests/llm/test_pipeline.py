"""The pipeline over a small corpus against a brute-force version, and its stages on odd tables."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from docmill.llm import _store
from docmill.llm.decontaminate import drop_leaks, find_leaks
from docmill.llm.near_dup import keep_one_of_each
from docmill.llm.secrets import scan_secrets
from docmill.llm.token_count import count_tokens
from docmill.llm.toxicity import toxicity
from docmill.llm.url_filter import filter_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, rank int, uid int, size int, score double, hash string, item_id long"
EXTRA = (1, "x", 1, 2, 3, 0.5, "h", 9)
QUESTION = "what is the name of the oldest harbour town on the northern coast? it is called little saltwick by the sea"


def words(seed, n):
    r = random.Random(seed)
    return [f"fine{r.randrange(4000)}" for _ in range(n)]


def corpus():
    """(doc_id, text, source): distinct good texts, bad ones, exact and near copies, a leak, nulls and repeated rows."""
    rows = [(k, " ".join(words(k, 60 + k)), "abc"[k % 3]) for k in range(60)]
    rows += [(1000 + k, "BUY NOW!! click here " * (10 + k), "b") for k in range(40)]
    rows += [(2000 + k, rows[k][1].replace(" ", "  \n"), "c") for k in range(8)]
    rows += [(3000 + k, rows[k][1] + " tail", None) for k in range(4, 12)]
    rows += [(4000, " ".join(words(77, 40)) + " " + QUESTION.upper() + " " + " ".join(words(78, 90)), "a")]
    return rows + [(5000, " ".join(words(79, 3000)), "a"), rows[0], rows[0]]


def brute_force(rows, good):
    """Ids after the four filtering stages."""
    docs = {i: t for i, t, _ in rows if i in good}
    first = {}
    for i in sorted(docs):
        first.setdefault(" ".join((docs[i] or "").split()), i)
    docs = {i: docs[i] for i in first.values()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in docs.items() for w in [t.lower().split()]}
    root = {i: i for i in docs}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    docs = {i: t for i, t in docs.items() if top(i) == i}
    wanted = QUESTION.replace("?", "")
    return {i for i, t in docs.items() if wanted not in t.lower().replace("?", "")}


def store(spark, folder, rows, items, labels):
    full = [(i, t, "en", s, *EXTRA) for i, t, s in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string, doc_id long, score double").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = corpus()
    good = {i for i, t, _ in rows if not t.startswith("BUY")}
    folder = store(spark, tmp_path, rows, [(1, QUESTION, 5, 0.1), (2, None, 5, 0.1)], [(i, int(i in good), 0, "t") for i in {i for i, _, _ in rows}])
    before = set(_store._live)
    result = corpus_pipeline.run(spark, folder)
    assert sum("/stage-" in p for p in set(_store._live) - before) == 1 and all("/stage-" in p or "/mix-" in p for p in set(_store._live) - before)
    got = result.collect()
    expected = brute_force(rows, good)
    assert len(expected) == 61 and {r.doc_id for r in got} == expected and len(got) == len(expected)
    source = {i: s for i, _, s in rows}
    size = {i: len(t.split()) for i, t, _ in rows}
    totals, taken, target = Counter(), Counter(), {}
    for r in got:
        assert (r.source, r.size) == (source[r.doc_id], size[r.doc_id]) and r.taken <= 3 * r.size
        totals[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(r.source_size == totals[r.source] for r in got)
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(totals))}
    if all(sum(totals.values()) * weight[s] / sum(weight.values()) <= 3 * totals[s] for s in totals):
        assert target == {s: pytest.approx(sum(totals.values()) * weight[s] / sum(weight.values())) for s in totals}
    assert sum(target.values()) == pytest.approx(sum(totals.values())) and all(abs(taken[s] - target[s]) <= 1 for s in totals)


@pytest.mark.parametrize("rows", [[], [(None, None, None), (None, None, None), (1, "", "a"), (2, None, "a"), (3, "un texto", None), (3, "un texto", None)]], ids=["empty", "nulls"])
def test_every_stage_takes_odd_tables(spark, tmp_path, rows):
    folder = store(spark, tmp_path, rows, [], [(None, None, None, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert (out.count() > 0) == (len(rows) > 0), name
    assert all(r.taken <= 3 * r.size for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect())
    assert (corpus_pipeline.run(spark, folder).count() > 0) == (len(rows) > 0)


def test_leaks_are_dropped_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, QUESTION, "en", "a", *EXTRA), (1, QUESTION, "en", "a", *EXTRA), (2, None, "en", "a", *EXTRA), (None, QUESTION, "en", "a", *EXTRA), (3, "clean text of some length here", "en", "a", *EXTRA)], SCHEMA)
    items = spark.createDataFrame([(1, QUESTION, 7, 0.0), (None, QUESTION, 7, 0.0), (3, "", 7, 0.0)], "item_id long, text string, doc_id long, score double")
    assert {r.doc_id for r in find_leaks(docs, items).filter("doc_id is not null").collect()} == {1}
    kept = drop_leaks(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3}


def test_row_operators_take_clashing_columns(spark):
    names = "doc_id long, text string, n_bytes long, base string, spans string, kind string, toxic int, p_toxic double, sections string"
    docs = spark.createDataFrame([(1, "token=abcdefgh12", 1, "b", "s", "k", 1, 0.5, "x"), (None, None, 1, "b", "s", "k", 1, 0.5, "x")], names)
    found = scan_secrets(docs).select("doc_id", "base").collect()
    assert sorted(len(r.base) for r in found) == [0, 1]
    labels = spark.createDataFrame([(1, 1, None, "t"), (1, None, 1, "t")], "doc_id long, quality int, toxic int, text string")
    assert toxicity(docs, labels, ["quality", "toxic"]).count() == 2
    P = pytest.importorskip("public_tokenizers")
    assert count_tokens(docs, str(P.path("piece_bpe_32k.model"))).count() == 2
    pages = spark.createDataFrame([(1, "http://a.b/c", "h", "p", "r", "v", 1, "i", "t")], "page_id long, url string, host string, path string, rule string, verdict string, good int, id string, template string")
    marks = spark.createDataFrame([(1, None, "http://x"), (None, 1, "y")], "id long, good long, url string")
    assert [(r.host, r.path) for r in filter_urls(pages, marks).select("host", "path").collect()] == [("a.b", "/c")]


def test_rows_with_null_ids_are_dropped_like_others(spark):
    docs = spark.createDataFrame([(1, "clean text of some length here"), (None, QUESTION), (None, "another clean text"), (2, QUESTION)], "doc_id long, text string")
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    kept = drop_leaks(docs, items)
    assert sorted(r.text for r in kept.collect()) == ["another clean text", "clean text of some length here"]
    a, b = (" ".join(words(seed, 100)) for seed in (1, 2))
    copies = [(5, a), (None, a), (None, a + " tail"), (None, b), (None, b), (None, b + " tail"), (9, "solo text"), (8, "Solo  text"), (None, None)]
    one = keep_one_of_each(spark.createDataFrame(copies, "doc_id long, text string"))
    assert one.columns == ["doc_id", "text"]
    got = sorted(((r.doc_id, r.text) for r in one.collect()), key=str)
    assert len(got) == 4 and [i for i, _ in got if i is not None] == [5, 8]
    assert {t for i, t in got if i is None} - {b, b + " tail"} == {None}
