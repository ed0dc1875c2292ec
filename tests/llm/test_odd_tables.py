"""Every operator over one odd table: null ids and texts, repeated rows, a very long text, and columns named like the operators' own."""

import random
from collections import Counter

import pytest

from docmill.llm.decontaminate import drop_leaks, find_leaks
from docmill.llm.exact_dedup import drop_exact_copies, exact_dedup
from docmill.llm.line_dedup import cut_repeats, repeated_lines
from docmill.llm.mixing import mix_sources, words_taken
from docmill.llm.near_dup import keep_one_of_each, near_duplicates
from docmill.llm.quality import fit_quality, keep_good, score_quality
from docmill.llm.queries import QUERIES
from docmill.llm.secrets import joined, scan_secrets
from docmill.llm.token_count import count_tokens
from docmill.llm.toxicity import toxicity
from docmill.llm.url_filter import filter_urls

CLASH = "id uid key hash sha norm n rep copies links root rank pos ord size order bucket start taken words kept keep first later item score good host path seg cur at place dropped lines held fold low high part gap spans base".split()
SCHEMA = "doc_id string, text string, source string, " + ", ".join(f"`{c}` int" for c in CLASH)
ITEM = "what is the name of the oldest harbour town on the northern coast? it is called little saltwick by the sea"


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(8)
    long = " ".join(f"w{r.randrange(30000)}" for _ in range(150_000)) + "\nlogin=bob77 token=abcdefgh12\n" + ITEM
    rows = [(None, ITEM, "a"), ("1", ITEM, "a"), ("1", ITEM, "a"), ("2", None, None), ("3", "", "b"), ("4", long, "b"), (None, None, "a"), ("5", " \n\t", "ñ"), ("6", "token=abcdefgh12 😀 login=me@x", None)]
    return rows, spark.createDataFrame([(i, t, s, *range(len(CLASH))) for i, t, s in rows], SCHEMA)


def counted(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def test_leaks(spark, odd):
    rows, docs = odd
    items = spark.createDataFrame([("q", ITEM, 1, 2), ("q", ITEM, 1, 2), (None, None, 1, 2), ("e", " ", 1, 2)], "item_id string, text string, id int, doc_id int")
    assert counted(find_leaks(docs, items), "doc_id", "item_id") == Counter({(None, "q"): 1, ("1", "q"): 2, ("4", "q"): 1})
    kept = drop_leaks(docs, items)
    assert kept.columns == docs.columns and counted(kept, "doc_id", "text") == Counter((i, t) for i, t, _ in rows if ITEM not in (t or ""))
    assert drop_leaks(docs.limit(0), items).count() == 0 and drop_leaks(docs, items.limit(0)).count() == len(rows)


def test_tokens(odd):
    rows, docs = odd
    sentencepiece = pytest.importorskip("sentencepiece")
    path = str(pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model"))
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert counted(count_tokens(docs, path), "doc_id", "n_tokens") == Counter((i, len(sp.encode(t or ""))) for i, t, _ in rows)


def test_classifiers(spark, odd):
    rows, docs = odd
    labels = spark.createDataFrame([("1", 1, 0, "x"), ("1", 0, None, "x"), ("6", 0, 1, "x"), ("2", 1, 0, "x"), (None, 1, 1, "x"), ("7", None, None, "x")], "doc_id string, quality int, toxic int, text string")
    w = fit_quality(docs, labels.select("doc_id", "quality"))
    scored = score_quality(docs, w)
    assert Counter(r.doc_id for r in scored.collect()) == Counter(i for i, _, _ in rows) and all(0 <= r.score <= 1 for r in scored.collect())
    assert len({r.score for r in scored.filter("doc_id = '1'").collect()}) == 1
    assert keep_good(docs, w).columns == docs.columns and keep_good(docs.limit(0), w).count() == 0
    tox = toxicity(docs, labels, ["quality", "toxic"])
    assert Counter(r.doc_id for r in tox.collect()) == Counter(i for i, _, _ in rows) and tox.columns == ["doc_id", "p_quality", "p_toxic", "quality", "toxic"]
    assert toxicity(docs.limit(0), labels, ["toxic"]).count() == 0


def test_copies(odd):
    rows, docs = odd
    exact = Counter((x.doc_id, x.keep_id, x.group_size, x.kept) for x in exact_dedup(docs).collect())
    assert exact == Counter({(None, "1", 3, False): 1, ("1", "1", 3, True): 2, ("2", "2", 3, True): 1, (None, "2", 3, False): 1, ("3", "2", 3, False): 1, ("4", "4", 1, True): 1, ("5", "5", 1, True): 1, ("6", "6", 1, True): 1})
    assert counted(drop_exact_copies(docs), "doc_id") == Counter({(i,): 1 for i in "12456"})
    near = Counter((x.doc_id, x.class_id, x.n_links) for x in near_duplicates(docs).collect())
    assert near == Counter({(None, "1", 2): 1, ("1", "1", 2): 2, ("2", "2", 3): 1, ("3", "2", 3): 1, ("5", "2", 3): 1, (None, "2", 3): 1, ("4", "4", 0): 1, ("6", "6", 0): 1})
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and counted(kept, "doc_id") == Counter({(i,): 1 for i in "1246"})


def test_mixture(odd):
    rows, docs = odd
    got = words_taken(mix_sources(docs, block_words=64)).collect()
    assert Counter((x.id, x.source, x.size) for x in got) == Counter((i, s, len((t or "").split())) for i, t, s in rows)
    taken, target = Counter(), {}
    for x in got:
        taken[x.source] += x.taken
        target[x.source] = x.target
        assert x.taken <= 3 * x.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_lines(odd):
    rows, docs = odd
    found = repeated_lines(docs, 10)
    assert counted(found, "doc_id", "n_lines", "n_dropped") == Counter({(None, 1, 1): 1, ("1", 1, 0): 1, ("1", 1, 1): 1, ("2", 0, 0): 1, ("3", 0, 0): 1, ("4", 3, 1): 1, (None, 0, 0): 1, ("5", 2, 0): 1, ("6", 1, 0): 1})
    cut = cut_repeats(docs, 10)
    assert cut.columns == docs.columns and cut.filter(f"text like '%{ITEM}'").count() == 1 and cut.count() == len(rows)


def test_secrets(odd):
    rows, docs = odd
    got = counted(scan_secrets(docs).select("doc_id", joined("base").alias("b"), joined("spans").alias("s")), "doc_id", "b", "s")
    at = rows[5][1].index("login=")
    assert got[("4", f"assign:{at + 12}:{at + 28}", f"weak_id:{at}:{at + 11},assign:{at + 12}:{at + 28}")] == 1
    assert got[("6", "assign:0:16", "assign:0:16,weak_id:19:29")] == 1 and sum(got.values()) == len(rows) and got[("1", "", "")] == 2


def test_urls(spark):
    deep = "http://d.test/" + "/".join(f"s{k}" for k in range(20_000)) + "/7"
    urls = [(None, None), (1, ""), (1, ""), (2, "no scheme"), (3, "http://"), (4, deep), (5, "HTTP://EXAMPLE.NET:80/en/"), (6, "http://u@x.org/fr/?a#b"), (None, "http://a.net/x"), (7, "://h.test?q"), (8, deep + "9")]
    names = "host path rule verdict template purity id good seg cur n labelled all child".split()
    pages = spark.createDataFrame([(i, u, *[0] * len(names)) for i, u in urls], "page_id long, url string, " + ", ".join(f"`{c}` int" for c in names))
    labels = spark.createDataFrame([(1, 1, "u"), (None, 0, "u"), (4, 0, "u"), (4, 1, "u"), (8, 0, "u")], "id long, good long, url string")
    got = Counter((x.page_id, x.host, x.rule, x.verdict) for x in filter_urls(pages, labels).collect())
    assert got[(None, "", None, "allow")] == 1 and got[(1, "", None, "allow")] == 2 and got[(None, "a.net", "net/", "block")] == 1 and got[(6, "u@x.org", "org/fr/", "allow")] == 1
    assert sum(got.values()) == len(urls) and {k[0] for k in got} == {None, *range(1, 9)}


def test_queries_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
