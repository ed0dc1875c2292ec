"""Archives, spelling variants and the filter audit: brute force over small random tables, and odd tables."""

import gzip
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from docmill.llm import queries
from docmill.llm._store import materialize
from docmill.llm.filter_audit import FILTERS, filter_audit, mask_cells, parity_sums
from docmill.llm.variants import letter_runs, spelling_variants
from docmill.llm.warc import assemble, page_captures, read_warc, records_of, resolved, value_of, write_warc

CLASH = "id uid key hash sha n word wid len best root form copies keep part mask good toxic first last digest file place type payload fields headers block refers".split()


def wide(rows, schema, spark):
    """The rows with columns named like the operators' own."""
    return spark.createDataFrame([(*r, *range(len(CLASH))) for r in rows], schema + ", " + ", ".join(f"`{c}_` int".replace("_`", "`") for c in CLASH))


# spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts, factor=10):
    out, form = {}, {}
    for w, n in counts.items():
        some = [x for x in counts if near(w, x)]
        best = min(some, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
        out[w] = [n, len(some), form[w], counts.get(form[w])]
    for w in counts:
        at = w
        while form[at] is not None:
            at = form[at]
        out[w].append(at)
    return out


def given(counts, spark, factor=10):
    rows = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), factor).collect()
    assert len(rows) == len(counts)
    return {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_against_all_pairs(spark, seed):
    r = random.Random(seed)
    words = {"".join(r.choice("abé:*") for _ in range(r.randint(0, 6))) for _ in range(250)}
    counts = {w: r.choice([1, 2, 2, 20, 200, 2000, 40000]) for w in words}
    assert given(counts, spark) == brute_variants(counts)
    assert given(counts, spark, 1_000_000) == brute_variants(counts, 1_000_000)


def test_variants_of_long_words(spark):
    """Words around the length up to which keys are strings, and far beyond it, among them long runs of one letter."""
    r = random.Random(3)
    counts = {}
    for n in (62, 63, 64, 65, 66, 67, 300):
        base = "".join(r.choice("abç") for _ in range(n))
        k = r.randrange(n)
        for w in (base, base[:k] + base[k + 1 :], base[:k] + "z" + base[k + 1 :], base + "z", "z" + base, base[:-1], base[1:], base[:k] + "zz" + base[k:]):
            counts[w] = r.choice([1, 30, 900])
    counts |= {"a" * n: n for n in (63, 64, 65, 66, 500, 501)}
    assert given(counts, spark) == brute_variants(counts)
    huge = {"ab" * 60_000: 2, "ab" * 60_000 + "c": 90, "x" + "ab" * 60_000: 5}
    assert given(huge, spark)["ab" * 60_000] == [2, 2, "ab" * 60_000 + "c", 90, "ab" * 60_000 + "c"]


def test_one_word_with_very_many_variants(spark):
    """A frequent word with every replacement: a group for each place, never a pair of them."""
    word, letters = "standard", "abcdefghijklmnopqrstuvwxyz"
    counts = {word[:k] + c + word[k + 1 :]: 3 for k in range(8) for c in letters} | {word: 10_000}
    got = given(counts, spark)
    assert got[word] == [10_000, 200, None, None, word] and all(v[2] == v[4] == word and v[1] == 25 for w, v in got.items() if w != word)


def test_variant_counts_of_odd_tables(spark):
    rows = [("abc", 2), ("abc", 3), (None, 4), ("abd", None), ("abd", 50), ("", 1)]
    got = spelling_variants(wide(rows, "word_ string, n_ long", spark).selectExpr("word_ as word", "n_ as n", "id", "wid", "root", "form", "best")).collect()
    assert {(r.word, r.n, r.form) for r in got} == {("abc", 5, "abd"), ("abd", 50, None), ("", 1, None)}
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def query_words(docs):
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            found[run[:k] + run[k + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def test_variant_query_against_all_pairs(spark, tmp_path):
    r = random.Random(6)
    words = ["Verzeichnis", "été×ÿÀbcdefg", "ABCDEFG", "kurz", "Mittelwort", "straßenbahn", "abcdefgh"]
    docs = [(None if k == 7 else k, " ".join(r.choice(words) for _ in range(r.randint(0, 90))) + r.choice(["", "1", "ab-abcdefgh"])) for k in range(60)] + [(3, None), (3, ""), (4, "x" * 5000 + " " + "x" * 5000), (5, "y" * 70 + " " + "y" * 70)]
    wide(docs, "doc_id long, text string", spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.word: [x.n, x.n_near, x.form, x.form_n, x.root] for x in queries.op12_spelling_variants(spark, str(tmp_path)).collect()}
    want = brute_variants(query_words(docs))
    assert got == want and any(v[2] for v in want.values()) and max(map(len, want)) == 5000
    assert letter_runs(spark.createDataFrame([], "doc_id long, text string"), 7).count() == 0


# filter audit


def brute_audit(docs, labels):
    text = lambda t: t or ""
    marks = {}
    for i, q, t in labels:
        if i is not None:
            old = marks.get(i, (0, 0))
            marks[i] = (max(old[0], q or 0), max(old[1], t or 0))
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[text(t)] = min(i, first.get(text(t), i))
    rows = []
    for i, t, part in docs:
        t = text(t)
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(f for f, x in zip(FILTERS, (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search("[#$%&*|]", t), i is not None and first[t] < i)) if x)
        rows.append((part or "", fails, *marks.get(i, (0, 0))))
    out, shares = {}, Counter()
    for part in {p for p, *_ in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations(FILTERS)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shares[part, f] += len(gone)
                redundant = sum(f in r[1] for r in own) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(r[1] == f for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_every_order(spark):
    r = random.Random(4)
    texts = [None, "", "A b", "a b # c", " ".join(f"w{k}" for k in range(200)), "x " * 300, "\x0b".join(f"W{k}" for k in range(250)), " ".join(["q"] * 101 + [f"z{k}" for k in range(101)]), "é" * 300_000, "a b " * 40 + " ".join(map(str, range(170)))]
    docs = [(r.choice([None, *range(40)]), r.choice(texts), r.choice(["en", "de", "", None])) for _ in range(120)]
    docs += docs[:5]
    labels = [(r.choice([None, *range(40)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(40)]
    marked = spark.createDataFrame([(*x, "u") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = filter_audit(wide(docs, "doc_id long, text string, lang string", spark), marked)
    assert {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in got.collect()} == brute_audit(docs, labels)
    assert got.count() == 3 * 600 and got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert filter_audit(spark.createDataFrame([], "doc_id long, text string, lang string"), marked).count() == 0


def test_parity_sums_give_the_cells_back(spark):
    r = random.Random(2)
    rows = [("p", r.randrange(32), r.random() < 0.5, r.random() < 0.1) for _ in range(400)]
    sums = parity_sums(spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean"))
    want = Counter((g, t, m) for _, m, g, t in rows)
    for x in sums.collect():
        assert x.sums == [sum((-1) ** bin(s & m).count("1") * n for (g, t, m), n in want.items() if (g, t) == (x.good, x.toxic)) for s in range(32)]
    assert {(x.good, x.toxic, m): n for x in mask_cells(sums).collect() for m, n in enumerate(x.cells) if n} == want


# archives


def test_archives_of_odd_pages(spark, tmp_path):
    big, cut = "é" * 600, "WARC/1.1\r\nWARC-Type: response\r\n\r\nx\r\n\r\nWARC/1.1\r\n" * 30
    pages = [(1, "http://a.test/1?q=1#f", big), (5, "http://a.test/1", big), (3, "http://a b.test/\r\nX: y", big), (None, "http://a.test/1", big), (2, None, None), (4, "", "x" * 999), (6, "u", "x" * 999), (7, "http://c.test", cut), (8, "http://c.test", cut), (8, "http://c.test", cut), (None, None, "y" * 2000), (None, None, "y" * 2000), (9, "http://é.test/ü", "z" * 3_000_000)]
    wide(pages, "page_id long, url string, html string", spark).write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter(map(tuple, queries.op11_warc(spark, str(tmp_path)).select("page_id", "payload_bytes", "record_type", "refers_to").collect()))
    assert got == Counter({(1, 1200, "revisit", 5): 1, (5, 1200, "response", None): 1, (3, 1200, "revisit", 5): 1, (None, 1200, "revisit", 5): 1, (2, 0, "response", None): 1, (4, 999, "response", None): 1, (6, 999, "response", None): 1, (7, len(cut), "revisit", 8): 1, (8, len(cut), "response", None): 2, (None, 2000, "response", None): 2, (9, 3_000_000, "response", None): 1})
    write_warc(page_captures(spark.read.parquet(f"{tmp_path}/pages.parquet")), f"file:{tmp_path}/w", max_bytes="1500")
    read = read_warc(spark, f"{tmp_path}/w")
    assert read.filter("error is not null").count() == 0 and read.select("file").distinct().count() >= 5
    assert Counter(bytes(r.payload).decode() for r in read.filter("type = 'response'").collect()) == Counter([big, "", "x" * 999, "x" * 999, cut, cut, "y" * 2000, "y" * 2000, "z" * 3_000_000])
    rows = assemble(read).collect()
    assert len(rows) == len(pages) and all(len(r.requests) == len(r.metadata) == 1 and r.part == 0 for r in rows)
    assert {r.response.target_uri for r in rows} == {"http://a.test/1?q=1#f", "http://a.test/1", "http://a%20b.test/%20%20X:%20y", None, "", "u", "http://c.test", "http://é.test/ü"} - {""} | {""}
    assert {bytes(r.requests[0].payload) for r in rows} == {b""}
    empty = spark.read.parquet(f"{tmp_path}/pages.parquet").limit(0)
    write_warc(page_captures(empty), f"{tmp_path}/none")
    assert read_warc(spark, f"{tmp_path}/none").count() == 0


def record(kind, ident, block=b"", **more):
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<{ident}>", **{k.replace("_", "-"): v for k, v in more.items()}}
    lines = [f"{k}: {x}" for k, v in headers.items() for x in (v if isinstance(v, list) else [v])]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Links in either direction and over other records, repeated copies, chunked bodies, broken and plain files."""
    http = "application/http; msgtype=response"
    body = b"HTTP/1.0 404 Not\r\nTransfer-Encoding: chunked\r\nX: 1\r\n\r\n3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n"
    records = [
        record("warcinfo", "w"),
        record("response", "r1", body, Content_Type=http, WARC_Concurrent_To="<q1>", WARC_Target_URI="http://x"),
        record("request", "q1"),
        record("metadata", "m1", b"via: a\r\nvia: b\r\n", WARC_Concurrent_To="<q1>", Content_Type="application/warc-fields"),
        record("metadata", "m2", WARC_Concurrent_To=["<m1>", "<gone>"]),
        record("resource", "r2", b"pure"),
        record("request", "q2", WARC_Concurrent_To=["<r2>", "<r1>"]),
        record("metadata", "lone", WARC_Concurrent_To="<nothing>"),
        record("revisit", "v", b"HTTP/1.0 200 OK\r\n\r\n", Content_Type=http, WARC_Refers_To_Target_URI="http://x", WARC_Payload_Digest="sha1:AOUGFHXLOVMFKFQ7NT5GLBFSOWLWCPFM"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.warc").write_bytes(records[1] + b"noise\r\n" + records[5] + record("request", "cut", b"x" * 50)[:-30])
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(record("request", "q9"))[:-12])
    (tmp_path / "_x.warc").write_bytes(records[0])
    (tmp_path / "empty.warc").write_bytes(b"")
    read = read_warc(spark, str(tmp_path))
    assert read.filter("type = 'warcinfo'").count() == 1
    assert Counter(r.error.split(":")[0] for r in read.filter("error is not null").collect()) == Counter({"no record": 1, "cut off": 1, "EOFError": 1})
    whole = materialize(assemble(read), "test")
    rows = {r.capture_id: r for r in whole.collect()}
    assert set(rows) == {"r1", "r2", "lone", "v"}
    one = rows["r1"]
    assert (one.response.http_status, bytes(one.response.payload)) == (404, b"abcde") and [q.record_id for q in one.requests] == ["q1", "q2"] and [m.record_id for m in one.metadata] == ["m1", "m2"]
    assert [(p.name, p.value) for p in one.metadata[0].fields] == [("via", "a"), ("via", "b")]
    assert rows["lone"].response is None and [m.record_id for m in rows["lone"].metadata] == ["lone"]
    assert rows["r2"].requests == [] and bytes(rows["r2"].response.payload) == b"pure"
    found = resolved(whole).filter("capture_id = 'v'").select("original.capture_id", value_of("response.http_headers", "x").alias("x")).collect()
    assert len(found) == 1


def test_a_capture_with_very_many_records(spark, tmp_path):
    records = [record("response", "r", b"x")] + [record("metadata", f"m{k}", WARC_Concurrent_To="<r>") for k in range(2500)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    rows = assemble(read_warc(spark, str(tmp_path))).collect()
    assert len(rows) == 3 and max(len(r.metadata) for r in rows) < 1200 and [r.part for r in rows if r.response] == [0]
    assert {m.record_id for r in rows for m in r.metadata} == {f"m{k}" for k in range(2500)}


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("u", "d", b"x", {}, None)], "target_uri string, date string, payload binary, fields map<string,string>, refers struct<uri:string,date:string>")
    write_warc(rows, f"{tmp_path}/w")
    bad = rows.selectExpr("target_uri", "date", "cast(raise_error('stop') as binary) as payload", "fields", "refers")
    with pytest.raises(Exception, match="stop"):
        write_warc(bad, f"{tmp_path}/w")
    assert read_warc(spark, f"{tmp_path}/w").filter("type = 'response'").count() == 1
    assert [r["type"] for r in records_of("f", __import__("io").BytesIO(record("request", "q")), True)] == ["request"]


def test_little_is_copied_at_the_end_of_each_member():
    import gzip
    import io

    from docmill.llm.warc import Inflated

    members = [b"%d " % k * (k % 90) for k in range(2000)]
    stream, found, most = Inflated(io.BytesIO(b"".join(map(gzip.compress, members)))), b"", 0
    while part := stream.read(1 << 16):
        found, most = found + part, max(most, len(stream.left))
    assert found == b"".join(members) and 0 < most <= 1 << 14
