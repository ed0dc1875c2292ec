"""Operators without SQL against exhaustive versions over small random tables."""

import math
import random
import re
import struct
import time
from collections import Counter

import numpy as np
import pytest
import xxhash

from docmill.llm import decontaminate, mixing, near_dup
from docmill.llm.decontaminate import drop_leaks, find_leaks
from docmill.llm.line_dedup import cut_repeats, repeated_lines
from docmill.llm.linear import Ftrl
from docmill.llm.mixing import mix_sources, words_taken
from docmill.llm.near_dup import keep_one_of_each, near_duplicates
from docmill.llm.quality import labelled_sample
from docmill.llm.queries import QUERIES
from docmill.llm.secrets import scan_secrets


def later_lines(texts, min_words):
    """Places of the lines that go, for each text of a list in order: every window of every length, as the docstring defines it."""
    lines = [[(k, x) for k, x in enumerate((t or "").split("\n")) if x.strip()] for t in texts]
    first, gone = {}, [set() for _ in texts]
    for d, own in enumerate(lines):
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                run = tuple(x for _, x in own[i:j])
                if sum(len(x.split()) for x in run) < min_words:
                    continue
                at, f = first.setdefault(run, (d, i))
                if (at, f) != (d, i):
                    gone[d] |= {own[k][0] for k in range(i, j) if at != d or not f <= k < f + len(run)}
    return [sorted(g) for g in gone]


def test_line_dedup_against_every_window(spark):
    r, min_words = random.Random(7), 7
    letters = ["a", "b b", "c c c", "d " * 6, "e " * 30, "", " "]
    texts = ["\n".join(r.choice(letters[: r.randint(2, 7)]) for _ in range(r.randint(0, 40))) for _ in range(14)]
    texts += ["\n".join(["x x"] * 20), "\n".join(["p " * 7, "q " * 7] * 2 + ["p " * 7]), None, texts[3], texts[3]]
    ids = [*range(len(texts) - 2), len(texts) - 3, None]  # a repeated row, and a copy without an id, which is the last in order
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id int, text string")
    gone = later_lines(texts, min_words)
    got = sorted((str(x.doc_id), x.n_dropped, x.dropped) for x in repeated_lines(docs, min_words).collect())
    assert got == sorted((str(i), len(g), g) for i, g in zip(ids, gone))
    whole = [t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g) for t, g in zip(texts, gone)]
    assert sorted((str(x.doc_id), str(x.text)) for x in cut_repeats(docs, min_words).collect()) == sorted((str(i), str(t)) for i, t in zip(ids, whole))


def test_no_text_is_lost_where_rows_repeat(spark):
    text = "\n".join("w%d " % k * 20 for k in range(6))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    assert sorted(r.text for r in cut_repeats(docs).collect()) == ["", "", text]


def brute_spans(text, scope=400):
    kinds = {
        "assign": (r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I, 8),
        "access": (r"(AKIA[A-Z0-9]+)", 0, 16),
        "hex": (r"([0-9a-f]+)", 0, 32),
        "weak_id": (r"""((?:access_?key(?:_?id)?|client_?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,})""", re.I, 0),
        "weak_secret": (r"((?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=]))", 0, 0),
        "endpoint": (r"""((?:https?|ftp|jdbc:[a-z]+|s3|redis|mongodb|amqp)://[^\s"'<>]+)""", re.I, 0),
    }
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, (p, flags, least)) in enumerate(kinds.items()) for m in re.finditer(p, text, flags) if len(m[1]) >= least]
    base = [s for s in found if s[1] < 3]
    weak = [s for s in found if s[1] >= 3 and not any(b[0] < s[2] and s[0] < b[2] for b in base)]
    part = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
    need = {"weak_id": {"secret"}, "weak_secret": {"id"}, "endpoint": {"id", "secret"}}
    linked = [w for w in weak if need[w[3]] <= {part[s[3]] for s in base + weak if max(s[0] - w[2], w[0] - s[2]) <= scope}]
    return sorted(base), sorted(base + linked)


def test_secrets_against_all_pairs(spark):
    r = random.Random(5)
    pieces = ["login=bob77", "Zz9/" * 10, "token=abcdefgh12", "https://x.example/yy", "AKIA" + "B" * 16, "0f" * 16, "client_id: me", "s3://b/" + "k" * 500, "password=" + "z" * 900, "é😀", "user=AKIA" + "C" * 20, "secret=" + "0123456789abcdef" * 2]
    texts = ["".join(r.choice(pieces) + " " * r.choice([1, 1, 2, 90, 399, 401]) for _ in range(r.randint(1, 60))) for _ in range(40)] + [" ".join(["0a" * 16] * 700)]
    got = {row.doc_id: row for row in scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    for k, t in enumerate(texts):
        base, spans = brute_spans(t)
        assert [tuple(s) for s in got[k].base] == base, k
        assert [tuple(s) for s in got[k].spans] == spans, k


def test_secrets_of_a_long_text_in_short_time(spark):
    text = " ".join(f"login=bob{k} " + "Zz9/" * 10 + f" token=abcdefgh{k}" for k in range(16_000))
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    scan_secrets(docs.limit(0)).collect()
    began = time.time()
    row = scan_secrets(docs).selectExpr("size(base) AS b", "size(spans) AS s").first()
    assert (row.b, row.s) == (16_000, 48_000) and time.time() - began < 30


def leak_tables():
    """Documents (id, text) and items (id, text) with leaks whole, in parts, spread out, at the seams of passages, and none."""
    r = random.Random(11)
    common, rare = ["the", "of", "and", "in", "to"], [f"r{k}" for k in range(300)]
    some = lambda n: " ".join(r.choice(common) if r.random() < 0.5 else r.choice(rare) for _ in range(n))
    items = [(k, f"{some(r.randint(3, 30))}? {some(r.randint(1, 12))}") for k in range(40)]
    items += [(100, some(170) + ". " + some(20)), (101, "the of and"), (102, None), (103, ""), (104, "one? word"), (7, items[7][1]), (105, items[7][1]), (None, items[9][1])]
    docs = [(None if k % 17 == 0 else k, some(r.randint(0, 400))) for k in range(60)]
    for k in range(60):
        q, _, a = (items[k % 40][1]).partition("?")
        docs.append((1000 + k, " ".join([some(r.randint(0, 200)), q if k % 3 else q.upper(), some(r.choice([0, 3, 20, 60, 100])), a if k % 4 else "", some(r.randint(0, 90))])))
    return docs + [(2000, some(90) + " " + items[40][1] + " " + some(40)), (2001, None), (2002, ""), (2003, items[47][1]), docs[70], docs[70]], items


def brute_leaks(docs, items, threshold=0.6, overlap=0.8):
    """(doc, item) pairs by scoring every item for every passage."""
    words = {(i, t): decontaminate.words_of(t) for i, t in items if t and decontaminate.words_of(t)}
    n, mean = len(words), sum(map(len, words.values())) / len(words)
    df = Counter(w for x in words.values() for w in set(x))
    weight = {}
    for key, x in words.items():
        of = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean)) for w, tf in Counter(x).items()}
        weight[key] = {w: v / sum(of.values()) for w, v in of.items()}
    out = Counter()
    for d, t in docs:
        x, found = decontaminate.words_of(t or ""), set()
        for key, of in weight.items():
            half = max(64, 2 ** math.ceil(math.log2(len(words[key]))))
            q, a = decontaminate.parts(key[1])
            for s in range(0, max(1, len(x) - half), half):
                passage = x[s : s + 2 * half]
                if sum(of.get(w, 0) for w in set(passage)) >= threshold - 1e-6 and min(decontaminate.held(q, passage), decontaminate.held(a, passage)) >= overlap:
                    found.add(key[0])
        out.update((d, i) for i in found)
    return out


@pytest.mark.parametrize("shard_words", [2_000_000, 300, 100])
def test_leaks_against_every_item_for_every_passage(spark, monkeypatch, shard_words):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    rows, items = leak_tables()
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    want = brute_leaks(rows, items)
    assert len(want) > 30 and Counter((r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()) == want
    if shard_words == 300:
        leaking = {d for d, _ in want if d is not None}
        kept = [r.doc_id for r in drop_leaks(docs, bench).collect() if r.doc_id is not None]
        assert sorted(kept) == sorted(d for d, _ in rows if d is not None and d not in leaking)


def test_wand_finds_what_exhaustive_scoring_finds():
    r = random.Random(3)
    weights = []
    for _ in range(300):
        of = {r.randrange(80): r.random() ** 3 for _ in range(r.randint(1, 12))}
        weights.append({t: w / sum(of.values()) for t, w in of.items()})
    postings = decontaminate.Postings(64, list(range(300)), weights, 80, 0.6)
    for _ in range(300):
        terms = sorted(r.sample(range(80), r.randint(1, 60)))
        want = {i for i, of in enumerate(weights) if sum(w for t, w in of.items() if t in terms) >= 0.6}
        assert {i for i, _ in postings.search(terms)} == want


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BUCKET", 8)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    r = random.Random(2)
    rows = []
    for _ in range(12):
        base = [f"w{r.randrange(500)}" for _ in range(r.randint(3, 150))]
        for _ in range(r.randint(1, 25)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = f"x{r.randrange(9)}"
            rows.append(" ".join(copy))
    rows = [(None if k % 13 == 0 else str(r.randrange(10**6)), t) for k, t in enumerate(rows)] + [(None, None), ("e", ""), (None, "only here without an id")]
    rows += [rows[1], rows[13]]
    sets = [({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()) for _, t in rows for w in [(t or "").split()]]
    n, links, root = len(rows), Counter(), list(range(len(rows)))
    for a in range(n):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root = [root[b] if x == root[a] else x for x in root]
    ids = {x: [rows[k][0] for k in range(n) if root[k] == x] for x in set(root)}
    name = {x: min((i for i in of if i is not None), default=None) for x, of in ids.items()}
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = Counter((x.doc_id, x.class_id, x.n_links) for x in near_duplicates(docs).collect())
    assert got == Counter((rows[k][0], name[root[k]], links[k]) for k in range(n))
    kept = keep_one_of_each(docs).collect()
    assert sorted(str(x.doc_id) for x in kept) == sorted(str(i) for i in name.values())


def spark_hash(*values):
    """Spark's xxhash64: (kind, value) pairs, each seeding the next; nulls leave the seed."""
    h = 42
    for kind, v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if kind == "s" else struct.pack(f"<{kind}", v), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_mixture_step_by_step(spark):
    """The same draws, permutations and streams, one word block at a time."""
    block, per_shard, bucket_docs, seed = 16, 32, 20, 17
    r = random.Random(4)
    rows = [(k if k % 50 else None, r.choice([0, 1, 5, 40, 90]), r.choice(["a", "b", "c", None, "ñ"])) for k in range(300)] + [(1000, 4000, "a"), (1001, 7, "tiny"), (7, 3, "b"), (7, 3, "b")]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, n, s in rows], "doc_id long, text string, source string")
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    own = {s: [(i, n) for i, n, x in rows if x == s] for s in sources}
    size = {s: sum(n for _, n in own[s]) for s in sources}
    fixed, total = {}, sum(size.values())
    while True:
        free = [s for s in sources if s not in fixed]
        weight = {s: sources.index(s) % 3 + 1 for s in free}
        share = {s: (total - sum(fixed.values())) * weight[s] / sum(weight.values()) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        fixed |= {s: 3.0 * size[s] for s in over}
    target = fixed | share
    plan = []
    for s in sources:
        words, blocks = math.floor(target[s] + 0.5), -(-size[s] // block)
        passes = words // size[s]
        rest = words - passes * size[s]
        plan.append((size[s] // block, blocks, passes, rest, passes * blocks + -(-rest // block)))
    quota = [p[4] for p in plan]
    edges = [sum(quota[: k + 1]) / sum(quota) for k in range(len(quota))]
    counts, drawn, surplus = [0] * len(quota), [], []
    for slot in range(sum(quota)):
        u = spark_hash(("i", seed), ("s", "draw"), ("q", slot)) % (1 << 52) / (1 << 52)
        src = next(k for k, e in enumerate(edges) if u < e)
        (drawn.append((slot, src, counts[src])) if counts[src] < quota[src] else surplus.append(slot))
        counts[src] += 1
    missing = [(s, k) for s in range(len(quota)) for k in range(counts[s], quota[s])]
    drawn += [(slot, s, k) for slot, (s, k) in zip(surplus, missing, strict=True)]
    used = Counter()
    for _, src, k in drawn:
        full, blocks, passes, rest, _ = plan[src]
        turn, at = divmod(k, blocks)
        if at >= full:
            place, length = full, size[sources[src]] - full * block
        else:
            place, length, key = at, block, spark_hash(("i", seed), ("i", src), ("q", turn))
            for x in range(1, 41):
                other = (spark_hash(("q", key), ("i", x)) % full - place) % full
                if spark_hash(("q", key), ("i", x), ("q", max(place, other))) % 2 == 1:
                    place = other
        used[src, place, min(length, rest - at * block) if turn == passes else length] += 1
    want = Counter()
    for src, s in enumerate(sources):
        spread = max(1, -(-len(own[s]) // bucket_docs))
        key = lambda d: (spark_hash(("i", seed + 1), ("q", d[0]), ("q", d[1])) % spread, spark_hash(("i", seed), ("q", d[0])), d[0] is not None, d[0] or 0, d[1])  # noqa: E731, B023
        at = 0
        for i, n in sorted(own[s], key=key):
            got = sum(times * max(0, min(at + n, b * block + w) - max(at, b * block)) for (x, b, w), times in used.items() if x == src)
            want[i, s, n, size[s], round(target[s], 6), got] += 1
            at += n
    mix = mix_sources(docs, block_words=block, slots_per_shard=per_shard, bucket_docs=bucket_docs, seed=seed)
    assert Counter((x.id, x.source, x.size, x.source_size, round(x.target, 6), x.taken) for x in words_taken(mix).collect()) == want
    assert sorted(s.slot for s in mix.slots.collect()) == list(range(sum(quota)))


def test_prefix_sums_in_runs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 4)
    rows = [(g, k, k * k) for g in ("a", "b", None) for k in range(0, 90, 3)]
    df = spark.createDataFrame(rows, "g string, k long, v long").na.fill("none")
    got = {(r.g, r.k): r.out for r in mixing.before(df, ["g"], "k", "v", "out").collect()}
    assert got == {(g or "none", k): sum(x * x for x in range(0, k, 3)) for g, k, _ in rows}


def test_updates_against_a_plain_loop():
    """Follow-the-regularised-leader with dictionaries, one weight at a time."""
    r = random.Random(1)
    model, z, n = Ftrl(dim=50, alpha=0.5, l1=0.1, l2=0.1), Counter(), Counter()

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.1 else -(z[i] - math.copysign(0.1, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.5 + 0.1)

    for _ in range(300):
        x = {i: r.random() for i in r.sample(range(50), 6)}
        y = int(sum(v for i, v in x.items() if i % 2) > 1)
        model.learn(np.array(list(x), np.int32), np.array(list(x.values())), y)
        x[50] = 1.0
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))
        for i, v in x.items():
            w, g = weight(i), (p - y) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * w
            n[i] += g * g
    assert np.allclose(model.weights(), [weight(i) for i in range(51)], atol=1e-5)


def test_held_out_accuracy(spark):
    """Both classifiers on the third of the labelled rows that they never see."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = {r.doc_id: r.predicted for r in QUERIES["op3_quality"](spark, folder).collect() if r.held_out and r.doc_id in labels}
    assert len(held) > 1000 and sum(labels[i][0] == p for i, p in held.items()) / len(held) >= 0.99
    toxic = {r.doc_id: r.toxic for r in QUERIES["op6_toxicity"](spark, folder).collect() if r.doc_id in held}
    assert sum(labels[i][1] == p for i, p in toxic.items()) / len(toxic) >= 0.97
    hit, said, there = sum(labels[i][1] and p for i, p in toxic.items()), sum(toxic.values()), sum(labels[i][1] for i in toxic)
    assert hit / there >= 0.9 and hit / said >= 0.9  # recall and precision


def test_samples_are_bounded_whatever_repeats(spark):
    rows = [(k, "w " * (k + 1)) for k in range(50)] + [(3, "w " * 900)] * 40 + [(2, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] * 2, "doc_id long, quality int")
    take = lambda sample, chars: labelled_sample(docs, labels, sample, chars, "doc_id", "text", ["quality"]).collect()
    got = take(5, 10**6)
    assert len(got) == 5 == len({r.id for r in got})
    whole = take(1000, 10**6)
    assert sum(len(r.text) for r in take(1000, 700)) <= 700 and all(len(r.text) <= 700 // 64 for r in take(1000, 700))
    assert {r.id: r.text for r in whole}.get(2, "") == "" and len(whole) == len({r.id for r in whole}) > 20
