"""Many-term matching, label joins and the review fold against plain versions."""

import io
import random
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from docmill.functions import fixed as X
from docmill.operators import jobs, matching


def test_terms_against_find(spark):
    r = random.Random(3)
    word = lambda a, b: "".join(r.choice("abÉé ") for _ in range(r.randint(a, b)))
    texts = [(r.choice([None, *range(30)]), word(0, 60)) for _ in range(60)] + [(1, None), (2, ""), (2, ""), (3, "b" * 200_000 + "aé")]
    terms = [(k, word(0, 5)) for k in range(80)] + [(5, "a"), (500, "bb"), (501, "bb"), (None, "a"), (502, None), (503, "b" * 1000)]
    docs = spark.createDataFrame([(*t, 9) for t in texts], "key int, text string, term_id int")
    known = spark.createDataFrame(terms, "term_id long, term string")
    want = sorted(((i, n, w, (t or "").lower().index(w.lower()) + 1) for i, t in texts for n, w in {(n, w.lower()) for n, w in terms if n is not None and w is not None} if w in (t or "").lower()), key=str)
    for chars in (10_000, 60):  # one automaton, and many
        got = sorted((tuple(x) for x in matching.term_matches(docs, known, "key", chars=chars).collect()), key=str)
        assert got == want
    assert matching.term_matches(docs, known.limit(0), "key").count() == 0 and matching.term_matches(docs.limit(0), known, "key").count() == 0


def label_of(text, labels):
    if not text:
        return None
    best = [(w != text, p, w) for w, p in labels if w and (w.lower() in text.lower() or text.lower() in w.lower())]
    return min(best)[2] if best else None


def test_labels_against_every_pair(spark):
    r = random.Random(4)
    word = lambda a, b: "".join(r.choice("abcÁ.") for _ in range(r.randint(a, b)))
    labels = [(word(0, 6), r.randint(0, 9)) for _ in range(70)] + [(None, 1), ("a", 3), ("ab", 3), ("hot" * 30, 0)]
    texts = [word(0, 12) for _ in range(150)] + [None, "", "hot", "HOT", "hot" * 2000] + ["ab"] * 50
    t, b = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, text string"), spark.createDataFrame(labels, "label string, place int")
    least = {}
    for w, p in labels:
        if w is not None:
            least[w] = min(p, least.get(w, p))
    made = matching.closest_label(t, b)
    assert {x.k: x.label for x in made.collect()} == {k: label_of(x, least.items()) for k, x in enumerate(texts)}
    said = io.StringIO()
    with redirect_stdout(said):
        made.explain()
    assert "NestedLoop" not in said.getvalue() and "Cartesian" not in said.getvalue()
    assert matching.containing(t.limit(0), b).count() == 0 and matching.containing(t, b.limit(0)).count() == 0


def test_grams_of_few_bytes_of_text_stay_in_many_tasks_and_are_not_sorted(spark):
    texts = spark.range(3000).selectExpr("concat('w', id, ' ', md5(cast(id % 1000 as string))) AS text")
    labels = spark.createDataFrame([("w99 ",), ("W1",), ("ab",), ("nothing of it",)], "label string")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        made = matching.containing(texts, labels)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert "REPARTITION_BY_NUM" in plan and "min_by" not in plan and "SortAggregate" not in plan
    own = [r.text for r in texts.collect()]
    assert {tuple(r) for r in made.collect()} == {(t, w) for t in own for w in ("w99 ", "W1", "ab", "nothing of it") if w.lower() in t.lower()}


def plain_reviews(results, events):
    required = [k for k in X.TEMPLATES["C"] if k not in X.OPTIONAL_KEYS]
    out = {}
    for doc, first in results.items():
        sections, state, editor, n = dict(first), None, None, 0
        for _, _, action, reviewer, note, force, changes in sorted((e for e in events if e[1] == doc), key=lambda e: e[0]):
            note = note or ""
            if action == "edited":
                sections |= changes or {}
                editor = reviewer
            elif action == "approved":
                bad = ["schema"] * sum(not sections.get(k, "").strip() for k in required) + ["refusal"] * any("i cannot" in v.lower() for v in sections.values())
                if bad and not force:
                    continue
                if bad:
                    note = f"{note} [FORZADO pese a: {', '.join(bad)}]".strip()
            elif action != "rejected":
                continue
            n += 1
            state = (action, reviewer, note, dict(sections), editor)
        if state:
            out[doc] = (*state, n)
    return out


def test_reviews_against_a_plain_loop(spark):
    r = random.Random(5)
    keys = [*X.TEMPLATES["C"], "otra"]
    results = {f"d{k}": {key: r.choice(["x", " ", "y"]) for key in keys if r.random() < 0.9} for k in range(12)} | {"full": dict.fromkeys(keys, "x")}
    events = [(n, r.choice([*results, "unknown"]), r.choice(["approved", "approved", "rejected", "edited", "odd"]), f"r{n % 4}", r.choice([None, "", "nota"]), r.random() < 0.2, {r.choice(keys): r.choice(["e", " ", "I cannot help"])} if r.random() < 0.9 else None) for n in range(400)]
    # an approval is refused, the gap is filled, and the next one holds; another edit spoils it again
    results["story"] = {k: "x" for k in keys if k != "titulo"}
    events += [(500, "story", "approved", "a", "", False, None), (501, "story", "edited", "b", "n", False, {"titulo": "T"}), (502, "story", "approved", "c", "ok", False, None), (503, "story", "edited", "d", "", False, {"titulo": " "}), (504, "story", "approved", "e", "", False, None)]
    base = spark.createDataFrame(list(results.items()), "doc_id string, sections map<string,string>").selectExpr("*", "'C' AS template", "'es' AS lang", "cast(array() as array<string>) AS declared", "cast(array() as array<string>) AS present")
    rows = spark.createDataFrame([(d, n, a, who, note, force, c) for n, d, a, who, note, force, c in events], "doc_id string, seq long, action string, reviewer string, note string, force boolean, changes map<string,string>").withColumn("ts", F.timestamp_seconds(F.col("seq")))
    actions = jobs.reviewed(base, rows)
    got = {x.doc_id: (x.state, x.reviewer, x.note, x.sections, x.edited_by, x.actions) for x in jobs.review_records(actions).collect()}
    assert got == plain_reviews(results, events) and got["story"][:2] == ("edited", "d")
    story = actions.filter("doc_id = 'story'").orderBy("seq").collect()
    assert [(x.action, x.allowed, x.errors) for x in story] == [("approved", False, ["schema"]), ("edited", True, None), ("approved", True, []), ("edited", True, None), ("approved", False, ["schema"])]
    assert story[1].logged == "n (secciones: ['titulo'])" and jobs.reviewed(base, rows.limit(0)).count() == 0
