"""Hierarchical summaries against a plain version: chapters, blocks, and one more call over each merged text."""

import random
import re

from docmill import sources, summary_records
from docmill.functions import fixed as X
from docmill.functions.structure import CHAPTER
from docmill.operators import summarize


def plain_blocks(text, most):
    whole = text.strip()
    if len(whole) <= most:
        return [whole] if whole else []
    pieces = [p[i : i + most] for p in re.findall(r"(.+?(?:\n\s*\n|\Z))", whole, re.S) for i in range(0, len(p), most)]
    out, held = [], ""
    for p in pieces:
        if len(held) + len(p) <= most:
            held += p
        else:
            out, held = [*out, held], p
    return [b.strip() for b in [*out, held] if b.strip()]


def plain_summary(text, ask, most):
    """(sections, calls, strategy, parts) of a text for which language and template are fixed."""
    union = lambda s: "\n\n".join(f"{k}:\n{v}" for k, v in s.items() if v)

    def blocks(body):
        found = plain_blocks(body, most)
        partials = [ask(b) for b in found]
        if len(partials) == 1:
            return partials[0], 1, len(found)
        keys = dict.fromkeys(k for p in partials for k in p)
        merged = {k: "\n".join(p[k] for p in partials if p.get(k, "").strip()) for k in keys}
        return ask(union(merged)), len(found) + 1, len(found)

    if len(text) <= most:
        return ask(text.strip()), 1, "full", ["completo"]
    cut = re.split(CHAPTER, text)
    bodies = [b.strip() for b in cut[3::3]]
    if len(bodies) < 2 or len(text) < 100:
        sections, calls, n = blocks(text)
        return sections, calls, "blocks", [f"bloque_{k + 1}" for k in range(n)]
    each = [blocks(b) for b in bodies]
    merged = {}
    for k in dict.fromkeys(k for s, _, _ in each for k in s):
        values = [s[k] for s, _, _ in each if s.get(k, "").strip()]
        if k in X.DEDUP_KEYS:
            lines = {re.sub(r"^[-•] ", "", x.strip()).strip() for v in values for x in v.split("\n")} - {""}
            merged[k] = "\n".join(f"- {x}" for x in sorted(lines))
        else:
            merged[k] = "\n\n".join(values)
    return ask(union(merged)), sum(c for _, c, _ in each) + 1, "hierarchical", [f"cap_{n}" for n in cut[1::3]]


def test_against_a_plain_version(spark):
    def odd(text, lang, template):
        """Sections that depend on the text: some blank, some bulleted, one by chance alone."""
        out = {"titulo": text[:25], "terminos": "\n".join(f"- {w}" for w in sorted(set(text.split()))[:4]), "publico": "" if len(text) % 3 == 0 else f"n{len(text)}"}
        return out | ({"extra": text[-9:]} if len(text) % 2 else {})

    r = random.Random(9)
    para = lambda: " ".join(r.choice(["uno", "dos", "tres", "cuatro"]) for _ in range(r.randint(1, 25)))
    body = lambda: "\n\n".join(para() for _ in range(r.randint(1, 9)))
    texts = ["".join(f"Capítulo\n\n{k + 1}\n\nTITULO NUMERO\n{body()}\n" for k in range(n)) for n in (0, 1, 2, 3, 5, 8)]
    texts += [body() for _ in range(4)] + ["x" * 900, "corto", "Prefacio\n" + texts[3], "a\n\n" * 400]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts) if t], "doc_id int, text string, pages int")
    got = {x.doc_id: x for x in summary_records(docs, lambda: odd, "hierarchical", 120, lang="es", doc_type="divulgacion").collect()}
    for k, t in enumerate(texts):
        if t:
            sections, calls, strategy, parts = plain_summary(t, lambda x: odd(x, "es", "C"), 120)
            assert (got[k].secciones, got[k].calls, got[k].fed.strategy, got[k].fed.parts) == (sections, calls, strategy, parts), k
    assert {x.fed.strategy for x in got.values()} == {"full", "blocks", "hierarchical"}
    assert summarize.plan_parts(docs.limit(0), "hierarchical", 120).count() == 0


def test_written_metadata_is_read_again(spark, tmp_path):
    meta = spark.createDataFrame([("a b", "s1", "3", 2), ("ñ/2", "s2", "2", 1)], "doc_id string, pdf_sha256 string, pipeline_version string, pages int")
    sources.write_ocr_meta(meta, str(tmp_path / "m"))
    (tmp_path / "m" / "old.meta.json").write_text('{"pdf_sha256": "s3"}')
    (tmp_path / "m" / "bad.meta.json").write_text("{")
    got = {r.doc_id: (r.pdf_sha256, r.pipeline_version, r.readable) for r in sources.read_ocr_meta(spark, str(tmp_path / "m")).collect()}
    assert got == {"a b": ("s1", "3", True), "ñ/2": ("s2", "2", True), "old": ("s3", None, True), "bad": (None, None, False)}
