"""Model calls: fan-out over chapters and blocks, fan-in by section, and the merged summary.

A summariser is a callable (text, lang, template) -> {section: content}, built once for each
Python worker by a factory, so clients and connections stay on the executors. The calls are in a
single line (parts, merged blocks, merged chapters). With ``answers``, each step's answers are kept before they are used, and no
question is sent twice; without (dry runs), the line is one lazy plan, which a lost executor runs again. A failed call gives an error in its
row and never fails the job.

A document is a distinct (doc_id, text, pages), named by ``row_key``; so null and repeated ids do not mix.
"""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..functions import fixed as X
from ..functions import structure as S
from ..functions import text as T
from ..functions.text import strip
from .answers import Answers, Summarizer, tried
from .sections import dedup_lines

#: What call_model adds to a row, or carries through where the row's text is null.
OUTCOME = {"sections": "map<string,string>", "error": "string", "attempts": "int", "seconds": "double"}


#: Rows that a worker holds as Python objects at once.
ROWS = 256


def _labels(template: str, lang: str) -> dict[str, str]:
    at = X.LABEL_LANGS.index(lang) if lang in X.LABEL_LANGS else 0
    return {X.LABELS[k][at]: k for k in X.TEMPLATES.get(template, X.TEMPLATES["C"])}


def prompt_text(text: str, lang: str, template: str, max_chars: int = X.MAX_CHARS) -> str:
    """The prompt of sections.prompt for one text, for clients that build it on an executor."""
    fields = "\n".join(f"## {n}" for n in _labels(template, lang))
    return "\n\n".join((X.INSTRUCTIONS.get(lang, X.INSTRUCTIONS["pt"]), fields, f'TEXTO:\n"""\n{text[:max_chars]}\n"""'))


def answer_sections(markdown: str, lang: str, template: str) -> dict[str, str]:
    """The sections of sections.parse_sections for one answer, thoughts removed."""
    known = _labels(template, lang)
    pieces = re.split(r"(?m)^[^\S\n]*##[^\S\n]+(\S.*?)[^\S\n]*$", re.sub(r"(?s)<think>.*?</think>", "", markdown))
    found = {}
    for label, body in zip(pieces[1::2], pieces[2::2]):
        near = (k for n, k in known.items() if n.lower() in label.lower() or label.lower() in n.lower())
        found[known.get(label) or next(near, label)] = body.strip()
    return found


def http_summarizer(url: str, body: Callable[[str], dict], answer: Callable[[dict], str], headers: dict[str, str] | None = None, timeout: float = 600.0) -> Callable[[], Summarizer]:
    """Factory of a summariser behind an HTTP endpoint: ``body`` makes the request of a prompt, ``answer`` takes the text out of the response."""

    def factory() -> Summarizer:
        def call(text: str, lang: str, template: str) -> dict[str, str]:
            sent = json.dumps(body(prompt_text(text, lang, template))).encode()
            request = urllib.request.Request(url, sent, {"Content-Type": "application/json", **(headers or {})})
            with urllib.request.urlopen(request, timeout=timeout) as response:
                return answer_sections(answer(json.load(response)), lang, template)

        return call

    return factory


def first_words(text: str, lang: str, template: str) -> dict[str, str]:
    """Deterministic summariser for dry runs: the first twelve words under each section key."""
    head = " ".join(text.split()[:12])
    return {k: f"[{lang}] {head}" for k in X.TEMPLATES.get(template, X.TEMPLATES["C"])}


def call_model(rows: DataFrame, factory: Callable[[], Summarizer], retries: int = 0, answers: Answers | None = None) -> DataFrame:
    """``rows`` (..., text, lang, template) without text and with OUTCOME: sections, error, attempts, seconds.

    Rows with a null text are not sent; they keep the OUTCOME that they have. attempts and seconds add to
    those that a row brings; an error comes after retries + 1 failures.
    """
    for name, kind in OUTCOME.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(0 if name in ("attempts", "seconds") else None).cast(kind))
    kept = [f for f in rows.schema if f.name not in ("text", *OUTCOME)]
    if answers is not None:
        asked = answers.ask(rows, factory, retries)
        said = F.col("__outcome")
        new = [F.when(said.isNull(), F.col(n)).otherwise(F.col(n) + said[n] if n in ("attempts", "seconds") else said[n]).cast(k).alias(n) for n, k in OUTCOME.items()]
        return asked.select(*[f"`{f.name}`" for f in kept], *new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summarize = factory()
        for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            sent = b.select(["text", "lang", "template", *OUTCOME]).to_pylist()
            for r in sent:
                if r["text"] is None:
                    continue
                out = tried(summarize, r["text"], r["lang"], r["template"], retries)
                r["sections"], r["error"] = out["sections"] and list(out["sections"].items()), out["error"]
                r["attempts"] += out["attempts"]
                r["seconds"] += out["seconds"]
            types = (pa.map_(pa.string(), pa.string()), pa.string(), pa.int32(), pa.float64())
            new = [pa.array([r[n] for r in sent], t) for n, t in zip(OUTCOME, types)]
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in kept] + new, [f.name for f in kept] + list(OUTCOME))

    added = [T_.StructField(n, T_._parse_datatype_string(k)) for n, k in OUTCOME.items()]
    return rows.mapInArrow(run, T_.StructType(kept + added))


#: What was given to the model of a text.
FED = "struct<strategy:string,parts:array<string>,truncated:boolean,chars:int>"


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with row_key, the name of the document (doc_id, text, pages): equal for equal rows only."""
    if "row_key" in docs.columns:
        return docs
    told = F.to_json(F.struct(F.col("doc_id"), F.col("pages")), {"ignoreNullFields": "false"})
    return docs.withColumn("row_key", F.sha2(F.concat(told, F.lit("\n"), F.coalesce("text", F.lit(""))), 256))


def plan_parts(docs: DataFrame, strategy: str = "excerpt", max_chars: int = X.MAX_CHARS, lang: str | None = None, doc_type: str | None = None) -> DataFrame:
    """(row_key, doc_id, chapter, block, chapters, blocks, text, lang, template, fed): what is sent to the model for docs (doc_id, text, pages).

    Only texts over ``max_chars`` follow the strategy: blocks is one chapter of several blocks, hierarchical
    cuts each detected chapter into blocks; others send one excerpt. Unknown languages count as Portuguese.
    ``fed`` says what of the document that is; its parts are null where the blocks' numbers name them.
    """
    typed = described(with_key(docs), lang, doc_type)
    text = F.col("text")

    def one_of(strategy: str, texts: Column, parts: Column) -> Column:
        fed = F.struct(F.lit(strategy).alias("strategy"), parts.cast("array<string>").alias("parts"), F.lit(False).alias("truncated"), F.length(text).alias("chars"))
        return F.struct(fed.cast(FED).alias("fed"), texts.alias("texts"))

    def taken(e: Column) -> Column:
        fed = F.struct(e["strategy"].alias("strategy"), e["parts"].alias("parts"), e["truncated"].alias("truncated"), F.length(e["text"]).alias("chars"))
        return F.struct(fed.cast(FED).alias("fed"), F.array(e["text"]).alias("texts"))

    one = F.array(T.let(S.excerpt(text, F.col("tipo"), max_chars), taken))
    whole = F.array(one_of("blocks", S.blocks(text, max_chars), F.lit(None)))
    if strategy == "blocks":
        parts = F.when(F.length(text) > max_chars, whole).otherwise(one)
    elif strategy == "hierarchical":
        found = S.chapters(text)
        each = F.transform(found, lambda c: one_of("hierarchical", S.blocks(c["text"], max_chars), F.array(F.concat(F.lit("cap_"), c["number"]))))
        parts = F.when(F.length(text) <= max_chars, one).when(F.size(found) > 0, each).otherwise(whole)
    elif strategy == "excerpt":
        parts = one
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    # What stands beside an explode is worked out for each of its rows, so all but the explode comes before it.
    planned = typed.select("row_key", "doc_id", "lang", "template", parts.alias("parts")).withColumn("chapters", F.size("parts"))
    chapters = planned.select("row_key", "doc_id", "lang", "template", "chapters", F.posexplode("parts").alias("chapter", "of"))
    sized = chapters.select("row_key", "doc_id", "chapter", "chapters", F.size("of.texts").alias("blocks"), "lang", "template", "of.fed", "of.texts")
    cut = sized.select("row_key", "doc_id", "chapter", "chapters", "blocks", F.posexplode("texts").alias("block", "text"), "lang", "template", "fed")
    return cut.dropDuplicates(["row_key", "chapter", "block"])


def described(docs: DataFrame, lang: str | None = None, doc_type: str | None = None) -> DataFrame:
    """``docs`` (text, pages) with lang, tipo and template, found or as given; a null text is empty."""
    d = docs.withColumn("text", F.coalesce("text", F.lit("")))
    found = F.lit(lang) if lang else T.let(T.detect_language(F.col("text")), lambda x: F.when(x == "unknown", "pt").otherwise(x))
    d = d.withColumn("lang", found).withColumn("tipo", F.lit(doc_type) if doc_type else T.document_type(F.col("text"), F.col("pages")))
    return d.withColumn("template", T.template_of(F.col("tipo")))


def _merged(rows: DataFrame, keys: list[str], order: str, carried: list[str], join: Callable[[Column, Column], Column], *summed: str, gathered: str | None = None) -> DataFrame:
    """Rows of each key as one: section contents in order through ``join``, the first error, sums of attempts and seconds; ``gathered`` as a list."""
    grouped = rows.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order, "sections")), lambda a, b: a[order] - b[order]), lambda p: p["sections"]).alias("all"),
        *[F.first(c).alias(c) for c in carried],
        F.min("error").alias("error"),
        F.sum("attempts").cast("int").alias("attempts"),
        F.sum("seconds").alias("seconds"),
        *[F.sum(c).cast("int").alias(c) for c in summed],
        *[F.collect_list(c).alias(c) for c in [gathered] if c],
    )
    names = F.array_distinct(F.flatten(F.transform("all", F.map_keys)))
    full = lambda k: F.filter(F.transform(F.col("all"), lambda s: F.try_element_at(s, k)), lambda v: strip(F.coalesce(v, F.lit(""))) != "")
    content = F.map_from_entries(F.transform(names, lambda k: F.struct(k, join(k, full(k)))))
    # A single part stays as the model gave it.
    sections = F.when(F.col("error").isNull(), F.when(F.size("all") == 1, F.col("all")[0]).otherwise(content))
    return grouped.withColumn("sections", sections).drop("all")


def _union_text(several: Column) -> Column:
    """The text of the call over merged sections; null where one part makes that call needless."""
    lines = F.transform(F.filter(F.map_entries("sections"), lambda e: e["value"] != ""), lambda e: F.concat(e["key"], F.lit(":\n"), e["value"]))
    return F.when(several & F.col("sections").isNotNull(), F.array_join(lines, "\n\n"))


def summarize(
    docs: DataFrame, factory: Callable[[], Summarizer], strategy: str = "excerpt", max_chars: int = X.MAX_CHARS, retries: int = 0,
    answers: Answers | None = None, lang: str | None = None, doc_type: str | None = None,
) -> DataFrame:
    """(row_key, doc_id, sections, calls, error, attempts, seconds, fed): one row for each document (doc_id, text, pages).

    Blocks of a chapter are joined by section and summarised together, then chapters likewise. A document
    with a failed call has its error and no sections. calls counts the parts and the calls over merged texts; fed is what the model was given.
    """
    parts = call_model(plan_parts(docs, strategy, max_chars, lang, doc_type), factory, retries, answers)
    head = ["doc_id", "chapters", "blocks", "lang", "template", "fed"]
    by_chapter = _merged(parts, ["row_key", "chapter"], "block", head, lambda _, v: F.array_join(v, "\n"))
    asked = by_chapter.withColumn("text", _union_text(F.col("blocks") > 1)).withColumn("calls", F.col("blocks") + F.col("text").isNotNull().cast("int"))
    chapters = call_model(asked, factory, retries, answers)
    by_doc = _merged(
        chapters.withColumn("names", F.struct("chapter", "fed.parts")), ["row_key"], "chapter", ["doc_id", "chapters", "lang", "template", "fed", "blocks"],
        lambda k, v: F.when(k.isin(*X.DEDUP_KEYS), dedup_lines(v)).otherwise(F.array_join(v, "\n\n")), "calls", gathered="names",
    )
    asked = by_doc.withColumn("text", _union_text(F.col("chapters") > 1)).withColumn("calls", F.col("calls") + F.col("text").isNotNull().cast("int"))
    done = call_model(asked, factory, retries, answers)
    named = F.flatten(F.transform(F.array_sort("names"), lambda n: n["parts"]))
    numbered = F.transform(F.sequence(F.lit(1), F.col("blocks")), lambda k: F.concat(F.lit("bloque_"), k.cast("string")))
    fed = F.struct("fed.strategy", F.coalesce(named, numbered).alias("parts"), "fed.truncated", "fed.chars")
    return done.select("row_key", "doc_id", "sections", "calls", "error", "attempts", F.round("seconds", 6).alias("seconds"), fed.alias("fed"))
