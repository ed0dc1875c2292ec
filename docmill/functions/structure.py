"""Column functions over document structure: sections, excerpts, abstracts, chapters, blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X
from .text import NOT_WORD_AFTER, heading, let, scan, strip



def cut(text: Column, start: Column | int, size: Column | int) -> Column:
    """``size`` code points from offset ``start`` (0 is the first)."""
    return F.substring(text, F.lit(start) + 1 if isinstance(start, int) else start + 1, F.lit(size) if isinstance(size, int) else size)


def section_start(text: Column, name: str, blank: bool = True) -> Column:
    """Offset of a section's first heading, null without one; blank lines before it are its own unless ``blank`` is false."""
    words, line = rf"(?iu:{X.STRUCTURE[name]}){NOT_WORD_AFTER}", r"(?dm:^)\s*"
    found = F.regexp_extract(text, rf"(?s)^(.*?)(?={line}{words})" if blank else rf"(?s)^(.*?{line})(?={words})", 1)
    return F.when(text.rlike(heading(X.STRUCTURE[name])), F.length(found))


def sections(text: Column) -> Column:
    """array<struct<start, name>> of the sections found, by offset."""
    each = [F.struct(section_start(text, n).alias("start"), F.lit(n).alias("name")) for n in X.STRUCTURE]
    return F.array_sort(F.filter(F.array(*each), lambda s: s["start"].isNotNull()))


def excerpt(text: Column, doc_type: Column, max_chars: int = X.MAX_CHARS) -> Column:
    """struct<text, parts, truncated, strategy>: what a model is given of a document.

    A window begins with its heading, so blank lines before that take nothing of the window's share.
    """

    def made(body: Column, parts: Column, truncated: Column, strategy: str) -> Column:
        return F.struct(body.alias("text"), parts.alias("parts"), truncated.alias("truncated"), F.lit(strategy).alias("strategy"))

    whole = made(strip(text), F.array(F.lit("completo")), F.lit(False), "full")
    prefix = strip(cut(text, 0, max_chars))
    shape = "struct<text:string,used:array<string>,total:int>"
    start = F.struct(F.lit("").alias("text"), F.array().cast("array<string>").alias("used"), F.lit(0).alias("total")).cast(shape)

    def window(name: str, share: float) -> Column:
        at = section_start(text, name, False)
        return F.struct(F.lit(name).alias("name"), F.when(at.isNotNull(), strip(cut(text, at, int(max_chars * share)))).alias("body"))

    article = F.filter(F.array(window("abstract", 0.4), window("introducao", 0.3), window("conclusao", 0.3)), lambda w: w["body"].isNotNull())

    def add_article(acc: Column, w: Column) -> Column:
        gap = F.when(F.size(acc["used"]) > 0, 2).otherwise(0)
        body = F.substring(w["body"], F.lit(1), F.greatest(F.lit(0), F.lit(max_chars) - acc["total"] - gap))
        joined = F.concat(acc["text"], F.when(gap > 0, "\n\n").otherwise(""), body)
        return F.when(
            strip(body) != "", F.struct(joined.alias("text"), F.concat(acc["used"], F.array(w["name"])).alias("used"), (acc["total"] + gap + F.length(body)).alias("total")).cast(shape)
        ).otherwise(acc)

    art = F.aggregate(article, start, add_article)
    head = strip(cut(text, 0, int(max_chars * 0.25)))
    offsets = F.array(*[F.struct(F.lit(n).alias("name"), section_start(text, n, False).alias("at")) for n in ("apresentacao", "sumario", "introducao")])
    first = F.struct(
        head.alias("text"), F.when(head != "", F.array(F.lit("portada"))).otherwise(F.array().cast("array<string>")).alias("used"), F.length(head).alias("total")
    ).cast(shape)

    def add_manual(acc: Column, w: Column) -> Column:
        left = F.lit(max_chars) - acc["total"]
        body = F.when((left > 0) & w["at"].isNotNull(), strip(cut(text, w["at"], F.least(F.lit(int(max_chars * 0.25)), left)))).otherwise("")
        joined = F.concat(acc["text"], F.when(F.size(acc["used"]) > 0, "\n\n").otherwise(""), body)
        return F.when(
            body != "", F.struct(joined.alias("text"), F.concat(acc["used"], F.array(w["name"])).alias("used"), (acc["total"] + F.length(body)).alias("total")).cast(shape)
        ).otherwise(acc)

    man = F.aggregate(offsets, first, add_manual)
    by_prefix = F.array(F.lit("prefijo"))
    return (
        F.when(F.length(text) <= max_chars, whole)
        .when((doc_type == "articulo") & (F.size(article) > 0), made(art["text"], art["used"], F.lit(True), "articulo"))
        .when(doc_type == "articulo", made(prefix, by_prefix, F.lit(True), "articulo"))
        .when(doc_type == "manual", made(strip(cut(man["text"], 0, max_chars)), man["used"], F.lit(True), "manual"))
        .otherwise(made(prefix, by_prefix, F.lit(True), "divulgacion"))
    )


def abstracts(text: Column) -> Column:
    """array<struct<lang, header, text, keywords>> of the abstracts that stand under their headings."""
    names = "|".join(X.ABSTRACT_HEADERS)
    head = rf"(?dimu)^\s*({names})\s*[:.\-]?\s*"
    headers = F.regexp_extract_all(text, F.lit(head), F.lit(1))
    bodies = F.slice(F.split(text, head, -1), 2, 1 << 30)
    langs = F.create_map(*[F.lit(v) for kv in X.ABSTRACT_HEADERS.items() for v in kv])
    mark = rf"(?iu)(?<![\p{{L}}\p{{N}}_])({X.ABSTRACT_KEYWORDS}){NOT_WORD_AFTER}\s*[:.\-]?\s*"

    def block(pair: Column) -> Column:
        chunk = strip(pair["body"])
        halves = F.split(chunk, mark, 2)
        keywords = F.when(F.size(halves) > 1, strip(F.element_at(F.split(strip(F.get(halves, F.lit(1))), r"\n\s*\n", 2), 1))).otherwise("")
        body = F.when(F.size(halves) > 1, strip(F.get(halves, F.lit(0)))).otherwise(chunk)
        lead = F.element_at(F.split(body, rf"(?dimu)^\s*(?:{X.ABSTRACT_BODY}){NOT_WORD_AFTER}", 2), 1)
        body = F.when((F.length(lead) > X.BODY_AFTER) & (F.length(lead) < F.length(body)), strip(lead)).otherwise(body)
        body = strip(F.regexp_replace(body, r"(?U)\s+", " "))
        for tail in X.ABSTRACT_TAILS:
            body = strip(F.element_at(F.split(body, f"(?i){tail}", 2), 1))
        capped = F.substring(body, 1, X.ABSTRACT_MAX)
        dotted = F.when(F.contains(capped, F.lit(".")), F.regexp_extract(capped, r"(?s)^(.*)\.", 1)).otherwise(capped)
        body = F.when(F.length(body) > X.ABSTRACT_MAX, F.concat(strip(dotted), F.lit("."))).otherwise(body)
        header = F.upper(pair["header"])
        return F.struct(F.try_element_at(langs, header).alias("lang"), header.alias("header"), body.alias("text"), keywords.alias("keywords"))

    pairs = F.zip_with(headers, bodies, lambda h, b: F.struct(h.alias("header"), b.alias("body")))
    return F.filter(F.transform(pairs, block), lambda b: F.length(b["text"]) >= X.ABSTRACT_MIN)


CHAPTER = r"Cap[ií]tulo\s*\n+\s*(\d{1,2})\s*\n+\s*([A-ZÁÉÍÓÚÑ0-9][^\n]{3,90})"


def chapters(text: Column) -> Column:
    """array<struct<number, title, text>>; empty for short texts or fewer than two headings."""
    numbers = F.regexp_extract_all(text, F.lit(CHAPTER), F.lit(1))
    titles = F.regexp_extract_all(text, F.lit(CHAPTER), F.lit(2))
    bodies = F.slice(F.split(text, CHAPTER, -1), 2, 1 << 30)
    found = F.transform(
        F.arrays_zip(numbers.alias("n"), titles.alias("t"), bodies.alias("b")),
        lambda c: F.struct(c["n"].alias("number"), strip(c["t"]).alias("title"), strip(c["b"]).alias("text")),
    )
    return F.when((F.length(text) >= 100) & (F.size(numbers) >= 2), found).otherwise(F.slice(found, 1, 0))


def covered(text: Column, found: Column) -> Column:
    """Whether the chapters hold at least 80 % of the text."""
    held = F.aggregate(found, F.lit(0), lambda acc, c: acc + F.length(c["text"]))
    return (F.size(found) > 0) & (F.try_divide(held.cast("double"), F.length(text)) >= 0.8)


def blocks(text: Column, max_chars: int = X.BLOCK_CHARS) -> Column:
    """Blocks of at most ``max_chars`` that cover the text, cut between paragraphs where possible.

    Paragraphs carry the blank lines behind them; longer ones are cut hard first, so a scan over the
    lengths of pieces that all fit is enough and no piece is given twice.
    """
    whole = strip(text)
    paragraphs = F.regexp_extract_all(whole, F.lit(r"(?s)(.+?(?:\n\s*\n|\z))"), F.lit(1))
    pieces = F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(p, F.lit(rf"(?s)(.{{1,{max_chars}}})"), F.lit(1))))
    return F.when(F.length(whole) <= max_chars, F.filter(F.array(whole), lambda b: b != "")).otherwise(let(pieces, lambda p: packed(p, max_chars)))


def packed(pieces: Column, max_chars: int) -> Column:
    """Pieces in order, as many in a block as fit, without the blanks at a block's ends."""

    def step(state: Column, n: Column) -> Column:
        fits = state["held"] + n <= max_chars
        return F.struct(F.when(fits, state["held"] + n).otherwise(n).alias("held"), (state["block"] + F.when(fits, 0).otherwise(1)).alias("block"))

    start = F.struct(F.lit(0).alias("held"), F.lit(0).alias("block"))
    block = scan(F.transform(pieces, F.length), start, step, lambda s: s["block"])

    def cut_up(of: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda k: (k == 0) | (F.get(of, k) != F.get(of, k - 1)))
        ends = lambda at: F.transform(at, lambda k, i: F.array_join(F.slice(pieces, k + 1, F.coalesce(F.get(at, i + 1), F.size(pieces)) - k), ""))
        return F.filter(F.transform(let(first, ends), strip), lambda b: b != "")

    return F.when(F.size(pieces) > 0, let(block, cut_up)).otherwise(pieces)
