"""Column functions over texts: tokens, languages, types, cleaning, ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as X

NOT_WORD_AFTER = r"(?![\p{L}\p{N}_])"
MARKER = r"(?dm)^=== pág \d+ ===$"


def strip(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def pick(table: dict, key: Column, default=None) -> Column:
    """Value of a small literal map."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, key), F.lit(default)) if default is not None else F.try_element_at(m, key)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Items that a scan goes through before it starts another array.
RUN = 256


def scan(items: Column, start: Column, step: Callable[[Column, Column], Column], out: Callable[[Column], Column]) -> Column:
    """``out`` of the state after each item, the state being ``step`` of the one before and the item.

    Appending to one array for each item would copy it each time. So the states at every RUN-th item come
    first, then those between two of them, and work stays in proportion to the items.
    """

    def over(items: Column) -> Column:
        part = lambda k: F.slice(items, k * RUN + 1, RUN)
        runs = F.sequence(F.lit(0), F.greatest(F.floor((F.size(items) - 1) / RUN).cast("int"), F.lit(0)))
        begins = F.aggregate(runs, F.array(start), lambda a, k: F.concat(a, F.array(F.aggregate(part(k), F.element_at(a, -1), step))))

        def inside(state: Column, k: Column) -> Column:
            first = let(F.aggregate(F.slice(items, k * RUN + 1, 1), state, step), lambda s: F.struct(s.alias("s"), F.array(out(s)).alias("all")))

            def add(a: Column, x: Column) -> Column:
                return let(step(a["s"], x), lambda s: F.struct(s.alias("s"), F.concat(a["all"], F.array(out(s))).alias("all")))

            return F.aggregate(F.slice(items, k * RUN + 2, RUN - 1), first, add)["all"]

        found = F.flatten(F.zip_with(F.slice(begins, F.lit(1), F.size(runs)), runs, inside))
        return F.when(F.size(items) > 0, found).otherwise(F.slice(found, 1, 0))

    return let(items, over)


def tokens(text: Column) -> Column:
    """Lower-case tokens of a text in its composed form."""
    from .unicode import nfc

    return F.regexp_extract_all(F.lower(nfc(text)), F.lit(X.TOKEN), F.lit(0))


def language_hits(toks: Column) -> dict[str, Column]:
    """Number of tokens among each language's function words."""
    def hits(words: list[str]) -> Column:
        return F.size(F.filter(toks, lambda w: w.isin(*words))).cast("long")

    return {lang: hits(words) for lang, words in X.STOPWORDS.items()}


def best_language(hits: dict[str, Column]) -> Column:
    """Language with most hits, the first of equals; unknown without any."""
    top = F.greatest(*hits.values())
    out = F.when(top <= 0, F.lit("unknown"))
    for lang, n in hits.items():
        out = out.when(n == top, F.lit(lang))
    return out


def detect_language(text: Column) -> Column:
    """The language whose function words are most among the tokens; the text is split once, and counted once for each language."""

    def best(counted: Column) -> Column:
        return best_language({k: counted[k] for k in X.STOPWORDS})

    return let(tokens(text), lambda toks: let(F.struct(*[n.alias(k) for k, n in language_hits(toks).items()]), best))


def heading(names: str) -> str:
    return rf"(?dimu)^\s*({names}){NOT_WORD_AFTER}"


def document_type(text: Column, pages: Column) -> Column:
    contents = text.rlike(heading(X.CONTENTS))
    keywords = text.rlike(rf"(?diu)(?<![\p{{L}}\p{{N}}_])({X.KEYWORDS}){NOT_WORD_AFTER}")
    imrad = F.regexp_count(text, F.lit(heading(X.IMRAD)))
    return (
        F.when(contents & (pages >= X.MANUAL_MIN_PAGES), "manual")
        .when((imrad >= 2) & keywords & (pages <= X.ARTICLE_MAX_PAGES), "articulo")
        .otherwise("divulgacion")
    )


def template_of(doc_type: Column) -> Column:
    return pick(X.TEMPLATE_OF, doc_type)


def source_kind(chars: Column, pages: Column, threshold: int = X.NATIVE_CHARS_PER_PAGE) -> Column:
    return F.when(pages <= 0, "escaneado").when(F.try_divide(chars, pages) >= threshold, "nativo").otherwise("escaneado")


def route_pages(page_chars: Column, threshold: int = X.NATIVE_CHARS_PER_PAGE) -> Column:
    return F.transform(page_chars, lambda n: F.when(n >= threshold, "nativo").otherwise("ocr"))


def combined_source(decisions: Column) -> Column:
    return (
        F.when(F.forall(decisions, lambda d: d == "ocr"), "escaneado").when(F.forall(decisions, lambda d: d == "nativo"), "nativo").otherwise("mixto")
    )


def native_pages(text: Column, pages: Column) -> Column:
    """Pages of a text cut at form feeds, padded with empty ones or cut to the page count."""
    parts = F.split(text, "\f", -1)
    return F.slice(F.concat(parts, F.array_repeat(F.lit(""), F.greatest(pages - F.size(parts), F.lit(0)))), 1, F.greatest(pages, F.lit(0)))


def page_chars(page: Column) -> Column:
    return F.length(F.translate(page, " \n", ""))


def route_ocr(conf: Column, words: Column) -> Column:
    return F.when((conf >= X.OCR_MIN_CONF) & (words >= X.OCR_MIN_WORDS), "tesseract").otherwise("vlm")


def dehyphenate(text: Column) -> Column:
    """Join words cut at line ends; the hyphen stays before a capital or a digit."""
    joined = F.regexp_replace(text, r"(?U)(\w)-\n\s*([a-záàâãéêíóôõúüçñèìòù])", "$1$2")
    return F.regexp_replace(joined, r"(?U)(\w)-\n\s*([A-ZÁÀÂÃÉÊÍÓÔÕÚÜÇÑ0-9])", "$1-$2")


def edge_form(line: Column) -> Column:
    """A line as compared between pages: no digits or blanks at its ends, one space inside, lower case."""
    bare = F.regexp_replace(line, r"(?U)^[\s\d]+|[\s\d]+$", "")
    return F.lower(F.regexp_replace(bare, r"(?U)\s+", " "))


def inferred_pages(text: Column) -> Column:
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(MARKER)))


def garbage_ratio(text: Column) -> Column:
    """Share of characters that do not belong in a legible transcript."""
    bare = F.regexp_replace(text, MARKER, "")
    odd = F.length(F.regexp_replace(bare, f"[{X.LEGIBLE}]", ""))
    return F.when(F.length(strip(bare)) == 0, F.lit(0.0)).otherwise(F.try_divide(odd.cast("double"), F.length(bare)))


def split_names(raw: Column) -> Column:
    """Names between ; / and the words y, e, and."""
    parts = F.split(raw, r"(?U)\s*(?:;|/|\by\b|\be\b|\band\b)\s*", -1)
    return F.filter(F.transform(parts, lambda p: F.btrim(p, F.lit(" .,"))), lambda p: p != "")


def year(raw: Column) -> Column:
    return F.regexp_extract(raw, r"\b(1[5-9]\d{2}|20\d{2})\b", 1)


def bullet_terms(raw: Column) -> Column:
    """Terms, one a line, without bullets."""
    lines = F.transform(F.split(raw, r"\r\n|\n|\r", -1), lambda x: F.btrim(F.regexp_replace(strip(x), r"^[-•*]+", ""), F.lit(" .,")))
    return F.filter(lines, lambda x: x != "")


def candidate_terms(raw: Column) -> Column:
    """Terms between commas or semicolons."""
    return F.filter(F.transform(F.split(raw, "[;,]", -1), lambda x: F.btrim(x, F.lit(" .;"))), lambda x: x != "")


def strip_think(raw: Column) -> Column:
    return F.regexp_replace(raw, r"(?s)<think>.*?</think>", "")


def safe_stem(name: Column) -> Column:
    """File name as an id part: other signs than letters, digits, _ and - become _, at most 40 characters."""
    clean = F.substring(F.btrim(F.regexp_replace(name, "[^A-Za-z0-9_-]+", "_"), F.lit("_")), 1, 40)
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("doc"))


def content_id(payload: Column) -> Column:
    return F.substring(F.sha2(payload, 256), 1, 12)


def job_key(doc_id: Column, payload: Column) -> Column:
    return F.concat_ws(":", doc_id, content_id(payload))


def valid_id(doc_id: Column) -> Column:
    """Whether an id may name a file: not blank, no dots alone, separators (plain or encoded) or control characters."""
    return (
        (F.length(strip(doc_id)) > 0)
        & ~doc_id.isin(".", "..")
        & ~doc_id.rlike(r"[/\\\x00-\x1f\x7f]")
        & ~F.lower(doc_id).rlike("%2e|%2f|%5c")
    )


def fold(word: Column) -> Column:
    """Lower case without accents, whatever the script."""
    from .unicode import without_marks

    return without_marks(F.lower(word))


def words(text: Column) -> Column:
    """Runs of letters, numbers of any kind and _; a mark stays with its letter."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0))


def lexical_overlap(vlm: Column, base: Column) -> Column:
    """Share of the distinct base words of four letters or more that the other text has; 1 without any.

    The long text is folded as a whole: folding turns letters into letters, so its words stay the same. Each base word is folded once.
    """
    own = F.array_distinct(F.transform(F.array_distinct(F.filter(base, lambda w: F.length(w) >= X.MIN_WORD_LEN)), fold))
    seen = words(fold(vlm))
    return let(own, lambda of: F.when(F.size(of) == 0, F.lit(1.0)).otherwise(F.try_divide(F.size(F.array_intersect(of, seen)).cast("double"), F.size(of))))


def first_phrase(text: Column, phrases: tuple[str, ...]) -> Column:
    """First of the phrases, in their order, that the lower-cased text contains, whole ones not as part of longer words."""

    def said(low: Column, phrase: str) -> Column:
        there = F.contains(low, F.lit(phrase))
        return there & low.rlike(rf"(?<![\p{{L}}\p{{M}}\p{{N}}_]){phrase}(?![\p{{L}}\p{{M}}\p{{N}}_])") if phrase in X.WHOLE_PHRASES else there

    return let(F.lower(text), lambda low: F.coalesce(*[F.when(said(low, p), F.lit(p)) for p in phrases]))


def verify_vlm(vlm: Column, base: Column, pack: Column, overlap: Column | None = None) -> Column:
    """Reason to reject a vision model's transcription, null if it is accepted; ``overlap`` is its lexical overlap where a column has it."""
    useful = F.size(F.filter(base, lambda w: F.length(w) >= X.MIN_WORD_LEN))
    allowed = F.filter(F.transform(F.split(pack, r"\+"), lambda p: pick(X.PACK_LANGS, p)), lambda p: p.isNotNull())

    def alien(text: Column) -> Column:
        outside = lambda found: F.when((found != "unknown") & ~F.array_contains(allowed, found), F.concat(F.lit("idioma '"), found, F.lit("' fuera del pack")))
        return F.when((F.size(allowed) > 0) & (F.size(words(text)) >= X.LANG_MIN_TOKENS), let(detect_language(text), outside))

    def judged(text: Column) -> Column:
        share = lexical_overlap(text, base) if overlap is None else overlap
        said = let(first_phrase(text, X.CHATTER), lambda phrase: F.when(phrase.isNotNull(), F.concat(F.lit("chachara: '"), phrase, F.lit("'"))))
        little = let(share, lambda x: F.when((useful >= X.MIN_BASE_WORDS) & (x < X.OVERLAP_MIN), F.format_string("solape lexico %.2f < 0.3", x)))
        grown = F.when((F.length(text) > X.EXPLOSION_CHARS) & (useful < X.EXPLOSION_MAX_BASE), F.lit("explosion de longitud sin base"))
        # each test is made only where those before it found nothing
        return F.when(text == "", F.lit("vacio")).otherwise(F.coalesce(said, little, alien(text), grown))

    return let(strip(F.coalesce(vlm, F.lit(""))), judged)
