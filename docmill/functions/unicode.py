"""Unicode normal forms and accent folding as column functions, without a Python worker.

The tables follow from the rules of the Unicode character database that Python carries. A table that turns one code point into another is a
``translate``, which looks each code point up; a decomposition is up to four of them, one for each of its code points, and compositions
are one for each second code point. Hangul is computed. Only clusters, a code point and what may combine with it, are taken
apart, and only in texts that hold a code point which a normal form may change; all other texts pass through a single search.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, scan

#: Hangul: first code points of leads, vowels, tails (before the first) and syllables; numbers of vowels and of tails with none.
L, V, T, S, NV, NT = 0x1100, 0x1161, 0x11A7, 0xAC00, 21, 28
NL = 19


def _class(points: Iterable[int]) -> str:
    """A regular expression's class of code points, as ranges; those below the first are sorted out by one comparison."""
    runs: list[list[int]] = []
    for c in sorted(points):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    ranges = "".join(rf"\x{{{a:X}}}" + (rf"-\x{{{b:X}}}" if b > a else "") for a, b in runs)
    return rf"[\x{{{runs[0][0]:X}}}-\x{{10FFFF}}&&[{ranges}]]"


class Tables:
    """What the columns below need, worked out once in a process."""

    def __init__(self) -> None:
        points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
        self.ccc = {c: k for c in points if (k := unicodedata.combining(chr(c)))}
        hangul = range(S, S + NL * NV * NT)
        self.nfd = {c: d for c in points if c not in hangul and (d := unicodedata.normalize("NFD", chr(c))) != chr(c)}
        # second code point: {first: composed}
        self.pairs: dict[int, dict[int, int]] = {}
        for c in self.nfd:
            parts = unicodedata.decomposition(chr(c)).split()
            if len(parts) == 2 and unicodedata.normalize("NFC", chr(c)) == chr(c):
                a, b = (int(x, 16) for x in parts)
                self.pairs.setdefault(b, {})[a] = c
        seconds = {*self.ccc, *self.pairs, *range(V, V + NV), *range(T + 1, T + NT)}
        seconds |= {c for c, d in self.nfd.items() if ord(d[0]) in seconds}
        broken = {c for c in self.nfd if unicodedata.normalize("NFC", chr(c)) != chr(c)}
        self.unsure, self.cluster = _class(seconds | broken), f"(?s).{_class(seconds)}+|{_class(broken)}"
        self.changed = _class({*self.nfd, *self.ccc, *hangul})  # what a decomposition may change or move
        self.apart = f"(?s).{_class(seconds)}+|{_class({*self.nfd, *hangul})}"
        # folding: one code point for one, marks for none; the others are taken apart
        bare = {c: "".join(x for x in d if not unicodedata.combining(x)) for c, d in self.nfd.items()}
        self.fold_from = "".join(chr(c) for c, b in bare.items() if len(b) == 1) + "".join(chr(c) for c, b in bare.items() if not b) + "".join(chr(c) for c in self.ccc if c not in self.nfd)
        self.fold_to = "".join(b for b in bare.values() if len(b) == 1)
        self.several = _class({*(c for c, b in bare.items() if len(b) > 1), *hangul})


@cache
def tables() -> Tables:
    return Tables()


def _code(c: Column) -> Column:
    return F.ascii(c)


def _char(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def decomposed(c: Column) -> Column:
    """The canonical decomposition of one code point."""
    t = tables()
    longest = sorted(t.nfd, key=lambda k: -len(t.nfd[k]))
    matching = "".join(map(chr, longest))
    place = lambda k: "".join(t.nfd[x][k] for x in longest if len(t.nfd[x]) > k)
    first = F.translate(c, matching, place(0))
    rest = [F.translate(c, matching, place(k)) for k in range(1, max(map(len, t.nfd.values())))]

    def syllable(n: Column) -> Column:
        tail = n % NT
        return F.concat(_char(F.lit(L) + F.floor(n / (NV * NT))), _char(F.lit(V) + F.floor(n % (NV * NT) / NT)), F.when(tail > 0, _char(F.lit(T) + tail)).otherwise(""))

    hangul = let(_code(c) - S, lambda n: F.when((n >= 0) & (n < NL * NV * NT), syllable(n)))
    return F.coalesce(hangul, F.when(first != c, F.concat(first, *rest)).otherwise(c))


def combining_class(c: Column) -> Column:
    """Canonical combining class of one code point; 0 for most."""
    t = tables()
    known = F.translate(c, "".join(map(chr, t.ccc)), "".join(chr(0x4E00 + k) for k in t.ccc.values()))
    return F.when(known != c, _code(known) - 0x4E00).otherwise(0)


def composed(a: Column, b: Column) -> Column:
    """The code point that two compose to, else null."""
    lead, mark = _code(a), _code(b)
    syllable = F.when((lead >= L) & (lead < L + NL) & (mark >= V) & (mark < V + NV), _char(F.lit(S) + ((lead - L) * NV + (mark - V)) * NT)).when(
        (lead >= S) & (lead < S + NL * NV * NT) & ((lead - S) % NT == 0) & (mark > T) & (mark < T + NT), _char(lead + mark - T)
    )
    out = F.when(F.lit(False), F.lit(""))
    for second, firsts in tables().pairs.items():
        out = out.when(b == chr(second), F.nullif(F.translate(a, "".join(map(chr, firsts)), "".join(map(chr, firsts.values()))), a))
    return F.coalesce(out, syllable)


def _ordered(cluster: Column) -> Column:
    """array<struct<ccc, c>>: the decomposed code points of a cluster, marks in canonical order behind each starter."""
    apart = F.filter(F.split(F.array_join(F.transform(F.split(cluster, ""), decomposed), ""), ""), lambda c: c != "")
    classed = F.transform(apart, lambda c, i: F.struct(i.alias("i"), combining_class(c).alias("ccc"), c.alias("c")))

    def placed(of: Column) -> Column:
        # the number of starters up to each
        after = scan(of, F.lit(0), lambda n, x: n + F.when(x["ccc"] == 0, 1).otherwise(0), lambda n: n)
        return F.array_sort(F.zip_with(of, after, lambda x, n: F.struct(n.alias("after"), x["ccc"].alias("ccc"), x["i"].alias("i"), x["c"].alias("c"))))

    many = lambda of: F.size(F.filter(of, lambda x: x["ccc"] == 0)) > 1
    one = lambda of: F.array_sort(F.transform(of, lambda x: F.struct(F.lit(0).alias("after"), x["ccc"].alias("ccc"), x["i"].alias("i"), x["c"].alias("c"))))
    begins = lambda of: F.get(of, F.lit(0))["ccc"] == 0
    return let(classed, lambda of: F.when(begins(of) & ~many(of), one(of)).otherwise(placed(of)))


def _together(ordered: Column) -> Column:
    """Ordered code points composed, each with the last starter where nothing stands between."""
    shape = "struct<done:string,starter:string,tail:string,last:int>"
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("starter"), F.lit("").alias("tail"), F.lit(0).alias("last")).cast(shape)

    def step(s: Column, x: Column) -> Column:
        free = (s["starter"] != "") & ((s["tail"] == "") | ((s["last"] < x["ccc"]) & (x["ccc"] != 0)))
        whole = F.when(free, composed(s["starter"], x["c"]))
        kept = lambda done, starter, tail, last: F.struct(done.alias("done"), starter.alias("starter"), tail.alias("tail"), last.alias("last")).cast(shape)
        return let(
            whole,
            lambda w: F.when(w.isNotNull(), kept(s["done"], w, s["tail"], s["last"]))
            .when(x["ccc"] == 0, kept(F.concat(s["done"], s["starter"], s["tail"]), x["c"], F.lit(""), F.lit(0)))
            .otherwise(kept(s["done"], s["starter"], F.concat(s["tail"], x["c"]), x["ccc"])),
        )

    return F.aggregate(ordered, start, step, lambda s: F.concat(s["done"], s["starter"], s["tail"]))


def _by_cluster(text: Column, test: str, cluster: str, each: Callable[[Column], Column]) -> Column:
    """``text`` with ``each`` of its clusters; clusters that are alike, nearly all in a text of any length, are worked out once."""

    def looked_up(found: Column) -> Column:
        known = let(F.array_distinct(found), lambda of: F.map_from_arrays(of, F.transform(of, each)))
        return let(known, lambda made: F.transform(found, lambda c: F.try_element_at(made, c)))

    found = let(F.regexp_extract_all(text, F.lit(cluster), F.lit(0)), looked_up)
    joined = F.array_join(F.zip_with(F.split(text, cluster, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(text.rlike(test), joined).otherwise(text)


def nfc(text: Column) -> Column:
    """Canonical composition; equal texts in any canonical form become the same."""
    t = tables()
    return _by_cluster(text, t.unsure, t.cluster, lambda c: _together(_ordered(c)))


def nfd(text: Column) -> Column:
    """Canonical decomposition."""
    t = tables()
    return _by_cluster(text, t.changed, t.apart, lambda c: F.array_join(F.transform(_ordered(c), lambda x: x["c"]), ""))


def without_marks(text: Column) -> Column:
    """Canonical decomposition without the code points that combine: letters of any script without their accents."""
    t = tables()
    apart = F.when(text.rlike(t.several), F.array_join(F.transform(F.split(text, ""), decomposed), "")).otherwise(text)
    return F.translate(apart, t.fold_from, t.fold_to)
