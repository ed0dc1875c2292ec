"""Normal forms and folding against Python's own, over all of Unicode."""

import random
import sys
import unicodedata

from pyspark.sql import functions as F

from docmill.functions import text as T
from docmill.functions.unicode import nfc, nfd, without_marks


def check(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(8)
    got = {r.k: r for r in df.select("k", nfc(F.col("t")).alias("c"), nfd(F.col("t")).alias("d"), without_marks(F.col("t")).alias("f")).collect()}
    bare = lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.c, r.d, r.f) == ((unicodedata.normalize("NFC", t), unicodedata.normalize("NFD", t), bare(t)) if t is not None else (None,) * 3), ascii(t)


def test_every_code_point_that_a_form_changes(spark):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    some = [c for c in points if unicodedata.normalize("NFD", c) != c or unicodedata.normalize("NFC", c) != c or unicodedata.combining(c)]
    hangul = [c for c in some if "가" <= c <= "힣"]
    rest = [c for c in some if not "가" <= c <= "힣"]
    check(spark, [f"a{c}b{unicodedata.normalize('NFD', c)}" for c in rest] + [f"{c}{unicodedata.normalize('NFD', c)}́" for c in hangul[::9] + hangul[:60]])


def test_random_clusters(spark):
    r = random.Random(1)
    firsts = "aeiouAEnNsS ǖṩक़েெᄀ가각ೆେᬅ\U0001d15e\U00011131יִཱ̈́Ω"
    marks = "̸़ִ̧̛̣̱̀́̈̄̇ͅাாᅡᆨೕೂୗᬵ゙ཱིི\U0001d165\U0001d16e\U00011127"
    texts = ["".join(r.choice(firsts if r.random() < 0.45 else marks) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    check(spark, [*texts, None, "", "plain", "é" * 20_000, "a" + "̣́" * 1500, "́" * 3000])


def test_language_and_overlap_of_decomposed_texts(spark):
    text = "El niño está en la canción, más allá; el corazón también. Ὀδυσσεύς Łódź ő ș ā ž"
    rows = [("c", text), ("d", unicodedata.normalize("NFD", text))]
    df = spark.createDataFrame(rows, "k string, t string")
    got = {r.k: (r.toks, r.folded, r.same) for r in df.select("k", T.tokens(F.col("t")).alias("toks"), T.fold(F.col("t")).alias("folded"), T.lexical_overlap(F.col("t"), T.words(F.lit(text))).alias("same")).collect()}
    assert got["c"] == got["d"] and "está" in got["d"][0] and got["d"][2] == 1.0
    assert got["c"][1].endswith("οδυσσευς łodz o s a z")
