"""Hand-made cases for column functions."""

from pyspark.sql import functions as F

from docmill.functions import structure as S
from docmill.functions import text as T
from docmill.operators import gates, pages, regions, sections


def one(spark, expr, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(expr.alias("x")).first()["x"]


def test_language(spark):
    assert one(spark, T.detect_language(F.col("t")), t="the results of this study") == "en"
    assert one(spark, T.detect_language(F.col("t")), t="não é para você") == "pt"
    assert one(spark, T.detect_language(F.col("t")), t="") == "unknown"


def test_document_type(spark):
    article = "RESUMO\nx\nABSTRACT\ny\nKeywords: z"
    assert one(spark, T.document_type(F.col("t"), F.lit(3)), t=article) == "articulo"
    assert one(spark, T.document_type(F.col("t"), F.lit(20)), t="SUMÁRIO\nmétodos") == "manual"
    assert one(spark, T.document_type(F.col("t"), F.lit(1)), t="folleto") == "divulgacion"


def test_sources(spark):
    kinds = [one(spark, T.source_kind(F.lit(a), F.lit(b), c), t=1) for a, b, c in ((500, 3, 100), (50, 3, 100), (0, 0, 100), (90, 1, 80))]
    assert kinds == ["nativo", "escaneado", "escaneado", "nativo"]
    assert one(spark, T.combined_source(T.route_pages(F.array(F.lit(5), F.lit(500)))), t=1) == "mixto"


def test_dehyphenate(spark):
    assert one(spark, T.dehyphenate(F.col("t")), t="informa-\nción Guinea-\nBissau") == "información Guinea-Bissau"


def test_clean_text_drops_headers_and_numbers(spark):
    text = "\f".join(f"Boletim {k}\nbody {chr(97 + k)}\nmore\nlast {chr(97 + k)}\nlonger text here\nx{chr(97 + k)}\n{k}" for k in range(5))
    cleaned = pages.clean_text(spark.createDataFrame([(1, text)], "id int, text string"), "id").first()["cleaned"]
    assert "Boletim" not in cleaned and "body c" in cleaned and not cleaned.endswith("4")


def test_blocks_cover_and_never_repeat(spark):
    for text, size in (("a\n\ncdefghij", 4), ("para one\n\npara two\n\n" + "x" * 50, 12), ("", 5), ("short", 10)):
        got = one(spark, S.blocks(F.col("t"), size), t=text)
        assert all(0 < len(b) <= size for b in got)
        assert "".join("".join(got).split()) == "".join(text.split())


def test_abstracts(spark):
    body = "palabra larga " * 6
    text = f"RESUMO\n{body}\nPalavras-chave: a; b\n\nABSTRACT: {body}\nRESUMEN\ncorto"
    got = one(spark, S.abstracts(F.col("t")), t=text)
    assert [(a["lang"], a["keywords"]) for a in got] == [("pt", "a; b"), ("en", "")]


def test_excerpt_stays_in_budget(spark):
    text = "ABSTRACT\n" + "a " * 300 + "\nINTRODUCTION\n" + "b " * 900 + "\nCONCLUSIONS\n" + "c " * 300
    got = one(spark, S.excerpt(F.col("t"), F.lit("articulo"), 1000), t=text)
    assert got["parts"] == ["abstract", "introducao", "conclusao"] and len(got["text"]) <= 1000 and got["truncated"]
    got = one(spark, S.excerpt(F.col("t"), F.lit("manual"), 1000), t=text)
    assert got["parts"][0] == "portada" and len(got["text"]) <= 1000


def test_chapters(spark):
    text = "prologo " + "".join(f"\nCapítulo\n\n{k}\n\nTITULO {k}\n" + "cuerpo " * 20 for k in (1, 2, 3))
    got = one(spark, S.chapters(F.col("t")), t=text)
    assert [c["number"] for c in got] == ["1", "2", "3"]
    assert one(spark, S.chapters(F.col("t")), t="x" * 200) == []


def test_vlm(spark):
    base = F.array(*[F.lit(w) for w in "salud pública enfermedad hospital médico".split()])
    reason = lambda t: one(spark, T.verify_vlm(F.col("t"), base, F.lit("por+eng+spa")), t=t)
    assert reason("  ") == "vacio"
    assert reason("The image shows a page").startswith("chachara")
    assert reason("nothing in common at all here").startswith("solape")
    assert reason("SALUD publica enfermedad del hospital y medico") is None


def test_ids(spark):
    assert one(spark, T.safe_stem(F.col("t")), t="../a b.pdf") == "a_b_pdf"
    assert one(spark, T.safe_stem(F.col("t")), t="///") == "doc"
    for bad in (" ", "..", "a/b", "a%2Fb", "a\x00b"):
        assert one(spark, T.valid_id(F.col("t")), t=bad) is False


def test_gates(spark):
    noise = "¤¤¤¤ " * 50
    got = one(spark, gates.transcript_gates(F.col("t")), t=noise)
    assert [g["gate"] for g in got] == ["garbage", "stopword_ratio"]
    meta = F.struct(
        F.array(*[F.struct(F.lit(k).alias("page"), F.lit(0 if k < 2 else 9).alias("chars"), F.lit(k == 1).alias("vlm_rejected")) for k in range(4)]).alias("pages_detail"),
        F.lit(41.5).alias("conf_media"),
        F.lit(1).alias("vlm_rejected"),
        F.lit(True).alias("legacy"),
    )
    got = one(spark, gates.transcript_gates(F.col("t"), meta), t="ok")
    assert [(g["gate"], g["severity"]) for g in got] == [("paginas", "error"), ("conf_baja", "warning"), ("vlm_rechazado", "warning"), ("legacy_cache", "warning")]


def test_reading_order(spark):
    rows = [(1, 400, 0, 500, 50), (1, 10, 100, 90, 200), (1, 0, 0, 90, 50), (1, 415, 60, 500, 90)]
    got = regions.reading_order(spark.createDataFrame(rows, "page int, left int, top int, right int, bottom int"), "page").first()["regions"]
    assert [(r["left"], r["top"]) for r in got] == [(0, 0), (10, 100), (400, 0), (415, 60)]


def test_sections(spark):
    md = "intro\n## Título\nuno\n## publico\ndos\n## Nuevo\ntres"
    df = spark.createDataFrame([(1, md, "C", "es")], "id int, md string, template string, lang string")
    got = {r["section"]: r["content"] for r in sections.parse_sections(df, "id", "md", "template", "lang").collect()}
    assert got == {"titulo": "uno", "publico": "dos", "Nuevo": "tres"}


def test_excerpts_of_long_documents(spark):
    article = "RESUMO\n" + "o estudo mede algo. " * 90 + "\n\nINTRODUÇÃO\n" + "o problema nasce aqui. " * 90 + "\n\nMÉTODOS\n" + "medida " * 900 + "\n\nCONCLUSÕES\n" + "a técnica serve. " * 90
    manual = "Secretaria - guia\n\nAPRESENTAÇÃO\n" + "este guia orienta. " * 80 + "\n\nSUMÁRIO\n1. Um\n2. Dois\n\nINTRODUÇÃO\n" + "o contexto pede regras. " * 80 + "\n\n" + "corpo do guia " * 3000
    for text, kind in ((article, "articulo"), (manual, "manual"), ("folheto curto. " * 9, "divulgacion")):
        got = one(spark, S.excerpt(F.col("t"), F.lit(kind), 3000), t=text)
        assert len(got["text"]) <= 3000 and got["truncated"] == (len(text) > 3000)
        if kind == "articulo":
            assert got["parts"] == ["abstract", "introducao", "conclusao"] and got["text"].count("medida") < 30 and "a técnica serve" in got["text"]
        elif kind == "manual":
            assert got["parts"][:2] == ["portada", "apresentacao"] and got["text"] != text[:3000] and "SUMÁRIO" in got["text"]
        else:
            assert (got["strategy"], got["parts"]) == ("full", ["completo"])
    names = {s["name"] for s in one(spark, S.sections(F.col("t")), t=manual)}
    assert {"apresentacao", "sumario", "introducao"} <= names


def test_abstracts_in_three_languages(spark):
    text = (
        "\nRESUMO: A mudança do cuidado abriu serviços novos e mais próximos das pessoas na cidade.\nPalavras-chave: Saúde. Cidade.\n"
        "ABSTRACT: The change of care opened services that are new and nearer to people in town.\nKeywords: Health. Town.\n"
        "RESUMEN: El cambio del cuidado abrió servicios nuevos y más cercanos a las personas.\n"
    )
    got = one(spark, S.abstracts(F.col("t")), t=text)
    assert [(a["lang"], a["keywords"]) for a in got] == [("pt", "Saúde. Cidade."), ("en", "Health. Town."), ("es", "")]
    assert got[0]["text"].startswith("A mudança do cuidado") and got[1]["text"].endswith("people in town.")
    assert one(spark, S.abstracts(F.col("t")), t="Fume menos. Ligue já.") == []


def test_cleaning_keeps_pages_and_order(spark):
    pages_of = lambda n, sep: sep.join(f"Cabeçalho {k}\n\nlinha {chr(97 + k)}1\nlinha {chr(97 + k)}2\nmeio\nlinha {chr(97 + k)}3\nfim {chr(97 + k)}\nRodapé\n{k}" for k in range(n))
    docs = spark.createDataFrame([(1, pages_of(4, "\f")), (2, pages_of(2, "\f")), (3, "sem páginas\nRodapé"), (4, None), (5, ""), (6, "\n".join(f"=== pág {k} ===\nTopo\ncorpo {chr(97 + k)}\nfim" for k in range(1, 4)))], "id int, text string")
    got = {r.id: r.cleaned for r in pages.clean_text(docs, "id").collect()}
    assert "Cabeçalho" not in got[1] and "Rodapé" not in got[1] and got[1].count("\f") == 3 and got[1].index("linha a1") < got[1].index("linha d3") and got[1].count("meio") == 4
    assert got[2].count("Cabeçalho") == 2 and "\n1" not in got[2]
    assert (got[3], got[4], got[5]) == ("sem páginas\nRodapé", None, "")
    assert "=== pág 2 ===" in got[6] and "Topo" not in got[6] and "corpo b" in got[6]
    plan = pages.clean_text(docs, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    forms = {(r.form, r.n) for r in pages.repeated_edges(docs, "id").filter("id = 1").collect()}
    assert ("cabeçalho", 4) in forms and ("rodapé", 4) in forms


def test_last_block_of_a_section_stays(spark):
    md = "x\n## Title\none\r\n##   Title\ntwo\n##\tOther thing\n\n three \n##no\nfour"
    got = sections.parse_sections(spark.createDataFrame([(1, md, "A", "en"), (2, None, "A", "en"), (3, "none", "A", "en")], "id int, md string, template string, lang string"), "id", "md", "template", "lang")
    assert {(r.id, r.section): r.content for r in got.collect()} == {(1, "titulo"): "two", (1, "Other thing"): "three \n##no\nfour"}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
