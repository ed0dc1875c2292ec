"""Inputs derived from the driver's tables by SQL that Spark and DuckDB read alike."""

NL = "chr(10)"
#: A text with article or manual headings on some rows, and a page count.
STRUCTURED = f"""CASE WHEN doc_id % 5 = 0 THEN 'RESUMO' || {NL} || substr(text, 1, 600) || {NL} || 'Palavras-chave: a; b' || {NL} || 'ABSTRACT' || {NL}
 || substr(text, 601, 600) || {NL} || 'Keywords: c' || {NL} || 'Conclusiones' || {NL} || substr(text, 1201)
 WHEN doc_id % 5 = 1 THEN 'SUMÁRIO' || {NL} || substr(text, 1, 400) || {NL} || 'PREFÁCIO' || {NL} || substr(text, 401) ELSE text END"""
PAGES = "CAST(1 + doc_id % 20 AS INT)"
#: Form-feed pages (one a line) with a repeated header and a page number line.
PAGED = f"replace('Boletim ' || source || {NL} || text || {NL} || '7', {NL} || '', chr(12) || 'Boletim ' || source || {NL})"
HYPHENED = f"replace(replace(text, 'tion', 'ti-' || {NL} || 'on'), ' The', '-' || {NL} || 'The')"
CHAPTERED = f"'Prefacio ' || {NL} || replace(text, {NL}, {NL} || 'Capítulo' || {NL} || {NL} || '3' || {NL} || 'TITULO' || {NL})"
TYPE = "CASE WHEN doc_id % 3 = 0 THEN 'articulo' WHEN doc_id % 3 = 1 THEN 'manual' ELSE 'divulgacion' END"
