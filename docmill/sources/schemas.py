"""Explicit schemas of the files that are read; nothing is inferred."""

ABSTRACT = "struct<lang:string,header:string,text:string,keywords:string>"
SUMMARY = (
    "contract_version string, doc_id string, idioma_principal string, tipo_documento string, plantilla string, secciones map<string,string>, "
    f"idiomas_resumo_origem array<string>, abstracts_origem array<{ABSTRACT}>, meta map<string,string>"
)
CONTROL_CASE = "doc_id string, expected_lang string, expected_type string, expected_terms array<string>"
PAGE_DETAIL = (
    "struct<page:int,source:string,conf:double,words:int,chars:int,deskew_angle:double,non_text_regions:int,vlm_rejected:boolean,vlm_motivo:string>"
)
OCR_META = (
    "meta_version string, ocr_pipeline_version string, doc_id string, pdf_sha256 string, pages int, source_kind string, lang_ocr string, legacy boolean, "
    f"pages_detail array<{PAGE_DETAIL}>, quality struct<paginas_vlm:int,paginas_vacias:int,paginas_vlm_rechazado:int,conf_media:double>"
)
EVENT = "timestamp timestamp, run_id string, event string, doc_id string, phase string, seconds double"
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
