"""Records about transcripts: the OCR metadata of new ones and of those cached before there was any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import inferred_pages
from .reports import ocr_quality


def ocr_meta(transcripts: DataFrame, pages: DataFrame, lang: str) -> DataFrame:
    """Metadata of transcripts (doc_id, pdf_sha256, source_kind) with the quality of their pages (doc_id, page, source, conf, words, chars, vlm_rejected)."""
    quality = ocr_quality(pages, "doc_id").join(pages.groupBy("doc_id").agg(F.count("*").cast("int").alias("pages")), "doc_id")
    return transcripts.join(quality, "doc_id", "left").select(
        F.lit(X.META_VERSION).alias("meta_version"), F.lit(X.PIPELINE_VERSION).alias("pipeline_version"), F.lit(False).alias("legacy"), "doc_id", "pdf_sha256",
        F.coalesce("pages", F.lit(0)).alias("pages"), "source_kind", F.lit(lang).alias("lang_ocr"),
        "paginas_vlm", "paginas_vacias", "paginas_vlm_rechazado", "conf_media",
    )


def legacy_meta(transcripts: DataFrame) -> DataFrame:
    """Metadata of cached transcripts (doc_id, pdf_sha256, text) that have none: pages come from the markers, quality is unknown."""
    none = [F.lit(None).cast("bigint").alias(c) for c in ("paginas_vlm", "paginas_vacias", "paginas_vlm_rechazado")]
    return transcripts.select(
        F.lit(X.META_VERSION).alias("meta_version"), F.lit(None).cast("string").alias("pipeline_version"), F.lit(True).alias("legacy"), "doc_id", "pdf_sha256",
        inferred_pages(F.coalesce("text", F.lit(""))).cast("int").alias("pages"), F.lit("cached").alias("source_kind"), F.lit(None).cast("string").alias("lang_ocr"),
        *none, F.lit(None).cast("double").alias("conf_media"),
    )
