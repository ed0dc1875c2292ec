"""Queries over page images, which are drawn from the texts of ``documents`` where they are measured."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import images
from .documents import docs

#: Code points in a row of the drawing, half of them in each of two columns; a drawing is WIDTH pixels wide.
ROW, WIDTH = 52, 256


def _drawing(text: str | None) -> np.ndarray:
    """A text as a gray page: each code point is 4 by 8 pixels, dark unless blank.

    A row has 26 code points, a gutter of 48 pixels and 26 more; 32 white rows of pixels follow every eighth row.
    """
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = max(1, -(-len(points) // ROW))
    cells = np.full(n * ROW, 255, np.uint8)
    cells[: len(points)] = np.where((points == 32) | (points - 9 < 5), 255, 0)
    cells = cells.reshape(n, 2, ROW // 2)
    lines = np.full((n, WIDTH), 255, np.uint8)
    lines[:, : 2 * ROW], lines[:, -2 * ROW :] = cells[:, 0].repeat(4, 1), cells[:, 1].repeat(4, 1)
    whole = n // 8
    page = np.full((8 * n + 32 * whole, WIDTH), 255, np.uint8)
    page[: 96 * whole].reshape(whole, 96, WIDTH)[:, :64].reshape(whole, 8, 8, WIDTH)[:] = lines[: 8 * whole].reshape(whole, 8, 1, WIDTH)
    page[96 * whole :].reshape(-1, 8, WIDTH)[:] = lines[8 * whole :, None]
    return page


DRAWING = images.Source("text", _drawing)


def drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, width, height, pixels): the drawings as a table, for what takes pixels."""
    return images.paged(docs(spark, sf_dir, "doc_id", "text"), DRAWING, "doc_id")


def page_ink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ink): share of dark pixels of each drawn text."""
    return images.ink(docs(spark, sf_dir, "doc_id", "text"), "doc_id", source=DRAWING)


def page_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, angle): angle that levels each drawn text."""
    return images.skew(docs(spark, sf_dir, "doc_id", "text"), "doc_id", source=DRAWING)


def page_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ord, left, top, right, bottom): blocks of each drawn text in reading order."""
    found = images.regions(docs(spark, sf_dir, "doc_id", "text"), "doc_id", source=DRAWING)
    return found.select("doc_id", F.posexplode("boxes").alias("ord", "b")).select("doc_id", "ord", "b.*")


QUERIES = {f.__name__: f for f in (page_ink, page_skew, page_regions)}
ORACLE_SQL = {
    "page_ink": r"""WITH d AS (SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS dark, greatest(1, CAST(ceil(length(coalesce(text, '')) / 52.0) AS INT)) AS n FROM documents)
 SELECT doc_id, CAST(dark * 32 AS DOUBLE) / (256 * (8 * n + 32 * (n // 8))) AS ink FROM d""",
}
