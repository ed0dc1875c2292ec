"""Registered queries and their SQL."""

from . import documents, images, operations

QUERIES = documents.QUERIES | operations.QUERIES | images.QUERIES
ORACLE_SQL = documents.ORACLE_SQL | operations.ORACLE_SQL | images.ORACLE_SQL
