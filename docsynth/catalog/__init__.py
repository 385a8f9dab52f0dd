"""Every operator bound to the driver's tables, with the SQL that must give the same rows."""

from docsynth.catalog import annotations, corpora, pictures, products, streams, structures, tabular, texts  # noqa: F401
from docsynth.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
