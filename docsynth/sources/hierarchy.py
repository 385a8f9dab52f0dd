"""Hierarchy files: statement -> section -> list of items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NESTED = "statement_no BIGINT, statement STRING, sections ARRAY<STRUCT<section: STRING, items: ARRAY<STRING>>>"


def read_hierarchy(spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
    """One row per item; a section without items keeps one row with a null item. ``only`` keeps statements that
    hold that text in their name. The file is a short configuration read on the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        content = yaml.safe_load(f)
    rows = [(i, name, [(s, list(items or [])) for s, items in (sections or {}).items()]) for i, (name, sections) in enumerate(content.items())]
    return explode_hierarchy(spark.createDataFrame(rows, NESTED), only)


def explode_hierarchy(nested: DataFrame, only: str | None = None) -> DataFrame:
    if only is not None:
        nested = nested.where(F.contains("statement", F.lit(only)))
    sections = nested.select("statement_no", "statement", F.posexplode("sections").alias("section_no", "s"))
    return sections.select(
        "statement_no", "statement", "section_no", "s.section", F.posexplode_outer("s.items").alias("item_no", "item")
    )
