"""Financial statements: section heads, numbered items, amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.functions.text import indent_item, money_text
from docsynth.operators.ordered import scan
from docsynth.rng import integer, uniform

# Note marks.
CHINESE_NUMBERS = "一二三四五六七八九十"


def report_rows(hierarchy: DataFrame) -> DataFrame:
    """Section head rows and item rows in order; ``line_no`` counts items only, heads have none."""
    heads = hierarchy.groupBy("statement_no", "section_no", "section").agg(F.lit(-1).cast("bigint").alias("item_no"))
    heads = heads.select("statement_no", "section_no", "item_no", F.col("section").alias("text"), F.lit(0).alias("is_item"))
    items = hierarchy.select("statement_no", "section_no", "item_no", F.col("item").alias("text"), F.lit(1).alias("is_item"))
    chunk = {"section": F.col("section_no"), "block": F.floor(F.col("item_no") / 4096)}
    both = heads.unionByName(items)
    numbered = scan(both, ["statement_no"], chunk, ["section_no", "item_no"], sums={"line_no": F.col("is_item").cast("bigint")})
    return numbered.withColumn("line_no", F.when(F.col("is_item") == 1, F.col("line_no")))


def amount_cell(ident: Column, salt: int, fill: float = 0.7, brace: float = 0.3) -> Column:
    """An amount, an amount in brackets, or a dash."""
    shown = F.format_number(integer(ident, salt, 1, 9999999), 0)
    return (
        F.when(uniform(ident, salt + 1) >= fill, F.lit("-"))
        .when(uniform(ident, salt + 2) < brace, F.concat(F.lit("("), shown, F.lit(")")))
        .otherwise(shown)
    )


def note_cell(ident: Column, salt: int, fill: float = 0.7) -> Column:
    mark = F.substring(F.lit(CHINESE_NUMBERS), integer(ident, salt, 1, 10).cast("int"), F.lit(1))
    return F.when(uniform(ident, salt + 1) < fill, F.concat(F.lit("("), mark, F.lit(")"))).otherwise(F.lit(" "))


def financial_statement(hierarchy: DataFrame) -> DataFrame:
    """Report body: indented item, line number, note, this and last period's amounts; heads have blanks.

    Head rows stand before their items (``item_no`` -1), so the order of a report is (section_no, item_no).
    """
    rows = report_rows(hierarchy)
    ident = F.col("section_no") * 100003 + F.col("item_no")
    item = F.col("is_item") == 1
    blank = F.lit("")
    return rows.select(
        "statement_no",
        "section_no",
        "item_no",
        F.when(item, indent_item(F.col("text"))).otherwise(F.col("text")).alias("item"),
        F.when(item, F.col("line_no").cast("string")).otherwise(blank).alias("line_no"),
        F.when(item, note_cell(ident, 100)).otherwise(blank).alias("note"),
        F.when(item, amount_cell(ident, 110)).otherwise(blank).alias("this_period"),
        F.when(item, amount_cell(ident, 120)).otherwise(blank).alias("last_period"),
    )


__all__ = ["amount_cell", "financial_statement", "money_text", "note_cell", "report_rows"]
