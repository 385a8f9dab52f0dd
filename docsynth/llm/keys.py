"""Row numbers that every later job finds again, however the files are split by then."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.llm.arrays import fresh
from docsynth.session import materialise

#: Bits of a row's position in its file; the bits above hold the number of the file.
POSITION = 40


def numbered(docs: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """``docs``, or these columns of it, with a number for each row in the column ``key``.

    Rows of Parquet files are numbered by file and position in it. Splits, and with them
    ``monotonically_increasing_id``, change with the cores at hand, so a table that does not come straight from
    Parquet files is written once with its numbers.
    """
    kept = [F.col(f"`{c}`") for c in columns or docs.columns]
    found = from_files(docs, key, kept)
    return materialise(docs.select(*kept, F.monotonically_increasing_id().alias(key)), "numbered") if found is None else found


def from_files(docs: DataFrame, key: str, kept: list[Column]) -> DataFrame | None:
    """Numbers by file and position; None if ``docs`` is no plain scan of Parquet files or reads a file twice.

    Files are numbered in the order of their paths, one row each; the numbers are written and joined like any table, so
    its size decides how.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if plan.nodeName() != "LogicalRelation" or plan.relation().toString() != "parquet":
        return None
    meta = docs.metadataColumn("_metadata")
    path, at = meta["file_path"], meta["row_index"]
    name, number, position = (fresh(docs, c) for c in ("file_path", "file_number", "file_position"))
    files = docs.select(path.alias(name), at.alias("at")).groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"))
    numbers = materialise(files.select(name, "n", "last", (F.row_number().over(Window.orderBy(name)) - 1).cast("long").alias(number)), "files")
    if not numbers.where("n <> last + 1").isEmpty():
        return None
    rows = docs.select(*kept, path.alias(name), at.alias(position)).join(numbers.select(name, number), name, "left")
    return rows.select(*kept, F.expr(f"shiftleft(`{number}`, {POSITION}) + `{position}`").alias(key))
