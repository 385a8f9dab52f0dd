"""Rows, columns, grid and cells recovered from text boxes ``image_id, ann_id, l, t, r, b, content``.

All steps go through the chunked scans of ``ordered`` (bands of the page) and the tiles of ``spatial``. With ``whole``
they order and join the texts of a page in one task, for pages that are known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.functions.geometry import centre_inside
from docsynth.operators.ordered import islands, number_rows, scan
from docsynth.operators.spatial import cover, page_join, points_in_boxes, tile_of

BAND = 512
READING = ["t", "l", "ann_id"]


def band(c: str, size: int = BAND) -> dict[str, Column]:
    return {"band": F.floor(F.col(c) / size)}


def half(x: Column) -> Column:
    """Floor of the half."""
    return F.floor(x / 2)


def reading_order(boxes: DataFrame, name: str = "seq") -> DataFrame:
    return number_rows(boxes, ["image_id"], band("t"), READING, name)


def same_row(p: Column, q: Column) -> Column:
    return centre_inside(p["t"], p["b"], q["t"], q["b"])


def same_col(p: Column, q: Column) -> Column:
    return centre_inside(p["l"], p["r"], q["l"], q["r"])


def row_clusters(boxes: DataFrame, whole: bool = False) -> DataFrame:
    """``row_no``: same row as the previous text in reading order if either middle lies in the other's height."""
    carry = {"t": F.col("t"), "b": F.col("b")}
    return islands(boxes, ["image_id"], {} if whole else band("t"), READING, carry, same_row, "row_no")


def line_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("image_id", "row_no").agg(F.count(F.lit(1)).alias("n"))


def column_count(sizes: DataFrame) -> DataFrame:
    """Largest number of texts in a row that more than two rows have."""
    often = sizes.groupBy("image_id", "n").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 2)
    return often.groupBy("image_id").agg(F.max("n").alias("cols_max"))


def normal_rows(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Texts of the rows that have the full number of columns."""
    if whole:
        page = Window.partitionBy("image_id")
        sized = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("image_id", "row_no")))
        # As many texts as rows of that size times the size.
        often = F.count(F.lit(1)).over(Window.partitionBy("image_id", "__n")) > 2 * F.col("__n")
        most = F.max(F.when(F.col("__often"), F.col("__n"))).over(page)
        return sized.withColumn("__often", often).withColumn("__most", most).where("__n = __most").drop("__n", "__often", "__most")
    return rows.join(full_rows(line_sizes(rows)), ["image_id", "row_no"], "left_semi")


def full_rows(sizes: DataFrame, whole: bool = False) -> DataFrame:
    if whole:
        return sizes.join(column_count(sizes), "image_id").where("n = cols_max").select("image_id", "row_no")
    most = column_count(sizes).withColumnRenamed("cols_max", "n")
    return sizes.join(most, ["image_id", "n"]).select("image_id", "row_no")


def column_clusters(texts: DataFrame, whole: bool = False) -> DataFrame:
    """``col_no`` by the row rule turned sideways, after sorting by the left edge."""
    carry = {"l": F.col("l"), "r": F.col("r")}
    return islands(texts, ["image_id"], {} if whole else band("l"), ["l", "t", "ann_id"], carry, same_col, "col_no")


def bounding_union(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))


def page_edges(boxes: DataFrame) -> DataFrame:
    return boxes.groupBy("image_id").agg(F.min("l").alias("left_min"), F.max("r").alias("right_max"))


def row_extents(rows: DataFrame) -> DataFrame:
    """Box of each row: top of its first text, greatest text height, stretched to the page's text edges."""
    first = F.min_by("t", F.struct(*READING))
    per_row = rows.groupBy("image_id", "row_no").agg(first.alias("t"), F.max(F.col("b") - F.col("t")).alias("h"))
    return per_row.join(page_edges(rows), "image_id").select(
        "image_id",
        "row_no",
        F.col("left_min").alias("l"),
        "t",
        F.col("right_max").alias("r"),
        (F.col("t") + F.col("h")).alias("b"),
    )


def column_padding(cols: DataFrame, edges: DataFrame, whole: bool = False) -> DataFrame:
    """Columns grow to half the gap on both sides and to the page edges at the ends.

    If the second column has less room on its right than on its left, its left growth is cut to that and the first
    column gets the difference.
    """
    group, chunk, order = ["image_id"], {} if whole else {"block": F.floor(F.col("col_no") / 256)}, ["col_no"]
    near = scan(cols, group, chunk, order, prev={"pr": F.col("r")}, next={"nl": F.col("l")}).join(edges, "image_id")
    lp = F.when(F.col("pr").isNull(), F.col("l") - F.col("left_min")).otherwise(half(F.col("l") - F.col("pr")))
    rp = F.when(F.col("nl").isNull(), F.col("right_max") - F.col("r")).otherwise(half(F.col("nl") - F.col("r")))
    padded = near.withColumns({"lp": lp, "rp": rp, "first": F.col("pr").isNull()})
    linked = scan(
        padded,
        group,
        chunk,
        order,
        prev={"p_first": F.col("first")},
        next={"n_lp": F.col("lp"), "n_rp": F.col("rp")},
    )
    second = F.coalesce(F.col("p_first"), F.lit(False))
    left = F.when(second, F.least("lp", "rp")).otherwise(F.col("lp"))
    moved = F.coalesce(F.greatest(F.col("n_lp") - F.col("n_rp"), F.lit(0)), F.lit(0))
    right = F.col("rp") + F.when(F.col("first"), moved).otherwise(0)
    return linked.select(
        "image_id", "col_no", (F.col("l") - left).alias("l"), "t", (F.col("r") + right).alias("r"), "b"
    )


def hidden_rows(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Rows to insert where the gap to the next row exceeds the mean height: that high, centred in the gap."""
    mean = rows.groupBy("image_id").agg(
        F.floor(F.sum(F.col("b") - F.col("t")) / F.count(F.lit(1))).alias("avg_h")
    )
    chunk = {} if whole else {"block": F.floor(F.col("row_no") / 256)}
    near = scan(rows, ["image_id"], chunk, ["row_no"], prev={"pb": F.col("b")})
    gap = near.join(mean, "image_id").where(F.col("t") - F.col("pb") > F.col("avg_h"))
    top = half(F.col("pb") + F.col("t")) - half(F.col("avg_h"))
    return gap.select("image_id", "row_no", "l", top.alias("t"), "r", (top + F.col("avg_h")).alias("b"))


def add_rows(rows: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows and inserted rows with ``inserted`` and a list position: given rows first, then the inserted ones."""
    return rows.withColumn("inserted", F.lit(0)).unionByName(extra.withColumn("inserted", F.lit(1)))


def trim_rows(df: DataFrame, group: list[str], chunk: dict[str, Column], order: list[str], start: int, end: int) -> DataFrame:
    """Drop the first ``start`` and the last ``end`` rows of every group."""
    placed = number_rows(df, group, chunk, order, "__rn")
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    keep = (F.col("__rn") > start) & (F.col("__rn") <= F.col("__n") - end)
    return placed.join(sizes, group).where(keep).drop("__rn", "__n")


def row_heights(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Half-gap padding above and below, then every row but the last reaches to the next one. Adds ``seq``."""
    group, chunk, order = ["image_id"], {} if whole else band("t"), ["t", "inserted", "row_no"]
    near = scan(
        rows, group, chunk, order, prev={"pb": F.col("b")}, next={"nt": F.col("t")}, sums={"seq": F.lit(1).cast("bigint")}
    )
    above, below = half(F.col("t") - F.col("pb")), half(F.col("nt") - F.col("b"))
    padded = near.withColumns(
        {
            "nt2": F.col("t") - F.coalesce(above, below, F.lit(0)),
            "nb2": F.col("b") + F.coalesce(below, above, F.lit(0)),
        }
    ).select("image_id", "seq", "l", "r", F.col("nt2").alias("t"), F.col("nb2").alias("b"))
    linked = scan(padded, ["image_id"], {} if whole else {"block": F.floor(F.col("seq") / 256)}, ["seq"], next={"below": F.col("t")})
    return linked.select("image_id", "seq", "l", "t", "r", F.coalesce("below", "b").alias("b"))


def grid_cells(rows: DataFrame, cols: DataFrame) -> DataFrame:
    """Every row with every column of its image: as many cells as the page has, which is the result asked for."""
    r = rows.select("image_id", F.col("row_no"), "t", "b")
    c = cols.select("image_id", F.col("col_no"), "l", "r")
    return r.join(c, "image_id")


def assign_text_to_cell(texts: DataFrame, cells: DataFrame, whole: bool = False) -> DataFrame:
    """First cell in row-major order whose closed box holds the text's middle."""
    points = texts.select(
        "image_id", "ann_id", "content", half(F.col("l") + F.col("r")).alias("x"), half(F.col("t") + F.col("b")).alias("y")
    )
    if whole:
        held = F.col("x").between(F.col("l"), F.col("r")) & F.col("y").between(F.col("t"), F.col("b"))
        hits = points.join(cells, "image_id").where(held)
    else:
        hits = points_in_boxes(points, "x", "y", cells, ["image_id"])
    return hits.groupBy("image_id", "ann_id", "content").agg(F.min(F.struct("row_no", "col_no")).alias("cell")).select(
        "image_id", "ann_id", "content", "cell.*"
    )


def texts_outside_cells(texts: DataFrame, cells: DataFrame, whole: bool = False) -> DataFrame:
    if whole:
        return page_join(texts, assign_text_to_cell(texts, cells, whole), ["ann_id"], "left_anti")
    return texts.join(assign_text_to_cell(texts, cells), ["image_id", "ann_id"], "left_anti")


def cells_in_tables(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """Every table box that contains a cell; candidates meet on the tile of the cell's corner."""
    near = cells.withColumns({"tx": tile_of(F.col("l")), "ty": tile_of(F.col("t"))})
    wide = cover(tables, "l", "t", "r", "b").select(
        "image_id", "table_no", "tx", "ty", *[F.col(k).alias(f"t_{k}") for k in "ltrb"]
    )
    held = (
        (F.col("l") >= F.col("t_l")) & (F.col("t") >= F.col("t_t")) & (F.col("r") <= F.col("t_r")) & (F.col("b") <= F.col("t_b"))
    )
    return near.join(wide, ["image_id", "tx", "ty"]).where(held).drop("tx", "ty", "t_l", "t_t", "t_r", "t_b")


def modal_height(boxes: DataFrame, value: Column, name: str) -> DataFrame:
    """Most common value per image; of equally common ones the first in reading order."""
    counted = boxes.groupBy("image_id", value.alias(name)).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(F.struct(*READING)).alias("seen")
    )
    best = F.min(F.struct((-F.col("cnt")).alias("neg"), "seen", F.col(name)))
    return counted.groupBy("image_id").agg(best.alias("b")).select("image_id", f"b.{name}", (-F.col("b.neg")).alias("cnt"))


def digit_heights(boxes: DataFrame) -> DataFrame:
    """Font size of number texts becomes their mean (floored) plus three; others keep their height."""
    size = F.col("b") - F.col("t")
    starts = F.col("content").rlike(r"^[0-9,)(]")
    mean = boxes.groupBy("image_id").agg(F.floor(F.avg(F.when(starts, size))).alias("mean"))
    changed = F.when(F.col("content").rlike(r"^[0-9,)(-]"), F.coalesce(F.col("mean") + 3, size)).otherwise(size)
    return boxes.join(mean, "image_id").withColumn("font_size", changed).drop("mean")


def cells_to_rows(cells: DataFrame) -> DataFrame:
    """``row`` by equal tops, ``col`` by the left edge inside a row."""
    tops = cells.select("image_id", "t").distinct()
    ranked = number_rows(tops, ["image_id"], band("t"), ["t"], "row")
    placed = number_rows(cells, ["image_id", "t"], band("l"), ["l", "ann_id"], "col")
    return placed.join(ranked, ["image_id", "t"])


def table_extents(boxes: DataFrame, is_text: Column) -> DataFrame:
    """A free-text line closes the table above it: box of each table's cells, ``table_no`` from 0."""
    marked = boxes.withColumn("__text", is_text.cast("bigint"))
    placed = scan(marked, ["image_id"], band("t"), READING, sums={"table_no": F.col("__text")})
    return bounding_union(placed.where(F.col("__text") == 0), "image_id", "table_no")


def merge_cells(cells: DataFrame, axis: str, start: int, end: int, texts: Column) -> DataFrame:
    """Cells ``start..end`` along an axis become one per line of the other axis; number of texts kept with it."""
    span = F.when(F.col(axis).between(start, end), F.lit(start)).otherwise(F.col(axis))
    other = "col_no" if axis == "row_no" else "row_no"
    return cells.groupBy("image_id", other, span.alias(axis)).agg(
        F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"), texts.alias("n_texts")
    )


def cell_texts(assigned: DataFrame, boxes: DataFrame, whole: bool = False) -> DataFrame:
    """Lines of a multi-line cell, numbered from the top; stays one row per text."""
    placed = assigned.select("image_id", "ann_id", "row_no", "col_no")
    placed = page_join(boxes, placed, ["ann_id"]) if whole else placed.join(boxes, ["image_id", "ann_id"])
    return number_rows(placed, ["image_id", "row_no", "col_no"], {} if whole else band("t"), READING, "line_no")


def cells_to_rows_text(cells: DataFrame, assigned: DataFrame, boxes: DataFrame, whole: bool = False) -> DataFrame:
    """One line per grid row: first text of every cell in column order, blank where there is none."""
    keyed = assigned.select("image_id", "ann_id", "row_no", "col_no")
    keyed = page_join(boxes, keyed, ["ann_id"]) if whole else keyed.join(boxes, ["image_id", "ann_id"])
    first = keyed.groupBy("image_id", "row_no", "col_no").agg(F.min_by("content", F.struct(*READING)).alias("text"))
    wanted, keys = cells.select("image_id", "row_no", "col_no"), ["row_no", "col_no"]
    full = page_join(wanted, first, keys, "left") if whole else wanted.join(first, ["image_id", *keys], "left")
    ordered = F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("text", F.lit(" ")).alias("text"))))
    return full.groupBy("image_id", "row_no").agg(
        F.array_join(F.transform(ordered, lambda s: s["text"]), "|").alias("texts")
    )
