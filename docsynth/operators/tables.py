"""Text tables as rows of cells and as drawn lines.

``rows(table_id, row_no, cells ARRAY<STRING>)``, ``lines(table_id, line_no, line)``. Widths are reduced map-side to one
short array per table and joined back, so even one huge table keeps its rows spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.functions.binding import let
from docsynth.functions.text import BODY_SPLIT, display_width, with_starts
from docsynth.operators.ordered import entry_states, number_rows, scan

LINE_BLOCK = 1024


def block(c: str) -> dict[str, Column]:
    return {"block": F.floor(F.col(c) / LINE_BLOCK)}


def column_widths(rows: DataFrame, low: int = 0, high: int | None = None) -> DataFrame:
    """Greatest display width per column, at least ``low``; with ``high`` at most that, for cells that will be wrapped or cut."""
    cells = rows.select("table_id", F.posexplode("cells").alias("col_no", "text"))
    widest = F.max(display_width(F.col("text")))
    width = F.greatest(widest if high is None else F.least(widest, F.lit(high)), F.lit(low))
    return cells.groupBy("table_id", "col_no").agg(width.cast("bigint").alias("width"))


def fit_widths(widths: DataFrame, target: Column) -> DataFrame:
    """Shrink or grow every column by the same share until the drawn table has the target width.

    The first columns take the remainder. Drawn width: columns, one separator between two, two borders. ``widths`` has
    one row per column, so the window over a table is short.
    """
    w = Window.partitionBy("table_id")
    sized = widths.withColumns({"n": F.count(F.lit(1)).over(w), "total": F.sum("width").over(w)})
    diff = target - (F.col("total") + F.col("n") + 1)
    part, rest = F.floor(F.abs(diff) / F.col("n")), F.abs(diff) % F.col("n")
    step = part + F.when(F.col("col_no") < rest, 1).otherwise(0)
    return sized.select("table_id", "col_no", (F.col("width") + F.signum(diff).cast("bigint") * step).alias("width"))


def equal_table_width(widths: DataFrame, stack: DataFrame) -> DataFrame:
    """Tables of one stack (``table_id, stack_id``) all get the widest one's width."""
    drawn = widths.groupBy("table_id").agg((F.sum("width") + F.count(F.lit(1)) + 1).alias("drawn")).join(stack, "table_id")
    widest = drawn.groupBy("stack_id").agg(F.max("drawn").alias("target"))
    targets = drawn.select("table_id", "stack_id").join(widest, "stack_id").select("table_id", "target")
    return fit_widths(widths.join(targets, "table_id"), F.col("target"))


def width_arrays(widths: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("col_no", "width")))
    return widths.groupBy("table_id").agg(F.transform(ordered, lambda s: s["width"].cast("int")).alias("widths"))


def rule(widths: Column, left: str, cross: str, right: str) -> Column:
    bars = F.transform(widths, lambda w: F.repeat(F.lit("═"), w))
    return F.concat(F.lit(left), F.array_join(bars, cross), F.lit(right))


def body_line(cells: Column, widths: Column) -> Column:
    padded = F.zip_with(cells, widths, lambda c, w: F.concat(c, F.repeat(F.lit(" "), F.greatest(w - display_width(c), F.lit(0)))))
    return F.concat(F.lit("║"), F.array_join(padded, "║"), F.lit("║"))


def render(rows: DataFrame, widths: DataFrame) -> DataFrame:
    """Rows as lines: a rule before each row (row_no from 1), one after the last."""
    arrays = width_arrays(widths)
    drawn = rows.join(arrays, "table_id")
    above = F.when(F.col("row_no") == 1, rule(F.col("widths"), "╔", "╦", "╗")).otherwise(rule(F.col("widths"), "╠", "╬", "╣"))
    two = F.array(
        F.struct((F.col("row_no") * 2 - 1).alias("line_no"), above.alias("line")),
        F.struct((F.col("row_no") * 2).alias("line_no"), body_line(F.col("cells"), F.col("widths")).alias("line")),
    )
    lines = drawn.select("table_id", F.explode_outer(two).alias("s")).select("table_id", "s.*")
    sizes = rows.groupBy("table_id").agg((F.max("row_no") * 2 + 1).alias("line_no"))
    last = sizes.join(arrays, "table_id").select("table_id", "line_no", rule(F.col("widths"), "╚", "╩", "╝").alias("line"))
    return lines.unionByName(last)


def titled(lines: DataFrame, titles: DataFrame, side: str) -> DataFrame:
    """Put a title (``table_id, title``) above, below, left or right; left and right write it downwards, centred."""
    if side in "lr":
        sizes = lines.groupBy("table_id").agg(F.max("line_no").alias("__n")).join(titles, "table_id")
        at = F.col("line_no") - F.floor((F.col("__n") - F.length("title")) / 2)
        sign = F.when(at.between(1, F.length("title")), F.substring(F.col("title"), at.cast("int"), F.lit(1))).otherwise(F.lit(" "))
        out = F.concat(sign, "line") if side == "l" else F.concat("line", sign)
        return lines.join(sizes, "table_id").select("table_id", "line_no", out.alias("line"))
    sizes = lines.groupBy("table_id").agg(F.max("line_no").alias("__n"), F.max(display_width(F.col("line"))).alias("__w"))
    pad = F.greatest(F.col("__w") - display_width(F.col("title")), F.lit(0))
    centred = F.concat(F.repeat(F.lit(" "), F.floor(pad / 2).cast("int")), "title")
    one = sizes.join(titles, "table_id").select(
        "table_id", (F.lit(0) if side == "t" else F.col("__n") + 1).cast("bigint").alias("line_no"), centred.alias("line")
    )
    return lines.unionByName(one)


def parse_text_table(lines: DataFrame) -> DataFrame:
    """Cells of the drawn lines; rule lines give none."""
    pieces = F.split("line", BODY_SPLIT)
    inner = F.slice(pieces, F.lit(2), F.size(pieces) - 2)
    return lines.where(F.col("line").startswith("║")).select(
        "table_id", "line_no", F.posexplode_outer(inner).alias("col_no", "text")
    ).where(F.col("col_no").isNotNull())


def cell_positions(lines: DataFrame, font: int, line_height: int) -> DataFrame:
    """Pixel box of every cell of a drawn table: across by display width, down to the nearest rules."""
    is_rule = ~F.col("line").startswith("║")
    near = scan(
        lines,
        ["table_id"],
        block("line_no"),
        ["line_no"],
        highs={"above": F.when(is_rule, F.col("line_no"))},
        lows={"below": F.when(is_rule, F.col("line_no"))},
    )
    pieces = F.split("line", BODY_SPLIT)
    near = near.where(~is_rule).withColumn("cells", F.slice(pieces, F.lit(2), F.size(pieces) - 2))
    near = near.withColumn("cells", with_starts(F.col("cells"), display_width, 1))

    def box(cell: Column, i: Column) -> Column:
        left = cell["x"] + 1
        return F.struct(
            i.alias("col_no"),
            cell["item"].alias("text"),
            (left * (font // 2)).cast("bigint").alias("l"),
            ((left + display_width(cell["item"])) * (font // 2)).cast("bigint").alias("r"),
        )

    placed = near.select("table_id", "line_no", "above", "below", F.explode_outer(F.transform("cells", box)).alias("c")).where(F.col("c").isNotNull())
    half = line_height // 2
    return placed.select(
        "table_id",
        "line_no",
        "c.*",
        (F.col("above") * line_height + half).alias("t"),
        (F.col("below") * line_height + half).alias("b"),
    )


def paginate(records: DataFrame, limit: int) -> DataFrame:
    """Page number (from 1) of records of mixed heights: a page ends before the record that finds it full.

    A record's page depends on all before it, but only through the fill of the open page, which has ``limit`` + 1
    states. Every block of records is therefore reduced to a short table "fill before -> fill after and pages begun".
    The tables of a document are combined in a tree of fixed runs, and each block is then numbered on its own from the
    state in which the tree says it is entered.
    """
    blocks = (
        records.withColumns(block("row_no"))
        .groupBy("table_id", "block")
        .agg(F.array_sort(F.collect_list(F.struct("row_no", "height"))).alias("recs"))
    )

    def step(s: Column, r: Column) -> Column:
        turns = s["fill"] >= limit
        return F.struct(
            F.least(F.when(turns, r["height"]).otherwise(s["fill"] + r["height"]), F.lit(limit)).cast("int").alias("fill"),
            (s["pages"] + F.when(turns, 1).otherwise(0)).cast("bigint").alias("pages"),
        )

    def start(fill: Column) -> Column:
        return F.struct(fill.cast("int").alias("fill"), F.lit(0).cast("bigint").alias("pages"))

    def after(table: Column, state: Column) -> Column:
        end = F.element_at(table, state["fill"] + 1)
        return F.struct(end["fill"].alias("fill"), (state["pages"] + end["pages"]).alias("pages"))

    ends = F.transform(F.sequence(F.lit(0), F.lit(limit)), lambda f: F.aggregate("recs", start(f), step))
    starts = entry_states(
        blocks.select("table_id", "block", ends.alias("ends")),
        ["table_id"], "block", "ends", start(F.lit(0)), after, lambda one, two: F.transform(one, lambda s: after(two, s)),
    )

    def number(s: Column, r: Column) -> Column:
        nxt = step(s["at"], r)
        mark = F.struct(r["row_no"].alias("row_no"), nxt["pages"].alias("page"))
        return F.struct(nxt.alias("at"), F.concat(s["out"], F.array(mark)).alias("out"))

    blank = F.array().cast("array<struct<row_no:bigint,page:bigint>>")
    first = F.struct(F.col("state").alias("at"), blank.alias("out"))
    numbered = blocks.join(starts, ["table_id", "block"])
    marks = F.aggregate("recs", first, number, lambda s: s["out"])
    return numbered.select("table_id", F.explode_outer(marks).alias("m")).select("table_id", "m.row_no", (F.col("m.page") + 1).alias("page"))


def page_fill(blocks: DataFrame, budget: int, gap: int, text_height: int) -> DataFrame:
    """Blocks ``page_id, rn, height, is_title`` kept on each page, and how many text blocks fill the rest (``n_texts``).

    Blocks are taken in order while they fit; a title that would come last is taken off again (its room stays lost).
    """
    ends = scan(blocks, ["page_id"], block("rn"), ["rn"], sums={"end": F.col("height") + gap})
    fits = ends.where(F.col("end") - gap <= budget)
    last = fits.groupBy("page_id").agg(F.max("end").alias("used"), F.max_by("is_title", "rn").alias("t"), F.max("rn").alias("last"))
    room = F.greatest(F.floor((budget - F.col("used") + gap) / (text_height + gap)), F.lit(0))
    kept = fits.join(last, "page_id").where(~(F.col("t") & (F.col("rn") == F.col("last"))))
    return kept.select("page_id", "rn", (F.col("end") - gap - F.col("height")).alias("top"), room.alias("n_texts"))


def double_column(rows: DataFrame, lossless: bool = True) -> DataFrame:
    """Row i beside row i + mid of the same table (``table_id, rn, item``); mid is half the body rounded up.

    Without ``lossless`` mid is rounded down, and rows ``mid`` and from ``2 mid`` on are left out.
    """
    n = rows.groupBy("table_id").agg(F.count(F.lit(1)).alias("n"))
    mid = F.ceil(F.col("n") / 2) if lossless else F.floor(F.col("n") / 2)
    placed = rows.join(n.withColumn("mid", mid).drop("n"), "table_id")
    top = F.col("mid") if lossless else F.col("mid") - 1
    left = placed.where(F.col("rn") <= top).select("table_id", "rn", F.col("item").alias("left"))
    right = placed.where((F.col("rn") > F.col("mid")) & (F.col("rn") <= F.col("mid") + top))
    right = right.select("table_id", (F.col("rn") - F.col("mid")).alias("rn"), F.col("item").alias("right"))
    return left.join(right, ["table_id", "rn"], "left")


def side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two line blocks line by line; each is as wide as its widest line, the shorter one goes on with blank lines."""
    widths = [x.groupBy("table_id").agg(F.max(display_width(F.col("line"))).alias(w)) for x, w in ((a, "__wa"), (b, "__wb"))]
    both = a.select("table_id", "line_no", F.col("line").alias("__a")).join(b.select("table_id", "line_no", F.col("line").alias("__b")), ["table_id", "line_no"], "full")
    both = both.join(widths[0], "table_id", "left").join(widths[1], "table_id", "left")

    def filled(line: str, width: str) -> Column:
        text, wide = F.coalesce(line, F.lit("")), F.coalesce(width, F.lit(0))
        return F.concat(text, F.repeat(F.lit(" "), (wide - display_width(text)).cast("int")))

    return both.select("table_id", "line_no", F.concat(filled("__a", "__wa"), filled("__b", "__wb")).alias("line"))


def stack(*blocks: DataFrame) -> DataFrame:
    """Line blocks one under the other: ``block_no`` keeps their order."""
    out = None
    for i, b in enumerate(blocks, 1):
        one = b.select("table_id", F.lit(i).cast("bigint").alias("block_no"), "line_no", "line")
        out = one if out is None else out.unionByName(one)
    return out


def flatten_header(leaves: DataFrame, table: str, path: str, chunk: dict[str, Column], order: list[str]) -> DataFrame:
    """Nested header as spans: each node's level, first leaf (from 1) and number of leaves; leaves hold their path."""
    placed = number_rows(leaves, [table], chunk, order, "leaf_no")
    levels = F.explode_outer(F.sequence(F.lit(1), F.size(path))).alias("level")
    nodes = placed.select(table, "leaf_no", path, levels).withColumn(
        "node", F.array_join(F.slice(F.col(path), F.lit(1), F.col("level")), "/")
    )
    return nodes.groupBy(table, "level", "node").agg(F.min("leaf_no").alias("first_leaf"), F.count(F.lit(1)).alias("span"))


def key_value_rows(df: DataFrame, keep: list[str], entries: Column, per_row: int) -> DataFrame:
    """Dictionary entries, ``per_row`` pairs to a line."""
    rows = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(entries) - 1) / per_row).cast("int")),
        lambda i: F.array_join(
            F.transform(F.slice(entries, i * per_row + 1, F.lit(per_row)), lambda e: F.concat_ws(":", e["key"], e["value"])), "|"
        ),
    )
    return df.select(*keep, F.posexplode_outer(rows).alias("line_no", "line"))


def fold_wide_rows(df: DataFrame, keep: list[str], cells: Column, max_cols: int) -> DataFrame:
    """A record wider than ``max_cols`` as several lines, the last one padded with blanks."""
    lines = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(cells) - 1) / max_cols).cast("int")),
        lambda i: F.slice(cells, i * max_cols + 1, F.lit(max_cols)),
    )
    padded = F.when(
        F.size(cells) > max_cols,
        F.transform(lines, lambda a: F.concat(a, F.array_repeat(F.lit(" "), F.lit(max_cols) - F.size(a)))),
    ).otherwise(lines)
    return df.select(*keep, F.posexplode_outer(padded).alias("part", "cells"))


def header_and_values(df: DataFrame, keep: list[str], entries: Column) -> DataFrame:
    """Dictionary as two lines: its keys, then its values."""
    lines = [F.array_join(F.transform(entries, lambda e: e[part]), "|") for part in ("key", "value")]
    return df.select(*keep, F.posexplode_outer(F.array(*lines)).alias("line_no", "line"))


def is_body(line: Column) -> Column:
    return line.startswith("║")


def align_column(line: Column, col_no: int, side: str) -> Column:
    """A drawn line with one cell set left (``l``), right (``r``) or in the middle (``c``); one blank stays on a set side.

    A cell without a blank to spare, and a rule, stay as they are.
    """

    def moved(cell: Column) -> Column:
        def place(m: Column) -> Column:
            blanks = lambda n: F.repeat(F.lit(" "), n)
            half = F.floor(m["free"] / 2).cast("int")
            left = {"l": F.lit(1), "r": m["free"] - 1, "c": half}[side]
            return F.when(m["free"] > 0, F.concat(blanks(left), m["text"], blanks(m["free"] - left))).otherwise(cell)

        bare = F.trim(cell)
        return let(F.struct(bare.alias("text"), (F.length(cell) - F.length(bare)).alias("free")), place)

    cells = F.transform(F.split(line, "║"), lambda c, i: F.when(i == col_no + 1, moved(c)).otherwise(c))
    return F.when(is_body(line), F.array_join(cells, "║")).otherwise(line)


def widen(line: Column, by: int, side: str) -> Column:
    """A drawn line ``by`` columns wider, in its last cell: the text keeps left, right or (``m``) halfway."""
    end = F.substring(line, -1, 1)
    before = {"l": 0, "r": by, "m": by // 2}[side]
    last = F.substring_index(F.substring(line, F.lit(1), F.length(line) - 1), "║", -1)
    head = F.substring(line, F.lit(1), F.length(line) - 1 - F.length(last))
    body = F.concat(head, F.lit(" " * before), last, F.lit(" " * (by - before)), end)
    ruled = F.concat(F.substring(line, F.lit(1), F.length(line) - 1), F.repeat(F.substring(line, -2, 1), F.lit(by)), end)
    return F.when(is_body(line), body).otherwise(ruled)


def heighten(lines: DataFrame, by: int, side: str) -> DataFrame:
    """Drawn tables with ``by`` blank lines: before the last rule (``t``) or after the first (``b``).

    Where a column ends is read off the joints of that rule; the lines behind are renumbered.
    """
    ends = lines.groupBy("table_id").agg(
        F.max("line_no").alias("__last"), F.max_by("line", "line_no").alias("__bottom"), F.min_by("line", "line_no").alias("__top")
    )
    joints = F.regexp_replace(F.translate(F.col("__bottom" if side == "t" else "__top"), "═", " "), "[^ ]", "║")
    at = F.col("__last") if side == "t" else F.lit(2)
    blank = ends.select("table_id", F.explode(F.sequence(at.cast("bigint"), at.cast("bigint") + by - 1)).alias("line_no"), joints.alias("line"))
    moved = lines.join(ends.select("table_id", at.cast("bigint").alias("__at")), "table_id")
    number = F.col("line_no") + F.when(F.col("line_no") >= F.col("__at"), by).otherwise(0)
    return moved.select("table_id", number.alias("line_no"), "line").unionByName(blank)


def merge_row(line: Column) -> Column:
    """Inner separators of a line become blanks."""
    inner = F.substring(line, F.lit(2), F.length(line) - 2)
    return F.concat(F.substring(line, 1, 1), F.translate(inner, "║╬╦╩", "    "), F.substring(line, -1, 1))


def drop_inner_rules(lines: DataFrame) -> DataFrame:
    """Only the first and the last rule stay."""
    return lines.where(~F.col("line").startswith("╠"))
