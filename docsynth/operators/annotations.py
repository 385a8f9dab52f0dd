"""Annotation sets: encoding, padding, merging, rule lines, composition of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.functions import geometry as g
from docsynth.operators.ordered import scan


def select_label_keys(df: DataFrame) -> DataFrame:
    """Training columns only, the text without its kind."""
    return df.select("image_id", "polys", F.regexp_replace("label", "^text@", "").alias("text"))


def encode_labels(df: DataFrame) -> DataFrame:
    """``labels`` and the flat ``points`` (four per label) as aligned ``polys``, ``texts`` and ``ignore_tags``."""
    n = F.size("labels")
    polys = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(F.col("points"), i * 4 + 1, F.lit(4)))
    return df.select(
        *[c for c in df.columns if c not in ("labels", "points")],
        polys.alias("polys"),
        F.transform("labels", lambda x: F.regexp_replace(x, "^text@", "")).alias("texts"),
        F.transform("labels", lambda x: F.lit(False)).alias("ignore_tags"),
    )


def pad_polygons(df: DataFrame, group: str, quad: str | Column, name: str = "quad", corners: Column | None = None) -> DataFrame:
    """Repeat the last corner up to the longest polygon of the group.

    A polygon given as an expression is made after the rows are dealt by group, as column ``name``: what it is made of is
    smaller to shuffle. ``corners`` is its number of corners, where that is known without the polygon. The groups of a
    partition are hashed, so the rows, which are many more, are not sorted.
    """
    if isinstance(quad, str):
        quad, name = F.col(quad), quad
    longest = df.groupBy(group).agg(F.max(F.size(quad) if corners is None else corners).alias("__n"))
    dealt = df.join(longest.hint("shuffle_hash"), group).withColumn(name, quad)
    last = F.element_at(F.col(name), -1)
    padded = F.concat(F.col(name), F.array_repeat(last, F.col("__n") - F.size(name)))
    return dealt.withColumn(name, padded).drop("__n")


def merge_annotations(*parts: tuple[str, DataFrame]) -> DataFrame:
    """Several kinds of boxes as one label list."""
    out = None
    for kind, df in parts:
        one = df.select("image_id", F.lit(kind).alias("kind"), "content", "l", "t", "r", "b")
        out = one if out is None else out.unionByName(one)
    return out


def layout_offsets(blocks: DataFrame, group: str, chunk: dict[str, Column], order: list[str], extent: str, gap: int) -> DataFrame:
    """Place blocks one after another: ``offset`` of each along the axis, the gap between two."""
    step = (F.col(extent) + gap).cast("bigint")
    placed = scan(blocks, [group], chunk, order, sums={"__end": step})
    return placed.withColumn("offset", F.col("__end") - step).drop("__end")


def container_size(blocks: DataFrame, group: str, along: str, across: str, gap: int) -> DataFrame:
    """Sum of the extents with the gaps between them, and the greatest extent the other way."""
    total = F.sum(F.col(along) + gap) - gap
    return blocks.groupBy(group).agg(total.alias("along"), F.max(across).alias("across"))


#: Boxes whose lines one task merges.
PART_BOXES = 500_000


def rule_segments(boxes: DataFrame, mode: Column) -> DataFrame:
    """Lines drawn around boxes; equal lines once.

    ``all`` four edges, ``rows`` top and bottom, ``cols`` left and right, ``header`` top and bottom of the first row,
    ``border`` the upper edge of the first row and the lower edge of the last one.
    """
    parts = max(int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-boxes.count() // PART_BOXES))
    ends = boxes.groupBy("image_id").agg(F.min("t").alias("__first"), F.max("b").alias("__last"))
    boxes = boxes.withColumn("__mode", mode).join(ends, "image_id")
    mode, first, last = F.col("__mode"), F.col("t") == F.col("__first"), F.col("b") == F.col("__last")

    def edge(kind: str, x1: str, y1: str, x2: str, y2: str) -> Column:
        return F.struct(F.lit(kind).alias("axis"), *[F.col(c).alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])

    edges = F.array(
        edge("h", "l", "t", "r", "t"), edge("h", "l", "b", "r", "b"), edge("v", "l", "t", "l", "b"), edge("v", "r", "t", "r", "b")
    )

    def drawn(e: Column) -> Column:
        across, top = e["axis"] == "h", e["y1"] == F.col("t")
        border = across & ((first & top) | (last & ~top))
        return (mode == "all") | ((mode == "rows") & across) | ((mode == "cols") & ~across) | ((mode == "header") & first & across) | ((mode == "border") & border)

    wanted, line = F.filter(edges, drawn), ["image_id", "axis", "x1", "y1", "x2", "y2"]
    found = boxes.select("image_id", F.explode_outer(wanted).alias("e")).where(F.col("e").isNotNull()).select("image_id", "e.*")
    # Dealt out before they are merged, in as many parts as the boxes need: merged in the scan, the lines of a whole file
    # split would be held by one task. A line drawn many times is held once.
    return found.repartition(parts, *line).distinct()


def arc_outlines(df: DataFrame, n: str, size: str, radius: str, clockwise: bool = True, degrees: Column | None = None) -> DataFrame:
    """``outline`` of n letters on an arc: outer edge forward, inner edge back, moved to the origin.

    Angles run over -d/2, 0, d, .., (n-1)d, (n-1)d + d/2 with d the angle of a letter. Without ``degrees`` the arc is
    turned until its chord is level. Each intermediate is its own column, so nothing is computed twice.
    """
    sign = 1 if clockwise else -1
    letter = g.arc_angle(F.col(size), F.col(radius))
    d, last = F.col("__d"), F.col("__d") * (F.col(n) - 1)
    steps = F.concat(F.array(-d / 2), F.transform(F.sequence(F.lit(0), F.col(n) - 1), lambda i: i * d), F.array(last + d / 2))

    def edge(share: float) -> Column:
        return F.transform("__steps", lambda a: g.arc_vertex(a, F.col(size) * share, F.col(radius), F.col("__turn"), sign))

    edges = {"__outer": edge(0.5), "__inner": edge(-0.5)}
    return (
        df.withColumn("__d", letter)
        .withColumns({"__turn": -last * sign / 2 if degrees is None else F.radians(degrees), "__steps": steps})
        .withColumns(edges)
        .withColumn("outline", F.concat("__outer", F.reverse("__inner")))
        .withColumn("__box", g.quad_to_box(F.col("outline")))
        .withColumn("outline", g.shift_points(F.col("outline"), -F.col("__box.l"), -F.col("__box.t")))
        .drop("__d", "__turn", "__steps", "__outer", "__inner", "__box")
    )
