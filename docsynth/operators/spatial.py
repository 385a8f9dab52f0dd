"""Range joins on boxes, as equi joins on tiles.

A box is listed once for every tile it touches, so a page with very many boxes is spread over its tiles instead of being
one join key, and only boxes that share a tile are ever compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.session import materialise

TILE = 256
#: Boxes of a page that one task compares at once; larger pages go by bands and tiles.
PAGE_BOXES = 4096
#: Boxes of a bucket of small pages.
BUCKET_BOXES = 2_000_000


def tile_of(x: Column, size: int = TILE) -> Column:
    return F.floor(x / size)


def cover(df: DataFrame, l: str, t: str, r: str, b: str, size: int = TILE) -> DataFrame:
    """One row per touched tile, columns ``tx`` and ``ty``; the far edges count."""
    across = F.explode_outer(F.sequence(tile_of(F.col(l), size), tile_of(F.col(r), size))).alias("tx")
    down = F.explode_outer(F.sequence(tile_of(F.col(t), size), tile_of(F.col(b), size))).alias("ty")
    return df.select("*", across).select("*", down)


def locate(df: DataFrame, x: Column, y: Column, size: int = TILE) -> DataFrame:
    """The one tile of a point."""
    return df.withColumns({"tx": tile_of(x, size), "ty": tile_of(y, size)})


def points_in_boxes(
    points: DataFrame, x: str, y: str, boxes: DataFrame, group: Sequence[str], size: int = TILE
) -> DataFrame:
    """Pairs (point row, box row) where the closed box ``l,t,r,b`` holds the point."""
    left = locate(points, F.col(x), F.col(y), size)
    right = cover(boxes, "l", "t", "r", "b", size)
    inside = (F.col(x) >= F.col("l")) & (F.col(x) <= F.col("r")) & (F.col(y) >= F.col("t")) & (F.col(y) <= F.col("b"))
    return left.join(right, [*group, "tx", "ty"]).where(inside).drop("tx", "ty")


def page_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", group: str = "image_id") -> DataFrame:
    """Join on ``group`` and ``keys`` for pages that are small: rows dealt by ``group`` alone stay where they are.

    Spark deals rows anew for an equality that they are not dealt by, so the other keys are compared inside a page.
    """
    other = right.select(F.col(group).alias("__g"), *[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c != group and c not in keys])
    same = F.col(group) == F.col("__g")
    for k in keys:
        same = same & (F.col(k) <= F.col(f"__k_{k}")) & (F.col(k) >= F.col(f"__k_{k}"))
    return left.join(other, same, how).drop("__g", *[f"__k_{k}" for k in keys])


def split_pages(boxes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Boxes of pages with at most ``PAGE_BOXES`` boxes, and those of the others if there are any."""
    counted = boxes.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    large = materialise(counted.where(F.col("n") > PAGE_BOXES).select("image_id"), "large-pages")
    if large.isEmpty():
        return boxes, None
    return boxes.join(large, "image_id", "left_anti"), boxes.join(large, "image_id", "left_semi")


def buckets_of(boxes: DataFrame) -> int:
    """As many buckets of pages as the boxes need."""
    return max(int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-boxes.count() // BUCKET_BOXES))
