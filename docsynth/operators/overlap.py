"""Collisions of boxes: flags, greedy removal, and the largest free rectangle."""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from docsynth.functions.geometry import crossing, similar_area
from docsynth.operators.spatial import buckets_of, page_join, split_pages
from docsynth.session import materialise, materialise_by, work_path

BOX = ["l", "t", "r", "b"]


def distinct_boxes(boxes: DataFrame) -> DataFrame:
    """Equal boxes of an image become one, with the number of copies and the first id; merged map-side."""
    return boxes.groupBy("image_id", *BOX).agg(F.count(F.lit(1)).alias("copies"), F.min("ann_id").alias("ann_id"))


def level_of() -> Column:
    """Level of a box: its cells are as wide as the next power of two above its longer side."""
    return F.ceil(F.log2(F.greatest(F.col("r") - F.col("l"), F.col("b") - F.col("t"), F.lit(1)).cast("double"))).cast("int")


def cells(boxes: DataFrame, level: str) -> DataFrame:
    """One row per touched cell of a level, columns ``tx`` and ``ty``; the far edges count."""
    size = F.pow(F.lit(2.0), F.col(level))
    for low, high, name in (("l", "r", "tx"), ("t", "b", "ty")):
        span = F.sequence(F.floor(F.col(low) / size).cast("long"), F.floor(F.col(high) / size).cast("long"))
        boxes = boxes.select("*", F.explode_outer(span).alias(name))
    return boxes


def near_pairs(boxes: DataFrame) -> DataFrame:
    """Different boxes that cross or touch, found on a hierarchical grid; the other one's columns start with ``o_``.

    A box lies in at most four cells of its own level, whatever its size, and is looked up in at most four cells of each
    larger level that its image has boxes on. So a page-wide box is a few rows, and where many small boxes lie close
    together they are told apart by cells of their own size. A pair that shares several cells is reported on each of
    them, so callers reduce with idempotent aggregates.
    """
    own = boxes.withColumn("level", level_of())
    levels = own.groupBy("image_id").agg(F.collect_set("level").alias("levels"))
    home = cells(own, "level")
    asked = own.withColumnRenamed("level", "o_level").join(levels, "image_id")
    asked = asked.select("image_id", "o_level", *[F.col(c).alias(f"o_{c}") for c in boxes.columns if c != "image_id"], *BOX, F.explode(F.filter("levels", lambda x: x >= F.col("o_level"))).alias("level"))
    asked = cells(asked, "level").drop(*BOX)
    same = (F.col("l") == F.col("o_l")) & (F.col("t") == F.col("o_t")) & (F.col("r") == F.col("o_r")) & (F.col("b") == F.col("o_b"))
    touch = (
        (F.col("l") <= F.col("o_r")) & (F.col("o_l") <= F.col("r")) & (F.col("t") <= F.col("o_b")) & (F.col("o_t") <= F.col("b"))
    )
    names = [c for c in boxes.columns if c != "image_id"]
    found = home.join(asked, ["image_id", "level", "tx", "ty"]).where(touch & ~same)
    # A box of a smaller level is only looked up among the larger ones, so such a pair is turned round as well.
    ways = F.array(F.lit(False), F.when(F.col("o_level") < F.col("level"), True))
    turned = found.select("*", F.explode(F.filter(ways, lambda x: x.isNotNull())).alias("turn"))
    either = lambda c, d: F.when(F.col("turn"), F.col(c)).otherwise(F.col(d))
    return turned.select("image_id", *[either(f"o_{c}", c).alias(c) for c in names], *[either(c, f"o_{c}").alias(f"o_{c}") for c in names])


def page_pairs(boxes: DataFrame) -> DataFrame:
    """Pairs of boxes of a page, for pages that are small; the other one's columns start with ``o_``."""
    other = boxes.select("image_id", *[F.col(c).alias(f"o_{c}") for c in boxes.columns if c != "image_id"])
    return boxes.join(other, "image_id")


def area(prefix: str = "") -> Column:
    return (F.col(f"{prefix}r") - F.col(f"{prefix}l")) * (F.col(f"{prefix}b") - F.col(f"{prefix}t"))


def crossing_pair() -> Column:
    return crossing(*[F.col(c) for c in BOX], *[F.col(f"o_{c}") for c in BOX])


def overlaps(boxes: DataFrame) -> DataFrame:
    """Per distinct box: does it cross any other, one of similar area, or cross or contain one (either way)."""
    single = distinct_boxes(boxes).drop("ann_id")
    inside = (
        (F.col("o_l") >= F.col("l")) & (F.col("o_r") <= F.col("r")) & (F.col("o_t") >= F.col("t")) & (F.col("o_b") <= F.col("b"))
    )
    around = (
        (F.col("o_l") <= F.col("l")) & (F.col("o_r") >= F.col("r")) & (F.col("o_t") <= F.col("t")) & (F.col("o_b") >= F.col("b"))
    )
    hits = (
        near_pairs(single)
        .groupBy("image_id", *BOX)
        .agg(
            F.bool_or(crossing_pair()).alias("any"),
            F.bool_or(crossing_pair() & similar_area(area(), area("o_"))).alias("similar"),
            F.bool_or(crossing_pair() | inside | around).alias("nested"),
        )
    )
    out = single.join(hits, ["image_id", *BOX], "left")
    twin = F.col("copies") > 1
    return out.select(
        "image_id", *BOX, "copies", *[(twin | F.coalesce(c, F.lit(False))).alias(c) for c in ("any", "similar", "nested")]
    )


def dedupe_boxes(boxes: DataFrame, order: list[str]) -> DataFrame:
    """Greedy removal in ``order``: a text goes if its exact box was kept or it crosses a kept one of similar area.

    Equal boxes are merged first. Each box then waits on literals "that earlier rival is kept" (``kept`` true) or "is
    dropped" (false): it stays if none of them holds. A round replaces every rival that is decided by its decision, and
    every rival that itself waits on a single literal by the box this one is about, so a chain of rivals halves each
    round. Boxes without an earlier rival are decided from the start; each round decides at least the earliest undecided
    box of every cluster. Decisions are appended to one table, so no plan grows with the rounds.
    """
    spark, key = boxes.sparkSession, ["image_id", "ann_id"]
    at = F.struct(*order, "ann_id")

    def merged(part: DataFrame) -> DataFrame:
        return part.groupBy("image_id", *BOX).agg(F.min(at).alias("at"))

    def literals(pairs: DataFrame) -> DataFrame:
        found = pairs.where(crossing_pair() & similar_area(area(), area("o_")) & (F.col("o_at") < F.col("at")))
        return found.select("image_id", F.col("at.ann_id").alias("ann_id"), F.col("o_at.ann_id").alias("on"), F.lit(True).alias("kept")).distinct()

    # Small pages are dealt out once, by page, and compared there; large ones meet on the grid.
    small, large = split_pages(boxes)
    buckets = buckets_of(small)
    single = materialise_by(merged(small.repartition(buckets, "image_id")), "dedupe-boxes", "image_id", buckets)
    rivals = literals(page_pairs(single))
    if large is not None:
        spread = materialise(merged(large), "dedupe-boxes")
        rivals = rivals.unionByName(literals(near_pairs(spread)))
    waiting = materialise(rivals, "dedupe-waiting")
    first = waiting.select("image_id", F.col("on").alias("ann_id")).distinct().join(waiting, key, "left_anti")
    path = work_path(spark, "dedupe-decided")
    decided = first.withColumn("stays", F.lit(True))
    decided.write.parquet(path)
    fresh = spark.read.schema(decided.schema).parquet(path)
    while not waiting.isEmpty():
        told = fresh.select("image_id", F.col("ann_id").alias("on"), "stays")
        seen = waiting.join(told, ["image_id", "on"], "left").select(*key, "on", "kept", (F.col("stays") == F.col("kept")).alias("holds"))
        open_ = F.col("holds").isNull()
        alone = seen.where("holds IS NULL OR holds").groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.bool_or("holds").alias("lost"), F.first("on").alias("to"), F.first("kept").alias("to_kept"))
        alone = alone.where("n = 1 AND lost IS NULL").select("image_id", F.col("ann_id").alias("on"), "to", "to_kept")
        # A box that waits on one literal stays just if that does not hold, so the sign turns with a true one.
        turns = open_ & F.col("to").isNotNull()
        after = seen.join(alone, ["image_id", "on"], "left").select(
            *key, F.when(turns, F.col("to")).otherwise(F.col("on")).alias("on"), F.when(turns, F.col("kept") != F.col("to_kept")).otherwise(F.col("kept")).alias("kept"), "holds"
        ).distinct()
        after = materialise(after, "dedupe-step")
        per_rival = after.groupBy(*key, "on").agg(
            F.bool_or("holds").alias("holds"), F.bool_or(open_ & F.col("kept")).alias("plus"), F.bool_or(open_ & ~F.col("kept")).alias("minus")
        )
        # Both signs of one rival: one of them holds.
        per_box = per_rival.groupBy(*key).agg(
            F.bool_or(F.coalesce("holds", F.lit(False)) | (F.col("plus") & F.col("minus"))).alias("lost"), F.bool_or(F.col("plus") | F.col("minus")).alias("open")
        )
        fresh = materialise(per_box.where("lost OR NOT open").select(*key, (~F.col("lost")).alias("stays")), "dedupe-fresh")
        fresh.write.mode("append").parquet(path)
        waiting = materialise(after.where(open_).drop("holds").join(fresh, key, "left_anti"), "dedupe-waiting")
    lost = spark.read.schema(decided.schema).parquet(path).where("NOT stays").select(*key)
    columns = ["image_id", F.col("at.ann_id").alias("ann_id"), *BOX]
    out = page_join(single.select(*columns), lost, ["ann_id"], "left_anti")
    return out if large is None else out.unionByName(spread.select(*columns).join(lost, key, "left_anti"))


#: Left edges of a picture that one row sweeps from.
EDGES = 64


def sweep(edges: list, boxes: list[tuple], union: tuple) -> tuple | None:
    """Largest (area, l, r, t, b) free of ``boxes`` (l, t, r, b; sorted) whose left edge is one of ``edges``.

    From each left edge the boxes are met from left to right. The stretches of height that no box has closed yet stay
    open, sorted and apart from each other; a box ends those it reaches into and leaves what is above and below it.
    """
    left, top, right, bottom = union
    best = None
    for edge in edges:
        if best is not None and (right - edge) * (bottom - top) < best[0]:
            continue
        tops, bottoms = [top], [bottom]
        for l, t, r, b in boxes:
            if r <= edge:
                continue
            first, stop = bisect.bisect_right(bottoms, t), bisect.bisect_left(tops, b)
            if first >= stop:
                continue
            for k in range(first, stop if l > edge else first):
                found = ((l - edge) * (bottoms[k] - tops[k]), edge, l, tops[k], bottoms[k])
                best = found if best is None or found > best else best
            above = [(tops[first], t)] if t > tops[first] else []
            below = [(b, bottoms[stop - 1])] if b < bottoms[stop - 1] else []
            tops[first:stop], bottoms[first:stop] = [x for x, _ in above + below], [x for _, x in above + below]
            if not tops:
                break
        for x, y in zip(tops, bottoms, strict=True):
            found = ((right - edge) * (y - x), edge, right, x, y)
            if right > edge and y > x and (best is None or found > best):
                best = found
    return best


def largest_gap(boxes: DataFrame) -> DataFrame:
    """Largest rectangle inside the union box that crosses no box; of equal ones the last by left, right, top, bottom.

    A largest rectangle reaches on the left to a box's right edge or the union's. Each left edge is swept once over the
    boxes of its picture, so the work is about the square of a picture's distinct boxes; the edges of a large picture are
    dealt out in runs of ``EDGES``. A picture's boxes are one array.
    """
    box = F.array_sort(F.collect_set(F.struct(*BOX)))
    union = F.struct(F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))
    pictures = boxes.groupBy("image_id").agg(box.alias("boxes"), union.alias("u"))
    lefts = F.array_sort(F.array_union(F.transform("boxes", lambda x: x["r"]), F.array(F.col("u.l"))))
    runs = F.transform(F.sequence(F.lit(1), F.size("lefts"), F.lit(EDGES)), lambda i: F.slice("lefts", i, F.lit(EDGES)))
    dealt = pictures.withColumn("lefts", lefts).select("image_id", "boxes", "u", F.posexplode(runs).alias("run", "edges"))
    kind = boxes.schema["l"].dataType.simpleString()
    fields = ", ".join(f"{c} {kind}" for c in ("area", "l", "r", "t", "b"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Columns as flat lists once a batch; a row's lists are slices of them.
            near, lefts, union = batch.column("boxes"), batch.column("edges"), batch.column("u")
            flat = list(zip(*[near.values.field(c).to_pylist() for c in BOX], strict=True))
            unions = zip(*[union.field(c).to_pylist() for c in BOX], strict=True)
            ends, edges, stops = near.offsets.to_pylist(), lefts.values.to_pylist(), lefts.offsets.to_pylist()
            found = [sweep(edges[stops[i] : stops[i + 1]], flat[ends[i] : ends[i + 1]], u) for i, u in enumerate(unions)]
            kept = [i for i, x in enumerate(found) if x]
            columns = zip(*[found[i] for i in kept], strict=True) if kept else [[]] * 5
            arrays = [batch.column("image_id").take(pa.array(kept, pa.int64())), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, schema, strict=True)], schema=schema)

    ident = boxes.schema["image_id"].dataType
    out_fields = f"image_id {ident.simpleString()}, {fields}"
    schema = to_arrow_schema(boxes.select("image_id", *[F.lit(None).cast(kind).alias(c) for c in ("area", "l", "r", "t", "b")]).schema)
    spread = dealt.repartition("image_id", "run").select("image_id", "edges", "boxes", "u")
    best = F.max(F.struct("area", "l", "r", "t", "b"))
    return spread.mapInArrow(task, out_fields).groupBy("image_id").agg(best.alias("s")).select("image_id", "s.*")
