"""Hard negatives by inner product: rows of another label whose score lies in a window below a positive's.

Candidates are sorted along a Hilbert curve, cut into blocks and written as Parquet, each block with the least and
greatest value of every dimension (its zone map) and its labels. Interval arithmetic on a zone map bounds the scores that
an anchor can have with any row of the block: the positives of an anchor are looked for in the blocks whose upper bound
reaches what the anchor's own block already offers, its negatives in the blocks whose bounds meet one of its windows. Only
the blocks so chosen are sent to the anchors that need them. Zone maps and blocks are met by packs of anchors, so no task
sees more than a pack and a page of zone maps or a chunk of blocks.

A score is the inner product of floor(256 * x), computed exactly. Higher scores come first, ties by smaller vec_id; equal
rows of one id cannot be told apart in the result.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; zero and empty
vectors do. Vectors of different length are never compared. A row without id is no anchor, and comes last among ties.
Rows that share an id are different rows, each of them an anchor if the id is one. Whole components beyond
:func:`largest` saturate there, so that no score overflows. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.session import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
#: Bits of the Hilbert curve for each dimension, and bytes of the index that rows are sorted by.
BITS, KEY_BYTES = 4, 32
#: Rows of a block; numbers (rows x dimensions) of a chunk of blocks and rows x dimensions behind a page of zone maps.
ROWS, CHUNK, PAGE = 256, 1 << 19, 1 << 24
#: Anchors of a pack.
PACK = 512
#: A row's number is its partition, its block in the partition and its place in the block, of which these bits hold the last.
SHIFT, ROW_BITS = 32, 8
NO_ID = np.iinfo(np.int64).max


def largest(dim: int) -> int:
    """Greatest whole component: a hundred times any score still fits a long."""
    return math.isqrt(((1 << 63) - 1) // (128 * max(1, dim)))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component."""
    most = min(largest(vectors.shape[1]), (1 << 31) - 1)
    return np.clip(np.floor(SCALE * vectors), -most, most).astype(np.int32)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bits of the Hilbert index of each row of cells (0 to 2**bits - 1 a dimension), most significant first."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    if not n:
        return np.zeros((cells.shape[0], 0), np.uint8)
    # Undo the turns and reflections of each cube, from the largest cube down.
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(flip, below, swap)
            x[i] ^= swap
    # What is left is a Gray code.
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    return np.stack([(x[i] >> level) & 1 for level in range(bits - 1, -1, -1) for i in range(n)], 1).astype(np.uint8)


def curve_keys(vectors: np.ndarray) -> list[bytes]:
    """First bytes of the Hilbert index of each vector's direction."""
    n, dim = vectors.shape
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        unit = vectors / np.abs(vectors).max(1, initial=0, keepdims=True)
        unit = np.nan_to_num(unit / np.linalg.norm(unit, axis=1, keepdims=True)) * math.sqrt(max(1, dim))
    cells = np.minimum(np.floor((0.5 + np.arctan(unit) / math.pi) * (1 << BITS)), (1 << BITS) - 1)
    # The first bytes hold the highest bits of all dimensions; more cells than fit into them are not needed.
    used = 1 + (KEY_BYTES * 8 - 1) // max(1, dim)
    packed = np.packbits(hilbert(cells.astype(np.int64) >> max(0, BITS - used), min(BITS, used)), axis=1)[:, :KEY_BYTES]
    return [row.tobytes() for row in packed] if n else []


def matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole matrices."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    kind = np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def zone_bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each row of ``a`` can have within each zone."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return products(plus, low) + products(minus, high), products(plus, high) + products(minus, low)


def usable(vectors: DataFrame, ident: str, label: Column, vector: str) -> DataFrame:
    rows = vectors.select(F.col(ident).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite).withColumn("dim", F.size("v"))


ROW = "dim int, id long, label long, key binary, salt int, v array<int>"


def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components and place on the curve of each row; batches may mix lengths."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            n = len(part)
            v = matrix(part.column("v"), n)
            ints = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * dim, pa.int32()), pa.array(whole(v).ravel()))
            # Equal vectors are spread by a number drawn from their place in the batch.
            salt = np.random.default_rng(n).permutation(n).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("dim"), part.column("id"), part.column("label"), pa.array(curve_keys(v), pa.binary()), pa.array(salt), ints], ["dim", "id", "label", "key", "salt", "v"])


BLOCK = "part int, block long, dim int, n int, n_anchors int, low array<int>, high array<int>, labels array<long>, ids array<long>, row_labels array<long>, v array<int>, asks array<boolean>, floors array<long>"


def blocks(batches: Iterable[pa.RecordBatch], positives: int, most: int) -> Iterator[pa.RecordBatch]:
    """Blocks of ``most`` neighbours on the curve, from sorted rows; ``floors``: what an anchor's own block offers as positives."""
    part, count = TaskContext.get().partitionId(), 0
    held: list[pa.Table] = []

    def cut(table: pa.Table) -> pa.RecordBatch:
        nonlocal count
        dim, n = table.column("dim")[0].as_py(), len(table)
        ids = table.column("id").combine_chunks().fill_null(int(NO_ID)).to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, label = ids[order], table.column("label").to_numpy()[order]
        asks = table.column("asks").to_numpy()[order]
        v = matrix(table.column("v"), n)[order]
        floors = np.full(n, np.iinfo(np.int64).min)
        at = np.flatnonzero(asks)
        scores = products(v[at], v)
        for i, row in zip(at.tolist(), scores, strict=True):
            same = label == label[i]
            same[i] = False
            if same.sum() >= positives:
                floors[i] = np.partition(row[same], -positives)[-positives]
        one = [part, (part << SHIFT) + count, dim, n, len(at), v.min(0), v.max(0), np.unique(label), ids, label, v.ravel(), asks, floors]
        count += 1
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.list_(k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64())]]
        names = [x.split()[0] for x in BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(one, kinds, strict=True)], names)

    def ready(table: pa.Table, last: bool) -> Iterator[pa.Table]:
        """Tables of one block each; without ``last`` the rows of the last one are held back."""
        dims = table.column("dim").to_numpy()
        edges = [*np.flatnonzero(dims[1:] != dims[:-1]) + 1, len(dims)] if len(dims) else []
        start = 0
        for end in edges:
            while start < end:
                stop = min(int(end), start + most)
                if not last and stop == len(dims) and stop - start < most:
                    held.append(table.slice(start))
                    return
                yield table.slice(start, stop - start)
                start = stop

    for batch in batches:
        table = pa.concat_tables([*held, pa.Table.from_batches([batch])])
        held.clear()
        for piece in ready(table, False):
            yield cut(piece)
    if held:
        table = held.pop()
        for piece in ready(table, True):
            yield cut(piece)


def indexed(rows: DataFrame, is_anchor: Column, positives: int) -> DataFrame:
    """The written blocks along the curve, each with the number of its chunk, its page and the first of its anchors."""
    placed = rows.mapInArrow(keyed, ROW).withColumn("asks", F.coalesce(is_anchor, F.lit(False)))
    ranged = placed.repartitionByRange("dim", "key", "salt").sortWithinPartitions("dim", "key", "salt")
    most = ROWS
    cut = materialise(ranged.mapInArrow(lambda it: blocks(it, positives, most), BLOCK), "blocks")
    size = F.col("n").cast("long") * F.greatest("dim", F.lit(1))
    # One row a partition, so the window over them has as many rows as the shuffle has partitions.
    parts = cut.groupBy("part").agg(F.sum(size).alias("size"), F.sum("n_anchors").cast("long").alias("anchors"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_size"), F.coalesce(F.sum("anchors").over(before), F.lit(0)).alias("part_anchors"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = cut.select("part", "block", F.coalesce(F.sum(size).over(inside), F.lit(0)).alias("size"), F.coalesce(F.sum("n_anchors").over(inside), F.lit(0)).alias("anchors")).join(parts, "part")
    at = F.col("size") + F.col("part_size")
    return materialise(places.select("block", F.floor(at / CHUNK).alias("chunk"), F.floor(at / PAGE).alias("page"), (F.col("anchors") + F.col("part_anchors")).alias("first_anchor")).join(cut.drop("part"), "block"), "index")


def met(left: DataFrame, right: DataFrame, own: str, other: str) -> DataFrame:
    """Each row of ``left`` once for every ``other`` of its length; ``right`` lists them as a range a length."""
    span = right.groupBy("dim").agg(F.min(other).alias("from"), F.max(other).alias("to"))
    return left.join(span, "dim").select(*left.columns, F.explode(F.sequence("from", "to")).alias(other))


def chosen(packs: DataFrame, zones: DataFrame, negatives: bool) -> DataFrame:
    """(pack, block, who): blocks that some anchor of a pack must read, and the places of these anchors in the pack."""

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            a = Anchors(left)
            low, high = (matrix(right.column(c), len(right)).astype(np.int64) for c in ("low", "high"))
            least, most = zone_bounds(a.v, low, high)
            for j, (block, chunk, labels) in enumerate(zip(right.column("block").to_pylist(), right.column("chunk").to_pylist(), right.column("labels").to_pylist(), strict=True)):
                if negatives:
                    need = np.zeros(len(a.label), bool)
                    for k in range(a.floor.shape[1]):
                        need |= (100 * most[:, j] >= LOW * a.floor[:, k]) & (100 * least[:, j] <= HIGH * a.floor[:, k]) & a.has[:, k]
                    need &= (a.label != labels[0]) if len(labels) == 1 else True
                else:
                    need = (most[:, j] >= a.floor[:, 0]) & np.isin(a.label, labels)
                if need.any():
                    out.append((a.dim, a.pack, block, chunk, np.flatnonzero(need).astype(np.int32)))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        return pa.table([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], ["dim", "pack", "block", "chunk", "who"])

    key = ["dim", "pack", "page"]
    pages = zones.select("dim", "page", "block", "chunk", "low", "high", "labels")
    left, right = met(packs, zones, "pack", "page"), met(pages, packs, "page", "pack")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(choose, "dim int, pack long, block long, chunk long, who array<int>")


class Anchors:
    """Anchors of a pack; ``floor`` holds the score their positives must reach, or the scores of their positives."""

    def __init__(self, table: pa.Table):
        self.pack, self.dim = table.column("pack")[0].as_py(), table.column("dim")[0].as_py()
        rows = table.column("rows").combine_chunks().flatten()
        n = len(rows)
        self.key, self.label = rows.field("key").to_numpy(), rows.field("label").to_numpy()
        self.v = matrix(rows.field("v"), n).astype(np.int64)
        given = rows.field("floor").to_pylist()
        width = max(map(len, given))
        self.floor, self.has = np.zeros((n, width), np.int64), np.zeros((n, width), bool)
        for i, x in enumerate(given):
            self.floor[i, : len(x)], self.has[i, : len(x)] = x, True


def found(packs: DataFrame, needed: DataFrame, index: DataFrame, negatives: bool, keep: int) -> DataFrame:
    """(key, window, row, id, score): the first ``keep`` rows of each chunk for an anchor, or for each of its windows."""

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            a, n = Anchors(left), right.column("n").to_numpy()
            ids, labels = (np.concatenate([x.values.to_numpy() for x in right.column(c)]) for c in ("ids", "row_labels"))
            rows = np.concatenate([(b << ROW_BITS) + np.arange(k) for b, k in zip(right.column("block").to_pylist(), n.tolist(), strict=True)])
            # Equal scores are told apart by id, so the columns stand in the order of ids.
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            scores, seen, start = np.zeros((len(a.label), len(ids)), np.int64), np.zeros((len(a.label), len(ids)), bool), 0
            for k, who, v in zip(n.tolist(), right.column("who"), right.column("v"), strict=True):
                who, to = who.values.to_numpy(), place[start : start + k]
                scores[np.ix_(who, to)] = products(a.v[who], v.values.to_numpy().reshape(k, -1).astype(np.int64))
                seen[np.ix_(who, to)] = True
                start += k
            ids, labels, rows = ids[order], labels[order], rows[order]
            for i, key in enumerate(a.key.tolist()):
                fits = seen[i] & ((labels != a.label[i]) if negatives else (labels == a.label[i]) & (rows != key))
                at = np.flatnonzero(fits)
                if not negatives:
                    at = at[scores[i, at] >= a.floor[i, 0]]
                s = scores[i, at]
                best = np.argsort(-s, kind="stable")
                at, s = at[best], s[best]
                for k in np.flatnonzero(a.has[i]).tolist() if negatives else [0]:
                    # A window is a stretch of the scores in order.
                    first = int(np.searchsorted(-100 * s, -HIGH * a.floor[i, k])) if negatives else 0
                    stop = int(np.searchsorted(-100 * s, -LOW * a.floor[i, k], "right")) if negatives else len(s)
                    out += [(key, k, int(rows[j]), int(ids[j]), int(x)) for j, x in zip(at[first : min(stop, first + keep)], s[first : min(stop, first + keep)], strict=True)]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], ["key", "window", "row", "id", "score"])

    key = ["dim", "pack", "chunk"]
    sent = needed.join(index.select("block", "n", "ids", "row_labels", "v"), "block")
    left = packs.join(needed.select("dim", "pack", F.col("chunk").alias("chunk")).distinct(), ["dim", "pack"])
    best = left.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(read, "key long, window int, row long, id long, score long")
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id", "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    ident: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows ``is_anchor`` holds for (a
    column of ``id``)."""
    rows = usable(vectors, ident, F.col("label") if label is None else label, vector)
    index = indexed(rows, is_anchor, positives)
    asks = F.filter(F.transform("asks", lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    picked = index.where("n_anchors > 0").select("dim", "block", "first_anchor", "ids", "row_labels", "v", "floors", F.posexplode(asks).alias("nth", "i"))
    width = F.col("dim")
    anchors = picked.select(
        "dim",
        F.floor((F.col("first_anchor") + F.col("nth")) / PACK).alias("pack"),
        (F.shiftleft("block", ROW_BITS) + F.col("i")).alias("key"),
        F.get("ids", "i").alias("id"),
        F.get("row_labels", "i").alias("label"),
        F.slice("v", F.col("i") * width + 1, width).alias("v"),
        F.array(F.get("floors", "i")).alias("floor"),
    )
    anchors = materialise(anchors, "anchors")

    def packs(of: DataFrame) -> DataFrame:
        # A pack has one range of the curve, and PACK anchors at most.
        return materialise(of.groupBy("dim", "pack").agg(F.array_sort(F.collect_list(F.struct("key", "label", "v", "floor"))).alias("rows")), "packs")

    first = packs(anchors)
    best = found(first, materialise(chosen(first, index, False), "chosen"), index, False, positives)
    best = materialise(best.select("key", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = best.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("window", "positive_score"))), lambda x: x["positive_score"]).alias("floor"))
    second = packs(anchors.drop("floor").join(scores, "key"))
    hard = found(second, materialise(chosen(second, index, True), "chosen"), index, True, negatives)
    hard = hard.select("key", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = hard.join(best, ["key", "window"]).join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
    known = lambda c: F.nullif(F.col(c), F.lit(int(NO_ID))).alias(c)
    return named.select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")
