"""Nearest neighbours by inner product: exact, from blocks of int8 products with error bounds.

Vectors are packed into blocks, and every block of queries meets every block of candidates in one task. Within such a
tile the integer product of the quantised vectors, with a bound of what quantisation may have changed, gives an upper
and a lower bound of each inner product. A pair whose upper bound is below the K-th best value so far (at first: the
K-th best lower bound) is dropped; the others are computed again from the original numbers in double precision, one
dimension after the other, and go through a heap of K for each query.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do rows
without id. Vectors of different length are never compared. Rows that share an id are different rows: each is a candidate
of the other, and each that is a query has its own ranks from 1. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.llm.arrays import fresh
from docsynth.llm.keys import numbered
from docsynth.session import materialise

NEAREST = 20
#: Vectors of a block, about: of queries and of candidates; and how many of each are multiplied at once.
QUERIES, CANDIDATES = 4096, 8192
STEP = 1024
#: Slack for rounding in single precision, relative to the product of lengths.
ROUNDING = 1e-6
#: Longest vectors whose int8 products are exact in single precision.
SINGLE = (1 << 24) // (127 * 127)


def usable(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """(row, id, v, dim) of the vectors that take part."""
    key = fresh(vectors, "row")
    rows = numbered(vectors, key, [ident, vector])
    rows = rows.select(F.col(key).alias("row"), F.col(ident).cast("long").alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.where(finite & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def packed(rows: DataFrame, counts: DataFrame, blocks: str) -> DataFrame:
    """(dim, block, rows): lists of vectors; ``counts`` names for each length the number of blocks."""
    dealt = rows.join(counts.select("dim", F.col(blocks).alias("n")), "dim").withColumn("block", F.pmod(F.xxhash64("row"), "n"))
    return dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("row", "id", "v")).alias("rows"))


class Block:
    """Vectors of a block with their quantised form, in the order of their rows."""

    def __init__(self, table: pa.Table):
        rows = table.column("rows").combine_chunks().flatten()
        ids = rows.field("id").to_numpy()
        vectors = rows.field("v").flatten().to_numpy().reshape(len(ids), -1)
        order = np.argsort(rows.field("row").to_numpy())
        self.rows, self.ids, self.vectors = rows.field("row").to_numpy()[order], ids[order], vectors[order]
        self.scale = np.abs(self.vectors).max(1) / 127
        self.small = np.rint(self.vectors / self.scale[:, None]).astype(np.int8)
        near = self.small * self.scale[:, None]
        self.off, self.near, self.length = (np.linalg.norm(x, axis=1) for x in (self.vectors - near, near, self.vectors))


def bounds(q: Block, c: Block, qs: slice, cs: slice) -> tuple[np.ndarray, np.ndarray]:
    """Product of the quantised vectors, and how far the true inner product can be from it."""
    kind = np.float32 if q.small.shape[1] <= SINGLE else np.float64
    product = (q.small[qs].astype(kind) @ c.small[cs].astype(kind).T).astype(np.float64)
    product *= q.scale[qs, None]
    product *= c.scale[cs]
    error = np.outer(q.off[qs], c.length[cs]) + np.outer(q.near[qs], c.off[cs]) + ROUNDING * np.outer(q.length[qs], c.length[cs])
    return product, error


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed dimension after dimension."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def nearest(q: Block, c: Block, k: int) -> list[list[tuple[float, int, int]]]:
    """For each query of a tile its k best (score, minus id, minus row)."""
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in q.ids]
    with np.errstate(over="ignore", invalid="ignore"):
        for a in range(0, len(q.ids), STEP):
            qs = slice(a, min(a + STEP, len(q.ids)))
            least = np.full(qs.stop - a, -np.inf)
            for b in range(0, len(c.ids), STEP):
                cs = slice(b, min(b + STEP, len(c.ids)))
                product, error = bounds(q, c, qs, cs)
                own = q.rows[qs, None] == c.rows[cs]
                floor = least
                if cs.stop - b > k:
                    low = np.where(own, -np.inf, product - error)
                    floor = np.fmax(least, np.partition(low, -k, axis=1)[:, -k])
                left, right = np.nonzero(~(product + error < floor[:, None]) & ~own)
                scores = exact(q.vectors[a + left], c.vectors[b + right])
                for i, j, row, s in zip(left.tolist(), c.ids[b + right].tolist(), c.rows[b + right].tolist(), scores.tolist(), strict=True):
                    heap = heaps[a + i]
                    if len(heap) < k:
                        heapq.heappush(heap, (s, -j, -row))
                    elif (s, -j, -row) > heap[0]:
                        heapq.heapreplace(heap, (s, -j, -row))
                least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[qs]])
    return heaps


def search(vectors: DataFrame, is_query: Column, ident: str = "vec_id", vector: str = "embedding", k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row that ``is_query`` holds for (a column of ``id``)."""
    rows = usable(vectors, ident, vector)
    asked = F.coalesce(is_query, F.lit(False))
    counts = rows.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / CANDIDATES).cast("long").alias("c_blocks"),
        F.ceil(F.count(F.when(asked, 1)) / QUERIES).cast("long").alias("q_blocks"),
    )

    # Packs are written: both sides of the tiles read them, each once for every block of the other.
    def spread(packs: DataFrame, other: str, own_name: str, other_name: str) -> DataFrame:
        """Each block once for every block of the other side."""
        to = counts.where(F.col(other) > 0).select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other_name))
        return packs.withColumnRenamed("block", own_name).join(to, "dim")

    queries = spread(materialise(packed(rows.where(asked), counts, "q_blocks"), "queries"), "c_blocks", "q", "c")
    found = spread(materialise(packed(rows, counts, "c_blocks"), "vectors"), "q_blocks", "c", "q")

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            q, c = Block(left), Block(right)
            out = [(r, i, -j, -n, s) for r, i, heap in zip(q.rows.tolist(), q.ids.tolist(), nearest(q, c, k), strict=True) for s, j, n in heap]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["query_row", "query_id", "vec_id", "row", "score"])

    key = ["dim", "q", "c"]
    best = queries.groupBy(*key).cogroup(found.groupBy(*key)).applyInArrow(tile, "query_row long, query_id long, vec_id long, row long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
