"""Near-duplicate groups by b-bit MinHash, confirmed on full sets.

A text is the set of the hashes of its n-grams; equal sets are one class. Each class has the minima of HASHES hash
functions. Rows of minima make band keys: classes that share a band key are candidates. Of every minimum its lowest BITS
bits are kept and packed as bit planes, so that the number of equal ones between two classes is a bit count; equal by
chance is one in 2**BITS, for which the estimate is corrected. Within a band, classes whose estimate allows a link are
joined to a forest, never listed as pairs.

Each class is first confirmed against the best parent that the forests give it, on the full sets. That leaves whole groups
of near copies connected. Where a group of candidates still falls apart, the classes outside its largest part are held
against all others of the group, estimate first and full set then, in tiles of bounded size: so work follows the strays,
not the square of the group. Links join parts, and parts are named after the smallest id.

A band key that very many classes share is split by hash, and the pieces are tied to its first class, so it is a group of
candidates whatever its size. Every link is confirmed on full sets. A pair at the least similarity shares no band with a
probability of 5e-8, and its estimate is too low with one of 1e-8; above it both fall fast.

Defined cases: null and empty texts have an empty set and link with nothing; fewer words than n are one n-gram. A document
without id takes part, but no group is named after it; a group without any id has a null name and all its documents are
kept. Repeated rows are copies: those of the smallest id are all kept, as their id is the name. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.llm.arrays import U64, as_long, map_text, runs, slices, stir, windows, words_of
from docsynth.llm.components import components
from docsynth.llm.keys import numbered
from docsynth.llm.sift import sifted
from docsynth.session import materialise

WORDS = 4
#: Least similarity as a fraction.
OVER, UNDER = 4, 5
#: Hash functions, rows of a band, and bits kept of a minimum.
HASHES, ROWS, BITS = 128, 4, 4
#: Equal minima below which a pair is left out: six deviations under what the least similarity lets expect.
_EXPECTED = 2.0**-BITS + (1 - 2.0**-BITS) * OVER / UNDER
LEAST_EQUAL = int(HASHES * _EXPECTED - 6 * (HASHES * _EXPECTED * (1 - _EXPECTED)) ** 0.5)
#: Classes of a band key that are compared at once, and n-grams of a block of a tile.
PIECE = 4096
BLOCK_GRAMS = 1_500_000

_FUNCTIONS = np.random.Generator(np.random.PCG64(77_003)).integers(0, 1 << 64, (2, HASHES), dtype=U64)
_FUNCTIONS[1] |= U64(1)


def gram_sets(col: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-grams of each text."""
    w = words_of(col)
    hashes = w.hashes(lower=True)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        k = min(WORDS, b - a)
        grams = windows(hashes[a:b], k) if k else hashes[:0]
        # One n-gram of fewer words is never one of n words.
        out.append(np.unique(stir(grams + U64(k)) if 0 < k < WORDS else grams))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Least value of each hash function over each set, which must not be empty."""
    out = np.empty((HASHES, len(sets)), U64)
    if sets:
        values, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])[:-1]])
        for j in range(HASHES):
            out[j] = np.minimum.reduceat((values ^ _FUNCTIONS[0, j]) * _FUNCTIONS[1, j], starts)
    return out.T


def band_keys(least: np.ndarray) -> np.ndarray:
    """One hash a band of ROWS minima, told apart by the number of the band."""
    bands = HASHES // ROWS
    out = stir(np.broadcast_to(np.arange(1, bands + 1, dtype=U64), (len(least), bands)).copy())
    for r in range(ROWS):
        out = stir(out ^ least[:, r::ROWS])
    return out


def signature(least: np.ndarray) -> np.ndarray:
    """Lowest bits of the minima as BITS planes of HASHES bits for each row."""
    low = stir(least.copy())
    planes = [np.packbits(((low >> U64(k)) & U64(1)).astype(bool), axis=1) for k in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1))


def planes_of(column: pa.ChunkedArray) -> np.ndarray:
    """Signatures as (rows, planes, 64-bit words)."""
    data = b"".join(x.as_py() for x in column)
    return np.frombuffer(data, U64).reshape(-1, BITS, HASHES // 64)


def equal_minima(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many minima agree, as far as the kept bits tell: planes that differ anywhere are counted."""
    return HASHES - np.bitwise_count(np.bitwise_or.reduce(one ^ others, axis=1)).sum(1, dtype=np.int64)


def similarity(equal: np.ndarray) -> np.ndarray:
    """Estimate of the similarity, corrected for what agrees by chance."""
    chance = 2.0**-BITS
    return (equal / HASHES - chance) / (1 - chance)


def sizes_allow(n: np.ndarray, other: np.ndarray) -> np.ndarray:
    return UNDER * np.minimum(n, other) >= OVER * np.maximum(n, other)


def sketched(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, set, bands, planes) of each row of ``docs`` (row, doc_id, text)."""

    def work(col: pa.Array) -> list:
        found = gram_sets(col)
        full = [i for i, g in enumerate(found) if len(g)]
        least = minima([found[i] for i in full])
        bands, planes = [None] * len(found), [None] * len(found)
        for i, b, p in zip(full, as_long(band_keys(least)), signature(least), strict=True):
            bands[i], planes[i] = b, p.tobytes()
        ids = [hashlib.blake2b(g.tobytes(), digest_size=16).digest() for g in found]
        return [np.array([len(g) for g in found], np.int64), ids, bands, planes]

    fields = [T.StructField("n", T.LongType()), T.StructField("set", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("planes", T.BinaryType())]
    return map_text(docs, "text", fields, work, keep=False)


def forest(ids: np.ndarray, n: np.ndarray, planes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(child, parent, equal minima): a forest over the pairs whose size and estimate allow a link."""
    left = np.arange(len(ids))
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            equal = equal_minima(planes[i], planes[left])
            near = (equal >= LEAST_EQUAL) & sizes_allow(n[left], n[i])
            yield from zip(ids[left[near]].tolist(), [int(ids[i])] * int(near.sum()), equal[near].tolist(), strict=True)
            todo += left[near][::-1].tolist()
            left = left[~near]


def candidates(classes: DataFrame) -> DataFrame:
    """(a, b, equal) for each class tied to another: forests of the bands, pieces of a large one tied to its first class
    (``equal`` null)."""
    dealt = materialise(classes.select("class", F.explode("bands").alias("key")), "bands")
    # Counted before anything is sent together: a key of very many classes is one row a task.
    keys = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min("class").alias("first")).where("times > 1")
    piece = F.pmod(F.xxhash64("class"), F.ceil(F.col("times") / PIECE).cast("long"))
    shared = dealt.join(keys, "key").select(F.xxhash64("key", piece).alias("piece"), "class", F.when(F.col("times") > PIECE, F.col("first")).alias("first"))
    members = materialise(shared, "shared").join(classes.select("class", "n", "planes"), "class")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "piece", 1024):
            piece, ids, n = (table.column(c).to_numpy() for c in ("piece", "class", "n"))
            planes, first = planes_of(table.column("planes")), table.column("first").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])).tolist()
            out = []
            for a, b in zip(starts, [*starts[1:], len(piece)], strict=True):
                out += forest(ids[a:b], n[a:b], planes[a:b])
                if first[a] is not None:
                    out.append((int(ids[a]), first[a], None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b", "equal"])

    ties = members.repartition("piece").sortWithinPartitions("piece", "class").mapInArrow(task, "a long, b long, equal long")
    return ties.where("a <> b").groupBy("a", "b").agg(F.max("equal").alias("equal"))


def full_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(class, planes, grams) of the rows that stand for classes; ``members``: (row, planes)."""
    joined = sifted(docs.select("row", "text"), members, "row").join(members, "row")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [g.tobytes() for g in gram_sets(part.column("text").fill_null(""))]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("planes"), pa.array(found, pa.binary())], ["class", "planes", "grams"])

    return joined.select("row", "planes", "text").mapInArrow(read, "class long, planes binary, grams binary")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on sorted arrays: UNDER * intersection >= OVER * union."""
    if not sizes_allow(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are links, by their full sets."""
    side = lambda name: sets.select(F.col("class").alias(name), F.col("grams").alias(f"grams_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(x.as_buffer(), U64) for x in batch.column(c)] for c in ("grams_a", "grams_b"))
            yield batch.select(["a", "b"]).filter(pa.array([linked(x, y) for x, y in zip(left, right, strict=True)], pa.bool_()))

    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(task, "a long, b long")


def tiles(parts: DataFrame) -> DataFrame:
    """(class, comp, tile, side) for the groups that fall into several parts: the classes outside the largest part
    (``side`` 0) meet all (1) in tiles of about BLOCK_GRAMS a side. ``parts``: (class, n, cluster, comp)."""
    sizes = parts.groupBy("cluster", "comp").agg(F.sum("n").alias("grams"))
    whole = sizes.groupBy("cluster").agg(F.count(F.lit(1)).alias("parts"), F.sum("grams").alias("grams"), F.max(F.struct("grams", "comp")).alias("most")).where("parts > 1")
    blocks = lambda grams: F.ceil(grams / BLOCK_GRAMS).cast("long")
    open_ = parts.join(whole.select("cluster", F.col("most.comp").alias("main"), blocks(F.col("grams")).alias("rights"), blocks(F.col("grams") - F.col("most.grams")).alias("lefts")), "cluster")
    block = lambda of: F.pmod(F.xxhash64("class"), F.col(of))
    every = lambda of: F.sequence(F.lit(0).cast("long"), F.col(of) - 1)
    tile = lambda left, right, side: F.struct(F.xxhash64("cluster", left, right).alias("tile"), F.lit(side).alias("side"))
    as_right = F.transform(every("lefts"), lambda left: tile(left, block("rights"), 1))
    as_left = F.transform(every("rights"), lambda right: tile(block("lefts"), right, 0))
    none = F.array().cast("array<struct<tile:bigint,side:int>>")
    dealt = F.concat(as_right, F.when(F.col("comp") != F.col("main"), as_left).otherwise(none))
    return open_.select("class", "comp", F.explode(dealt).alias("x")).select("class", "comp", "x.tile", "x.side")


def joints(tiled: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between classes of different parts, as many as join the parts that a tile can join."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile", 256):
            tile, side, ids, comp = (table.column(c).to_numpy() for c in ("tile", "side", "class", "comp"))
            grams = [np.frombuffer(x.as_buffer(), U64) for c in table.column("grams").chunks for x in c]
            planes, n = planes_of(table.column("planes")), np.array([len(g) for g in grams])
            starts, out = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])).tolist(), []
            for a, b in zip(starts, [*starts[1:], len(tile)], strict=True):
                part = comp[a:b].copy()
                right = np.flatnonzero(side[a:b] == 1)
                for i in np.flatnonzero(side[a:b] == 0).tolist():
                    near = right[sizes_allow(n[a + right], n[a + i]) & (part[right] != part[i])]
                    equal = equal_minima(planes[a + i], planes[a + near])
                    near = near[np.argsort(-equal, kind="stable")[: int((equal >= LEAST_EQUAL).sum())]]
                    while len(near):
                        j, near = int(near[0]), near[1:]
                        if linked(grams[a + i], grams[a + j]):
                            out.append((int(ids[a + i]), int(ids[a + j])))
                            part[part == part[j]] = part[i]
                            near = near[part[near] != part[i]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    sent = tiled.join(sets, "class").select("tile", "side", "class", "comp", "planes", "grams")
    return sent.repartition("tile").sortWithinPartitions("tile", "side", "class").mapInArrow(task, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row for each row of ``docs``."""
    texts = numbered(docs, "row", ["doc_id", "text"])
    rows = materialise(sketched(texts), "sketches")
    merged = rows.where("n > 0").groupBy("set").agg(F.min("row").alias("class"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
    classes = materialise(merged, "classes")
    ties = materialise(candidates(classes), "ties")
    clusters = components(ties.select("a", "b")).select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    members = materialise(clusters.join(classes.select("class", "n", "planes"), "class"), "members")
    sets = materialise(full_sets(texts, members.select(F.col("class").alias("row"), "planes")), "sets")
    # Each class against its best parent, and the pieces of large bands against what they are tied to.
    best = ties.where("equal IS NOT NULL").groupBy("a").agg(F.max_by("b", F.struct("equal", "b")).alias("b"))
    first = materialise(confirmed(best.union(ties.where("equal IS NULL").select("a", "b")).distinct(), sets), "confirmed")
    comps = components(first).select(F.col("node").alias("class"), F.col("root").alias("comp"))
    parts = materialise(members.join(comps, "class", "left").select("class", "n", "cluster", F.coalesce("comp", "class").alias("comp")), "parts")
    more = materialise(joints(tiles(parts), sets), "joints")
    # The first links are within parts, so only parts are joined now.
    of = lambda name: parts.select(F.col("class").alias(name), F.col("comp").alias(f"comp_{name}"))
    joined = components(more.join(of("a"), "a").join(of("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    roots = parts.join(joined.select(F.col("node").alias("comp"), "root"), "comp", "left").select("class", F.coalesce("root", "comp").alias("root"))
    named = classes.select("set", "class", "least").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    out = rows.join(named.join(names, "root").select("set", "component_id"), "set", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
