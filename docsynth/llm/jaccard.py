"""Exact Jaccard join of word n-grams.

A document is the set of the hashes of its n-grams. Equal sets are one class. Two classes can only reach the least
similarity if they share several n-grams among the first of each, in an order that puts n-grams last the more common
their words are, and n-grams known to be frequent after all others: those first n-grams are dealt out by value. Where few
classes hold one, their pairs are counted; where many do, each is tied to one of them, and the tie only counts for a class
that has enough such n-grams to reach a link by them. Classes that share enough first n-grams form tiles. A tile is read by size: a class is held against those whose size allows a link, first by bitmaps of hashed n-grams, whose bit counts
bound the overlap from above, then by intersection of the sorted arrays. A large tile is split into blocks of bounded
size within bands of set size, and only pairs of blocks from the same or neighbouring bands are compared. Links are
counted where they are found and handed on as spanning trees, so no pair ever becomes a row.

Defined cases: null and empty texts have an empty set and link with nothing; fewer words than n are one n-gram. A
document without id takes part, but no class is named after it. Repeated rows are copies. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.llm.arrays import U64, as_long, fresh, map_text, runs, slices, stir, windows, words_of
from docsynth.llm.components import components
from docsynth.llm.keys import numbered
from docsynth.llm.sift import sifted, without
from docsynth.session import materialise, release

WORDS = 5
#: Least similarity as a fraction.
OVER, UNDER = 3, 4
#: A word is common if it makes up this share of all words, so the list has at most 1 / COMMON words.
COMMON = 1 / 16384
#: Levels of common words, each for words twice as common as the one below; an n-gram's sum of levels has RANK bits.
LEVELS, RANK = 12, 6
#: Bits of the table in which common words are looked up.
TABLE = 20
#: First n-grams found so often within slices of text count as frequent; at most so many are listed (8 bytes each).
FREQUENT, MOST_FREQUENT = 8, 1 << 20
#: Classes sharing one n-gram, up to which pairs are counted; more are tied to one of them. A first n-gram stands in
#: FEW / 2 pairs at most, so pairs grow with the texts whatever they have in common.
FEW = 8
#: First n-grams that a task packs at once, and those of a part on average, if that takes more parts than PARTS times the
#: shuffle's partitions; of a part, so many are unpacked at once.
PACK, PART, PARTS, UNPACK = 1_500_000, 500_000, 3, 2_000_000
#: n-grams of a block, and of a task's read of small tiles.
BLOCK_GRAMS = 1_500_000


def common_words(docs: DataFrame) -> np.ndarray:
    """Table over the low bits of word hashes: the level of common words, 0 for others; counted over all texts."""

    def task(batches):
        for part in slices(batches, "text"):
            words, times = np.unique(words_of(part.column("text").fill_null("")).hashes(lower=True), return_counts=True)
            # What is rare in a slice adds up to its total only.
            often = times >= COMMON / 4 * times.sum()
            words, times = np.append(words[often], U64(0)), np.append(times[often], times[~often].sum())
            yield pa.RecordBatch.from_arrays([pa.array(as_long(words)), pa.array(times)], ["word", "times"])

    counts = materialise(docs.select("text").mapInArrow(task, "word long, times long").groupBy("word").agg(F.sum("times").alias("times")), "words")
    total = counts.agg(F.sum("times")).first()[0] or 0
    listed = counts.where((F.col("word") != 0) & (F.col("times") >= COMMON * total)).toArrow()
    level = np.minimum(LEVELS, 1 + np.log2(listed.column("times").to_numpy() / max(1, COMMON * total)).astype(np.int64))
    table = np.zeros(1 << TABLE, np.uint8)
    np.maximum.at(table, (listed.column("word").to_numpy().view(U64) & U64((1 << TABLE) - 1)).astype(np.int64), level.astype(np.uint8))
    return table


def gram_sets(col: pa.Array, common: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-grams of each text; their top bits add up how common the words are."""
    w = words_of(col)
    hashes = w.hashes(lower=True)
    flags = np.concatenate([[0], np.cumsum(common[(hashes & U64((1 << TABLE) - 1)).astype(np.int64)], dtype=np.int64)])
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        k = min(WORDS, b - a)
        grams = windows(hashes[a:b], k) if k else hashes[:0]
        if 0 < k < WORDS:
            grams = stir(grams + U64(k))
        if k:
            rank = (flags[a + k : b + 1] - flags[a : b - k + 1]).astype(U64)
            grams = (grams >> U64(RANK)) | (rank << U64(64 - RANK))
        out.append(np.unique(grams))
    return out


def set_ids(grams: np.ndarray) -> tuple[int, int]:
    """Two independent halves of a 128-bit digest of a set."""
    digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def set_id(grams: np.ndarray, shared: frozenset[int]) -> int:
    """The first half, or the second where different sets share the first."""
    first, second = set_ids(grams)
    return second if first in shared else first


def more(n: np.ndarray) -> np.ndarray:
    """n-grams beyond the first that a pair must share among its first ones; weeds out pairs that share few by chance."""
    return n // 16


def least_partner(n: np.ndarray) -> np.ndarray:
    """n-grams of the smallest set that one of n can be linked with."""
    return (OVER * n + UNDER - 1) // UNDER


def first_grams(n: np.ndarray) -> np.ndarray:
    """A linked pair shares at least 3/4 of the larger set, so it shares 1 + more among this many first n-grams."""
    return np.minimum(n, n - least_partner(n) + 1 + more(n))


def sets(docs: DataFrame, common: Broadcast) -> DataFrame:
    """(row, doc_id, n, set, check): number of n-grams and digest of the set of each row of ``docs`` (row, doc_id, text)."""

    def work(col: pa.Array) -> list:
        found = gram_sets(col, common.value)
        ids = np.array([set_ids(g) for g in found], np.int64).reshape(-1, 2)
        return [np.array([len(g) for g in found], np.int64), ids[:, 0].copy(), ids[:, 1].copy()]

    return map_text(docs, "text", [T.StructField(c, T.LongType()) for c in ("n", "set", "check")], work, keep=False)


def shared_ids(rows: DataFrame) -> frozenset[int]:
    """First halves of a digest that different sets have in common: none among 10**9 sets, a handful among 10**10."""
    twins = rows.groupBy("set").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a <> b").select("set").toArrow()
    return frozenset(twins.column("set").to_pylist())


def frequent(docs: DataFrame, common: Broadcast) -> np.ndarray:
    """Hashes of frequent n-grams, sorted: counted over all texts, from those that a slice of texts has at least twice.

    n-grams beyond twice the first ones of a set stand late anyhow and are not counted. The list only steers the order
    of n-grams, on which the result does not depend.
    """

    def task(batches):
        for part in slices(batches, "text", 4_000_000):
            early = (g[: 2 * int(first_grams(np.int64(len(g))))] for g in gram_sets(part.column("text").fill_null(""), common.value))
            seen = {g.tobytes(): g for g in early}
            if seen:
                grams, times = np.unique(np.concatenate(list(seen.values())), return_counts=True)
                often = times > 1
                yield pa.RecordBatch.from_arrays([pa.array(as_long(grams[often])), pa.array(times[often])], ["gram", "times"])

    rows = docs.select("text").mapInArrow(task, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times"))
    listed = rows.where(F.col("times") >= FREQUENT).orderBy(F.desc("times"), "gram").limit(MOST_FREQUENT).select("gram").toArrow()
    return np.sort(listed.column("gram").to_numpy().view(U64))


def planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes and so on, which packs well where values are close."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: memoryview, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


def packed(gram: np.ndarray, ident: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row (part, rows, data) for each part of the range of hashes of n-grams; within it, n-grams ascend."""
    key = stir(gram)
    order = np.argsort(key)
    key, ident, n = key[order], ident[order], n[order]
    part = ((key >> U64(32)) * U64(parts)) >> U64(32)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    steps = np.diff(key, prepend=U64(0))
    steps[starts] = key[starts]
    data = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
        data.append(pa.compress(planes(steps[a:b]) + planes(ident[a:b]) + planes(n[a:b]), codec="zstd", asbytes=True))
    rows = np.diff(np.append(starts, len(key)))
    return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int64)), pa.array(rows), pa.array(data, pa.binary())], PACKED)


PACKED = ["part", "rows", "data"]
WIDTH = 8 + 8 + 4


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending hashes of n-grams, sets and sizes, as they were packed."""
    raw = memoryview(pa.decompress(data, n * WIDTH, codec="zstd", asbytes=True))
    return np.cumsum(from_planes(raw[: 8 * n], U64, n), dtype=U64), from_planes(raw[8 * n : 16 * n], np.int64, n), from_planes(raw[16 * n :], np.int32, n)


def postings(docs: DataFrame, common: Broadcast, often: np.ndarray, twins: frozenset[int], parts: int) -> DataFrame:
    """Packed (gram, set, n) for the first n-grams of each set; a task gives each set once."""
    shared = docs.sparkSession.sparkContext.broadcast(often)  # MOST_FREQUENT at most

    def task(batches):
        often, seen, held, size = shared.value, set(), [], 0
        for part in slices(batches, "text"):
            for g in gram_sets(part.column("text").fill_null(""), common.value):
                if not len(g) or (ident := set_id(g, twins)) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(ident)
                if len(often):
                    late = often[np.minimum(np.searchsorted(often, g), len(often) - 1)] == g
                    g = np.concatenate([g[~late], g[late]]) if late.any() else g
                first = g[: int(first_grams(np.int64(len(g))))].copy()
                held.append((first, np.full(len(first), ident), np.full(len(first), len(g), np.int32)))
                size += len(first)
            if size >= PACK:
                yield packed(*map(np.concatenate, zip(*held, strict=True)), parts)
                held, size = [], 0
        if held:
            yield packed(*map(np.concatenate, zip(*held, strict=True)), parts)

    return docs.select("text").mapInArrow(task, "part long, rows long, data binary")


def unpacked_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, set, n) sorted by gram, n and set, without n-grams of one row, from packed rows sorted by part."""
    for table in runs(batches, "part", 1):
        part, rows, data = table.column("part").to_numpy(), table.column("rows").to_pylist(), table.column("data").to_pylist()
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
        for a, b in zip(starts, [*starts[1:], len(part)], strict=True):
            yield from by_gram(list(zip(data[a:b], rows[a:b], strict=True)))


def by_gram(of: list[tuple[bytes, int]], low: int = 0, high: int = (1 << 64) - 1) -> Iterator[pa.RecordBatch]:
    """Rows of a part with hashes from ``low`` to ``high``. Of too many, those below, at and above a middle one come in
    turn, and those of a single hash as they were packed, so memory does not grow with the sets that hold an n-gram."""

    def cut(data: bytes, n: int) -> tuple[np.ndarray, ...]:
        found = unpacked(data, n)
        a, b = np.searchsorted(found[0], U64(low)), np.searchsorted(found[0], U64(high), "right")
        return tuple(x[a:b] for x in found)

    if sum(n for _, n in of) <= UNPACK:
        yield from repeated(*map(np.concatenate, zip(*(cut(*x) for x in of), strict=True)))
    elif low == high:
        for x in of:
            yield batch_of(*cut(*x))
    else:
        found = [(x, cut(*x)[0]) for x in of]
        # Rows of which nothing is in the range are left out from here on.
        inside = [(x, int(key[len(key) // 2]), len(key)) for x, key in found if len(key)]
        if sum(n for *_, n in inside) <= UNPACK:
            yield from repeated(*map(np.concatenate, zip(*(cut(*x) for x, *_ in inside), strict=True))) if inside else ()
            return
        del found
        middle = sorted(m for _, m, _ in inside)[len(inside) // 2]
        for a, b in ((low, middle - 1), (middle, middle), (middle + 1, high)):
            if a <= b:
                yield from by_gram([x for x, *_ in inside], a, b)


def batch_of(key: np.ndarray, ident: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """The sign is turned, so that hashes ascend as signed numbers too."""
    return pa.RecordBatch.from_arrays([pa.array(as_long(key ^ U64(1 << 63))), pa.array(ident), pa.array(n)], ["gram", "set", "n"])


def repeated(key: np.ndarray, ident: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    kept = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    key, ident, n = key[kept], ident[order[kept]], n[order[kept]]
    if len(key):
        order = np.lexsort((ident, n, key))
        yield batch_of(key[order], ident[order], n[order])


PAIRS = ["a", "b", "need", "times", "least"]


def tied(centers: np.ndarray, to: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Ties of sets to the center of an n-gram that many hold; ``least`` is what a set must share with any partner."""
    least = (1 + more(least_partner(n.astype(np.int64)))).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(centers), pa.array(to), pa.nulls(len(to), pa.int64()), pa.array(np.ones(len(to), np.int64)), pa.array(least)], PAIRS)


def group_pairs(gram: np.ndarray, ident: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of the sets of each n-gram if they are few, ties of all to the smallest, which is the first, if they are many."""
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(gram)]]))
    left, right = [], []
    after = np.repeat(np.where(sizes <= FEW, starts + sizes, 0), sizes) - np.arange(len(gram))
    for k in range(1, min(FEW, int(after.max()))):
        # Pairs k apart within a group of few.
        at = np.flatnonzero(after > k)
        at = at[OVER * np.maximum(n[at], n[at + k]) <= UNDER * np.minimum(n[at], n[at + k])]
        left.append(at)
        right.append(at + k)
    if any(map(len, left)):
        left, right = np.concatenate(left), np.concatenate(right)
        need = (1 + np.minimum(more(n[left]), more(n[right]))).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (ident[left], ident[right], need, np.ones(len(left), np.int64))), pa.nulls(len(left), pa.int64())], PAIRS)
    many = np.repeat(sizes > FEW, sizes)
    if many.any():
        yield tied(np.repeat(ident[starts], sizes)[many], ident[many], n[many])


def candidate_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and ties from (gram, set, n) sorted by gram, n and set. Of an n-gram that runs on over many batches only the
    set that the others are tied to is remembered."""
    gram, ident, n = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    many: tuple[int, int] | None = None
    for batch in batches:
        gram, ident, n = (np.concatenate([old, batch.column(c).to_numpy()]) for c, old in zip(("gram", "set", "n"), (gram, ident, n), strict=True))
        if many is not None:
            go = int(np.searchsorted(gram, many[0], "right"))
            if go:
                yield tied(np.full(go, many[1]), ident[:go], n[:go])
            gram, ident, n = gram[go:], ident[go:], n[go:]
        if not len(gram):
            continue
        many = None
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (ident[1:] != ident[:-1])
        gram, ident, n = gram[new], ident[new], n[new]
        last = int(np.searchsorted(gram, gram[-1]))
        if len(gram) - last > FEW:
            many, last = (int(gram[-1]), int(ident[last])), len(gram)
        if last:
            yield from group_pairs(gram[:last], ident[:last], n[:last])
        gram, ident, n = gram[last:], ident[last:], n[last:]
    if len(gram):
        yield from group_pairs(gram, ident, n)


def candidates(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of sets that may share enough first n-grams, and ties that stand for such pairs.

    Of the first n-grams that a pair shares, those held by few are counted for the pair, and those held by many for each
    set alone, which bounds them for its pairs. So a pair without a count needs two sets that hold enough n-grams of
    many, and they are tied to the same center; a pair with a count needs what it lacks from what both hold of many.
    A center that holds too few itself is no part of the tile: sets are tied to a number made from the center's.
    """
    found = rows.repartition("part").sortWithinPartitions("part").mapInArrow(lambda x: candidate_batches(unpacked_batches(x)), "a long, b long, need long, times long, least long")
    found = found.select("a", "b", F.col("need").isNull().alias("tie"), F.coalesce("need", "least").alias("need"), "times")
    shared = materialise(found.groupBy("a", "b", "tie").agg(F.min("need").alias("need"), F.sum("times").alias("times")), "shared")
    ties, pairs = shared.where("tie"), shared.where("NOT tie")
    held = materialise(ties.groupBy("b").agg(F.sum("times").alias("many"), F.min("need").alias("least")), "held")
    tied_to = ties.join(held.where("many >= least").select("b"), "b").select(F.xxhash64("a").alias("a"), "b")
    lacking = pairs.where("times < need")
    for side in ("a", "b"):
        lacking = lacking.join(held.select(F.col("b").alias(side), F.col("many").alias(f"many_{side}")), side)
    lacking = lacking.where("times + least(many_a, many_b) >= need")
    return pairs.where("times >= need").select("a", "b").union(lacking.select("a", "b")).union(tied_to)


def bitmap(grams: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, bool)
    out[(grams & U64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out).view(U64)


def bits_for(n: int) -> int:
    """Twice as many bits as n-grams, as a power of two from 64 to 65536."""
    return 1 << min(16, max(6, int(2 * n).bit_length()))


def compare(grams: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each class of ``left`` those of ``right`` after it in (size, place) that it is linked with.

    ``left`` and ``right`` are places in ``grams``, sorted by size; a pair within both is given once.
    """
    n = np.array([len(g) for g in grams], np.int64)
    both = np.unique(np.concatenate([left, right]))
    is_left, is_right = np.isin(both, left), np.isin(both, right)
    sizes = n[both]
    order = np.argsort(sizes, kind="stable")
    both, is_left, is_right, sizes = both[order], is_left[order], is_right[order], sizes[order]
    most = np.searchsorted(sizes, UNDER * sizes // OVER, "right")
    # Bitmaps as wide as suits the larger side of a stretch of similar sizes.
    at = 0
    while at < len(both):
        stop = max(at + 1, int(np.searchsorted(sizes, 2 * sizes[at], "left")))
        end = int(most[stop - 1])
        width = bits_for(int(sizes[end - 1]))
        maps = np.stack([bitmap(grams[i], width) for i in both[at:end]])
        counts = np.bitwise_count(maps).sum(1, dtype=np.int64)
        for i in range(at, stop):
            j = np.arange(i + 1, int(most[i]))
            if not len(j):
                continue
            j = j[(is_left[i] & is_right[j]) | (is_right[i] & is_left[j])]
            if not len(j):
                continue
            # Bits of one that the other lacks stand for n-grams that it lacks.
            common = np.bitwise_count(maps[i - at] & maps[j - at]).sum(1, dtype=np.int64)
            bound = np.minimum(sizes[i] - (counts[i - at] - common), sizes[j] - (counts[j - at] - common))
            j = j[(UNDER + OVER) * bound >= OVER * (sizes[i] + sizes[j])]
            j = j[linked(grams[both[i]], [grams[k] for k in both[j]])]
            if len(j):
                yield int(both[i]), both[j]
        at = stop


def linked(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Exact test on sorted arrays, a against each of the others: UNDER * intersection >= OVER * union.

    Two sorted arrays of distinct values share as many values as stand twice in a row once they are merged; against
    many others, their values are looked up in a table of a's lowest bits first.
    """
    if len(others) < 4:
        common = np.array([len(np.intersect1d(a, b, assume_unique=True)) for b in others], np.int64)
    else:
        bits = U64((1 << max(10, int(len(a) * 8).bit_length())) - 1)
        table = np.zeros(int(bits) + 1, bool)
        table[(a & bits).astype(np.int64)] = True
        sizes = np.array([len(b) for b in others])
        values = np.concatenate(others)
        maybe = np.flatnonzero(table[(values & bits).astype(np.int64)])
        found = values[maybe]
        at = np.searchsorted(a, found)
        at[at == len(a)] = 0
        common = np.bincount(np.repeat(np.arange(len(others)), sizes)[maybe[a[at] == found]], minlength=len(others))
    sizes = np.array([len(b) for b in others], np.int64)
    return UNDER * common >= OVER * (len(a) + sizes - common)


def tile_links(docs: DataFrame, common: Broadcast, members: DataFrame) -> DataFrame:
    """(a, b, links): for every class found linked within a tile, its tree's root and the linked rows it has there.

    ``members``: (row, set, copies, blocks) of the row that stands for a class, where blocks holds the keys of the tiles
    it goes to and on which side of each it stands (0 left, 1 right, 2 both).
    """
    joined = sifted(docs, members, "row").join(members, "row")

    def read(batches):
        for part in slices(batches, "text"):
            found = [g.tobytes() for g in gram_sets(part.column("text").fill_null(""), common.value)]
            yield pa.RecordBatch.from_arrays([part.column("set"), part.column("copies"), part.column("blocks"), pa.array(found, pa.binary())], ["set", "copies", "blocks", "grams"])

    block = "array<struct<tile:long,side:int>>"
    arrays = joined.select("text", "set", "copies", "blocks").mapInArrow(read, f"set long, copies long, blocks {block}, grams binary")
    dealt = arrays.select("set", "copies", "grams", F.explode("blocks").alias("x")).select("x.tile", "x.side", "set", "copies", "grams")

    def task(batches):
        for table in runs(batches, "tile", 256):
            tile, side, ident, copies = (table.column(c).to_numpy() for c in ("tile", "side", "set", "copies"))
            grams = [np.frombuffer(x.as_buffer(), U64) for c in table.column("grams").chunks for x in c]
            starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])).tolist()
            out: list[tuple[int, int, int]] = []
            for a, b in zip(starts, [*starts[1:], len(tile)], strict=True):
                at = np.arange(a, b)
                root, degree = list(range(b - a)), np.zeros(b - a, np.int64)

                def top(x: int, root: list[int] = root) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for i, hits in compare(grams, at[side[a:b] != 1], at[side[a:b] != 0]):
                    degree[i - a] += copies[hits].sum()
                    degree[hits - a] += copies[i]
                    for j in hits.tolist():
                        x, y = top(i - a), top(j - a)
                        if x != y:
                            root[max(x, y)] = min(x, y)
                out += [(int(ident[a + i]), int(ident[a + top(i)]), int(degree[i])) for i in np.flatnonzero(degree).tolist()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b", "links"])

    return dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(task, "a long, b long, links long")


def blocks(clustered: DataFrame) -> DataFrame:
    """Adds ``blocks`` to (cluster, set, n, ...): tiles of a cluster, one if it is small.

    Bands are a third apart in size, so that linked sets lie in the same or in neighbouring bands. A band is split by
    hash into blocks of about BLOCK_GRAMS; every pair of blocks of one band or of neighbouring bands is a tile.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(UNDER / OVER))).cast("long")
    rows = clustered.withColumn("band", band)
    bands = rows.groupBy("cluster", "band").agg(F.sum("n").alias("grams"))
    whole = bands.groupBy("cluster").agg(F.sum("grams").alias("total"))
    parts = bands.select("cluster", "band", F.ceil(F.col("grams") / BLOCK_GRAMS).cast("long").alias("parts"))
    large = whole.where(F.col("total") > BLOCK_GRAMS).select("cluster").join(parts, "cluster")
    of = lambda shift, name: large.select("cluster", (F.col("band") + shift).alias("band"), F.col("parts").alias(name))
    large = large.join(of(-1, "above"), ["cluster", "band"], "left").join(of(1, "below"), ["cluster", "band"], "left")
    rows = rows.join(large, ["cluster", "band"], "left")
    mine = F.pmod(F.xxhash64("set"), F.col("parts"))

    def tile(lower_band, lower_part, upper_band, upper_part, side):
        return F.struct(F.xxhash64("cluster", lower_band, lower_part, upper_band, upper_part).alias("tile"), side.cast("int").alias("side"))

    own = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda p: tile(F.col("band"), F.least(p, mine), F.col("band"), F.greatest(p, mine), F.when(p == mine, 2).when(p < mine, 1).otherwise(0)),
    )
    up = F.when(F.col("above").isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.col("above") - 1), lambda p: tile(F.col("band"), mine, F.col("band") + 1, p, F.lit(0))))
    down = F.when(F.col("below").isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.col("below") - 1), lambda p: tile(F.col("band") - 1, p, F.col("band"), mine, F.lit(1))))
    none = F.array().cast("array<struct<tile:long,side:int>>")
    split = F.concat(own, F.coalesce(up, none), F.coalesce(down, none))
    single = F.array(F.struct(F.xxhash64("cluster").alias("tile"), F.lit(2).alias("side")))
    return rows.withColumn("blocks", F.when(F.col("parts").isNull(), single).otherwise(split))


def join(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_shingles, component_id, n_links."""
    return grouped(numbered(docs, "row", ["doc_id", "text"])).drop("root")


def grouped(docs: DataFrame) -> DataFrame:
    """Rows of ``join`` for numbered documents (row, doc_id, text), with the root of their group, which tells groups apart
    whatever their ids; null without words."""
    common = docs.sparkSession.sparkContext.broadcast(common_words(docs))  # 2**TABLE bytes
    rows = materialise(sets(docs, common), "sets")
    twins = shared_ids(rows)
    if twins:
        rows = rows.withColumn("set", F.when(F.col("set").isin(*twins), F.col("check")).otherwise(F.col("set")))
    classes = rows.where("n > 0").groupBy("set").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    grams = rows.agg(F.sum("n")).first()[0] or 0
    parts = max(PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), grams // (3 * PART))  # about a third are first ones
    pairs = candidates(postings(docs, common, frequent(docs, common), twins, parts))
    release(docs.sparkSession)
    clusters = components(pairs).select(F.col("node").alias("set"), F.col("root").alias("cluster"))
    members = blocks(classes.join(clusters, "set")).select("row", "set", "copies", "blocks")
    found = materialise(tile_links(docs, common, materialise(members, "members")), "found")
    roots = components(found.select("a", "b")).select(F.col("node").alias("set"), "root")
    degrees = found.groupBy(F.col("a").alias("set")).agg(F.sum("links").alias("links"))
    classes = classes.join(roots, "set", "left").join(degrees, "set", "left").withColumn("root", F.coalesce("root", "set"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(names, "root").select("set", "root", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.join(named, "set", "left")
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "root")


def representatives(docs: DataFrame) -> DataFrame:
    """The documents with one of each linked group: the row of smallest id, and of these the first."""
    key = fresh(docs, "row_key")
    rows = numbered(docs, key)
    found = materialise(grouped(rows.select(F.col(key).alias("row"), "doc_id", "text")).where("n_shingles > 0").select("row", "doc_id", "root"), "joined")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("x")).select("x.row")
    gone = materialise(found.join(first, "row", "left_anti").select(F.col("row").alias(key)), "gone")
    return without(rows, gone, key).drop(key)
