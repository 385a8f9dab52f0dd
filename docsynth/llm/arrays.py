"""Helpers for work on Arrow batches inside Spark tasks: slices of texts, word boundaries and hashes, sorted runs.

A word is a maximal run of bytes other than space and 0x09 to 0x0D. All functions work on whole texts; memory follows
the slice (a few MB of text, or one text if that is longer), never the partition.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text handled at once.
SLICE = 2_000_000
#: Longest word hashed in lanes of eight bytes; longer ones are hashed one by one.
LANES = 64
#: Words hashed at once; sized for the processor's cache.
GROUP = 1 << 13

#: Folder of the package.
ROOT = str(Path(__file__).resolve().parent.parent.parent)

U64 = np.uint64
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_LEFT, _RIGHT, _STIR, _STIR2 = (U64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NO_HASH = np.empty(0, U64)


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where they share the driver's file system but not its search path."""
    known = spark.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known.get("PYTHONPATH", "")]))
    return spark


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``most`` bytes of text; a longer text stands alone."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        size = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(size), 0
        while start < len(batch):
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    # Workers are used again: what the texts of this task took goes back to the machine.
    pa.default_memory_pool().release_unused()


def map_text(df: DataFrame, text: str, fields: list[T.StructField], work: Callable[[pa.Array], list], keep: bool = True) -> DataFrame:
    """Every row of ``df`` with new columns that ``work`` makes from slices of its text column (nulls become empty).

    Without ``keep`` the text itself is left out of the result.
    """
    kept = [f for f in df.schema.fields if keep or f.name != text]
    schema = T.StructType([*kept, *fields])

    def task(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = [to_arrow_schema(T.StructType([f])).field(0).type for f in fields]
        names = schema.fieldNames()
        for part in slices(batches, text):
            col = part.column(part.schema.get_field_index(text)).fill_null("")
            made = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(work(col), kinds, strict=True)]
            old = [c for c, f in zip(part.columns, part.schema, strict=True) if keep or f.name != text]
            yield pa.RecordBatch.from_arrays([*old, *made], names)

    return df.mapInArrow(task, schema)


@dataclass
class Words:
    """Words of a slice of texts: byte bounds in ``data``, and the first word of each text (one more at the end)."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word; ``lower`` folds A-Z.

        Eight bytes at a time are mixed into the hash so far, which starts from the length, so words of the same length
        up to eight bytes never share one. Longer words than ``LANES`` bytes get a digest.
        """
        data = FOLD[self.data] if lower else self.data
        size = self.ends - self.starts
        out = np.empty(len(size), U64)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        lanes = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        for a in range(0, len(size), GROUP):
            starts, left = self.starts[a : a + GROUP], size[a : a + GROUP]
            hashes, at = stir(left.astype(U64) * _LEFT + _RIGHT), None
            while True:
                mixed = lanes[starts] & _MASKS[np.minimum(left, 8)]
                mixed ^= hashes if at is None else hashes[at]
                mixed *= _RIGHT
                mixed = stir(mixed)
                if at is None:
                    hashes = mixed
                else:
                    hashes[at] = mixed
                more = np.flatnonzero((left > 8) & (left <= LANES))
                if not len(more):
                    break
                at = more if at is None else at[more]
                starts, left = starts[more] + 8, left[more] - 8
            out[a : a + GROUP] = hashes
        for i in np.flatnonzero(size > LANES).tolist():
            word = data[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def stir(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h *= _STIR
    h ^= h >> U64(29)
    h *= _STIR2
    h ^= h >> U64(32)
    return h


def words_of(col: pa.Array) -> Words:
    """Find the words of a string column without nulls."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    _, where, what = col.buffers()
    offsets = np.frombuffer(where, np.int64)[col.offset : col.offset + len(col) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    data = np.frombuffer(what, np.uint8)[low:high] if what is not None and high > low else np.empty(0, np.uint8)
    offsets = offsets - low
    ink = ~SPACE[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens = ink.copy()
    opens[1:] &= ~ink[:-1]
    opens[edges] = ink[edges]
    closes = ink.copy()
    closes[:-1] &= ~ink[1:]
    closes[edges - 1] = ink[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` values from each place on, for the places where so many follow; doubling, so log k steps."""
    n, done, have, size, cur = len(words) - k + 1, None, 0, 1, words
    if n <= 0:
        return NO_HASH
    while True:
        if k & size:
            done = cur if done is None else stir(done[: len(cur) - have] * _LEFT + cur[have:] * _RIGHT + U64(size))
            have += size
        if have == k:
            return done[:n]
        cur = stir(cur[:-size] * _LEFT + cur[size:] * _RIGHT + U64(size + 1))
        size *= 2


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def runs(batches: Iterable[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``key`` from sorted batches, many short runs together; a run of any length is whole."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        col = batch.column(batch.schema.get_field_index(key))
        if rows < most or col[0] == col[-1]:
            continue
        ids = col.to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(ids[:-1] != ids[1:])[-1]) + 1
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held = [batch.slice(cut)]
        rows = len(held[0])
    if held:
        yield pa.Table.from_batches(held)
