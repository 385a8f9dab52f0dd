"""Packing of token ids into rows of fixed length.

A document longer than a row is cut into whole rows and a rest, losing nothing. The rests of a shard are packed best fit
decreasing: longest first, each into the open row with the least room that still takes it, found in a segment tree over
the amounts of room. A shard is a run of SHARD_TOKENS of one partition, so memory is bounded and no row depends on
another partition.

:func:`write` stores each shard as two binary files, made by the task that packs it: the id matrix for training to map
into memory, and the arrays that describe its rows. :func:`read` gives the rows back.

Defined cases: a null or empty text has no ids and is in no row. Repeated rows are packed each. A document without id is
listed with a null. Other columns are ignored. An empty table, and one without any id, gives no rows and no files.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsynth.llm import bpe
from docsynth.llm.arrays import slices

ROW_TOKENS = 2048
SHARD_TOKENS = 4_000_000
#: Words kept by a task; nothing else runs beside the packing, so it may keep more.
KEPT = 400_000
#: Fixed value of the vocabulary: the end-of-text token fills what is left of a row.
PAD = 49_407

SCHEMA = (
    "shard long, row long, n_tokens int, ids binary, cumulative array<int>, position_resets array<int>, doc_ids array<long>, doc_starts array<long>"
)
#: Lists of a row that stand beside its ids.
SCHEMA_LISTS = ("cumulative", "position_resets", "doc_ids", "doc_starts")

MANIFEST = "shard long, name string, row_tokens int, n_rows long, n_tokens long, n_segments long, ids_sha256 string"
#: Shards that a task of the reader takes on average, and rows in a batch of it.
READ_SHARDS, READ_ROWS = 8, 512


class Room:
    """Segment tree over amounts of room: how many open rows have an amount, and the least amount from a value on."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def least(self, room: int) -> int:
        """Smallest amount of at least ``room``, or -1."""
        at, count = room + self.size, self.count
        if count[at]:
            return room
        # Up until a right neighbour holds something, then down to its first.
        while at > 1:
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at + (not count[2 * at])
                return at - self.size
            at >>= 1
        return -1


def best_fit(lengths: list[int], row: int) -> list[list[int]]:
    """Rows as lists of places in ``lengths``: longest first, into the fullest row that takes it; ties keep their order."""
    tree, open_rows = Room(row), [[] for _ in range(row + 1)]
    rows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        room = tree.least(n)
        if room < 0:
            at, room = len(rows), row
            rows.append([])
        else:
            at = open_rows[room].pop()
            tree.add(room, -1)
        rows[at].append(i)
        if room > n:
            open_rows[room - n].append(at)
            tree.add(room - n, 1)
    return rows


def shard_rows(docs: list[tuple[int | None, np.ndarray]], row: int, pad: int) -> Iterator[tuple]:
    """(n_tokens, ids, cumulative, resets, doc_ids, doc_starts) of the rows of one shard."""
    rests, lengths = [], []
    for ident, ids in docs:
        whole = len(ids) // row * row
        for at in range(0, whole, row):
            yield row, ids[at : at + row].tobytes(), [0, row], [0], [ident], [at]
        if whole < len(ids):
            rests.append((ident, whole, ids[whole:]))
            lengths.append(len(ids) - whole)
    for places in best_fit(lengths, row):
        parts = [rests[i] for i in places]
        ends = np.cumsum([len(p) for _, _, p in parts]).tolist()
        filled = np.full(row, pad, "<u4")
        filled[: ends[-1]] = np.concatenate([p for _, _, p in parts])
        yield ends[-1], filled.tobytes(), [0, *ends], [0, *ends[:-1]], [i for i, _, _ in parts], [s for _, s, _ in parts]


def pack(docs: DataFrame, path: str, row: int = ROW_TOKENS, shard: int = SHARD_TOKENS, pad: int = PAD) -> DataFrame:
    """Rows of ``row`` ids for the whole texts of ``docs`` (doc_id, text).

    ids: the row as little-endian unsigned 32-bit integers, filled up with ``pad`` after n_tokens; cumulative: where
    segments begin and the last one ends; position_resets: where positions start again from 0; doc_ids and doc_starts:
    which document a segment comes from and at which of its tokens it begins.
    """

    def task(batches):
        coder, held, tokens, number, at = bpe.loaded(path, KEPT), [], 0, 0, TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, number
            first, out = 0, []
            for r in shard_rows(held, row, pad):
                out.append(r)
                if len(out) == 1024:
                    yield batch(first, out)
                    first, out = first + len(out), []
            if out:
                yield batch(first, out)
            held, tokens, number = [], 0, number + 1

        def batch(first: int, out: list[tuple]) -> pa.RecordBatch:
            n, ids, cumulative, resets, doc_ids, starts = zip(*out, strict=True)
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([(at << 32) + number] * len(out), pa.int64()), pa.array(range(first, first + len(out)), pa.int64()), pa.array(n, pa.int32()), pa.array(ids, pa.binary()),
                 pa.array(cumulative, ints), pa.array(resets, ints), pa.array(doc_ids, longs), pa.array(starts, longs)],
                ["shard", "row", "n_tokens", "ids", "cumulative", "position_resets", "doc_ids", "doc_starts"],
            )

        for part in slices(batches, "text"):
            for ident, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = np.frombuffer(coder.encode(text or ""), "<u4")
                if len(ids):
                    held.append((ident, ids))
                    tokens += len(ids)
                if tokens >= shard:
                    yield from flush()
        yield from flush()

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)


def place_of(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder: any that pyarrow opens by its URI, or a mounted path."""
    return fs.FileSystem.from_uri(folder if "://" in folder else folder.removeprefix("file:"))


def rows_in(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, len(batch), 64):
            yield from batch.slice(at, 64).to_pylist()


def store(where: fs.FileSystem, folder: str, shard: int, rows: Iterable[dict]) -> tuple:
    """Files of one shard; a row of the manifest.

    ``.ids``: n_rows x row_tokens ids, little-endian unsigned 32-bit. ``.segments``: an Arrow file with
    the cumulative lengths, resets and origins of each row. The ids are written as they come,
    and both files get their names when they are whole, so a task that is lost or runs twice leaves no half file.
    """
    name, made = f"{shard:016x}", uuid.uuid4().hex
    digest, n_rows, n_tokens, n_segments, wide = hashlib.sha256(), 0, 0, 0, 0
    kinds = pa.schema([("row", pa.int64()), ("n_tokens", pa.int32()), ("cumulative", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64()))])
    held: list[dict] = []
    ids_at, segments_at = f"{folder}/{name}-{made}.ids.part", f"{folder}/{name}-{made}.segments.part"
    with where.open_output_stream(ids_at) as ids, where.open_output_stream(segments_at) as side, pa.ipc.new_file(side, kinds) as segments:
        for r in rows:
            matrix = r.pop("ids")
            ids.write(matrix)
            digest.update(matrix)
            wide = len(matrix) // 4
            n_rows, n_tokens, n_segments = n_rows + 1, n_tokens + r["n_tokens"], n_segments + len(r["doc_ids"])
            held.append(r)
            if len(held) == READ_ROWS:
                segments.write_batch(pa.RecordBatch.from_pylist(held, kinds))
                held = []
        if held:
            segments.write_batch(pa.RecordBatch.from_pylist(held, kinds))
    where.move(ids_at, f"{folder}/{name}.ids")
    where.move(segments_at, f"{folder}/{name}.segments")
    return shard, name, wide, n_rows, n_tokens, n_segments, digest.hexdigest()


def write(docs: DataFrame, path: str, folder: str, row: int = ROW_TOKENS, shard: int = SHARD_TOKENS, pad: int = PAD) -> DataFrame:
    """Packs ``docs`` as :func:`pack` does and stores the shards under ``folder``; returns their manifest.

    ``folder`` must be new, shared by driver and executors, and known to Spark and to pyarrow under this name. The
    manifest is written last: a folder without one is not whole.
    """
    columns = [f.split()[0] for f in MANIFEST.split(", ")]

    def task(batches):
        where, at = place_of(folder)
        where.create_dir(f"{at}/shards", recursive=True)
        for number, rows in groupby(rows_in(batches), lambda r: r["shard"]):
            made = store(where, f"{at}/shards", number, ({k: v for k, v in r.items() if k != "shard"} for r in rows))
            yield pa.RecordBatch.from_pylist([dict(zip(columns, made, strict=True))], kinds)

    kinds = pa.schema([(c, pa.string() if c in ("name", "ids_sha256") else pa.int32() if c == "row_tokens" else pa.int64()) for c in columns])
    pack(docs, path, row, shard, pad).mapInArrow(task, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that :func:`write` stored; ids that do not have the digest of the manifest are an error."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def task(batches):
        where, at = place_of(folder)
        for m in rows_in(batches):
            digest, size = hashlib.sha256(), 4 * m["row_tokens"]
            with where.open_input_stream(f"{at}/shards/{m['name']}.ids") as ids, where.open_input_file(f"{at}/shards/{m['name']}.segments") as side:
                segments = pa.ipc.open_file(side)
                for k in range(segments.num_record_batches):
                    part = segments.get_batch(k)
                    data = ids.read(size * len(part))
                    digest.update(data)
                    matrix = pa.array([data[i : i + size] for i in range(0, len(data), size)], pa.binary())
                    number = pa.array([m["shard"]] * len(part), pa.int64())
                    yield pa.RecordBatch.from_arrays([number, part["row"], part["n_tokens"], matrix, *(part[c] for c in SCHEMA_LISTS)], names)
                if digest.hexdigest() != m["ids_sha256"] or ids.read(1):
                    raise ValueError(f"shard {m['name']} is not as it was written")

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    tasks = manifest.count() // READ_SHARDS + 1
    return manifest.repartition(tasks, F.col("shard")).mapInArrow(task, SCHEMA)
