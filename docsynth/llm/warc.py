"""WARC records and a Merkle audit of two replicas.

Pages become WARC/1.0 records in files of up to FILE_IDS page ids. Each record's bytes are hashed; a leaf of the tree is
the hash of the records that begin in one range of RANGE bytes, in order of offset, and a node above is the hash of up
to FAN neighbouring ranges. Two replicas are compared by the roots of their files, and only below nodes that differ the
next level is read, down to the records whose bytes differ or are missing.

:func:`write` stores the files, :func:`scan` reads the records of any folder of uncompressed WARC files from their
bytes, each replica with its own offsets, and :func:`compare` says of two such folders which records are damaged,
missing, extra or only moved because bytes before them were lost or added.

Defined cases: a null html is an empty body, a null url an empty target. Pages without id go to files of their own by
their content and keep the order of url and content. Repeated rows are separate records. No pages give no records.
Other columns are ignored. A record whose header is broken, or whose length leads nowhere, ends where the next one begins;
bytes before the first record are a record without id. An empty folder has no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsynth.llm.packing import place_of
from docsynth.session import materialise

FILE_IDS = 1000
#: Files for pages without id.
LOOSE_FILES = 4096
RANGE, FAN = 65_536, 16
DATE = "2024-01-01T00:00:00Z"
#: Bytes read at once, and most bytes of a header that is looked at.
STEP, HEADER = 1 << 20, 1 << 20
START, END = b"WARC/1.", b"\r\n\r\n"
LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*\r\n", re.IGNORECASE)
RECORD_ID = re.compile(rb"\r\nWARC-Record-ID:[ \t]*<([!-;=?-~]+)>", re.IGNORECASE)


def record(ident: Column, url: Column, html: Column) -> Column:
    """One record as text; its bytes are the text's UTF-8 form."""
    key = F.md5(F.concat_ws(" ", ident.cast("string"), url).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    uuid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in cuts])
    body = F.coalesce(html, F.lit(""))
    head = [
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid, F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    ]
    return F.concat(*head)


def file_of() -> Column:
    """Number of the file that a page's record goes to."""
    return F.coalesce(F.expr(f"page_id div {FILE_IDS}"), -1 - F.pmod(F.xxhash64("url", "html"), F.lit(LOOSE_FILES)))


def manifest(pages: DataFrame, copy: Column | None = None) -> DataFrame:
    """(file, offset, length, page_id, digest): every record's place in its file and the hash of its bytes.

    ``copy``: the html that a replica holds at the same place (null: nothing); adds the hash of those bytes as ``copy``.
    """
    bytes_of = lambda html: record(F.col("page_id"), F.col("url"), html)
    columns = ["page_id", "url", file_of().alias("file"), F.octet_length(bytes_of(F.col("html"))).cast("long").alias("length"), F.sha2(bytes_of(F.col("html")).cast("binary"), 256).alias("digest")]
    if copy is not None:
        columns.append(F.when(copy.isNotNull(), F.sha2(bytes_of(copy).cast("binary"), 256)).alias("copy"))
    rows = pages.select(*columns)
    # A file is bounded, so is the window.
    inside = Window.partitionBy("file").orderBy("page_id", "url", "digest").rowsBetween(Window.unboundedPreceding, -1)
    rest = ["length", "page_id", "digest", *(["copy"] if copy is not None else [])]
    return rows.select("file", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"), *rest)


def combined(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """(file, place, digest): hash of the offsets and digests of each place in order; as many rows a place as its range
    allows."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce("digest", F.lit("-")).alias("d"))))
    listed = F.transform(parts, lambda x: F.concat_ws(":", x["o"].cast("string"), x["d"]))
    return rows.groupBy("file", key.alias("place")).agg(F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("digest"))


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of the trees of all files, leaves first; the last one has the roots."""
    levels = [materialise(combined(records, F.expr(f"offset div {RANGE}"), "offset"), "leaves")]
    while (levels[-1].agg(F.max("place")).first()[0] or 0) > 0:
        levels.append(materialise(combined(levels[-1], F.expr(f"place div {FAN}"), "place"), "nodes"))
    return levels


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, place) of nodes that one side lacks or has otherwise."""
    both = left.join(right.withColumnRenamed("digest", "other"), ["file", "place"], "full")
    return both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("file", "place")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, offset) of the records whose digest differs between two replicas (file, offset, digest)."""
    mine, other = tree(left), tree(right)
    while len(mine) < len(other):
        mine.append(combined(mine[-1], F.expr(f"place div {FAN}"), "place"))
    while len(other) < len(mine):
        other.append(combined(other[-1], F.expr(f"place div {FAN}"), "place"))
    bad = materialise(differing(mine[-1], other[-1]), "bad")
    for a, b in zip(mine[-2::-1], other[-2::-1], strict=True):
        above = bad.withColumnRenamed("place", "above")
        below = lambda level, above=above: level.withColumn("above", F.expr(f"place div {FAN}")).join(above, ["file", "above"], "left_semi").drop("above")
        bad = materialise(differing(below(a), below(b)), "bad")
    leaf = lambda rows: rows.select("file", F.col("offset").alias("at"), "digest", F.expr(f"offset div {RANGE}").alias("place")).join(bad, ["file", "place"], "left_semi").select("file", F.col("at").alias("place"), "digest")
    return differing(leaf(left), leaf(right)).withColumnRenamed("place", "offset")


def report(pages: DataFrame, copy: Column) -> DataFrame:
    """One row per page: its record's file, offset, length and digest, and whether the replica's bytes there are damaged."""
    known = materialise(manifest(pages, copy), "manifest")
    damaged = audit(known.select("file", "offset", "digest"), known.select("file", "offset", F.col("copy").alias("digest"))).withColumn("damaged", F.lit(True))
    out = known.join(damaged, ["file", "offset"], "left")
    return out.select("page_id", "file", "offset", "length", "digest", F.coalesce("damaged", F.lit(False)).alias("damaged"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Stores the records as files ``<file>.warc`` in ``folder``, in the order and at the offsets of :func:`manifest`.

    ``folder`` must be new, shared by driver and executors, and known to Spark and to pyarrow under this name. A file
    gets its name when it is whole, so a task that is lost or runs twice leaves no half file. Returns (file, n_records,
    length, sha256), written last under ``folder``: a folder without it is not whole.
    """
    made = record(F.col("page_id"), F.col("url"), F.col("html")).cast("binary")
    rows = pages.select(file_of().alias("file"), "page_id", "url", made.alias("record"), F.sha2(made, 256).alias("digest"))
    columns = "file long, n_records long, length long, sha256 string"

    def parts(batches) -> Iterator[tuple[int, pa.Scalar]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("record"), strict=True)

    def task(batches):
        where, at = place_of(folder)
        where.create_dir(at, recursive=True)
        for file, records in groupby(parts(batches), lambda x: x[0]):
            digest, n, length, part = hashlib.sha256(), 0, 0, f"{at}/{file}-{uuid.uuid4().hex}.part"
            with where.open_output_stream(part) as out:
                for _, one in records:
                    data = one.as_buffer()
                    out.write(data)
                    digest.update(data)
                    n, length = n + 1, length + len(data)
            where.move(part, f"{at}/{file}.warc")
            yield pa.RecordBatch.from_pylist([{"file": file, "n_records": n, "length": length, "sha256": digest.hexdigest()}])

    ordered = rows.repartition("file").sortWithinPartitions("file", "page_id", "url", "digest").select("file", "record")
    ordered.mapInArrow(task, columns).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(columns).parquet(f"{folder}/manifest")


def bytes_at(file: pa.NativeFile, at: int, n: int) -> bytes:
    file.seek(at)
    return file.read(n)


def end_of(file: pa.NativeFile, at: int, size: int) -> tuple[int, str | None]:
    """Where the record that begins here ends, and its id. Its length counts only if it leads to the end of a record."""
    head, n = b"", 1 << 12
    while END not in head and len(head) < min(HEADER, size - at):
        head, n = bytes_at(file, at, n), 4 * n
    head = head[: head.find(END) + 2]
    ident, length = RECORD_ID.search(head), LENGTH.search(head)
    name = ident[1].decode("ascii") if ident and head.startswith(START) else None
    if name is not None and length:
        end = at + len(head) + 2 + int(length[1]) + len(END)
        if end <= size and bytes_at(file, end - len(END), len(END)) == END:
            return end, name
    # A step overlaps the next one by less than what is looked for.
    for place in range(at + 1, size, STEP):
        if (k := bytes_at(file, place, STEP + len(END + START) - 1).find(END + START)) >= 0:
            return place + k + len(END), name
    return size, name


def records_in(file: pa.NativeFile) -> Iterator[tuple[int, int, str | None, str]]:
    """(offset, length, record_id, digest) of the records of a file, in bounded memory."""
    at, size = 0, file.size()
    while at < size:
        end, name = end_of(file, at, size)
        digest = hashlib.sha256()
        for place in range(at, end, STEP):
            digest.update(bytes_at(file, place, min(STEP, end - place)))
        yield at, end - at, name, digest.hexdigest()
        at = end


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """(file, offset, length, record_id, digest) of all records in the ``.warc`` files of ``folder``, from their bytes.

    Spark lists the files and deals them out by size; a file is streamed by one task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(folder).select("path")
    names = ["file", "offset", "length", "record_id", "digest"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def task(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, at = place_of(path)
                name, held = at.rsplit("/", 1)[-1], []
                with where.open_input_file(at) as file:
                    for found in records_in(file):
                        held.append((name, *found))
                        if len(held) == 4096:
                            yield batch_of(held)
                            held = []
                if held:
                    yield batch_of(held)

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), kinds, strict=True)], names)

    return files.mapInArrow(task, "file string, offset long, length long, record_id string, digest string")


def compare(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Records of two folders that do not stand at the same place with the same bytes, found by :func:`audit`:
    (file, record_id, state, offset, digest, copy_offset, copy_digest).

    state: ``moved`` (same bytes at another offset of the file), ``damaged`` (other bytes under the same id, or, where an
    id cannot be read, at the same offset), ``missing`` (on the left only), ``extra`` (on the right only). Of records
    that are equal in all, or in id and file, the first are matched with the first.
    """
    mine, other = materialise(scan(spark, left), "scan"), materialise(scan(spark, right), "scan")
    places = materialise(audit(*(x.select("file", "offset", "digest") for x in (mine, other))), "places")
    a = mine.join(places, ["file", "offset"], "left_semi").select("file", "record_id", "offset", "digest")
    b = other.join(places, ["file", "offset"], "left_semi").select("file", "record_id", F.col("offset").alias("copy_offset"), F.col("digest").alias("copy_digest"))

    def matched(a: DataFrame, b: DataFrame, keys: list[str], state: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Pairs that agree in ``keys`` and their turn among these, and what is left of both sides."""
        turn = lambda rows, order, keys: rows.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        of_b = [{"digest": "copy_digest", "offset": "copy_offset"}.get(k, k) for k in keys]
        x, y = turn(a, "offset", keys), turn(b, "copy_offset", of_b)
        same = [x[k] == y[m] for k, m in zip([*keys, "turn"], [*of_b, "turn"], strict=True)]
        both = x.join(y, same).select(x["file"], F.coalesce(x["record_id"], y["record_id"]).alias("record_id"), F.lit(state).alias("state"), "offset", "digest", "copy_offset", "copy_digest")
        both = materialise(both, state)
        return both, a.join(both, ["file", "offset"], "left_anti"), b.join(both, ["file", "copy_offset"], "left_anti")

    moved, a, b = matched(a, b, ["file", "record_id", "digest"], "moved")
    named, a, b = matched(a, b, ["file", "record_id"], "damaged")
    unread = b.where("record_id IS NULL")
    placed, a, _ = matched(a, unread, ["file", "offset"], "damaged")
    b = b.join(placed, ["file", "copy_offset"], "left_anti")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("offset", "long"), ("digest", "string"))]
    missing = a.select("file", "record_id", F.lit("missing").alias("state"), "offset", "digest", F.lit(None).cast("long").alias("copy_offset"), F.lit(None).cast("string").alias("copy_digest"))
    extra = b.select("file", "record_id", F.lit("extra").alias("state"), *none, "copy_offset", "copy_digest")
    return moved.union(named).union(placed).union(missing).union(extra)
