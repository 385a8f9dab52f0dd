"""Removal of long passages that stand anywhere else, found from difference-cover anchors.

Of every text only the windows at some word positions are hashed: those whose position modulo PERIOD lies in COVER. Any
two positions have a common shift below PERIOD that takes both into the cover, so two equal windows of LENGTH words
share an equal anchor of LENGTH - PERIOD + 1 words at the same place inside them. Anchors that stand at two places are
extended: of the texts that hold them, all windows of LENGTH words around them are hashed, and those that stand at two
places are removed. Hashes of 64 bits for anchors (a false one only costs work), of 96 bits for windows.

Values that repeat within a slice of texts are settled there, and one copy goes to the shuffle, so a passage that many
documents share does not gather in one task.

Defined cases: a null or empty text has no words. Repeated rows are copies of each other, so all their windows go.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.llm.arrays import U64, as_long, map_text, slices, stir, windows, words_of
from docsynth.llm.keys import numbered
from docsynth.session import materialise

LENGTH = 35
PERIOD = 21
#: Perfect difference set: every residue modulo PERIOD is a difference of two of these.
COVER = (0, 1, 4, 14, 16)
ANCHOR = LENGTH - PERIOD + 1
_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True


def joined_words(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, words): the words of each whole text, unchanged, joined by one space."""

    def work(col: pa.Array) -> list:
        words = [t.encode().split() for t in col.to_pylist()]
        return [np.array([len(w) for w in words], np.int64), [b" ".join(w).decode() for w in words]]

    return map_text(docs, "text", [T.StructField("n_words", T.LongType()), T.StructField("words", T.StringType())], work, keep=False)


PLACES = "way long, value long, check int, row long, at int, twice boolean"


def places(value: np.ndarray, check: np.ndarray, row: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Rows of one slice: places of values seen twice in it are settled (value 0, twice); of each value one more row goes
    to the exchange, with its place if it is the only one."""
    order = np.lexsort((check, value))
    value, check, row, at = value[order], check[order], row[order], at[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (check[1:] != check[:-1])
    starts = np.flatnonzero(new)
    single = np.diff(np.concatenate([starts, [len(value)]])) == 1
    alone = np.repeat(single, np.diff(np.concatenate([starts, [len(value)]])))
    settled = np.flatnonzero(~alone)
    n, m = len(starts), len(settled)
    way = np.concatenate([value[starts], stir(row[settled].view(U64) * U64(PERIOD) + at[settled].astype(U64))])
    columns = [
        pa.array(as_long(way)), pa.array(as_long(np.concatenate([value[starts], np.zeros(m, U64)]))),
        pa.array(np.concatenate([check[starts], np.zeros(m, np.int32)])),
        pa.array(np.concatenate([row[starts], row[settled]]), mask=np.concatenate([~single, np.zeros(m, bool)])),
        pa.array(np.concatenate([at[starts], at[settled]]).astype(np.int32)),
        pa.array(np.concatenate([~single, np.ones(m, bool)])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["way", "value", "check", "row", "at", "twice"])


def repeated_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of values that stand twice, from rows sorted by value. Of a value that runs on over many batches only the
    value itself is remembered, of one seen once its row."""
    held = {c: np.empty(0, t) for c, t in (("way", np.int64), ("value", np.int64), ("check", np.int32), ("row", np.int64), ("at", np.int32), ("twice", bool))}
    for batch in batches:
        if not len(batch):
            continue
        new = {c: batch.column(c).fill_null(-1).to_numpy(zero_copy_only=False) if c == "row" else batch.column(c).to_numpy(zero_copy_only=False) for c in held}
        x = {c: np.concatenate([held[c], new[c]]) for c in held}
        first = np.ones(len(x["way"]), bool)
        first[1:] = (x["way"][1:] != x["way"][:-1]) | (x["value"][1:] != x["value"][:-1]) | (x["check"][1:] != x["check"][:-1])
        group = np.cumsum(first) - 1
        size = np.bincount(group)
        good = (size > 1) | (np.bincount(group, x["twice"]) > 0)
        out = np.flatnonzero(good[group] & (x["row"] >= 0))
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(x["row"][out]), pa.array(x["at"][out])], ["row", "at"])
        # One row of the last value goes on: itself if it is alone so far, else a mark without a place.
        held = {c: v[-1:].copy() for c, v in x.items()}
        if good[-1]:
            held["row"][0], held["twice"][0] = -1, True


def repeated(rows: DataFrame) -> DataFrame:
    """(row, at) of all places whose value stands at another place too."""
    return rows.repartition("way").sortWithinPartitions("way", "value", "check").mapInArrow(repeated_batches, "row long, at int")


def anchors(docs: DataFrame) -> DataFrame:
    """Anchor windows of all texts at the positions of the cover."""

    def task(batches):
        for part in slices(batches, "text"):
            w = words_of(part.column("text").fill_null(""))
            row = part.column("row").to_numpy()
            at = np.arange(len(w.starts)) - np.repeat(w.first[:-1], w.counts())
            room = np.repeat(w.first[1:], w.counts()) - np.arange(len(w.starts))
            take = np.flatnonzero(_IN_COVER[at % PERIOD] & (room >= ANCHOR))
            if len(take):
                yield places(windows(w.hashes(), ANCHOR)[take], np.zeros(len(take), np.int32), row[w.owner()[take]], at[take])

    return docs.select("row", "text").mapInArrow(task, PLACES)


def extended(docs: DataFrame) -> DataFrame:
    """Windows of LENGTH words that hold one of the anchors in ``hits`` at a place where the cover can have put it."""

    def task(batches):
        for part in slices(batches, "text"):
            w = words_of(part.column("text").fill_null(""))
            row, owner, counts = part.column("row").to_numpy(), w.owner(), w.counts()
            total = len(w.starts)
            hits = part.column("hits")
            found = np.repeat(w.first[:-1], pc.list_value_length(hits).to_numpy()) + hits.flatten().to_numpy()
            step = np.zeros(total + 1, np.int64)
            begin = w.first[:-1][owner[found]]
            np.add.at(step, np.maximum(found - PERIOD + 1, begin), 1)
            np.add.at(step, found + 1, -1)
            room = np.repeat(w.first[1:], counts) - np.arange(total)
            take = np.flatnonzero((np.cumsum(step[:-1]) > 0) & (room >= LENGTH))
            if len(take):
                hashes = w.hashes()
                check = (windows(stir(hashes + U64(1)), LENGTH)[take] >> U64(32)).astype(np.uint32).view(np.int32)
                yield places(windows(hashes, LENGTH)[take], check, row[owner[take]], take - w.first[:-1][owner[take]])

    return docs.select("row", "text", "hits").mapInArrow(task, PLACES)


def kept_words(docs: DataFrame) -> DataFrame:
    """(row, n_removed, kept): words outside all windows that start at the places in ``hits``."""

    def task(batches):
        for part in slices(batches, "text"):
            texts, rows = part.column("text").fill_null("").to_pylist(), part.column("row")
            removed, kept = [], []
            for text, hits in zip(texts, part.column("hits"), strict=True):
                words = text.encode().split()
                step = np.zeros(len(words) + 1, np.int64)
                at = hits.values.to_numpy()
                np.add.at(step, at, 1)
                np.add.at(step, at + LENGTH, -1)
                gone = np.cumsum(step[:-1]) > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode())
            yield pa.RecordBatch.from_arrays([rows, pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["row", "n_removed", "kept"])

    return docs.select("row", "text", "hits").mapInArrow(task, "row long, n_removed long, kept string")


def by_row(found: DataFrame) -> DataFrame:
    """All places of one row as a list, no longer than its text."""
    return found.groupBy("row").agg(F.collect_set("at").alias("hits"))


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with a number for each row."""
    return numbered(docs, "row", ["doc_id", "text"]).select("row", "doc_id", "text")


def passages(docs: DataFrame) -> DataFrame:
    """(row, n_removed, kept) for the rows of ``keyed`` documents that lose words: what is left of their text."""
    hits = materialise(by_row(repeated(anchors(docs))), "anchors")
    # Only texts with a repeated anchor go on; they are needed twice, so they are written.
    texts = materialise(docs.select("row", "text").join(hits, "row"), "texts")
    doubles = by_row(repeated(extended(texts)))
    return kept_words(texts.select("row", "text").join(doubles, "row"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: number of words, of removed words, and a digest of what is kept."""
    docs = keyed(docs)
    left = passages(docs).select("row", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    full = joined_words(docs).select("row", "doc_id", "n_words", F.sha2(F.col("words").cast("binary"), 256).alias("all_sha256"))
    out = full.join(left, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))
