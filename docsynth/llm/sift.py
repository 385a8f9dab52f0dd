"""Leaving most rows out before a join that keeps few, by a bitmap of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.llm.arrays import fresh

#: Bits of the bitmap, in pieces of what one aggregate holds: 1 MB in all, whatever the number of keys.
PIECES, PIECE = 256, 32_768


def marked(rows: DataFrame, keys: DataFrame, key: str, maybe: str) -> DataFrame:
    """``rows`` with the column ``maybe``: false only where ``key`` is certainly not among ``keys``."""
    place, piece, field = fresh(rows, "place"), fresh(rows, "piece"), fresh(rows, "bits")
    at = F.pmod(F.xxhash64(key), F.lit(PIECES * PIECE))
    bits = keys.select(at.alias("p")).groupBy(F.expr(f"p div {PIECE}").alias(piece)).agg(F.bitmap_construct_agg(F.col("p") % PIECE).alias(field))
    joined = rows.withColumn(place, at).join(F.broadcast(bits), F.expr(f"{place} div {PIECE}") == F.col(piece), "left")
    byte = F.conv(F.hex(F.substring(field, ((F.col(place) % PIECE) / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(F.getbit(byte, F.col(place) % 8) == 1, F.lit(False)).alias(maybe))


def sifted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``keys``; the join after it decides.

    Of rows that no key stands for, a share as large as the filled part of the bitmap stays, so the wide columns of
    the others need no shuffle.
    """
    maybe = fresh(rows, "maybe")
    return marked(rows, keys, key, maybe).where(maybe).drop(maybe)


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not among ``keys``; only those that may be among them are shuffled."""
    maybe = fresh(rows, "maybe")
    found = marked(rows, keys, key, maybe)
    gone = keys.select(F.col(key).alias(fresh(rows, "gone")))
    asked = found.where(maybe).join(gone, F.col(key) == F.col(gone.columns[0]), "left_anti")
    return found.where(~F.col(maybe)).union(asked).drop(maybe)
