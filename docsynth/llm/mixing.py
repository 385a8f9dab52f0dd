"""Mixing sources to target weights along a curriculum, in DataFrame functions only.

Sources get shares of all words by weight, at most REPEATS times their own size; what is above that is shared out again.
Each source's weight changes over training time; its schedule is integrated to a cumulative demand for words, and the
inverse of the demand gives every word taken from the source its time. Documents of a source stand in an order set by
a digest of id and text; the words the mix takes are whole rounds over the source and then a last, partial round that
ends within one document. Sorting all placements by time gives the order of training.

Defined cases: a null text has size 0 and nothing is taken of it; a null source is a source of its own, last in order;
without any word all targets are 0. Repeated rows count each; the order of rows equal in id and text cannot show, and
documents without id are spread by their texts. Other columns are kept by :func:`curriculum`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.llm import keys
from docsynth.llm.arrays import fresh

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Change of a source's weight from start to end of training, by its place in the order of sources.
SLOPES = (-0.5, 0.5, 0.0)
#: Hexadecimal digits of the digest that name a bucket: a source of any size is split into 16**3.
DIGITS = 3

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Words wanted of each source; ``sizes`` has one row a source (``source``, ``source_size``).

    Filling up by weight until nothing is above its limit: sources reach their limit in the order of limit over weight,
    so those at their limit are the first ones of that order. The windows see one row a source.
    """
    by_name = Window.orderBy("missing", F.col("source").cast("binary"))
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    rows = rows.withColumn("weight", weight).withColumn("most", F.col("source_size") * repeats)
    full = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words_left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("rank", F.row_number().over(full)).withColumn("level", words_left / weight_left)
    below = F.col("most") > F.col("weight") * F.col("level")
    rows = rows.withColumn("open", F.min(F.when(below, F.col("rank"))).over(everything))
    rows = rows.withColumn("at", F.max(F.when(F.col("rank") == F.col("open"), F.col("level"))).over(everything))
    target = F.when(F.col("open").isNull() | (F.col("rank") < F.col("open")), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("at"))
    return rows.select("missing", "source", "source_size", "place", target.alias("target"))


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a key for each row, repeated ones too; it holds within one job, so it is not joined with."""
    return docs.withColumn("_row", F.monotonically_increasing_id())


def placed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One narrow row for each of ``numbered(docs)``: size, source_size, target, taken, rounds (whole ones), part (words
    of the last round), start (words of the source before it), total (of the source) and position (time of its start)."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).cast("binary"))
    rows = docs.select(
        "_row", "doc_id", F.col("source").isNull().alias("missing"), F.coalesce("source", F.lit("")).alias("source"),
        size_of("text").alias("size"), digest.alias("digest"), F.substring(digest, 1, DIGITS).alias("bucket"),
    )
    key = ["missing", "source"]
    sums = rows.groupBy(*key, "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select(*key, "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    goals = targets(sums.groupBy(*key).agg(F.sum("words").alias("source_size")), weights, repeats)
    inside = Window.partitionBy(*key, "bucket").orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(firsts.join(goals, key), [*key, "bucket"])
    total = F.floor(F.col("target") + 0.5).cast("long")
    rows = rows.select("_row", "doc_id", "size", "source_size", "place", "target", (F.col("before") + F.col("within")).alias("start"), total.alias("total"))
    rounds = F.when(F.col("source_size") > 0, F.expr("total div source_size")).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("rounds", rounds)
    cut = F.col("total") - F.col("rounds") * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), cut - F.col("start")))
    rows = rows.withColumn("part", part).withColumn("taken", F.col("rounds") * F.col("size") + F.col("part"))
    return rows.withColumn("position", F.when(F.col("taken") > 0, time_of(F.col("start"))))


def time_of(demand: Column) -> Column:
    """Training time at which the source's cumulative demand reaches so many words.

    A weight that goes linearly from 1 - s to 1 + s has the integral (1 - s) t + s t², 1 at the end.
    """
    share = F.least(F.lit(1.0), demand / F.col("total"))
    slope = F.element_at(F.array(*map(F.lit, SLOPES)), (F.col("place") % len(SLOPES) + 1).cast("int"))
    flat = 1 - slope
    return F.when(slope == 0, share).otherwise((F.sqrt(flat * flat + 4 * slope * share) - flat) / (2 * slope))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: what the mix takes of it and when its first word is due."""
    return placed(numbered(docs.select("doc_id", "source", "text"))).select("doc_id", "size", "source_size", "target", "taken", "position")


def curriculum(docs: DataFrame, position: str | None = None) -> DataFrame:
    """Training documents in order: each document once for every round that takes it, sorted by training time.

    The last round ends inside one document of each source, which gives its first words only (joined by one space).
    The columns are those of ``docs``, with the time added if ``position`` names it.
    """
    key, other, mix = (fresh(docs, c) for c in ("row_key", "mix_row", "mix"))
    keyed = keys.numbered(docs, key)
    rows = placed(keyed.select(F.col(key).alias("_row"), "doc_id", "source", "text")).where("taken > 0")
    last = F.col("rounds") - F.when(F.col("part") > 0, F.lit(0)).otherwise(F.lit(1))
    rows = rows.withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.withColumn("position", time_of(F.col("start") + F.col("round") * F.col("source_size")))
    part = F.when((F.col("round") == F.col("rounds")) & (F.col("part") < F.col("size")), F.col("part")).cast("int")
    rows = rows.select(F.col("_row").alias(other), F.struct("position", "round", part.alias("part")).alias(mix))
    taken = keyed.join(rows, F.col(key) == F.col(other))
    taken = taken.repartitionByRange(F.col(f"{mix}.position"), F.col(key)).sortWithinPartitions(f"{mix}.position", key, f"{mix}.round")
    words = F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), F.col(f"{mix}.part"))
    first = F.array_join(words, " ")
    new = {"text": first, "n_chars": F.length(first)}
    columns = [F.when(F.col(f"{mix}.part").isNotNull(), new[c]).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    return taken.select(*columns, *([F.col(f"{mix}.position").alias(position)] if position else []))
