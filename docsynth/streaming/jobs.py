"""Samples made on demand and ingestion that resumes where it stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from docsynth.rng import draw
from docsynth.sources.dataset import sample_name


def sample_stream(spark: SparkSession, rows_per_batch: int) -> DataFrame:
    """An endless stream of sample indexes."""
    source = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    return source.load().select(F.col("value").alias("index"))


def online_samples(indexes: DataFrame, mode: str, lang: str) -> DataFrame:
    """Names and seeds of samples; the same columns for a batch or a stream of ``index``."""
    name = sample_name(F.lit(mode), F.lit(lang), F.col("index"), F.lit(0))
    return indexes.select("index", name.alias("name"), draw(F.col("index"), 50).alias("seed"))


def new_names(names: DataFrame) -> DataFrame:
    """Each name of a stream once, over restarts too: what was seen is the query's checkpointed state."""
    return names.select("name").dropDuplicates(["name"])


def append_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Take what has arrived since the last run of this checkpoint, append it, stop."""
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def keep_batches(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Make the samples of the next batch of an endless stream and keep them under the batch's number.

    A batch that is repeated after a failure overwrites its own folder, so each sample stands once however often the job
    is killed and started again.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
