"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own session to every function instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docsynth")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session, as in tests, may leave it unnamed and gets one fresh folder for the process; on a cluster a
    folder of one machine would lose the tables of the others, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="docsynth-"))
    return _LOCAL[0]


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: cuts lineage with a table that outlives any executor."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the driver's garbage collected: Spark deletes the shuffle files of tables written since only after that."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise_by(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """Like :func:`materialise`, in ``parts`` buckets of ``key``: later steps that group or join by it deal no rows anew."""
    table = f"{re.sub('[^a-z]', '_', name)}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(parts, key).option("path", f"{shared_dir(df.sparkSession)}/{table}").saveAsTable(table)
    return df.sparkSession.table(table)
