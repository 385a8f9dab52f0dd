"""Sample names, partitioned packages, file lists, and a generator source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

ARTICLE = "url STRING, content STRING, image_urls ARRAY<STRING>"


def sample_name(name: Column, lang: Column, index: Column, stamp: Column) -> Column:
    return F.format_string("%s_%s_%08d_%d", name, lang, index, stamp)


def write_dataset(df: DataFrame, path: str) -> None:
    """Package by mode and language; only the folders present in ``df`` are replaced."""
    df.write.partitionBy("mode", "lang").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def list_by_extension(spark: SparkSession, path: str, ext: str) -> DataFrame:
    """Files under a folder; one that cannot be listed stops the job. File bodies are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{ext}")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    base = F.substring_index("path", "/", -1)
    return files.select("path", F.regexp_replace(base, r"\.[^.]*$", "").alias("stem"), F.lit(f".{ext}").alias("ext"), "length")


class Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class SampleReader(DataSourceReader):
    """Indexes ``first`` to ``last`` in ranges, each once for every language."""

    def __init__(self, first: int, last: int, parts: int, langs: list[str]):
        self.first, self.last, self.parts, self.langs = first, last, parts, langs

    def partitions(self) -> list[Range]:
        step = -(-max(0, self.last + 1 - self.first) // self.parts) or 1
        ranges = [Range(i, min(i + step, self.last + 1)) for i in range(self.first, self.last + 1, step)]
        return ranges or [Range(self.first, self.first)]

    def read(self, partition: Range):
        import pyarrow as pa

        size = 65536
        for lo in range(partition.first, partition.last, size):
            ids = list(range(lo, min(lo + size, partition.last)))
            for lang in self.langs:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([lang] * len(ids), pa.string())], ["index", "lang"])


class FilteredReader(SampleReader):
    """Filters narrow the bounds and the languages, so rows they leave out are never made."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column, value = ".".join(getattr(f, "attribute", ())), getattr(f, "value", None)
            if column == "lang" and isinstance(f, (In, EqualTo)):
                self.langs = [x for x in self.langs if x in (f.value if isinstance(f, In) else (value,))]
            elif column == "index" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, value + isinstance(f, GreaterThan))
            elif column == "index" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.last = min(self.last, value - isinstance(f, LessThan))
            elif column == "index" and isinstance(f, EqualTo):
                self.first, self.last = max(self.first, value), min(self.last, value)
            elif not isinstance(f, IsNotNull):
                yield f


class SampleSource(DataSource):
    """``format("docsynth")``: sample indexes ``first`` to ``last`` (or 0 to n - 1) per language of ``langs``, in ``parts``
    ranges. With ``pushdown`` filters go down into the source, which the session must have switched on."""

    @classmethod
    def name(cls) -> str:
        return "docsynth"

    def schema(self) -> str:
        return "index BIGINT, lang STRING"

    def reader(self, schema) -> SampleReader:
        o = self.options
        last = int(o["last"]) if "last" in o else int(o.get("n", "10")) - 1
        kind = FilteredReader if o.get("pushdown", "") == "true" else SampleReader
        return kind(int(o.get("first", "0")), last, int(o.get("parts", "8")), o.get("langs", "en").split(","))


#: Indexes of a partition of the source, about.
PART_INDEXES = 4_000_000


def samples(spark: SparkSession, first: int, last: int, langs: list[str]) -> DataFrame:
    """(index, lang) for indexes ``first`` to ``last``; filters on both go down into the source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SampleSource)
    parts = max(spark.sparkContext.defaultParallelism, -(-(last - first + 1) // PART_INDEXES))
    options = {"first": first, "last": last, "parts": parts, "langs": ",".join(langs), "pushdown": "true"}
    return spark.read.format("docsynth").options(**options).load()
