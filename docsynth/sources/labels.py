"""Label files: one annotation per line, four corners and ``kind@content``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsynth.functions.geometry import point

# Fixed value: the four-point line. Name, eight coordinates, kind and content.
LINE = r"(?s)^([^;]*)" + r";(-?[0-9.]+)" * 8 + r";([^@;]*)@(.*)\z"
TABLE_KINDS = ("table", "row", "column", "cell")


def parse_label_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """``name, kind, content, quad`` and ``role`` (the kind for table parts, else text); other lines are skipped."""
    v = F.col(value)
    part = [F.regexp_extract(v, LINE, i) for i in range(1, 12)]
    corners = [point(part[1 + 2 * i], part[2 + 2 * i]) for i in range(4)]
    kept = df.where(v.rlike(LINE))
    rest = [c for c in df.columns if c != value]
    out = kept.select(
        *rest,
        part[0].alias("name"),
        part[9].alias("kind"),
        part[10].alias("content"),
        F.array(*corners).alias("quad"),
    )
    return out.withColumn("role", F.when(F.col("kind").isin(*TABLE_KINDS), F.col("kind")).otherwise("text"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label files with the file each line came from. A file in which nothing matches raises in :func:`require_labels`."""
    return parse_label_lines(spark.read.text(path).withColumn("file", F.input_file_name()))


def require_labels(spark: SparkSession, path: str) -> DataFrame:
    """``file, n`` per label file; stops the job at a file without any label line."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    n = F.sum(F.when(F.col("value").rlike(LINE), 1).otherwise(0))
    counted = lines.groupBy("file").agg(n.alias("n"))
    checked = F.when(F.col("n") > 0, F.col("n")).otherwise(
        F.raise_error(F.concat(F.lit("no label line in "), F.col("file"))).cast("bigint")
    )
    return counted.withColumn("n", checked)


def label_line(name: Column, quad: Column, label: Column) -> Column:
    """The line of one annotation; coordinates lose their fraction. Any number of corners."""
    coords = F.flatten(F.transform(quad, lambda p: F.array(p["x"].cast("bigint"), p["y"].cast("bigint"))))
    return F.concat_ws(";", name, F.array_join(F.transform(coords, lambda c: c.cast("string")), ";"), label)


def write_labels(df: DataFrame, path: str) -> None:
    """``mode, lang, name, quad, label`` rows to text files under ``mode=/lang=`` folders."""
    line = label_line(F.col("name"), F.col("quad"), F.col("label")).alias("value")
    df.select("mode", "lang", line).write.partitionBy("mode", "lang").mode("overwrite").text(path)


def two_to_four_points(value: Column) -> Column:
    """``l;t;r;b;label`` as four corners; any other line stays as it is."""
    p = F.split(value, ";")
    four = F.concat_ws(";", p[0], p[1], p[2], p[1], p[2], p[3], p[0], p[3], p[4])
    return F.when(F.size(p) == 5, four).otherwise(value)


def word_set(df: DataFrame, value: str = "value") -> DataFrame:
    """Distinct lower-case alphabetic words behind the first ``@``."""
    rest = F.regexp_replace(value, "^[^@]*@", "")
    return (
        df.select(F.explode_outer(F.split(rest, r"\s+")).alias("word"))
        .where(F.col("word").rlike(r"^\p{L}+$"))
        .select(F.lower("word").alias("word"))
        .distinct()
    )


def read_word_sets(spark: SparkSession, path: str) -> DataFrame:
    return word_set(spark.read.text(path).where(F.contains("value", F.lit("@"))))


def corpus_entries(df: DataFrame, value: str = "value") -> DataFrame:
    """Text behind the last ``@`` of each line, longer than one sign."""
    return df.select(F.substring_index(value, "@", -1).alias("word")).where(F.length("word") > 1)


def encode_text(text: Column, charset: str) -> Column:
    """Bytes of a text in any charset; SQL's own function takes the Unicode ones only."""
    return F.pandas_udf(lambda s: s.map(lambda t: None if t is None else t.encode(charset, "replace")), "binary")(text)


def decode_corpus(files: DataFrame, charset: str) -> DataFrame:
    """Entries of label files held as bytes in ``content``."""

    @F.pandas_udf("string")
    def text(content: pd.Series) -> pd.Series:
        # Charsets beyond the Unicode ones need a switch of the whole session in SQL; bad bytes become the replacement sign.
        return content.map(lambda b: None if b is None else bytes(b).decode(charset, "replace"))

    return corpus_entries(files.select(F.explode_outer(F.split(text("content"), r"\r?\n")).alias("value")))


def read_corpus(spark: SparkSession, path: str, charset: str = "GBK") -> DataFrame:
    """Label files in a legacy charset, decoded file by file, so the charset need not be line-safe."""
    return decode_corpus(spark.read.format("binaryFile").load(path), charset)


def slots_of(df: DataFrame) -> DataFrame:
    """Label rows whose content is ``text`` or ``text|font`` as template slots with an integer rectangle."""
    from docsynth.functions.geometry import quad_to_box

    box = quad_to_box(F.col("quad"))
    font = F.split_part(F.col("content"), F.lit("|"), F.lit(2))
    return df.select(
        *[c for c in df.columns if c not in ("quad", "content", "role")],
        F.split_part(F.col("content"), F.lit("|"), F.lit(1)).alias("content"),
        F.nullif(font, F.lit("")).alias("font"),
        *[box[k].cast("bigint").alias(k) for k in "ltrb"],
    )


def read_background_boxes(spark: SparkSession, path: str) -> DataFrame:
    """``jpg;l;t;r;b;rest`` lines."""
    schema = "jpg STRING, l INT, t INT, r INT, b INT, rest STRING"
    return spark.read.schema(schema).csv(path, sep=";", quote="").drop("rest")
