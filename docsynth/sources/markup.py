"""Labelling-tool JSON and slice HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The file shape and the two patterns of slice HTML.
LABELME = "imagePath STRING, shapes ARRAY<STRUCT<label STRING, points ARRAY<ARRAY<DOUBLE>>>>"
SLICE_NAME = "status='([^']*)'"
SLICE_BOX = r'width="(\d+)" height="(\d+)" border="0" alt="([^"]*)"'


def read_labelme(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``image, label, l, t, r, b``: label behind the first ``@`` (or whole), box from the first two points."""
    docs = spark.read.schema(LABELME).json(path, multiLine=multi_line)
    shapes = docs.select(F.col("imagePath").alias("image"), F.explode("shapes").alias("s"))
    corner = [F.col("s.points")[i][j].cast("bigint").alias(k) for k, i, j in (("l", 0, 0), ("t", 0, 1), ("r", 1, 0), ("b", 1, 1))]
    return shapes.select("image", F.regexp_replace("s.label", "^[^@]*@", "").alias("label"), *corner)


def slice_html(df: DataFrame, html: str) -> DataFrame:
    """Slots of a sliced mock-up: names and boxes paired by position; unequal counts stop the job."""
    names = F.regexp_extract_all(html, F.lit(SLICE_NAME), F.lit(1))
    found = [F.regexp_extract_all(html, F.lit(SLICE_BOX), F.lit(i)) for i in (1, 2, 3)]
    checked = F.when(F.size(names) == F.size(found[0]), names).otherwise(
        F.raise_error(F.lit("names and boxes differ in number")).cast("array<string>")
    )
    zipped = F.arrays_zip(checked.alias("name"), *[f.alias(k) for f, k in zip(found, ("width", "height", "alt"))])
    rest = [c for c in df.columns if c != html]
    rows = df.select(*rest, F.posexplode_outer(zipped).alias("i", "z")).where(F.col("i").isNotNull())
    alt = F.split("z.alt", ",")
    font = F.split(alt[2], "#")
    return rows.select(
        *rest,
        (F.col("i") + 1).alias("slot_no"),
        "z.name",
        F.col("z.width").cast("bigint").alias("width"),
        F.col("z.height").cast("bigint").alias("height"),
        alt[0].cast("bigint").alias("x"),
        alt[1].cast("bigint").alias("y"),
        font[0].alias("font"),
        F.when(F.size(font) > 1, F.concat(F.lit("#"), F.get(font, F.lit(1)))).alias("colour"),
    )
