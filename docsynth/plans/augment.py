"""Seeded, probabilistic stages over pictures and their annotations, with lineage.

Whether a stage hits a picture and with which parameters is a pure function of the picture's id, so boxes and pixels
get the same stages without a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsynth.functions import geometry as g
from docsynth.functions import pixels as fx
from docsynth.operators.pixels import RGB
from docsynth.rng import uniform


@dataclass(frozen=True)
class Stage:
    """A stage with its share of pictures and the range of its parameter."""

    name: str
    ratio: float
    low: float
    high: float


# The stages in order with their shares and parameter ranges.
STAGES = [
    Stage("seal", 0.0, 0.0, 1.0),
    Stage("fold", 0.5, 0.25, 0.75),
    Stage("noise", 0.5, 0.0, 0.01),
    Stage("distortion", 0.5, 0.0, 0.4),
    Stage("rotate", 1.0, -0.5, 0.5),
    Stage("perspective", 1.0, 0.01, 0.05),
    Stage("background", 0.0, 20.0, 50.0),
]


def plan_stages(df: DataFrame, stages: list[Stage] = STAGES) -> DataFrame:
    """``a_<stage>`` (does it hit), ``p_<stage>`` and ``q_<stage>`` (two parameters) by ``image_id``."""
    i = F.col("image_id")
    cols: dict[str, Column] = {}
    for k, s in enumerate(stages):
        if s.ratio >= 1 or s.ratio <= 0:
            cols[f"a_{s.name}"] = F.lit(s.ratio >= 1)
        else:
            cols[f"a_{s.name}"] = uniform(i, 200 + 7 * k) < s.ratio
        cols[f"p_{s.name}"] = s.low + uniform(i, 201 + 7 * k) * (s.high - s.low)
        cols[f"q_{s.name}"] = s.low + uniform(i, 202 + 7 * k) * (s.high - s.low)
    return df.withColumns(cols)


def stage_lineage(planned: DataFrame, stages: list[Stage] = STAGES) -> DataFrame:
    """The stages each picture went through, in order."""
    names = F.array_compact(F.array(*[F.when(F.col(f"a_{s.name}"), F.lit(s.name)) for s in stages]))
    return planned.select("image_id", F.posexplode_outer(names).alias("i", "stage")).where(F.col("i").isNotNull()).select(
        "image_id", (F.col("i") + 1).alias("step"), "stage"
    )


def needs_fallback(stages: list[Stage] = STAGES) -> Column:
    """The last stage was not applied, so a plain white background comes in its place (no offset)."""
    return ~F.col(f"a_{stages[-1].name}")


def augment_points(df: DataFrame, stages: list[Stage] = STAGES) -> DataFrame:
    """Corners ``quad`` of annotations on ``w`` x ``h`` pictures through rotation, perspective and background.

    The other stages leave the corners where they are.
    """
    kept = df.columns
    out = plan_stages(df, stages)
    angle = F.col("p_rotate")
    new_w, new_h = g.canvas_after_rotation(F.col("w"), F.col("h"), angle)
    out = out.withColumns(
        {
            "quad": F.when(F.col("a_rotate"), g.rotate_points(F.col("quad"), F.col("w"), F.col("h"), angle)).otherwise(F.col("quad")),
            "w": F.when(F.col("a_rotate"), new_w).otherwise(F.col("w")),
            "h": F.when(F.col("a_rotate"), new_h).otherwise(F.col("h")),
        }
    )
    warped = g.perspective_points(F.col("quad"), F.col("w"), F.col("h"), F.col("p_perspective"), F.col("q_perspective"))
    out = out.withColumn("quad", F.when(F.col("a_perspective"), warped).otherwise(F.col("quad")))
    off = F.floor("p_background")
    out = out.withColumn("quad", F.when(F.col("a_background"), g.shift_points(F.col("quad"), off, off)).otherwise(F.col("quad")))
    return out.select(*kept)


def augment_pixels(df: DataFrame, width: int, stages: list[Stage] = STAGES) -> DataFrame:
    """Fold and noise on pixel rows of pictures ``width`` wide; both are decided row by row."""
    kept = df.columns
    out = plan_stages(df, stages)
    pos = F.greatest(F.least(F.floor(F.col("p_fold") * width), F.lit(width - 1)), F.lit(1))
    u = uniform(F.col("image_id") * 1048583 + F.col("y") * width + F.col("x"), 81)
    out = out.withColumns({"__pos": pos, "__u": u})
    for c in RGB:
        folded = F.when(F.col("a_fold"), fx.fold_shade(F.col(c), F.col("x"), F.col("__pos"), width)).otherwise(F.col(c))
        out = out.withColumn(c, folded)
    p = F.col("p_noise")
    for c in RGB:
        spot = F.when(F.col("__u") < p, F.lit(0)).when(F.col("__u") > 1 - p, F.lit(255)).otherwise(F.col(c))
        out = out.withColumn(c, F.when(F.col("a_noise"), spot).otherwise(F.col(c)).cast("bigint"))
    return out.select(*kept)
