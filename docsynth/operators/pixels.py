"""Operators on pixel rows ``image_id, y, x, red, green, blue, alpha`` (0..255).

Image statistics are grouped aggregates joined back, so a single huge image is reduced map-side like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsynth.functions import pixels as fx
from docsynth.rng import uniform

RGB = ["red", "green", "blue"]


def unit(df: DataFrame) -> DataFrame:
    """Channels as DOUBLE in [0, 1]."""
    return df.withColumns({c: F.col(c) / 255.0 for c in RGB})


def channel_means(df: DataFrame) -> DataFrame:
    """Means of [0, 1] channels, summed in whole billionths so that the order of the rows cannot show."""
    total = {c: F.sum(F.floor(F.col(c) * 1e9 + 0.5)) for c in RGB}
    return df.groupBy("image_id").agg(*[(s / F.count(F.lit(1)) / 1e9).alias(f"mean_{c}") for c, s in total.items()])


def each(df: DataFrame, f: Callable[[Column, str], Column]) -> DataFrame:
    return df.withColumns({c: f(F.col(c), c) for c in RGB})


def brightness(df: DataFrame, x: float) -> DataFrame:
    return each(df, lambda v, c: fx.brightness(v, x))


def contrast(df: DataFrame, x: float) -> DataFrame:
    means = channel_means(df)
    mean = (F.col("mean_red") + F.col("mean_green") + F.col("mean_blue")) / 3
    return each(df.join(means, "image_id"), lambda v, c: fx.contrast(v, x, mean)).drop(*[f"mean_{c}" for c in RGB])


def saturation(df: DataFrame, x: float) -> DataFrame:
    low, high = F.least(*RGB), F.greatest(*RGB)
    return each(df.withColumns({"__low": low, "__high": high}), lambda v, c: fx.saturation(v, x, F.col("__low"), F.col("__high"))).drop(
        "__low", "__high"
    )


def temperature(df: DataFrame, x: float) -> DataFrame:
    means = {c: F.col(f"mean_{c}") for c in RGB}
    out = each(df.join(channel_means(df), "image_id"), lambda v, c: fx.temperature(v, x, c, means))
    return out.drop(*[f"mean_{c}" for c in RGB])


def highlight(df: DataFrame, x: float) -> DataFrame:
    return each(df, lambda v, c: fx.highlight(v, x))


def shadow(df: DataFrame, x: float) -> DataFrame:
    return each(df, lambda v, c: fx.shadow(v, x))


def masked_filter_chain(df: DataFrame, mask: Column, args: dict[str, float]) -> DataFrame:
    """Temperature, brightness, contrast, saturation, highlight, shadow in this order; after every step the
    background outside the mask gets its value back."""
    out = df.withColumn("__m", mask)
    for step in (temperature, brightness, contrast, saturation, highlight, shadow):
        kept = out.withColumns({f"__old_{c}": F.col(c) for c in RGB})
        done = step(kept, args[step.__name__])
        out = each(done, lambda v, c: F.col("__m") * v + (1 - F.col("__m")) * F.col(f"__old_{c}")).drop(*[f"__old_{c}" for c in RGB])
    return out.drop("__m")


def levels(df: DataFrame, *args: float) -> DataFrame:
    return each(df, lambda v, c: fx.level(v, *args))


def pair(bottom: DataFrame, top: DataFrame) -> DataFrame:
    """Two pictures of one size, pixel by pixel; the top one's channels start with ``top_``."""
    renamed = top.select("image_id", "y", "x", *[F.col(c).alias(f"top_{c}") for c in RGB])
    return bottom.join(renamed, ["image_id", "y", "x"])


def weighted_add(pairs: DataFrame, alpha: float, beta: float) -> DataFrame:
    """Rounded and clipped sum with the grey of the top layer."""
    grey = F.col("top_red") * 0.299 + F.col("top_green") * 0.587 + F.col("top_blue") * 0.114
    return each(pairs, lambda v, c: fx.clamp(F.rint(v * alpha + F.rint(grey) * beta), 0.0, 255.0).cast("bigint"))


def salt_pepper(df: DataFrame, u: Column, p: float) -> DataFrame:
    return each(df, lambda v, c: F.when(u < p, F.lit(0)).when(u > 1 - p, F.lit(255)).otherwise(v).cast("bigint"))


def normal(ident: Column, salt: int) -> Column:
    """Standard normal draw from two uniform ones of the same id (Box-Muller)."""
    return F.sqrt(-2 * F.log(1 - uniform(ident, salt))) * F.cos(2 * math.pi * uniform(ident, salt + 1))


def gauss_noise(df: DataFrame, mean: float, var: float, ident: Column, salt: int) -> DataFrame:
    """Normal noise on [0, 1] values, clipped, back to 0..255; drawn from the pixel's id, so it repeats in every order."""
    sd = var**0.5
    noisy = {c: F.floor(fx.clamp(F.col(c) / 255.0 + normal(ident, salt + 2 * i) * sd + mean) * 255).cast("bigint") for i, c in enumerate(RGB)}
    return df.withColumns(noisy)


def grey(df: DataFrame) -> Column:
    return F.floor(F.col("red") * 0.299 + F.col("green") * 0.587 + F.col("blue") * 0.114 + 0.5)


def ink_box(df: DataFrame, threshold: int) -> DataFrame:
    """Bounding box of the dark pixels of every picture."""
    dark = df.where(grey(df) < threshold)
    return dark.groupBy("image_id").agg(
        F.min("x").alias("l"), F.min("y").alias("t"), F.max("x").alias("r"), F.max("y").alias("b"), F.count(F.lit(1)).alias("n")
    )


def box_blur(df: DataFrame, k: int, channels: Sequence[str] = RGB) -> DataFrame:
    """Mean over a k x k neighbourhood; at the edges over what exists.

    Sums and counts run over x inside a line, then over y inside a column, so the group of a window is one line or one
    column of a picture.
    """
    half = k // 2
    across = Window.partitionBy("image_id", "y").orderBy("x").rangeBetween(-half, half)
    down = Window.partitionBy("image_id", "x").orderBy("y").rangeBetween(-half, half)
    first = df.withColumns({f"__{c}": F.sum(c).over(across) for c in channels} | {"__n": F.count(F.lit(1)).over(across)})
    total = first.withColumns({f"__{c}": F.sum(f"__{c}").over(down) for c in channels} | {"__n": F.sum("__n").over(down)})
    return total.withColumns({c: F.col(f"__{c}") / F.col("__n") for c in channels}).drop(*[f"__{c}" for c in channels], "__n")


def image_metrics(pairs: DataFrame, mask: Column) -> DataFrame:
    """MSE, foreground MSE and PSNR of the top layer against the bottom one."""
    n = F.count(F.lit(1)) * 3
    err = sum(((F.col(c) - F.col(f"top_{c}")) * (F.col(c) - F.col(f"top_{c}")) for c in RGB[1:]), (F.col("red") - F.col("top_red")) * (F.col("red") - F.col("top_red")))
    per = pairs.groupBy("image_id").agg(
        F.sum(err).alias("se"),
        F.sum(F.when(mask, err).otherwise(0)).alias("fse"),
        n.alias("n"),
        (F.sum(F.when(mask, 1).otherwise(0)) * 3).alias("fg"),
        (F.max(F.greatest(*[f"top_{c}" for c in RGB])) - F.min(F.least(*[f"top_{c}" for c in RGB]))).alias("span"),
    )
    mse = F.col("se") / F.col("n")
    return per.select(
        "image_id",
        mse.alias("mse"),
        F.try_divide(F.col("fse"), F.col("fg")).alias("fmse"),
        F.when(mse > 0, 10 * F.log10(F.col("span") * F.col("span") / mse)).alias("psnr"),
    )


def mean_colour(df: DataFrame) -> DataFrame:
    """The one-colour palette: the mean."""
    return df.groupBy("image_id").agg(*[F.avg(c).alias(c) for c in RGB])


def dominant_colours(df: DataFrame, k: int, rounds: int = 5) -> DataFrame:
    """k colours of every picture by k-means over its distinct colours, with their pixels (``image_id, cluster, .., n``).

    Colours start in the k shares of the picture's grey levels; then means and nearest means follow each other a fixed
    number of times, ties to the smaller cluster. Only k means a picture are joined back, so its pixels stay spread out.
    """
    colours = df.groupBy("image_id", *RGB).agg(F.count(F.lit(1)).alias("n")).withColumn("level", grey(df))
    levels = colours.groupBy("image_id", "level").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("image_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    share = {"__b": F.coalesce(F.sum("n").over(before), F.lit(0)), "__t": F.sum("n").over(Window.partitionBy("image_id"))}
    levels = levels.withColumns(share).select("image_id", "level", F.expr(f"{k} * (2 * __b + n) div (2 * __t)").alias("cluster"))
    points = colours.join(levels, ["image_id", "level"])

    def means(points: DataFrame) -> DataFrame:
        total = F.sum("n")
        return points.groupBy("image_id", "cluster").agg(*[(F.sum(F.col("n") * F.col(c)) / total).alias(c) for c in RGB], total.alias("n"))

    for _ in range(rounds):
        centres = means(points).groupBy("image_id").agg(F.collect_list(F.struct("cluster", *RGB)).alias("__c"))

        def distance(c: Column) -> Column:
            d = [(F.col(x) - c[x]) * (F.col(x) - c[x]) for x in RGB]
            return F.struct((d[0] + d[1] + d[2]).alias("d"), c["cluster"].alias("cluster"))

        nearest = F.array_min(F.transform("__c", distance))["cluster"]
        points = colours.join(centres, "image_id").withColumn("cluster", nearest).drop("__c")
    return means(points).select("image_id", "cluster", *RGB, "n")


def grey_to_colour_map(df: DataFrame) -> DataFrame:
    """For every grey level 0..255 of a picture its colour: the last seen one fills gaps, the first one the start.

    One picture has at most 256 levels, so the filling windows are short.
    """
    at = F.struct("y", "x")
    seen = df.groupBy("image_id", grey(df).alias("level")).agg(F.max_by(F.struct(*RGB), at).alias("c"))
    full = df.select("image_id").distinct().select("image_id", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), F.lit(255).cast("bigint"))).alias("level"))
    up = Window.partitionBy("image_id").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.partitionBy("image_id").orderBy("level").rowsBetween(0, Window.unboundedFollowing)
    joined = full.join(seen, ["image_id", "level"], "left")
    colour = F.coalesce(F.last("c", ignorenulls=True).over(up), F.first("c", ignorenulls=True).over(rest))
    return joined.withColumn("c", colour).select("image_id", "level", "c.*")
