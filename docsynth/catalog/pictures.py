"""Pixel queries on the vectors read as small pictures, and the augmentation chain."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth.catalog.base import Tables, boxes, pixels, query, r4, r4_sql, uniform_sql
from docsynth.functions import pixels as fx
from docsynth.functions.geometry import box_to_quad
from docsynth.operators import pixels as px
from docsynth.plans import augment
from docsynth.rng import uniform

C = F.col
KEY = ["image_id", "y", "x"]
RGB = px.RGB
D = "CAST({} AS DOUBLE)".format
UNIT = "(SELECT image_id, y, x, red / CAST(255 AS DOUBLE) AS red, green / CAST(255 AS DOUBLE) AS green, blue / CAST(255 AS DOUBLE) AS blue, alpha FROM pixels)"


def out(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*(keep or KEY), *[r4(C(c)).alias(c) for c in RGB])


def rgb_sql(f, source: str = UNIT, keep: str = "image_id, y, x") -> str:
    return f"SELECT {keep}, " + ", ".join(f"{r4_sql(f(c))} AS {c}" for c in RGB) + f" FROM {source}"


def clamp_sql(e: str, high: int = 1) -> str:
    return f"least(greatest({e}, {D(0)}), {D(high)})"


@query(rgb_sql(lambda c: clamp_sql(f"{c} * {D(repr(1 / ((1 - 0.2) + 1e-6)))}")))
def brightness(t: Tables) -> DataFrame:
    return out(px.brightness(px.unit(pixels(t)), 0.2))




def mean_sql(c: str) -> str:
    return f"CAST(sum(CAST(floor({c} * {D(1e9)} + {D(0.5)}) AS BIGINT)) AS DOUBLE) / count(*) / {D(1e9)}"


MEANS = f"(SELECT image_id, {mean_sql('red')} AS mr, {mean_sql('green')} AS mg, {mean_sql('blue')} AS mb FROM {UNIT} GROUP BY image_id)"
WITH_MEANS = f"(SELECT u.*, mr, mg, mb FROM {UNIT} u JOIN {MEANS} m ON u.image_id = m.image_id)"


@query(rgb_sql(lambda c: clamp_sql(f"{c} + ({c} - (mr + mg + mb) / 3) * {D(repr(255 / (256 - 0.3 * 255 // 1) - 1))}"), WITH_MEANS))
def contrast(t: Tables) -> DataFrame:
    return out(px.contrast(px.unit(pixels(t)), 0.3))


SAT = f"""(SELECT *, (hi - lo) / CASE WHEN (hi + lo) / 2 < {D(0.5)} THEN hi + lo + {D('0.000001')} ELSE 2 - (hi + lo) + {D('0.000001')} END AS s FROM
    (SELECT *, least(red, green, blue) AS lo, greatest(red, green, blue) AS hi FROM {UNIT}))"""


@query(
    rgb_sql(
        lambda c: clamp_sql(
            f"{c} + ({c} - (hi + lo) / 2) * (1 / (CASE WHEN s + {D(0.4)} > 1 THEN s ELSE {D(0.6)} END + {D('0.000001')}) - 1)"
        ),
        SAT,
    )
)
def saturation(t: Tables) -> DataFrame:
    return out(px.saturation(px.unit(pixels(t)), 0.4))


LIFT = {"red": "mr", "green": f"(mg + {D(0.25)} * {D(0.5)})", "blue": f"(mb + {D(0.25)})"}
PLAIN = {"red": "mr", "green": "mg", "blue": "mb"}


@query(
    rgb_sql(
        lambda c: clamp_sql(
            f"{c} * (({LIFT['red']} + {LIFT['green']} + {LIFT['blue']}) / 3 / ({LIFT[c]} + {D('0.000001')}) + "
            f"(1 - (mr + mg + mb) / 3 / ({PLAIN[c]} + {D('0.000001')})))"
        ),
        WITH_MEANS,
    )
)
def temperature(t: Tables) -> DataFrame:
    return out(px.temperature(px.unit(pixels(t)), 0.25))


@query(rgb_sql(lambda c: clamp_sql(f"1 - {clamp_sql(f'pow((1 - {c}) + {D(1e-9)}, {D(1.3)})')}")))
def highlight(t: Tables) -> DataFrame:
    return out(px.highlight(px.unit(pixels(t)), 0.3))


@query(rgb_sql(lambda c: clamp_sql(f"pow({c} + {D(1e-9)}, {D(0.7)})")))
def shadow(t: Tables) -> DataFrame:
    return out(px.shadow(px.unit(pixels(t)), 0.3))


def level_sql(c: str) -> str:
    v1 = clamp_sql(f"255 * ({c} - 20) / {D(200)}", 255)
    return f"CAST(floor({clamp_sql(f'10 + 230 * (255 * pow({v1} / 255, 1 / {D(1.2)})) / 255', 255)}) AS BIGINT)"


@query("SELECT image_id, y, x, " + ", ".join(f"{level_sql(c)} AS {c}" for c in RGB) + " FROM pixels")
def levels(t: Tables) -> DataFrame:
    return px.levels(pixels(t), 20, 220, 1.2, 10, 240).select(*KEY, *RGB)


def shifted(t: Tables) -> DataFrame:
    """Every picture under the number of the one before it."""
    return pixels(t).withColumn("image_id", C("image_id") - 1)


PAIRS = f"""(SELECT a.*, b.red AS tred, b.green AS tgreen, b.blue AS tblue FROM {UNIT} a JOIN {UNIT} b ON b.image_id = a.image_id + 1
    AND a.x = b.x AND a.y = b.y)"""


def _blend_sql(c: str) -> str:
    a, b = c, f"t{c}"
    parts = {
        "screen": f"1 - (1 - {a}) * (1 - {b})",
        "overlay": f"CASE WHEN {b} > {D(0.5)} THEN 2 * {a} * {b} ELSE 1 - 2 * (1 - {a}) * (1 - {b}) END",
        "soft": f"CASE WHEN {a} <= {D(0.5)} THEN (2 * {a} - 1) * ({b} - {b} * {b}) + {b} ELSE (2 * {a} - 1) * (sqrt({b}) - {b}) + {b} END",
        "strong": f"CASE WHEN {a} <= {D(0.5)} THEN 2 * {a} * {b} ELSE 1 - 2 * (1 - {a}) * (1 - {b}) END",
    }
    return ", ".join(f"{r4_sql(e)} AS {m}_{c}" for m, e in parts.items())


@query(f"SELECT image_id, y, x, {', '.join(_blend_sql(c) for c in RGB)} FROM {PAIRS}")
def blend(t: Tables) -> DataFrame:
    pairs = px.pair(px.unit(pixels(t)), px.unit(shifted(t)))
    modes = ("screen", "overlay", "soft", "strong")
    return pairs.select(*KEY, *[r4(fx.blend(C(c), C(f"top_{c}"), m)).alias(f"{m}_{c}") for c in RGB for m in modes])


GREY_T = "(b.red * CAST(0.299 AS DOUBLE) + b.green * CAST(0.587 AS DOUBLE) + b.blue * CAST(0.114 AS DOUBLE))"


@query(
    "SELECT a.image_id, a.y, a.x, "
    + ", ".join(
        f"CASE WHEN a.alpha > 127 THEN a.{c} ELSE CAST({clamp_sql(f'round_even(a.{c} * {D(0.6)} + round_even({GREY_T}, 0) * {D(0.4)}, 0)', 255)} AS BIGINT) END AS {c}"
        for c in RGB
    )
    + " FROM pixels a JOIN pixels b ON b.image_id = a.image_id + 1 AND a.x = b.x AND a.y = b.y"
)
def weighted_add(t: Tables) -> DataFrame:
    pairs = px.pair(pixels(t), shifted(t))
    kept = pairs.withColumns({f"own_{c}": C(c) for c in RGB})
    mixed = px.weighted_add(kept, 0.6, 0.4)
    return mixed.select(*KEY, *[F.when(C("alpha") > 127, C(f"own_{c}")).otherwise(C(c)).alias(c) for c in RGB])


def _fold_sql(c: str) -> str:
    left = f"floor({clamp_sql(f'{c} * {D(0.8)} + 1', 255)}) + floor({D(50)} - x * ({D(50)} / 2))"
    right = f"floor({clamp_sql(f'{c} * {D(0.85)} + 1', 255)}) + floor({D(50)} - (x - 2) * ({D(50)} / 2)) * {D(0.8)}"
    return f"CAST({clamp_sql(f'round_even(CASE WHEN x < 2 THEN {left} ELSE {right} END, 0)', 255)} AS BIGINT) AS {c}"


@query(f"SELECT image_id, y, x, {', '.join(_fold_sql(c) for c in RGB)} FROM pixels")
def fold_shade(t: Tables) -> DataFrame:
    return px.each(pixels(t), lambda v, c: fx.fold_shade(v, C("x"), 2, 4)).select(*KEY, *RGB)


@query(
    "SELECT image_id, y, x, "
    + ", ".join(f"CASE WHEN u < {D(0.05)} THEN 0 WHEN u > 1 - {D(0.05)} THEN 255 ELSE {c} END AS {c}" for c in RGB)
    + f" FROM (SELECT *, {uniform_sql('image_id * 16 + y * 4 + x', 80)} AS u FROM pixels)"
)
def salt_pepper(t: Tables) -> DataFrame:
    u = uniform(C("image_id") * 16 + C("y") * 4 + C("x"), 80)
    return px.salt_pepper(pixels(t).withColumn("u", u), C("u"), 0.05).select(*KEY, *RGB)


@query(
    f"SELECT {', '.join(KEY)}, "
    + ", ".join(
        f"""CAST(floor(least(greatest({c} / {D(255.0)} + sqrt(-2 * ln(1 - {uniform_sql('id', 84 + 2 * i)})) * cos({D(2 * math.pi)} * {uniform_sql('id', 85 + 2 * i)})
        * {D(0.001**0.5)} + {D(0.0)}, 0), 1) * 255) AS BIGINT) AS {c}"""
        for i, c in enumerate(RGB)
    )
    + " FROM (SELECT *, image_id * 16 + y * 4 + x AS id FROM pixels)"
)
def gauss_noise(t: Tables) -> DataFrame:
    ident = C("image_id") * 16 + C("y") * 4 + C("x")
    return px.gauss_noise(pixels(t), 0.0, 0.001, ident, 84).select(*KEY, *RGB)


GREY = "CAST(floor(red * CAST(0.299 AS DOUBLE) + green * CAST(0.587 AS DOUBLE) + blue * CAST(0.114 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"


@query(
    f"""SELECT image_id, min(x) AS l, min(y) AS t, max(x) AS r, max(y) AS b, count(*) AS n FROM pixels WHERE {GREY} < 120 GROUP BY image_id"""
)
def threshold_mask(t: Tables) -> DataFrame:
    return px.ink_box(pixels(t), 120)


@query(
    "SELECT a.image_id, a.y, a.x, "
    + ", ".join(r4_sql(f"CAST(sum(b.{c}) AS DOUBLE) / count(*)") + f" AS {c}" for c in RGB)
    + " FROM pixels a JOIN pixels b ON a.image_id = b.image_id AND b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1"
    + " GROUP BY a.image_id, a.y, a.x"
)
def box_blur(t: Tables) -> DataFrame:
    return out(px.box_blur(pixels(t), 3))


@query(
    f"""WITH p AS (SELECT a.image_id, a.alpha > 127 AS fg, (a.red - b.red) * (a.red - b.red) + (a.green - b.green) * (a.green - b.green) +
      (a.blue - b.blue) * (a.blue - b.blue) AS e, greatest(b.red, b.green, b.blue) AS hi, least(b.red, b.green, b.blue) AS lo
      FROM pixels a JOIN pixels b ON b.image_id = a.image_id + 1 AND a.x = b.x AND a.y = b.y),
    g AS (SELECT image_id, CAST(sum(e) AS DOUBLE) / (count(*) * 3) AS mse, CAST(sum(CASE WHEN fg THEN e ELSE 0 END) AS DOUBLE) /
      nullif(sum(CASE WHEN fg THEN 3 ELSE 0 END), 0) AS fmse, max(hi) - min(lo) AS span FROM p GROUP BY image_id)
    SELECT image_id, {r4_sql('mse')} AS mse, {r4_sql('fmse')} AS fmse,
      CASE WHEN mse > 0 THEN {r4_sql('10 * log10(span * span / mse)')} END AS psnr FROM g"""
)
def image_metrics(t: Tables) -> DataFrame:
    m = px.image_metrics(px.pair(pixels(t), shifted(t)), C("alpha") > 127)
    return m.select("image_id", *[r4(C(c)).alias(c) for c in ("mse", "fmse", "psnr")])


@query(
    "SELECT image_id, " + ", ".join(f"{r4_sql(f'CAST(sum({c}) AS DOUBLE) / count(*)')} AS {c}" for c in RGB) + " FROM pixels GROUP BY image_id"
)
def mean_colour(t: Tables) -> DataFrame:
    return out(px.mean_colour(pixels(t)), "image_id")


def palette_sql(k: int, rounds: int) -> str:
    mean = ", ".join(f"CAST(sum(n * {c}) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS {c}" for c in RGB)
    far = " + ".join(f"(k.{c} - m.{c}) * (k.{c} - m.{c})" for c in RGB)
    parts = [
        f"k AS MATERIALIZED (SELECT image_id, red, green, blue, {GREY} AS level, count(*) AS n FROM pixels GROUP BY ALL)",
        "h AS (SELECT image_id, level, sum(n) AS n FROM k GROUP BY ALL)",
        f"""p0 AS MATERIALIZED (SELECT k.*, CAST({k} * (2 * b + h.n) // (2 * t) AS BIGINT) AS cluster FROM k JOIN (SELECT *,
          coalesce(sum(n) OVER (PARTITION BY image_id ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
          sum(n) OVER (PARTITION BY image_id) AS t FROM h) h ON k.image_id = h.image_id AND k.level = h.level)""",
    ]
    for i in range(rounds):
        parts.append(f"m{i} AS MATERIALIZED (SELECT image_id, cluster, {mean} FROM p{i} GROUP BY ALL)")
        parts.append(
            f"""p{i + 1} AS MATERIALIZED (SELECT k.*, m.cluster FROM k JOIN m{i} m ON k.image_id = m.image_id
            QUALIFY row_number() OVER (PARTITION BY k.image_id, k.red, k.green, k.blue ORDER BY {far}, m.cluster) = 1)"""
        )
    return f"WITH {', '.join(parts)} SELECT image_id, cluster, " + ", ".join(f"{r4_sql(c)} AS {c}" for c in RGB) + f", n FROM (SELECT image_id, cluster, {mean}, CAST(sum(n) AS BIGINT) AS n FROM p{rounds} GROUP BY ALL)"


@query(palette_sql(3, 5))
def dominant_colours(t: Tables) -> DataFrame:
    return px.dominant_colours(pixels(t), 3).select("image_id", "cluster", *[r4(C(c)).alias(c) for c in RGB], "n")


@query(
    f"""WITH s AS (SELECT image_id, {GREY} AS level, arg_max({{'r': red, 'g': green, 'b': blue}}, (y, x)) AS c FROM pixels GROUP BY ALL),
    f AS (SELECT DISTINCT image_id, level FROM pixels, range(0, 256) AS r(level)),
    j AS (SELECT f.image_id, f.level, c FROM f LEFT JOIN s ON f.image_id = s.image_id AND f.level = s.level),
    k AS (SELECT image_id, level, coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY image_id ORDER BY level ROWS BETWEEN UNBOUNDED
      PRECEDING AND CURRENT ROW), first_value(c IGNORE NULLS) OVER (PARTITION BY image_id ORDER BY level ROWS BETWEEN CURRENT ROW AND
      UNBOUNDED FOLLOWING)) AS c FROM j)
    SELECT image_id, level, c.r AS red, c.g AS green, c.b AS blue FROM k"""
)
def gray_to_colour_map(t: Tables) -> DataFrame:
    return px.grey_to_colour_map(pixels(t))


CHAIN = {"temperature": 0.1, "brightness": 0.1, "contrast": 0.2, "saturation": 0.1, "highlight": 0.1, "shadow": 0.1}


def _chain_sql() -> str:
    """The six steps one after another as WITH parts; ``m`` is the mask."""
    def keep(c: str, e: str) -> str:
        return f"m * {e} + (1 - m) * {c} AS {c}"

    def step(name: str, source: str, f, extra: str = "") -> str:
        return f"{name} AS (SELECT image_id, y, x, m, {', '.join(keep(c, f(c)) for c in RGB)} FROM {source}{extra})"

    def means(name: str, source: str) -> str:
        cols = ", ".join(f"{mean_sql(c)} AS {n}" for c, n in PLAIN.items())
        return f"{name} AS (SELECT image_id, {cols} FROM {source} GROUP BY image_id)"

    e6 = D("0.000001")
    lift = {"red": "mr", "green": f"(mg + {D(0.1)} * {D(0.5)})", "blue": f"(mb + {D(0.1)})"}
    parts = [
        f"s0 AS (SELECT image_id, y, x, red, green, blue, alpha / {D(255)} AS m FROM {UNIT})",
        means("m0", "s0"),
        "j0 AS (SELECT s0.*, mr, mg, mb FROM s0 JOIN m0 ON s0.image_id = m0.image_id)",
        step("s1", "j0", lambda c: clamp_sql(
            f"{c} * (({lift['red']} + {lift['green']} + {lift['blue']}) / 3 / ({lift[c]} + {e6}) + (1 - (mr + mg + mb) / 3 / ({PLAIN[c]} + {e6})))")),
        step("s2", "s1", lambda c: clamp_sql(f"{c} * {D(repr(1 / ((1 - 0.1) + 1e-6)))}")),
        means("m2", "s2"),
        "j2 AS (SELECT s2.*, mr, mg, mb FROM s2 JOIN m2 ON s2.image_id = m2.image_id)",
        step("s3", "j2", lambda c: clamp_sql(f"{c} + ({c} - (mr + mg + mb) / 3) * {D(repr(255 / (256 - 0.2 * 255 // 1) - 1))}")),
        "j3 AS (SELECT *, least(red, green, blue) AS lo, greatest(red, green, blue) AS hi FROM s3)",
        f"k3 AS (SELECT *, (hi - lo) / CASE WHEN (hi + lo) / 2 < {D(0.5)} THEN hi + lo + {e6} ELSE 2 - (hi + lo) + {e6} END AS s FROM j3)",
        step("s4", "k3", lambda c: clamp_sql(
            f"{c} + ({c} - (hi + lo) / 2) * (1 / (CASE WHEN s + {D(0.1)} > 1 THEN s ELSE {D(0.9)} END + {e6}) - 1)")),
        step("s5", "s4", lambda c: clamp_sql(f"1 - {clamp_sql(f'pow((1 - {c}) + {D(1e-9)}, {D(1.1)})')}")),
        step("s6", "s5", lambda c: clamp_sql(f"pow({c} + {D(1e-9)}, {D(0.9)})")),
    ]
    return "WITH " + ", ".join(parts) + " " + rgb_sql(lambda c: c, "s6")


@query(_chain_sql())
def masked_filter_chain(t: Tables) -> DataFrame:
    return out(px.masked_filter_chain(px.unit(pixels(t)), C("alpha") / 255.0, CHAIN))


# ---------------------------------------------------------------- stages

# The stages with even odds, so that every combination comes up.
STAGES = [augment.Stage(s.name, 0.5, s.low, s.high) for s in augment.STAGES]
NO = {s.name: i for i, s in enumerate(STAGES)}


def applied_sql(name: str, ident: str = "image_id") -> str:
    return f"{uniform_sql(ident, 200 + 7 * NO[name])} < CAST({STAGES[NO[name]].ratio} AS DOUBLE)"


def param_sql(name: str, which: int = 1, ident: str = "image_id") -> str:
    s = STAGES[NO[name]]
    return f"(CAST({s.low} AS DOUBLE) + {uniform_sql(ident, 200 + which + 7 * NO[name])} * CAST({s.high - s.low} AS DOUBLE))"


LINEAGE = " UNION ALL ".join(
    f"SELECT vec_id AS image_id, {i} AS no, '{s.name}' AS stage FROM embeddings WHERE {applied_sql(s.name, 'vec_id')}"
    for i, s in enumerate(STAGES)
)


def images(t: Tables) -> DataFrame:
    return t.embeddings.select(C("vec_id").alias("image_id"))


@query(f"SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY no) AS step, stage FROM ({LINEAGE})")
def stage_lineage(t: Tables) -> DataFrame:
    return augment.stage_lineage(augment.plan_stages(images(t), STAGES), STAGES)


@query(f"SELECT vec_id AS image_id, NOT ({applied_sql('background', 'vec_id')}) AS fallback FROM embeddings")
def last_stage_fallback(t: Tables) -> DataFrame:
    return augment.plan_stages(images(t), STAGES).select("image_id", augment.needs_fallback(STAGES).alias("fallback"))


@query("SELECT vec_id AS image_id, " + ", ".join(f"{r4_sql(param_sql(s.name, 1, 'vec_id'))} AS {s.name}" for s in STAGES) + " FROM embeddings")
def stage_params(t: Tables) -> DataFrame:
    planned = augment.plan_stages(images(t), STAGES)
    return planned.select("image_id", *[r4(C(f"p_{s.name}")).alias(s.name) for s in STAGES])


@query(
    f"""WITH c AS (SELECT image_id, ann_id, k AS corner, CASE WHEN k IN (0, 3) THEN l ELSE r END AS x, CASE WHEN k < 2 THEN t ELSE b END AS y,
      CAST(420 AS BIGINT) AS w, CAST(760 AS BIGINT) AS h FROM boxes, range(0, 4) AS g(k)),
    a AS (SELECT c.*, d.* EXCLUDE image_id FROM c JOIN (SELECT image_id, {applied_sql('rotate')} AS rot, cos(radians({param_sql('rotate')})) AS cs,
      sin(radians({param_sql('rotate')})) AS sn, {applied_sql('perspective')} AS per, {param_sql('perspective')} AS lo,
      {param_sql('perspective', 2)} AS ro, {applied_sql('background')} AS bg, {param_sql('background')} AS off
      FROM (SELECT DISTINCT image_id FROM boxes)) d ON c.image_id = d.image_id),
    a2 AS (SELECT *, CAST(trunc(h * abs(sn) + w * abs(cs)) AS BIGINT) AS w2, CAST(trunc(h * abs(cs) + w * abs(sn)) AS BIGINT) AS h2 FROM a),
    b AS (SELECT * REPLACE (CASE WHEN rot THEN cs * x + sn * y + ((1 - cs) * 210 - sn * 380 + w2 / 2 - 210) ELSE x END AS x,
      CASE WHEN rot THEN -sn * x + cs * y + (sn * 210 + (1 - cs) * 380 + h2 / 2 - 380) ELSE y END AS y,
      CASE WHEN rot THEN w2 ELSE w END AS w, CASE WHEN rot THEN h2 ELSE h END AS h) FROM a2),
    p AS (SELECT * REPLACE (CASE WHEN per THEN floor(((1 - lo - ro) * x - w * lo * y / h + w * lo) / (1 - (lo + ro) * y / h)) ELSE x END AS x,
      CASE WHEN per THEN floor((1 - lo - ro) * y / (1 - (lo + ro) * y / h)) ELSE y END AS y) FROM b)
    SELECT ann_id, corner, {r4_sql('CASE WHEN bg THEN x + floor(off) ELSE x END')} AS x, {r4_sql('CASE WHEN bg THEN y + floor(off) ELSE y END')} AS y FROM p"""
)
def augment_chain(t: Tables) -> DataFrame:
    quad = box_to_quad(C("l"), C("t"), C("r"), C("b"))
    rows = boxes(t).select("image_id", "ann_id", quad.alias("quad"), *[F.lit(v).cast("bigint").alias(k) for k, v in (("w", 420), ("h", 760))])
    done = augment.augment_points(rows, STAGES)
    corners = done.select("ann_id", F.posexplode_outer("quad").alias("corner", "p"))
    return corners.select("ann_id", "corner", r4(C("p.x")).alias("x"), r4(C("p.y")).alias("y"))


def _pixel_sql(c: str) -> str:
    pos = f"greatest(least(CAST(floor({param_sql('fold')} * 4) AS BIGINT), 3), 1)"
    left = f"floor({clamp_sql(f'{c} * {D(0.8)} + 1', 255)}) + floor({D(50)} - x * ({D(50)} / {pos}))"
    right = f"floor({clamp_sql(f'{c} * {D(0.85)} + 1', 255)}) + floor({D(50)} - (x - {pos}) * ({D(50)} / (4 - {pos}))) * {D(0.8)}"
    fold = f"CAST({clamp_sql(f'round_even(CASE WHEN x < {pos} THEN {left} ELSE {right} END, 0)', 255)} AS BIGINT)"
    folded = f"CASE WHEN {applied_sql('fold')} THEN {fold} ELSE {c} END"
    u, p = uniform_sql("image_id * 1048583 + y * 4 + x", 81), param_sql("noise")
    return f"CASE WHEN NOT ({applied_sql('noise')}) THEN {folded} WHEN {u} < {p} THEN 0 WHEN {u} > 1 - {p} THEN 255 ELSE {folded} END AS {c}"


@query(f"SELECT image_id, y, x, {', '.join(_pixel_sql(c) for c in RGB)} FROM pixels")
def augment_pixels(t: Tables) -> DataFrame:
    return augment.augment_pixels(pixels(t), 4, STAGES).select(*KEY, *RGB)
