"""Colour filters on one pixel value in [0, 1] (or 0..255 where said) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-6


def clamp(v: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(v, F.lit(low)), F.lit(high))


def brightness(v: Column, x: float) -> Column:
    return clamp(v * (1 / ((1 - x) + EPS) if x >= 0 else x + 1))


def contrast(v: Column, x: float, mean: Column) -> Column:
    k = 255 / (256 - x * 255 // 1) - 1 if x > 0 else x
    return clamp(v + (v - mean) * k)


def saturation(v: Column, x: float, low: Column, high: Column) -> Column:
    """``low`` and ``high`` are the least and greatest channel of the same pixel."""
    spread, total = high - low, high + low
    mid = total / 2
    s = spread / F.when(mid < 0.5, total + EPS).otherwise(2 - total + EPS)
    if x < 0:
        return clamp(mid + (v - mid) * (1 + x))
    gain = 1 / (F.when(s + x > 1, s).otherwise(F.lit(1 - x)) + EPS) - 1
    return clamp(v + (v - mid) * gain)


def temperature(v: Column, x: float, channel: str, means: dict[str, Column]) -> Column:
    """Warmer below 0 (red up), colder above 0 (blue up), green half as much."""
    lift = {"red": abs(x) if x < 0 else 0.0, "green": abs(x) * 0.5, "blue": abs(x) if x > 0 else 0.0}
    grey = (means["red"] + means["green"] + means["blue"]) / 3
    moved = {k: m + lift[k] for k, m in means.items()}
    grey_moved = (moved["red"] + moved["green"] + moved["blue"]) / 3
    gain = grey_moved / (moved[channel] + EPS) + (1 - grey / (means[channel] + EPS))
    return clamp(v * gain)


def highlight(v: Column, x: float) -> Column:
    return clamp(1 - clamp(F.pow((1 - v) + 1e-9, F.lit(x + 1))))


def shadow(v: Column, x: float) -> Column:
    return clamp(F.pow(v + 1e-9, F.lit(1 - x)))


def level(v: Column, low: int, high: int, gamma: float, out_low: int, out_high: int) -> Column:
    """Stretch, gamma and output stretch of a value in 0..255, down to a whole number."""
    v1 = clamp(255 * (v - low) / F.lit(float(high - low)), 0.0, 255.0)
    v2 = 255 * F.pow(v1 / 255, F.lit(1 / gamma))
    return F.floor(clamp(out_low + (out_high - out_low) * v2 / 255, 0.0, 255.0))


def blend(a: Column, b: Column, mode: str) -> Column:
    """Two layers in [0, 1]."""
    multiply, screen = 2 * a * b, 1 - 2 * (1 - a) * (1 - b)
    if mode == "screen":
        return 1 - (1 - a) * (1 - b)
    if mode == "overlay":
        return F.when(b > 0.5, multiply).otherwise(screen)
    if mode == "soft":
        return F.when(a <= 0.5, (2 * a - 1) * (b - b * b) + b).otherwise((2 * a - 1) * (F.sqrt(b) - b) + b)
    if mode == "strong":
        return F.when(a <= 0.5, multiply).otherwise(screen)
    raise ValueError(mode)


def _num(pos: Column | int) -> Column:
    return pos if isinstance(pos, Column) else F.lit(pos)


def fold_shade(v: Column, at: Column, pos: Column | int, size: int) -> Column:
    """Crease at ``pos``: two gains, one more, and on each side a ramp from 50 to 0, the right one weaker; 0..255."""
    left = F.floor(clamp(v * 0.8 + 1, 0.0, 255.0)) + F.floor(F.lit(50.0) - at * (50.0 / _num(pos)))
    right = F.floor(clamp(v * 0.85 + 1, 0.0, 255.0)) + F.floor(F.lit(50.0) - (at - pos) * (50.0 / (size - _num(pos)))) * 0.8
    return clamp(F.rint(F.when(at < pos, left).otherwise(right)), 0.0, 255.0).cast("bigint")
