"""Boxes and points as Column expressions. A quad is ARRAY<STRUCT<x, y>> of any length, clockwise from top left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsynth.functions.binding import let
from docsynth.rng import draw


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_to_quad(l: Column, t: Column, r: Column, b: Column) -> Column:
    return F.array(point(l, t), point(r, t), point(r, b), point(l, b))


def quad_to_box(q: Column) -> Column:
    xs, ys = F.transform(q, lambda p: p["x"]), F.transform(q, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("l"), F.array_min(ys).alias("t"), F.array_max(xs).alias("r"), F.array_max(ys).alias("b")
    )


def map_points(q: Column, fx: Callable, fy: Callable) -> Column:
    return F.transform(q, lambda p: point(fx(p["x"], p["y"]), fy(p["x"], p["y"])))


def shift_points(q: Column, dx: Column, dy: Column) -> Column:
    return map_points(q, lambda x, y: x + dx, lambda x, y: y + dy)


def canvas_after_rotation(w: Column, h: Column, degrees: Column) -> tuple[Column, Column]:
    c, s = F.abs(F.cos(F.radians(degrees))), F.abs(F.sin(F.radians(degrees)))
    return (h * s + w * c + 1e-9).cast("bigint"), (h * c + w * s + 1e-9).cast("bigint")


def rotate_points(q: Column, w: Column, h: Column, degrees: Column) -> Column:
    """Rotation about the middle of a w x h picture whose canvas grows to hold it."""

    def angle(d: Column) -> Column:
        new_w, new_h = canvas_after_rotation(w, h, d)
        parts = {"c": F.cos(F.radians(d)), "s": F.sin(F.radians(d)), "cx": F.floor(w / 2), "cy": F.floor(h / 2), "w": new_w, "h": new_h}
        return F.struct(*[v.alias(k) for k, v in parts.items()])

    def move(a: Column) -> Column:
        c, s, cx, cy = a["c"], a["s"], a["cx"], a["cy"]
        dx = (1 - c) * cx - s * cy + a["w"] / 2 - cx
        dy = s * cx + (1 - c) * cy + a["h"] / 2 - cy
        return F.struct(c.alias("c"), s.alias("s"), dx.alias("dx"), dy.alias("dy"))

    def turn(k: Column) -> Column:
        return map_points(
            q,
            lambda x, y: k["c"] * x + k["s"] * y + k["dx"],
            lambda x, y: -k["s"] * x + k["c"] * y + k["dy"],
        )

    return let(degrees, lambda d: let(angle(d), lambda a: let(move(a), turn)))


def perspective_points(q: Column, w: Column, h: Column, left: Column, right: Column) -> Column:
    """Trapezoid: the upper edge is pulled in by the shares ``left`` and ``right`` of the width."""
    args = F.struct(
        (1 - left - right).alias("k"), (left + right).alias("lr"), (w * left).alias("wl"), h.alias("h")
    )

    def warp(a: Column) -> Column:
        def depth(y: Column) -> Column:
            return 1 - a["lr"] * y / a["h"]

        return map_points(
            q,
            lambda x, y: F.floor((a["k"] * x - a["wl"] * y / a["h"] + a["wl"]) / depth(y)),
            lambda x, y: F.floor(a["k"] * y / depth(y)),
        )

    return let(args, warp)


def order_clockwise(q: Column) -> Column:
    """Top left has the least x+y, bottom right the greatest, top right the least y-x of the four."""

    def best(key: Callable[[Column], Column], low: bool) -> Column:
        keyed = F.transform(q, lambda p: F.struct(key(p).alias("k"), p.alias("p")))
        return (F.array_min(keyed) if low else F.array_max(keyed))["p"]

    def s(p: Column) -> Column:
        return p["x"] + p["y"]

    def d(p: Column) -> Column:
        return p["y"] - p["x"]

    return F.array(best(s, True), best(d, True), best(s, False), best(d, False))


def snap(x: Column, unit: Column) -> Column:
    """Nearest multiple, halves to the even one."""
    return F.rint(x / unit) * unit


def centre_inside(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Either span holds the other's middle (whole-pixel middles)."""
    ca, cb = F.floor((a0 + a1) / 2), F.floor((b0 + b1) / 2)
    return ((b0 <= ca) & (ca <= b1)) | ((a0 <= cb) & (cb <= a1))


def crossing(l1: Column, t1: Column, r1: Column, b1: Column, l2: Column, t2: Column, r2: Column, b2: Column) -> Column:
    """Open intervals meet on both axes."""
    return (l1 < r2) & (l2 < r1) & (t1 < b2) & (t2 < b1)


def similar_area(a: Column, b: Column, tolerance: float = 0.1) -> Column:
    return F.abs(a - b) <= F.greatest(a, b) * tolerance


def fit_scale(w: Column, h: Column, box_w: Column, box_h: Column, keep_ratio: bool) -> tuple[Column, Column]:
    sx, sy = box_w / w, box_h / h
    return (F.least(sx, sy), F.least(sx, sy)) if keep_ratio else (sx, sy)


def arc_angle(size: Column, radius: Column, ratio: float = 0.7) -> Column:
    """Angle one letter takes on an arc."""
    return 2 * F.asin(ratio * size * 2**0.5 / 2 / radius)


def arc_vertex(theta: Column, off: Column, radius: Column, turn: Column, sign: int = 1) -> Column:
    """Point at an angle of the arc, pushed outwards by ``off`` and turned about the start.

    A point straight above or below the start stays where it is.
    """
    dx = (radius + off) * F.sin(theta)
    dy = sign * (radius - (radius + off) * F.cos(theta))
    x = F.when(dx == 0, F.lit(0.0)).otherwise(dx * F.cos(turn) - dy * F.sin(turn))
    y = F.when(dx == 0, dy).otherwise(dx * F.sin(turn) + dy * F.cos(turn))
    return point(x.cast("bigint"), y.cast("bigint"))


def to_origin(q: Column) -> Column:
    return let(quad_to_box(q), lambda box: shift_points(q, -box["l"], -box["t"]))


def css_colour(parts: Column) -> Column:
    """RGB of a 1 (grey), 3 (rgb) or 4 (cmyk) component colour in [0, 1]; null is black."""

    def byte(x: Column) -> Column:
        return (x * 255).cast("int")

    n = F.size(parts)
    k = F.get(parts, F.lit(3))
    rgb = [
        F.when(n == 1, byte(F.get(parts, F.lit(0))))
        .when(n == 3, byte(F.get(parts, F.lit(i))))
        .when(n == 4, byte(1 - (F.get(parts, F.lit(i)) + k)))
        .otherwise(0)
        for i in range(3)
    ]
    return F.array(*rgb)


def homography(src: list[tuple[float, float]], dst: list[tuple[float, float]]) -> list[float]:
    """The eight numbers of the warp that takes four points to four others (one fixed mock-up, solved once)."""
    import numpy as np

    rows, rhs = [], []
    for (x, y), (u, v) in zip(src, dst, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        rhs += [u, v]
    return [float(a) for a in np.linalg.solve(np.array(rows, float), np.array(rhs, float))]


def warp_points(q: Column, m: list[Column]) -> Column:
    """Apply the eight numbers of :func:`homography`."""

    def w(x: Column, y: Column) -> Column:
        return m[6] * x + m[7] * y + 1

    return map_points(
        q,
        lambda x, y: (m[0] * x + m[1] * y + m[2]) / w(x, y),
        lambda x, y: (m[3] * x + m[4] * y + m[5]) / w(x, y),
    )


def rectangle_to_quad(width: Column, height: Column, corners: list[tuple[Column, Column]]) -> list[Column]:
    """The eight numbers of the warp that takes the corners of a page (clockwise from the origin) to four points.

    In closed form from the unit square, so every row can have its own scene; a quad of three points in line has none.
    """
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = corners
    ax, ay, bx, by = x1 - x2, y1 - y2, x3 - x2, y3 - y2
    sx, sy = x0 - x1 + x2 - x3, y0 - y1 + y2 - y3
    turn = F.nullif(ax * by - bx * ay, F.lit(0.0))
    g, h = (sx * by - bx * sy) / turn, (ax * sy - sx * ay) / turn
    across = [x1 - x0 + g * x1, y1 - y0 + g * y1, g]
    down = [x3 - x0 + h * x3, y3 - y0 + h * y3, h]
    (a, d, g), (b, e, h) = [x / width for x in across], [x / height for x in down]
    return [a, b, x0, d, e, y0, g, h]


def inflate_quad(q: Column, offset: Column) -> Column:
    """Push every vertex away from the middle of the quad's box."""
    def push(box: Column) -> Column:
        mx, my = (box["l"] + box["r"]) / 2, (box["t"] + box["b"]) / 2
        return map_points(q, lambda x, y: x + F.signum(x - mx) * offset, lambda x, y: y + F.signum(y - my) * offset)

    return let(quad_to_box(q), push)


def align_anchor(align: Column, l: Column, t: Column, r: Column, b: Column, pad: int) -> tuple[Column, Column]:
    """Anchor point of ``lt`` .. ``rb`` inside a padded cell."""
    across, down = F.substring(align, 1, 1), F.substring(align, 2, 1)
    x = F.when(across == "l", l + pad).when(across == "r", r - pad).otherwise(F.floor((l + r) / 2))
    y = F.when(down == "t", t + pad).when(down == "b", b - pad).otherwise(F.floor((t + b) / 2))
    return x, y


def anchored_box(align: Column, x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    """Tight box of a w x h text whose anchor is at (x, y)."""
    across, down = F.substring(align, 1, 1), F.substring(align, 2, 1)
    l = F.when(across == "l", x).when(across == "r", x - w).otherwise(x - F.floor(w / 2))
    t = F.when(down == "t", y).when(down == "b", y - h).otherwise(y - F.floor(h / 2))
    return l, t, l + w, t + h


def crop_window(q: Column, width: int, height: int, offset: int, ident: Column, salt: int) -> Column:
    """STRUCT<l, t, r, b>: a window that holds the quad with ``offset`` around it, drawn between it and the picture's edges."""

    def between(low: Column, high: Column, k: int) -> Column:
        return low + draw(ident, salt + k) % (F.greatest(high - low, F.lit(0)) + 1)

    def window(box: Column) -> Column:
        l, t, r, b = (box[k].cast("bigint") for k in "ltrb")
        zero = F.lit(0).cast("bigint")
        return F.struct(
            between(zero, l - offset, 0).alias("l"), between(zero, t - offset, 1).alias("t"),
            between(r + offset, F.lit(width - 1), 2).alias("r"), between(b + offset, F.lit(height - 1), 3).alias("b"),
        )

    return let(quad_to_box(q), window)


def turned_size(w: Column, h: Column, degrees: Column) -> tuple[Column, Column]:
    """Whole-pixel canvas that holds a picture turned by an angle; the last digits of sine and cosine do not count."""
    s, c = F.abs(F.sin(F.radians(degrees))), F.abs(F.cos(F.radians(degrees)))
    return (h * s + w * c + 1e-9).cast("bigint"), (h * c + w * s + 1e-9).cast("bigint")


def stamp_box(x: Column, y: Column, w: Column, h: Column, degrees: Column, is_round: Column) -> tuple[Column, Column, Column, Column]:
    """Label box of a turned stamp put at (x, y): a round one keeps its size in the middle of the canvas."""
    cw, ch = turned_size(w, h, degrees)
    l = x + F.when(is_round, F.floor((cw - w) / 2)).otherwise(0)
    t = y + F.when(is_round, F.floor((ch - h) / 2)).otherwise(0)
    return l, t, l + F.when(is_round, w).otherwise(cw), t + F.when(is_round, h).otherwise(ch)


def align_in_cell(align: Column, l: Column, t: Column, r: Column, b: Column, pads: list[int]) -> tuple[Column, Column]:
    """Anchor point of ``lt`` .. ``rb`` in a cell with one padding, two (across, down) or four (left, top, right, bottom)."""
    pl, pt, pr, pb = pads * 4 if len(pads) == 1 else pads * 2 if len(pads) == 2 else pads
    across, down = F.substring(align, 1, 1), F.substring(align, 2, 1)
    x = F.when(across == "l", l + pl).when(across == "r", r - pr).otherwise(F.floor((l + r) / 2))
    y = F.when(down == "t", t + pt).when(down == "b", b - pb).otherwise(F.floor((t + b) / 2))
    return x, y


def text_in_cell(c: Column, char: int, align: Column, x: Column, y: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """Tight box of a text anchored at (x, y): spaces at its ends take room but are not in the box."""
    from docsynth.functions.text import display_width

    l, t, r, b = anchored_box(align, x, y, display_width(c) * char, height)
    lead = (F.length(c) - F.length(F.ltrim(c))) * char
    tail = (F.length(c) - F.length(F.rtrim(c))) * char
    return l + lead, t, F.greatest(r - tail, l + lead), b
