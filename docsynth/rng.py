"""Seeded pseudo-random columns.

Integer arithmetic only (three congruential steps modulo 2^31-1), so a value depends on the row's id and a salt alone:
the same on every run, on every partitioning, after a lost executor, and in any other SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

M = 2147483647


def draw(ident: Column, salt: int) -> Column:
    """Integer in [0, 2^31-1) for a row id and a salt. Ids beyond 2^31 keep their high part."""
    ident = ident.cast("bigint")
    high = F.shiftright(ident, 31) % 1000003
    x1 = ((ident % M) * 48271 + high * 7919 + (salt * 69621 + 11)) % M
    x2 = (x1 * (x1 + 12345) + salt) % M
    return (x2 * (x2 + 54321) + 7) % M


def uniform(ident: Column, salt: int) -> Column:
    """DOUBLE in [0, 1)."""
    return draw(ident, salt) / F.lit(float(M))


def integer(ident: Column, salt: int, low: int, high: int) -> Column:
    """BIGINT in low..high, both ends included."""
    return draw(ident, salt) % (high - low + 1) + low


def pick(ident: Column, salt: int, options: list) -> Column:
    """One of a short fixed list."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (draw(ident, salt) % len(options) + 1).cast("int"))


def digits(ident: Column, salt: int, n: int) -> Column:
    """A string of n pseudo-random digits."""
    parts, left = [], n
    while left > 0:
        k = min(left, 6)
        parts.append(F.lpad((draw(ident, salt + len(parts)) % 10**k).cast("string"), k, "0"))
        left -= k
    return F.concat(*parts)


def letters(ident: Column, salt: int, n: int) -> Column:
    """A string of n pseudo-random capital letters."""
    return F.concat(*[F.char(draw(ident, salt + i) % 26 + 65) for i in range(n)])
