"""Naming an intermediate value inside one Column expression.

A note on lists: the library explodes computed lists with the ``_outer`` generators and drops the null row of an empty
list afterwards. The inner ones make the optimizer add a "list is not empty" filter below the projection, which works
the whole list out a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often the body names it.

    Lambdas of array functions work out every expression they capture again for each element; bind such expressions
    here first.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
