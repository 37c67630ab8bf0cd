"""Ways to have an expression evaluated once.

Catalyst inlines projections into filters above them, and does not share subexpressions across branches
or inside lambdas. For costly text expressions that is the wrong trade.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with more columns, which later filters and projections use and do not repeat."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))
