"""Aggregate expressions that give the same value whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """Double quotient; NULL instead of an error for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean(column: Column | str) -> Column:
    """Exact sum divided once. ``avg`` of a decimal would round to the decimal's scale + 4."""
    return ratio(F.sum(column), F.count(column))


def late_share(late: Column | str) -> Column:
    """Share of rows whose flag is true; a NULL flag counts as not late."""
    flag = F.col(late) if isinstance(late, str) else late
    return ratio(F.count_if(F.coalesce(flag, F.lit(False))), F.count(F.lit(1)))


def clamp_unit(column: Column) -> Column:
    """Clamp to [0, 1]. ``greatest``/``least`` would turn NULL into a bound."""
    return F.when(column > 1, F.lit(1)).when(column < 0, F.lit(0)).otherwise(column)
