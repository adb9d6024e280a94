"""Ratios, casts and ranks whose corner cases differ between engines."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def log1p_positive(x: Column) -> Column:
    return F.when(x > 0, F.log1p(x))


def number(raw: Column) -> Column:
    return raw.try_cast("double")


def not_nan(x: Column) -> Column:
    """NaN compares as the largest number; null is what is meant."""
    return F.when(~F.isnan(x), x)


def mean_tie_percentile(x: Column, *by: Column) -> Column:
    """Percentile rank with ties at their mean rank; nulls are neither ranked nor counted. One sort for all three parts."""
    order = Window.partitionBy(*by).orderBy(x.asc_nulls_last())
    ties = F.count(x).over(order.rangeBetween(Window.currentRow, Window.currentRow))
    n = F.count(x).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.when(x.isNotNull(), (F.rank().over(order) + (ties - 1) / F.lit(2.0)) / n)


def bin_of(position: Column, n: Column, bins: int) -> Column:
    """The bin (1 to ``bins``) of a 1-based rank among n rows, with right-closed equal-width edges."""
    edge = F.ceil((position - 1) * F.lit(bins) / F.nullif(n - 1, F.lit(0)).cast("double"))
    return F.greatest(F.lit(1), F.coalesce(edge, F.lit(1))).cast("int")
