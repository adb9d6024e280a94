"""Month strings, sentinel dates and timing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ymd_date(raw: Column) -> Column:
    """YYYYMMDD as a date; blanks, 0 and 00000000 are null."""
    s = F.trim(raw)
    return F.when(~F.lower(s).isin("", "0", "00000000", "nan"), F.try_to_date(s, "yyyyMMdd"))


def ymd_month(raw: Column) -> Column:
    s = F.trim(F.coalesce(raw, F.lit("")))
    return F.when(s.rlike("^[0-9]{6}") & ~s.startswith("00000000"), F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2)))


def month_start(month: Column) -> Column:
    return F.concat(month, F.lit("-01")).try_cast("date")


def month_index(month: Column) -> Column:
    return F.when(month.rlike("^[0-9]{4}-[0-9]{2}$"), F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int"))


def tenure_months(first: Column, last: Column) -> Column:
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1


def timing_bucket(ymd: Column, low: int, high: int) -> Column:
    y = F.substring(ymd, 1, 4).try_cast("int")
    return F.when(y.isNull(), "").when(y < low, f"before_{low}").when(y > high, f"after_{high}").otherwise(f"during_{low}_{high}")


def active_at_claim(month: Column, deactivated: Column, reactivated: Column) -> Column:
    """Whether a provider was active in a service month; null where the month is unknown."""
    at = month_start(month)
    return (
        F.when(at.isNull(), None).when(deactivated.isNull(), True).when(at < deactivated, True)
        .when(reactivated.isNotNull() & (at >= reactivated), True).otherwise(False)
    )
