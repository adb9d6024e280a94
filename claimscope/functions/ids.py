"""Identifier expressions: all native, so they run inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Luhn sum of the card-issuer prefix 80840, with which provider ids are checked; a fixed value.
PREFIX_SUM = 24


def digits(raw: Column) -> Column:
    """Trimmed, unquoted, without anything but digits."""
    return F.regexp_replace(F.btrim(raw, F.lit(" '\"\t\r\n")), r"[^0-9]", "")


def luhn_check_digit(nine: Column) -> Column:
    """The check digit of the first nine digits of a provider id."""
    def value(i: int) -> Column:
        d = F.substring(nine, i + 1, 1).cast("int")
        return d if i % 2 else F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = reduce(lambda a, b: a + b, [value(i) for i in range(9)], F.lit(PREFIX_SUM))
    return (10 - total % 10) % 10


def canonical_npi(raw: Column) -> Column:
    """The ten digits of a valid provider id, else null."""
    d = digits(raw)
    return F.when(F.length(d) == 10, F.when(luhn_check_digit(d) == F.substring(d, 10, 1).cast("int"), d))


def is_valid_npi(raw: Column) -> Column:
    return canonical_npi(raw).isNotNull()


def identifier_bucket(raw: Column) -> Column:
    """Five exclusive classes of identifiers that matched no provider."""
    s = F.trim(F.coalesce(raw, F.lit("")))
    ten = s.rlike(r"^[0-9]{10}$")
    return (
        F.when(s == "", "blank")
        .when(s.rlike(r"^[A-Za-z]"), "alpha_prefixed")
        .when(ten & is_valid_npi(raw), "valid_not_registered")
        .when(ten, "failed_luhn")
        .otherwise("malformed")
    )


def quarantined(raw: Column) -> Column:
    """True for ids that are there, aren't all zeros, and fail the check."""
    d = F.trim(F.coalesce(raw, F.lit("")))
    return (d != "") & ~d.rlike("^0+$") & canonical_npi(raw).isNull()


def malformed_code(code: Column) -> Column:
    """True unless a billing code is five digits, or a letter and four digits."""
    return ~F.coalesce(code, F.lit("")).rlike("^(?:[0-9]{5}|[A-Za-z][0-9]{4})$")
