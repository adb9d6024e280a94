"""Name, address and state expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Business and title tokens that name keys leave out; fixed values.
NAME_TOKENS = ("LLC", "L L C", "INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "LTD", "LP", "LLP", "PLLC", "PC", "PA", "MD", "DO", "JR", "SR", "II", "III")
#: Legal suffixes that company keys leave out; fixed values.
LEGAL_SUFFIXES = ("INC", "INCORPORATED", "LLC", "CORP", "CORPORATION", "CO", "COMPANY", "PC", "PA", "LTD", "LP", "LLP")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _without(c: Column, tokens: tuple[str, ...]) -> Column:
    return F.regexp_replace(c, r"\b(" + "|".join(tokens) + r")\b", " ")


def name_key(raw: Column) -> Column:
    upper = F.trim(F.upper(F.coalesce(raw, F.lit(""))))
    return collapse(_without(F.regexp_replace(upper, "[.,]", " "), NAME_TOKENS))


def address_key(line1: Column, city: Column, state: Column, zip_: Column) -> Column:
    text = [F.upper(F.coalesce(c, F.lit(""))) for c in (line1, city, state)]
    zip5 = F.substring(F.regexp_replace(F.coalesce(zip_, F.lit("")), "[^0-9]", ""), 1, 5)
    return collapse(F.regexp_replace(F.concat_ws(" ", *text, zip5), "[.,]", " "))


def company_key(raw: Column) -> Column:
    plain = F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[^A-Z0-9 ]", " ")
    return collapse(_without(F.regexp_replace(plain, "^THE ", ""), LEGAL_SUFFIXES))


def name_root(raw: Column, tokens: int = 3) -> Column:
    return F.array_join(F.slice(F.split(company_key(raw), " "), 1, tokens), " ")


def spaced_alnum(raw: Column) -> Column:
    return F.trim(F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[^A-Z0-9]+", " "))


def bare_alnum(raw: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[^A-Z0-9]", "")


def display_name(org: Column, last: Column, first: Column) -> Column:
    """The organisation, else ``LAST, FIRST``."""
    person = F.btrim(F.concat(F.coalesce(last, F.lit("")), F.lit(", "), F.coalesce(first, F.lit(""))), F.lit(", "))
    return F.when(F.coalesce(org, F.lit("")) != "", org).otherwise(person)


def name_match(a: Column, b: Column) -> Column:
    x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    return (
        F.when((x == "") | (y == ""), "unknown").when(x == y, "exact")
        .when(F.arrays_overlap(F.split(x, r"\s+"), F.split(y, r"\s+")), "partial").otherwise("mismatch")
    )


def state_codes(cell: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), "[;,/]"), lambda p: F.upper(F.trim(p))), lambda p: F.length(p) == 2))


def role_rank(role: Column) -> Column:
    """3 for managers and owners, 2 for directors, officers and partners, 1 for others."""
    r = F.upper(F.coalesce(role, F.lit("")))
    return F.when(r.contains("MANAG") | r.contains("OWNER"), 3).when(r.contains("DIRECTOR") | r.contains("OFFICER") | r.contains("PARTNER"), 2).otherwise(1)


def role_weight(role: Column) -> Column:
    r = F.upper(F.coalesce(role, F.lit("")))
    return (
        F.when(r.contains("MANAGING") | r.contains("5%") | r.contains("OWNER"), 1.0)
        .when(r.contains("DIRECTOR") | r.contains("OFFICER") | r.contains("PARTNER"), 0.6).otherwise(0.3)
    )
