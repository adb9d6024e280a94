"""Small fixed look-ups: specialties by taxonomy code, states, tier labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# A seed of taxonomy codes; a full table can be passed instead.
SPECIALTIES = {
    "207Q00000X": "Family Medicine",
    "207R00000X": "Internal Medicine",
    "163W00000X": "Registered Nurse",
    "251E00000X": "Home Health Agency",
    "314000000X": "Skilled Nursing Facility",
    "3416L0300X": "Ambulance (Land Transport)",
    "261QM1300X": "Multi-Specialty Clinic",
}
# Postal codes of states and territories.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine",
    "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire",
    "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming", "PR": "Puerto Rico", "VI": "U.S. Virgin Islands", "GU": "Guam", "AS": "American Samoa",
}
#: What readers of the company list see for its tiers; fixed values.
TIER_LABELS = {"1_billed_after_exclusion": "Direct — billed while excluded", "2_on_leie": "Direct — on LEIE", "3_company_anomaly": "Company anomaly", "4_probable_owner": "Probable excluded owner"}


def mapping(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*values.items())])


def looked_up(key: Column, values: dict[str, str]) -> Column:
    """The value of ``key``, null where there is none."""
    return F.try_element_at(mapping(values), key)


def specialty(code: Column, names: dict[str, str] | None = None) -> Column:
    """The readable specialty of a registry record."""
    return F.coalesce(looked_up(F.trim(F.coalesce(code, F.lit(""))), names or SPECIALTIES), F.lit("Unknown / not in crosswalk"))


def lead_specialty(code: Column, names: dict[str, str] | None = None) -> Column:
    """The specialty of a lead: its name, else the code itself; empty without a code."""
    c = F.trim(F.coalesce(code, F.lit("")))
    return F.when(c == "", "").otherwise(F.coalesce(looked_up(c, names or SPECIALTIES), F.concat(c, F.lit(" (taxonomy code)"))))


def full_states(cell: Column) -> Column:
    """Distinct full state names of a cell such as ``tx; California/NY``, in order; what isn't a state stays.

    Names are the same if they are in upper case; the first spelling stays.
    """
    names = mapping(STATES | {v.upper(): v for v in STATES.values()})
    parts = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), "[;,/]"), lambda p: F.trim(p)), lambda p: p != "")
    full = F.transform(parts, lambda p: F.coalesce(F.try_element_at(names, F.upper(p)), p))
    return F.filter(full, lambda p, i: F.array_position(F.transform(full, lambda p: F.upper(p)), F.upper(p)) == i + 1)
