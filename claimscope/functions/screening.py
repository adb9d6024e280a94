"""Whole-word keyword classes of organisation names, for false-positive screening."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimscope.functions.names import spaced_alnum

# Keyword lists of the screening classes, first match wins.
GOVERNMENT = ("COUNTY OF", "CITY OF", "STATE OF", "COMMONWEALTH OF", "TOWN OF", "VILLAGE OF", "BOROUGH OF", "PARISH OF", "DEPARTMENT OF", "DEPT OF", "BOARD OF", "HOSPITAL DISTRICT", "HEALTH DISTRICT", "HEALTHCARE DISTRICT", "HEALTH AUTHORITY", "HOSPITAL AUTHORITY", "PUBLIC HEALTH", "MUNICIPAL", "HEALTH AND HOSPITALS", "HOSPITAL SERVICE DISTRICT", "HEALTH CARE DISTRICT", "HEALTHCARE AUTHORITY", "MEDICAL CENTER AUTHORITY", "SERVICE DISTRICT NO")
TRIBAL = ("TRIBE", "TRIBAL", "RANCHERIA", "PUEBLO", "NATION", "BAND OF", "NATIVE AMERICAN", "INDIAN HEALTH", "INDIAN NATION", "INDIAN TRIBE", "REGIONAL HEALTH CONSORTIUM", "NATIVE ASSOCIATION", "ALASKA NATIVE")
PUBLIC_ACADEMIC = ("UNIVERSITY", "REGENTS OF", "BOARD OF REGENTS", "STATE COLLEGE", "COLLEGE OF MEDICINE")
NONPROFIT = ("VOLUNTEERS OF AMERICA", "SALVATION ARMY", "GOODWILL", "CATHOLIC CHARITIES", "EASTERSEALS", "EASTER SEALS", "SHRINERS", "BANCROFT", "MELMARK", "THE ARC", "ARC OF", "UNITED WAY", "YMCA", "YWCA", "RED CROSS", "LUTHERAN SOCIAL SERVICES", "JEWISH FAMILY", "ST JUDE", "BOYS AND GIRLS", "BOYS GIRLS CLUB")
HOSPITAL = ("HOSPITAL", "MEDICAL CENTER", "MED CENTER", "MED CTR", "INFIRMARY", "HEALTH SYSTEM", "HEALTHCARE SYSTEM", "HEALTH NETWORK", "CLINIC FOUNDATION", "ASCENSION", "PROVIDENCE HEALTH", "TRINITY HEALTH", "ADVENTIST", "CATHOLIC HEALTH", "DIGNITY HEALTH", "COMMONSPIRIT", "KAISER", "MAYO CLINIC", "CLEVELAND CLINIC", "INTERMOUNTAIN", "SUTTER", "GEISINGER", "OCHSNER", "BANNER HEALTH")
#: The advertising screen has its own, partly shorter lists.
ADVERT_GOVERNMENT = ("COUNTY OF", "CITY OF", "CITY & COUNTY OF", "CITY AND COUNTY OF", "STATE OF", "COMMONWEALTH OF", "TOWN OF", "VILLAGE OF", "BOROUGH OF", "PARISH OF", "DEPARTMENT OF", "DEPT OF", "BOARD OF", "HOSPITAL DISTRICT", "HEALTH DISTRICT", "HEALTHCARE DISTRICT", "HEALTH AUTHORITY", "HOSPITAL AUTHORITY", "PUBLIC HEALTH", "MUNICIPAL", "HEALTH AND HOSPITALS")
ADVERT_TRIBAL = ("TRIBE", "TRIBAL", "RANCHERIA", "PUEBLO", "NATION", "BAND OF", "NATIVE AMERICAN", "INDIAN HEALTH", "INDIAN NATION", "INDIAN TRIBE")
ADVERT_NONPROFIT = ("VOLUNTEERS OF AMERICA", "SALVATION ARMY", "GOODWILL", "CATHOLIC CHARITIES", "EASTERSEALS", "EASTER SEALS", "SHRINERS", "BANCROFT", "MELMARK", "THE ARC", "ARC OF", "UNITED WAY", "YMCA", "YWCA", "RED CROSS", "LUTHERAN SOCIAL SERVICES", "GOOD SAMARITAN SOCIETY", "EVANGELICAL LUTHERAN", "JEWISH FAMILY", "ST JUDE", "BOYS AND GIRLS", "BOYS GIRLS CLUB")
LABS = ("LABORATORY CORPORATION OF AMERICA", "LABCORP", "QUEST DIAGNOSTICS")
FISCAL = ("PUBLIC PARTNERSHIPS", "CONSUMER DIRECT CARE", "ACUMEN FISCAL", "GT INDEPENDENCE", "TEMPUS UNLIMITED", "PALCO", "MORNING SUN FINANCIAL", "ANNKISSAM", "FISCAL")
CORP_TOKENS = ("LLC", "INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "LTD", "LLP", "PLLC", "PC", "PA", "CENTER", "CENTRE", "SERVICES", "SERVICE", "CARE", "HEALTH", "HEALTHCARE", "CLINIC", "AGENCY", "GROUP", "ASSOCIATES", "ASSOCIATION", "FOUNDATION", "HOSPITAL", "HOME", "SYSTEM", "SYSTEMS", "PARTNERS", "NETWORK", "SOLUTIONS", "INSTITUTE", "ENTERPRISES", "WELLNESS", "RECOVERY", "BEHAVIORAL", "FAMILY", "COMMUNITY", "THERAPY", "MEDICAL")
FQHC_TAXONOMY, HOSPITAL_TAXONOMY_PREFIXES = "261QF0400X", ("282", "283", "273")
PERSON = r"^[A-Z][A-Za-z.'\-]+,\s+[A-Z][A-Za-z.'\-]+(?:\s+[A-Z][A-Za-z.'\-]*\.?){0,2}$"

LEAD_RULES = (("government", GOVERNMENT), ("tribal", TRIBAL), ("public_academic", PUBLIC_ACADEMIC), ("national_nonprofit", NONPROFIT), ("hospital_name", HOSPITAL))
ADVERT_RULES = (("labs", LABS), ("fiscal_intermediary", FISCAL), ("government", ADVERT_GOVERNMENT), ("tribal", ADVERT_TRIBAL), ("public_academic", PUBLIC_ACADEMIC), ("national_nonprofit", ADVERT_NONPROFIT))


def taxonomy_code(text: Column) -> Column:
    return F.regexp_extract(F.upper(F.coalesce(text, F.lit(""))), "([0-9]{3}[A-Z0-9]{6}X)", 1)


def has_word(name: Column, keywords: tuple[str, ...]) -> Column:
    return name.rlike(r"\b(?:" + "|".join(map(re.escape, keywords)) + r")\b")


def _ends_with_county(name: Column) -> Column:
    return name.rlike(r"\bCOUNTY$")


def lead_class(name: Column, specialty: Column) -> Column:
    """Taxonomy rules come before name rules; a name that ends with COUNTY is government. Null where none fits."""
    code, n = taxonomy_code(specialty), spaced_alnum(name)
    by_code = F.when(code == FQHC_TAXONOMY, "fqhc_taxonomy").when(F.substring(code, 1, 3).isin(*HOSPITAL_TAXONOMY_PREFIXES), "hospital_taxonomy")
    hit = {label: has_word(n, words) for label, words in LEAD_RULES}
    hit["government"] = hit["government"] | _ends_with_county(n)
    return F.coalesce(by_code, *[F.when(h, label) for label, h in hit.items()])


def first_keyword(name: Column, rules: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """The first keyword, in rule order, that a spaced_alnum() name has; null where it has none."""
    return F.coalesce(*[F.when(has_word(name, (k,)), k) for _, ks in rules for k in ks], F.lit(None).cast("string"))


def lead_matched(name: Column, specialty: Column) -> Column:
    """What lead_class() met: the taxonomy code, the keyword, or the ending."""
    code, n = taxonomy_code(specialty), spaced_alnum(name)
    by_code = F.when((code == FQHC_TAXONOMY) | F.substring(code, 1, 3).isin(*HOSPITAL_TAXONOMY_PREFIXES), code)
    government, others = LEAD_RULES[:1], LEAD_RULES[1:]
    return F.coalesce(by_code, first_keyword(n, government), F.when(_ends_with_county(n), "ENDS WITH COUNTY"), first_keyword(n, others))


def has_corp_token(name: Column) -> Column:
    """Corporate tokens, also when written as single letters (L L C)."""
    n = spaced_alnum(name)
    merged = F.regexp_replace(n, r"(?<=\b[A-Z0-9]) (?=[A-Z0-9]\b)", "")
    words = F.array(*[F.lit(t) for t in CORP_TOKENS])
    return F.arrays_overlap(F.split(n, " "), words) | F.arrays_overlap(F.split(merged, " "), words)


def _is_person(name: Column) -> Column:
    return F.trim(F.coalesce(name, F.lit(""))).rlike(PERSON) & ~has_corp_token(name)


def advert_class(name: Column) -> Column:
    """The advertising screen: people, then its keywords; a name that ends with COUNTY is government only where no keyword fits."""
    n = spaced_alnum(name)
    by_word = [F.when(has_word(n, words), label) for label, words in ADVERT_RULES]
    return F.coalesce(F.when(_is_person(name), "individual"), *by_word, F.when(_ends_with_county(n), "government"))


def advert_matched(name: Column) -> Column:
    """What advert_class() met."""
    n = spaced_alnum(name)
    return F.coalesce(F.when(_is_person(name), "person-name"), first_keyword(n, ADVERT_RULES), F.when(_ends_with_county(n), "ENDS WITH COUNTY"))


def strength_band(score: Column, listed: Column) -> Column:
    return F.when(listed, "high").when(score >= 0.9, "high").when(score >= 0.8, "medium").otherwise("low")
