"""Lead lists: look-ups, names, reasons, and the projections that are exported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions import screening
from claimscope.functions.lookups import TIER_LABELS, full_states, lead_specialty, looked_up, specialty
from claimscope.functions.names import spaced_alnum
from claimscope.operators.companies import TIERS as COMPANY_TIERS


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def _some(c: Column) -> Column:
    return F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))


def company_lookups(members: DataFrame, names: DataFrame) -> DataFrame:
    """company_id, top_npi (most dollars, ties by npi), its dollars, the name it resolves to, and the taxonomy with most dollars.

    ``members``: npi, company_id, net_paid, primary_taxonomy, org_legal_name, one row an npi;
    ``names``: npi, provider_name.
    """
    known = members.join(names.select("npi", "provider_name"), "npi", "left")
    top = known.groupBy("company_id").agg(F.max_by(F.struct("npi", "net_paid", F.coalesce(_some(F.col("provider_name")), _some(F.col("org_legal_name"))).alias("name")), F.struct(F.coalesce("net_paid", F.lit(-1e300).cast("double")).cast("double"), "npi")).alias("b"))
    by_tax = members.where(_text("primary_taxonomy") != "").groupBy("company_id", "primary_taxonomy").agg(F.sum(F.coalesce("net_paid", F.lit(0))).alias("p"))
    tax = by_tax.groupBy("company_id").agg(F.max_by("primary_taxonomy", F.struct("p", "primary_taxonomy")).alias("dominant_taxonomy"))
    return top.join(tax, "company_id", "left").select("company_id", F.col("b.npi").alias("top_npi"), F.col("b.net_paid").alias("top_net_paid"), F.col("b.name").alias("resolved_name"), "dominant_taxonomy")


def named(leads: DataFrame, lookups: DataFrame) -> DataFrame:
    """``leads`` with a company name that is never an id, name_unresolved, specialty, top_npi."""
    met = leads.join(lookups, "company_id", "left")
    own = _text("company_name")
    bad = (own == "") | own.startswith("npi:")
    name = F.when(~bad, own).otherwise(F.coalesce("resolved_name", F.concat(F.lit("UNKNOWN NAME (NPI "), F.col("top_npi"), F.lit(")"))))
    return met.withColumns({
        "name_unresolved": bad & F.col("resolved_name").isNull(), "company_name": name, "specialty": lead_specialty(F.col("dominant_taxonomy")),
        "tier_label": F.coalesce(looked_up(F.col("priority_tier"), TIER_LABELS), F.col("priority_tier")),
    }).drop("resolved_name", "dominant_taxonomy", "top_net_paid")


def sentence() -> Column:
    """Why a company is a lead, as sentences; needs contributing_concepts, a list, and genuine_fragmentation."""
    tier = F.col("priority_tier")
    own = F.filter(F.transform(F.filter(F.coalesce("contributing_concepts", F.array().cast("array<string>")), lambda x: ~x.contains("context")), lambda x: F.trim(F.substring_index(x, "(", 1))), lambda x: x != "")
    parts = [
        F.when(tier == COMPANY_TIERS[0], F.concat(F.lit("Billed while excluded — a constituent NPI billed on or after its OIG LEIE exclusion date ($"), F.format_number(F.coalesce(F.col("paid_after").cast("double"), F.lit(0.0)), 0), F.lit(" billed after exclusion)")))
        .when(tier == COMPANY_TIERS[1], "A constituent NPI is on the OIG LEIE exclusion list")
        .when(tier == COMPANY_TIERS[2], F.format_string("Company-level billing anomaly vs. company peers (score %.2f)", F.coalesce("company_anomaly_score", F.lit(0.0))))
        .when(tier == COMPANY_TIERS[3], "A facility has a probable excluded owner (low-confidence name match)"),
        F.when((F.size(own) > 0) & (tier != COMPANY_TIERS[0]), F.concat(F.lit("company anomaly: "), F.array_join(own, " + "), F.lit(" at ≥99th percentile vs peers"))),
        F.when(F.col("genuine_fragmentation"), "billing is genuinely fragmented across NPIs (possible split-billing — no single NPI was flagged, but the company is extreme consolidated)"),
        F.when(F.col("any_provider_on_leie") & ~tier.isin(*COMPANY_TIERS[:2]), "also has an NPI on the OIG LEIE list"),
        F.when(F.col("any_probable_excluded_owner") & (tier != COMPANY_TIERS[3]), "also has a probable excluded owner"),
    ]
    return F.concat(F.concat_ws(". ", *parts), F.lit("."))


def provider_leads(leads: DataFrame, names: DataFrame, cases: DataFrame) -> DataFrame:
    """The exported columns of provider leads: name, kind, taxonomy and its description, tier, dollars, exclusion case, reasons.

    ``leads``: as detect() writes them, with org_legal_name, entity_type, primary_taxonomy and
    practice_state; ``cases``: npi, disposition, paid_after.
    """
    met = leads.join(names.select("npi", F.col("provider_name").alias("__name")), "npi", "left").join(cases.select("npi", F.col("disposition").alias("layer1_disposition"), F.col("paid_after").alias("__after")), "npi", "left")
    reasons = F.concat_ws(" | ", _some(F.array_join("rule_reasons", "; ")), _some(F.array_join("contributing_concepts", "; ")), F.when(F.col("probable_owner"), "probable_excluded_owner"))
    return met.select(
        "npi", F.coalesce(_some(F.col("__name")), _some(F.col("org_legal_name"))).alias("provider_name"), F.when(F.col("entity_type") == "1", "individual").when(F.col("entity_type") == "2", "organization").otherwise("(unknown)").alias("entity_type"),
        "primary_taxonomy", F.when(specialty(F.col("primary_taxonomy")).startswith("Unknown"), "").otherwise(specialty(F.col("primary_taxonomy"))).alias("taxonomy_description"), F.col("practice_state").alias("state"), "priority_tier", "priority_rank",
        F.round(F.col("net_paid").cast("double"), 2).alias("net_paid"), "provider_on_leie", "billed_after_exclusion", "layer1_disposition", F.col("__after").alias("paid_after"),
        F.round("anomaly_score", 4).alias("anomaly_score"), "n_concept_signals", F.array_join("contributing_concepts", "; ").alias("contributing_concepts"), F.col("probable_owner").alias("probable_excluded_owner"), reasons.alias("reasons"),
    )


def final_leads(projected: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Leads of any tier with enough dollars."""
    return projected.where((F.col("priority_tier") != "6_none") & (F.col("net_paid") >= cfg.min_net_paid))


def excluded_leads(projected: DataFrame) -> DataFrame:
    """Leads that billed after their exclusion, or whose case is qualified, whatever their dollars."""
    return projected.where((F.col("priority_rank") == 1) | (F.coalesce("layer1_disposition", F.lit("")) == "QUALIFIED"))


def lead_kinds() -> dict[str, Column]:
    """The flat exports by kind: one projection, four predicates."""
    rank = F.col("priority_rank")
    return {"fraud_leads": F.lit(True), "leads_ranked": rank <= 5, "layer1_rule_hits": rank <= 3, "layer3_ownership_leads": F.coalesce("probable_excluded_owner", F.lit(False))}


def advert_selection(companies: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Companies for outreach with the reason why one isn't: ``reason`` (null: kept) and ``matched``.

    Selected are companies with enough dollars and an anomaly score at the bar or a listed provider.
    Removed are those without a name, those that the advertising screen names, and repeats of a
    name in the same first state, of which the best (listed, score, dollars, id) stays.
    """
    listed, score = F.coalesce("any_provider_on_leie", F.lit(False)), F.coalesce("max_anomaly_score", F.lit(0.0))
    picked = companies.where((F.col("company_net_paid") >= cfg.min_net_paid) & ((score >= cfg.anomaly_bar) | listed))
    states = full_states(F.col("states"))
    ready = picked.withColumns({
        "states_all": F.array_join(states, "; "), "lead_strength": screening.strength_band(score, listed), "__class": screening.advert_class(F.col("company_name")), "__word": screening.advert_matched(F.col("company_name")),
        "__key": spaced_alnum(F.col("company_name")), "__state": F.upper(F.coalesce(F.get(states, F.lit(0)), F.lit(""))),
    })
    blank = _text("company_name") == ""
    fit = ~blank & F.col("__class").isNull()
    alone = F.when(fit, F.col("__state")).otherwise(F.concat(F.lit("|"), "company_id"))  # what is removed anyway stands alone
    same = Window.partitionBy("__key", alone).orderBy(listed.desc(), score.desc(), F.col("company_net_paid").desc(), "company_id")
    met = ready.withColumns({"__n": F.row_number().over(same), "__first": F.first("company_name").over(same)})
    reason = F.when(blank, "missing_name").otherwise(F.coalesce("__class", F.when(F.col("__n") > 1, "duplicate")))
    matched = F.when(blank, "").otherwise(F.coalesce("__word", F.when(F.col("__n") > 1, F.col("__first"))))
    return met.select(*companies.columns, "states_all", "lead_strength", reason.alias("reason"), matched.alias("matched"))


def model_leads(scores: DataFrame, lookups: DataFrame, top_k: int = 5000, min_score: float = 0.0, cfg: Config = DEFAULT) -> DataFrame:
    """The top_k companies by model score, then dollars, with resolved names and ranks.

    ``scores``: company_scores() with company_name; ``lookups``: company_id, best_npi and best_name of the
    constituent with the highest score (best_members()), npi_list. The k rows are the feature of the list.
    """
    fit = scores.where((F.col("company_net_paid") >= cfg.min_net_paid) & (F.col("max_score") >= min_score))
    best = fit.orderBy(F.col("max_score").desc(), F.col("company_net_paid").desc(), "company_id").limit(top_k)
    met = best.join(lookups, "company_id", "left")
    name = F.coalesce(_some(F.col("company_name")), _some(F.col("best_name")), F.concat(F.lit("UNKNOWN NAME (NPI "), F.col("best_npi"), F.lit(")")))
    rank = F.row_number().over(Window.orderBy(F.col("max_score").desc(), F.col("company_net_paid").desc(), "company_id"))  # at most top_k rows
    return met.withColumn("company_name", name).withColumn("rank", rank).drop("best_name", "best_npi")


def best_members(members: DataFrame, score: str = "score") -> DataFrame:
    """company_id, best_npi and best_name (highest score, ties by the least number), npi_list (highest score, ties by npi as text), specialty_code of the member with most dollars."""
    down = (-F.coalesce(F.col(score), F.lit(-1.0))).alias("o")
    listed = F.array_sort(F.collect_list(F.struct(down, "npi")))
    best = F.min(F.struct(down, F.length("npi").alias("digits"), "npi", "org_legal_name"))  # by length, then text: as numbers
    agg = members.groupBy("company_id").agg(listed.alias("l"), best.alias("b"), F.max_by("primary_taxonomy", F.struct(F.coalesce(F.col("net_paid").cast("double"), F.lit(-1e300)), "npi")).alias("specialty_code"))
    return agg.select("company_id", F.col("b.npi").alias("best_npi"), F.col("b.org_legal_name").alias("best_name"), F.array_join(F.transform("l", lambda x: x["npi"]), "|").alias("npi_list"), "specialty_code")


def screened(leads: DataFrame, name: str, code: str) -> DataFrame:
    """Adds removed_category and matched of the lead screen (null: kept)."""
    return leads.withColumns({"removed_category": screening.lead_class(F.col(name), F.col(code)), "matched": screening.lead_matched(F.col(name), F.col(code))})


def provider_model_leads(scores: DataFrame, min_net_paid: float = 5_000_000.0, min_score: float = 0.9) -> DataFrame:
    """Reliable providers above both floors with a name that is never empty, screened."""
    fit = scores.where(F.col("score_reliable") & (F.col("net_paid") >= min_net_paid) & (F.col("score") >= min_score))
    kind = F.when(F.col("entity_type") == "1", "INDIVIDUAL PROVIDER").otherwise("UNKNOWN NAME")
    name = F.coalesce(_some(F.col("org_legal_name")), F.concat(kind, F.lit(" (NPI "), F.col("npi"), F.lit(")")))
    return screened(fit, "org_legal_name", "primary_taxonomy").withColumn("provider_name", name)
