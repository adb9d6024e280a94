"""Companies: key precedence, roll-up, tiers and triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.names import company_key, name_root

#: Company tiers in order of precedence; fixed values.
TIERS = ("1_billed_after_exclusion", "2_on_leie", "3_company_anomaly", "4_probable_owner", "5_none")


def link(providers: DataFrame) -> DataFrame:
    """Adds company_id and basis: PAC id, else an owner shared by two non-PAC providers, else the name, else itself.

    ``providers``: npi, pac_id, owner_key, org_legal_name, one row an npi. There is no transitive closure.
    """
    some = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    ready = providers.withColumns({"__pac": some("pac_id"), "__name": company_key(F.col("org_legal_name"))}).withColumn("__own", F.when(F.col("__pac").isNull(), some("owner_key")))
    shared = F.when(F.col("__own").isNotNull() & (F.count("__own").over(Window.partitionBy("__own")) >= 2), F.col("__own"))
    named = F.when(F.col("__name") != "", F.col("__name"))
    kinds = {"pac": (F.col("__pac"), "pac_id"), "owner": (F.col("__shared"), "shared_owner"), "name": (named, "name")}
    out = ready.withColumn("__shared", shared)
    company = F.coalesce(*[F.concat(F.lit(f"{k}:"), c) for k, (c, _) in kinds.items()], F.concat(F.lit("npi:"), F.col("npi")))
    basis = F.coalesce(*[F.when(c.isNotNull(), b) for c, b in kinds.values()], F.lit("single"))
    return out.withColumns({"company_id": company, "merge_basis_raw": basis}).drop("__pac", "__own", "__name", "__shared")


def _joined(c: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.when(c != "", c))), "; ")


def rollup(linked: DataFrame) -> DataFrame:
    """One row a company from linked providers with their signals; built-in aggregates only."""
    net = F.col("net_paid")
    listed = F.array_sort(F.collect_list(F.struct((-net).alias("o"), F.col("npi"), net.alias("net"))))
    agg = linked.groupBy("company_id").agg(
        F.sum(F.coalesce(net, F.lit(0))).alias("company_net_paid"), F.sum(F.coalesce("gross_paid", F.lit(0))).alias("company_gross_paid"), F.count(F.lit(1)).alias("npi_count"), F.max(net).alias("max_constituent_net_paid"),
        _joined(F.col("practice_state")).alias("states"), F.count_distinct(F.when(F.col("practice_state") != "", F.col("practice_state"))).alias("n_states"),
        F.substring(_joined(F.col("primary_taxonomy")), 1, 200).alias("primary_taxonomies"), _joined(F.col("entity_type")).alias("entity_types"),
        F.coalesce(F.min(F.when(F.col("org_legal_name") != "", F.struct("npi", "org_legal_name")))["org_legal_name"], F.lit("")).alias("company_name"),
        F.min("merge_basis_raw").alias("raw"), F.bool_or("provider_on_leie").alias("any_provider_on_leie"), F.bool_or("billed_after_exclusion").alias("any_billed_after_exclusion"),
        F.max("anomaly_score").alias("max_anomaly_score"), F.max(F.coalesce("n_concept_signals", F.lit(0))).alias("max_n_concept_signals"), F.bool_or("probable_owner").alias("any_probable_excluded_owner"),
        F.min(F.coalesce("priority_rank", F.lit(6))).alias("best_priority_rank"), F.bool_or(F.coalesce("npi_lead", F.lit(False))).alias("any_npi_lead"),
        F.array_join(F.transform(listed, lambda x: F.concat(x["npi"], F.lit(":"), F.format_number(x["net"].cast("double"), 0))), "; ").alias("npi_list"),
    )
    based = agg.withColumn("merge_basis", F.when(F.col("npi_count") >= 2, F.col("raw")).otherwise("single")).drop("raw")
    basis = F.col("merge_basis")
    trust = F.when(basis.isin("pac_id", "shared_owner"), "high").when(basis == "single", "single").when(F.col("n_states") <= 1, "medium").otherwise("low")
    return based.withColumn("merge_confidence", trust).withColumn("flagged", F.col("best_priority_rank") <= 5)


def strength() -> Column:
    """What ranks within a tier: the score for anomalies, dollars after exclusion for the first tier, else size."""
    return F.when(F.col("priority_rank") == 3, F.coalesce("company_anomaly_score", F.lit(0.0))).when(F.col("priority_rank") == 1, F.coalesce(F.col("paid_after").cast("double"), F.lit(0.0))).otherwise(F.col("company_net_paid").cast("double"))


def track(companies: DataFrame, scores: DataFrame, paid_after: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Company tiers from the roll-up, company scores (company_id, company_anomaly_score, company_anomaly_lead) and dollars after exclusion."""
    met = companies.join(scores, "company_id", "left").join(paid_after, "company_id", "left").withColumn("paid_after", F.coalesce("paid_after", F.lit(0)))
    lead = F.coalesce("company_anomaly_lead", F.lit(False))
    member = (F.coalesce("company_anomaly_score", F.lit(0.0)) >= cfg.anomaly_bar) | lead
    flags = ["any_billed_after_exclusion", "any_provider_on_leie", "__member", "any_probable_excluded_owner"]
    tiered = met.withColumn("__member", member).withColumn("priority_tier", F.coalesce(*[F.when(F.col(f), t) for f, t in zip(flags, TIERS)], F.lit(TIERS[-1])))
    return tiered.withColumns({
        "anomaly_tier_member": F.col("__member"), "priority_rank": F.substring("priority_tier", 1, 1).cast("int"),
        "fragmentation_signal": lead & ~F.col("any_npi_lead") & (F.col("npi_count") >= 2),
    }).drop("__member")


def ranked(tracked: DataFrame) -> DataFrame:
    """Leads (tiers 1 to 4) with their rank over all: tier, strength, id. Leads are few next to companies."""
    order = Window.orderBy("priority_rank", F.col("strength").desc(), "company_id")
    return tracked.where(F.col("priority_rank") <= 4).withColumn("strength", strength()).withColumn("rank", F.row_number().over(order))


def triage(tracked: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Review flags: genuine fragmentation, companies that may be one operator, low confidence, no name."""
    name = F.trim(F.coalesce("company_name", F.lit("")))
    unnamed = F.col("name_unresolved") if "name_unresolved" in tracked.columns else (name == "") | name.startswith("npi:")
    share = F.col("max_constituent_net_paid").cast("double") / F.nullif(F.col("company_net_paid").cast("double"), F.lit(0.0))
    ready = tracked.withColumns({
        "name_unresolved": unnamed, "genuine_fragmentation": F.coalesce(F.col("fragmentation_signal") & (share < cfg.frag_max_share), F.lit(False)),
        "__key": F.when(~unnamed & (name_root(name) != ""), F.concat_ws("||", name_root(name), F.coalesce("states", F.lit("")))),
    })
    same = Window.partitionBy(F.coalesce("__key", F.concat(F.lit("|"), "company_id")))  # companies without a key stand alone
    met = ready.withColumn("possible_same_operator", F.col("__key").isNotNull() & (F.count("company_id").over(same) >= 2))
    flags = [(F.col("merge_confidence") == "low", "low_merge_confidence"), (F.col("possible_same_operator"), "possible_same_operator"), (F.col("genuine_fragmentation"), "genuine_fragmentation"), (F.col("name_unresolved"), "name_unresolved")]
    return met.withColumn("review_flags", F.concat_ws("; ", *[F.when(c, t) for c, t in flags])).drop("__key")


def related(triaged: DataFrame) -> DataFrame:
    """(company_id, related_entities) for companies that may be one operator; clusters share a name root and states."""
    keyed = triaged.where("possible_same_operator").withColumn("__key", F.concat_ws("||", name_root(F.col("company_name")), F.coalesce("states", F.lit(""))))
    everyone = keyed.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("company_id", "company_name"))).alias("all"))
    met = keyed.select("__key", "company_id").join(everyone, "__key")
    return met.select("company_id", F.expr("array_join(transform(filter(all, x -> x.company_id <> company_id), x -> concat(x.company_name, ' (', x.company_id, ')')), '; ')").alias("related_entities"))


def reason() -> Column:
    """One sentence on why a tracked company surfaced."""
    lead = (
        F.when(F.col("priority_rank") == 1, F.concat(F.lit("Billed while excluded: $"), F.format_number(F.col("paid_after").cast("double"), 0), F.lit(" after exclusion")))
        .when(F.col("priority_rank") == 2, "A provider is on the exclusion list")
        .when(F.col("priority_rank") == 3, F.format_string("Billing is unusual among company peers (score %.2f)", F.coalesce("company_anomaly_score", F.lit(0.0))))
        .when(F.col("priority_rank") == 4, "A facility may have an excluded owner")
    )
    also = [F.when(F.col("fragmentation_signal"), "billing is split over several providers"), F.when(F.col("any_provider_on_leie") & (F.col("priority_rank") > 2), "also has a listed provider"), F.when(F.col("any_probable_excluded_owner") & (F.col("priority_rank") != 4), "also has a probable excluded owner")]
    return F.concat_ws("; ", lead, *also)


def top(companies: DataFrame, k: int, cfg: Config = DEFAULT, min_score: float = 0.0) -> DataFrame:
    """The k best by score, then dollars."""
    fit = companies.where((F.col("company_net_paid") >= cfg.min_net_paid) & (F.col("score") >= min_score))
    return fit.orderBy(F.col("score").desc(), F.col("company_net_paid").desc(), "company_id").limit(k)
