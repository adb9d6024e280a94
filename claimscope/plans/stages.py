"""The pipeline's stages: each reads tables by path and writes Parquet; flags are parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.numbers import log1p_positive
from claimscope.functions.ids import malformed_code
from claimscope.operators import attribution, companies, coverage, evaluation, exclusions, features, history, leads, ml, peers
from claimscope.operators.quality import conserved, partitioned, unique_key
from claimscope.sources import domain, readers
from claimscope.sources.writers import markdown, write_csv, write_lead_files, write_parquet


class Store:
    """Named Parquet tables below one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        write_parquet(df, f"{self.path}/{name}.parquet")
        return self.read(name)

    def report(self, name: str, text: str) -> None:
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/{name}")


def integrate(store: Store, spending: str, registry: str, enrollment: str, owners: list[str], excluded: str, npi_role: str = "billing") -> None:
    """Dimensions, the attributed fact, exclusions, owner edges, facility flags and quarantine; nothing fans out."""
    spark = store.spark
    bad_lines = store.put("malformed_lines", readers.union_files([readers.malformed(spark, p) for p in (spending, registry, enrollment, excluded, *owners)]))
    enrolled = store.put("enrollment", domain.enrollment(spark, enrollment))
    dim = store.put("provider_dim", unique_key(domain.registry(spark, registry).join(domain.one_enrollment(enrolled), "npi", "left"), "npi"))
    claims = domain.spending(spark, spending)
    if npi_role == "servicing":
        claims = claims.withColumnsRenamed({"billing_npi_raw": "servicing_npi_raw", "servicing_npi_raw": "billing_npi_raw"})
    fact = attribution.attribute(claims, dim).withColumn("servicing_npi", attribution.canonical_npi(F.col("servicing_npi_raw")))
    fact = store.put("spending_fact", fact)
    conserved(claims, fact, "total_paid")
    listed = store.put("exclusions", domain.exclusions(spark, excluded))
    pac = enrolled.select("pac_id", "npi").distinct()
    store.put("pac_crosswalk", pac)
    by_enrollment = enrolled.groupBy("enrollment_id").agg(F.min("npi").alias("npi"))
    owner_npi = attribution.unambiguous(pac, "pac_id", "npi").select(F.col("pac_id").alias("owner_pac_id"), F.col("npi").alias("owner_npi"))
    edges = attribution.resolve_owner(domain.owners(spark, owners), by_enrollment, pac).join(owner_npi, "owner_pac_id", "left")
    edges = store.put("owner_edges", edges)
    flags = store.put("facility_flags", exclusions.facility_flags(exclusions.owner_matches(edges, listed)))
    bad = attribution.quarantine(claims, "billing_npi_raw", "spending_billing").unionByName(attribution.quarantine(claims, "servicing_npi_raw", "spending_servicing"))
    store.put("npi_quarantine", bad)
    store.report("integration_report", markdown("Integration", {"coverage": attribution.coverage(fact), "top unmatched": attribution.top_unmatched(fact.withColumn("billing_npi", F.col("billing_npi_raw"))), "facilities": flags.agg(F.count(F.lit(1)).alias("flagged")), "lines that fit no header": bad_lines.groupBy("source").agg(F.count(F.lit(1)).alias("n"))}))


def audit(store: Store, cfg: Config = DEFAULT) -> None:
    """The exclusive partition of the fact, its summary, and the clean base."""
    fact = store.read("spending_fact")
    write_parquet(fact.withColumn("bucket", attribution.partition_bucket(cfg.paid_ceiling)), f"{store.path}/spending_partition.parquet", ("bucket",))
    store.put("partition_summary", attribution.partition_summary(fact, cfg.paid_ceiling))
    store.put("coverage_split", attribution.coverage_split(fact))
    base = store.put("clean_base", attribution.clean_base(fact, cfg.paid_ceiling))
    over = F.coalesce(F.col("total_paid"), F.lit(0)) > cfg.paid_ceiling
    corrupt = store.put("spending_corruption_quarantine", fact.where(over).withColumn("hcpcs_malformed", malformed_code(F.col("hcpcs_code"))))
    aggregate = fact.where(~over & ~F.coalesce(F.col("provider_matched"), F.lit(False)))
    partitioned(fact, corrupt, aggregate, base, measure="total_paid")
    diagnose(store, fact, aggregate, cfg)


def diagnose(store: Store, fact: DataFrame, aggregate: DataFrame, cfg: Config = DEFAULT) -> None:
    """What the claims without a provider are; the aggregate track is written where its boundary is clean."""
    ids = coverage.unmatched_ids(fact)
    buckets = store.put("unmatched_buckets", coverage.bucket_shares(ids))
    codes = store.put("unmatched_codes", coverage.code_shares(fact))
    held = store.put("quarantine_accounting", coverage.quarantine_accounting(ids, store.read("npi_quarantine").where("source = 'spending_billing'")))
    verdict = store.put("coverage_ambiguity", coverage.ambiguity(buckets, cfg))
    top = ids.orderBy(F.col("paid").desc_nulls_last(), "raw_value").limit(50)
    if verdict.first()["segregate"]:
        store.put("spending_aggregate_billing", aggregate)
    store.report("coverage_report", markdown("Coverage", {"matched and unmatched": store.read("coverage_split"), "top unmatched identifiers": top, "classes": buckets, "quarantine": held, "top codes": codes, "scope": verdict}))


CARRIED = {"primary_taxonomy": "taxonomy_code", "entity_type": "entity_type", "practice_state": "provider_state", "org_legal_name": "org_legal_name"}


def build_features(store: Store, cfg: Config = DEFAULT) -> None:
    """provider_features: core, concentration, peers, temporal, rare codes and linkage, one row an npi."""
    base = store.read("clean_base")
    key = "billing_npi"
    codes, months = store.put("provider_hcpcs", features.by_code(base, key)), store.put("provider_month", features.by_month(base, key))
    core = features.core(base, key, CARRIED)
    state = F.concat("primary_taxonomy", F.lit("|"), F.coalesce("practice_state", F.lit("")))
    core = store.put("provider_core", core)
    rare = features.rare_codes(base, ["taxonomy_code", "entity_type"], key, cfg)
    dims = core.select(key, F.col("primary_taxonomy").alias("taxonomy_code"), "entity_type")
    listed = store.read("exclusions").where("npi is not null").select(F.col("npi").alias(key), F.lit(True).alias("provider_on_leie")).distinct()
    flags = store.read("facility_flags").withColumnRenamed("facility_npi", key)
    parts = [
        features.concentration(codes, key), features.temporal(months, key, cfg), features.rare_share(codes, dims, rare, ["taxonomy_code", "entity_type"], key, "rare_share"),
        peers.peer_features(core, key, F.col("primary_taxonomy"), "tax", cfg=cfg), peers.peer_features(core, key, state, "taxstate", cfg=cfg), listed, flags,
    ]
    out = core
    for part in parts:
        out = out.join(part, key, "left")
    out = out.withColumn("provider_on_leie", F.coalesce("provider_on_leie", F.lit(False))).withColumn("log_max_single_month", log1p_positive(F.col("max_single_month_net_paid"))).withColumnRenamed(key, "npi")
    unique_key(store.put("provider_features", out), "npi")


def detect(store: Store, cfg: Config = DEFAULT) -> None:
    """Leads at provider grain: deterministic rules, three anomaly scores, owners, tiers; and verified cases."""
    frame, base, listed = store.read("provider_features"), store.read("clean_base"), store.read("exclusions")
    months = store.read("provider_month").select(F.col("billing_npi").alias("npi"), "service_month", F.col("net_paid").alias("paid"), "claim_lines")
    status = store.put("month_status", exclusions.month_status(months, listed.where("npi is not null")))
    context = frame.select("npi", "org_legal_name", "entity_type", "primary_taxonomy", "practice_state")
    cases = exclusions.dispositions(status).join(exclusions.top_codes_after(base, status), "npi", "left")
    cases = store.put("layer1_cases", exclusions.case_context(cases, listed, context))
    v1, v2 = peers.anomaly_v1(frame, "npi", cfg), peers.anomaly_v2(frame, "npi", cfg)
    store.put("fraud_leads_v1", v1)
    store.put("fraud_leads_v2", v2)
    v3 = peers.score_concepts(frame, "npi", cfg)
    billed = exclusions.billed_while_excluded(base, listed).select("npi", "paid_after_exclusion", "n_months_after", "billed_after_exclusion", "excluded_after_billing")
    met = peers.implausible(frame, cfg).select("npi", "net_paid", "gross_paid", "provider_on_leie", "has_probable_excluded_owner", "lines_per_patient_instance", "paid_per_claim_line", "rule_implausible_lines_per_patient", "rule_implausible_paid_per_line").join(v3, "npi").join(billed, "npi", "left")
    owner = F.coalesce(F.col("has_probable_excluded_owner") > 0, F.lit(False))
    rate = F.col("rule_implausible_lines_per_patient") | F.col("rule_implausible_paid_per_line")
    tier = peers.priority_tier(F.col("billed_after_exclusion"), rate, F.col("excluded_after_billing"), F.col("anomaly_lead"), owner)
    found = met.withColumns({"probable_owner": owner, "priority_tier": tier, "billed_after_exclusion": F.coalesce("billed_after_exclusion", F.lit(False))}).withColumn("priority_rank", F.substring("priority_tier", 1, 1).cast("int")).withColumn("rule_reasons", peers.rule_reasons())
    found = store.put("fraud_leads_v3", found.join(context, "npi"))
    store.report("detection_report", markdown("Detection", {"tiers": tier_counts(found), "verdicts": cases.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"), F.sum("paid_after").alias("paid_after")).orderBy("disposition"), "name checks": cases.groupBy("name_match").agg(F.count(F.lit(1)).alias("n")).orderBy("name_match")}))


def tier_counts(found: DataFrame) -> DataFrame:
    """Leads and their dollars by tier."""
    dollars = "net_paid" if "net_paid" in found.columns else "company_net_paid"
    return found.groupBy("priority_tier").agg(F.count(F.lit(1)).alias("n"), F.sum(dollars).alias("paid")).orderBy("priority_tier")


def export(store: Store, cfg: Config = DEFAULT, preserve_excluded: bool = True) -> None:
    """The final provider and company lists, flat files by kind, and the outreach selection with its audit."""
    names = store.read("provider_dim").select("npi", "provider_name")
    projected = store.put("provider_leads", leads.provider_leads(store.read("fraud_leads_v3"), names, store.read("layer1_cases")))
    most = F.col("net_paid").desc_nulls_last()
    write_lead_files(projected.orderBy("priority_rank", F.col("anomaly_score").desc_nulls_last(), F.col("paid_after").desc_nulls_last(), most, "npi"), f"{store.path}/flat", leads.lead_kinds())
    write_csv(leads.final_leads(projected, cfg).orderBy("priority_rank", most, "npi"), f"{store.path}/final_leads.csv", ("priority_rank",), force_quote=("npi",))
    if preserve_excluded:
        write_csv(leads.excluded_leads(projected).orderBy(F.col("paid_after").desc_nulls_last(), most, "npi"), f"{store.path}/high_precision_excluded_leads.csv", ("priority_rank",), force_quote=("npi",))
    tracked = store.read("company_lead_tracker")
    clean = companies.ranked(tracked.where(F.col("company_net_paid") >= cfg.min_net_paid))
    quoted = ("company_name", "npi_list", "related_entities")
    clean = store.put("company_leads_clean", clean.join(store.read("related_entities"), "company_id", "left")).orderBy("rank")
    write_lead_files(clean, f"{store.path}/companies", {"company_leads_clean": F.lit(True), "triage_priority": F.col("priority_rank") <= 3, "probable_owner_backlog": F.col("priority_rank") == 4}, quoted)
    screened = leads.screened(clean, "company_name", "specialty")
    write_lead_files(screened, f"{store.path}/screened", {"final_leads": F.col("removed_category").isNull(), "removed_audit": F.col("removed_category").isNotNull()}, quoted)
    picked = store.put("advert_selection", leads.advert_selection(store.read("company_rollup"), cfg))
    write_lead_files(picked, f"{store.path}/advert", {"selected": F.lit(True), "clean": F.col("reason").isNull(), "excluded": F.col("reason").isNotNull()}, ("company_name", "npi_list"))
    store.report("export_report", markdown("Exports", {"provider tiers": tier_counts(projected), "company tiers": tier_counts(clean), "outreach": picked.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy("reason")}))


def roll_up(store: Store, cfg: Config = DEFAULT) -> None:
    """Companies: map, roll-up, company scores, tracker, triage and ranked leads."""
    frame, found, base = store.read("provider_features"), store.read("fraud_leads_v3"), store.read("clean_base")
    pac = store.read("pac_crosswalk").where("coalesce(pac_id, '') <> ''").groupBy("npi").agg(F.min("pac_id").alias("pac_id"))
    owner = F.coalesce(F.nullif(F.col("owner_npi"), F.lit("")), F.nullif(F.col("owner_name_key"), F.lit("")))
    owned = store.read("owner_edges").where("facility_npi is not null").groupBy(F.col("facility_npi").alias("npi")).agg(F.min(owner).alias("owner_key"))
    ready = frame.select("npi", "org_legal_name", "practice_state", "primary_taxonomy", "entity_type").join(pac, "npi", "left").join(owned, "npi", "left")
    signals = found.select("npi", "net_paid", "gross_paid", "provider_on_leie", "billed_after_exclusion", "anomaly_score", "n_concept_signals", "probable_owner", "priority_rank", F.col("anomaly_lead").alias("npi_lead"))
    linked = store.put("npi_to_company_map", companies.link(ready).join(signals, "npi"))
    rolled = store.put("company_rollup", companies.rollup(linked))
    claims = base.join(linked.select(F.col("npi").alias("billing_npi"), "company_id"), "billing_npi")
    paid = claims.groupBy("company_id", "taxonomy_code", "entity_type").agg(F.sum(F.greatest("total_paid", F.lit(0.0))).alias("g"))
    dims = paid.groupBy("company_id").agg(F.max(F.struct("g", "taxonomy_code", "entity_type")).alias("b")).select("company_id", F.col("b.taxonomy_code").alias("taxonomy_code"), F.coalesce("b.entity_type", F.lit("")).alias("entity_type"))
    placed = claims.drop("taxonomy_code", "entity_type").join(dims, "company_id")
    cell = ["taxonomy_code", "entity_type"]
    rare = features.rare_share(features.by_code(claims, "company_id"), dims, features.rare_codes(placed, cell, "company_id", cfg), cell, "company_id", "rare_share")
    scoring = features.rate_features(claims, "company_id", cfg).join(dims.withColumnRenamed("taxonomy_code", "primary_taxonomy"), "company_id").join(rare, "company_id", "left").withColumn("log_max_single_month", log1p_positive(F.col("max_single_month_net_paid")))
    scores = store.put("company_scores_full", peers.score_concepts(scoring, "company_id", cfg))
    after = store.read("layer1_cases").join(linked.select("npi", "company_id"), "npi").groupBy("company_id").agg(F.sum("paid_after").alias("paid_after"))
    named = scores.select("company_id", F.col("anomaly_score").alias("company_anomaly_score"), F.col("anomaly_lead").alias("company_anomaly_lead"), "contributing_concepts")
    lookups = store.put("company_lookups", leads.company_lookups(linked, store.read("provider_dim")))
    tracked = companies.triage(leads.named(companies.track(rolled, named, after, cfg), lookups), cfg).withColumn("reasons", leads.sentence())
    tracked = store.put("company_lead_tracker", tracked)
    store.put("related_entities", companies.related(tracked))


def model(store: Store, cfg: Config = DEFAULT, rounds: int = 20) -> None:
    """Boosted trees on listed providers against quiet ones; scores of all, segments and company scores."""
    frame = store.read("provider_features")
    v1 = store.read("fraud_leads_v1").select("npi", F.col("anomaly_score").alias("a"), "not_scored")
    met = frame.join(v1, "npi", "left").withColumn("label", F.col("provider_on_leie").cast("int")).withColumn("in_training", (F.col("label") == 1) | (F.coalesce("a", F.lit(-1.0)) == 0))
    numeric = [c for c, t in frame.dtypes if c in ml.model_features(frame.columns) and t.startswith(("double", "bigint", "int", "decimal"))]
    split = ml.stratified_split(met.where("in_training"), "npi", "label", cfg)
    fitted = ml.fit_boosted(split, numeric, ["primary_taxonomy", "entity_type"], rounds=rounds, cfg=cfg)
    fitted.write().overwrite().save(f"{store.path}/model")
    scores = ml.score_boosted(fitted, met, numeric, "npi")
    done = evaluation.rank_reliable(evaluation.segments(scores.join(met.select("npi", "net_paid", "provider_on_leie", "in_training", "not_scored", "label"), "npi")))
    done = store.put("provider_model_scores", done.join(frame.select("npi", "org_legal_name", "entity_type", "primary_taxonomy", "practice_state"), "npi"))
    members = done.join(store.read("npi_to_company_map").select("npi", "company_id"), "npi")
    names = store.read("company_rollup").select("company_id", "company_name")
    store.put("company_model_scores", evaluation.company_scores(members).join(names, "company_id", "left"))
    store.put("company_best_members", leads.best_members(members.where("score_reliable")))
    val = store.put("val_predictions", done.join(split.where("is_val").select("npi"), "npi").select("npi", F.col("label").alias("y_true"), F.col("score").alias("model_score")))
    store.put("model_metrics", evaluation.ranking_metrics(val, "model_score", "y_true"))
    store.put("model_at_k", evaluation.at_k(val, "model_score", "y_true", "npi", (50, 100, 250, 500, 1000)))
    store.put("pr_curve", evaluation.precision_recall_curve(val, "model_score", "y_true"))
    found = store.put("feature_importance", ml.importances(fitted, [*numeric, "primary_taxonomy", "entity_type"]))
    store.report("model_report", markdown("Model", {"validation": store.read("model_metrics"), "at k": store.read("model_at_k"), "features by gain": found.orderBy(F.col("gain").desc(), "feature").limit(20)}))


def model_exports(store: Store, cfg: Config = DEFAULT, top_k: int = 5000, min_score: float = 0.0, npi_min_net_paid: float = 5_000_000.0, npi_min_score: float = 0.9) -> None:
    """The company list of the model, its screened part and audit, and the provider list."""
    best = leads.model_leads(store.read("company_model_scores"), store.read("company_best_members"), top_k, min_score, cfg)
    judged = store.put("model_leads", leads.screened(best, "company_name", "specialty_code"))
    kinds = {"leads": F.lit(True), "screened": F.col("removed_category").isNull(), "removed_audit": F.col("removed_category").isNotNull()}
    write_lead_files(judged, f"{store.path}/model_leads_csv", kinds, ("company_name", "npi_list"))
    providers = store.put("model_npi_leads", leads.provider_model_leads(store.read("provider_model_scores"), npi_min_net_paid, npi_min_score))
    write_lead_files(providers, f"{store.path}/model_npi_leads_csv", kinds, ("npi",))


def backtest(store: Store, cfg: Config = DEFAULT) -> None:
    """Labels from the exclusion list, deciles, lift and null tests of the company score."""
    listed = store.read("exclusions").where(exclusions.type_key(F.col("excl_type")).isin(*exclusions.BACKTEST_FRAUD_TYPES)).withColumn("d", F.date_format("excl_date", "yyyyMMdd"))
    by_npi = listed.where("npi is not null").groupBy("npi").agg(F.min("d").alias("excl_date"))
    by_name = listed.where("coalesce(busname, '') <> ''").groupBy(evaluation.bare_alnum(F.col("busname")).alias("name_key"), F.upper("state").alias("state")).agg(F.min("d").alias("excl_date"))
    scored = store.read("company_rollup").join(store.read("company_scores_full").where("not not_scored").select("company_id", "anomaly_score"), "company_id")
    labelled = evaluation.binned(evaluation.labels(scored, by_npi, by_name), "anomaly_score", "company_id", "score_decile")
    labelled = store.put("backtest_results", labelled)
    store.put("backtest_lift", evaluation.lift_table(labelled, "score_decile"))
    store.put("backtest_within_size", evaluation.within_size_lift(labelled, "anomaly_score", "company_net_paid", "company_id"))
    store.put("backtest_null_tests", evaluation.null_tests(labelled, "anomaly_score", cfg=cfg))
    by_size = evaluation.binned(labelled, "company_net_paid", "company_id", "billing_decile")
    store.put("backtest_billing_lift", evaluation.lift_table(by_size, "billing_decile"))
    store.put("backtest_timing", evaluation.timing_lift(labelled, "score_decile", "hit", "exclusion_date", *cfg.billing_years))
    at_bar = labelled.agg(F.avg("hit").alias("base"), F.count_if(F.col("anomaly_score") >= cfg.anomaly_bar).alias("n_leads"), F.avg(F.when(F.col("anomaly_score") >= cfg.anomaly_bar, F.col("hit"))).alias("lead_rate"))
    store.put("backtest_bar", at_bar.withColumn("lead_lift", F.col("lead_rate") / F.nullif(F.col("base"), F.lit(0.0))))
    parts = {"deciles": "backtest_lift", "billing deciles": "backtest_billing_lift", "within size": "backtest_within_size", "timing": "backtest_timing", "at the bar": "backtest_bar", "null tests": "backtest_null_tests"}
    store.report("backtest_report", markdown("Backtest", {k: store.read(v) for k, v in parts.items()}))


def yearly_clean(store: Store, spending: str, registry: str, excluded: str, min_total_paid: float = 10_000_000.0) -> None:
    """The yearly track's inputs: months and years of qualifying providers, and one enriched row a provider."""
    spark = store.spark
    months = store.put("yearly_months", history.monthly(history.qualifying(readers.yearly_spending(spark, spending), min_total_paid)))
    store.put("yearly_annual", history.annual(months))
    facts = history.enriched(history.summary(months), domain.registry(spark, registry).select("npi", "provider_name", "taxonomy_code", "specialty", "enumerated", "deactivated"), domain.exclusions(spark, excluded).select("npi", "excl_date", "reinstate_date", "excl_type"))
    write_csv(unique_key(store.put("yearly_providers", facts), "npi"), f"{store.path}/providers_clean.csv")


def yearly_features(store: Store, cfg: Config = DEFAULT) -> None:
    """Provider-year inputs of the forest."""
    frame = store.put("yearly_features", history.provider_years(store.read("yearly_months"), store.read("yearly_providers"), cfg))
    write_csv(unique_key(frame, "npi", "year"), f"{store.path}/fraud_features.csv")


def yearly_score(store: Store, contamination: float = 0.05, trees: int = 300, save_top: int | None = 200) -> None:
    """Scores of provider-years, ranked with descriptions, rolled up by provider, and held against exclusions."""
    scored = store.put("yearly_scores", history.score_years(store.read("yearly_features"), contamination, trees))
    named = store.read("yearly_providers").select("npi", "provider_name")
    write_csv(history.ranking(scored, save_top).join(named, "npi", "left").orderBy("rank"), f"{store.path}/provider_rankings.csv")
    write_csv(history.provider_ranking(scored, save_top).join(named, "npi", "left").orderBy("rank"), f"{store.path}/provider_summary.csv")
    keyed = scored.withColumn("__key", F.concat_ws("|", "npi", "year"))
    store.put("yearly_at_k", evaluation.at_k(keyed, "anomaly_score", "is_excluded", "__key", (50, 100, 200, 500, 1000)))
