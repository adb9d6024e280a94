"""Queries of the engine's own operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.config import DEFAULT
from claimscope.functions import dates, ids, lookups, names, numbers, screening
from claimscope.operators import attribution, companies, evaluation, exclusions, features, history, leads, ml, peers, yearly
from claimscope.operators import coverage as uncovered
from claimscope.operators import screening as screens
from claimscope.plans.adapter import CARRIED, CEILING, Tables
from claimscope.plans.sql import pct, with_views

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Money and ratios as doubles of 6 places, counts as bigints: the same in any engine."""
    out = []
    for c, t in df.dtypes:
        if t.startswith(("decimal", "double")):
            out.append((F.round(F.col(c).cast("double"), 6) + F.lit(0.0)).alias(c))
        else:
            out.append(F.col(c).cast("bigint").alias(c) if t in ("int", "smallint") else F.col(c))
    return df.select(*out)


def _typed(columns: str) -> str:
    """``name``, ``name:d`` (double of 6 places) and ``name:i`` (bigint) as SQL."""
    out = []
    for c in columns.split():
        name, _, kind = c.partition(":")
        out.append({"": name, "d": f"round({name}::double, 6) + 0.0::double as {name}", "i": f"{name}::bigint as {name}"}[kind])
    return ", ".join(out)


def query(views: str = "", columns: str = "", sql: str | None = None):
    def register(f):
        Q[f.__name__] = lambda spark, sf_dir: _plain(f(Tables(spark, sf_dir)))
        if sql is not None:
            SQL[f.__name__] = with_views(views, f"select {_typed(columns)} from ({sql}) q")
        return f

    return register


CORE = "gross_paid:d net_paid:d reversal_amount:d total_claim_lines:i service_volume:i n_distinct_hcpcs:i n_active_months:i first_month last_month"
RATES = "gross_paid:d net_paid:d total_claim_lines:i service_volume:i n_distinct_hcpcs:i paid_per_claim_line:d paid_per_patient_instance:d lines_per_patient_instance:d top_hcpcs_paid_share:d hcpcs_hhi:d max_single_month_net_paid:d month_to_month_volatility:d yoy_growth_net_paid:d"
RATIOS = "net_paid / nullif(total_claim_lines, 0) as paid_per_claim_line, net_paid / nullif(service_volume, 0) as paid_per_patient_instance, total_claim_lines / nullif(service_volume, 0) as lines_per_patient_instance"


# core facts


@query("core", f"npi primary_taxonomy entity_type practice_state {CORE} reversal_ratio:d paid_per_claim_line:d paid_per_patient_instance:d lines_per_patient_instance:d tenure_months:i",
       f"select *, abs(reversal_amount) / nullif(gross_paid, 0) as reversal_ratio, {RATIOS}, datediff('month', (first_month || '-01')::date, (last_month || '-01')::date) + 1 as tenure_months from core")
def provider_core(t: Tables) -> DataFrame:
    return features.core(t.claims(), "billing_npi", CARRIED).withColumnRenamed("billing_npi", "npi").drop("org_legal_name")


@query("codes", "billing_npi hcpcs_code gross_paid_code:d net_paid_code:d claim_lines:i patients:i", "select k as billing_npi, hcpcs_code, gross as gross_paid_code, net as net_paid_code, lines as claim_lines, pats as patients from codes")
def provider_hcpcs(t: Tables) -> DataFrame:
    return features.by_code(t.claims(), "billing_npi")


@query("months", "billing_npi service_month month_date net_paid:d gross_paid:d claim_lines:i", "select k as billing_npi, service_month, d as month_date, net as net_paid, gross as gross_paid, lines as claim_lines from months")
def provider_month(t: Tables) -> DataFrame:
    return features.by_month(t.claims(), "billing_npi")


@query("fact", "billing_npi n_rows:i paid:d", f"select billing_npi, count(*) as n_rows, sum(total_paid) as paid from fact where provider_matched and total_paid <= {CEILING} group by billing_npi")
def clean_base(t: Tables) -> DataFrame:
    return attribution.clean_base(t.fact(), CEILING).groupBy("billing_npi").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))


@query("fact", "bucket n_rows:i paid:d", f"select case when total_paid > {CEILING} then 'corrupt' when provider_matched then 'base' else 'aggregate' end as bucket, count(*) as n_rows, sum(total_paid) as paid from fact group by 1")
def corruption_partition(t: Tables) -> DataFrame:
    return attribution.partition_summary(t.fact(), CEILING)


@query("fact", "provider_matched n_rows:i paid:d median_paid:d p90_paid:d max_paid:d", "select provider_matched, count(*) as n_rows, sum(total_paid) as paid, median(total_paid::double) as median_paid, quantile_cont(total_paid::double, 0.9) as p90_paid, max(total_paid) as max_paid from fact group by 1")
def coverage_split(t: Tables) -> DataFrame:
    return attribution.coverage_split(t.fact())


@query("fact", "n_rows:i n_matched:i paid:d paid_matched:d row_share:d paid_share:d", "select *, n_matched / n_rows as row_share, paid_matched::double / paid::double as paid_share from (select count(*) as n_rows, count(*) filter (where provider_matched) as n_matched, sum(total_paid) as paid, sum(total_paid) filter (where provider_matched) as paid_matched from fact)")
def coverage(t: Tables) -> DataFrame:
    return attribution.coverage(t.fact())


_NPI_OK = "(10 - (24 + " + " + ".join(f"(case when {d} > 4 then 2 * {d} - 9 else 2 * {d} end)" if i % 2 == 0 else d for i, d in enumerate(f"substring(raw, {i + 1}, 1)::int" for i in range(9))) + ") % 10) % 10 = substring(raw, 10, 1)::int"


@query("claims", "billing_npi_raw billing_npi service_month provider_matched active_at_claim total_paid:d", f"""
    select raw as billing_npi_raw, case when ok then raw end as billing_npi, service_month, ok and k % 20 <> 0 as provider_matched, total_paid,
      case when not (ok and k % 20 <> 0) or k % 7 <> 0 then true when service_month < '1998-01' then true when k % 14 = 0 and service_month >= '1999-06' then true else false end as active_at_claim
    from (select *, {_NPI_OK} as ok from (select (c_custkey + 1000000000)::varchar as raw, c_custkey as k, service_month, total_paid from claims))""")  # fmt: skip
def attributed_fact(t: Tables) -> DataFrame:
    return attribution.attribute(t.raw_claims(), t.registry()).select("billing_npi_raw", "billing_npi", "service_month", "provider_matched", "active_at_claim", "total_paid")


@query("claims", "npi n_active:i n_inactive:i", """select npi, count(*) filter (where a) as n_active, count(*) filter (where not a) as n_inactive from (
    select (c_custkey + 1000000000)::varchar as npi, c_custkey % 7 <> 0 or service_month < '1998-01' or (c_custkey % 14 = 0 and service_month >= '1999-06') as a from claims where c_custkey % 20 <> 0) group by npi""")  # fmt: skip
def active_at_claim(t: Tables) -> DataFrame:
    met = t.raw_claims().join(t.registry(), F.col("billing_npi_raw") == F.col("npi")).withColumn("a", dates.active_at_claim(F.col("service_month"), F.col("deactivated"), F.col("reactivated")))
    return met.groupBy("npi").agg(F.count_if("a").alias("n_active"), F.count_if(~F.col("a")).alias("n_inactive"))


@query("claims", "service_month is_runout n_rows:i", "select service_month, left(service_month, 4)::int * 12 + right(service_month, 2)::int > max(left(service_month, 4)::int * 12 + right(service_month, 2)::int) over () - 12 as is_runout, n_rows from (select service_month, count(*) as n_rows from claims group by 1)")
def runout_flags(t: Tables) -> DataFrame:
    return attribution.runout_flags(t.claims()).groupBy("service_month", "is_runout").agg(F.count(F.lit(1)).alias("n_rows"))


@query("claims", "billing_npi n_rows:i paid:d", "select billing_npi, count(*) as n_rows, sum(total_paid) as paid from claims group by 1 having sum(total_paid) > 2000000")
def cohort_having(t: Tables) -> DataFrame:
    return attribution.cohort(t.claims(), "billing_npi", 2_000_000).groupBy("billing_npi").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))


@query("claims", "billing_npi n_rows:i paid:d", "select billing_npi, count(*) as n_rows, sum(total_paid) as paid from claims where c_custkey % 20 = 0 group by 1 order by paid desc, billing_npi limit 25")
def top_unmatched(t: Tables) -> DataFrame:
    return attribution.top_unmatched(t.fact())


# features


@query("codes", "billing_npi top_hcpcs_paid_share:d hcpcs_hhi:d", "select k as billing_npi, max(gross)::double / nullif(sum(gross), 0)::double as top_hcpcs_paid_share, case when sum(gross) > 0 then sum(gross::double * gross::double) / (sum(gross)::double * sum(gross)::double) end as hcpcs_hhi from codes group by 1")
def concentration_hhi(t: Tables) -> DataFrame:
    return features.concentration(features.by_code(t.claims(), "billing_npi"), "billing_npi")


@query("months", "billing_npi max_single_month_net_paid:d month_to_month_volatility:d yoy_growth_net_paid:d new_biller_surge_onset", """
    select k as billing_npi, max(net) as max_single_month_net_paid, case when avg(net::double) <> 0 then stddev_samp(net::double) / abs(avg(net::double)) end as month_to_month_volatility,
      sum(net::double) filter (where d > hi - interval 18 month) / nullif(sum(net::double) filter (where d <= hi - interval 18 month and d > hi - interval 30 month), 0) - 1 as yoy_growth_net_paid,
      min(d) > min(lo) and max(net::double) / nullif(median(net::double), 0) >= 5 as new_biller_surge_onset
    from months, (select max(d) as hi, min(d) as lo from months) where d <= hi - interval 6 month group by k""")  # fmt: skip
def temporal_features(t: Tables) -> DataFrame:
    return features.temporal(features.by_month(t.claims(), "billing_npi"), "billing_npi")


@query("prates", "npi rare_share:d", "select k as npi, rare_share from prates")
def rare_code_share(t: Tables) -> DataFrame:
    return t.provider_scoring().select("npi", "rare_share")


@query("prates", f"npi {RATES}", "select *, k as npi from prates")
def rate_features_provider(t: Tables) -> DataFrame:
    return features.rate_features(t.claims(), "billing_npi").withColumnRenamed("billing_npi", "npi")


@query("crates", f"company_id {RATES}", "select *, k as company_id from crates")
def rate_features_company(t: Tables) -> DataFrame:
    return features.rate_features(t.company_claims(), "company_id")


@query("cclaims", "company_id n_npi:i n_rows:i paid:d", "select company_id, count(distinct billing_npi) as n_npi, count(*) as n_rows, sum(total_paid) as paid from cclaims group by 1")
def company_base(t: Tables) -> DataFrame:
    return t.company_claims().groupBy("company_id").agg(F.count_distinct("billing_npi").alias("n_npi"), F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))


@query("prates,core,excl", f"npi primary_taxonomy {RATES} rare_share:d log_max_single_month:d n_active_months:i provider_on_leie", "select r.*, r.k as npi, c.primary_taxonomy, c.n_active_months, r.k in (select npi from excl) as provider_on_leie from prates r join core c on r.k = c.npi")
def provider_features(t: Tables) -> DataFrame:
    core = features.core(t.claims(), "billing_npi").select(F.col("billing_npi").alias("npi"), "n_active_months")
    listed = t.exclusions().select("npi", F.lit(True).alias("on")).distinct()
    met = t.provider_scoring().join(core, "npi", "left").join(listed, "npi", "left").withColumn("provider_on_leie", F.coalesce("on", F.lit(False)))
    return met.drop("on", "entity_type")


# peers and scoring


def _peer_sql(group: str, suffix: str) -> str:
    """Median and MAD by group for each metric, z by the inverted constant, percent rank with nulls last."""
    ms = peers.METRICS
    z = [f"case when sz >= 30 then 1.4826 * ({m} - med_{m}) / nullif(mad_{m}, 0) end as {m}_rz_{suffix}" for m in ms]
    p = [f"case when sz >= 30 then p_{m} end as {m}_pct_{suffix}" for m in ms]
    return f"""select npi, sz as peer_group_size_{suffix}, sz < 30 as peer_group_too_small_{suffix}, {", ".join(z + p)} from (
      select *, {", ".join(f"median(abs({m} - med_{m})) over (partition by g) as mad_{m}" for m in ms)} from (
        select npi, g, count(*) over (partition by g) as sz, {", ".join(f"{m}, median({m}) over (partition by g) as med_{m}, percent_rank() over (partition by g order by {m} nulls last) as p_{m}" for m in ms)}
        from (select npi, {group} as g, net_paid, {", ".join(f"round({e}, 6) as {m}" for m, e in (("paid_per_claim_line", "net_paid / total_claim_lines"), ("lines_per_patient_instance", "total_claim_lines / service_volume"), ("paid_per_patient_instance", "net_paid / service_volume")))} from core)))"""


def _peer_columns(suffix: str) -> str:
    return f"npi peer_group_size_{suffix}:i peer_group_too_small_{suffix} " + " ".join(f"{m}_rz_{suffix}:d {m}_pct_{suffix}:d" for m in peers.METRICS)


def _core_rounded(t: Tables) -> DataFrame:
    core = features.core(t.claims(), "billing_npi", CARRIED).withColumnRenamed("billing_npi", "npi")
    return core.withColumns({m: F.round(F.col(m).cast("double"), 6) for m in peers.METRICS})


@query("core", _peer_columns("tax"), _peer_sql("primary_taxonomy", "tax"))
def peer_robust_z(t: Tables) -> DataFrame:
    return peers.peer_features(_core_rounded(t), "npi", F.col("primary_taxonomy"), "tax")


@query("core", _peer_columns("taxstate"), _peer_sql("primary_taxonomy || '|' || practice_state", "taxstate"))
def peer_percent_rank(t: Tables) -> DataFrame:
    return peers.peer_features(_core_rounded(t), "npi", F.concat("primary_taxonomy", F.lit("|"), F.coalesce("practice_state", F.lit(""))), "taxstate")


@query("prates", "npi pct_hhi:d pct_yoy:d", f"select k as npi, {pct('hcpcs_hhi', 'tax')} as pct_hhi, {pct('yoy_growth_net_paid', 'tax')} as pct_yoy from prates")
def pct_rank_avg(t: Tables) -> DataFrame:
    tax = F.col("primary_taxonomy")
    return t.provider_scoring().select("npi", numbers.mean_tie_percentile(F.col("hcpcs_hhi"), tax).alias("pct_hhi"), numbers.mean_tie_percentile(F.col("yoy_growth_net_paid"), tax).alias("pct_yoy"))


_FEATS = peers.FEATURES


def _v1_sql() -> str:
    med = ", ".join(f"{f}, median({f}) over (partition by tax) as m_{f}" for f in _FEATS)
    mad = ", ".join(f"median(abs({f} - m_{f})) over (partition by tax) as d_{f}" for f in _FEATS)
    z = ", ".join(f"case when {f} is not null and d_{f} <> 0 then greatest(-50, least(50, 1.4826 * ({f} - m_{f}) / d_{f})) end as z_{f}" for f in _FEATS)
    hits = " + ".join(f"coalesce(z_{f} >= 3.5, false)::int" for f in _FEATS)
    total = " + ".join(f"case when z_{f} >= 3.5 then z_{f} else 0 end" for f in _FEATS)
    return f"select npi, not ok as not_scored, case when ok then '' else 'peer_group_too_small(<30)' end as not_scored_reason, case when ok then {hits} else 0 end as n_anomaly_signals, case when ok then {total} end as anomaly_score, ok and {hits} >= 2 as anomaly_lead from (select k as npi, ok, {z} from (select *, {mad} from (select k, tax, count(*) over (partition by tax) >= 30 as ok, {med} from prates)))"


@query("prates", "npi not_scored not_scored_reason n_anomaly_signals:i anomaly_score:d anomaly_lead", _v1_sql())
def anomaly_v1(t: Tables) -> DataFrame:
    return peers.anomaly_v1(t.provider_scoring(), "npi").drop("signals")


def _v2_sql() -> str:
    p = ", ".join(f"{pct(f, 'pk')} as p_{f}" for f in _FEATS)
    n = " + ".join(f"coalesce(p_{f} >= 0.99, false)::int" for f in _FEATS)
    mean = f"list_avg(list_filter([{', '.join(f'p_{f}' for f in _FEATS)}], lambda x: x is not null))"
    return f"""select npi, peer_basis, case when pk is null then 'peer_group_too_small(<30)' else '' end as not_scored_reason, case when pk is null then 0 else {n} end as n_extreme_p99, case when pk is not null then {mean} end as anomaly_score_v2, pk is not null and {n} >= 2 as anomaly_lead_v2
      from (select *, {p} from (select *, case when te >= 30 then tax || '|' || ent when tx >= 30 then tax end as pk, case when te >= 30 then 'taxonomy_x_entity' when tx >= 30 then 'taxonomy_only' else 'too_small' end as peer_basis
        from (select *, k as npi, count(*) over (partition by tax, ent) as te, count(*) over (partition by tax) as tx from prates)))"""


@query("prates", "npi peer_basis not_scored_reason n_extreme_p99:i anomaly_score_v2:d anomaly_lead_v2", _v2_sql())
def anomaly_v2(t: Tables) -> DataFrame:
    return peers.anomaly_v2(t.provider_scoring(), "npi")


def _v3_sql(rates: str, key: str) -> str:
    feats = (*_FEATS, peers.CONTEXT)
    p = ", ".join(f"case when te >= 30 then {pct(f, 'ok, tax, ent')} else {pct(f, 'ok, tax')} end as p_{f}" for f in feats)
    c = ", ".join(f"case when ok then greatest({', '.join(f'p_{f}' for f in fs)}) end as {name}" for name, fs in peers.CONCEPTS.items())
    names_ = list(peers.CONCEPTS)
    n = " + ".join(f"coalesce({x} >= 0.99, false)::int" for x in names_)
    return f"""select {key}, peer_basis, not ok as not_scored, case when gross_paid <= 0 then 'degenerate_zero_gross_paid' when not gate then 'low_volume_unreliable' when ok then '' else 'peer_group_too_small(<30)' end as not_scored_reason, {", ".join(names_)}, {n} as n_concept_signals,
        list_avg(list_filter([{", ".join(names_)}], lambda x: x is not null)) as anomaly_score, {n} >= 2 as anomaly_lead from (
      select *, {c} from (select *, {p} from (
        select *, k as {key}, gate and gross_paid > 0 and (te >= 30 or tx >= 30) as ok, case when te >= 30 then 'taxonomy_x_entity' when tx >= 30 then 'taxonomy_only' else 'too_small' end as peer_basis from (
          select *, count(*) filter (where gate and gross_paid > 0) over (partition by tax, ent) as te, count(*) filter (where gate and gross_paid > 0) over (partition by tax) as tx
          from (select *, service_volume >= 30 and total_claim_lines >= 100 as gate from {rates})))))"""


_V3 = "peer_basis not_scored not_scored_reason " + " ".join(f"{c}:d" for c in peers.CONCEPTS) + " n_concept_signals:i anomaly_score:d anomaly_lead"


@query("prates", f"npi {_V3}", _v3_sql("prates", "npi"))
def score_concepts_provider(t: Tables) -> DataFrame:
    return peers.score_concepts(t.provider_scoring(), "npi").drop("contributing_concepts")


@query("crates", f"company_id {_V3}", _v3_sql("crates", "company_id"))
def score_concepts_company(t: Tables) -> DataFrame:
    return peers.score_concepts(t.company_scoring(), "company_id").drop("contributing_concepts")


@query("core", "npi rule_implausible_lines_per_patient rule_implausible_paid_per_line", "select npi, total_claim_lines / service_volume > 8 as rule_implausible_lines_per_patient, net_paid / total_claim_lines > 2500 as rule_implausible_paid_per_line from core")
def implausible_rates(t: Tables) -> DataFrame:
    from dataclasses import replace

    core = features.core(t.claims(), "billing_npi").withColumnRenamed("billing_npi", "npi")
    return peers.implausible(core, replace(DEFAULT, max_lines_per_patient=8.0, max_paid_per_line=2500.0)).select("npi", "rule_implausible_lines_per_patient", "rule_implausible_paid_per_line")


@query("linked", "npi priority_tier", "select npi, case when k % 100 = 0 then '1_L1_billed_after_exclusion' when k % 17 = 0 then '2_L1_implausible_rate' when k % 50 = 0 then '3_L1_excluded_after_billing' when k % 13 = 0 then '4_L2_anomaly' when k % 41 = 0 then '5_L3_probable_owner' else '6_none' end as priority_tier from linked")
def priority_tiers(t: Tables) -> DataFrame:
    k = F.col("npi").cast("bigint")
    return t.linked().select("npi", peers.priority_tier(F.col("billed_after_exclusion"), k % 17 == 0, F.col("provider_on_leie"), F.col("npi_lead"), F.col("probable_owner")).alias("priority_tier"))


@query()
def feature_summary(t: Tables) -> DataFrame:
    """Approximate quantiles, which have no equal in the SQL engine."""
    long = peers.unpivot(t.provider_scoring(), ["npi"], (*peers.FEATURES, "net_paid"))
    return long.groupBy("metric").agg(F.count("x").alias("n"), F.percentile_approx("x", [0.5, 0.9, 0.99]).alias("q")).select("metric", "n", *[F.col("q")[i].alias(f"p{p}") for i, p in enumerate((50, 90, 99))])


# identity

_RAW = "select c_custkey as id, case when c_custkey % 11 = 0 then null when c_custkey % 7 = 0 then 'A' || c_custkey when c_custkey % 5 = 0 then ' ''' || (c_custkey + 1000000000) else (c_custkey + 1000000000)::varchar end as raw0 from customer"


def _raw_ids(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    plain = (k + 1_000_000_000).cast("string")
    return t.read("customer").select(k.alias("id"), F.when(k % 11 == 0, None).when(k % 7 == 0, F.concat(F.lit("A"), k)).when(k % 5 == 0, F.concat(F.lit(" '"), plain)).otherwise(plain).alias("raw"))


@query("", "id npi", f"select id, case when length(raw) = 10 and {_NPI_OK} then raw end as npi from (select id, case when length(regexp_replace(raw0, '[^0-9]', '', 'g')) = 10 then regexp_replace(raw0, '[^0-9]', '', 'g') else '0000000000' end as raw, length(regexp_replace(raw0, '[^0-9]', '', 'g')) = 10 as ok from ({_RAW})) where true".replace("case when length(raw) = 10 and", "case when ok and"))
def npi_canonicalize(t: Tables) -> DataFrame:
    return _raw_ids(t).select("id", ids.canonical_npi(F.col("raw")).alias("npi"))


@query("", "source raw_value reason", f"""select distinct 'spending_billing' as source, trim(raw0) as raw_value, 'failed_luhn_or_format' as reason from (select raw0, case when length(d) = 10 then d else '0000000000' end as raw, length(d) = 10 as ok
    from (select raw0, regexp_replace(raw0, '[^0-9]', '', 'g') as d from ({_RAW}))) where raw0 is not null and not (ok and {_NPI_OK})""")
def npi_quarantine(t: Tables) -> DataFrame:
    return attribution.quarantine(_raw_ids(t), "raw", "spending_billing")


@query("", "bucket n:i", f"""select bucket, count(*) as n from (select case when raw0 is null then 'blank' when regexp_matches(trim(raw0), '^[A-Za-z]') then 'alpha_prefixed' when regexp_matches(trim(raw0), '^[0-9]{{10}}$') and {_NPI_OK} then 'valid_not_registered'
    when regexp_matches(trim(raw0), '^[0-9]{{10}}$') then 'failed_luhn' else 'malformed' end as bucket from (select raw0, case when regexp_matches(trim(raw0), '^[0-9]{{10}}$') then trim(raw0) else '0000000000' end as raw from ({_RAW}))) group by 1""")
def identifier_buckets(t: Tables) -> DataFrame:
    return _raw_ids(t).groupBy(ids.identifier_bucket(F.col("raw")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("names", "id name_key", r"select id, trim(regexp_replace(regexp_replace(regexp_replace(trim(upper(name)), '[.,]', ' ', 'g'), '\b(" + "|".join(names.NAME_TOKENS) + r")\b', ' ', 'g'), '\s+', ' ', 'g')) as name_key from names")
def name_normalize(t: Tables) -> DataFrame:
    return t.names().select("id", names.name_key(F.col("name")).alias("name_key"))


_COMPANY_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(name), '[^A-Z0-9 ]', ' ', 'g'), '^THE ', ''), '\b(" + "|".join(names.LEGAL_SUFFIXES) + r")\b', ' ', 'g'), '\s+', ' ', 'g'))"


@query("names", "id company_key root", f"select id, ck as company_key, array_to_string(string_split(ck, ' ')[1:3], ' ') as root from (select id, {_COMPANY_KEY} as ck from names)")
def company_name_key(t: Tables) -> DataFrame:
    return t.names().select("id", names.company_key(F.col("name")).alias("company_key"), names.name_root(F.col("name")).alias("root"))


@query("", "p_brand p_partkey completeness:i", """select p_brand, p_partkey, completeness from (select *, row_number() over (partition by p_brand order by completeness desc, p_partkey) as rn
    from (select p_brand, p_partkey, (p_size % 3 <> 0)::int + (p_type <> 'ECONOMY')::int as completeness from part)) where rn = 1""")
def dedup_best_record(t: Tables) -> DataFrame:
    part = t.read("part").select("p_brand", "p_partkey", F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("a"), F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("b"))
    return attribution.best_record(part, ["p_brand"], ["a", "b"], ["p_partkey"]).select("p_brand", "p_partkey", "completeness")


@query("", "edge facility_npi", """with pac as (select (c_custkey % 60)::varchar as pac_id, min(c_custkey)::varchar as lo, max(c_custkey)::varchar as hi from customer where c_custkey < 90 group by 1)
    select s_suppkey as edge, coalesce(case when s_suppkey % 2 = 0 then s_suppkey::varchar end, case when lo = hi then lo end) as facility_npi from supplier left join pac on pac_id = (s_suppkey % 75)::varchar""")
def owner_resolution(t: Tables) -> DataFrame:
    s, k = F.col("s_suppkey"), F.col("c_custkey")
    edges = t.read("supplier").select(s.alias("edge"), F.concat(F.lit("E"), s).alias("enrollment_id"), (s % 75).cast("string").alias("pac_id"))
    enrollment = t.read("supplier").where(s % 2 == 0).select(F.concat(F.lit("E"), s).alias("enrollment_id"), s.cast("string").alias("npi"))
    pac = t.read("customer").where(k < 90).select((k % 60).cast("string").alias("pac_id"), k.cast("string").alias("npi"))
    return attribution.resolve_owner(edges, enrollment, pac).select("edge", "facility_npi")


@query("owners,excl", "facility_npi n_owners:i n_high:i n_probable:i weighted_high:d weighted_probable:d has_high_excluded_owner:i has_probable_excluded_owner:i", """
    select facility_npi, count(*) as n_owners, count(*) filter (where a) as n_high, count(*) filter (where b and not a) as n_probable, coalesce(sum(w) filter (where a), 0) as weighted_high, coalesce(sum(w) filter (where b and not a), 0) as weighted_probable,
      bool_or(a)::int as has_high_excluded_owner, bool_or(b and not a)::int as has_probable_excluded_owner
    from (select *, coalesce(owner_npi in (select npi from excl), false) as a, match_key in (select name_key from excl) as b, case when owner_role in ('MANAGING CONTROL', '5% OWNERSHIP') then 1.0 when owner_role = 'DIRECTOR' then 0.6 else 0.3 end as w from owners)
    group by 1 having bool_or(a or b)""")  # fmt: skip
def facility_flags(t: Tables) -> DataFrame:
    return exclusions.facility_flags(exclusions.owner_matches(t.owners(), t.exclusions()))


@query("owners", "owner_role rank:i weight:d n:i", "select owner_role, case when owner_role in ('MANAGING CONTROL', '5% OWNERSHIP') then 3 when owner_role = 'DIRECTOR' then 2 else 1 end as rank, case when owner_role in ('MANAGING CONTROL', '5% OWNERSHIP') then 1.0 when owner_role = 'DIRECTOR' then 0.6 else 0.3 end as weight, count(*) as n from owners group by 1")
def role_weight(t: Tables) -> DataFrame:
    role = F.col("owner_role")
    return t.owners().select(role, names.role_rank(role).alias("rank"), names.role_weight(role).alias("weight")).groupBy("owner_role", "rank", "weight").agg(F.count(F.lit(1)).alias("n"))


# exclusions


@query("claims,excl", "npi excl_month paid_after_exclusion:d n_months_after:i first_after last_month billed_after_exclusion excluded_after_billing", """
    select npi, em as excl_month, sum(total_paid) filter (where service_month >= em) as paid_after_exclusion, count(distinct service_month) filter (where service_month >= em) as n_months_after, min(service_month) filter (where service_month >= em) as first_after,
      max(service_month) as last_month, max(service_month) >= em as billed_after_exclusion, max(service_month) < em as excluded_after_billing
    from claims join (select npi, min(excl_month) as em from excl group by npi) on billing_npi = npi group by npi, em""")  # fmt: skip
def billed_while_excluded(t: Tables) -> DataFrame:
    return exclusions.billed_while_excluded(t.claims(), t.exclusions())


@query("status", "npi service_month paid:d claim_lines:i status", "select npi, service_month, paid, lines as claim_lines, status from status")
def month_status(t: Tables) -> DataFrame:
    return exclusions.month_status(t.provider_months(), t.exclusions())


@query("status", "npi paid_after:d n_clean_after_months:i claim_lines_after:i same_month_paid:d reinstated_or_waivered_paid:d billed_before_paid:d first_clean_after_month last_clean_after_month disposition", """
    select *, case when paid_after > 0 then 'QUALIFIED' when same_month_paid > 0 then 'AMBIGUOUS' when reinstated_or_waivered_paid > 0 then 'DISQUALIFIED' else 'CONTEXT_ONLY' end as disposition from (
      select npi, coalesce(sum(paid) filter (where status = 'clean_after'), 0) as paid_after, count(*) filter (where status = 'clean_after' and paid > 0) as n_clean_after_months, coalesce(sum(lines) filter (where status = 'clean_after'), 0) as claim_lines_after,
        coalesce(sum(paid) filter (where status = 'same_month'), 0) as same_month_paid, coalesce(sum(paid) filter (where status in ('reinstated', 'waivered')), 0) as reinstated_or_waivered_paid, coalesce(sum(paid) filter (where status = 'before'), 0) as billed_before_paid,
        min(service_month) filter (where status = 'clean_after' and paid > 0) as first_clean_after_month, max(service_month) filter (where status = 'clean_after' and paid > 0) as last_clean_after_month from status group by npi)""")  # fmt: skip
def exclusion_dispositions(t: Tables) -> DataFrame:
    return exclusions.dispositions(exclusions.month_status(t.provider_months(), t.exclusions()))


@query("claims,status", "npi top_hcpcs_after", """select npi, string_agg(hcpcs_code || '($' || round_even(paid, 0)::bigint || ')', '; ' order by rn) as top_hcpcs_after from (
    select *, row_number() over (partition by npi order by paid desc, hcpcs_code) as rn from (
      select s.npi, c.hcpcs_code, sum(c.total_paid) as paid from status s join claims c on c.billing_npi = s.npi and c.service_month = s.service_month where s.status = 'clean_after' and s.paid > 0 group by all)) where rn <= 5 group by npi""")
def top_codes_after(t: Tables) -> DataFrame:
    return exclusions.top_codes_after(t.claims(), exclusions.month_status(t.provider_months(), t.exclusions()))


_LEIE = """select company_id, (n > 0 or nm)::int as hit, (n > 0)::int as hit_npi, case when n > 0 then 'npi' when nm then 'name' else '' end as match_confidence, case when n > 0 then a when nm then b end as exclusion_date from (
    select c.company_id, count(e.npi) as n, min(e.excl_date) as a, bool_or(x.s is not null) as nm, min(x.excl_date) as b
    from (select s_suppkey as company_id, s_suppkey + 1000000000 as n1, s_name, ['TX', 'NY', 'CA'][s_suppkey % 3 + 1] as st from supplier) c
    left join (select (c_custkey + 1000000000)::varchar as npi, '1999' || lpad((c_custkey % 12 + 1)::varchar, 2, '0') || '01' as excl_date from customer where c_custkey % 10 = 0) e on e.npi = c.n1::varchar
    left join (select 'SUPPLIER' || lpad(s_suppkey::varchar, 9, '0') as s, 'NY' as state, '20200101' as excl_date from supplier where s_suppkey % 4 = 0) x on x.s = regexp_replace(upper(c.s_name), '[^A-Z0-9]', '', 'g') and x.state = c.st group by 1)"""


@query("", "company_id hit:i hit_npi:i match_confidence exclusion_date", _LEIE)
def leie_labels(t: Tables) -> DataFrame:
    s, k = F.col("s_suppkey"), F.col("c_custkey")
    firms = t.read("supplier").select(s.alias("company_id"), F.col("s_name").alias("company_name"), F.concat((s + 1_000_000_000).cast("string"), F.lit(":12; x")).alias("npi_list"), F.concat(F.element_at(F.array(*map(F.lit, ("TX", "NY", "CA"))), (s % 3 + 1).cast("int")), F.lit("; Other")).alias("states"))
    by_npi = t.read("customer").where(k % 10 == 0).select((k + 1_000_000_000).cast("string").alias("npi"), F.concat(F.lit("1999"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("01")).alias("excl_date"))
    by_name = t.read("supplier").where(s % 4 == 0).select(F.concat(F.lit("SUPPLIER"), F.lpad(s.cast("string"), 9, "0")).alias("name_key"), F.lit("NY").alias("state"), F.lit("20200101").alias("excl_date"))
    return evaluation.labels(firms, by_npi, by_name).select("company_id", "hit", "hit_npi", "match_confidence", "exclusion_date")


# companies


@query("map", "npi company_id merge_basis_raw", "select npi, company_id, basis as merge_basis_raw from map")
def company_linkage(t: Tables) -> DataFrame:
    return companies.link(t.providers()).select("npi", "company_id", "merge_basis_raw")


@query("comp2", "company_id company_net_paid:d company_gross_paid:d npi_count:i max_constituent_net_paid:d states n_states:i primary_taxonomies entity_types company_name merge_basis merge_confidence any_provider_on_leie any_billed_after_exclusion max_anomaly_score:d max_n_concept_signals:i any_probable_excluded_owner best_priority_rank:i flagged any_npi_lead",
       "select *, best_priority_rank <= 5 as flagged from comp2")
def company_rollup(t: Tables) -> DataFrame:
    return t.companies().drop("npi_list")


@query("cdims", "company_id primary_taxonomy entity_type", "select * from cdims")
def dominant_category(t: Tables) -> DataFrame:
    return t.company_dims()


@query("track", "company_id priority_tier priority_rank:i paid_after:d anomaly_tier_member fragmentation_signal", "select *, left(priority_tier, 1)::int as priority_rank, member as anomaly_tier_member from track")
def company_tracker(t: Tables) -> DataFrame:
    return t.tracked().select("company_id", "priority_tier", "priority_rank", "paid_after", "anomaly_tier_member", "fragmentation_signal")


_STRENGTH = "case left(priority_tier, 1) when '3' then max_anomaly_score when '1' then paid_after else company_net_paid end"


@query("track", "company_id priority_tier strength:d rank:i", f"select company_id, priority_tier, {_STRENGTH} as strength, row_number() over (order by left(priority_tier, 1), {_STRENGTH} desc, company_id) as rank from track where left(priority_tier, 1) < '5'")
def tier_ranking(t: Tables) -> DataFrame:
    return companies.ranked(t.tracked()).select("company_id", "priority_tier", "strength", "rank")


@query("track", "company_id name_unresolved genuine_fragmentation possible_same_operator review_flags", f"""
    select company_id, false as name_unresolved, frag as genuine_fragmentation, same as possible_same_operator, concat_ws('; ', case when merge_confidence = 'low' then 'low_merge_confidence' end, case when same then 'possible_same_operator' end, case when frag then 'genuine_fragmentation' end) as review_flags
    from (select *, count(*) over (partition by root, states) >= 2 as same, coalesce(fragmentation_signal and max_constituent_net_paid / nullif(company_net_paid, 0) < 0.5, false) as frag
      from (select *, array_to_string(string_split({_COMPANY_KEY.replace('upper(name)', 'upper(company_name)')}, ' ')[1:3], ' ') as root from track))""")
def triage_flags(t: Tables) -> DataFrame:
    return companies.triage(t.tracked()).select("company_id", "name_unresolved", "genuine_fragmentation", "possible_same_operator", "review_flags")


@query("comp", "company_id score:d company_net_paid:d", "select company_id, max_anomaly_score as score, company_net_paid from comp where company_net_paid >= 1000000 order by max_anomaly_score desc, company_net_paid desc, company_id limit 50")
def topk_companies(t: Tables) -> DataFrame:
    from dataclasses import replace

    return companies.top(t.companies().withColumn("score", F.col("max_anomaly_score")), 50, replace(DEFAULT, min_net_paid=1e6)).select("company_id", "score", "company_net_paid")


@query("linked", "company_id top_npi top_net_paid:d resolved_name dominant_taxonomy", """
    with top as (select company_id, npi, net_paid, k, org_legal_name from (select *, row_number() over (partition by company_id order by net_paid desc, npi desc) as rn from linked) where rn = 1),
      tax as (select company_id, primary_taxonomy from (select company_id, primary_taxonomy, row_number() over (partition by company_id order by sum(net_paid) desc, primary_taxonomy desc) as rn from linked group by company_id, primary_taxonomy) where rn = 1)
    select t.company_id, npi as top_npi, net_paid as top_net_paid, case when k % 4 = 0 then 'Dr ' || npi else org_legal_name end as resolved_name, primary_taxonomy as dominant_taxonomy from top t left join tax using (company_id)""")  # fmt: skip
def company_lookups(t: Tables) -> DataFrame:
    k = F.col("npi").cast("bigint")
    known = t.linked().select("npi", F.when(k % 4 == 0, F.concat(F.lit("Dr "), "npi")).otherwise("").alias("provider_name"))
    return leads.company_lookups(t.linked(), known)


@query("track", "company_id reasons", r"""select company_id, concat_ws('. ', case left(priority_tier, 1)
      when '1' then 'Billed while excluded — a constituent NPI billed on or after its OIG LEIE exclusion date ($' || format('{:,}', round_even(paid_after, 0)::bigint) || ' billed after exclusion)'
      when '2' then 'A constituent NPI is on the OIG LEIE exclusion list' when '3' then 'Company-level billing anomaly vs. company peers (score ' || format('{:.2f}', max_anomaly_score) || ')'
      when '4' then 'A facility has a probable excluded owner (low-confidence name match)' end,
    case when member and left(priority_tier, 1) <> '1' then 'company anomaly: temporal at ≥99th percentile vs peers' end,
    case when fragmentation_signal and max_constituent_net_paid / nullif(company_net_paid, 0) < 0.5 then 'billing is genuinely fragmented across NPIs (possible split-billing — no single NPI was flagged, but the company is extreme consolidated)' end,
    case when any_provider_on_leie and left(priority_tier, 1) > '2' then 'also has an NPI on the OIG LEIE list' end,
    case when any_probable_excluded_owner and left(priority_tier, 1) <> '4' then 'also has a probable excluded owner' end) || '.' as reasons from track""")  # fmt: skip
def company_reasons(t: Tables) -> DataFrame:
    why = F.when(F.col("anomaly_tier_member"), F.array(F.lit("temporal(pct=0.999)"), F.lit("log_max_single_month(pct=1.000,context)")))
    return companies.triage(t.tracked()).withColumn("contributing_concepts", why).select("company_id", leads.sentence().alias("reasons"))


@query("track", "priority_tier n:i paid:d", "select priority_tier, count(*) as n, sum(company_net_paid) as paid from track group by 1")
def tier_counts(t: Tables) -> DataFrame:
    from claimscope.plans.stages import tier_counts as counted

    return counted(t.tracked())


_PROJECTED = """select npi, case when k % 3 = 0 then 'Dr ' || npi else org_legal_name end as provider_name, case entity_type when '1' then 'individual' else 'organization' end as entity_type, primary_taxonomy, '' as taxonomy_description,
    practice_state as state, case when k % 100 = 0 then '1_L1_billed_after_exclusion' when k % 50 = 0 then '3_L1_excluded_after_billing' when k % 13 = 0 then '4_L2_anomaly' when k % 41 = 0 then '5_L3_probable_owner' else '6_none' end as priority_tier,
    net_paid, on_leie as provider_on_leie, baf as billed_after_exclusion, case when k % 70 = 0 then 'QUALIFIED' end as layer1_disposition, case when k % 70 = 0 then k::double end as paid_after, round(score, 4) as anomaly_score, n_sig as n_concept_signals,
    case when k % 13 = 0 then 'temporal; concentration' else '' end as contributing_concepts, own_flag as probable_excluded_owner,
    concat_ws(' | ', case when k % 100 = 0 then 'billed' end, case when k % 13 = 0 then 'temporal; concentration' end, case when own_flag then 'probable_excluded_owner' end) as reasons from linked"""
_PROJECTED_COLUMNS = "npi provider_name entity_type primary_taxonomy taxonomy_description state priority_tier net_paid:d provider_on_leie billed_after_exclusion layer1_disposition paid_after:d anomaly_score:d n_concept_signals:i contributing_concepts probable_excluded_owner reasons"


def _projected(t: Tables) -> DataFrame:
    k, none = F.col("npi").cast("bigint"), F.array().cast("array<string>")
    rank = F.when(k % 100 == 0, 0).when(k % 50 == 0, 2).when(k % 13 == 0, 3).when(k % 41 == 0, 4).otherwise(5)
    tier = F.element_at(F.array(*map(F.lit, peers.TIERS)), rank + 1)
    ready = t.linked().withColumns({
        "priority_tier": tier, "priority_rank": rank + 1, "rule_reasons": F.when(k % 100 == 0, F.array(F.lit("billed"))).otherwise(none), "contributing_concepts": F.when(k % 13 == 0, F.array(F.lit("temporal"), F.lit("concentration"))).otherwise(none),
    })
    known = t.linked().where(k % 3 == 0).select("npi", F.concat(F.lit("Dr "), "npi").alias("provider_name"))
    cases = t.linked().where(k % 70 == 0).select("npi", F.lit("QUALIFIED").alias("disposition"), k.cast("double").alias("paid_after"))
    return leads.provider_leads(ready, known, cases)


@query("linked", _PROJECTED_COLUMNS, f"select * from ({_PROJECTED}) where priority_tier <> '6_none' and net_paid >= 500000")
def final_leads(t: Tables) -> DataFrame:
    from dataclasses import replace

    return leads.final_leads(_projected(t), replace(DEFAULT, min_net_paid=5e5)).drop("priority_rank")


@query("linked", _PROJECTED_COLUMNS, f"select * from ({_PROJECTED}) where left(priority_tier, 1) = '1' or layer1_disposition = 'QUALIFIED'")
def excluded_leads(t: Tables) -> DataFrame:
    return leads.excluded_leads(_projected(t)).drop("priority_rank")


@query("linked", "kind n:i", f"select kind, count(*) as n from ({_PROJECTED}), unnest(['fraud_leads', 'leads_ranked', 'layer1_rule_hits', 'layer3_ownership_leads']) u(kind) where kind = 'fraud_leads' or (kind = 'leads_ranked' and left(priority_tier, 1) <= '5') or (kind = 'layer1_rule_hits' and left(priority_tier, 1) <= '3') or (kind = 'layer3_ownership_leads' and probable_excluded_owner) group by kind")
def flat_lead_files(t: Tables) -> DataFrame:
    met = _projected(t)
    return reduce(DataFrame.unionByName, [met.where(keep).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, keep in leads.lead_kinds().items()])


# screening


_ALNUM = "trim(regexp_replace(upper(name), '[^A-Z0-9]+', ' ', 'g'))"
# The SQL of the screens is written out here, apart from the library's lists.
_CLASSES = r"""
    case when specialty like '%261QF0400X%' then 'fqhc_taxonomy' when specialty like '%282N00000X%' then 'hospital_taxonomy'
      when regexp_matches(n, '\b(COUNTY OF|CITY OF|STATE OF|COMMONWEALTH OF|TOWN OF|VILLAGE OF|BOROUGH OF|PARISH OF|DEPARTMENT OF|DEPT OF|BOARD OF|HOSPITAL DISTRICT|HEALTH DISTRICT|HEALTHCARE DISTRICT|HEALTH AUTHORITY|HOSPITAL AUTHORITY|PUBLIC HEALTH|MUNICIPAL|HEALTH AND HOSPITALS|HOSPITAL SERVICE DISTRICT|HEALTH CARE DISTRICT|HEALTHCARE AUTHORITY|MEDICAL CENTER AUTHORITY|SERVICE DISTRICT NO)\b') or regexp_matches(n, '\bCOUNTY$') then 'government'
      when regexp_matches(n, '\b(TRIBE|TRIBAL|RANCHERIA|PUEBLO|NATION|BAND OF|NATIVE AMERICAN|INDIAN HEALTH|INDIAN NATION|INDIAN TRIBE|REGIONAL HEALTH CONSORTIUM|NATIVE ASSOCIATION|ALASKA NATIVE)\b') then 'tribal'
      when regexp_matches(n, '\b(UNIVERSITY|REGENTS OF|BOARD OF REGENTS|STATE COLLEGE|COLLEGE OF MEDICINE)\b') then 'public_academic'
      when regexp_matches(n, '\b(VOLUNTEERS OF AMERICA|SALVATION ARMY|GOODWILL|CATHOLIC CHARITIES|EASTERSEALS|EASTER SEALS|SHRINERS|BANCROFT|MELMARK|THE ARC|ARC OF|UNITED WAY|YMCA|YWCA|RED CROSS|LUTHERAN SOCIAL SERVICES|JEWISH FAMILY|ST JUDE|BOYS AND GIRLS|BOYS GIRLS CLUB)\b') then 'national_nonprofit'
      when regexp_matches(n, '\b(HOSPITAL|MEDICAL CENTER|MED CENTER|MED CTR|INFIRMARY|HEALTH SYSTEM|HEALTHCARE SYSTEM|HEALTH NETWORK|CLINIC FOUNDATION|ASCENSION|PROVIDENCE HEALTH|TRINITY HEALTH|ADVENTIST|CATHOLIC HEALTH|DIGNITY HEALTH|COMMONSPIRIT|KAISER|MAYO CLINIC|CLEVELAND CLINIC|INTERMOUNTAIN|SUTTER|GEISINGER|OCHSNER|BANNER HEALTH)\b') then 'hospital_name' end as lead_class,
    case when regexp_matches(n, '\b(LABORATORY CORPORATION OF AMERICA|LABCORP|QUEST DIAGNOSTICS)\b') then 'labs'
      when regexp_matches(n, '\b(PUBLIC PARTNERSHIPS|CONSUMER DIRECT CARE|ACUMEN FISCAL|GT INDEPENDENCE|TEMPUS UNLIMITED|PALCO|MORNING SUN FINANCIAL|ANNKISSAM|FISCAL)\b') then 'fiscal_intermediary'
      when regexp_matches(n, '\b(COUNTY OF|CITY OF|CITY AND COUNTY OF|STATE OF|COMMONWEALTH OF|TOWN OF|VILLAGE OF|BOROUGH OF|PARISH OF|DEPARTMENT OF|DEPT OF|BOARD OF|HOSPITAL DISTRICT|HEALTH DISTRICT|HEALTHCARE DISTRICT|HEALTH AUTHORITY|HOSPITAL AUTHORITY|PUBLIC HEALTH|MUNICIPAL|HEALTH AND HOSPITALS)\b') then 'government'
      when regexp_matches(n, '\b(TRIBE|TRIBAL|RANCHERIA|PUEBLO|NATION|BAND OF|NATIVE AMERICAN|INDIAN HEALTH|INDIAN NATION|INDIAN TRIBE)\b') then 'tribal'
      when regexp_matches(n, '\b(UNIVERSITY|REGENTS OF|BOARD OF REGENTS|STATE COLLEGE|COLLEGE OF MEDICINE)\b') then 'public_academic'
      when regexp_matches(n, '\b(VOLUNTEERS OF AMERICA|SALVATION ARMY|GOODWILL|CATHOLIC CHARITIES|EASTERSEALS|EASTER SEALS|SHRINERS|BANCROFT|MELMARK|THE ARC|ARC OF|UNITED WAY|YMCA|YWCA|RED CROSS|LUTHERAN SOCIAL SERVICES|GOOD SAMARITAN SOCIETY|EVANGELICAL LUTHERAN|JEWISH FAMILY|ST JUDE|BOYS AND GIRLS|BOYS GIRLS CLUB)\b') then 'national_nonprofit'
      when regexp_matches(n, '\bCOUNTY$') then 'government' end as advert_class"""


@query("names", "id lead_class advert_class", f"select id, {_CLASSES} from (select *, {_ALNUM} as n from names)")
def keyword_classify(t: Tables) -> DataFrame:
    n = F.col("name")
    return t.names().select("id", screening.lead_class(n, F.col("specialty")).alias("lead_class"), screening.advert_class(n).alias("advert_class"))


_ADVERT = """
    select company_id, states as states_all, case when any_provider_on_leie or max_anomaly_score >= 0.9 then 'high' when max_anomaly_score >= 0.8 then 'medium' else 'low' end as lead_strength,
      case when row_number() over w > 1 then 'duplicate' end as reason, case when row_number() over w > 1 then first(company_name) over w end as matched
    from (select * replace (replace(company_name, 'NATION', 'LAND') as company_name) from comp) where company_net_paid >= 1000000 and (max_anomaly_score >= 0.7 or any_provider_on_leie)
    window w as (partition by trim(regexp_replace(upper(company_name), '[^A-Z0-9]+', ' ', 'g')), string_split(states, '; ')[1] order by any_provider_on_leie desc, max_anomaly_score desc, company_net_paid desc, company_id)"""


@query("comp", "company_id states_all lead_strength reason matched", _ADVERT)
def advert_selection(t: Tables) -> DataFrame:
    from dataclasses import replace

    named = t.companies().withColumn("company_name", F.replace("company_name", F.lit("NATION"), F.lit("LAND")))  # NATION is a keyword of the screen
    return leads.advert_selection(named, replace(DEFAULT, min_net_paid=1e6)).select("company_id", "states_all", "lead_strength", "reason", "matched")


@query("names", "id states_all", "select id, case states when 'TX' then 'Texas' when 'CA; NY' then 'California; New York' when 'tx/ca' then 'Texas; California' else '' end as states_all from names")
def full_states(t: Tables) -> DataFrame:
    return t.names().select("id", F.array_join(lookups.full_states(F.col("states")), "; ").alias("states_all"))


@query("", "id specialty lead_specialty", """select id, coalesce(name, 'Unknown / not in crosswalk') as specialty, case when code = '' then '' else coalesce(name, code || ' (taxonomy code)') end as lead_specialty from (
    select p_partkey::bigint as id, ['207Q00000X', '163W00000X', '999X00000X', '', '314000000X'][p_partkey % 5 + 1] as code, ['Family Medicine', 'Registered Nurse', null, null, 'Skilled Nursing Facility'][p_partkey % 5 + 1] as name from part)""")
def specialties(t: Tables) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, ("207Q00000X", "163W00000X", "999X00000X", "", "314000000X"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return t.read("part").select(F.col("p_partkey").cast("bigint").alias("id"), lookups.specialty(code).alias("specialty"), lookups.lead_specialty(code).alias("lead_specialty"))


@query("", "id malformed", "select p_partkey::bigint as id, not regexp_full_match(case p_partkey % 3 when 0 then lpad(p_partkey::varchar, 5, '0') when 1 then 'A' || right(lpad(p_partkey::varchar, 4, '0'), 4) else p_partkey || 'X' end, '[0-9]{5}|[A-Za-z][0-9]{4}') as malformed from part")
def billing_code_format(t: Tables) -> DataFrame:
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    code = F.when(k % 3 == 0, F.lpad(text, 5, "0")).when(k % 3 == 1, F.concat(F.lit("A"), F.right(F.lpad(text, 4, "0"), F.lit(4)))).otherwise(F.concat(text, F.lit("X")))
    return t.read("part").select(k.cast("bigint").alias("id"), ids.malformed_code(code).alias("malformed"))


@query("", "id name_match", """select id, case when a = '' or b = '' then 'unknown' when a = b then 'exact' when len(list_intersect(string_split(a, ' '), string_split(b, ' '))) > 0 then 'partial' else 'mismatch' end as name_match
    from (select p_partkey::bigint as id, p_name as a, case p_partkey % 4 when 0 then '' when 1 then p_name when 2 then 'x ' || string_split(p_name, ' ')[1] else 'nothing alike' end as b from part)""")
def name_match(t: Tables) -> DataFrame:
    k, a = F.col("p_partkey"), F.col("p_name")
    b = F.when(k % 4 == 0, "").when(k % 4 == 1, a).when(k % 4 == 2, F.concat(F.lit("x "), F.split(a, " ")[0])).otherwise("nothing alike")
    return t.read("part").select(k.cast("bigint").alias("id"), names.name_match(a, b).alias("name_match"))


# coverage of claims without a provider

_LOST = f"lost as (select raw, ok, hcpcs_code, total_paid from (select *, {_NPI_OK} as ok from (select (c_custkey + 1000000000)::varchar as raw, c_custkey as k, hcpcs_code, total_paid from claims)) where not (ok and k % 20 <> 0))"


def _unmatched(t: Tables) -> DataFrame:
    return attribution.attribute(t.raw_claims(), t.registry())


@query("claims", "bucket distinct_ids:i n_rows:i paid:d paid_share:d", f"with {_LOST} select case when ok then 'valid_not_registered' else 'failed_luhn' end as bucket, count(distinct raw) as distinct_ids, count(*) as n_rows, sum(total_paid) as paid, sum(total_paid)::double / (select sum(total_paid)::double from lost) as paid_share from lost group by 1")
def coverage_buckets(t: Tables) -> DataFrame:
    return uncovered.bucket_shares(uncovered.unmatched_ids(_unmatched(t)))


@query("claims", "hcpcs_code n_rows:i paid:d paid_share:d", f"with {_LOST} select hcpcs_code, count(*) as n_rows, sum(total_paid) as paid, sum(total_paid)::double / (select sum(total_paid)::double from lost) as paid_share from lost group by 1 order by paid desc, hcpcs_code limit 25")
def coverage_codes(t: Tables) -> DataFrame:
    return uncovered.code_shares(_unmatched(t))


@query("claims", "ambiguous_share:d segregate", f"with {_LOST} select s as ambiguous_share, s < 0.01 as segregate from (select coalesce(sum(total_paid::double) filter (where ok), 0) / sum(total_paid)::double as s from lost)")
def coverage_ambiguity(t: Tables) -> DataFrame:
    return uncovered.ambiguity(uncovered.bucket_shares(uncovered.unmatched_ids(_unmatched(t))))


@query("claims", "n_ids:i n_rows:i paid:d paid_share:d", f"with {_LOST} select count(distinct raw) filter (where not ok) as n_ids, count(*) filter (where not ok) as n_rows, sum(total_paid) filter (where not ok) as paid, (sum(total_paid) filter (where not ok))::double / sum(total_paid)::double as paid_share from lost")
def quarantine_accounting(t: Tables) -> DataFrame:
    bad = attribution.quarantine(t.raw_claims(), "billing_npi_raw", "spending_billing")
    return uncovered.quarantine_accounting(uncovered.unmatched_ids(_unmatched(t)), bad)


@query("names", "id occurrence:i first_name", f"select id, row_number() over w as occurrence, first(name) over w as first_name from (select *, {_ALNUM} as n from names) window w as (partition by n, states order by amount desc, id)")
def dedupe_with_audit(t: Tables) -> DataFrame:
    ready = t.names().withColumn("n", names.spaced_alnum(F.col("name"))).withColumn("o", -F.col("amount"))
    return screens.dedupe_with_audit(ready, ["n", "states"], ["o", "id"], "name").select("id", "occurrence", "first_name")


# provider years


@query("monthly", "npi year:i avg_claims_per_beneficiary:d avg_paid_per_claim:d hcpcs_concentration:d n_hcpcs:i total_paid:d", """
    select npi, year, sum(c) / nullif(sum(b), 0) as avg_claims_per_beneficiary, sum(p)::double / nullif(sum(c), 0) as avg_paid_per_claim, sum(c::double * c) / (sum(c)::double * sum(c)::double) as hcpcs_concentration, count(*) as n_hcpcs, sum(p) as total_paid
    from (select npi, year, hcpcs_code, sum(claims) as c, sum(bene) as b, sum(paid) as p from monthly group by all) group by npi, year""")  # fmt: skip
def provider_year_static(t: Tables) -> DataFrame:
    return yearly.static(yearly.cells(t.monthly()))


_PEER_RATIO = """select npi, year, case when p is not null then greatest(least(p, hp), lp) end as paid_vs_peer_ratio, case when q is not null then greatest(least(q, hq), lq) end as claims_vs_peer_ratio from (
    select *, quantile_cont(p, 0.01) over () as lp, quantile_cont(p, 0.99) over () as hp, quantile_cont(q, 0.01) over () as lq, quantile_cont(q, 0.99) over () as hq from (
      select npi, year, exp(sum(claims * lpaid) / nullif(sum(claims) filter (where lpaid is not null), 0)) as p, exp(sum(claims * lclaims) / nullif(sum(claims) filter (where lclaims is not null), 0)) as q from (
        select npi, year, claims, case when n >= 20 and mp > 0 and pr > 0 then ln(pr / mp) end as lpaid, case when n >= 20 and mc > 0 and cr > 0 then ln(cr / mc) end as lclaims from (
          select *, count(*) over g as n, median(pr) over g as mp, median(cr) over g as mc from (select *, paid::double / nullif(claims, 0) as pr, claims / nullif(bene, 0) as cr from coarse) window g as (partition by tax, year, code)))
      group by npi, year))"""


@query("coarse", "npi year:i paid_vs_peer_ratio:d claims_vs_peer_ratio:d", _PEER_RATIO)
def peer_rate_ratio(t: Tables) -> DataFrame:
    return yearly.peer_ratios(t.coarse_monthly(), t.taxonomy())


@query("coarse", "npi year:i n_distinct_hcpcs_vs_peer:d", "select npi, year, case when np >= 20 and med > 0 then n / med end as n_distinct_hcpcs_vs_peer from (select *, count(*) over (partition by tax, year) as np, median(n) over (partition by tax, year) as med from (select npi, year, tax, count(*) as n from coarse group by all))")
def code_count_ratio(t: Tables) -> DataFrame:
    return yearly.code_count_ratio(t.coarse_monthly(), t.taxonomy())


@query("coarse", "npi year:i new_hcpcs_fraction:d", "select npi, year, count(*) filter (where y0 = year) / count(*)::double as new_hcpcs_fraction from (select *, min(year) over (partition by npi, code) as y0 from coarse) group by npi, year")
def new_code_fraction(t: Tables) -> DataFrame:
    return yearly.new_code_fraction(t.coarse_monthly())


_VECTOR = ", ".join(f"greatest(sum(case when month_num = {i} then paid else 0 end), 0)::double as p{i}" for i in range(1, 13)) + ", " + ", ".join(f"greatest(sum(case when month_num = {i} then claims else 0 end), 0)::double as c{i}" for i in range(1, 13))
_P = "[" + ", ".join(f"p{i}" for i in range(1, 13)) + "]"


@query("monthly", "npi year:i " + " ".join(f"p{i}:d c{i}:d" for i in range(1, 13)) + " active_months:i first_active_month:i", f"select *, len(list_filter({_P}, lambda x: x > 0)) as active_months, nullif(list_position(list_transform({_P}, lambda x: x > 0), true), 0) as first_active_month from (select npi, year, {_VECTOR} from monthly group by npi, year)")
def monthly_vectors(t: Tables) -> DataFrame:
    return yearly.monthly_vectors(t.monthly())


@query("monthly", "npi year:i log_step_volatility:d monthly_variation:d peak_to_median_paid:d end_drop:d", f"""
    select npi, year, case when n >= 6 then list_aggregate(list_transform(range(2, 13), lambda i: ln(p[i] + 1) - ln(p[i - 1] + 1)), 'stddev_samp') end as log_step_volatility, case when n >= 6 then list_aggregate(p, 'stddev_samp') / (list_avg(p) + 1) end as monthly_variation,
      case when n >= 3 then list_max(p) / (list_median(list_filter(p, lambda x: x > 0)) + 1) end as peak_to_median_paid, case when n >= 6 then 1 - list_avg(p[10:12]) / (list_max(p) + 1) end as end_drop
    from (select npi, year, {_P} as p, len(list_filter({_P}, lambda x: x > 0)) as n from (select npi, year, {_VECTOR} from monthly group by npi, year))""")  # fmt: skip
def vector_features(t: Tables) -> DataFrame:
    return yearly.vector_features(yearly.monthly_vectors(t.monthly()))


@query("monthly", "npi onset_slope:d", """select npi, case when count(*) >= 4 then regr_slope(ln(p + 1), m) end as onset_slope from (
    select *, row_number() over (partition by npi order by m) as rn, min(m) over (partition by npi) as m1 from (select npi, (year * 12 + month_num)::double as m, greatest(sum(paid), 0)::double as p from monthly group by npi, year, month_num) where p > 0)
    where rn <= 6 and m1 > (select min(year * 12 + month_num) from monthly) and floor((m - 1) / 12) = floor((m1 - 1) / 12) group by npi""")
def onset_slope(t: Tables) -> DataFrame:
    return yearly.onset_slope(t.monthly())


@query("coarse", "npi year:i excess_yoy_growth:d", """select npi, year, greatest(least(e, quantile_cont(e, 0.99) over ()), quantile_cont(e, 0.01) over ()) as excess_yoy_growth from (select npi, year, case when count(*) over g >= 20 then x - median(x) over g end as e from (
    select a.npi, a.year, a.tax, ln(a.p + 1) - ln(b.p + 1) as x from (select npi, year, tax, sum(paid)::double as p from coarse group by all) a join (select npi, year, sum(paid)::double as p from coarse group by all) b on a.npi = b.npi and b.year = a.year - 1
    where a.p <> 0 and b.p <> 0 and a.p > -1 and b.p > -1) window g as (partition by tax, year))""")
def growth_vs_peer(t: Tables) -> DataFrame:
    return yearly.log_growth_vs_peer(yearly.static(t.coarse_monthly()), t.taxonomy())


def _year_months(t: Tables) -> DataFrame:
    return history.monthly(history.qualifying(t.claims().withColumnRenamed("billing_npi", "npi"), 500_000))


_QUAL = "q as (select * from claims where billing_npi in (select billing_npi from claims group by 1 having sum(total_paid) > 500000))"


@query("claims", "npi service_year claims:i beneficiaries:i paid:d", f"with {_QUAL} select billing_npi as npi, left(service_month, 4) as service_year, sum(total_claim_lines) as claims, sum(total_patients) as beneficiaries, sum(total_paid) as paid from q group by 1, 2")
def provider_annual(t: Tables) -> DataFrame:
    return history.annual(_year_months(t))


_FACTS = f"""with {_QUAL}, p as (select billing_npi as npi, count(distinct hcpcs_code) as n_distinct_hcpcs, sum(total_claim_lines) as total_claims, sum(total_patients) as total_beneficiaries, sum(total_paid) as total_paid, count(distinct service_month) as n_active_months,
      (min(service_month) || '-01')::date as first_billing_month, (max(service_month) || '-01')::date as last_billing_month from q group by 1),
    f as (select npi, min(excl_date) as d from excl group by 1)
    select npi, n_distinct_hcpcs, total_claims, total_beneficiaries, total_paid, n_active_months, first_billing_month, last_billing_month, first_billing_month = (select min(first_billing_month) from p) as left_censored, f.d is not null as in_leie,
      case when npi::bigint % 20 <> 0 then greatest(0, first_billing_month - (date '1991-01-01' + (npi::bigint % 2000)::int)) end as npi_age_days_at_first_claim,
      coalesce((last_billing_month > case when npi::bigint % 20 <> 0 and npi::bigint % 7 = 0 then date '1998-01-01' end)::int, 0) as billing_on_deactivated_npi, strptime(f.d, '%Y%m%d')::date as excl_date from p left join f using (npi)"""


def _facts(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    registry = t.read("customer").where(k % 20 != 0).select(k.cast("string").alias("npi"), F.date_add(F.lit("1991-01-01").cast("date"), (k % 2000).cast("int")).alias("enumerated"), F.when(k % 7 == 0, F.lit("1998-01-01").cast("date")).alias("deactivated"))
    listed = t.exclusions().select("npi", F.to_date("excl_date", "yyyyMMdd").alias("excl_date"), F.when(F.col("npi").cast("bigint") % 150 == 0, F.date_add(F.to_date("excl_date", "yyyyMMdd"), 365)).alias("reinstate_date"), "excl_type")
    return history.enriched(history.summary(_year_months(t)), registry, listed)


@query("claims,excl", "npi n_distinct_hcpcs:i total_claims:i total_beneficiaries:i total_paid:d n_active_months:i first_billing_month last_billing_month left_censored in_leie npi_age_days_at_first_claim:i billing_on_deactivated_npi:i excl_date", _FACTS)
def provider_facts(t: Tables) -> DataFrame:
    return _facts(t).drop("enumerated", "deactivated", "reinstate_date", "excl_type")


@query("claims,excl", "npi year:i is_excluded:i", f"""select npi, y as year, coalesce((excl_date <= make_date(y, 12, 31) and (npi::bigint % 150 <> 0 or excl_date + 365 > make_date(y, 12, 31)))::int, 0) as is_excluded
    from ({_FACTS}), unnest([1996, 1997, 1998, 1999, 2000]) u(y)""")
def excluded_at_year_end(t: Tables) -> DataFrame:
    years = F.explode(F.array(*map(F.lit, (1996, 1997, 1998, 1999, 2000)))).alias("year")
    return _facts(t).select("npi", "excl_date", "reinstate_date", years).select("npi", "year", history.excluded_at_year_end(F.col("year")).alias("is_excluded"))


# evaluation


def _bin_sql(order: str, bins: int, by: str = "") -> str:
    part = f"partition by {by} " if by else ""
    return f"greatest(1, ceil((row_number() over ({part}order by {order}) - 1) * {bins} / nullif(count(*) over ({part.strip()}) - 1, 0)::double))::bigint"


@query("scored", "npi score_decile:i size_band:i", f"select npi, {_bin_sql('score, npi', 10)} as score_decile, {_bin_sql('net_paid, npi', 4)} as size_band from scored")
def score_deciles(t: Tables) -> DataFrame:
    return evaluation.binned(evaluation.binned(t.scored(), "score", "npi", "score_decile"), "net_paid", "npi", "size_band", 4).select("npi", "score_decile", "size_band")


@query("scored", "score_decile:i n:i hits:i rate:d lift:d", f"select score_decile, count(*) as n, sum(label) as hits, avg(label) as rate, avg(label) / (select avg(label) from scored) as lift from (select label, {_bin_sql('score, npi', 10)} as score_decile from scored) group by 1")
def decile_lift(t: Tables) -> DataFrame:
    return evaluation.lift_table(evaluation.binned(t.scored(), "score", "npi", "score_decile"), "score_decile", "label")


@query("scored", "band:i base:d top_lift:d", f"select band, avg(label) as base, avg(label) filter (where d = 10) / nullif(avg(label), 0) as top_lift from (select *, {_bin_sql('score, npi', 10, 'band')} as d from (select *, {_bin_sql('net_paid, npi', 4)} as band from scored)) group by 1")
def within_size_lift(t: Tables) -> DataFrame:
    return evaluation.within_size_lift(t.scored(), "score", "net_paid", "npi", "label")


@query("scored", "k:i hits:i precision:d recall:d lift:d", """select k, h as hits, h / least(k, n)::double as precision, h / p::double as recall, h / least(k, n)::double / (p / n::double) as lift from (
    select k, sum(label) filter (where rn <= k) as h, sum(label) as p, count(*) as n from (select label, row_number() over (order by score desc, npi) as rn from scored), unnest([50, 100, 250, 500, 1000]) u(k) group by k)""")
def precision_at_k(t: Tables) -> DataFrame:
    return evaluation.at_k(t.scored(), "score", "label", "npi", (50, 100, 250, 500, 1000))


@query("scored", "average_precision:d roc_auc:d n_positive:i", """select sum(y * cy / cn::double) / sum(y) as average_precision, sum((n - y) * (cy - y / 2.0::double)) / (sum(y) * sum(n - y))::double as roc_auc, sum(y) as n_positive
    from (select *, sum(y) over (order by score desc) as cy, sum(n) over (order by score desc) as cn from (select score, count(*) as n, sum(label) as y from scored group by score))""")
def average_precision(t: Tables) -> DataFrame:
    return evaluation.ranking_metrics(t.scored(), "score", "label")


@query("scored", "company_id npi_count:i n_reliable:i max_score:d mean_score:d company_net_paid:d weighted_score:d", """select company_id, count(*) as npi_count, count(*) filter (where ok) as n_reliable, max(score) filter (where ok) as max_score, avg(score) filter (where ok) as mean_score, sum(net_paid) as company_net_paid,
    case when sum(w) filter (where ok) > 0 then sum(score * w) filter (where ok) / sum(w) filter (where ok) else avg(score) filter (where ok) end as weighted_score from (select *, not not_scored as ok, greatest(net_paid, 0)::double as w from scored) group by 1""")
def weighted_company_score(t: Tables) -> DataFrame:
    return evaluation.company_scores(evaluation.segments(t.scored()))


@query("scored", "npi segment score_reliable rank_reliable:i", "select npi, case when on_leie then 'leie_positive' when in_training then 'clean_negative_trained' when not_scored then 'ambiguous_not_scored' else 'ambiguous_high_anomaly' end as segment, not not_scored as score_reliable, case when not not_scored then row_number() over (partition by not_scored order by score desc, npi) end as rank_reliable from scored")
def score_segments(t: Tables) -> DataFrame:
    return evaluation.rank_reliable(evaluation.segments(t.scored())).select("npi", "segment", "score_reliable", "rank_reliable")


@query("scored", "threshold:d n:i precision:d recall:d", """select score as threshold, cn as n, cy / cn::double as precision, cy / (select sum(label) from scored)::double as recall
    from (select score, sum(y) over (order by score desc) as cy, sum(n) over (order by score desc) as cn from (select score, count(*) as n, sum(label) as y from scored group by score))""")
def precision_recall_curve(t: Tables) -> DataFrame:
    return evaluation.precision_recall_curve(t.scored(), "score", "label")


@query("scored", "timing hits:i base_rate:d top_lift:d", f"""select kind as timing, sum(h) as hits, sum(h) / count(*)::double as base_rate, (sum(h) filter (where d = 10) / count(*) filter (where d = 10)::double) / nullif(sum(h) / count(*)::double, 0) as top_lift
    from (select kind, d, (label = 1 and kind = case when y < 2018 then 'before_2018' when y > 2024 then 'after_2024' else 'during_2018_2024' end)::int as h
      from (select label, 2015 + npi::bigint % 13 as y, {_bin_sql('score, npi', 10)} as d from scored), unnest(['before_2018', 'during_2018_2024', 'after_2024']) u(kind)) group by kind""")
def timing_lift(t: Tables) -> DataFrame:
    dated = t.scored().withColumn("ymd", F.concat((F.lit(2015) + F.col("npi").cast("bigint") % 13).cast("string"), F.lit("0101")))
    return evaluation.timing_lift(evaluation.binned(dated, "score", "npi", "score_decile"), "score_decile", "label", "ymd", *DEFAULT.billing_years)


@query("scored", "billing_decile:i n:i hits:i rate:d lift:d", f"select billing_decile, count(*) as n, sum(label) as hits, avg(label) as rate, avg(label) / (select avg(label) from scored) as lift from (select label, {_bin_sql('net_paid, npi', 10)} as billing_decile from scored) group by 1")
def billing_lift(t: Tables) -> DataFrame:
    return evaluation.lift_table(evaluation.binned(t.scored(), "net_paid", "npi", "billing_decile"), "billing_decile", "label")


_MODEL_LEADS = """select *, row_number() over (order by max_score desc, company_net_paid desc, company_id) as rank from (
    select s.company_id, max(s.score) filter (where not not_scored) as max_score, sum(s.net_paid) as company_net_paid, string_agg(s.npi, '|' order by s.score desc, s.npi) filter (where not not_scored) as npi_list,
      coalesce(case when min(l.k) % 2 = 0 then min(l.org_legal_name) end, arg_max(l.org_legal_name, s.score - s.npi::bigint * 1e-12) filter (where not not_scored)) as company_name,
      arg_max(l.primary_taxonomy, s.net_paid) filter (where not not_scored) as specialty_code from scored s join linked l on l.npi = s.npi group by s.company_id)
    where company_net_paid >= 1000000 and max_score >= 0.2 order by rank limit 100"""


@query("scored,linked", "rank:i company_id company_name max_score:d company_net_paid:d npi_list specialty_code", _MODEL_LEADS)
def model_leads(t: Tables) -> DataFrame:
    from dataclasses import replace

    members = evaluation.segments(t.scored()).join(t.linked().select("npi", "org_legal_name", "primary_taxonomy"), "npi")
    named = members.groupBy("company_id").agg(F.min(F.col("npi").cast("bigint")).alias("k"), F.min("org_legal_name").alias("n")).select("company_id", F.when(F.col("k") % 2 == 0, F.col("n")).otherwise(" ").alias("company_name"))
    best = leads.model_leads(evaluation.company_scores(members).join(named, "company_id"), leads.best_members(members.where("score_reliable")), 100, 0.2, replace(DEFAULT, min_net_paid=1e6))
    return best.select("rank", "company_id", "company_name", "max_score", "company_net_paid", "npi_list", "specialty_code")


@query("names", "id removed_category matched", r"""select id, lead_class as removed_category, case lead_class when 'fqhc_taxonomy' then '261QF0400X' when 'hospital_taxonomy' then '282N00000X' when 'tribal' then case when n like '%TRIBAL%' then 'TRIBAL' else 'ALASKA NATIVE' end when 'public_academic' then 'UNIVERSITY'
      when 'national_nonprofit' then 'RED CROSS' when 'hospital_name' then 'HOSPITAL' when 'government' then case when n like '%COUNTY OF%' then 'COUNTY OF' when n like '%HOSPITAL SERVICE DISTRICT%' then 'HOSPITAL SERVICE DISTRICT' else 'ENDS WITH COUNTY' end end as matched
    from (select id, n, """ + _CLASSES + f""" from (select *, {_ALNUM} as n from names))""")
def screened_leads(t: Tables) -> DataFrame:
    return leads.screened(t.names(), "name", "specialty").select("id", "removed_category", "matched")


# models and simulations, without SQL


@query()
def null_tests(t: Tables) -> DataFrame:
    return evaluation.null_tests(evaluation.binned(t.scored(), "score", "npi", "score_decile"), "score", "label")


@query()
def isolation_forest(t: Tables) -> DataFrame:
    scored = ml.isolation_forest(t.provider_scoring(), "npi", list(peers.FEATURES))
    return ml.contaminated(scored).select("npi", "iforest_score", "is_anomaly", *[F.col("importance")[i].alias(f"imp_{f}") for i, f in enumerate(peers.FEATURES)])


@query()
def boosted_tree_scores(t: Tables) -> DataFrame:
    numeric = list(peers.FEATURES)
    labelled = t.stored_scoring().withColumn("label", (F.col("npi").cast("bigint") % 50 == 0).cast("int"))
    split = ml.stratified_split(labelled, "npi", "label").persist()  # fitted and scored
    model = ml.fit_boosted(split, numeric, ["primary_taxonomy", "entity_type"])
    return ml.score_boosted(model, split, numeric, "npi")


@query()
def feature_importance(t: Tables) -> DataFrame:
    numeric = list(peers.FEATURES)
    labelled = t.stored_scoring().withColumn("label", (F.col("npi").cast("bigint") % 50 == 0).cast("int"))
    return ml.importances(ml.fit_boosted(ml.stratified_split(labelled, "npi", "label"), numeric, ["primary_taxonomy", "entity_type"]), [*numeric, "primary_taxonomy", "entity_type"])


@query("", "window_start event_type n:i total:d", "select date_trunc('hour', ts) as window_start, event_type, count(*) as n, sum(value) as total from events group by 1, 2")
def windowed_events(t: Tables) -> DataFrame:
    from claimscope.streaming.monthly import windowed_totals

    return windowed_totals(t.read("events"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)



