"""The adapter's views and the operators' stages in DuckDB SQL: common table expressions by name."""

from __future__ import annotations

VIEWS: dict[str, tuple[str, str]] = {
    "claims": ("", """select c_custkey::varchar as billing_npi, l_partkey::varchar as hcpcs_code, strftime(l_shipdate, '%Y-%m') as service_month,
        (case when l_returnflag = 'R' and l_linenumber = 1 then -l_extendedprice else l_extendedprice end)::decimal(18, 2) as total_paid,
        l_quantity::bigint as total_claim_lines, l_linenumber::bigint as total_patients, c_mktsegment as taxonomy_code, n_name as provider_state,
        case when c_acctbal >= 0 then '2' else '1' end as entity_type, n_name || ' ' || c_mktsegment || ' LLC' as org_legal_name, c_custkey
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""),
    "prov": ("", """select c_custkey::varchar as npi, c_custkey as k, case when c_custkey % 3 = 0 then (c_custkey % 97)::varchar end as pac_id,
        case when c_custkey % 3 = 1 then 'own' || (c_custkey % 400) end as owner_key, n_name || ' ' || c_mktsegment || ' LLC' as org_legal_name, n_name as practice_state,
        c_mktsegment as primary_taxonomy, case when c_acctbal >= 0 then '2' else '1' end as entity_type from customer join nation on c_nationkey = n_nationkey"""),
    "fact": ("claims", "select *, c_custkey % 20 <> 0 as provider_matched from claims"),
    "codes": ("claims", "select billing_npi as k, hcpcs_code, sum(greatest(total_paid, 0)) as gross, sum(total_paid) as net, sum(total_claim_lines) as lines, sum(total_patients) as pats from claims group by all"),
    "months": ("claims", "select billing_npi as k, service_month, sum(total_paid) as net, sum(greatest(total_paid, 0)) as gross, sum(total_claim_lines) as lines, (service_month || '-01')::date as d from claims group by billing_npi, service_month"),
    "core": ("claims", """select billing_npi as npi, min(taxonomy_code) as primary_taxonomy, min(entity_type) as entity_type, min(provider_state) as practice_state,
        sum(greatest(total_paid, 0))::double as gross_paid, sum(total_paid)::double as net_paid, sum(least(total_paid, 0))::double as reversal_amount,
        sum(total_claim_lines)::bigint as total_claim_lines, sum(total_patients)::bigint as service_volume, count(distinct hcpcs_code) as n_distinct_hcpcs,
        count(distinct service_month) as n_active_months, min(service_month) as first_month, max(service_month) as last_month from claims group by billing_npi"""),
    "map0": ("prov", r"""select *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(org_legal_name), '[^A-Z0-9 ]', ' ', 'g'), '^THE ', ''),
        '\b(INC|INCORPORATED|LLC|CORP|CORPORATION|CO|COMPANY|PC|PA|LTD|LP|LLP)\b', ' ', 'g'), '\s+', ' ', 'g')) as nk, case when pac_id is null then owner_key end as own from prov"""),
    "map": ("map0", """select *, case when pac_id is not null then 'pac:' || pac_id when n_own >= 2 then 'owner:' || own when nk <> '' then 'name:' || nk else 'npi:' || npi end as company_id,
        case when pac_id is not null then 'pac_id' when n_own >= 2 then 'shared_owner' when nk <> '' then 'name' else 'single' end as basis
        from (select *, case when own is not null then count(*) over (partition by own) end as n_own from map0)"""),
    "cclaims": ("claims,map", "select c.*, m.company_id from claims c join map m on c.billing_npi = m.npi"),
    "cdims": ("cclaims", """select company_id, taxonomy_code as primary_taxonomy, entity_type from (select company_id, taxonomy_code, entity_type,
        row_number() over (partition by company_id order by sum(greatest(total_paid, 0)) desc, taxonomy_code desc, entity_type desc) as rn from cclaims group by company_id, taxonomy_code, entity_type) where rn = 1"""),
    "pbase": ("claims", "select billing_npi as k, hcpcs_code, service_month, total_paid, total_claim_lines, total_patients, taxonomy_code as tax, entity_type as ent from claims"),
    "cbase": ("cclaims,cdims", "select company_id as k, hcpcs_code, service_month, total_paid, total_claim_lines, total_patients, primary_taxonomy as tax, d.entity_type as ent from cclaims join cdims d using (company_id)"),
    "excl": ("", """select k::varchar as npi, strftime(d, '%Y-%m') as excl_month, case when k % 150 = 0 then strftime(d + 365, '%Y-%m') end as rein_month, case when k % 100 = 0 then strftime(d + 200, '%Y-%m') end as waiver_month,
        strftime(d, '%Y%m%d') as excl_date, upper(c_name) as name_key from (
          select c_custkey as k, c_name, date '1997-01-01' + (c_custkey % 1200)::int as d from customer where c_custkey % 50 = 0
          union all select c_custkey, c_name, date '1997-01-01' + (c_custkey % 1200 + 700)::int from customer where c_custkey % 200 = 0)"""),
    "owners": ("", """select (s_suppkey * 5 % 300)::varchar as facility_npi, case when s_suppkey % 3 = 0 then (s_suppkey % 30 * 50 + s_suppkey % 2)::varchar end as owner_npi,
        ['MANAGING CONTROL', 'DIRECTOR', '5% OWNERSHIP', 'CONTRACTOR'][s_nationkey % 4 + 1] as owner_role, 'CUSTOMER#' || lpad((s_suppkey % 40 * 25)::varchar, 9, '0') as match_key from supplier"""),
    "status": ("months,excl", """select k as npi, service_month, net as paid, lines, ['before', 'reinstated', 'waivered', 'same_month', 'clean_after'][max(lv)::int] as status from (
        select m.k, m.service_month, m.net, m.lines, case when service_month < excl_month then 1 when service_month = excl_month then 4 when service_month >= rein_month then 2 when service_month >= waiver_month then 3 else 5 end as lv
        from months m join excl e on m.k = e.npi) group by all"""),
    "linked": ("map,core", """select m.npi, m.k, company_id, basis, m.org_legal_name, m.practice_state, m.primary_taxonomy, m.entity_type, c.net_paid, c.gross_paid, k % 50 = 0 as on_leie, k % 100 = 0 as baf, k % 101 / 101.0::double as score,
        (k % 4)::int as n_sig, k % 41 = 0 as own_flag, k % 13 = 0 as npi_lead, case when k % 100 = 0 then 1 when k % 50 = 0 then 3 when k % 13 = 0 then 4 when k % 41 = 0 then 5 else 6 end as rnk from map m join core c on c.npi = m.npi"""),
    "comp": ("linked", """select company_id, sum(net_paid) as company_net_paid, sum(gross_paid) as company_gross_paid, count(*) as npi_count, max(net_paid) as max_constituent_net_paid,
        string_agg(distinct practice_state, '; ' order by practice_state) as states, count(distinct practice_state) as n_states, left(string_agg(distinct primary_taxonomy, '; ' order by primary_taxonomy), 200) as primary_taxonomies,
        string_agg(distinct entity_type, '; ' order by entity_type) as entity_types, arg_min(org_legal_name, npi) as company_name, min(basis) as raw, bool_or(on_leie) as any_provider_on_leie, bool_or(baf) as any_billed_after_exclusion,
        max(score) as max_anomaly_score, max(n_sig) as max_n_concept_signals, bool_or(own_flag) as any_probable_excluded_owner, min(rnk) as best_priority_rank, bool_or(npi_lead) as any_npi_lead,
        coalesce(sum(net_paid) filter (where baf), 0) as paid_after from linked group by company_id"""),
    "comp2": ("comp", """select *, case when npi_count >= 2 then raw else 'single' end as merge_basis, case when npi_count < 2 then 'single' when raw in ('pac_id', 'shared_owner') then 'high' when n_states <= 1 then 'medium' else 'low' end as merge_confidence from comp"""),
    "track": ("comp2", """select *, max_n_concept_signals >= 3 as lead, max_anomaly_score >= 0.7 or max_n_concept_signals >= 3 as member,
        case when any_billed_after_exclusion then '1_billed_after_exclusion' when any_provider_on_leie then '2_on_leie' when max_anomaly_score >= 0.7 or max_n_concept_signals >= 3 then '3_company_anomaly' when any_probable_excluded_owner then '4_probable_owner' else '5_none' end as priority_tier,
        max_n_concept_signals >= 3 and not any_npi_lead and npi_count >= 2 as fragmentation_signal from comp2"""),
    "names": ("", """select p_partkey::bigint as id, case when p_partkey % 5 = 0 then w || ' ' || p_name else p_name || '  ' || p_type || '  ' || w end as name,
        case when p_partkey % 31 = 0 then 'Clinic 261QF0400X' when p_partkey % 29 = 0 then 'General 282N00000X' else 'Home' end as specialty, ['TX', 'CA; NY', 'tx/ca', ''][p_partkey % 4 + 1] as states, p_retailprice as amount
        from (select *, ['County of', 'Tribal Health', 'State University,', 'Red Cross of', 'Hospital', 'the', 'L L C', 'Inc.', 'Hospital Service District', 'Good Samaritan Society', 'Alaska Native', 'Kern County'][p_partkey % 12 + 1] as w from part)"""),
    "monthly": ("claims", "select billing_npi as npi, hcpcs_code, left(service_month, 4)::int as year, substring(service_month, 6, 2)::int as month_num, sum(total_paid) as paid, sum(total_claim_lines) as claims, sum(total_patients) as bene from claims group by all"),
    "coarse": ("claims", "select billing_npi as npi, (hcpcs_code::bigint % 7)::varchar as code, left(service_month, 4)::int as year, sum(total_paid) as paid, sum(total_claim_lines) as claims, sum(total_patients) as bene, min(taxonomy_code) as tax from claims group by all"),
    "scored": ("linked", "select npi, company_id, net_paid, on_leie, k * 7919 % 1009 / 1009.0::double as score, (k % 50 = 0)::int as label, k % 5 = 0 as in_training, k % 11 = 0 as not_scored from linked"),
}


def rate_view(base: str) -> str:
    """Rate features, rare share and peer dimensions of one grain, rounded to 6 places."""
    return f"""
      with h as (select k, hcpcs_code, sum(greatest(total_paid, 0))::double as g, sum(total_paid)::double as n, sum(total_claim_lines) as l, sum(total_patients) as p, min(tax) as tax, min(ent) as ent from {base} group by k, hcpcs_code),
      cell as (select tax, ent, count(distinct k) as n from {base} group by all), cellcode as (select tax, ent, hcpcs_code, count(distinct k) as nc from {base} group by all),
      rare as (select cellcode.tax, cellcode.ent, hcpcs_code from cellcode join cell using (tax, ent) where nc / n < 0.01),
      a as (select h.k, min(h.tax) as tax, min(h.ent) as ent, sum(g) as gross_paid, sum(n) as net_paid, sum(l) as total_claim_lines, sum(p) as service_volume, count(*) as n_distinct_hcpcs, max(g) as top, sum(g * g) as sq,
          sum(case when rare.hcpcs_code is not null then g else 0 end) as rg from h left join rare on h.tax = rare.tax and h.ent = rare.ent and h.hcpcs_code = rare.hcpcs_code group by h.k),
      m as (select k, (service_month || '-01')::date as d, sum(total_paid)::double as n from {base} group by all), b as (select max(d) as dmax from m),
      t as (select k, max(n) as mx, case when avg(n) <> 0 then stddev_samp(n) / abs(avg(n)) end as vol, sum(n) filter (where d > dmax - interval 18 month) / nullif(sum(n) filter (where d <= dmax - interval 18 month and d > dmax - interval 30 month), 0) - 1 as yoy
        from m, b where d <= dmax - interval 6 month group by k)
      select k, tax, ent, round(gross_paid, 6) as gross_paid, round(net_paid, 6) as net_paid, total_claim_lines, service_volume, n_distinct_hcpcs, round(net_paid / nullif(total_claim_lines, 0), 6) as paid_per_claim_line, round(net_paid / nullif(service_volume, 0), 6) as paid_per_patient_instance,
        round(total_claim_lines / nullif(service_volume, 0), 6) as lines_per_patient_instance, round(top / nullif(gross_paid, 0), 6) as top_hcpcs_paid_share, round(case when gross_paid > 0 then sq / (gross_paid * gross_paid) end, 6) as hcpcs_hhi,
        round(rg / nullif(gross_paid, 0), 6) as rare_share, round(mx, 6) as max_single_month_net_paid, round(vol, 6) as month_to_month_volatility, round(yoy, 6) as yoy_growth_net_paid, round(case when mx > 0 then ln(1 + mx) end, 6) as log_max_single_month from a left join t using (k)"""


VIEWS["prates"] = ("pbase", rate_view("pbase"))
VIEWS["crates"] = ("cbase", rate_view("cbase"))


def with_views(views: str, body: str) -> str:
    """``body`` behind the views that it names, and those that they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in filter(None, VIEWS[name][0].split(",")):
            add(need)
        if name not in order:
            order.append(name)

    for v in filter(None, views.split(",")):
        add(v)
    return ("with " + ",\n".join(f"{v} as ({VIEWS[v][1]})" for v in order) + "\n" if order else "") + body


def pct(x: str, part: str) -> str:
    """Percentile rank with ties at their mean rank."""
    return f"case when {x} is not null then (rank() over (partition by {part} order by {x} nulls last) + (count({x}) over (partition by {part}, {x}) - 1) / 2.0::double) / count({x}) over (partition by {part}) end"
