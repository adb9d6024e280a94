"""All stages over small CSV files, with the edge rows of each input."""

import csv
import glob
import random

import pytest

from claimscope.config import Config
from claimscope.plans import stages


def npi(i):
    nine = f"1{i:08d}"
    total = 24 + sum((d if k % 2 else (2 * d - 9 if d > 4 else 2 * d)) for k, d in enumerate(map(int, nine)))
    return nine + str((10 - total % 10) % 10)


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    rng = random.Random(7)
    months = [f"{y}-{m:02d}" for y in (2018, 2019, 2020) for m in range(1, 13)]
    claims = []
    for i in range(70):
        for m in rng.sample(months, 20):
            for code in rng.sample(["99213", "T1019", "A0001", "B0002"], 2):
                claims.append([npi(i), npi(i), code, m, rng.randrange(1, 30), rng.randrange(10, 90), round(rng.uniform(-50, 5000), 2)])
    claims += [["", "", "99213", "2019-01", 1, 1, 100.5], ["1234567890", "", "99213", "2019-01", 1, 1, 7], ["A12345", "", "20", "2021-13", "abc", 0, 5], [npi(0), "", "99213", "2019-01", 1, 1, "7469333333258.64"], [npi(999), "", "99213", "2019-02", 2, 2, 30]]
    paths = {
        "spending": write(d / "spend.csv", ["BILLING_PROVIDER_NPI_NUM", "SERVICING_PROVIDER_NPI_NUM", "HCPCS_CODE", "CLAIM_FROM_MONTH", "TOTAL_PATIENTS", "TOTAL_CLAIM_LINES", "TOTAL_PAID"], claims),
        "registry": write(d / "npi.csv", ["NPI", "Entity Type Code", "Provider Organization Name (Legal Business Name)", "Provider Last Name (Legal Name)", "Provider First Name", "Healthcare Provider Taxonomy Code_1", "Provider Business Practice Location Address State Name", "NPI Deactivation Date", "NPI Reactivation Date"],
                          [[npi(i), 2, f"Org {i // 2} LLC", "", "", "207Q00000X", "TX", "01/15/2019" if i == 3 else "", ""] for i in range(70)] + [[npi(1), "", "", "DOE", "JANE", "", "", "", ""]]),
        "enrollment": write(d / "pecos.csv", ["NPI", "PECOS_ASCT_CNTL_ID", "ENRLMT_ID", "PROVIDER_TYPE_CD", "PROVIDER_TYPE_DESC", "STATE_CD"], [[npi(i), f"0{i // 2}", f"O{i}", "12", "X", "TX"] for i in range(40)] + [[npi(5), "0999", "I5", "", "", ""]]),
        "exclusions": write(d / "leie.csv", ["LASTNAME", "FIRSTNAME", "BUSNAME", "NPI", "EXCLTYPE", "EXCLDATE", "REINDATE", "WAIVERDATE", "WVRSTATE", "STATE"],
                            [["", "", "ORG 2 LLC", npi(4), "1128a1", "20190601", "00000000", "0", "", "TX"], ["", "", "ORG 3", npi(6), "1128b7", "20180101", "20190101", "", "", "TX"], ["", "", "ORG 4", npi(8), "1128a3", "20190601", "", "", "TX", "TX"], ["SMITH", "AL", "", "0000000000", "1128a1", "20200101", "0", "", "", "TX"]]),
    }
    header = ["ENROLLMENT ID", "ASSOCIATE ID", "ORGANIZATION NAME", "ASSOCIATE ID - OWNER", "TYPE - OWNER", "ROLE TEXT - OWNER", "FIRST NAME - OWNER", "LAST NAME - OWNER", "ORGANIZATION NAME - OWNER", "LLC - OWNER"]
    owners = [
        write(d / "HHA_All_Owners_2024.csv", header, [["O10", "03", "Fac", "01", "I", "5% OWNERSHIP", "AL", "SMITH", "", "N"], ["O11", "03", "Fac", "09", "O", "DIRECTOR", "", "", "Nobody LLC", "Y"]]),
        write(d / "HospiceOwners.csv", [*header, "REIT - OWNER"], [["O99", "0999", "Fac", "02", "O", "MANAGING CONTROL", "", "", "ORG 4 Inc", "N", "Y"]]),
    ]
    out = stages.Store(spark, str(tmp_path_factory.mktemp("store")))
    cfg = Config(min_net_paid=1.0)
    stages.integrate(out, paths["spending"], paths["registry"], paths["enrollment"], owners, paths["exclusions"])
    stages.audit(out, cfg)
    stages.build_features(out, cfg)
    stages.detect(out, cfg)
    stages.roll_up(out, cfg)
    stages.model(out, cfg, rounds=2)
    stages.backtest(out, cfg)
    stages.export(out, cfg)
    stages.model_exports(out, cfg, top_k=5, npi_min_net_paid=1.0, npi_min_score=0.0)
    stages.yearly_clean(out, paths["spending"], paths["registry"], paths["exclusions"], 1.0)
    stages.yearly_features(out, cfg)
    stages.yearly_score(out, trees=20, save_top=None)
    return out, len(claims)


def rows(out, name):
    return [r for f in glob.glob(f"{out.path}/{name}/part*") for r in csv.DictReader(open(f))]


def test_fact_is_conserved(store):
    out, n = store
    fact = out.read("spending_fact")
    assert fact.count() == n
    assert {r["bucket"]: r["n_rows"] for r in out.read("partition_summary").collect()} == {"corrupt": 1, "aggregate": 4, "base": n - 5}
    assert {r["raw_value"] for r in out.read("npi_quarantine").collect()} == {"1234567890", "A12345"}
    assert out.read("provider_dim").count() == 70 and out.read("provider_dim").where(f"npi = '{npi(1)}'").first()["org_legal_name"] == "Org 0 LLC"
    assert {r["active_at_claim"] for r in fact.where(f"billing_npi = '{npi(3)}' and service_month > '2019-02'").collect()} == {False}


def test_owner_flags(store):
    out, _ = store
    edges = {r["enrollment_id"]: r for r in out.read("owner_edges").collect()}
    assert edges["O10"]["facility_npi"] == npi(10) and edges["O10"]["facility_type"] == "hha" and edges["O99"]["facility_type"] == "hospice"
    assert edges["O99"]["facility_npi"] == npi(5)  # the only npi of that PAC id
    flags = {r["facility_npi"]: r for r in out.read("facility_flags").collect()}
    assert flags[npi(10)]["n_probable"] == 1 and flags[npi(10)]["weighted_probable"] == 1.0 and flags[npi(5)]["n_probable"] == 1


def test_leads(store):
    out, _ = store
    cases = {r["npi"]: r["disposition"] for r in out.read("layer1_cases").collect()}
    assert cases[npi(4)] == "QUALIFIED" and cases[npi(8)] in ("AMBIGUOUS", "DISQUALIFIED")
    leads = {r["npi"]: r for r in out.read("fraud_leads_v3").collect()}
    assert len(leads) == 70 and leads[npi(4)]["priority_rank"] == 1 and not leads[npi(20)]["not_scored"]
    tracked = out.read("company_lead_tracker")
    assert tracked.groupBy("company_id").count().where("count > 1").count() == 0
    assert tracked.agg({"npi_count": "sum"}).first()[0] == 70
    assert tracked.where("priority_rank = 1").count() >= 1


def test_models_and_backtest(store):
    out, _ = store
    scores = out.read("provider_model_scores")
    assert scores.count() == 70 and {r["segment"] for r in scores.where("provider_on_leie").collect()} == {"leie_positive"}
    assert out.read("backtest_results").agg({"hit": "sum"}).first()[0] >= 1
    assert out.read("backtest_lift").count() == 10


def test_coverage_diagnosis(store):
    out, n = store
    buckets = {r["bucket"]: r["n_rows"] for r in out.read("unmatched_buckets").collect()}
    assert sum(buckets.values()) == out.read("spending_fact").where("not provider_matched").count() and {"blank", "failed_luhn"} <= set(buckets)
    assert out.read("quarantine_accounting").first()["n_ids"] == 2
    assert out.read("spending_corruption_quarantine").count() == 1 and out.read("coverage_ambiguity").count() == 1
    assert out.read("malformed_lines").count() == 0


def test_exports(store):
    out, _ = store
    leads = {r["npi"]: r for r in out.read("provider_leads").collect()}
    assert len(leads) == 70 and leads[npi(4)]["layer1_disposition"] == "QUALIFIED" and leads[npi(20)]["provider_name"] == "Org 10 LLC"
    kinds = {k: len(rows(out, f"flat/{k}")) for k in ("fraud_leads", "leads_ranked", "layer1_rule_hits", "layer3_ownership_leads")}
    assert kinds["fraud_leads"] == 70 >= kinds["leads_ranked"] >= kinds["layer1_rule_hits"] >= 1
    assert npi(4) in {r["npi"] for r in rows(out, "high_precision_excluded_leads.csv")}
    clean = rows(out, "companies/company_leads_clean")
    assert len(clean) == len(rows(out, "companies/triage_priority")) + len(rows(out, "companies/probable_owner_backlog")) >= 1 and all(r["company_name"] for r in clean)
    assert len(rows(out, "advert/selected")) == len(rows(out, "advert/clean")) + len(rows(out, "advert/excluded"))
    cases = {r["npi"]: r for r in out.read("layer1_cases").collect()}
    assert cases[npi(4)]["name_match"] == "exact" and cases[npi(4)]["fraud_related_type"] and cases[npi(4)]["excl_months"] == "2019-06"


def test_model_artifacts(store):
    out, _ = store
    assert out.read("feature_importance").count() > 5 and out.read("pr_curve").count() >= 1
    assert out.read("val_predictions").count() >= 1 and out.read("model_leads").count() <= 5
    assert out.read("model_npi_leads").where("provider_name is null").count() == 0
    assert out.read("backtest_timing").count() == 3 and out.read("backtest_billing_lift").count() == 10


def test_yearly_track(store):
    out, _ = store
    people = {r["npi"]: r for r in out.read("yearly_providers").collect()}
    assert people[npi(3)]["billing_on_deactivated_npi"] == 1 and people[npi(4)]["in_leie"] and people[npi(5)]["specialty"] == "Family Medicine"
    years = out.read("yearly_features")
    assert years.count() == years.select("npi", "year").distinct().count() >= 200
    scored = out.read("yearly_scores")
    assert scored.agg({"anomaly_score": "max"}).first()[0] == 1.0 and scored.agg({"anomaly_score": "min"}).first()[0] == 0.0
    ranked = rows(out, "provider_rankings.csv")
    assert len(ranked) == years.count() and sorted(int(r["rank"]) for r in ranked) == list(range(1, len(ranked) + 1)) and all(r["description"] for r in ranked)
    assert len(rows(out, "provider_summary.csv")) == len(people) - 1  # one has no valid month
