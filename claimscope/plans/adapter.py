"""Claim-shaped views of the driver's tables, in Spark; plans.sql has the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.functions.numbers import log1p_positive
from claimscope.llm.common import discard, materialize
from claimscope.operators import companies, features

CARRIED = {"primary_taxonomy": "taxonomy_code", "entity_type": "entity_type", "practice_state": "provider_state", "org_legal_name": "org_legal_name"}
#: The most dollars that a plausible row of these tables has.
CEILING = 100_000.0


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def claims(self) -> DataFrame:
        """Line items as claims; a third of the first lines that were returned are reversals."""
        li, o, c, n = (self.read(t) for t in ("lineitem", "orders", "customer", "nation"))
        return self._as_claims(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")))

    @staticmethod
    def _as_claims(joined: DataFrame) -> DataFrame:
        reversal = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
        return joined.select(
            F.col("c_custkey").cast("string").alias("billing_npi"), F.col("l_partkey").cast("string").alias("hcpcs_code"), F.date_format("l_shipdate", "yyyy-MM").alias("service_month"),
            F.when(reversal, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).cast("decimal(18,2)").alias("total_paid"),
            F.col("l_quantity").cast("bigint").alias("total_claim_lines"), F.col("l_linenumber").cast("bigint").alias("total_patients"),
            F.col("c_mktsegment").alias("taxonomy_code"), F.col("n_name").alias("provider_state"), F.when(F.col("c_acctbal") >= 0, "2").otherwise("1").alias("entity_type"),
            F.concat_ws(" ", "n_name", "c_mktsegment", F.lit("LLC")).alias("org_legal_name"), "c_custkey",
        )

    def providers(self) -> DataFrame:
        """Linking columns, one row an npi."""
        k = F.col("c_custkey")
        c = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return c.select(
            k.cast("string").alias("npi"), F.when(k % 3 == 0, (k % 97).cast("string")).alias("pac_id"), F.when(k % 3 == 1, F.concat(F.lit("own"), k % 400)).alias("owner_key"),
            F.concat_ws(" ", "n_name", "c_mktsegment", F.lit("LLC")).alias("org_legal_name"), F.col("n_name").alias("practice_state"), F.col("c_mktsegment").alias("primary_taxonomy"), F.when(F.col("c_acctbal") >= 0, "2").otherwise("1").alias("entity_type"),
        )

    def fact(self) -> DataFrame:
        return self.claims().withColumn("provider_matched", F.col("c_custkey") % 20 != 0)

    def raw_claims(self) -> DataFrame:
        return self.claims().withColumn("billing_npi_raw", (F.col("c_custkey") + 1_000_000_000).cast("string")).drop("billing_npi")

    def registry(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.read("customer").where(k % 20 != 0).select(
            (k + 1_000_000_000).cast("string").alias("npi"), F.when(k % 7 == 0, F.lit("1998-01-01").cast("date")).alias("deactivated"), F.when(k % 14 == 0, F.lit("1999-06-01").cast("date")).alias("reactivated")
        )

    def exclusions(self) -> DataFrame:
        """Every fiftieth customer; some are reinstated or waivered, some listed twice."""
        k = F.col("c_custkey")
        base = self.read("customer").where(k % 50 == 0)

        def record(df: DataFrame, shift: int, kind: str) -> DataFrame:
            day = F.date_add(F.lit("1997-01-01").cast("date"), (k % 1200 + shift).cast("int"))
            return df.select(
                k.cast("string").alias("npi"), F.date_format(day, "yyyy-MM").alias("excl_month"), F.when(k % 150 == 0, F.date_format(F.date_add(day, 365), "yyyy-MM")).alias("rein_month"),
                F.when(k % 100 == 0, F.date_format(F.date_add(day, 200), "yyyy-MM")).alias("waiver_month"), F.date_format(day, "yyyyMMdd").alias("excl_date"), F.lit(kind).alias("excl_type"), F.upper("c_name").alias("name_key"),
            )

        return record(base, 0, "1128a1").unionByName(record(base.where(k % 200 == 0), 700, "1128b7"))

    def owners(self) -> DataFrame:
        s = F.col("s_suppkey")
        role = F.element_at(F.array(*map(F.lit, ("MANAGING CONTROL", "DIRECTOR", "5% OWNERSHIP", "CONTRACTOR"))), (F.col("s_nationkey") % 4 + 1).cast("int"))
        listed = F.concat(F.lit("CUSTOMER#"), F.lpad(((s % 40) * 25).cast("string"), 9, "0"))
        return self.read("supplier").select(
            (s * 5 % 300).cast("string").alias("facility_npi"), F.when(s % 3 == 0, ((s % 30) * 50 + s % 2).cast("string")).alias("owner_npi"), role.alias("owner_role"),
            F.when(s % 2 == 0, "O").otherwise("I").alias("owner_type"), F.when(s % 2 == 0, listed).otherwise("").alias("owner_org_name_key"), F.when(s % 2 == 1, listed).otherwise("").alias("owner_name_key"),
        )

    def provider_months(self) -> DataFrame:
        m = features.by_month(self.claims(), "billing_npi")
        return m.select(F.col("billing_npi").alias("npi"), "service_month", F.col("net_paid").alias("paid"), "claim_lines")

    def company_map(self) -> DataFrame:
        return companies.link(self.providers()).select("npi", "company_id")

    def _scoring(self, claims: DataFrame, key: str, dims: DataFrame) -> DataFrame:
        """The scoring frame: rate features rounded to 6 places, so ties are ties in any engine. Claims are summed once by code and once by month."""
        codes, cell = features.by_code(claims, key), ["taxonomy_code", "entity_type"]
        rates = features.rate_features(claims, key, codes=codes)
        places = dims.select(key, F.col("primary_taxonomy").alias("taxonomy_code"), "entity_type")
        rare = features.rare_share(codes, places, features.rare_pairs(codes.join(places, key), cell, key), cell, key, "rare_share")
        return self._frame(rates, dims, rare, key)

    @staticmethod
    def _frame(rates: DataFrame, dims: DataFrame, rare: DataFrame, key: str) -> DataFrame:
        met = rates.join(dims, key).join(rare, key, "left").withColumn("log_max_single_month", log1p_positive(F.col("max_single_month_net_paid")))
        return met.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if t.startswith(("double", "decimal")) else F.col(c) for c, t in met.dtypes])

    def provider_scoring(self) -> DataFrame:
        claims = self.claims()
        dims = self.providers().select(F.col("npi").alias("billing_npi"), "primary_taxonomy", "entity_type")
        return self._scoring(claims, "billing_npi", dims).withColumnRenamed("billing_npi", "npi")

    def stored_scoring(self) -> DataFrame:
        """provider_scoring() for models, which read it many times: its steps are stored tables, and each step's
        shuffle files are deleted before the next one."""
        key, cell = "billing_npi", ["taxonomy_code", "entity_type"]
        store = lambda df, label: materialize(df, f"scoring-{label}", clean=True)
        dims = self.providers().select(F.col("npi").alias(key), "primary_taxonomy", "entity_type")
        places = dims.select(key, F.col("primary_taxonomy").alias("taxonomy_code"), "entity_type")
        li, o, c, n = (self.read(x) for x in ("lineitem", "orders", "customer", "nation"))
        placed = o.join(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
        claims = store(self._as_claims(li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))).select(key, "hcpcs_code", "service_month", "total_paid", "total_claim_lines", "total_patients"), "claims")
        dealt = claims.repartition(F.col(key))  # one exchange serves all sums of a key
        codes = store(features.by_code(dealt, key), "codes")
        rates = store(features.rate_features(dealt, key, codes=codes, months=features.by_month(dealt, key)), "rates")
        discard(claims)
        placed = store(codes.join(places, key), "placed")
        discard(codes)
        rare = store(features.rare_pairs(placed, cell, key), "pairs")
        share = store(features.share_of_rare(placed, rare, cell, key, "rare_share"), "rare")
        for done in (placed, rare):
            discard(done)
        frame = store(self._frame(rates, dims, share, key).withColumnRenamed(key, "npi"), "frame")
        for done in (rates, share):
            discard(done)
        return frame

    def company_claims(self) -> DataFrame:
        return self.claims().join(self.company_map().withColumnRenamed("npi", "billing_npi"), "billing_npi")

    def company_dims(self) -> DataFrame:
        """The taxonomy and entity type with most gross dollars of each company."""
        claims = self.company_claims()
        paid = claims.groupBy("company_id", "taxonomy_code", "entity_type").agg(F.sum(F.when(F.col("total_paid") > 0, F.col("total_paid")).otherwise(F.lit(0))).alias("g"))
        best = paid.groupBy("company_id").agg(F.max(F.struct("g", "taxonomy_code", "entity_type")).alias("b"))
        return best.select("company_id", F.col("b.taxonomy_code").alias("primary_taxonomy"), F.col("b.entity_type").alias("entity_type"))

    def company_scoring(self) -> DataFrame:
        return self._scoring(self.company_claims().drop("taxonomy_code", "entity_type"), "company_id", self.company_dims())

    def linked(self) -> DataFrame:
        """Linked providers with simple signals, for the company roll-up."""
        k = F.col("npi").cast("bigint")
        core = features.core(self.claims(), "billing_npi").select(F.col("billing_npi").alias("npi"), "net_paid", "gross_paid")
        return companies.link(self.providers()).join(core, "npi").withColumns({
            "provider_on_leie": k % 50 == 0, "billed_after_exclusion": k % 100 == 0, "anomaly_score": (k % 101) / F.lit(101.0), "n_concept_signals": (k % 4).cast("int"), "probable_owner": k % 41 == 0,
            "npi_lead": k % 13 == 0, "priority_rank": F.when(k % 100 == 0, 1).when(k % 50 == 0, 3).when(k % 13 == 0, 4).when(k % 41 == 0, 5).otherwise(6),
        })

    def companies(self) -> DataFrame:
        return companies.rollup(self.linked())

    def tracked(self) -> DataFrame:
        rolled = self.companies()
        scores = rolled.select("company_id", F.col("max_anomaly_score").alias("company_anomaly_score"), (F.col("max_n_concept_signals") >= 3).alias("company_anomaly_lead"))
        after = self.linked().where(F.col("billed_after_exclusion")).groupBy("company_id").agg(F.sum("net_paid").alias("paid_after"))
        return companies.track(rolled, scores, after)

    def names(self) -> DataFrame:
        """Organisation-like names from part names and nations, some with screening keywords."""
        p = self.read("part")
        k = F.col("p_partkey")
        word = F.element_at(F.array(*map(F.lit, ("County of", "Tribal Health", "State University,", "Red Cross of", "Hospital", "the", "L L C", "Inc.", "Hospital Service District", "Good Samaritan Society", "Alaska Native", "Kern County"))), (k % 12 + 1).cast("int"))
        code = F.when(k % 31 == 0, "Clinic 261QF0400X").when(k % 29 == 0, "General 282N00000X").otherwise("Home")
        return p.select(k.cast("bigint").alias("id"), F.when(k % 5 == 0, F.concat_ws(" ", word, "p_name")).otherwise(F.concat_ws("  ", "p_name", "p_type", word)).alias("name"), code.alias("specialty"), F.element_at(F.array(*map(F.lit, ("TX", "CA; NY", "tx/ca", ""))), (k % 4 + 1).cast("int")).alias("states"), F.col("p_retailprice").alias("amount"))

    def monthly(self) -> DataFrame:
        c = self.claims()
        return c.groupBy(F.col("billing_npi").alias("npi"), "hcpcs_code", F.substring("service_month", 1, 4).cast("int").alias("year"), F.substring("service_month", 6, 2).cast("int").alias("month_num")).agg(
            F.sum("total_paid").alias("paid"), F.sum("total_claim_lines").alias("claims"), F.sum("total_patients").alias("beneficiaries")
        )

    def coarse_monthly(self) -> DataFrame:
        """Months with part groups as codes, so peer groups have enough members."""
        c = self.claims().withColumn("hcpcs_code", (F.col("hcpcs_code").cast("bigint") % 7).cast("string"))
        return c.groupBy(F.col("billing_npi").alias("npi"), "hcpcs_code", F.substring("service_month", 1, 4).cast("int").alias("year")).agg(F.sum("total_paid").alias("paid"), F.sum("total_claim_lines").alias("claims"), F.sum("total_patients").alias("beneficiaries"))

    def taxonomy(self) -> DataFrame:
        return self.providers().select("npi", F.col("primary_taxonomy").alias("taxonomy_code"))

    def scored(self) -> DataFrame:
        """Providers with a stand-in model score and a label."""
        k = F.col("npi").cast("bigint")
        return self.linked().select("npi", "company_id", "net_paid", "provider_on_leie", (k * 7919 % 1009 / F.lit(1009.0)).alias("score"), (k % 50 == 0).cast("int").alias("label"), (k % 5 == 0).alias("in_training"), (k % 11 == 0).alias("not_scored"))

