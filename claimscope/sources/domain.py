"""The five inputs: spending, registry, enrollment, owners and exclusions, read as strings and cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimscope.functions.dates import ymd_date, ymd_month
from claimscope.functions.ids import canonical_npi
from claimscope.functions.lookups import specialty
from claimscope.functions.names import address_key, display_name, name_key
from claimscope.sources.readers import facility_type, file_stem, read_any, read_table, resolve_columns, typed_spending, union_files

# The headers that each column is known by.
SPENDING = {
    "billing_npi_raw": ["BILLING_PROVIDER_NPI_NUM", "billing_provider_npi", "billing_npi", "npi"],
    "servicing_npi_raw": ["SERVICING_PROVIDER_NPI_NUM", "servicing_provider_npi", "servicing_npi", "rendering_npi"],
    "hcpcs_code": ["HCPCS_CODE", "procedure_code"],
    "service_month": ["CLAIM_FROM_MONTH", "service_month", "month"],
    "total_patients": ["TOTAL_PATIENTS", "total_beneficiaries", "total_recipients", "recipient_count"],
    "total_claim_lines": ["TOTAL_CLAIM_LINES", "total_claims", "claim_count"],
    "total_paid": ["TOTAL_PAID", "total_paid_amount", "paid_amount"],
    "suppressed": ["SUPPRESSED", "suppression_flag", "is_suppressed"],
}
REGISTRY = {
    "npi_raw": ["NPI"], "entity_type": ["Entity Type Code"], "org_legal_name": ["Provider Organization Name (Legal Business Name)"], "last_name": ["Provider Last Name (Legal Name)"], "first_name": ["Provider First Name"],
    "taxonomy_code": ["Healthcare Provider Taxonomy Code_1"], "line1": ["Provider First Line Business Practice Location Address"], "city": ["Provider Business Practice Location Address City Name"],
    "provider_state": ["Provider Business Practice Location Address State Name"], "zip": ["Provider Business Practice Location Address Postal Code"], "deactivation": ["NPI Deactivation Date"], "reactivation": ["NPI Reactivation Date"],
    "enumeration": ["Provider Enumeration Date"],
}
ENROLLMENT = {
    "npi_raw": ["NPI"], "pac_id": ["PECOS_ASCT_CNTL_ID"], "enrollment_id": ["ENRLMT_ID"], "provider_type_code": ["PROVIDER_TYPE_CD"], "provider_type_desc": ["PROVIDER_TYPE_DESC"], "pecos_state": ["STATE_CD"],
    "first_name": ["FIRST_NAME"], "last_name": ["LAST_NAME"], "org_name": ["ORG_NAME"],
}
EXCLUSIONS = {
    "npi_raw": ["NPI"], "last_name": ["LASTNAME"], "first_name": ["FIRSTNAME"], "busname": ["BUSNAME"], "excl_type": ["EXCLTYPE"], "excl_raw": ["EXCLDATE"], "rein_raw": ["REINDATE"], "waiver_raw": ["WAIVERDATE"],
    "waiver_state": ["WVRSTATE"], "city": ["CITY"], "state": ["STATE"], "zip": ["ZIP"],
}
OWNERS = {
    "enrollment_id": ["ENROLLMENT ID"], "pac_id": ["ASSOCIATE ID"], "facility_name": ["ORGANIZATION NAME"], "owner_pac_id": ["ASSOCIATE ID - OWNER"], "owner_type": ["TYPE - OWNER"], "owner_role": ["ROLE TEXT - OWNER"],
    "association_date": ["ASSOCIATION DATE - OWNER"], "owner_first_name": ["FIRST NAME - OWNER"], "owner_last_name": ["LAST NAME - OWNER"], "owner_org_name": ["ORGANIZATION NAME - OWNER"], "pct_ownership": ["PERCENTAGE OWNERSHIP"],
}
#: Codes whose unit covers a wide span of effort.
BROAD_CODES = ("T1019", "T1020", "S5125", "S5126", "T2025", "H2014")


def spending(spark: SparkSession, path: str) -> DataFrame:
    """Raw records with numbers; suppressed measures are null, codes with broad units are flagged."""
    df = typed_spending(read_table(spark, path, SPENDING, ("billing_npi_raw", "hcpcs_code", "service_month", "total_paid")), "suppressed").drop("suppressed")
    return df.withColumn("broad_code", F.coalesce(F.col("hcpcs_code").isin(*BROAD_CODES), F.lit(False)))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """One row a valid npi: the most complete, ties by name and address."""
    df = read_table(spark, path, REGISTRY, ("npi_raw",))
    day = lambda c: F.coalesce(F.try_to_date(F.col(c), "MM/dd/yyyy"), F.try_to_date(F.col(c), "yyyy-MM-dd"))
    ready = df.withColumns({
        "npi": canonical_npi(F.col("npi_raw")), "provider_name": display_name(F.col("org_legal_name"), F.col("last_name"), F.col("first_name")), "deactivated": day("deactivation"), "reactivated": day("reactivation"), "enumerated": day("enumeration"), "specialty": specialty(F.col("taxonomy_code")),
        "addr_key": address_key(F.col("line1"), F.col("city"), F.col("provider_state"), F.col("zip")),
    }).withColumn("is_active", F.col("deactivated").isNull() | (F.col("reactivated") >= F.col("deactivated")))
    kept = ["npi", "entity_type", "org_legal_name", "provider_name", "taxonomy_code", "provider_state", "addr_key", "deactivated", "reactivated", "is_active", "enumerated", "specialty"]
    filled = sum((F.col(c).isNotNull().cast("int") for c in kept if c != "specialty"), F.lit(0))
    first = Window.partitionBy("npi").orderBy(filled.desc(), "provider_name", "addr_key", "taxonomy_code", "deactivation", "reactivation")
    return ready.where("npi is not null").withColumn("__n", F.row_number().over(first)).where("__n = 1").select(*kept)


def enrollment(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path, ENROLLMENT, ("npi_raw", "enrollment_id")).withColumn("npi", canonical_npi(F.col("npi_raw")))
    kind = F.when(F.col("enrollment_id").startswith("I"), "individual").when(F.col("enrollment_id").startswith("O"), "organization")
    return df.where("npi is not null").drop("npi_raw").withColumn("enrollment_type", kind).distinct()


def one_enrollment(enrolled: DataFrame) -> DataFrame:
    """The enrollment of each npi: the most complete, ties by enrollment id."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in enrolled.columns), F.lit(0))
    first = Window.partitionBy("npi").orderBy(filled.desc(), "enrollment_id", "pac_id")
    return enrolled.withColumn("__n", F.row_number().over(first)).where("__n = 1").select("npi", "provider_type_code", "provider_type_desc", "pecos_state")


def exclusions(spark: SparkSession, path: str) -> DataFrame:
    """All records; a waiver state without a date is waived from the exclusion month."""
    df = read_table(spark, path, EXCLUSIONS)
    name = F.when((F.coalesce("last_name", F.lit("")) != "") | (F.coalesce("first_name", F.lit("")) != ""), display_name(F.lit(""), F.col("last_name"), F.col("first_name"))).otherwise(F.coalesce("busname", F.lit("")))
    em = ymd_month(F.col("excl_raw"))
    waiver = F.coalesce(ymd_month(F.col("waiver_raw")), F.when(F.trim(F.coalesce("waiver_state", F.lit(""))) != "", em))
    return df.select(
        canonical_npi(F.col("npi_raw")).alias("npi"), F.col("excl_type"), ymd_date(F.col("excl_raw")).alias("excl_date"), ymd_date(F.col("rein_raw")).alias("reinstate_date"), em.alias("excl_month"),
        ymd_month(F.col("rein_raw")).alias("rein_month"), waiver.alias("waiver_month"), "waiver_state", "state", "busname", name.alias("entity_name"), name_key(name).alias("name_key"),
    ).withColumn("currently_active", F.col("reinstate_date").isNull())


def owners(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Facility-owner edges of all files, which may have different columns; flags are kept as they are."""
    frames = []
    for path in paths:
        raw = read_any(spark, path)
        found = resolve_columns(raw.columns, OWNERS, ("enrollment_id",))
        flags = [c for c in raw.columns if c.endswith("- OWNER") and c not in found.values()]
        named = [F.col(f"`{c}`").cast("string").alias("flag_" + c.removesuffix(" - OWNER").lower().replace(" ", "_")) for c in flags]
        frames.append(raw.select(*[(F.col(f"`{c}`") if c else F.lit(None)).cast("string").alias(k) for k, c in found.items()], *named, facility_type(file_stem()).alias("facility_type")))
    person = display_name(F.lit(""), F.col("owner_last_name"), F.col("owner_first_name"))
    return union_files(frames).withColumns({"owner_org_name_key": name_key(F.col("owner_org_name")), "owner_name_key": name_key(person)})
