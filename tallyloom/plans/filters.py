"""Filters, predicates and projections over receipts and donors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text, values
from tallyloom.functions.rewrites import strip
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()
_C = "contributions"
_ID = "row_id"


def _receipts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, _C)


def _add(name: str, sql: str, f) -> None:
    registry.add(name, sql)(lambda spark, d: f(_receipts(spark, d)))


_add("flt_amount_min_incl", "SELECT row_id, amount FROM contributions WHERE amount >= 5000", lambda c: c.filter("amount >= 5000").select(_ID, "amount"))
_add("flt_amount_min_strict", "SELECT row_id, amount FROM contributions WHERE amount > 5000", lambda c: c.filter("amount > 5000").select(_ID, "amount"))
_add(
    "flt_qualifying_company",
    """SELECT row_id, contributor_employer, amount FROM contributions WHERE amount >= 1000 AND coalesce(strip(contributor_id), '') = ''
       AND lower(strip(coalesce(contributor_occupation, ''))) NOT IN ('retired', 'not employed', 'student', 'homemaker') AND strip(coalesce(contributor_employer, '')) <> ''""",
    lambda c: c.filter(
        (F.col("amount") >= 1000)
        & (strip(F.coalesce("contributor_id", F.lit(""))) == "")
        & ~F.lower(strip(F.coalesce("contributor_occupation", F.lit("")))).isin("retired", "not employed", "student", "homemaker")
        & (strip(F.coalesce("contributor_employer", F.lit(""))) != "")
    ).select(_ID, "contributor_employer", "amount"),
)
_KIND_SQL = """CASE WHEN strip(coalesce(contributor_id, '')) <> '' THEN 'committee' WHEN strip(coalesce(contributor_occupation, '')) <> '' THEN 'individual' ELSE 'organization' END"""


def donor_type(c: DataFrame):
    """A donor with an id is a committee, else with an occupation an individual, else an organisation."""
    filled = lambda x: strip(F.coalesce(x, F.lit(""))) != ""
    return F.when(filled(F.col("contributor_id")), "committee").when(filled(F.col("contributor_occupation")), "individual").otherwise("organization")


_add("prj_donor_type", f"SELECT row_id, {_KIND_SQL} AS donor_type FROM contributions", lambda c: c.select(_ID, donor_type(c).alias("donor_type")))
_add(
    "flt_entity_kind",
    f"""SELECT row_id, {_KIND_SQL} AS kind, CASE WHEN {_KIND_SQL} = 'individual' THEN coalesce(nullif(strip(contributor_employer), ''), contributor_occupation) ELSE contributor_name END AS entity
        FROM contributions WHERE amount >= 2500 OR (strip(coalesce(contributor_id, '')) <> '' AND amount > 0)""",
    lambda c: c.filter((F.col("amount") >= 2500) | ((strip(F.coalesce("contributor_id", F.lit(""))) != "") & (F.col("amount") > 0))).select(
        _ID,
        donor_type(c).alias("kind"),
        F.when(donor_type(c) == "individual", F.coalesce(F.nullif(strip(F.col("contributor_employer")), F.lit("")), F.col("contributor_occupation"))).otherwise(F.col("contributor_name")).alias("entity"),
    ),
)
registry.add("flt_cycle", "SELECT c.row_id, f.naml FROM contributions c JOIN filers f ON c.recipient_committee_id = f.filer_id WHERE c.start_date >= '2025-01-01'")(
    lambda spark, d: _receipts(spark, d)
    .filter("start_date >= '2025-01-01'")
    .join(table(spark, d, "filers"), F.col("recipient_committee_id") == F.col("filer_id"))
    .select(_ID, "naml")
)
_add(
    "flt_race_scope",
    "SELECT row_id FROM contributions WHERE office IN ('State Senate', 'Treasurer') OR ballot_measures = 'PROPOSITION 51' OR recipient_name LIKE 'BRAN%'",
    lambda c: c.filter(F.col("office").isin("State Senate", "Treasurer") | (F.col("ballot_measures") == "PROPOSITION 51") | F.col("recipient_name").startswith("BRAN")).select(_ID),
)
_add("flt_missing_committee", "SELECT row_id FROM contributions WHERE strip(coalesce(recipient_committee_id, '')) <> ''", lambda c: c.filter(strip(F.coalesce("recipient_committee_id", F.lit(""))) != "").select(_ID))
_add("flt_future_dates", "SELECT row_id, start_date FROM contributions WHERE try_cast(start_date AS DATE) > DATE '2025-11-30'", lambda c: c.filter(F.try_to_date("start_date", "yyyy-MM-dd") > F.lit("2025-11-30").cast("date")).select(_ID, "start_date"))
_PLACE = "('N A', 'NONE', 'INFORMATION REQUESTED', 'UNKNOWN', 'NOT EMPLOYED', '')"
_NORM_SQL = "norm({})"
_add(
    "flt_placeholder_employer",
    f"SELECT row_id, CASE WHEN {_NORM_SQL.format('contributor_employer')} IN {_PLACE} THEN 'Unclassified' ELSE {_NORM_SQL.format('contributor_employer')} END AS bucket FROM contributions",
    lambda c: c.select(_ID, F.when(text.normalize_name(F.col("contributor_employer")).isin("N A", "NONE", "INFORMATION REQUESTED", "UNKNOWN", "NOT EMPLOYED", ""), "Unclassified").otherwise(text.normalize_name(F.col("contributor_employer"))).alias("bucket")),
)
_add(
    "flt_skip_values",
    "SELECT row_id, contributor_employer FROM contributions WHERE coalesce(contributor_employer, '') <> '' AND upper(contributor_employer) NOT IN ('NOT EMPLOYED', 'RETIRED', 'SELF-EMPLOYED')",
    lambda c: c.filter((F.coalesce("contributor_employer", F.lit("")) != "") & ~F.upper("contributor_employer").isin("NOT EMPLOYED", "RETIRED", "SELF-EMPLOYED")).select(_ID, "contributor_employer"),
)
registry.add(
    "flt_not_pre_locked",
    "SELECT employer_id, CASE WHEN data_source_1 IS NOT NULL THEN level1_category WHEN employer_norm LIKE '%BANK%' THEN 'Finance' ELSE level1_category END AS level1_category FROM employers",
)(
    lambda spark, d: table(spark, d, "employers").select(
        "employer_id", F.when(F.col("data_source_1").isNotNull(), F.col("level1_category")).when(F.col("employer_norm").contains("BANK"), "Finance").otherwise(F.col("level1_category")).alias("level1_category")
    )
)
registry.add(
    "flt_uncoded_big",
    """SELECT DISTINCT c.contributor_name AS company FROM contributions c LEFT JOIN (SELECT name_norm, min(naics_code) AS code FROM running_list GROUP BY 1) r
       ON  norm(c.contributor_name) = r.name_norm
       WHERE c.amount >= 4000 AND coalesce(c.contributor_occupation, '') = '' AND r.code IS NULL""",
)(
    lambda spark, d: _receipts(spark, d)
    .filter((F.col("amount") >= 4000) & (F.coalesce("contributor_occupation", F.lit("")) == ""))
    .select(F.col("contributor_name").alias("company"), text.normalize_name(F.col("contributor_name")).alias("name_norm"))
    .distinct()
    .join(table(spark, d, "running_list").groupBy("name_norm").agg(F.min("naics_code").alias("code")), "name_norm", "left")
    .filter("code IS NULL")
    .select("company")
    .distinct()
)
registry.add(
    "flt_category_conf_range",
    "SELECT search_id, lower(confidence) AS confidence FROM web_search_cache WHERE lower(confidence) IN ('low', 'medium') AND NOT is_prominent ORDER BY searched_at, search_id LIMIT 200",
)(
    lambda spark, d: table(spark, d, "web_search_cache")
    .filter(F.lower("confidence").isin("low", "medium") & ~F.col("is_prominent"))
    .orderBy("searched_at", "search_id")
    .limit(200)
    .select("search_id", F.lower("confidence").alias("confidence"))
)
_RACE_SQL = "CASE WHEN ballot_measure_contribution = 'Y' THEN ballot_measures WHEN office IS NOT NULL THEN office ELSE recipient_name END"


def race_prop():
    """The measure of a measure contribution, else the office, else the recipient."""
    return F.when(F.col("ballot_measure_contribution") == "Y", F.col("ballot_measures")).when(F.col("office").isNotNull(), F.col("office")).otherwise(F.col("recipient_name"))


_add("prj_race_prop", f"SELECT row_id, {_RACE_SQL} AS race_prop FROM contributions", lambda c: c.select(_ID, race_prop().alias("race_prop")))
_add(
    "prj_recipient_key",
    "SELECT row_id, coalesce(nullif(strip(recipient_committee_id), ''), nullif(strip(ballot_measures), ''), recipient_name) AS recipient_key FROM contributions",
    lambda c: c.select(_ID, F.coalesce(F.nullif(strip(F.col("recipient_committee_id")), F.lit("")), F.nullif(strip(F.col("ballot_measures")), F.lit("")), F.col("recipient_name")).alias("recipient_key")),
)
_add(
    "prj_label_recipient",
    """SELECT row_id, coalesce(nullif(nullif(strip(recipient_name), ''), 'NAN, NAN'), recipient_committee) AS label,
       CASE WHEN allied_committee = 'Y' THEN 'allied' WHEN ballot_measure_contribution = 'Y' THEN 'measure' ELSE 'candidate' END AS contribution_type FROM contributions""",
    lambda c: c.select(
        _ID,
        F.coalesce(F.nullif(F.nullif(strip(F.col("recipient_name")), F.lit("")), F.lit("NAN, NAN")), F.col("recipient_committee")).alias("label"),
        F.when(F.col("allied_committee") == "Y", "allied").when(F.col("ballot_measure_contribution") == "Y", "measure").otherwise("candidate").alias("contribution_type"),
    ),
)
_add(
    "prj_map_contribution",
    """SELECT row_id, CASE WHEN upper(transaction_type) LIKE 'NON%' THEN 'in kind' ELSE 'money' END AS form, substr(start_date, 1, 4) AS cycle, coalesce(nullif(end_date, ''), start_date) AS end_date,
       round(amount, 2) AS amount, upper(strip(contributor_name)) AS contributor, upper(strip(coalesce(contributor_city, ''))) AS city, left(contributor_zip_code, 5) AS zip,
       candidate_contribution = 'Y' AS to_candidate, ballot_measure_contribution = 'Y' AS to_measure FROM contributions""",
    lambda c: c.select(
        _ID,
        F.when(F.upper("transaction_type").startswith("NON"), "in kind").otherwise("money").alias("form"),
        F.substring("start_date", 1, 4).alias("cycle"),
        F.coalesce(F.nullif("end_date", F.lit("")), F.col("start_date")).alias("end_date"),
        F.round("amount", 2).alias("amount"),
        F.upper(strip(F.col("contributor_name"))).alias("contributor"),
        F.upper(strip(F.coalesce("contributor_city", F.lit("")))).alias("city"),
        F.substring("contributor_zip_code", 1, 5).alias("zip"),
        (F.col("candidate_contribution") == "Y").alias("to_candidate"),
        (F.col("ballot_measure_contribution") == "Y").alias("to_measure"),
    ),
)
registry.add(
    "prj_code_restamp",
    "SELECT e.employer_id, e.naics_code, r.label FROM employers e LEFT JOIN (SELECT naics_code, min(naics_label) AS label FROM running_list WHERE naics_code IS NOT NULL GROUP BY 1) r USING (naics_code)",
)(
    lambda spark, d: table(spark, d, "employers")
    .select("employer_id", "naics_code")
    .join(table(spark, d, "running_list").filter("naics_code IS NOT NULL").groupBy("naics_code").agg(F.min("naics_label").alias("label")), "naics_code", "left")
    .select("employer_id", "naics_code", "label")
)
registry.add("prj_apply_colmap", "SELECT filer_id AS committee, naml AS last_name, CAST(NULL AS VARCHAR) AS middle_name FROM filers")(
    lambda spark, d: apply_colmap(table(spark, d, "filers"), {"committee": "filer_id", "last_name": "naml", "middle_name": "middle"}, required=("committee",))
)
_add(
    "prj_pad_zip",
    "SELECT row_id, CASE WHEN regexp_matches(contributor_zip_code, '^[0-9]+$') AND length(contributor_zip_code) < 5 THEN lpad(contributor_zip_code, 5, '0') ELSE left(contributor_zip_code, 5) END AS zip FROM contributions",
    lambda c: c.select(_ID, padded_zip(F.col("contributor_zip_code")).alias("zip")),
)
_add(
    "prj_missing_norm",
    "SELECT row_id, CASE WHEN strip(coalesce(contributor_occupation, '')) IN ('', 'N/A', 'NA', 'n/a', 'None') THEN 'N/A' ELSE contributor_occupation END AS occupation FROM contributions",
    lambda c: c.select(_ID, F.when(strip(F.coalesce("contributor_occupation", F.lit(""))).isin("", "N/A", "NA", "n/a", "None"), "N/A").otherwise(F.col("contributor_occupation")).alias("occupation")),
)
registry.add(
    "prj_manual_patches",
    "SELECT filer_id, CASE filer_id WHEN '1400020' THEN 'PATCHED' ELSE naml END AS naml FROM filers",
)(
    lambda spark, d: table(spark, d, "filers")
    .join(spark.createDataFrame([("1400020", "PATCHED")], "filer_id string, patch string"), "filer_id", "left")
    .select("filer_id", F.coalesce("patch", "naml").alias("naml"))
)


def padded_zip(c):
    """Digits padded to five on the left; otherwise the first five characters."""
    return F.when(c.rlike("^[0-9]+$") & (F.length(c) < 5), F.lpad(c, 5, "0")).otherwise(F.substring(c, 1, 5))


def apply_colmap(df: DataFrame, names: dict[str, str], required: tuple[str, ...] = ()) -> DataFrame:
    """Columns under their logical names; an absent one is null, and an absent required one an error that names it."""
    missing = [k for k in required if names[k] not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(v).alias(k) if v in df.columns else F.lit(None).cast("string").alias(k) for k, v in names.items()])


_add("d_cycle_year", "SELECT row_id, CASE WHEN regexp_matches(substr(start_date, 1, 4), '^[0-9]{4}$') THEN substr(start_date, 1, 4) END AS cycle FROM contributions", lambda c: c.select(_ID, values.cycle_year(F.col("start_date")).alias("cycle")))
_add("d_end_fallback", "SELECT row_id, coalesce(nullif(end_date, ''), start_date) AS end_date FROM contributions", lambda c: c.select(_ID, F.coalesce(F.nullif("end_date", F.lit("")), F.col("start_date")).alias("end_date")))
_add("d_year_filter", "SELECT row_id FROM contributions WHERE year(try_cast(start_date AS DATE)) >= 2025", lambda c: c.filter(F.year(F.try_to_date("start_date", "yyyy-MM-dd")) >= 2025).select(_ID))
_add("m_bucket", "SELECT row_id, CASE WHEN amount >= 100000 THEN '100k and more' WHEN amount >= 10000 THEN '10k to 100k' WHEN amount >= 1000 THEN '1k to 10k' ELSE 'under 1k' END AS tier FROM contributions", lambda c: c.select(_ID, values.tier(F.col("amount")).alias("tier")))
_add("m_contrib_category", "SELECT row_id, CASE WHEN amount IS NULL THEN 'unitemized' WHEN amount <= 100 THEN 'up to 100' WHEN amount < 5000 THEN 'under 5000' ELSE '5000 and more' END AS category FROM contributions", lambda c: c.select(_ID, F.when(F.col("amount").isNull(), "unitemized").when(F.col("amount") <= 100, "up to 100").when(F.col("amount") < 5000, "under 5000").otherwise("5000 and more").alias("category")))
_add("m_tier_label", f"SELECT row_id, CASE WHEN {_KIND_SQL} <> 'individual' THEN {_KIND_SQL} WHEN amount >= 100000 THEN '100k and more' WHEN amount >= 10000 THEN '10k to 100k' WHEN amount >= 1000 THEN '1k to 10k' ELSE 'under 1k' END AS label FROM contributions", lambda c: c.select(_ID, F.when(donor_type(c) != "individual", donor_type(c)).otherwise(values.tier(F.col("amount"))).alias("label")))
_add("h_dedup_md5", "SELECT row_id, md5(concat_ws('|', coalesce(start_date, ''), coalesce(upper(strip(contributor_name)), ''), coalesce(recipient_committee_id, ''), coalesce(contributor_zip_code, ''))) AS dedup FROM contributions", lambda c: c.select(_ID, values.dedup_key(F.col("start_date"), F.upper(strip(F.col("contributor_name"))), F.col("recipient_committee_id"), F.col("contributor_zip_code")).alias("dedup")))
_add("h_name_id", "SELECT DISTINCT contributor_name, substr(sha256(coalesce(contributor_name, '')), 1, 8) AS name_id FROM contributions", lambda c: c.select("contributor_name").distinct().withColumn("name_id", F.substring(F.sha2(F.coalesce("contributor_name", F.lit("")), 256), 1, 8)))
