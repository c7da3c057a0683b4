"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import is_organisation, normalize_name
from tallyloom.operators import joins as J
from tallyloom.operators.groups import best_row, first_rows
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()
add = registry.add


def _list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "running_list").select("name_norm", F.col("level1_category").alias("l_category"), F.col("naics_code").alias("l_code"), F.col("list_source").alias("l_source"), "ref_id")


@add("join_lookup_left", "SELECT e.employer_id, r.naics_code AS l_code, r.list_source AS l_source FROM employers e LEFT JOIN running_list r ON e.employer_norm = r.name_norm")
def join_lookup_left(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").select("employer_id", F.col("employer_norm").alias("name_norm"))
    return J.lookup(e, _list(spark, d), "name_norm", ["l_code", "l_source"], F.col("ref_id")).select("employer_id", "l_code", "l_source")


@add(
    "join_lookup_typed",
    """SELECT c.name_id, r.level1_category AS l_category FROM contributors c LEFT JOIN running_list r ON r.name_norm =
       CASE WHEN c.entity_kind = 'organization' THEN norm(c.contributor_name) WHEN upper(coalesce(c.contributor_employer, '')) NOT IN ('NOT EMPLOYED', 'RETIRED', 'SELF-EMPLOYED', 'N/A', '') THEN norm(c.contributor_employer) END""",
)
def join_lookup_typed(spark: SparkSession, d: str) -> DataFrame:
    skip = F.upper(F.coalesce("contributor_employer", F.lit(""))).isin("NOT EMPLOYED", "RETIRED", "SELF-EMPLOYED", "N/A", "")
    key = F.when(F.col("entity_kind") == "organization", normalize_name(F.col("contributor_name"))).when(~skip, normalize_name(F.col("contributor_employer")))
    c = table(spark, d, "contributors").select("name_id", key.alias("name_norm"))
    return J.lookup(c, _list(spark, d), "name_norm", ["l_category"], F.col("ref_id")).select("name_id", "l_category")


@add(
    "join_multi_key",
    """SELECT c.row_id, d.name_id FROM contributions c LEFT JOIN (SELECT contributor_name, coalesce(contributor_employer, '') AS e, min(name_id) AS name_id FROM contributors GROUP BY 1, 2) d
       ON c.contributor_name = d.contributor_name AND coalesce(c.contributor_employer, '') = d.e""",
)
def join_multi_key(spark: SparkSession, d: str) -> DataFrame:
    key = F.coalesce("contributor_employer", F.lit("")).alias("e")
    donors = table(spark, d, "contributors").select("contributor_name", key, "name_id").groupBy("contributor_name", "e").agg(F.min("name_id").alias("name_id"))
    return table(spark, d, "contributions").select("row_id", "contributor_name", key).join(donors, ["contributor_name", "e"], "left").select("row_id", "name_id")


@add(
    "join_employer_dual_source",
    """WITH both_sources AS (SELECT norm(contributor_name) AS k, 1 AS p, contributor_city AS v, name_id AS s FROM contributors WHERE entity_kind = 'organization' AND contributor_city IS NOT NULL
       UNION ALL SELECT employer_norm, 2, employer_city, employer_id FROM employers WHERE employer_city IS NOT NULL),
       one AS (SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, s) AS r FROM both_sources) WHERE r = 1)
       SELECT l.edd_id, one.v AS city_found FROM edd_listings l LEFT JOIN one ON norm(l.edd_match_name) = one.k""",
)
def join_employer_dual_source(spark: SparkSession, d: str) -> DataFrame:
    orgs = table(spark, d, "contributors").filter("entity_kind = 'organization' AND contributor_city IS NOT NULL")
    a = orgs.select(normalize_name(F.col("contributor_name")).alias("k"), F.lit(1).alias("p"), F.col("contributor_city").alias("city_found"), F.col("name_id").alias("s"))
    b = table(spark, d, "employers").filter("employer_city IS NOT NULL").select(F.col("employer_norm").alias("k"), F.lit(2).alias("p"), F.col("employer_city").alias("city_found"), F.col("employer_id").alias("s"))
    one = best_row(a.unionByName(b), ["k"], F.struct(-F.col("p"), -F.col("s"))).select("k", "city_found")
    return table(spark, d, "edd_listings").select("edd_id", normalize_name(F.col("edd_match_name")).alias("k")).join(one, "k", "left").select("edd_id", "city_found")


@add("join_dict_map", "SELECT name_id, CASE contributor_state WHEN 'CA' THEN 'home' WHEN 'WA' THEN 'north' WHEN 'NV' THEN 'east' END AS region FROM contributors")
def join_dict_map(spark: SparkSession, d: str) -> DataFrame:
    names = spark.createDataFrame([("CA", "home"), ("WA", "north"), ("NV", "east")], "contributor_state string, region string")
    return table(spark, d, "contributors").select("name_id", "contributor_state").join(F.broadcast(names), "contributor_state", "left").select("name_id", "region")


@add("join_bridge", "SELECT d.doc_id, f.naml, c.n FROM documents d JOIN filers f ON d.committee_id = f.filer_id JOIN (SELECT recipient_committee_id AS k, count(*) AS n FROM contributions GROUP BY 1) c ON c.k = f.filer_id")
def join_bridge(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "contributions").groupBy(F.col("recipient_committee_id").alias("filer_id")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "documents").select("doc_id", F.col("committee_id").alias("filer_id")).join(table(spark, d, "filers").select("filer_id", "naml"), "filer_id").join(counts, "filer_id").select("doc_id", "naml", "n")


@add("join_id_xref", "SELECT f.filer_id, x.naml AS xref_name FROM filers f LEFT JOIN filers x ON f.xref_filer_id = x.filer_id")
def join_id_xref(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filers")
    return f.select("filer_id", F.col("xref_filer_id").alias("x")).join(f.select(F.col("filer_id").alias("x"), F.col("naml").alias("xref_name")), "x", "left").select("filer_id", "xref_name")


@add(
    "join_name_multi",
    """SELECT c.standardized_name, count(DISTINCT c.name_id) AS n_ids, count(*) AS n_rows FROM (SELECT standardized_name, name_id FROM contributors WHERE standardized_name IS NOT NULL) c
       JOIN (SELECT DISTINCT standardized_name FROM contributions) r ON c.standardized_name = r.standardized_name GROUP BY 1 HAVING count(DISTINCT c.name_id) > 1""",
)
def join_name_multi(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "contributors").filter("standardized_name IS NOT NULL").select("standardized_name", "name_id")
    used = table(spark, d, "contributions").select("standardized_name").distinct()
    return ids.join(used, "standardized_name", "left_semi").groupBy("standardized_name").agg(F.count_distinct("name_id").alias("n_ids"), F.count(F.lit(1)).alias("n_rows")).filter("n_ids > 1")


@add("join_prefix_longest", """SELECT l.edd_id, (SELECT max_by(s.v, length(s.p)) FROM (SELECT naics_code AS p, min(level2_category) AS v FROM running_list WHERE naics_code IS NOT NULL AND level2_category IS NOT NULL GROUP BY 1) s WHERE starts_with(l.edd_naics_code, s.p)) AS sector FROM edd_listings l""")
def join_prefix_longest(spark: SparkSession, d: str) -> DataFrame:
    rules = table(spark, d, "running_list").filter("naics_code IS NOT NULL AND level2_category IS NOT NULL").groupBy("naics_code").agg(F.min("level2_category").alias("sector"))
    return J.prefix_longest(table(spark, d, "edd_listings").select("edd_id", "edd_naics_code"), rules, "edd_naics_code", "naics_code", "sector").select("edd_id", "sector")


@add("join_semi_in", "SELECT row_id FROM contributions WHERE recipient_committee_id IN (SELECT filer_id FROM filers WHERE filer_status = 'ACTIVE')")
def join_semi_in(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "filers").filter("filer_status = 'ACTIVE'").select(F.col("filer_id").alias("recipient_committee_id"))
    return table(spark, d, "contributions").select("row_id", "recipient_committee_id").join(active, "recipient_committee_id", "left_semi").select("row_id")


@add("join_anti", "SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM filers f WHERE f.filer_id = d.committee_id AND f.filer_status = 'ACTIVE')")
def join_anti(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "filers").filter("filer_status = 'ACTIVE'").select(F.col("filer_id").alias("committee_id"))
    return J.not_in(table(spark, d, "documents").select("doc_id", "committee_id"), active, ["committee_id"]).select("doc_id")


@add("join_broadcast_back", "SELECT row_id, count(*) OVER (PARTITION BY standardized_name) AS n_rows, round(sum(amount) OVER (PARTITION BY standardized_name), 2) AS total FROM contributions WHERE standardized_name IS NOT NULL")
def join_broadcast_back(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributions").filter("standardized_name IS NOT NULL").select("row_id", "standardized_name", "amount")
    totals = c.groupBy("standardized_name").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount"), 2).alias("total"))
    return c.join(totals, "standardized_name").select("row_id", "n_rows", "total")


@add("join_search_key_expand", "SELECT c.name_id, w.confidence FROM contributors c JOIN (SELECT contributor_name, min(lower(confidence)) AS confidence FROM web_search_cache GROUP BY 1) w ON c.contributor_name = w.contributor_name")
def join_search_key_expand(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "web_search_cache").groupBy("contributor_name").agg(F.min(F.lower("confidence")).alias("confidence"))
    return table(spark, d, "contributors").select("name_id", "contributor_name").join(found, "contributor_name").select("name_id", "confidence")


@add(
    "join_csv_enrich",
    """SELECT e.employer_id, CASE WHEN norm(e.employer) = '' THEN 'empty_query' WHEN l.k IS NULL THEN 'no_match' ELSE 'found' END AS status, l.code FROM employers e
       LEFT JOIN (SELECT norm(edd_match_name) AS k, min(edd_naics_code) AS code FROM edd_listings GROUP BY 1) l ON norm(e.employer) = l.k""",
)
def join_csv_enrich(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "edd_listings").groupBy(normalize_name(F.col("edd_match_name")).alias("k")).agg(F.min("edd_naics_code").alias("code"), F.lit(True).alias("hit"))
    e = table(spark, d, "employers").select("employer_id", normalize_name(F.col("employer")).alias("k"))
    return e.join(listed, "k", "left").select("employer_id", F.when(F.col("k") == "", "empty_query").when(F.col("hit").isNull(), "no_match").otherwise("found").alias("status"), "code")


@add(
    "join_explode_split",
    """WITH s AS (SELECT recipient_committee_id AS k, office, sum(amount) AS a, sum(sum(amount)) OVER (PARTITION BY recipient_committee_id) AS t FROM contributions WHERE amount > 0 AND office IS NOT NULL GROUP BY 1, 2)
       SELECT f.filer_id, s.office, round(1000 * s.a / s.t, 2) AS part FROM filers f JOIN s ON s.k = f.filer_id""",
)
def join_explode_split(spark: SparkSession, d: str) -> DataFrame:
    from tallyloom.operators.groups import shares

    s = shares(table(spark, d, "contributions").filter("amount > 0 AND office IS NOT NULL"), ["recipient_committee_id"], ["office"], "amount")
    return table(spark, d, "filers").select(F.col("filer_id"), F.col("filer_id").alias("recipient_committee_id")).join(s, "recipient_committee_id").select("filer_id", "office", F.round(1000 * F.col("amount") / F.col("total"), 2).alias("part"))


@add(
    "join_multi_source",
    """SELECT e.employer_id, r.naics_code AS by_list, l.code AS by_register, w.n AS n_searches FROM employers e LEFT JOIN running_list r ON r.name_norm = e.employer_norm
       LEFT JOIN (SELECT edd_match_name AS k, min(edd_naics_code) AS code FROM edd_listings GROUP BY 1) l ON l.k = e.employer_norm
       LEFT JOIN (SELECT norm(contributor_employer) AS k, count(*) AS n FROM web_search_cache WHERE contributor_employer IS NOT NULL GROUP BY 1) w ON w.k = e.employer_norm""",
)
def join_multi_source(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").select("employer_id", F.col("employer_norm").alias("k"))
    r = table(spark, d, "running_list").select(F.col("name_norm").alias("k"), F.col("naics_code").alias("by_list"))
    l = table(spark, d, "edd_listings").groupBy(F.col("edd_match_name").alias("k")).agg(F.min("edd_naics_code").alias("by_register"))
    w = table(spark, d, "web_search_cache").filter("contributor_employer IS NOT NULL").groupBy(normalize_name(F.col("contributor_employer")).alias("k")).agg(F.count(F.lit(1)).alias("n_searches"))
    return e.join(r, "k", "left").join(l, "k", "left").join(w, "k", "left").drop("k")


@add(
    "join_ml_unit_key",
    """SELECT c.row_id, u.n_units FROM (SELECT row_id, CASE WHEN coalesce(contributor_occupation, '') = '' THEN contributor_name ELSE coalesce(contributor_employer, '') || '|' || contributor_occupation END AS k FROM contributions) c
       JOIN (SELECT CASE WHEN entity_kind = 'organization' THEN contributor_name ELSE coalesce(contributor_employer, '') || '|' || coalesce(contributor_occupation, '') END AS k, count(*) AS n_units FROM contributors GROUP BY 1) u ON c.k = u.k""",
)
def join_ml_unit_key(spark: SparkSession, d: str) -> DataFrame:
    e, o = F.coalesce("contributor_employer", F.lit("")), F.coalesce("contributor_occupation", F.lit(""))
    pair = F.concat(e, F.lit("|"), o)
    units = table(spark, d, "contributors").groupBy(F.when(F.col("entity_kind") == "organization", F.col("contributor_name")).otherwise(pair).alias("k")).agg(F.count(F.lit(1)).alias("n_units"))
    return table(spark, d, "contributions").select("row_id", F.when(o == "", F.col("contributor_name")).otherwise(pair).alias("k")).join(units, "k").select("row_id", "n_units")


@add(
    "join_dup_rank",
    """SELECT a.row_id, b.name_id FROM (SELECT row_id, standardized_name AS k, row_number() OVER (PARTITION BY standardized_name ORDER BY row_id) AS r FROM contributions WHERE standardized_name IS NOT NULL) a
       LEFT JOIN (SELECT name_id, standardized_name AS k, row_number() OVER (PARTITION BY standardized_name ORDER BY name_id) AS r FROM contributors WHERE standardized_name IS NOT NULL) b ON a.k = b.k AND a.r = b.r""",
)
def join_dup_rank(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "contributions").filter("standardized_name IS NOT NULL").select("row_id", "standardized_name")
    b = table(spark, d, "contributors").filter("standardized_name IS NOT NULL").select("name_id", "standardized_name")
    return J.kth_to_kth(a, b, ["standardized_name"], [F.col("row_id")], [F.col("name_id")]).select("row_id", "name_id")


@add(
    "join_keyed_correction",
    """SELECT l.edd_id, coalesce(a.v, b.v) AS category FROM edd_listings l LEFT JOIN (SELECT naics_code AS k, min(level2_category) AS v FROM running_list WHERE level2_category IS NOT NULL GROUP BY 1) a ON left(l.edd_naics_code, 4) = a.k
       LEFT JOIN (SELECT left(naics_code, 2) AS k, min(level1_category) AS v FROM running_list WHERE level1_category IS NOT NULL GROUP BY 1) b ON left(l.edd_naics_code, 2) = b.k""",
)
def join_keyed_correction(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "running_list")
    fine = r.filter("level2_category IS NOT NULL").groupBy(F.col("naics_code").alias("f")).agg(F.min("level2_category").alias("v"))
    broad = r.filter("level1_category IS NOT NULL").groupBy(F.substring("naics_code", 1, 2).alias("b")).agg(F.min("level1_category").alias("w"))
    l = table(spark, d, "edd_listings").select("edd_id", F.substring("edd_naics_code", 1, 4).alias("f"), F.substring("edd_naics_code", 1, 2).alias("b"))
    return l.join(fine, "f", "left").join(broad, "b", "left").select("edd_id", F.coalesce("v", "w").alias("category"))


@add("join_range", "SELECT a.event_id AS id_a, b.event_id AS id_b FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id < b.event_id AND abs(a.value - b.value) <= 0.5")
def join_range(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    a, b = (e.select("user_id", F.col("event_id").alias(f"id_{x}"), F.col("value").alias(x)) for x in "ab")
    return J.banded_pairs(a, b, ["user_id"], "a", "b", 0.5).filter("id_a < id_b").select("id_a", "id_b")


@add("set_union_all", "SELECT contributor_name AS name, contributor_city AS city FROM contributors UNION ALL SELECT employer, employer_city FROM employers")
def set_union_all(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "contributors").select(F.col("contributor_name").alias("name"), F.col("contributor_city").alias("city"))
    return a.unionByName(table(spark, d, "employers").select(F.col("employer").alias("name"), F.col("employer_city").alias("city")))


@add("set_union_distinct", "SELECT upper(contributor_city) AS city FROM contributors UNION SELECT upper(employer_city) FROM employers")
def set_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    return J.union_distinct(table(spark, d, "contributors").select(F.upper("contributor_city").alias("city")), table(spark, d, "employers").select(F.upper("employer_city").alias("city")))


@add("set_difference", "SELECT contributor_zip_code AS zip FROM contributors EXCEPT SELECT zip_code FROM edd_listings")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select(F.col("contributor_zip_code").alias("zip")).subtract(table(spark, d, "edd_listings").select("zip_code"))


@add("set_intersect", "SELECT employer_norm AS name FROM employers INTERSECT SELECT name_norm FROM running_list")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "employers").select(F.col("employer_norm").alias("name")).intersect(table(spark, d, "running_list").select("name_norm"))


@add("set_distinct_rows", "SELECT DISTINCT contributor_name, contributor_city, contributor_state FROM contributors")
def set_distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select("contributor_name", "contributor_city", "contributor_state").distinct()


@add("set_distinct_cols", "SELECT contributor_name, name_id FROM (SELECT *, row_number() OVER (PARTITION BY contributor_name ORDER BY name_id) AS r FROM contributors) WHERE r = 1")
def set_distinct_cols(spark: SparkSession, d: str) -> DataFrame:
    return first_rows(table(spark, d, "contributors").select("contributor_name", "name_id"), ["contributor_name"], F.col("name_id"))


@add("set_distinct_ci", "SELECT employer, employer_id FROM (SELECT *, row_number() OVER (PARTITION BY lower(employer) ORDER BY employer_id) AS r FROM employers) WHERE r = 1")
def set_distinct_ci(spark: SparkSession, d: str) -> DataFrame:
    return J.distinct_ignoring_case(table(spark, d, "employers").select("employer", "employer_id"), ["employer"], F.col("employer_id"))


@add("s_org_detector_by_kind", "SELECT entity_kind, count(*) AS n FROM contributors WHERE regexp_matches(upper(contributor_name), '\\b(INC|LLC|CORP)\\b') GROUP BY 1")
def s_org_detector_by_kind(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors")
    return c.filter(is_organisation(F.col("contributor_name")) & F.upper("contributor_name").rlike(r"\b(INC|LLC|CORP)\b")).groupBy("entity_kind").agg(F.count(F.lit(1)).alias("n"))
