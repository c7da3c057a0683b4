"""Classification by ordered rules, reference lists and priors; reconciliation of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import normalize_name
from tallyloom.operators import rules as R
from tallyloom.operators.groups import best_row, mode_by
from tallyloom.operators.joins import not_in, prefix_longest
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()
add = registry.add

#: Example rules of the queries here; real lists come as tables or parameters.
KEYWORDS = [("bank", "Finance"), ("credit union", "Finance"), ("law", "Lawyers"), ("law offices", "Lawyers"), ("hospital", "Health"), ("dental", "Health"), ("school", "Education"), ("unified school district", "Education"), ("union", "Labor")]
PATTERNS = [(r"\bSERVICES?\b", "Services"), (r"\bFARM|RANCH|VINEYARD", "Agribusiness"), (r"\bREALTY|PROPERTY\b", "Real Estate")]


def _case(column: str, rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{v}'" for p, v in rules) + " END"


_LONGEST = [(rf"(?i)\b{k}\b", v) for k, v in sorted(KEYWORDS, key=lambda x: -len(x[0]))]


@add("cl_keyword_longest", f"SELECT employer_id, {_case('employer', _LONGEST)} AS category FROM employers")
def cl_keyword_longest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "employers").select("employer_id", R.longest_keyword(F.col("employer"), KEYWORDS).alias("category"))


@add("cl_keyword_join", f"SELECT employer_id, {_case('employer', _LONGEST)} AS value FROM employers WHERE {_case('employer', _LONGEST)} IS NOT NULL")
def cl_keyword_join(spark: SparkSession, d: str) -> DataFrame:
    return R.keywords_by_join(table(spark, d, "employers"), "employer_id", "employer", spark.createDataFrame(KEYWORDS, "keyword string, value string")).select("employer_id", "value")


@add(
    "cl_keyword_by_column",
    f"SELECT name_id, coalesce({_case('contributor_name', _LONGEST)}, {_case('contributor_employer', _LONGEST)}, {_case('contributor_occupation', _LONGEST)}) AS category FROM contributors",
)
def cl_keyword_by_column(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select("name_id", F.coalesce(*[R.longest_keyword(F.col(c), KEYWORDS) for c in ("contributor_name", "contributor_employer", "contributor_occupation")]).alias("category"))


@add("cl_keyword_category", f"SELECT employer_id, CASE WHEN contains(employer_norm, 'CASINO') THEN NULL ELSE {_case('employer_norm', PATTERNS)} END AS category FROM employers")
def cl_keyword_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "employers").select("employer_id", F.when(~F.col("employer_norm").contains("CASINO"), R.first_match(F.col("employer_norm"), PATTERNS)).alias("category"))


@add("cl_regex_override_last", f"SELECT employer_id, coalesce({_case('employer_norm', PATTERNS[::-1])}, level1_category) AS category FROM employers")
def cl_regex_override_last(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "employers").select("employer_id", R.last_match(F.col("employer_norm"), PATTERNS, F.col("level1_category")).alias("category"))


_NONE = "('', 'NONE', 'N A', 'NOT EMPLOYED')"


@add("cl_identity_none", f"SELECT name_id, CASE WHEN entity_kind = 'individual' AND norm(contributor_employer) IN {_NONE} THEN '100' END AS code FROM contributors")
def cl_identity_none(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select("name_id", F.when((F.col("entity_kind") == "individual") & normalize_name(F.col("contributor_employer")).isin("", "NONE", "N A", "NOT EMPLOYED"), "100").alias("code"))


@add("cl_unitemized", "SELECT row_id, CASE WHEN norm(contributor_name) = 'UNITEMIZED CONTRIBUTIONS' OR amount IS NULL THEN '101' END AS code FROM contributions")
def cl_unitemized(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributions").select("row_id", F.when((normalize_name(F.col("contributor_name")) == "UNITEMIZED CONTRIBUTIONS") | F.col("amount").isNull(), "101").alias("code"))


@add("cl_non_company", "SELECT name_id, CASE WHEN regexp_matches(upper(contributor_occupation), 'RETIRED|STUDENT|HOMEMAKER|NOT EMPLOYED') THEN upper(regexp_extract(upper(contributor_occupation), '(RETIRED|STUDENT|HOMEMAKER|NOT EMPLOYED)', 1)) END AS status FROM contributors")
def cl_non_company(spark: SparkSession, d: str) -> DataFrame:
    o = F.upper("contributor_occupation")
    return table(spark, d, "contributors").select("name_id", F.nullif(F.regexp_extract(o, "(RETIRED|STUDENT|HOMEMAKER|NOT EMPLOYED)", 1), F.lit("")).alias("status"))


_WATER = f"""SELECT e.employer_id, coalesce(r.level1_category, {_case('e.employer', _LONGEST)}, {_case('e.employer_norm', PATTERNS)}) AS value,
   CASE WHEN r.level1_category IS NOT NULL THEN 'list' WHEN {_case('e.employer', _LONGEST)} IS NOT NULL THEN 'keyword' WHEN {_case('e.employer_norm', PATTERNS)} IS NOT NULL THEN 'pattern' END AS source
   FROM employers e LEFT JOIN running_list r ON r.name_norm = e.employer_norm"""


def _waterfall(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").select("employer_id", "employer", F.col("employer_norm").alias("name_norm"))
    listed = e.join(table(spark, d, "running_list").select("name_norm", F.col("level1_category").alias("listed")), "name_norm", "left")
    yes = F.lit(True)
    filled = R.waterfall(R.stage(yes, F.col("listed"), "list"), R.stage(yes, R.longest_keyword(F.col("employer"), KEYWORDS), "keyword"), R.stage(yes, R.first_match(F.col("name_norm"), PATTERNS), "pattern"))
    return listed.select("employer_id", filled.alias("r")).select("employer_id", "r.value", "r.source")


add("cl_waterfall", _WATER)(_waterfall)


@add("cl_fallback_99", f"SELECT employer_id, coalesce(value, '99') AS value FROM ({_WATER})")
def cl_fallback_99(spark: SparkSession, d: str) -> DataFrame:
    return _waterfall(spark, d).select("employer_id", F.coalesce("value", F.lit("99")).alias("value"))


@add("cl_crosswalk", """SELECT e.employer_id, coalesce((SELECT max_by(s.v, length(s.p)) FROM (SELECT naics_code AS p, min(naics_label) AS v FROM running_list WHERE naics_code IS NOT NULL AND naics_label IS NOT NULL GROUP BY 1) s WHERE starts_with(e.naics_code, s.p)), 'unresolved') AS label FROM employers e""")
def cl_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    rules = table(spark, d, "running_list").filter("naics_code IS NOT NULL AND naics_label IS NOT NULL").groupBy("naics_code").agg(F.min("naics_label").alias("label")).withColumnRenamed("naics_code", "prefix")
    return prefix_longest(table(spark, d, "employers").select("employer_id", "naics_code"), rules, "naics_code", "prefix", "label").select("employer_id", F.coalesce("label", F.lit("unresolved")).alias("label"))


@add("cl_partition_parent", f"SELECT employer_id, CASE WHEN left(naics_code, 2) = '52' THEN coalesce({_case('employer_norm', [('BANK', '522'), ('INSURANCE', '524')])}, '521') ELSE naics_code END AS code FROM employers")
def cl_partition_parent(spark: SparkSession, d: str) -> DataFrame:
    child = R.first_match(F.col("employer_norm"), [("BANK", "522"), ("INSURANCE", "524")], F.lit("521"))
    return table(spark, d, "employers").select("employer_id", F.when(F.substring("naics_code", 1, 2) == "52", child).otherwise(F.col("naics_code")).alias("code"))


@add("cl_old_to_new", "SELECT left(naics_code, 3) AS old, min(level2_category) AS new FROM running_list WHERE naics_code IS NOT NULL AND level2_category IS NOT NULL GROUP BY 1 HAVING count(DISTINCT level2_category) = 1")
def cl_old_to_new(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "running_list").filter("naics_code IS NOT NULL AND level2_category IS NOT NULL")
    return r.groupBy(F.substring("naics_code", 1, 3).alias("old")).agg(F.count_distinct("level2_category").alias("n"), F.min("level2_category").alias("new")).filter("n = 1").select("old", "new")


@add("cl_normalize_codes", "SELECT edd_id, CASE WHEN left(edd_naics_code, 2) IN ('31', '32', '33') THEN '31-33' WHEN left(edd_naics_code, 2) IN ('44', '45') THEN '44-45' WHEN left(edd_naics_code, 2) IN ('48', '49') THEN '48-49' ELSE left(edd_naics_code, 2) END AS sector FROM edd_listings")
def cl_normalize_codes(spark: SparkSession, d: str) -> DataFrame:
    two = F.substring("edd_naics_code", 1, 2)
    return table(spark, d, "edd_listings").select("edd_id", F.when(two.isin("31", "32", "33"), "31-33").when(two.isin("44", "45"), "44-45").when(two.isin("48", "49"), "48-49").otherwise(two).alias("sector"))


@add("cl_prior", "SELECT c.name_id, coalesce(o.naics_code, e.c) AS prior FROM contributors c LEFT JOIN occupation_list o ON norm(c.contributor_occupation) = norm(o.occupation) LEFT JOIN (SELECT name_norm, min(naics_code) AS c FROM running_list GROUP BY 1) e ON norm(c.contributor_employer) = e.name_norm")
def cl_prior(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").select("name_id", normalize_name(F.col("contributor_occupation")).alias("o"), normalize_name(F.col("contributor_employer")).alias("e"))
    o = table(spark, d, "occupation_list").select(normalize_name(F.col("occupation")).alias("o"), F.col("naics_code").alias("by_occupation"))
    e = table(spark, d, "running_list").groupBy(F.col("name_norm").alias("e")).agg(F.min("naics_code").alias("by_employer"))
    return c.join(o, "o", "left").join(e, "e", "left").select("name_id", F.coalesce("by_occupation", "by_employer").alias("prior"))


_SCORE = "CASE data_source_1 WHEN 'masterfile' THEN 0.9 WHEN 'edd' THEN 0.5 END"


@add("cl_prior_apply", f"SELECT e.employer_id, CASE WHEN r.naics_code IS NOT NULL AND ({_SCORE} IS NULL OR {_SCORE} < 0.55) AND r.naics_code IS DISTINCT FROM e.naics_code THEN r.naics_code ELSE e.naics_code END AS code FROM employers e LEFT JOIN running_list r ON r.name_norm = e.employer_norm")
def cl_prior_apply(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").select("employer_id", F.col("employer_norm").alias("name_norm"), "naics_code", F.when(F.col("data_source_1") == "masterfile", 0.9).when(F.col("data_source_1") == "edd", 0.5).alias("conf"))
    r = table(spark, d, "running_list").select("name_norm", F.col("naics_code").alias("prior"))
    return e.join(r, "name_norm", "left").select("employer_id", R.overridden(F.col("naics_code"), F.col("conf"), F.col("prior"), 0.55).alias("code"))


@add("cl_ml_promote", "SELECT search_id, CASE WHEN lower(confidence) IN ('high', 'medium') THEN industry_summary END IS NOT NULL AS promoted FROM web_search_cache")
def cl_ml_promote(spark: SparkSession, d: str) -> DataFrame:
    score = F.when(F.lower("confidence") == "high", 0.9).when(F.lower("confidence") == "medium", 0.6).otherwise(0.1)
    return table(spark, d, "web_search_cache").select("search_id", F.when(score >= 0.3, F.col("industry_summary")).isNotNull().alias("promoted"))


@add("cl_industry_bucket", "SELECT employer_id, coalesce(level1_category, CASE left(naics_code, 2) WHEN '52' THEN 'Finance' WHEN '62' THEN 'Health' WHEN '61' THEN 'Education' END, 'Unclassified') AS bucket FROM employers")
def cl_industry_bucket(spark: SparkSession, d: str) -> DataFrame:
    two = F.substring("naics_code", 1, 2)
    return table(spark, d, "employers").select("employer_id", F.coalesce(F.col("level1_category"), F.when(two == "52", "Finance").when(two == "62", "Health").when(two == "61", "Education"), F.lit("Unclassified")).alias("bucket"))


@add("cl_manual_layer", "SELECT e.employer_id, coalesce(e.level1_category, r.level1_category) AS category, e.level1_category IS NOT NULL AND r.level1_category IS NOT NULL AND e.level1_category <> r.level1_category AS conflict FROM employers e LEFT JOIN (SELECT * FROM running_list WHERE list_source = 'manual') r ON r.name_norm = e.employer_norm")
def cl_manual_layer(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "running_list").filter("list_source = 'manual'").select("name_norm", F.col("level1_category").alias("manual"))
    e = table(spark, d, "employers").select("employer_id", F.col("employer_norm").alias("name_norm"), "level1_category").join(m, "name_norm", "left")
    differs = F.col("level1_category").isNotNull() & F.col("manual").isNotNull() & (F.col("level1_category") != F.col("manual"))
    return e.select("employer_id", F.coalesce("level1_category", "manual").alias("category"), F.coalesce(differs, F.lit(False)).alias("conflict"))


@add(
    "cl_running_list_build",
    """WITH s AS (SELECT name_norm AS n, naics_code AS c, 1 AS p FROM running_list WHERE naics_code IS NOT NULL UNION ALL SELECT employer_norm, naics_code, 2 FROM employers WHERE naics_code IS NOT NULL UNION ALL SELECT norm(edd_match_name), left(edd_naics_code, 4), 3 FROM edd_listings WHERE edd_naics_code IS NOT NULL),
       t AS (SELECT n, min(p) AS p FROM s GROUP BY 1), m AS (SELECT n, c, count(*) AS k, max(count(*)) OVER (PARTITION BY n) AS b FROM s JOIN t USING (n, p) GROUP BY 1, 2) SELECT n AS name, min(c) AS code FROM m WHERE k = b GROUP BY 1""",
)
def cl_running_list_build(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "running_list").filter("naics_code IS NOT NULL").select(F.col("name_norm").alias("name"), F.col("naics_code").alias("code"), F.lit(1).alias("p"))
    b = table(spark, d, "employers").filter("naics_code IS NOT NULL").select(F.col("employer_norm").alias("name"), F.col("naics_code").alias("code"), F.lit(2).alias("p"))
    c = table(spark, d, "edd_listings").filter("edd_naics_code IS NOT NULL").select(normalize_name(F.col("edd_match_name")).alias("name"), F.substring("edd_naics_code", 1, 4).alias("code"), F.lit(3).alias("p"))
    s = a.unionByName(b).unionByName(c)
    top = s.groupBy("name").agg(F.min("p").alias("p"))
    return mode_by(s.join(top, ["name", "p"], "left_semi"), ["name"], "code", name="code")


@add("cl_running_list_extend", "SELECT name_norm AS name FROM running_list UNION ALL SELECT DISTINCT norm(edd_match_name) FROM edd_listings WHERE norm(edd_match_name) NOT IN (SELECT name_norm FROM running_list) AND coalesce(edd_naics_code, '') <> '999990'")
def cl_running_list_extend(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "running_list").select(F.col("name_norm").alias("name"))
    new = table(spark, d, "edd_listings").filter(F.coalesce("edd_naics_code", F.lit("")) != "999990").select(normalize_name(F.col("edd_match_name")).alias("name")).distinct()
    return known.unionByName(not_in(new, known, ["name"]))


@add("cl_select_remote_match", "SELECT k AS name, arg_min(edd_id, (r, -s, edd_id)) AS edd_id FROM (SELECT norm(edd_match_name) AS k, edd_id, CASE edd_match_type WHEN 'exact' THEN 1 WHEN 'starts_with' THEN 2 ELSE 3 END AS r, coalesce(try_cast(replace(regexp_extract(coalesce(size_class, ''), '([0-9][0-9,]*)', 1), ',', '') AS BIGINT), -1) AS s FROM edd_listings) GROUP BY 1")
def cl_select_remote_match(spark: SparkSession, d: str) -> DataFrame:
    from tallyloom.functions.text import size_lower_bound

    rank = F.when(F.col("edd_match_type") == "exact", 1).when(F.col("edd_match_type") == "starts_with", 2).otherwise(3)
    l = table(spark, d, "edd_listings").select(normalize_name(F.col("edd_match_name")).alias("name"), "edd_id", rank.alias("r"), size_lower_bound(F.col("size_class")).alias("s"))
    return best_row(l, ["name"], F.struct(-F.col("r"), F.col("s"), -F.col("edd_id"))).select("name", "edd_id")


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """Codes of each employer name by three sources."""
    e = table(spark, d, "employers").select("employer_id", F.col("employer_norm").alias("name"), F.substring("naics_code", 1, 2).alias("typed"))
    r = table(spark, d, "running_list").select(F.col("name_norm").alias("name"), F.substring("naics_code", 1, 2).alias("listed"))
    l = table(spark, d, "edd_listings").groupBy(F.col("edd_match_name").alias("name")).agg(F.substring(F.min("edd_naics_code"), 1, 2).alias("registered"))
    return e.join(r, "name", "left").join(l, "name", "left")


_SRC = """(SELECT e.employer_id, left(e.naics_code, 2) AS typed, left(r.naics_code, 2) AS listed, left(l.c, 2) AS registered FROM employers e LEFT JOIN running_list r ON r.name_norm = e.employer_norm
   LEFT JOIN (SELECT edd_match_name AS n, min(edd_naics_code) AS c FROM edd_listings GROUP BY 1) l ON l.n = e.employer_norm)"""
_AGREED = "CASE WHEN typed = listed OR typed = registered THEN typed WHEN listed = registered THEN listed END"


@add("rs_agreement", f"SELECT employer_id, {_AGREED} AS code FROM {_SRC}")
def rs_agreement(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d).select("employer_id", R.agreed([(c, F.col(c)) for c in ("typed", "listed", "registered")]).alias("code"))


@add("rs_resolve_code", f"SELECT employer_id, coalesce({_AGREED}, listed, registered, typed, '99') AS code, CASE WHEN {_AGREED} IS NOT NULL THEN 'agreement' WHEN listed IS NOT NULL THEN 'list' WHEN registered IS NOT NULL THEN 'register' WHEN typed IS NOT NULL THEN 'typed' ELSE 'fallback' END AS source FROM {_SRC}")
def rs_resolve_code(spark: SparkSession, d: str) -> DataFrame:
    yes = F.lit(True)
    both = R.agreed([(c, F.col(c)) for c in ("typed", "listed", "registered")])
    r = R.waterfall(R.stage(yes, both, "agreement"), R.stage(yes, F.col("listed"), "list"), R.stage(yes, F.col("registered"), "register"), R.stage(yes, F.col("typed"), "typed"), R.stage(yes, F.lit("99"), "fallback"))
    return _sources(spark, d).select("employer_id", r.alias("r")).select("employer_id", F.col("r.value").alias("code"), "r.source")


@add("rs_post_flags", f"SELECT employer_id, concat_ws(' | ', CASE WHEN typed <> listed THEN 'list differs' END, CASE WHEN typed <> registered THEN 'register differs' END, CASE WHEN typed IS NULL THEN 'no code' END) AS reasons FROM {_SRC}")
def rs_post_flags(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d).select("employer_id", R.reasons((F.col("typed") != F.col("listed"), "list differs"), (F.col("typed") != F.col("registered"), "register differs"), (F.col("typed").isNull(), "no code")).alias("reasons"))


@add("rs_os_llm_crosswalk", "SELECT e.employer_id, coalesce(m.v, e.naics_code) AS code FROM employers e LEFT JOIN (SELECT naics_code AS k, min(level2_category) AS v FROM running_list WHERE naics_code IS NOT NULL GROUP BY 1) m ON m.k = e.naics_code")
def rs_os_llm_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "running_list").filter("naics_code IS NOT NULL").groupBy("naics_code").agg(F.min("level2_category").alias("v"))
    return table(spark, d, "employers").select("employer_id", "naics_code").join(m, "naics_code", "left").select("employer_id", F.coalesce("v", "naics_code").alias("code"))


@add(
    "rs_review_queue",
    f"""SELECT employer_norm, min(employer_id) AS employer_id FROM (SELECT employer_norm, employer_id FROM employers JOIN {_SRC} s USING (employer_id) WHERE s.typed <> s.listed OR s.typed <> s.registered
       UNION ALL SELECT employer_norm, employer_id FROM (SELECT employer_norm, employer_id FROM employers ORDER BY md5(employer_id || '|42'), employer_id LIMIT 50)) GROUP BY 1""",
)
def rs_review_queue(spark: SparkSession, d: str) -> DataFrame:
    from tallyloom.operators.groups import sample_rows

    s = _sources(spark, d)
    flagged = s.filter("typed <> listed OR typed <> registered").select(F.col("name").alias("employer_norm"), "employer_id")
    sampled = sample_rows(table(spark, d, "employers").select("employer_norm", "employer_id"), 50, "employer_id")
    return flagged.unionByName(sampled).groupBy("employer_norm").agg(F.min("employer_id").alias("employer_id"))
