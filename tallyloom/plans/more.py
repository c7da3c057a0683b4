"""Further queries of the inventory: fuzzy joins, cascades of models and rules, caches and labels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import similarity, text, values
from tallyloom.functions.rewrites import strip
from tallyloom.operators import entities as E
from tallyloom.operators import learning as L
from tallyloom.operators import rules as R
from tallyloom.operators.groups import first_rows, mode_by
from tallyloom.plans.registry import Registry
from tallyloom.plans.rules import KEYWORDS, PATTERNS
from tallyloom.session import shared_dir, table
from tallyloom.sources import files

registry = Registry()
add = registry.add


def _on(name: str, source: str, sql: str | None, f) -> None:
    registry.add(name, sql)(lambda spark, d: f(table(spark, d, source)))


@add("src_tsv_chunked", "SELECT filer_id, filer_status FROM filers WHERE filer_status IS NOT NULL")
def src_tsv_chunked(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tsv-{uuid.uuid4().hex}"
    f = table(spark, d, "filers").filter("filer_status IS NOT NULL").select("filer_id", F.coalesce("filer_type", F.lit("-")).alias("filer_type"), "filer_status")
    f.toDF(" Filer.Id ", "Filer.Type", "FILER  STATUS").write.option("header", True).option("sep", "\t").csv(path)
    wide = files.read_tsv(spark, path, ["filer_id", "filer_type", "filer_status"], "UTF-8")
    return wide.select("filer_id", "filer_status")  # only these columns are parsed


@add("sink_index_append", "SELECT name_norm AS name FROM running_list UNION SELECT employer_norm FROM employers")
def sink_index_append(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    files.append_new(table(spark, d, "running_list").select(F.col("name_norm").alias("name")), path, "name")
    files.append_new(table(spark, d, "employers").select(F.col("employer_norm").alias("name")), path, "name")
    return spark.read.parquet(path)


@add("cfg_vs_contract", "SELECT filer_id, naml FROM filers")
def cfg_vs_contract(spark: SparkSession, d: str) -> DataFrame:
    return files.require_columns(table(spark, d, "filers"), ["filer_id", "naml"]).select("filer_id", "naml")


_FUZZY = "WITH e AS (SELECT DISTINCT employer_norm AS a, left(employer_norm, 4) AS h FROM employers), p AS (SELECT a, ref_id, jaro_winkler_similarity(a, name_norm) AS s FROM e JOIN running_list r ON left(r.name_norm, 4) = e.h) SELECT a AS employer_norm, arg_max(ref_id, (round(s, 9), -ref_id)) AS ref_id FROM p WHERE s >= 0.95 GROUP BY 1"


_on("ord_status_queue", "filers", "SELECT filer_id FROM filers ORDER BY filer_status = 'ACTIVE' DESC, naml, filer_id", lambda f: f.orderBy(F.desc(F.col("filer_status") == "ACTIVE"), F.asc_nulls_last("naml"), "filer_id").select("filer_id"))
_PRIO = "CASE list_source WHEN 'manual' THEN 3 WHEN 'opensecrets' THEN 2 ELSE 1 END"
_on("ord_priority_stable", "running_list", f"SELECT level1_category, ref_id FROM (SELECT level1_category, ref_id, row_number() OVER (PARTITION BY level1_category ORDER BY {_PRIO} DESC, ref_id) AS r FROM running_list) WHERE r <= 3", lambda r: first_rows(r.select("level1_category", "ref_id", "list_source"), ["level1_category"], F.desc(F.when(F.col("list_source") == "manual", 3).when(F.col("list_source") == "opensecrets", 2).otherwise(1)), F.col("ref_id"), n=3).select("level1_category", "ref_id"))
_on("lim_max_rows", "contributors", "SELECT name_id FROM contributors ORDER BY name_id LIMIT 25", lambda c: c.orderBy("name_id").limit(25).select("name_id"))
_IDLE = "('NOT EMPLOYED', 'NONE', 'N A', 'RETIRED', 'UNEMPLOYED')"
_on("s_normalize_employer_key", "contributors", f"SELECT name_id, CASE WHEN norm(contributor_employer) IN {_IDLE} THEN '' ELSE norm(contributor_employer) END AS value FROM contributors", lambda c: c.select("name_id", F.when(text.normalize_name(F.col("contributor_employer")).isin("NOT EMPLOYED", "NONE", "N A", "RETIRED", "UNEMPLOYED"), "").otherwise(text.normalize_name(F.col("contributor_employer"))).alias("value")))
_on("m_ratio_guard", "contributions", "SELECT office, round(count(contributor_id) / greatest(count(contributor_employer), 1), 6) AS ratio FROM contributions GROUP BY 1", lambda c: c.groupBy("office").agg(F.round(values.ratio(F.count("contributor_id"), F.count("contributor_employer")), 6).alias("ratio")))
_on("m_conf_cut", "embeddings", "SELECT vec_id, CASE WHEN label / 10.0 >= 0.75 THEN 0.75::DOUBLE WHEN label / 10.0 >= 0.5 THEN 0.5 WHEN label / 10.0 >= 0.25 THEN 0.25 WHEN label / 10.0 >= 0 THEN 0.0 END AS bin FROM embeddings", lambda e: e.select("vec_id", values.confidence_bin(F.col("label") / 10.0).alias("bin")))
_on("h_names_sha256", "running_list", "SELECT sha256(string_agg(name_norm, chr(10) ORDER BY name_norm)) AS cache_key FROM running_list", lambda r: r.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("name_norm")), "\n"), 256).alias("cache_key")))
_on("a_list_result", "contributors", "SELECT name_id, contributor_city AS city, contributor_state AS state FROM contributors", lambda c: c.select("name_id", F.struct(F.col("contributor_city").alias("city"), F.col("contributor_state").alias("state")).alias("r")).select("name_id", "r.*"))
_on("j_state", "events", "SELECT event_id, coalesce(CAST(json_extract_string(props, '$.missing') AS BIGINT), 0) AS value FROM events", lambda e: e.select("event_id", F.coalesce(values.json_field(F.col("props"), "missing").cast("bigint"), F.lit(0).cast("bigint")).alias("value")))
_on("j_paged_rows", "filers", "SELECT filer_id FROM filers", lambda f: files.json_pages(f.select(F.to_json(F.struct(F.array(F.lit("filer_id")).alias("columns"), F.array(F.array("filer_id")).alias("rows"))).alias("page"))).select(F.col("fields")["filer_id"].alias("filer_id")))




def _case(column: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{v}'" for p, v in rules) + " END"


_WORDS = [(rf"(?i)\b{k}\b", v) for k, v in sorted(KEYWORDS, key=lambda x: -len(x[0]))]


@add("cl_resolver", f"SELECT name_id, coalesce({_case('contributor_employer', _WORDS)}, {_case('contributor_occupation', _WORDS)}, {_case('upper(contributor_employer)', PATTERNS)}, 'other') AS code FROM contributors")
def cl_resolver(spark: SparkSession, d: str) -> DataFrame:
    e, o = F.col("contributor_employer"), F.col("contributor_occupation")
    return table(spark, d, "contributors").select("name_id", F.coalesce(R.longest_keyword(e, KEYWORDS), R.longest_keyword(o, KEYWORDS), R.first_match(F.upper(e), PATTERNS), F.lit("other")).alias("code"))


@add("cl_manual_ingest", "SELECT k, min(c) AS code FROM (SELECT norm(contributor_employer) AS k, contributor_occupation AS c, count(*) AS n, max(count(*)) OVER (PARTITION BY norm(contributor_employer)) AS m FROM contributors WHERE contributor_occupation IS NOT NULL AND norm(contributor_employer) <> '' GROUP BY 1, 2) WHERE n = m GROUP BY 1")
def cl_manual_ingest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").select(text.normalize_name(F.col("contributor_employer")).alias("k"), F.col("contributor_occupation").alias("c")).filter("k <> ''")
    return mode_by(c, ["k"], "c", name="code")


@add("cl_custom_masterfile", f"SELECT ref_id, coalesce({_case('name_norm', PATTERNS[::-1])}, level1_category, '99') AS category FROM running_list")
def cl_custom_masterfile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "running_list").select("ref_id", F.coalesce(R.last_match(F.col("name_norm"), PATTERNS, F.col("level1_category")), F.lit("99")).alias("category"))


_on("rs_code_override", "employers", "SELECT employer_id, CASE WHEN data_source_1 = 'masterfile' THEN naics_code WHEN employer_norm LIKE '%UNION%' THEN '8139' ELSE naics_code END AS code FROM employers", lambda e: e.select("employer_id", F.when(F.col("data_source_1") == "masterfile", F.col("naics_code")).when(F.col("employer_norm").contains("UNION"), "8139").otherwise(F.col("naics_code")).alias("code")))


@add("rs_sub100", "SELECT c.name_id, s.sub FROM contributors c LEFT JOIN (SELECT standardized_name, min(contributor_occupation) AS sub FROM contributors WHERE upper(contributor_occupation) IN ('RETIRED', 'NOT EMPLOYED') GROUP BY 1) s ON c.standardized_name = s.standardized_name")
def rs_sub100(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors")
    s = c.filter(F.upper("contributor_occupation").isin("RETIRED", "NOT EMPLOYED")).groupBy("standardized_name").agg(F.min("contributor_occupation").alias("sub"))
    return c.select("name_id", "standardized_name").join(s, "standardized_name", "left").select("name_id", "sub")


_on("rs_pre_guard", "employers", "SELECT employer_id, naics_code IS NULL AND NOT coalesce(regexp_matches(data_source_1, 'masterfile|manual'), false) AS flagged FROM employers", lambda e: e.select("employer_id", (F.col("naics_code").isNull() & ~F.coalesce(F.col("data_source_1").rlike("masterfile|manual"), F.lit(False))).alias("flagged")))


@add("ml_classify_cascade")
def ml_classify_cascade(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "running_list").select(F.lower("name_norm").alias("text"), "level1_category")
    e = table(spark, d, "employers").select("employer_id", "employer", F.lower("employer_norm").alias("text"))
    p = L.predict(L.train_classifier(r, "text", "level1_category"), e, "employer_id", "text").select("employer_id", "label", "confidence")
    both = e.select("employer_id", R.longest_keyword(F.col("employer"), KEYWORDS).alias("word")).join(p, "employer_id")
    yes = F.lit(True)
    return both.select("employer_id", R.waterfall(R.stage(yes, F.col("word"), "keyword"), R.stage(F.col("confidence") >= 0.4, F.col("label"), "model"), R.stage(yes, F.lit("99"), "fallback")).alias("r")).select("employer_id", "r.value", "r.source")


_on("ml_special_case", "contributors", "SELECT name_id, CASE WHEN upper(strip(coalesce(contributor_occupation, ''))) IN ('RETIRED', 'NOT EMPLOYED', 'HOMEMAKER', 'STUDENT') THEN 1.0::DOUBLE END AS confidence FROM contributors", lambda c: c.select("name_id", F.when(F.upper(strip(F.coalesce("contributor_occupation", F.lit("")))).isin("RETIRED", "NOT EMPLOYED", "HOMEMAKER", "STUDENT"), 1.0).alias("confidence")))


_STACK = f"SELECT e.employer_id, coalesce({_case('e.employer', _WORDS)}, r.level1_category) AS stack, e.level1_category AS truth FROM employers e LEFT JOIN running_list r ON r.name_norm = e.employer_norm WHERE e.level1_category IS NOT NULL"


@add("ml_loo", "WITH e AS (SELECT employer_id, employer_norm AS k, level1_category AS v FROM employers WHERE level1_category IS NOT NULL), v AS (SELECT a.employer_id, a.v AS truth, b.v, count(*) AS n FROM e a JOIN e b ON a.k = b.k AND a.employer_id <> b.employer_id GROUP BY 1, 2, 3), w AS (SELECT employer_id, truth, arg_max(v, (n, v)) AS guess FROM v GROUP BY 1, 2) SELECT count(*) AS n, count(CASE WHEN truth = guess THEN 1 END) AS hits FROM w")
def ml_loo(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").filter("level1_category IS NOT NULL").select("employer_id", F.col("employer_norm").alias("k"), F.col("level1_category").alias("v"))
    counts = e.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    # each row against the counts of its name without itself
    others = e.withColumnRenamed("v", "truth").join(counts, "k").withColumn("n", F.col("n") - (F.col("v") == F.col("truth")).cast("bigint")).filter("n > 0")
    guess = others.groupBy("employer_id", "truth").agg(F.max(F.struct("n", "v")).alias("b"))
    return guess.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("b.v") == F.col("truth"), 1)).alias("hits"))


@add("llm_expand_full", "SELECT c.row_id, k.name_id FROM contributions c JOIN (SELECT contributor_name, contributor_employer, min(name_id) AS name_id FROM contributors WHERE contributor_employer IS NOT NULL GROUP BY 1, 2) k ON c.contributor_name = k.contributor_name AND c.contributor_employer = k.contributor_employer")
def llm_expand_full(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "contributors").filter("contributor_employer IS NOT NULL").groupBy("contributor_name", "contributor_employer").agg(F.min("name_id").alias("name_id"))
    return table(spark, d, "contributions").select("row_id", "contributor_name", "contributor_employer").join(k, ["contributor_name", "contributor_employer"]).select("row_id", "name_id")
