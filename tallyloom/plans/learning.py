"""Text features, neighbours, prototypes and classifiers; enrichment caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.rewrites import strip
from tallyloom.operators import learning as L
from tallyloom.operators.groups import first_rows
from tallyloom.operators.joins import not_in
from tallyloom.plans.registry import Registry
from tallyloom.session import cut, table

registry = Registry()
add = registry.add
_TFIDF = """WITH w AS (SELECT ref_id AS key, lower(unnest(string_split(name_norm, ' '))) AS term FROM running_list), tf AS (SELECT key, term, 1 + ln(count(*)) AS tf FROM w WHERE term <> '' GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.9 * (SELECT count(*) FROM running_list)),
  x AS (SELECT key, term, tf * (ln((1 + (SELECT count(*) FROM running_list)) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term))"""


@add("ml_knn_vote")
def ml_knn_vote(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "running_list").filter("level1_category IS NOT NULL")
    both = known.select(F.concat(F.lit("r"), F.col("ref_id")).alias("key"), F.col("name_norm").alias("text")).unionByName(table(spark, d, "employers").select(F.concat(F.lit("e"), F.col("employer_id")).alias("key"), F.col("employer_norm").alias("text")))
    # equal texts of one side are looked up once; the best three texts hold the best three rows
    one = both.groupBy("text", F.substring("key", 1, 1).alias("side")).agg(F.min("key").alias("key"))
    weights = cut(L.stacked_tfidf(both, "key", "text").join(one.select("key"), "key", "left_semi"), "tfidf")
    near = L.nearest_in_blocks(weights.filter("key LIKE 'e%'"), weights.filter("key LIKE 'r%'"), 3)
    rows = both.withColumn("side", F.substring("key", 1, 1)).join(one.withColumnRenamed("key", "first"), ["text", "side"])
    same = lambda c: rows.select(F.col("first").alias(c), F.col("key").alias(f"{c}_row"))
    spread = first_rows(near.join(same("item"), "item").select("query", F.col("item_row").alias("item"), "sim"), ["query"], F.desc(F.round("sim", 9)), F.col("item"), n=3)
    labels = known.select(F.concat(F.lit("r"), F.col("ref_id")).alias("item"), F.col("level1_category").alias("label"))
    return L.vote(spread, labels).join(same("query"), "query").select(F.substring("query_row", 2, 20).cast("bigint").alias("employer_id"), "label", F.round("confidence", 6).alias("confidence"))


_PROTO = "WITH v AS (SELECT vec_id AS id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(x) AS x FROM v GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(x * x)) AS l FROM c GROUP BY 1), s AS (SELECT v.id, c.label, sum(v.x * c.x) / any_value(n.l) AS s FROM v JOIN c USING (i) JOIN n ON n.label = c.label GROUP BY 1, 2) SELECT id, arg_max(label, s) AS label FROM s GROUP BY 1"


@add("ml_nearest_prototype", _PROTO)
def ml_nearest_prototype(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return L.nearest_prototype(e, "vec_id", "embedding", L.prototypes(e, "label", "embedding")).select(F.col("vec_id").alias("id"), "label")


@add("lim_topk_neighbors", "SELECT query, item FROM (SELECT a.vec_id AS query, b.vec_id AS item, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) DESC, b.vec_id) AS r FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) WHERE r <= 5")
def lim_topk_neighbors(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set, every fiftieth id, against all rows: queries travel to the rows in blocks, and only the best of each block go on."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    blocks = max(8, -(-e.count() // 2000))
    queries = e.filter("id % 50 = 0").select(F.col("id").alias("query"), F.col("vec").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    rows = e.select(F.col("id").alias("item"), "vec", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    sims = queries.join(rows, "block").filter("query <> item").select("query", "block", "item", F.round(L.dot(F.col("q"), F.col("vec")), 9).alias("s"))
    return first_rows(first_rows(sims, ["query", "block"], F.desc("s"), F.col("item"), n=5), ["query"], F.desc("s"), F.col("item"), n=5).select("query", "item")


@add("m_softmax_conf", "WITH s AS (SELECT employer_norm AS k, level1_category AS v, count(*) AS n FROM employers WHERE level1_category IS NOT NULL GROUP BY 1, 2) SELECT k, round(max(exp(n)) / sum(exp(n)), 6) AS conf FROM s GROUP BY 1")
def m_softmax_conf(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "employers").filter("level1_category IS NOT NULL").groupBy(F.col("employer_norm").alias("k"), "level1_category").agg(F.exp(F.count(F.lit(1)).cast("double")).alias("e"))
    return s.groupBy("k").agg(F.round(F.max("e") / F.sum("e"), 6).alias("conf"))


@add("ml_predict")
def ml_predict(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "running_list").select(F.lower("name_norm").alias("text"), "level1_category")
    e = table(spark, d, "employers").select("employer_id", F.lower("employer_norm").alias("text"))
    return L.predict(L.train_classifier(r, "text", "level1_category"), e, "employer_id", "text").select("employer_id", "label", F.round("confidence", 4).alias("confidence"))


@add("ml_training_assembly", "SELECT text, arg_max(label, (p, i)) AS label FROM (SELECT name_norm AS text, level1_category AS label, 1 AS p, ref_id AS i FROM running_list WHERE level1_category IS NOT NULL UNION ALL SELECT employer_norm, level1_category, 2, employer_id FROM employers WHERE level1_category IS NOT NULL) GROUP BY 1")
def ml_training_assembly(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "running_list").filter("level1_category IS NOT NULL").select(F.col("name_norm").alias("text"), F.col("level1_category").alias("label"), F.lit(1).alias("p"), F.col("ref_id").alias("i"))
    b = table(spark, d, "employers").filter("level1_category IS NOT NULL").select(F.col("employer_norm").alias("text"), F.col("level1_category").alias("label"), F.lit(2).alias("p"), F.col("employer_id").alias("i"))
    return a.unionByName(b).groupBy("text").agg(F.max_by("label", F.struct("p", "i")).alias("label"))


@add("ml_inference_units", "SELECT DISTINCT CASE WHEN coalesce(contributor_occupation, '') = '' THEN contributor_name ELSE coalesce(contributor_employer, '') || '|' || contributor_occupation END AS unit FROM contributions")
def ml_inference_units(spark: SparkSession, d: str) -> DataFrame:
    o = F.coalesce("contributor_occupation", F.lit(""))
    return table(spark, d, "contributions").select(F.when(o == "", F.col("contributor_name")).otherwise(F.concat(F.coalesce("contributor_employer", F.lit("")), F.lit("|"), o)).alias("unit")).distinct()


_KEY = "CASE WHEN lower(strip(coalesce(contributor_occupation, ''))) IN ('', 'not employed', 'retired') THEN concat_ws('|', upper(contributor_name), upper(coalesce(contributor_city, '')), coalesce(contributor_state, '')) ELSE concat_ws('|', upper(contributor_name), upper(coalesce(contributor_employer, ''))) END"


def search_key():
    """The key a donor is searched by: with the place where there is no work to search by."""
    idle = F.lower(strip(F.coalesce("contributor_occupation", F.lit("")))).isin("", "not employed", "retired")
    place = F.concat_ws("|", F.upper("contributor_name"), F.upper(F.coalesce("contributor_city", F.lit(""))), F.coalesce("contributor_state", F.lit("")))
    return F.when(idle, place).otherwise(F.concat_ws("|", F.upper("contributor_name"), F.upper(F.coalesce("contributor_employer", F.lit("")))))


@add("llm_search_key", f"SELECT name_id, {_KEY} AS search_key FROM contributors")
def llm_search_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select("name_id", search_key().alias("search_key"))


@add("llm_not_employed", "SELECT name_id FROM contributors WHERE lower(coalesce(contributor_employer, '')) IN ('', 'not employed', 'none') AND lower(coalesce(contributor_occupation, '')) IN ('', 'not employed', 'none')")
def llm_not_employed(spark: SparkSession, d: str) -> DataFrame:
    idle = [F.lower(F.coalesce(c, F.lit(""))).isin("", "not employed", "none") for c in ("contributor_employer", "contributor_occupation")]
    return table(spark, d, "contributors").filter(idle[0] & idle[1]).select("name_id")


@add("llm_unit_dedup", f"SELECT {_KEY} AS search_key, min(name_id) AS name_id FROM contributors GROUP BY 1")
def llm_unit_dedup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").groupBy(search_key().alias("search_key")).agg(F.min("name_id").alias("name_id"))


@add("llm_cache_skip", "SELECT name_id FROM contributors WHERE contributor_name NOT IN (SELECT contributor_name FROM web_search_cache WHERE contributor_name IS NOT NULL)")
def llm_cache_skip(spark: SparkSession, d: str) -> DataFrame:
    return not_in(table(spark, d, "contributors").select("name_id", "contributor_name"), table(spark, d, "web_search_cache"), ["contributor_name"]).select("name_id")


@add("llm_cache_upsert", "SELECT search_key, arg_max(search_id, (searched_at, search_id)) AS search_id FROM web_search_cache GROUP BY 1")
def llm_cache_upsert(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "web_search_cache").groupBy("search_key").agg(F.max_by("search_id", F.struct("searched_at", "search_id")).alias("search_id"))


@add("llm_code_validate", "SELECT e.employer_id, CASE WHEN a.k IS NOT NULL THEN e.naics_code WHEN b.k IS NOT NULL THEN left(e.naics_code, 2) ELSE '00' END AS code FROM employers e LEFT JOIN (SELECT DISTINCT naics_code AS k FROM running_list WHERE naics_code IS NOT NULL) a ON a.k = e.naics_code LEFT JOIN (SELECT DISTINCT left(naics_code, 2) AS k FROM running_list WHERE naics_code IS NOT NULL) b ON b.k = left(e.naics_code, 2)")
def llm_code_validate(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "running_list").filter("naics_code IS NOT NULL")
    full = r.select("naics_code", F.lit(True).alias("a")).distinct()
    two = r.select(F.substring("naics_code", 1, 2).alias("two"), F.lit(True).alias("b")).distinct()
    e = table(spark, d, "employers").select("employer_id", "naics_code", F.substring("naics_code", 1, 2).alias("two")).join(full, "naics_code", "left").join(two, "two", "left")
    return e.select("employer_id", F.when(F.col("a"), F.col("naics_code")).when(F.col("b"), F.col("two")).otherwise("00").alias("code"))


@add("llm_short_circuit", "SELECT search_id, CASE WHEN industry_summary IS NOT NULL THEN 'model' WHEN strip(coalesce(contributor_employer, '')) <> '' THEN 'employer' ELSE '100' END AS route FROM web_search_cache")
def llm_short_circuit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "web_search_cache").select("search_id", F.when(F.col("industry_summary").isNotNull(), "model").when(strip(F.coalesce("contributor_employer", F.lit(""))) != "", "employer").otherwise("100").alias("route"))


@add("llm_map_back", "SELECT c.row_id, w.search_id FROM contributions c LEFT JOIN (SELECT contributor_name, max(search_id) AS search_id FROM web_search_cache GROUP BY 1) w ON c.contributor_name = w.contributor_name")
def llm_map_back(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "web_search_cache").groupBy("contributor_name").agg(F.max("search_id").alias("search_id"))
    return table(spark, d, "contributions").select("row_id", "contributor_name").join(w, "contributor_name", "left").select("row_id", "search_id")


@add("llm_sector_text", "SELECT left(naics_code, 2) AS sector, string_agg(DISTINCT naics_label, '; ' ORDER BY naics_label) AS text FROM running_list WHERE naics_code IS NOT NULL AND naics_label IS NOT NULL GROUP BY 1")
def llm_sector_text(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "running_list").filter("naics_code IS NOT NULL AND naics_label IS NOT NULL")
    return r.groupBy(F.substring("naics_code", 1, 2).alias("sector")).agg(F.array_join(F.array_sort(F.collect_set("naics_label")), "; ").alias("text"))


@add("llm_mixed_employment", "SELECT contributor_employer, contributor_occupation, count(*) AS n FROM contributors WHERE upper(contributor_employer) = 'NOT EMPLOYED' AND upper(coalesce(contributor_occupation, '')) NOT IN ('', ' ', 'NOT EMPLOYED', 'RETIRED') GROUP BY 1, 2")
def llm_mixed_employment(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").filter((F.upper("contributor_employer") == "NOT EMPLOYED") & ~F.upper(F.coalesce("contributor_occupation", F.lit(""))).isin("", " ", "NOT EMPLOYED", "RETIRED"))
    return c.groupBy("contributor_employer", "contributor_occupation").agg(F.count(F.lit(1)).alias("n"))


@add("llm_cache_coverage", "SELECT contributor_name IN (SELECT contributor_name FROM web_search_cache WHERE contributor_name IS NOT NULL) AS hit, count(*) AS n FROM contributors GROUP BY 1")
def llm_cache_coverage(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "web_search_cache").select("contributor_name", F.lit(True).alias("h")).distinct()
    return table(spark, d, "contributors").select("contributor_name").join(w, "contributor_name", "left").groupBy(F.coalesce("h", F.lit(False)).alias("hit")).agg(F.count(F.lit(1)).alias("n"))
