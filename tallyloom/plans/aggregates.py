"""Aggregates over receipts, donors and employers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import values
from tallyloom.functions.rewrites import strip
from tallyloom.operators import groups as G
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()


def _on(name: str, source: str, sql: str, f) -> None:
    registry.add(name, sql)(lambda spark, d: f(table(spark, d, source)))




def n_rows():
    """The number of rows of a group."""
    return F.count(F.lit(1))


_on("agg_count_by", "contributions", "SELECT recipient_committee_id, count(*) AS n FROM contributions GROUP BY 1", lambda c: c.groupBy("recipient_committee_id").agg(n_rows().alias("n")))
_on(
    "agg_entity_rollup",
    "contributions",
    "SELECT contributor_name, count(*) AS n, round(sum(amount), 2) AS total, arg_min(contributor_occupation, row_id) FILTER (WHERE contributor_occupation IS NOT NULL) AS occupation FROM contributions GROUP BY 1",
    lambda c: c.groupBy("contributor_name").agg(n_rows().alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.min_by("contributor_occupation", F.when(F.col("contributor_occupation").isNotNull(), F.col("row_id"))).alias("occupation")),
)
_on(
    "agg_entity_multi_key",
    "contributors",
    "SELECT standardized_name, entity_kind, contributor_occupation, count(*) AS n FROM contributors GROUP BY 1, 2, 3",
    lambda c: c.groupBy("standardized_name", "entity_kind", "contributor_occupation").agg(n_rows().alias("n")),
)
_MODE = "SELECT {k}, min(v) AS mode FROM (SELECT {k}, {v} AS v, count(*) AS n, max(count(*)) OVER (PARTITION BY {k}) AS m FROM {t} WHERE {v} IS NOT NULL GROUP BY 1, 2) WHERE n = m GROUP BY 1"
_on("agg_mode", "contributions", _MODE.format(k="recipient_committee_id", v="contributor_city", t="contributions"), lambda c: G.mode_by(c, ["recipient_committee_id"], "contributor_city"))
_on(
    "agg_mode_first_seen",
    "contributions",
    "SELECT k AS recipient_committee_id, arg_max(v, (n, -f)) AS mode FROM (SELECT recipient_committee_id AS k, contributor_city AS v, count(*) AS n, min(row_id) AS f FROM contributions WHERE contributor_city IS NOT NULL GROUP BY 1, 2) GROUP BY 1",
    lambda c: G.mode_by(c, ["recipient_committee_id"], "contributor_city", order="row_id"),
)
_on("agg_mode_table", "employers", _MODE.format(k="naics_code", v="level2_category", t="employers"), lambda e: G.mode_by(e, ["naics_code"], "level2_category"))
_on(
    "agg_max_group_filter",
    "lineitem",
    "SELECT l_suppkey, l_returnflag, l_linenumber, l_orderkey FROM lineitem QUALIFY l_linenumber = max(l_linenumber) OVER (PARTITION BY l_suppkey, l_returnflag)",
    lambda l: G.tied_for_max(l, ["l_suppkey", "l_returnflag"], "l_linenumber").select("l_suppkey", "l_returnflag", "l_linenumber", "l_orderkey"),
)
_on(
    "agg_last_nonnull",
    "contributors",
    """SELECT standardized_name, arg_max(contributor_employer, name_id) FILTER (WHERE contributor_employer IS NOT NULL) AS contributor_employer,
       arg_max(contributor_zip_code, name_id) FILTER (WHERE contributor_zip_code IS NOT NULL) AS contributor_zip_code FROM contributors GROUP BY 1""",
    lambda c: G.last_non_null(c, ["standardized_name"], "name_id", ["contributor_employer", "contributor_zip_code"]),
)
_on(
    "agg_count_distinct",
    "contributions",
    "SELECT recipient_committee_id, count(DISTINCT contributor_zip_code) + max(CASE WHEN contributor_zip_code IS NULL THEN 1 ELSE 0 END) AS n_zips FROM contributions GROUP BY 1",
    lambda c: c.groupBy("recipient_committee_id").agg((F.count_distinct("contributor_zip_code") + F.max(F.col("contributor_zip_code").isNull().cast("int"))).alias("n_zips")),
)
_on("agg_distinct_conflict", "employers", "SELECT employer_norm, count(DISTINCT naics_code) AS n_values FROM employers GROUP BY 1 HAVING count(DISTINCT naics_code) > 1", lambda e: G.conflicts(e, ["employer_norm"], "naics_code"))
_on(
    "agg_conditional_sum",
    "contributions",
    "SELECT recipient_committee_id, round(coalesce(sum(CASE WHEN amount <= 100 THEN amount END), 0), 2) AS small, round(coalesce(sum(CASE WHEN amount > 100 THEN amount END), 0), 2) AS large FROM contributions GROUP BY 1",
    lambda c: c.groupBy("recipient_committee_id").agg(
        F.round(F.coalesce(F.sum(F.when(F.col("amount") <= 100, F.col("amount"))), F.lit(0.0)), 2).alias("small"), F.round(F.coalesce(F.sum(F.when(F.col("amount") > 100, F.col("amount"))), F.lit(0.0)), 2).alias("large")
    ),
)
_on(
    "agg_any_flags",
    "contributions",
    "SELECT contributor_name, coalesce(bool_or(candidate_contribution = 'Y'), false) AS any_candidate, coalesce(bool_or(allied_committee = 'Y'), false) AS any_allied FROM contributions GROUP BY 1",
    lambda c: c.groupBy("contributor_name").agg(F.coalesce(F.bool_or(F.col("candidate_contribution") == "Y"), F.lit(False)).alias("any_candidate"), F.coalesce(F.bool_or(F.col("allied_committee") == "Y"), F.lit(False)).alias("any_allied")),
)
_on(
    "agg_all_any_status",
    "web_search_cache",
    "SELECT search_key, CASE WHEN bool_and(coalesce(is_prominent, false)) THEN 'all' WHEN bool_or(coalesce(is_prominent, false)) THEN 'some' ELSE 'none' END AS status FROM web_search_cache GROUP BY 1",
    lambda w: w.groupBy("search_key").agg(F.bool_and(F.coalesce("is_prominent", F.lit(False))).alias("a"), F.bool_or(F.coalesce("is_prominent", F.lit(False))).alias("o")).select("search_key", F.when(F.col("a"), "all").when(F.col("o"), "some").otherwise("none").alias("status")),
)
_on(
    "agg_concat_sorted",
    "employers",
    "SELECT employer_norm, coalesce(string_agg(DISTINCT level1_category, ' | ' ORDER BY level1_category), '') AS categories FROM employers GROUP BY 1",
    lambda e: e.groupBy("employer_norm").agg(G.joined_values("level1_category").alias("categories")),
)
_on("agg_list_names", "employers", "SELECT employer_norm, list_sort(list(DISTINCT employer)) AS names FROM employers GROUP BY 1", lambda e: e.groupBy("employer_norm").agg(F.array_sort(F.collect_set("employer")).alias("names")))
_on(
    "agg_nest",
    "contributors",
    "SELECT standardized_name, len(list(name_id)) AS n_records, list_sort(list(name_id)) AS ids FROM contributors WHERE standardized_name IS NOT NULL GROUP BY 1",
    lambda c: c.filter("standardized_name IS NOT NULL").groupBy("standardized_name").agg(F.array_sort(F.collect_list(F.struct("name_id", "contributor_city"))).alias("records")).select("standardized_name", F.size("records").cast("bigint").alias("n_records"), F.col("records.name_id").alias("ids")),
)
_on(
    "agg_attr_first_last",
    "contributions",
    """SELECT contributor_name, contributor_city, count(*) AS n, round(sum(amount), 2) AS total, arg_min(row_id, (start_date, row_id)) AS first_row, arg_max(row_id, (start_date, row_id)) AS last_row
       FROM contributions WHERE start_date IS NOT NULL GROUP BY 1, 2""",
    lambda c: c.filter("start_date IS NOT NULL").groupBy("contributor_name", "contributor_city").agg(
        n_rows().alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.min_by("row_id", F.struct("start_date", "row_id")).alias("first_row"), F.max_by("row_id", F.struct("start_date", "row_id")).alias("last_row")
    ),
)
_on(
    "agg_longest_name",
    "contributors",
    "SELECT contributor_zip_code, arg_max(contributor_name, (length(contributor_name), name_id)) AS longest FROM contributors WHERE contributor_zip_code IS NOT NULL GROUP BY 1",
    lambda c: c.filter("contributor_zip_code IS NOT NULL").groupBy("contributor_zip_code").agg(F.max_by("contributor_name", F.struct(F.length("contributor_name"), F.col("name_id"))).alias("longest")),
)
_on(
    "agg_two_level_max",
    "contributions",
    "SELECT contributor_name, round(max(s), 2) AS most FROM (SELECT contributor_name, recipient_committee_id, sum(amount) AS s FROM contributions GROUP BY 1, 2) GROUP BY 1",
    lambda c: c.groupBy("contributor_name", "recipient_committee_id").agg(F.sum("amount").alias("s")).groupBy("contributor_name").agg(F.round(F.max("s"), 2).alias("most")),
)
_SHARE = "SELECT office, contributor_state, sum(amount) AS a, sum(sum(amount)) OVER (PARTITION BY office) AS t FROM contributions WHERE office IS NOT NULL AND amount IS NOT NULL GROUP BY 1, 2"
_on(
    "agg_share_of_total",
    "contributions",
    f"SELECT office, contributor_state, round(a, 2) AS amount, round(100 * a / t, 4) AS share FROM ({_SHARE})",
    lambda c: G.shares(c.filter("office IS NOT NULL AND amount IS NOT NULL"), ["office"], ["contributor_state"], "amount").select("office", "contributor_state", F.round("amount", 2).alias("amount"), F.round("share", 4).alias("share")),
)
_on(
    "agg_share_rounding_check",
    "contributions",
    f"SELECT office, abs(sum(round(100 * a / t, 4)) - 100) < 0.01 AS adds_up FROM ({_SHARE}) GROUP BY 1",
    lambda c: G.shares(c.filter("office IS NOT NULL AND amount IS NOT NULL"), ["office"], ["contributor_state"], "amount").groupBy("office").agg((F.abs(F.sum(F.round("share", 4)) - 100) < 0.01).alias("adds_up")),
)
_on(
    "agg_coverage",
    "employers",
    "SELECT coalesce(data_source_1, 'unmatched') AS source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share FROM employers GROUP BY 1",
    lambda e: e.groupBy(F.coalesce("data_source_1", F.lit("unmatched")).alias("source")).agg(n_rows().alias("n")).select("source", "n", F.round(100.0 * F.col("n") / F.sum("n").over(_all()), 4).alias("share")),
)
_TIER_SQL = "CASE WHEN amount >= 100000 THEN '100k and more' WHEN amount >= 10000 THEN '10k to 100k' WHEN amount >= 1000 THEN '1k to 10k' ELSE 'under 1k' END"
_on(
    "agg_tier_stats",
    "contributions",
    f"SELECT {_TIER_SQL} AS tier, count(*) AS n, round(sum(amount), 2) AS total, round(avg(amount), 4) AS mean, median(amount) AS median FROM contributions GROUP BY 1",
    lambda c: c.groupBy(values.tier(F.col("amount")).alias("tier")).agg(n_rows().alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.round(F.avg("amount"), 4).alias("mean"), F.median("amount").alias("median")),
)
_on("agg_summary_stats", "contributions", "SELECT recipient_committee_id, count(amount) AS n, round(sum(amount), 2) AS total, median(amount) AS median FROM contributions GROUP BY 1", lambda c: c.groupBy("recipient_committee_id").agg(F.count("amount").alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.median("amount").alias("median")))
_on(
    "agg_type_stats",
    "contributions",
    "SELECT transaction_type, count(*) AS n, round(sum(amount), 2) AS total, max(amount) AS most, min(CASE WHEN amount > 0 THEN amount END) AS least FROM contributions GROUP BY 1",
    lambda c: c.groupBy("transaction_type").agg(n_rows().alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.max("amount").alias("most"), F.min(F.when(F.col("amount") > 0, F.col("amount"))).alias("least")),
)
_on(
    "agg_match_rate",
    "employers",
    "SELECT entity_kind, count(*) AS n, count(data_source_1) AS matched, count(naics_code) AS coded, round(count(naics_code) / greatest(count(*), 1), 6) AS rate FROM employers GROUP BY 1",
    lambda e: e.groupBy("entity_kind").agg(n_rows().alias("n"), F.count("data_source_1").alias("matched"), F.count("naics_code").alias("coded"), F.round(values.ratio(F.count("naics_code"), n_rows()), 6).alias("rate")),
)
_on("agg_company_check", "contributions", "SELECT CASE WHEN strip(coalesce(contributor_employer, '')) = '' THEN '(blank / missing)' ELSE contributor_employer END AS company, count(*) AS n FROM contributions GROUP BY 1", lambda c: c.groupBy(F.when(strip(F.coalesce("contributor_employer", F.lit(""))) == "", "(blank / missing)").otherwise(F.col("contributor_employer")).alias("company")).agg(n_rows().alias("n")))
_on("agg_value_counts_top", "employers", "SELECT level2_category, count(*) AS n FROM employers GROUP BY 1 ORDER BY n DESC, level2_category NULLS LAST LIMIT 15", lambda e: e.groupBy("level2_category").agg(n_rows().alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("level2_category")).limit(15))
_CONF = "CASE lower(confidence) WHEN 'high' THEN 0.9 WHEN 'medium' THEN 0.6 WHEN 'low' THEN 0.3 END"
_on(
    "agg_conf_by_category",
    "web_search_cache",
    f"SELECT is_prominent, count(*) AS n, count(CASE WHEN {_CONF} < 0.5 THEN 1 END) AS n_low, round(avg({_CONF}), 6) AS mean, median({_CONF})::DOUBLE AS median FROM web_search_cache GROUP BY 1",
    lambda w: w.withColumn("c", F.when(F.lower("confidence") == "high", 0.9).when(F.lower("confidence") == "medium", 0.6).when(F.lower("confidence") == "low", 0.3)).groupBy("is_prominent").agg(n_rows().alias("n"), F.count(F.when(F.col("c") < 0.5, 1)).alias("n_low"), F.round(F.avg("c"), 6).alias("mean"), F.median("c").alias("median")),
)
_on(
    "agg_pivot_stack",
    "employers",
    "SELECT level1_category, count(CASE WHEN entity_kind = 'individual' THEN 1 END) AS individual, count(CASE WHEN entity_kind = 'organization' THEN 1 END) AS organization FROM employers GROUP BY 1",
    lambda e: e.groupBy("level1_category").pivot("entity_kind", ["individual", "organization"]).agg(n_rows()).na.fill(0, ["individual", "organization"]),
)
_on(
    "agg_small_slice_other",
    "contributions",
    "SELECT office, label, round(sum(a), 2) AS amount FROM (SELECT office, a, CASE WHEN 100 * a / sum(a) OVER (PARTITION BY office) < 3 THEN 'Other' ELSE contributor_state END AS label FROM (SELECT office, contributor_state, sum(amount) AS a FROM contributions WHERE office IS NOT NULL AND amount IS NOT NULL AND contributor_state IS NOT NULL GROUP BY 1, 2)) GROUP BY 1, 2",
    lambda c: G.folded_small(c.filter("office IS NOT NULL AND amount IS NOT NULL AND contributor_state IS NOT NULL"), ["office"], "contributor_state", "amount", 3.0).select("office", F.col("contributor_state").alias("label"), F.round("amount", 2).alias("amount")),
)
_on("agg_txn_types", "contributions", "SELECT transaction_type, count(*) AS n, round(sum(amount), 2) AS total FROM contributions GROUP BY 1", lambda c: c.groupBy("transaction_type").agg(n_rows().alias("n"), F.round(F.sum("amount"), 2).alias("total")))
_on("agg_fill_rate", "contributions", "SELECT round(avg(CASE WHEN strip(coalesce(contributor_employer, '')) <> '' THEN 1.0 ELSE 0.0 END), 6) AS employer, round(avg(CASE WHEN strip(coalesce(contributor_occupation, '')) <> '' THEN 1.0 ELSE 0.0 END), 6) AS occupation FROM contributions", lambda c: c.agg(*[F.round(F.avg((strip(F.coalesce(f"contributor_{x}", F.lit(""))) != "").cast("double")), 6).alias(x) for x in ("employer", "occupation")]))
registry.add(
    "agg_top_confusions",
    "SELECT e.level1_category AS given, r.level1_category AS listed, count(*) AS n FROM employers e JOIN running_list r ON e.employer_norm = r.name_norm GROUP BY 1, 2 ORDER BY n DESC, given NULLS LAST, listed NULLS LAST LIMIT 15",
)(
    lambda spark, d: table(spark, d, "employers").select(F.col("employer_norm").alias("k"), F.col("level1_category").alias("given"))
    .join(table(spark, d, "running_list").select(F.col("name_norm").alias("k"), F.col("level1_category").alias("listed")), "k")
    .groupBy("given", "listed").agg(n_rows().alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("given"), F.asc_nulls_last("listed")).limit(15)
)
registry.add(
    "agg_accuracy",
    "SELECT r.list_source, count(*) AS n, round(avg(CASE WHEN e.level1_category = r.level1_category THEN 1.0 ELSE 0.0 END), 6) AS top1 FROM employers e JOIN running_list r ON e.employer_norm = r.name_norm WHERE e.level1_category IS NOT NULL GROUP BY 1",
)(
    lambda spark, d: table(spark, d, "employers").filter("level1_category IS NOT NULL").select(F.col("employer_norm").alias("k"), "level1_category")
    .join(table(spark, d, "running_list").select(F.col("name_norm").alias("k"), F.col("level1_category").alias("truth"), "list_source"), "k")
    .groupBy("list_source").agg(n_rows().alias("n"), F.round(F.avg(F.coalesce(F.col("level1_category") == F.col("truth"), F.lit(False)).cast("double")), 6).alias("top1"))
)
_on(
    "agg_normalised_name_freq",
    "contributors",
    "SELECT c.name_id, f.n FROM (SELECT name_id, upper(split_part(contributor_name, ',', 1)) AS k FROM contributors) c JOIN (SELECT upper(split_part(contributor_name, ',', 1)) AS k, count(*) AS n FROM contributors GROUP BY 1) f USING (k)",
    lambda c: G.with_group(c.select("name_id", F.upper(F.split_part("contributor_name", F.lit(","), F.lit(1))).alias("k")), ["k"], n=n_rows()).filter("k IS NOT NULL").select("name_id", "n"),
)
_on("agg_grouping_sets", "contributions", "SELECT office, transaction_type, count(*) AS n FROM contributions GROUP BY GROUPING SETS ((office, transaction_type), (office), ())", lambda c: c.groupingSets([["office", "transaction_type"], ["office"], []], "office", "transaction_type").agg(n_rows().alias("n")))
_on("agg_rollup", "contributions", "SELECT contributor_state, office, round(sum(amount), 2) AS total FROM contributions GROUP BY ROLLUP (contributor_state, office)", lambda c: c.rollup("contributor_state", "office").agg(F.round(F.sum("amount"), 2).alias("total")))

_on("win_row_number_file", "filers", "SELECT filer_id, row_number() OVER (ORDER BY filer_id) AS n FROM filers", lambda f: G.numbered(f.select("filer_id"), "filer_id", "n"))
_on("win_dup_rank", "contributions", "SELECT row_id, row_number() OVER (PARTITION BY contributor_name, amount, start_date ORDER BY row_id) AS dup_rank FROM contributions", lambda c: G.duplicate_rank(c, ["contributor_name", "amount", "start_date"], F.col("row_id")).select("row_id", F.col("dup_rank").cast("bigint").alias("dup_rank")))
_on("win_group_total", "contributions", "SELECT row_id, round(sum(amount) OVER (PARTITION BY contributor_name, office), 2) AS total FROM contributions WHERE office IS NOT NULL", lambda c: G.with_group(c.filter("office IS NOT NULL").select("row_id", "contributor_name", "office", "amount"), ["contributor_name", "office"], total=F.round(F.sum("amount"), 2)).select("row_id", "total"))
_on("win_group_max", "employers", "SELECT employer_id, max(n_donors) OVER (PARTITION BY employer_norm) AS most FROM employers", lambda e: G.with_group(e.select("employer_id", "employer_norm", "n_donors"), ["employer_norm"], most=F.max("n_donors")).select("employer_id", "most"))
_on("win_distinct_count", "contributors", "SELECT c.name_id, g.n_zips FROM contributors c JOIN (SELECT standardized_name AS k, count(DISTINCT contributor_zip_code) AS n_zips FROM contributors GROUP BY 1) g ON c.standardized_name = g.k", lambda c: G.with_group(c.filter("standardized_name IS NOT NULL").select("name_id", "standardized_name", "contributor_zip_code"), ["standardized_name"], n_zips=F.count_distinct("contributor_zip_code")).select("name_id", "n_zips"))
_on("win_slice_max", "contributions", "SELECT contributor_name, row_id, amount FROM (SELECT *, row_number() OVER (PARTITION BY contributor_name ORDER BY amount DESC, row_id) AS r FROM contributions WHERE amount IS NOT NULL) WHERE r = 1", lambda c: G.best_row(c.filter("amount IS NOT NULL").select("contributor_name", "row_id", "amount"), ["contributor_name"], F.struct("amount", -F.col("row_id"))))
_PRIO = "CASE list_source WHEN 'manual' THEN 1 WHEN 'opensecrets' THEN 2 ELSE 3 END"
_on("win_slice_min_priority", "running_list", f"SELECT naics_code, ref_id FROM (SELECT naics_code, ref_id, row_number() OVER (PARTITION BY naics_code ORDER BY {_PRIO}, ref_id) AS r FROM running_list WHERE naics_code IS NOT NULL) WHERE r = 1", lambda r: G.best_row(r.filter("naics_code IS NOT NULL").select("naics_code", "ref_id", "list_source"), ["naics_code"], F.struct(-F.when(F.col("list_source") == "manual", 1).when(F.col("list_source") == "opensecrets", 2).otherwise(3), -F.col("ref_id"))).select("naics_code", "ref_id"))
_on("win_first_real_code", "employers", "SELECT employer_norm, naics_code FROM (SELECT employer_norm, naics_code, row_number() OVER (PARTITION BY employer_norm ORDER BY (naics_code IS NULL OR naics_code = '99'), employer_id) AS r FROM employers) WHERE r = 1", lambda e: G.first_rows(e.select("employer_norm", "naics_code", "employer_id"), ["employer_norm"], F.col("naics_code").isNull() | (F.col("naics_code") == "99"), F.col("employer_id")).select("employer_norm", "naics_code"))
_on("win_dedup_first", "web_search_cache", "SELECT search_key, min(search_id) AS search_id FROM web_search_cache GROUP BY 1", lambda w: G.first_rows(w.select("search_key", "search_id"), ["search_key"], F.col("search_id")))
_on("win_dedup_last", "web_search_cache", "SELECT search_key, max(search_id) AS search_id FROM web_search_cache GROUP BY 1", lambda w: G.first_rows(w.select("search_key", "search_id"), ["search_key"], F.desc("search_id")))
_on("win_dedup_priority", "contributors", "SELECT standardized_name, data_source, name_id FROM (SELECT *, row_number() OVER (PARTITION BY standardized_name ORDER BY CASE data_source WHEN 'manual' THEN 0 ELSE 1 END, name_id) AS r FROM contributors) WHERE r = 1", lambda c: G.first_rows(c.select("standardized_name", "data_source", "name_id"), ["standardized_name"], F.when(F.col("data_source") == "manual", 0).otherwise(1), F.col("name_id")))
_on("win_duplicates_flag", "contributions", "SELECT row_id, count(*) OVER (PARTITION BY contributor_name, amount, start_date, recipient_committee_id) > 1 AS repeated FROM contributions", lambda c: c.join(c.groupBy("contributor_name", "amount", "start_date", "recipient_committee_id").agg(n_rows().alias("__n")).select(*[F.col(x).alias(f"__{x}") for x in ("contributor_name", "amount", "start_date", "recipient_committee_id")], "__n"), [F.col(x).eqNullSafe(F.col(f"__{x}")) for x in ("contributor_name", "amount", "start_date", "recipient_committee_id")]).select("row_id", (F.col("__n") > 1).alias("repeated")))
_on("win_sample_per_group", "contributors", "SELECT data_source, name_id FROM (SELECT data_source, name_id, row_number() OVER (PARTITION BY data_source ORDER BY md5(name_id || '|42'), name_id) AS r FROM contributors) WHERE r <= 20", lambda c: G.sample_per_group(c.select("data_source", "name_id"), ["data_source"], 20, "name_id"))
_on("win_nsmallest_per_group", "contributions", "SELECT office, row_id, amount FROM (SELECT office, row_id, amount, row_number() OVER (PARTITION BY office ORDER BY amount, row_id) AS r FROM contributions WHERE office IS NOT NULL AND amount IS NOT NULL) WHERE r <= 5", lambda c: G.first_rows(c.filter("office IS NOT NULL AND amount IS NOT NULL").select("office", "row_id", "amount"), ["office"], F.col("amount"), F.col("row_id"), n=5))
_on("win_topn_per_group", "contributions", "SELECT office, contributor_state, total FROM (SELECT office, contributor_state, round(sum(amount), 2) AS total, row_number() OVER (PARTITION BY office ORDER BY round(sum(amount), 2) DESC, contributor_state NULLS LAST) AS r FROM contributions WHERE office IS NOT NULL GROUP BY 1, 2) WHERE r <= 3", lambda c: G.first_rows(c.filter("office IS NOT NULL").groupBy("office", "contributor_state").agg(F.round(F.sum("amount"), 2).alias("total")), ["office"], F.desc("total"), F.asc_nulls_last("contributor_state"), n=3))
_on("ord_desc_total", "contributions", "SELECT recipient_committee_id, round(sum(amount), 2) AS total FROM contributions GROUP BY 1 ORDER BY total DESC", lambda c: c.groupBy("recipient_committee_id").agg(F.round(F.sum("amount"), 2).alias("total")).orderBy(F.desc("total")))
_on("ord_len_desc", "running_list", "SELECT ref_name, row_number() OVER (ORDER BY length(ref_name) DESC, ref_id) AS priority FROM running_list", lambda r: G.numbered(r.select("ref_name", F.struct((-F.length("ref_name")).alias("l"), "ref_id").alias("k")), "k", "priority").select("ref_name", "priority"))
_on("ord_bool_then_num", "employers", "SELECT employer_norm, employer_id FROM (SELECT employer_norm, employer_id, row_number() OVER (PARTITION BY employer_norm ORDER BY naics_code IS NULL, abs(amount_total), employer_id) AS r FROM employers) WHERE r = 1", lambda e: G.first_rows(e.select("employer_norm", "employer_id", "naics_code", "amount_total"), ["employer_norm"], F.col("naics_code").isNull(), F.asc_nulls_last(F.abs("amount_total")), F.col("employer_id")).select("employer_norm", "employer_id"))
_on("ord_categorical", "contributions", "SELECT office, CASE office WHEN 'Treasurer' THEN 1 WHEN 'State Senate' THEN 2 ELSE 3 END AS sort_key, count(*) AS n FROM contributions GROUP BY 1, 2 ORDER BY 2, 3 DESC", lambda c: c.groupBy("office").agg(n_rows().alias("n")).select("office", F.when(F.col("office") == "Treasurer", 1).when(F.col("office") == "State Senate", 2).otherwise(3).alias("sort_key"), "n").orderBy("sort_key", F.desc("n")))
_on("lim_topn_global", "contributions", "SELECT row_id, recipient_committee_id FROM contributions WHERE recipient_committee_id IN (SELECT recipient_committee_id FROM contributions GROUP BY 1 ORDER BY round(sum(amount), 2) DESC, 1 LIMIT 5)", lambda c: c.select("row_id", "recipient_committee_id").join(F.broadcast(c.groupBy("recipient_committee_id").agg(F.round(F.sum("amount"), 2).alias("t")).orderBy(F.desc("t"), "recipient_committee_id").limit(5).select("recipient_committee_id")), "recipient_committee_id", "left_semi"))
_on("lim_top_contributors", "contributions", "SELECT contributor_name, round(sum(amount), 2) AS total FROM contributions GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 20", lambda c: c.groupBy("contributor_name").agg(F.round(F.sum("amount"), 2).alias("total")).orderBy(F.desc_nulls_last("total"), "contributor_name").limit(20))
_on("smp_random", "contributors", "SELECT name_id FROM contributors ORDER BY md5(name_id || '|42'), name_id LIMIT 100", lambda c: G.sample_rows(c.select("name_id"), 100, "name_id"))
_on("smp_batch_slice", "contributors", "SELECT name_id FROM (SELECT name_id, row_number() OVER (ORDER BY name_id) AS r FROM contributors) WHERE r BETWEEN 101 AND 150", lambda c: G.numbered(c.select("name_id"), "name_id", "n").filter("n BETWEEN 101 AND 150").select("name_id"))


def _all():
    """One window over all groups; for results with few rows only."""
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def breakdown(spark: SparkSession, d: str) -> DataFrame:
    """Money of each race and recipient by category of the donor's employer, with shares."""
    c = table(spark, d, "contributions").filter("amount IS NOT NULL")
    from tallyloom.functions.text import normalize_name
    from tallyloom.plans.filters import race_prop

    listed = table(spark, d, "running_list").select(F.col("name_norm").alias("k"), F.col("level1_category").alias("category"))
    coded = c.select(race_prop().alias("race"), F.col("recipient_committee_id").alias("recipient"), "amount", normalize_name(F.col("contributor_employer")).alias("k")).join(listed, "k", "left")
    return G.shares(coded.withColumn("category", F.coalesce("category", F.lit("Unclassified"))), ["race", "recipient"], ["category"], "amount").select("race", "recipient", "category", F.round("amount", 2).alias("amount"), F.round("share", 3).alias("share"))


registry.add(
    "breakdown_by_category",
    """SELECT race, recipient, category, round(a, 2) AS amount, CASE WHEN sum(a) OVER (PARTITION BY race, recipient) <> 0 THEN round(100 * a / sum(a) OVER (PARTITION BY race, recipient), 3) END AS share FROM (
       SELECT CASE WHEN c.ballot_measure_contribution = 'Y' THEN c.ballot_measures WHEN c.office IS NOT NULL THEN c.office ELSE c.recipient_name END AS race, c.recipient_committee_id AS recipient,
       coalesce(r.level1_category, 'Unclassified') AS category, sum(c.amount) AS a FROM contributions c LEFT JOIN running_list r ON r.name_norm = norm(c.contributor_employer) WHERE c.amount IS NOT NULL GROUP BY 1, 2, 3)""",
)(breakdown)
