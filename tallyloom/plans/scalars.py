"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import rewrites as R
from tallyloom.functions import similarity, text, values
from tallyloom.functions.rewrites import rewritten_sql, squish_sql
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()


def _on(name: str, source: str, sql: str | None, f) -> None:
    registry.add(name, sql)(lambda spark, d: f(table(spark, d, source)))


def _map(name: str, source: str, key: str, column: str, function, sql: str) -> None:
    """A function of one column, beside its key."""
    _on(name, source, f"SELECT {key}, {sql} AS value FROM {source}", lambda t: t.select(key, function(F.col(column)).alias("value")))


_map("s_normalize_name", "contributors", "name_id", "contributor_name", text.normalize_name, " norm(contributor_name)")
_map("s_normalize_for_key", "employers", "employer_id", "employer", text.normalize_name, " norm(employer)")
_map("s_standardize_names", "contributors", "name_id", "contributor_name", text.standardize_name, squish_sql(rewritten_sql("upper(contributor_name)", R.STANDARD_NAME)))
_map("s_fix_typos", "filers", "filer_id", "naml", text.fix_typos, squish_sql(rewritten_sql("upper(naml)", R.NAME_TYPOS)))
_map("s_replace_business_text", "employers", "employer_id", "employer_norm", text.business_core, squish_sql(rewritten_sql("employer_norm", R.BUSINESS_WORDS)))
_map("s_replace_committee_text", "filers", "filer_id", "naml", lambda c: R.squish(R.rewritten(c, R.COMMITTEE_WORDS)), squish_sql(rewritten_sql("naml", R.COMMITTEE_WORDS)))
_map("s_remove_pac_info", "filers", "filer_id", "naml", text.committee_core, squish_sql(rewritten_sql(rewritten_sql("naml", R.COMMITTEE_IDS), R.COMMITTEE_WORDS)))
_map("s_remove_unit_info", "employers", "employer_id", "employer", text.without_units, squish_sql(rewritten_sql("employer", R.UNIT_NUMBERS)))
_map("s_standardize_occ_emp", "contributors", "name_id", "contributor_occupation", text.work_status, squish_sql(rewritten_sql("upper(contributor_occupation)", R.WORK_STATUS)))
_map("s_standardize_city", "contributors", "name_id", "contributor_city", text.standardize_city, squish_sql(rewritten_sql("upper(regexp_replace(contributor_city, '\\s+[A-Z]{2}$', '', 'g'))", R.CITY)))
_map("s_standardize_state", "contributors", "name_id", "contributor_state", text.standardize_state, squish_sql(rewritten_sql("upper(contributor_state)", R.STATE)))
_map("s_strip_parens", "employers", "employer_id", "employer", text.without_parentheses, "regexp_replace(employer, '\\s*\\([^)]*\\)', '', 'g')")
_map("s_strip_corp_suffix", "employers", "employer_id", "employer", text.without_corporate_suffix, rewritten_sql("employer", R.CORPORATE_SUFFIX))
_TAIL = "trim(regexp_replace(naml, '(?i)[,;(]?\\s*\\b(?:SUPPORTING|OPPOSING|SPONSORED BY|IN SUPPORT OF)\\b.*$', '', 'g'))"
_map("s_strip_candidate_suffix", "filers", "filer_id", "naml", text.without_candidate_tail, f"CASE WHEN {_TAIL} = '' THEN naml ELSE {_TAIL} END")
_map("s_preprocess_text", "employers", "employer_id", "employer", text.expanded_words, squish_sql(rewritten_sql("regexp_replace(lower(employer), '[^a-z0-9 ]+', ' ', 'g')", R.SHORT_WORDS)))
_map("s_lightly_process", "contributors", "name_id", "contributor_occupation", lambda c: R.squish(F.lower(c)), squish_sql("lower(contributor_occupation)"))
_map("s_abbrev_ca", "contributors", "name_id", "contributor_city", lambda c: F.replace(F.concat(F.upper(c), F.lit(" ")), F.lit(" CA "), F.lit(" CALIFORNIA ")), "replace(upper(contributor_city) || ' ', ' CA ', ' CALIFORNIA ')")
_on("s_concat_name", "filers", "SELECT filer_id, CASE WHEN trim(coalesce(naml, '')) = '' THEN trim(coalesce(namf, '')) WHEN trim(coalesce(namf, '')) = '' THEN trim(coalesce(naml, '')) ELSE trim(naml) || ', ' || trim(namf) END AS name FROM filers", lambda f: f.select("filer_id", text.joined_name(F.col("naml"), F.col("namf")).alias("name")))
_on("s_title_case", "occupation_list", "SELECT occ_id, occupation AS title FROM occupation_list", lambda o: o.select("occ_id", F.initcap(F.lower("occupation")).alias("title")))
_on("s_split_keywords", "contributors", "SELECT name_id, unnest(list_filter(list_transform(string_split_regex(lower(contributor_occupation), '[,/]'), lambda x: strip(x)), lambda x: x <> '')) AS keyword FROM contributors", lambda c: c.select("name_id", F.explode(text.split_keywords(F.col("contributor_occupation"))).alias("keyword")))
_on("s_split_code_label", "running_list", "SELECT ref_id, split_part(naics_code || ' - ' || naics_label, ' - ', 1) AS code, naics_label AS label FROM running_list WHERE naics_code IS NOT NULL AND naics_label IS NOT NULL", lambda r: r.filter("naics_code IS NOT NULL AND naics_label IS NOT NULL").select("ref_id", F.split(F.concat_ws(" - ", "naics_code", "naics_label"), " - ", 2).alias("p")).select("ref_id", F.col("p")[0].alias("code"), F.col("p")[1].alias("label")))
_map("s_surname", "contributors", "name_id", "contributor_name", lambda c: F.upper(F.split_part(c, F.lit(","), F.lit(1))), "upper(split_part(contributor_name, ',', 1))")
_ORG = text.ORGANISATION
_map("s_org_detector", "contributors", "name_id", "contributor_name", text.is_organisation, f"(regexp_matches(upper(coalesce(contributor_name, '')), '{_ORG}') OR NOT contains(coalesce(contributor_name, ''), ','))")
_map("s_pac_language", "filers", "filer_id", "naml", text.has_committee_language, f"regexp_matches(upper(coalesce(naml, '')), '\\b(?:{text.COMMITTEE_LANGUAGE})\\b')")
_on("s_flags", "filers", "SELECT filer_id, regexp_matches(upper(coalesce(naml, '')), '\\bFED(ERAL)? PAC\\b') AS federal, regexp_matches(upper(coalesce(naml, '')), '\\b(UNION|DUES|LOCAL|WORKERS)\\b') AS dues FROM filers", lambda f: f.select("filer_id", F.upper(F.coalesce("naml", F.lit(""))).rlike(r"\bFED(ERAL)? PAC\b").alias("federal"), F.upper(F.coalesce("naml", F.lit(""))).rlike(r"\b(UNION|DUES|LOCAL|WORKERS)\b").alias("dues")))
_on("s_individual_detector", "contributors", None, lambda c: c.select("name_id", text.is_individual(F.col("contributor_name")).alias("individual")))
_on("s_parse_person_name", "contributors", None, lambda c: c.filter("entity_kind = 'individual'").select("name_id", text.person_name(F.col("contributor_name")).alias("p")).select("name_id", "p.*"))
_JUNK = ", ".join("'" + x.replace("/", " ").replace("-", " ") + "'" for x in text.NO_EMPLOYER)
_on(
    "s_junk_employer",
    "contributors",
    f"SELECT name_id, ( norm(contributor_employer) IN ({_JUNK}) OR NOT regexp_matches( norm(contributor_employer), '[A-Z]') OR ( norm(split_part(coalesce(contributor_name, ''), ',', 1)) <> '' AND norm(contributor_employer) = norm(contributor_name))) AS junk FROM contributors",
    lambda c: c.select("name_id", text.is_junk_employer(F.col("contributor_employer"), F.col("contributor_name")).alias("junk")),
)
_map("s_clean_field", "contributors", "name_id", "contributor_employer", lambda c: F.when(R.strip(F.lower(F.coalesce(c, F.lit("")))).isin("", "nan", "none", "n/a"), "").otherwise(R.strip(c)), "CASE WHEN strip(lower(coalesce(contributor_employer, ''))) IN ('', 'nan', 'none', 'n/a') THEN '' ELSE strip(contributor_employer) END")
_map("s_unusable_individual", "contributors", "name_id", "contributor_occupation", lambda c: F.upper(F.coalesce(c, F.lit(""))).rlike(r"^\s*$|RETIRED|NOT EMPLOYED|UNEMPLOYED|SELF[- ]?EMPLOYED|INFORMATION REQUESTED"), "regexp_matches(upper(coalesce(contributor_occupation, '')), '^\\s*$|RETIRED|NOT EMPLOYED|UNEMPLOYED|SELF[- ]?EMPLOYED|INFORMATION REQUESTED')")
_map("s_parse_candidate", "filers", "filer_id", "naml", lambda c: F.when(c.rlike(r"\b(NO ON|OPPOS)"), None).otherwise(F.nullif(F.regexp_extract(c, r"COMMITTEE TO ELECT (.+)$", 1), F.lit(""))), "CASE WHEN regexp_matches(naml, '\\b(NO ON|OPPOS)') THEN NULL ELSE nullif(regexp_extract(naml, 'COMMITTEE TO ELECT (.+)$', 1), '') END")
_on("s_phonetic_key", "contributors", None, lambda c: c.select("name_id", similarity.phonetic_key(F.split_part("contributor_name", F.lit(","), F.lit(1))).alias("value")))
_PAIR = "FROM employers e JOIN running_list r ON split_part(e.employer_norm, ' ', 1) = split_part(r.name_norm, ' ', 1)"


def _pairs(spark, d):
    e = table(spark, d, "employers").select("employer_id", F.col("employer_norm").alias("a"), F.split_part("employer_norm", F.lit(" "), F.lit(1)).alias("k"))
    return e.join(table(spark, d, "running_list").select("ref_id", F.col("name_norm").alias("b"), F.split_part("name_norm", F.lit(" "), F.lit(1)).alias("k")), "k")


registry.add("s_jaro_winkler", f"SELECT e.employer_id, r.ref_id, e.employer_norm = r.name_norm AS same, jaro_winkler_similarity(e.employer_norm, r.name_norm) > 0.9 AS near {_PAIR}")(lambda spark, d: _pairs(spark, d).select("employer_id", "ref_id", (F.col("a") == F.col("b")).alias("same"), (similarity.jaro_winkler(F.col("a"), F.col("b")) > 0.9).alias("near")))
registry.add(
    "s_bigram_cosine",
    f"""WITH p AS (SELECT e.employer_id, r.ref_id, e.employer_norm AS a, r.name_norm AS b {_PAIR}),
        ga AS (SELECT employer_id, ref_id, substr(a, i, 2) AS g, count(*) AS n FROM p, LATERAL (SELECT unnest(range(1, greatest(length(a), 2))) AS i) GROUP BY 1, 2, 3),
        gb AS (SELECT employer_id, ref_id, substr(b, i, 2) AS g, count(*) AS n FROM p, LATERAL (SELECT unnest(range(1, greatest(length(b), 2))) AS i) GROUP BY 1, 2, 3),
        na AS (SELECT employer_id, ref_id, sqrt(sum(n * n)) AS l FROM ga GROUP BY 1, 2), nb AS (SELECT employer_id, ref_id, sqrt(sum(n * n)) AS l FROM gb GROUP BY 1, 2)
        SELECT ga.employer_id, ga.ref_id, round(sum(ga.n * gb.n) / (any_value(na.l) * any_value(nb.l)), 6) AS cosine FROM ga JOIN gb USING (employer_id, ref_id, g) JOIN na USING (employer_id, ref_id) JOIN nb USING (employer_id, ref_id) GROUP BY 1, 2""",
)(lambda spark, d: _pairs(spark, d).select("employer_id", "ref_id", F.round(similarity.bigram_cosine(F.col("a"), F.col("b")), 6).alias("cosine")))
registry.add("s_substring_either", f"SELECT e.employer_id, r.ref_id, contains(e.employer_norm, r.name_norm) OR contains(r.name_norm, e.employer_norm) AS inside {_PAIR}")(lambda spark, d: _pairs(spark, d).select("employer_id", "ref_id", similarity.substring_either(F.col("a"), F.col("b")).alias("inside")))
registry.add(
    "s_name_key_match",
    f"SELECT employer_id, arg_min(ref_id, (rank, ref_id)) AS ref_id, min(rank) AS rank FROM (SELECT e.employer_id, r.ref_id, CASE WHEN e.employer_norm = r.name_norm THEN 1 WHEN starts_with(e.employer_norm, r.name_norm) OR starts_with(r.name_norm, e.employer_norm) THEN 2 ELSE 3 END AS rank {_PAIR}) GROUP BY 1",
)(
    lambda spark, d: _pairs(spark, d)
    .withColumn("rank", F.when(F.col("a") == F.col("b"), 1).when(F.col("a").startswith(F.col("b")) | F.col("b").startswith(F.col("a")), 2).otherwise(3))
    .groupBy("employer_id")
    .agg(F.min_by("ref_id", F.struct("rank", "ref_id")).alias("ref_id"), F.min("rank").alias("rank"))
)
_map("s_size_lower_bound", "edd_listings", "edd_id", "size_class", text.size_lower_bound, "coalesce(try_cast(replace(regexp_extract(coalesce(size_class, ''), '([0-9][0-9,]*)', 1), ',', '') AS BIGINT), -1)")
_on("s_extract_json_object", "events", "SELECT event_id, regexp_extract('reply: ' || props || ' end', '(?s)(\\{.*\\})', 1) AS value FROM events", lambda e: e.select("event_id", text.json_object(F.concat(F.lit("reply: "), "props", F.lit(" end"))).alias("value")))
_on("d_parse_rate", "contributions", "SELECT count(try_cast(start_date AS DATE)) AS parsed, count(*) AS n, round(avg(CASE WHEN start_date IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_share FROM contributions", lambda c: c.agg(F.count(F.try_to_date("start_date", "yyyy-MM-dd")).alias("parsed"), F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("start_date").isNull().cast("double")), 6).alias("null_share")))
_on("d_office_counts", "contributions", "SELECT office, count(*) AS n FROM contributions WHERE start_date > '2025-06-30' GROUP BY 1", lambda c: c.filter("start_date > '2025-06-30'").groupBy("office").agg(F.count(F.lit(1)).alias("n")))
_on("d_future", "contributions", "SELECT count(*) AS n FROM contributions WHERE try_cast(start_date AS DATE) > DATE '2030-01-01'", lambda c: c.filter(F.try_to_date("start_date", "yyyy-MM-dd") > F.lit("2030-01-01").cast("date")).agg(F.count(F.lit(1)).alias("n")))
_map("m_amount_text", "contributions", "row_id", "amount", values.amount_text, "regexp_replace(printf('%.2f', amount), '\\.00$', '')")
_on("m_weighted_score", "employers", "SELECT employer_id, round((CASE WHEN naics_code IS NOT NULL THEN 0.6 ELSE 0 END + CASE WHEN data_source_1 IS NOT NULL THEN 0.4 ELSE 0 END) / (0.6 + CASE WHEN entity_kind IS NULL THEN 0 ELSE 0.4 END), 6) AS score FROM employers", lambda e: e.select("employer_id", F.round((F.when(F.col("naics_code").isNotNull(), 0.6).otherwise(0.0) + F.when(F.col("data_source_1").isNotNull(), 0.4).otherwise(0.0)) / (0.6 + F.when(F.col("entity_kind").isNull(), 0.0).otherwise(0.4)), 6).alias("score")))
_on("m_vote_conf", "employers", "SELECT employer_norm, round(max(n) / sum(n), 6) AS conf FROM (SELECT employer_norm, level1_category, count(*) AS n FROM employers WHERE level1_category IS NOT NULL GROUP BY 1, 2) GROUP BY 1", lambda e: e.filter("level1_category IS NOT NULL").groupBy("employer_norm", "level1_category").agg(F.count(F.lit(1)).alias("n")).groupBy("employer_norm").agg(F.round(F.max("n") / F.sum("n"), 6).alias("conf")))
_map("m_round", "contributions", "row_id", "amount", lambda c: F.round(c / 3, 3), "round(amount / 3, 3)")
_on("m_data_sufficiency", "contributions", "SELECT recipient_committee_id, CASE WHEN sum(CASE WHEN transaction_type LIKE 'Monetary%' THEN amount END) > 0 THEN round(sum(amount) / sum(CASE WHEN transaction_type LIKE 'Monetary%' THEN amount END), 6) END AS ratio FROM contributions GROUP BY 1", lambda c: c.groupBy("recipient_committee_id").agg(F.sum("amount").alias("a"), F.sum(F.when(F.col("transaction_type").startswith("Monetary"), F.col("amount"))).alias("b")).select("recipient_committee_id", F.when(F.col("b") > 0, F.round(F.try_divide("a", "b"), 6)).alias("ratio")))
_map("m_log_bins", "contributions", "row_id", "amount", values.log_bin, "CASE WHEN amount > 0 THEN CAST(floor(log10(amount) * 4) AS BIGINT) END")
_on("h_hash_id", "employers", "SELECT employer_norm, 'E' || substr(sha256(array_to_string(list_sort(list(DISTINCT employer_id::VARCHAR)), '||')), 1, 16) AS unit_id FROM employers GROUP BY 1", lambda e: e.groupBy("employer_norm").agg(F.collect_list(F.col("employer_id").cast("string")).alias("k")).select("employer_norm", values.set_id(F.col("k"), "E").alias("unit_id")))
_on("a_explode_codes", "running_list", "SELECT ref_id, unnest(string_split(coalesce(naics_code, '') || '|' || coalesce(level1_category, ''), '|')) AS part FROM running_list", lambda r: r.select("ref_id", F.explode(F.split(F.concat(F.coalesce("naics_code", F.lit("")), F.lit("|"), F.coalesce("level1_category", F.lit(""))), r"\|")).alias("part")))
_on("a_zip_lists", "running_list", "SELECT ref_id, unnest(string_split(name_norm, ' ')) AS word, unnest(string_split(upper(ref_name), ' ')) AS typed FROM running_list", lambda r: r.select("ref_id", F.explode(values.zipped_rows(F.col("name_norm"), F.upper("ref_name"), sep=" ")).alias("z")).select("ref_id", F.col("z.0").alias("word"), F.col("z.1").alias("typed")))
_on("a_filter_codes", "edd_listings", "SELECT edd_id, list_filter([edd_naics_code, left(edd_naics_code, 2), left(edd_naics_code, 4)], lambda x: length(x) = 4) AS fours FROM edd_listings WHERE edd_naics_code IS NOT NULL", lambda l: l.filter("edd_naics_code IS NOT NULL").select("edd_id", F.filter(F.array("edd_naics_code", F.substring("edd_naics_code", 1, 2), F.substring("edd_naics_code", 1, 4)), lambda x: F.length(x) == 4).alias("fours")))
_on("a_pivot_longer", "filers", "SELECT filer_id, 'naml' AS part, naml AS value FROM filers UNION ALL SELECT filer_id, 'namf', namf FROM filers", lambda f: f.unpivot(["filer_id"], ["naml", "namf"], "part", "value"))
_on("a_named_add", "contributions", "SELECT recipient_committee_id, office, round(sum(amount), 2) AS amount FROM contributions WHERE amount IS NOT NULL GROUP BY 1, 2", lambda c: c.filter("amount IS NOT NULL").groupBy("recipient_committee_id", "office").agg(F.round(F.sum("amount"), 2).alias("amount")))
_on("a_concat_ids", "employers", "SELECT employer_norm, string_agg(employer_id::VARCHAR, ';' ORDER BY employer_id) AS ids FROM employers GROUP BY 1", lambda e: e.groupBy("employer_norm").agg(F.array_join(F.transform(F.array_sort(F.collect_list("employer_id")), lambda x: x.cast("string")), ";").alias("ids")))
_map("j_props", "events", "event_id", "props", lambda c: values.json_field(c, "k").cast("bigint"), "CAST(json_extract_string(props, '$.k') AS BIGINT)")
