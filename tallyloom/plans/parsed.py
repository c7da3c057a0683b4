"""Texts, dates, amounts, pages, hashes and keys read from every form they are written in, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import similarity, text, values
from tallyloom.functions.rewrites import strip
from tallyloom.operators import joins as J
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()
add = registry.add


@add("h_row_hash", "SELECT row_id, sha256(concat_ws('|', start_date, printf('%.2f', amount), contributor_name)) AS hash FROM contributions")
def h_row_hash(spark: SparkSession, d: str) -> DataFrame:
    amount = F.when(F.col("amount").isNotNull(), F.format_string("%.2f", "amount"))
    return table(spark, d, "contributions").select("row_id", F.sha2(F.concat_ws("|", "start_date", amount, "contributor_name"), 256).alias("hash"))


@add("h_row_xxhash", "SELECT row_id, min(row_id) OVER (PARTITION BY start_date, amount, contributor_name, recipient_committee_id) AS first FROM contributions")
def h_row_xxhash(spark: SparkSession, d: str) -> DataFrame:
    """The first row with the same hash, which must be the first with the same values."""
    c = table(spark, d, "contributions").select("row_id", F.xxhash64("start_date", "amount", "contributor_name", F.isnull("start_date"), F.isnull("amount"), F.isnull("contributor_name"), "recipient_committee_id").alias("h"))
    return c.join(c.groupBy("h").agg(F.min("row_id").alias("first")), "h").select("row_id", "first")


_HEX = "sha256(employer_norm)"


@add("h_uuid", f"SELECT employer_norm, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '8' || substr(h, 14, 3), 'a' || substr(h, 18, 3), substr(h, 21, 12)) AS entity FROM (SELECT DISTINCT employer_norm, {_HEX} AS h FROM employers)")
def h_uuid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "employers").select("employer_norm").distinct().withColumn("entity", values.name_uuid(F.col("employer_norm")))


_O, _E = "nullif(strip(lower(contributor_occupation)), '')", "nullif(strip(lower(contributor_employer)), '')"


@add("s_embed_text", f"SELECT name_id, CASE WHEN o IS NOT NULL AND e IS NOT NULL THEN o || ' at ' || e ELSE coalesce(o, e, lower(contributor_name)) END AS value FROM (SELECT name_id, contributor_name, {_O} AS o, {_E} AS e FROM contributors)")
def s_embed_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select("name_id", text.embed_text(F.col("contributor_occupation"), F.col("contributor_employer"), F.col("contributor_name")).alias("value"))


_HOST = "nullif(regexp_replace(lower(regexp_extract(CASE WHEN regexp_matches({0}, '(?i)^[a-z]+://') THEN {0} ELSE 'http://' || {0} END, '(?i)^[a-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\\.', ''), '')"


@add("s_url_domain", f"SELECT search_id, {_HOST.format('urls')} AS value FROM web_search_cache")
def s_url_domain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "web_search_cache").select("search_id", text.url_domain(F.col("urls")).alias("value"))


@add(
    "src_web_multi",
    f"""WITH n AS (SELECT DISTINCT employer_norm AS k FROM employers),
        a AS (SELECT name_norm AS k, min(naics_label) AS v FROM running_list WHERE naics_label IS NOT NULL GROUP BY 1),
        b AS (SELECT edd_match_name AS k, min(edd_naics_description) AS v FROM edd_listings WHERE edd_naics_description IS NOT NULL GROUP BY 1),
        c AS (SELECT norm(contributor_employer) AS k, min(industry_summary) AS v, min({_HOST.format('urls')}) AS host FROM web_search_cache WHERE industry_summary IS NOT NULL GROUP BY 1),
        e AS (SELECT employer_norm AS k, min(naics_label) AS v FROM employers WHERE naics_label IS NOT NULL GROUP BY 1)
        SELECT n.k AS name, CASE WHEN a.v IS NOT NULL THEN 'list' WHEN b.v IS NOT NULL THEN 'register' WHEN c.v IS NOT NULL THEN 'web' WHEN e.v IS NOT NULL THEN 'label' ELSE 'none' END AS source,
               coalesce(a.v, b.v, c.v, e.v) AS description, CASE WHEN a.v IS NULL AND b.v IS NULL THEN c.host END AS domain FROM n LEFT JOIN a USING (k) LEFT JOIN b USING (k) LEFT JOIN c USING (k) LEFT JOIN e USING (k)""",
)
def src_web_multi(spark: SparkSession, d: str) -> DataFrame:
    """Five sources of a description in their order: the first that has one gives it; the web also gives the domain."""
    of = lambda name, key, v, *more: table(spark, d, name).filter(F.col(v).isNotNull()).groupBy(key.alias("k")).agg(F.min(v).alias(f"v_{name}"), *more)
    names = table(spark, d, "employers").select(F.col("employer_norm").alias("k")).distinct()
    sources = [
        of("running_list", F.col("name_norm"), "naics_label"),
        of("edd_listings", F.col("edd_match_name"), "edd_naics_description"),
        of("web_search_cache", text.normalize_name(F.col("contributor_employer")), "industry_summary", F.min(text.url_domain(F.col("urls"))).alias("host")),
        of("employers", F.col("employer_norm"), "naics_label"),
    ]
    joined = names
    for s in sources:
        joined = joined.join(s, "k", "left")
    found = [("v_running_list", "list"), ("v_edd_listings", "register"), ("v_web_search_cache", "web"), ("v_employers", "label")]
    source = F.coalesce(*[F.when(F.col(c).isNotNull(), n) for c, n in found], F.lit("none"))
    return joined.select(F.col("k").alias("name"), source.alias("source"), F.coalesce(*[c for c, _ in found]).alias("description"), F.when(F.col("v_running_list").isNull() & F.col("v_edd_listings").isNull(), F.col("host")).alias("domain"))


#: A page around each text, so that each place of a description is met; both engines read it.
_PAGE = """CASE doc_id % 4 WHEN 0 THEN '<html><META lang=en name=' || chr(34) || 'description' || chr(34) || ' content=' || chr(34) || replace(text, chr(34), '') || chr(34) || '><p>' || text || '</p>'
  WHEN 1 THEN '<meta property=' || chr(34) || 'og:description' || chr(34) || ' content=' || chr(34) || replace(text, chr(34), '') || chr(34) || '/><p>' || text || '</p>'
  WHEN 2 THEN '<p>short</p><p class=x>' || text || '</p><P>' || text || '</P>' ELSE '<div>' || text || '</div>' END"""
_Q = '["\'\']'
_IN_META = "nullif(regexp_extract(page, '(?is)<meta[^>]+{0}=" + _Q + "{1}" + _Q + "[^>]+content=" + _Q + "([^\"'']*)" + _Q + "', 1), '')"
_FIRST_LONG = "list_filter(list_transform(regexp_extract_all(page, '(?is)<p[^>]*>(.*?)</p>', 1), lambda p: squish(regexp_replace(p, '<[^>]+>', '', 'g'))), lambda p: length(p) > 60)[1]"


@add("s_html_description", f"SELECT doc_id, left(coalesce({_IN_META.format('name', 'description')}, {_IN_META.format('property', 'og:description')}, {_FIRST_LONG}), 400) AS value FROM (SELECT doc_id, {_PAGE} AS page FROM documents)")
def s_html_description(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.expr(_PAGE).alias("page")).select("doc_id", text.html_description(F.col("page")).alias("value"))


_DATE = "CASE row_id % 5 WHEN 0 THEN start_date WHEN 1 THEN substr(start_date, 6, 2) || '/' || substr(start_date, 9, 2) || '/' || substr(start_date, 1, 4) || ' 10:30:00' WHEN 2 THEN replace(start_date, '-', '') WHEN 3 THEN start_date || 'T23:59:59' ELSE 'about ' || start_date END"


@add("d_parse_multi", "SELECT row_id, CASE WHEN row_id % 5 = 4 THEN 'about ' || start_date WHEN try_cast(start_date AS DATE) IS NOT NULL THEN start_date END AS value FROM contributions WHERE start_date IS NULL OR try_cast(start_date AS DATE) IS NOT NULL")
def d_parse_multi(spark: SparkSession, d: str) -> DataFrame:
    """Each date in one of the notations, by row; other text passes through."""
    c = table(spark, d, "contributions").filter(F.col("start_date").isNull() | F.try_to_date("start_date", "yyyy-MM-dd").isNotNull())
    return c.select("row_id", values.iso_date(F.expr(_DATE)).alias("value"))


_MONEY = "CASE row_id % 6 WHEN 0 THEN '$' || {0} WHEN 1 THEN ' ' || {0} || ' ' WHEN 2 THEN '$1,' || lpad(CAST(row_id % 1000 AS VARCHAR(9)), 3, '0') || '.50' WHEN 3 THEN 'n/a' WHEN 4 THEN '' ELSE {0} || ' USD' END"


@add("m_clean_amount", "SELECT row_id, CASE row_id % 6 WHEN 0 THEN round(amount, 2) WHEN 1 THEN round(amount, 2) WHEN 2 THEN 1000.5 + row_id % 1000 END AS value FROM contributions")
def m_clean_amount(spark: SparkSession, d: str) -> DataFrame:
    """Amounts as they are typed, some of them none: what is no number becomes null."""
    c = table(spark, d, "contributions").select("row_id", F.when(F.col("amount").isNotNull(), F.format_string("%.2f", "amount")).alias("a"))
    return c.select("row_id", F.round(values.clean_amount(F.expr(_MONEY.format("a"))), 2).alias("value"))


@add("m_threshold_label", "SELECT n, CASE WHEN n % 1000000 = 0 THEN (n // 1000000)::VARCHAR || 'm' WHEN n % 1000 = 0 THEN (n // 1000)::VARCHAR || 'k' ELSE n::VARCHAR END AS label, count(*) AS n_rows FROM (SELECT CAST(pow(10, floor(log10(amount))) AS BIGINT) * (1 + row_id % 3) AS n FROM contributions WHERE amount >= 1) GROUP BY 1, 2")
def m_threshold_label(spark: SparkSession, d: str) -> DataFrame:
    """The thresholds that amounts fall under, each with its label."""
    c = table(spark, d, "contributions").filter("amount >= 1").select((F.pow(F.lit(10.0), F.floor(F.log10("amount"))).cast("bigint") * (1 + F.col("row_id") % 3)).alias("n"))
    return c.groupBy("n").agg(F.count(F.lit(1)).alias("n_rows")).select("n", values.threshold_text(F.col("n")).alias("label"), "n_rows")


_REPLY = """CASE search_id % 5 WHEN 0 THEN '```json' || chr(10) || to_json(named_struct('confidence', confidence, 'industry_summary', industry_summary)) || chr(10) || '```'
  WHEN 1 THEN 'Here it is: ' || to_json(named_struct('confidence', confidence)) WHEN 2 THEN 'I did not find it.' WHEN 3 THEN '{"confidence": "HIGH", "industry_' ELSE to_json(named_struct('industry_summary', industry_summary, 'confidence', confidence, 'more', 1)) END"""
_CONF = "lower(coalesce(confidence, 'low'))"


@add("j_llm_response", f"SELECT search_id, CASE WHEN search_id % 5 IN (2, 3) THEN 'low' ELSE {_CONF} END AS confidence, CASE WHEN search_id % 5 IN (1, 2, 3) OR coalesce(industry_summary, '') = '' THEN 'no summary' ELSE industry_summary END AS summary FROM web_search_cache")
def j_llm_response(spark: SparkSession, d: str) -> DataFrame:
    """Replies as models write them: fenced, with words before, with keys missing or added, cut off, and without an object."""
    w = table(spark, d, "web_search_cache").select("search_id", text.json_object(F.expr(_REPLY)).alias("j"))
    parsed = F.from_json("j", "confidence string, industry_summary string")
    return w.select("search_id", parsed.alias("p")).select("search_id", F.lower(F.coalesce("p.confidence", F.lit("low"))).alias("confidence"), F.coalesce(F.nullif("p.industry_summary", F.lit("")), F.lit("no summary")).alias("summary"))


@add("j_cache", "SELECT search_key, arg_max(coalesce(confidence, '?'), search_id) AS confidence, max(search_id) AS search_id FROM web_search_cache GROUP BY 1")
def j_cache(spark: SparkSession, d: str) -> DataFrame:
    """A cache stored as one JSON object a line, written, read and looked up by key; the newest entry of a key counts."""
    from tallyloom.sources import files

    path = files.fresh_path(spark, "cache")
    w = table(spark, d, "web_search_cache").select(F.col("search_key").alias("key"), F.to_json(F.struct("confidence", "search_id")).alias("value"))
    w.write.json(path)
    stored = spark.read.schema("key string, value string").json(path).select("key", F.from_json("value", "confidence string, search_id bigint").alias("v"))
    return stored.groupBy(F.col("key").alias("search_key")).agg(F.max_by(F.coalesce("v.confidence", F.lit("?")), "v.search_id").alias("confidence"), F.max("v.search_id").alias("search_id"))


@add("s_metaphone")
def s_metaphone(spark: SparkSession, d: str) -> DataFrame:
    """(surname, sound) of every different surname of an individual."""
    c = table(spark, d, "contributors").filter("entity_kind = 'individual'").select(F.upper(F.split_part("contributor_name", F.lit(","), F.lit(1))).alias("surname")).distinct()
    return c.select("surname", similarity.metaphone(F.col("surname")).alias("sound"))


_JUNK = "('', 'nan', 'none', 'n/a', 'na', 'null', 'unknown', 'information requested', 'requested', 'not available', 'x', 'xx', 'xxx')"


@add("s_clean_occupation", f"SELECT name_id, CASE WHEN strip(lower(coalesce(contributor_occupation, ''))) IN {_JUNK} THEN '' ELSE strip(contributor_occupation) END AS value FROM contributors")
def s_clean_occupation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").select("name_id", clean_occupation(F.col("contributor_occupation")).alias("value"))


def clean_occupation(c: Column) -> Column:
    """An occupation without blanks around it; '' for null and for texts that name none."""
    return F.when(strip(F.lower(F.coalesce(c, F.lit("")))).isin(*[x.strip(" '") for x in _JUNK.strip("()").split(",")]), "").otherwise(strip(c))


@add("join_as_of", """WITH w AS (SELECT contributor_state, searched_at AS t, max(search_id) AS v FROM web_search_cache WHERE contributor_state IS NOT NULL AND searched_at IS NOT NULL GROUP BY 1, 2)
  SELECT c.name_id, w.v AS search_id FROM contributors c ASOF LEFT JOIN w ON w.contributor_state = c.contributor_state AND w.t <= c.added_at""")
def join_as_of(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").select("name_id", "contributor_state", F.col("added_at").alias("t"))
    w = table(spark, d, "web_search_cache").select("contributor_state", F.col("searched_at").alias("t"), "search_id")
    return J.as_of(c, w, ["contributor_state"], "t", "search_id").select("name_id", "search_id")


def _classes(name: str, source: str, keys: list[str], ident: str, where: str = "true") -> None:
    """A query of the classes of equal keys: what its pairs would say, one row for each row that has a partner or not."""
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    over = f"OVER (PARTITION BY {', '.join(keys)})"
    add(name, f'SELECT {ident}, min({ident}) {over} AS "class", count(*) {over} - 1 AS n_links FROM (SELECT {ident}, {", ".join(keys)} FROM {source} WHERE {where}) WHERE {known}')(lambda spark, d: J.class_of(table(spark, d, source).filter(where).select(ident, *keys), keys, ident))


_classes("a_pairwise_combn", "employers", ["employer_norm"], "employer_id")
_classes("join_self_pairs_exact", "contributors", ["standardized_name", "contributor_city"], "name_id")
_HEADS = "SELECT filer_id, filer_type, split_part(upper(naml), ' ', 1) AS head FROM filers"


@add("join_self_pairs_all", f'SELECT filer_id, min(filer_id) OVER (PARTITION BY filer_type, head) AS "class", count(*) OVER (PARTITION BY filer_type, head) - 1 AS n_links FROM ({_HEADS}) WHERE filer_type IS NOT NULL AND head IS NOT NULL')
def join_self_pairs_all(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filers").select("filer_id", "filer_type", F.split_part(F.upper("naml"), F.lit(" "), F.lit(1)).alias("head"))
    return J.class_of(f, ["filer_type", "head"], "filer_id")


_TOKENS = "SELECT DISTINCT {0} AS {1}, unnest(list_distinct(list_append(string_split({0}, ' '), left({0}, 4) || '*'))) AS t FROM {2}"


@add(
    "join_fuzzy_threshold",
    f"WITH e AS ({_TOKENS.format('employer_norm', 'a', 'employers')}), r AS ({_TOKENS.format('name_norm', 'b', 'running_list')}), p AS (SELECT DISTINCT a, b FROM e JOIN r USING (t) WHERE least(length(a), length(b)) >= 0.7 * greatest(length(a), length(b))), "
    "s AS (SELECT a, b, round(jaro_winkler_similarity(a, b), 9) AS s FROM p) SELECT a AS employer_norm, arg_max(ref_id, (s, -ref_id)) AS ref_id FROM s JOIN running_list l ON l.name_norm = s.b WHERE s >= 0.95 GROUP BY 1",
)
def join_fuzzy_threshold(spark: SparkSession, d: str) -> DataFrame:
    """Names that share a word, or their first four letters, are compared; different names once, and equal ones not at all.

    Two names with a similarity of 0.95 and no word and no beginning in common are not met; nor can they differ by more than
    three tenths in length.
    """
    keys = lambda c: F.array_distinct(F.concat(F.split(c, " "), F.array(F.concat(F.substring(c, 1, 4), F.lit("*")))))
    e = table(spark, d, "employers").select(F.col("employer_norm").alias("a")).distinct().select("a", F.explode(keys(F.col("a"))).alias("t"))
    r = table(spark, d, "running_list").select(F.col("name_norm").alias("b"), "ref_id")
    held = r.select("b", F.explode(keys(F.col("b"))).alias("t")).distinct()
    short, long = F.least(F.length("a"), F.length("b")), F.greatest(F.length("a"), F.length("b"))
    pairs = e.hint("merge").join(held, "t").filter(short >= 0.7 * long).select("a", "b").distinct()
    scored = pairs.withColumn("s", F.round(similarity.jaro_winkler(F.col("a"), F.col("b")), 9)).filter("s >= 0.95").join(r, "b")
    return scored.groupBy(F.col("a").alias("employer_norm")).agg(F.max_by("ref_id", F.struct("s", -F.col("ref_id"))).alias("ref_id"))
