"""Entity resolution and graphs over donors, employers and the money between committees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import rewrites as R
from tallyloom.functions import similarity, text
from tallyloom.functions.rewrites import rewritten_sql, squish_sql
from tallyloom.operators import entities as E
from tallyloom.operators import graph
from tallyloom.operators.groups import best_row, conflicts
from tallyloom.plans.registry import Registry
from tallyloom.session import cut, table

registry = Registry()
add = registry.add


_V1 = squish_sql(rewritten_sql("upper(naml)", R.STANDARD_NAME))
_V2, _V3, _V4 = squish_sql(rewritten_sql(rewritten_sql("v1", R.COMMITTEE_IDS), R.COMMITTEE_WORDS)), "regexp_replace(v2, '\\s*\\([^)]*\\)', '', 'g')", squish_sql(rewritten_sql("v3", R.BUSINESS_WORDS))


@add("er_name_variants", f"SELECT filer_id, v1, v2, v3, {_V4} AS v4 FROM (SELECT *, {_V3} AS v3 FROM (SELECT *, {_V2} AS v2 FROM (SELECT filer_id, {_V1} AS v1 FROM filers)))")
def er_name_variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "filers").select("filer_id", *E.name_variants(F.col("naml")))


@add(
    "er_exact_cascade",
    """WITH a AS (SELECT employer_id, upper(employer) AS v1, employer_norm AS v2, regexp_replace(employer_norm, ' (INC|LLC|CORP|CO|LTD|LP)$', '', 'g') AS v3 FROM employers),
       l1 AS (SELECT employer_id, v1 AS key, 1 AS level FROM a WHERE v1 IN (SELECT v1 FROM a GROUP BY 1 HAVING count(*) > 1)),
       b AS (SELECT * FROM a WHERE employer_id NOT IN (SELECT employer_id FROM l1)), l2 AS (SELECT employer_id, v2, 2 FROM b WHERE v2 IN (SELECT v2 FROM b GROUP BY 1 HAVING count(*) > 1)),
       c AS (SELECT * FROM b WHERE employer_id NOT IN (SELECT employer_id FROM l2)) SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT employer_id, v3, 3 FROM c WHERE v3 IN (SELECT v3 FROM c GROUP BY 1 HAVING count(*) > 1)""",
)
def er_exact_cascade(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").select("employer_id", F.upper("employer").alias("v1"), F.col("employer_norm").alias("v2"), F.regexp_replace("employer_norm", " (INC|LLC|CORP|CO|LTD|LP)$", "").alias("v3"))
    return E.exact_cascade(e, "employer_id", ["v1", "v2", "v3"])


_RAREST = """w AS (SELECT employer_norm AS v, unnest(list_distinct(list_filter(string_split(employer_norm, ' '), lambda x: x <> ''))) AS t FROM (SELECT DISTINCT employer_norm FROM employers)),
  d AS (SELECT t, count(*) AS n FROM w GROUP BY 1), k AS (SELECT v, t FROM (SELECT v, t, row_number() OVER (PARTITION BY v ORDER BY n, t) AS r FROM w JOIN d USING (t)) WHERE r <= 2)"""


@add(
    "er_org_fuzzy",
    f"""WITH {_RAREST}, i AS (SELECT employer_norm AS v, min(employer_id) AS id FROM employers GROUP BY 1), p AS (SELECT DISTINCT a.v AS a, b.v AS b FROM k a JOIN k b USING (t) WHERE a.v < b.v)
       SELECT least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b FROM p JOIN i x ON x.v = p.a JOIN i y ON y.v = p.b WHERE jaro_winkler_similarity(p.a, p.b) >= 0.97""",
)
def er_org_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Different names that share one of their two rarest words, wherever they are; each name stands under its first employer_id."""
    e = table(spark, d, "employers").filter("employer_norm IS NOT NULL").groupBy(F.col("employer_norm").alias("v")).agg(F.min("employer_id").alias("id"))
    return E.similar_by_rare_words(e, "id", "v", 0.97).select("id_a", "id_b")


@add("er_org_links")
def er_org_links(spark: SparkSession, d: str) -> DataFrame:
    pairs = E.similar_pairs(table(spark, d, "employers").select("employer_id", "employer_norm"), "employer_id", "employer_norm")
    return pairs.select("id_a", "id_b", F.round("jw", 6).alias("jw"), F.round("cosine", 6).alias("cosine"), "link")


def _individuals(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").filter("entity_kind = 'individual'").withColumn("p", text.person_name(F.col("contributor_name")))
    status = lambda f: text.work_status(F.col(f))
    return c.select("name_id", F.substring("contributor_zip_code", 1, 5).alias("zip"), F.col("p.last").alias("last"), F.col("p.first").alias("first"), status("contributor_employer").alias("emp"), status("contributor_occupation").alias("occ"), text.standardize_city(F.col("contributor_city")).alias("city"))


def _indiv_pairs(people: DataFrame) -> DataFrame:
    keyed = people.select("name_id", "zip", similarity.metaphone(F.col("last")).alias("sound"), F.substring("first", 1, 1).alias("initial"))
    by_zip = E.pairs_within(keyed, ["sound", "zip"], "name_id").select("id_a", "id_b")
    return by_zip.unionByName(E.pairs_within(keyed, ["sound", "initial"], "name_id").select("id_a", "id_b")).distinct()


#: Employers and occupations that tell nothing about a person.
UNINFORMATIVE = ("", "UNKNOWN", "RETIRED", "NONE", "NOT EMPLOYED", "UNEMPLOYED", "SELF EMPLOYED")


@add("er_indiv_compare")
def er_indiv_compare(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of er_indiv_block by six comparators; employer and occupation have no weight where neither side tells one."""
    people = cut(_individuals(spark, d), "people")
    side = lambda x: people.select(F.col("name_id").alias(f"id_{x}"), *[F.col(c).alias(f"{x}_{c}") for c in people.columns if c != "name_id"])
    pairs = _indiv_pairs(people).join(side("a"), "id_a").join(side("b"), "id_b")
    jw = lambda c: F.coalesce(similarity.jaro_winkler(F.col(f"a_{c}"), F.col(f"b_{c}")), F.lit(0.0))
    same = lambda c: F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False)).cast("double")
    tells = lambda x, c: ~F.coalesce(F.col(f"{x}_{c}"), F.lit("")).isin(*UNINFORMATIVE)
    either = lambda c: tells("a", c) | tells("b", c)
    both = lambda c, s: F.when(tells("a", c) & tells("b", c), s).otherwise(0.0)
    always = F.lit(True)
    cosine = similarity.bigram_cosine(F.col("a_emp"), F.col("b_emp"))
    score = E.weighted_score([(jw("last"), 0.3, always), (jw("first"), 0.25, always), (both("emp", cosine), 0.25, either("emp")), (both("occ", same("occ")), 0.1, either("occ")), (same("zip"), 0.07, always), (jw("city"), 0.03, always)])
    tier = F.when(F.col("score") >= 0.92, "auto").when(F.col("score") >= 0.8, "review").otherwise("none")
    return pairs.withColumn("score", score).select("id_a", "id_b", F.round("score", 6).alias("score"), tier.alias("link"))


@add("er_freq_threshold", "SELECT name_id, CASE WHEN f.n >= 50 THEN 0.95 WHEN f.n >= 10 THEN 0.9 WHEN f.n >= 3 THEN 0.85 ELSE 0.8 END::DOUBLE AS least FROM (SELECT name_id, split_part(upper(contributor_name), ',', 1) AS k FROM contributors) c JOIN (SELECT split_part(upper(contributor_name), ',', 1) AS k, count(*) AS n FROM contributors GROUP BY 1) f USING (k)")
def er_freq_threshold(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").select("name_id", F.split_part(F.upper("contributor_name"), F.lit(","), F.lit(1)).alias("k"))
    f = c.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return c.join(f, "k").select("name_id", F.when(F.col("n") >= 50, 0.95).when(F.col("n") >= 10, 0.9).when(F.col("n") >= 3, 0.85).otherwise(0.8).alias("least"))


_EDGES = "SELECT l_suppkey AS parent, l_partkey % (SELECT count(*) FROM supplier) AS child, round(sum(l_extendedprice), 2) AS amount FROM lineitem WHERE l_suppkey <> l_partkey % (SELECT count(*) FROM supplier) GROUP BY 1, 2"


def _payments(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    n = table(spark, d, "supplier").count()
    return rows.select(F.col("l_suppkey").alias("parent"), F.pmod("l_partkey", F.lit(n)).alias("child"), "l_extendedprice").filter("parent <> child")


def _edges(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    l = _payments(spark, d, rows)
    return l.groupBy("parent", "child").agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"))


def money_edges(spark: SparkSession, d: str) -> DataFrame:
    """Money between committees, played by suppliers and the parts they sell, from all rows."""
    return _edges(spark, d, table(spark, d, "lineitem"))


@add(
    "er_components",
    f"""WITH RECURSIVE e AS ({_EDGES}), u AS (SELECT parent AS a, child AS b FROM e UNION SELECT child, parent FROM e), r AS (SELECT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
        SELECT node, min(seen) AS component FROM r GROUP BY 1""",
)
def er_components(spark: SparkSession, d: str) -> DataFrame:
    return graph.components(money_edges(spark, d).select(F.col("parent").alias("a"), F.col("child").alias("b")))


@add("er_cluster_uuid", "SELECT e.employer_norm AS cluster, CASE WHEN count(DISTINCT r.ref_id) = 0 THEN 'new' WHEN count(DISTINCT r.ref_id) = 1 THEN 'reuse' ELSE 'conflict' END AS status FROM employers e LEFT JOIN running_list r ON e.employer_norm = r.name_norm GROUP BY 1")
def er_cluster_uuid(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "employers").select(F.col("employer_norm").alias("cluster"), F.col("employer_norm").alias("name"))
    known = table(spark, d, "running_list").select(F.col("name_norm").alias("name"), F.col("ref_id").cast("string").alias("entity"))
    return E.registry_links(names, known).select("cluster", "status")


@add(
    "er_registry_merge",
    "SELECT name, arg_min(code, (p, i)) AS code FROM (SELECT name_norm AS name, naics_code AS code, 1 AS p, ref_id AS i FROM running_list WHERE naics_code IS NOT NULL UNION ALL SELECT employer_norm, naics_code, 2, employer_id FROM employers WHERE naics_code IS NOT NULL) GROUP BY 1",
)
def er_registry_merge(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "running_list").filter("naics_code IS NOT NULL").select(F.col("name_norm").alias("name"), F.col("naics_code").alias("code"), F.lit(1).alias("p"), F.col("ref_id").alias("i"))
    b = table(spark, d, "employers").filter("naics_code IS NOT NULL").select(F.col("employer_norm").alias("name"), F.col("naics_code").alias("code"), F.lit(2).alias("p"), F.col("employer_id").alias("i"))
    return best_row(a.unionByName(b), ["name"], F.struct(-F.col("p"), -F.col("i"))).select("name", "code")


@add("er_provisional_writeback", "SELECT name_norm AS name, true AS confirmed FROM running_list UNION ALL SELECT DISTINCT employer_norm, false FROM employers WHERE employer_norm NOT IN (SELECT name_norm FROM running_list)")
def er_provisional_writeback(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "running_list").select(F.col("name_norm").alias("name"), F.col("ref_id").cast("string").alias("entity"))
    return E.appended_names(known, table(spark, d, "employers").select(F.col("employer_norm").alias("name"), F.lit(None).cast("string").alias("entity"))).select("name", "confirmed")


@add(
    "er_review_queue",
    """SELECT k, count(DISTINCT contributor_name) AS n_names, round(max(t), 2) AS most FROM (SELECT norm(contributor_name) AS k, contributor_name, sum(sum(amount)) OVER (PARTITION BY norm(contributor_name), recipient_committee_id) AS t FROM contributions GROUP BY 1, 2, recipient_committee_id)
       GROUP BY 1 HAVING count(DISTINCT contributor_name) > 1 AND round(max(t), 2) >= 5000""",
)
def er_review_queue(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributions").select(text.normalize_name(F.col("contributor_name")).alias("k"), "contributor_name", "recipient_committee_id", "amount")
    totals = c.groupBy("k", "recipient_committee_id").agg(F.sum("amount").alias("t")).groupBy("k").agg(F.round(F.max("t"), 2).alias("most"))
    names = c.select("k", "contributor_name").distinct().groupBy("k").agg(F.count("contributor_name").alias("n_names"))
    return names.join(totals, "k").filter("n_names > 1 AND most >= 5000").select("k", "n_names", "most")


@add(
    "er_employer_longest",
    "SELECT standardized_name, arg_max(contributor_employer, (length(contributor_employer), contributor_employer)) AS employer FROM contributors WHERE contributor_employer IS NOT NULL AND standardized_name IS NOT NULL GROUP BY 1",
)
def er_employer_longest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributors").filter("contributor_employer IS NOT NULL AND standardized_name IS NOT NULL")
    return c.groupBy("standardized_name").agg(F.max_by("contributor_employer", F.struct(F.length("contributor_employer"), F.col("contributor_employer"))).alias("employer"))


@add("er_threshold_5k", "SELECT standardized_name, recipient_committee_id, round(sum(amount), 2) AS total FROM contributions GROUP BY 1, 2 HAVING round(sum(amount), 2) >= 5000")
def er_threshold_5k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributions").groupBy("standardized_name", "recipient_committee_id").agg(F.round(F.sum("amount"), 2).alias("total")).filter("total >= 5000")


@add("er_alias_conflict", "SELECT e.employer_id, e.naics_code FROM employers e JOIN (SELECT employer_norm FROM employers WHERE naics_code <> '99' GROUP BY 1 HAVING count(DISTINCT naics_code) > 1) c USING (employer_norm)")
def er_alias_conflict(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers")
    return e.join(conflicts(e.filter("naics_code <> '99'"), ["employer_norm"], "naics_code"), "employer_norm", "left_semi").select("employer_id", "naics_code")


@add(
    "er_cross_source_conflict",
    "SELECT e.employer_norm, min(e.naics_code) AS typed, min(l.edd_naics_code) AS listed FROM employers e JOIN edd_listings l ON e.employer_norm = norm(l.edd_match_name) WHERE e.naics_code IS NOT NULL AND l.edd_naics_code IS NOT NULL AND left(e.naics_code, 2) <> left(l.edd_naics_code, 2) GROUP BY 1",
)
def er_cross_source_conflict(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").filter("naics_code IS NOT NULL").select("employer_norm", "naics_code").distinct()
    l = table(spark, d, "edd_listings").filter("edd_naics_code IS NOT NULL").select(text.normalize_name(F.col("edd_match_name")).alias("employer_norm"), "edd_naics_code").distinct()
    return e.join(l, "employer_norm").filter("left(naics_code, 2) <> left(edd_naics_code, 2)").groupBy("employer_norm").agg(F.min("naics_code").alias("typed"), F.min("edd_naics_code").alias("listed"))


@add("er_suspected_org", f"SELECT name_id FROM contributors WHERE entity_kind = 'individual' AND regexp_matches(upper(contributor_name), '{text.ORGANISATION}')")
def er_suspected_org(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributors").filter((F.col("entity_kind") == "individual") & F.upper("contributor_name").rlike(text.ORGANISATION)).select("name_id")


@add("er_split_pac_direct", "SELECT CASE WHEN strip(coalesce(contributor_id, '')) <> '' THEN 'committee' ELSE 'direct' END AS route, count(*) AS n FROM contributions GROUP BY 1")
def er_split_pac_direct(spark: SparkSession, d: str) -> DataFrame:
    from tallyloom.functions.rewrites import strip

    return table(spark, d, "contributions").groupBy(F.when(strip(F.coalesce("contributor_id", F.lit(""))) != "", "committee").otherwise("direct").alias("route")).agg(F.count(F.lit(1)).alias("n"))


@add("gr_entity_group", "SELECT recipient_committee_id, contributor_name, CASE WHEN count(DISTINCT contributor_id) = 1 THEN concat_ws('|', recipient_committee_id, 'id:' || min(contributor_id)) ELSE concat_ws('|', recipient_committee_id, 'name:' || contributor_name) END AS entity FROM contributions WHERE contributor_name IS NOT NULL GROUP BY 1, 2")
def gr_entity_group(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contributions").select("recipient_committee_id", "contributor_name", "contributor_id")
    return E.entity_groups(c, "recipient_committee_id", "contributor_name", "contributor_id")


@add("gr_aggregate", "SELECT recipient_committee_id, standardized_name, round(sum(amount), 2) AS total FROM contributions WHERE amount IS NOT NULL GROUP BY 1, 2 HAVING round(sum(amount), 2) >= 0")
def gr_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contributions").filter("amount IS NOT NULL").groupBy("recipient_committee_id", "standardized_name").agg(F.round(F.sum("amount"), 2).alias("total")).filter("total >= 0")


@add(
    "gr_traverse_bfs",
    f"""WITH RECURSIVE e AS ({_EDGES}), r AS (SELECT DISTINCT parent AS seed, parent AS node, 0 AS depth FROM e UNION SELECT r.seed, e.child, r.depth + 1 FROM r JOIN e ON r.node = e.parent WHERE r.depth < 5)
        SELECT seed, node, min(depth) AS depth FROM r GROUP BY 1, 2""",
)
def gr_traverse_bfs(spark: SparkSession, d: str) -> DataFrame:
    """Walks of up to five steps, as surveyed, from every node that has children."""
    e = _payments(spark, d, table(spark, d, "lineitem"))
    return graph.reachable(e, e.select(F.col("parent").alias("node")).distinct(), 5)


@add("gr_id_propagation", "SELECT d.name, CASE WHEN count(DISTINCT f.filer_id) = 1 THEN min(f.filer_id) END AS filer_id FROM (SELECT DISTINCT upper(contributor_name) AS name FROM contributions) d JOIN filers f ON d.name = upper(f.naml) GROUP BY 1")
def gr_id_propagation(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "contributions").select(F.upper("contributor_name").alias("name")).distinct()
    f = table(spark, d, "filers").select(F.upper("naml").alias("name"), "filer_id")
    return names.join(f, "name").groupBy("name").agg(F.count_distinct("filer_id").alias("n"), F.min("filer_id").alias("f")).select("name", F.when(F.col("n") == 1, F.col("f")).alias("filer_id"))


@add("gr_type_priority", "SELECT filer_id, filer_type FROM (SELECT filer_id, filer_type, row_number() OVER (PARTITION BY filer_id ORDER BY CASE filer_type WHEN 'RECIPIENT COMMITTEE' THEN 1 WHEN 'MAJOR DONOR' THEN 2 ELSE 3 END, filer_type) AS r FROM filers) WHERE r = 1")
def gr_type_priority(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("filer_type") == "RECIPIENT COMMITTEE", 1).when(F.col("filer_type") == "MAJOR DONOR", 2).otherwise(3)
    return best_row(table(spark, d, "filers").select("filer_id", "filer_type"), ["filer_id"], -rank).select("filer_id", "filer_type")


@add("gr_classifiability", f"WITH e AS ({_EDGES}), i AS (SELECT child AS node, sum(amount) AS got FROM e GROUP BY 1), o AS (SELECT parent AS node, sum(amount) AS gave FROM e GROUP BY 1) SELECT node, round(got / gave, 6) AS sufficiency FROM i JOIN o USING (node) WHERE gave > 0")
def gr_classifiability(spark: SparkSession, d: str) -> DataFrame:
    e = money_edges(spark, d)
    got, gave = (e.groupBy(F.col(c).alias("node")).agg(F.sum("amount").alias(n)) for c, n in (("child", "got"), ("parent", "gave")))
    return got.join(gave, "node").filter("gave > 0").select("node", F.round(F.col("got") / F.col("gave"), 6).alias("sufficiency"))


@add("gr_resolvable_tag", "SELECT filer_id, CASE WHEN filer_status IS NULL THEN 'no status' WHEN filer_status <> 'ACTIVE' THEN 'closed' WHEN naml IS NULL THEN 'no name' ELSE 'resolvable' END AS tag FROM filers")
def gr_resolvable_tag(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "filers").select("filer_id", F.when(F.col("filer_status").isNull(), "no status").when(F.col("filer_status") != "ACTIVE", "closed").when(F.col("naml").isNull(), "no name").otherwise("resolvable").alias("tag"))


@add("gr_topo_order")
def gr_topo_order(spark: SparkSession, d: str) -> DataFrame:
    """The layer of each node by its highest child; null on and above cycles. SQL has no such fixed point: tested against brute force."""
    return graph.layers(money_edges(spark, d))


@add("gr_cycles")
def gr_cycles(spark: SparkSession, d: str) -> DataFrame:
    return graph.layers(money_edges(spark, d)).filter("layer IS NULL").select("node")


def _own(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("node"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("label"), F.lit(50000.0).alias("amount"))


#: Money is passed on in so many steps, as surveyed.
_STEPS = 5


def _passed_sql(own: str) -> str:
    """Tables n0 to nN of what each node's money consists of after each step."""
    steps = [f"n0 AS ({own})"]
    for k in range(_STEPS):
        steps.append(f"n{k + 1} AS (SELECT node, label, sum(amount) AS amount FROM (SELECT * FROM n0 UNION ALL SELECT e.parent, n{k}.label, e.amount * n{k}.amount / w.whole FROM n{k} JOIN w USING (node) JOIN e ON e.child = n{k}.node) GROUP BY 1, 2)")
    whole = "w AS (SELECT node, coalesce(own, 0) + coalesce(came, 0) AS whole FROM (SELECT node, sum(amount) AS own FROM n0 GROUP BY 1) FULL JOIN (SELECT parent AS node, sum(amount) AS came FROM e GROUP BY 1) USING (node))"
    return f"WITH e AS ({_EDGES}), {steps[0]}, {whole}, {', '.join(steps[1:])}"


@add("gr_industry_distribution", _passed_sql("SELECT s_suppkey AS node, 'N' || s_nationkey AS label, 50000.0::DOUBLE AS amount FROM supplier") + f" SELECT node, label, round(amount, 2) AS amount FROM n{_STEPS}")
def gr_industry_distribution(spark: SparkSession, d: str) -> DataFrame:
    return graph.passed_down(money_edges(spark, d), _own(spark, d), _STEPS).select("node", "label", F.round("amount", 2).alias("amount"))


@add("gr_resolvable_fraction", _passed_sql("SELECT s_suppkey AS node, 'own' AS label, 50000.0::DOUBLE AS amount FROM supplier") + f" SELECT node, round(amount / whole, 6) AS fraction FROM n{_STEPS} JOIN w USING (node)")
def gr_resolvable_fraction(spark: SparkSession, d: str) -> DataFrame:
    e = cut(money_edges(spark, d), "edges")
    own = table(spark, d, "supplier").select(F.col("s_suppkey").alias("node"), F.lit("own").alias("label"), F.lit(50000.0).alias("amount"))
    known = graph.passed_down(e, own, _STEPS).groupBy("node").agg(F.sum("amount").alias("known"))
    whole = own.select("node", "amount").unionByName(e.select(F.col("parent").alias("node"), "amount")).groupBy("node").agg(F.sum("amount").alias("whole"))
    return known.join(whole, "node").select("node", F.round(F.col("known") / F.col("whole"), 6).alias("fraction"))


@add(
    "gr_split_contribution",
    """WITH s AS (SELECT recipient_committee_id AS node, coalesce(office, 'none') AS label, sum(amount) AS a, sum(sum(amount)) OVER (PARTITION BY recipient_committee_id) AS t FROM contributions WHERE amount > 0 GROUP BY 1, 2)
       SELECT f.filer_id AS key, s.label, round(1000 * s.a / s.t, 3) AS amount FROM filers f JOIN s ON s.node = f.filer_id UNION ALL SELECT filer_id, 'uncategorised', 1000 FROM filers WHERE filer_id NOT IN (SELECT node FROM s WHERE node IS NOT NULL)""",
)
def gr_split_contribution(spark: SparkSession, d: str) -> DataFrame:
    from tallyloom.operators.groups import shares

    s = shares(table(spark, d, "contributions").filter("amount > 0").withColumn("label", F.coalesce("office", F.lit("none"))), ["recipient_committee_id"], ["label"], "amount")
    rows = table(spark, d, "filers").select(F.col("filer_id").alias("key"), F.col("filer_id").alias("node"), F.lit(1000.0).alias("amount"))
    parts = s.select(F.col("recipient_committee_id").alias("node"), "label", (F.col("share") / 100).alias("share"))
    return graph.split_by_shares(rows, parts, "key", "node", "amount").select("key", "label", F.round("amount", 3).alias("amount"))


@add("gr_seed_coverage", f"WITH e AS ({_EDGES}) SELECT parent AS seed, round(sum(CASE WHEN s.s_acctbal > 0 THEN amount ELSE 0 END) / sum(amount), 6) AS coverage FROM e JOIN supplier s ON s.s_suppkey = e.child GROUP BY 1")
def gr_seed_coverage(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("child"), "s_acctbal")
    return money_edges(spark, d).join(s, "child").groupBy(F.col("parent").alias("seed")).agg(F.round(F.sum(F.when(F.col("s_acctbal") > 0, F.col("amount")).otherwise(0.0)) / F.sum("amount"), 6).alias("coverage"))


@add("gr_pac_review_queue", f"WITH e AS ({_EDGES}) SELECT parent AS node, string_agg(DISTINCT n.n_name, ' | ' ORDER BY n.n_name) AS labels FROM e JOIN supplier s ON s.s_suppkey = e.child JOIN nation n ON n.n_nationkey = s.s_nationkey GROUP BY 1 HAVING count(DISTINCT n.n_name) > 1")
def gr_pac_review_queue(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("child"), "n_name")
    return money_edges(spark, d).join(s, "child").groupBy(F.col("parent").alias("node")).agg(F.array_sort(F.collect_set("n_name")).alias("l")).filter("size(l) > 1").select("node", F.array_join("l", " | ").alias("labels"))


@add("er_id_pairs", 'SELECT contributor_id, contributor_name AS name, min(contributor_name) OVER w AS "class", count(*) OVER w - 1 AS n_links FROM (SELECT DISTINCT contributor_id, contributor_name FROM contributions WHERE contributor_id IS NOT NULL AND contributor_name IS NOT NULL) WINDOW w AS (PARTITION BY contributor_id)')
def er_id_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The different names of one id: their class is named by the smallest, and each is linked to all others."""
    names = table(spark, d, "contributions").filter("contributor_id IS NOT NULL AND contributor_name IS NOT NULL").select("contributor_id", F.col("contributor_name").alias("name")).distinct()
    groups = names.groupBy("contributor_id").agg(F.min("name").alias("class"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return names.join(groups, "contributor_id").select("contributor_id", "name", "class", "n_links")


@add("er_bridge", 'SELECT search_key, standardized_name AS name, min(standardized_name) OVER w AS "class", count(*) OVER w - 1 AS n_links FROM (SELECT DISTINCT search_key, standardized_name FROM web_search_cache WHERE search_key IS NOT NULL AND standardized_name IS NOT NULL) WINDOW w AS (PARTITION BY search_key)')
def er_bridge(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "web_search_cache").filter("search_key IS NOT NULL AND standardized_name IS NOT NULL").select("search_key", F.col("standardized_name").alias("name")).distinct()
    groups = names.groupBy("search_key").agg(F.min("name").alias("class"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return names.join(groups, "search_key").select("search_key", "name", "class", "n_links")


_TIER = "CASE WHEN a.contributor_employer = b.contributor_employer AND a.contributor_zip_code = b.contributor_zip_code THEN 'auto' WHEN a.contributor_zip_code = b.contributor_zip_code THEN 'likely' WHEN a.contributor_city = b.contributor_city THEN 'review' ELSE 'none' END"


@add("er_link_tier", f'SELECT b.name_id, a.name_id AS "class", {_TIER} AS tier FROM (SELECT standardized_name, min(name_id) AS first FROM contributors GROUP BY 1) f JOIN contributors a ON a.name_id = f.first JOIN contributors b ON b.standardized_name = f.standardized_name AND b.name_id <> a.name_id')
def er_link_tier(spark: SparkSession, d: str) -> DataFrame:
    """Each record against the first one of its name: how surely the two are one."""
    c = table(spark, d, "contributors").filter("standardized_name IS NOT NULL").select("standardized_name", "name_id", "contributor_employer", "contributor_zip_code", "contributor_city")
    first = c.groupBy("standardized_name").agg(F.min_by(F.struct(*[F.col(x) for x in c.columns[1:]]), "name_id").alias("f"))
    same = lambda x: F.col(f"f.{x}") == F.col(x)
    tier = F.when(same("contributor_employer") & same("contributor_zip_code"), "auto").when(same("contributor_zip_code"), "likely").when(same("contributor_city"), "review").otherwise("none")
    return c.join(first, "standardized_name").filter("name_id <> f.name_id").select("name_id", F.col("f.name_id").alias("class"), tier.alias("tier"))


@add("er_indiv_block")
def er_indiv_block(spark: SparkSession, d: str) -> DataFrame:
    """(name_id, by_zip, by_initial, n_links): the classes of both blocks, and with how many others each individual is compared."""
    people = _individuals(spark, d)
    keyed = cut(people.select("name_id", "zip", similarity.metaphone(F.col("last")).alias("sound"), F.substring("first", 1, 1).alias("initial")), "keyed")
    return E.two_blocks(keyed, "name_id", ["sound", "zip"], ["sound", "initial"], "by_zip", "by_initial")


_HEAD = "split_part(employer_norm, ' ', 1)"


@add(
    "join_blocked",
    f"""SELECT employer_id, CASE WHEN employer_norm IS NOT NULL THEN min(employer_id) OVER (PARTITION BY employer_norm) END AS by_name, CASE WHEN employer_zip IS NOT NULL THEN min(employer_id) OVER (PARTITION BY employer_zip, head) END AS by_place,
        CASE WHEN employer_norm IS NOT NULL THEN count(*) OVER (PARTITION BY employer_norm) ELSE 1 END + CASE WHEN employer_zip IS NOT NULL THEN count(*) OVER (PARTITION BY employer_zip, head) ELSE 1 END - CASE WHEN employer_norm IS NOT NULL AND employer_zip IS NOT NULL THEN count(*) OVER (PARTITION BY employer_norm, employer_zip, head) ELSE 1 END - 1 AS n_links
        FROM (SELECT employer_id, employer_norm, employer_zip, {_HEAD} AS head FROM employers)""",
)
def join_blocked(spark: SparkSession, d: str) -> DataFrame:
    """Rows that meet by name, or by zip and first word: both classes of each row, and its number of different partners."""
    e = table(spark, d, "employers").select("employer_id", "employer_norm", "employer_zip", F.split_part("employer_norm", F.lit(" "), F.lit(1)).alias("head"))
    return E.two_blocks(e, "employer_id", ["employer_norm"], ["employer_zip", "head"], "by_name", "by_place")


@add(
    "join_bridge_pairs",
    'SELECT naics_code, employer_zip, employer_norm AS name, min(employer_norm) OVER w AS "class", count(*) OVER w - 1 AS n_links FROM (SELECT DISTINCT naics_code, employer_zip, employer_norm FROM employers WHERE naics_code IS NOT NULL AND employer_zip IS NOT NULL) WINDOW w AS (PARTITION BY naics_code, employer_zip)',
)
def join_bridge_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "employers").filter("naics_code IS NOT NULL AND employer_zip IS NOT NULL").select("naics_code", "employer_zip", F.col("employer_norm").alias("name")).distinct()
    groups = e.groupBy("naics_code", "employer_zip").agg(F.min("name").alias("class"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return e.join(groups, ["naics_code", "employer_zip"]).select("naics_code", "employer_zip", "name", "class", "n_links")
