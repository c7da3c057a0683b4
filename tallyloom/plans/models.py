"""Text features, training, evaluation and benchmarks of classifiers; batches, retries and providers of enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.operators import learning as L
from tallyloom.operators import rules as R
from tallyloom.operators.groups import numbered
from tallyloom.operators.joins import not_in
from tallyloom.plans.more import _WORDS, _case
from tallyloom.plans.registry import Registry
from tallyloom.plans.rules import KEYWORDS
from tallyloom.session import cut, table
from tallyloom.sources import files

registry = Registry()
add = registry.add

_SPLIT = "list_filter(string_split(lower({0}), ' '), lambda x: x <> '')"
_WEIGHT = """c AS (SELECT key, term, count(*) AS n FROM g GROUP BY 1, 2), m AS (SELECT count(*) AS rows FROM running_list),
  df AS (SELECT term, count(*) AS df, sum(n) AS t FROM c GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.9 * (SELECT rows FROM m) ORDER BY t DESC, term LIMIT {0}),
  x AS (SELECT key, term, (1 + ln(n)) * (ln((1 + rows) / (1 + df)) + 1) AS w FROM c JOIN df USING (term), m) SELECT key, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY key)), 6) AS weight FROM x"""


@add("ml_tfidf_word", f"WITH w AS (SELECT ref_id AS key, {_SPLIT.format('name_norm')} AS w FROM running_list), g AS (SELECT key, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w), " + _WEIGHT.format(5000))
def ml_tfidf_word(spark: SparkSession, d: str) -> DataFrame:
    return L.tfidf(table(spark, d, "running_list"), "ref_id", "name_norm", terms=L.word_grams, limit=5000).select("key", "term", F.round("weight", 6).alias("weight"))


@add("ml_tfidf_char", f"WITH w AS (SELECT ref_id AS key, {_SPLIT.format('name_norm')} AS w FROM running_list), g AS (SELECT key, unnest(flatten(list_transform(w, lambda x: flatten(list_transform(range(2, 6), lambda n: list_transform(range(1, length(x) + 4 - n), lambda i: substr(' ' || x || ' ', i, n))))))) AS term FROM w), " + _WEIGHT.format(3000))
def ml_tfidf_char(spark: SparkSession, d: str) -> DataFrame:
    return L.tfidf(table(spark, d, "running_list"), "ref_id", "name_norm", terms=L.char_grams, limit=3000).select("key", "term", F.round("weight", 6).alias("weight"))


@add(
    "ml_encode",
    f"""WITH g AS (SELECT employer_norm AS key, unnest({_SPLIT.format('employer_norm')}) AS term FROM (SELECT DISTINCT employer_norm FROM employers)), c AS (SELECT key, CAST('0x' || substr(md5(term), 1, 4) AS INTEGER) % 256 AS dim, count(*) AS n FROM g GROUP BY 1, 2)
        SELECT key, dim, round(n / sqrt(sum(n * n) OVER (PARTITION BY key)), 6) AS value FROM c""",
)
def ml_encode(spark: SparkSession, d: str) -> DataFrame:
    """Each different text is encoded once; rows find theirs by it."""
    return L.hashed(table(spark, d, "employers").select("employer_norm").distinct(), "employer_norm", "employer_norm").select("key", "dim", F.round("value", 6).alias("value"))


_HELD = "CAST('0x' || substr(md5(employer_id || '|42'), 1, 4) AS INTEGER) < 13107"


@add("ml_split", f"SELECT level1_category AS label, count(CASE WHEN NOT h THEN 1 END) AS n_train, count(CASE WHEN h THEN 1 END) AS n_test FROM (SELECT level1_category, {_HELD} AS h FROM employers WHERE level1_category IS NOT NULL) GROUP BY 1 HAVING count(*) >= 5 QUALIFY sum(count(*)) OVER () >= 100")
def ml_split(spark: SparkSession, d: str) -> DataFrame:
    kept = L.split_by_hash(L.trainable(table(spark, d, "employers").select("employer_id", "level1_category"), "level1_category"), "employer_id")
    return kept.groupBy(F.col("level1_category").alias("label")).agg(F.count_if(~F.col("held_out")).alias("n_train"), F.count_if("held_out").alias("n_test"))


@add("ml_train_lr")
def ml_train_lr(spark: SparkSession, d: str) -> DataFrame:
    """Labels with support, four fifths to train and one to test, then once more on all: rows, top-1 and top-3 of both; no row with too few rows to train on."""
    e = table(spark, d, "employers").select("employer_id", F.lower("employer_norm").alias("text"), "level1_category")
    rows = cut(L.split_by_hash(L.trainable(e, "level1_category"), "employer_id"), "split")
    test = rows.filter("held_out")
    if not rows.limit(1).count():
        return spark.createDataFrame([], "n_test bigint, top1_test double, top3_test double, n_refit bigint, top1_refit double, top3_refit double")

    def scored(train: DataFrame, on: DataFrame, suffix: str) -> DataFrame:
        p = L.predict(L.train_classifier(train, "text", "level1_category"), on, "employer_id", "text").join(on.select("employer_id", "level1_category"), "employer_id")
        hit = lambda k: F.round(F.avg(L.in_top(F.col("level1_category"), F.col("top"), k).cast("double")), 4)
        return p.agg(F.count(F.lit(1)).alias(f"n{suffix}"), hit(1).alias(f"top1{suffix}"), hit(3).alias(f"top3{suffix}"))

    first = scored(rows.filter("NOT held_out"), test, "_test")
    again = scored(rows, rows, "_refit")  # on what it was trained on: shows that the refit took place, not how good it is
    return first.withColumn("one", F.lit(1)).join(again.withColumn("one", F.lit(1)), "one").drop("one")  # one row each


_MODEL = f"""t AS (SELECT label, unnest(list_distinct({_SPLIT.format('txt')})) AS term FROM train WHERE label IS NOT NULL), m AS (SELECT term, label, count(*) / sum(count(*)) OVER (PARTITION BY term) AS share FROM t GROUP BY 1, 2),
  p AS (SELECT key, label, round(sum(share), 9) AS s FROM (SELECT key, unnest(list_distinct({_SPLIT.format('txt')})) AS term FROM rows) JOIN m USING (term) GROUP BY 1, 2),
  r AS (SELECT key, list(label ORDER BY s DESC, label)[1:3] AS top FROM p GROUP BY 1)"""
_EMPLOYERS = f"WITH train AS (SELECT level1_category AS label, name_norm AS txt FROM running_list), rows AS (SELECT employer_id AS key, employer_norm AS txt FROM employers), {_MODEL}"
_HIT = "coalesce(list_contains(list_transform(top[1:{0}], lambda x: upper(trim(x))), upper(trim(level1_category))), false)"
_RATES = f"count(*) AS n, round(avg(CASE WHEN {_HIT.format(1)} THEN 1.0 ELSE 0.0 END), 6) AS top1, round(avg(CASE WHEN {_HIT.format(3)} THEN 1.0 ELSE 0.0 END), 6) AS top3"


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    """Labelled employers with the three likeliest labels by the words of the list's names."""
    model = L.word_votes(table(spark, d, "running_list"), "name_norm", "level1_category")
    e = table(spark, d, "employers")
    top = L.ranked_labels(model, e, "employer_id", "employer_norm")
    return e.filter("level1_category IS NOT NULL").select("employer_id", "employer", "employer_norm", "level1_category", "data_source_1").join(top.withColumnRenamed("key", "employer_id"), "employer_id", "left")


def _rates(df: DataFrame, *keys: str) -> DataFrame:
    hit = lambda k: F.round(F.avg(L.in_top(F.col("level1_category"), F.col("top"), k).cast("double")), 6)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), hit(1).alias("top1"), hit(3).alias("top3"))


@add("ml_topk", f"{_EMPLOYERS} SELECT level1_category AS label, {_RATES} FROM employers LEFT JOIN r ON r.key = employer_id WHERE level1_category IS NOT NULL GROUP BY 1")
def ml_topk(spark: SparkSession, d: str) -> DataFrame:
    return _rates(_predicted(spark, d).withColumn("label", F.col("level1_category")), "label")


_OOD = "employers LEFT JOIN r ON r.key = employer_id WHERE level1_category IS NOT NULL AND employer_norm NOT IN (SELECT name_norm FROM running_list)"


@add("ml_eval_ood", f"{_EMPLOYERS} SELECT coalesce(data_source_1, 'none') AS source, {_RATES} FROM {_OOD} GROUP BY 1 UNION ALL SELECT 'pooled', {_RATES} FROM {_OOD}")
def ml_eval_ood(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose name the training list does not have, by source and pooled."""
    unseen = not_in(_predicted(spark, d), table(spark, d, "running_list").select(F.col("name_norm").alias("employer_norm")), ["employer_norm"])
    both = unseen.select("level1_category", "top", F.explode(F.array(F.coalesce("data_source_1", F.lit("none")), F.lit("pooled"))).alias("source"))
    return _rates(both, "source")


_STACKED = f"SELECT level1_category AS truth, top[1] AS base, coalesce({_case('employer', _WORDS)}, l.prior, top[1]) AS stack FROM employers LEFT JOIN r ON r.key = employer_id LEFT JOIN (SELECT name_norm, level1_category AS prior FROM running_list) l ON l.name_norm = employer_norm WHERE level1_category IS NOT NULL"


@add("ml_stack_benchmark", f"{_EMPLOYERS}, s AS ({_STACKED}), h AS (SELECT coalesce(base = truth, false) AS b, coalesce(stack = truth, false) AS s FROM s) SELECT count(*) AS n, count(CASE WHEN b THEN 1 END) AS baseline, count(CASE WHEN s THEN 1 END) AS stacked, count(CASE WHEN s AND NOT b THEN 1 END) AS fixed, count(CASE WHEN b AND NOT s THEN 1 END) AS broken FROM h")
def ml_stack_benchmark(spark: SparkSession, d: str) -> DataFrame:
    """Rules, then the list, then the model, against the model alone: right answers of both, errors mended and rows broken."""
    prior = table(spark, d, "running_list").select(F.col("name_norm").alias("employer_norm"), F.col("level1_category").alias("prior"))
    rows = _predicted(spark, d).join(prior, "employer_norm", "left")
    base = F.try_element_at("top", F.lit(1))
    right = lambda c: F.coalesce(c == F.col("level1_category"), F.lit(False))
    h = rows.select(right(base).alias("b"), right(F.coalesce(R.longest_keyword(F.col("employer"), KEYWORDS), F.col("prior"), base)).alias("s"))
    return h.agg(F.count(F.lit(1)).alias("n"), F.count_if("b").alias("baseline"), F.count_if("s").alias("stacked"), F.count_if(F.col("s") & ~F.col("b")).alias("fixed"), F.count_if(F.col("b") & ~F.col("s")).alias("broken"))


_PROBE = f"WITH train AS (SELECT level1_category AS label, name_norm AS txt FROM running_list WHERE list_source <> 'manual'), rows AS (SELECT ref_id AS key, name_norm AS txt FROM running_list WHERE list_source = 'manual'), {_MODEL}"


@add("ml_probe", f"{_PROBE} SELECT ref_id, level1_category AS expected, coalesce({_case('ref_name', _WORDS)}, top[1]) AS got, coalesce(coalesce({_case('ref_name', _WORDS)}, top[1]) = level1_category, false) AS ok FROM running_list LEFT JOIN r ON r.key = ref_id WHERE list_source = 'manual'")
def ml_probe(spark: SparkSession, d: str) -> DataFrame:
    """Organisations whose class is known for sure, put to a model that has not seen them."""
    r = table(spark, d, "running_list")
    known = r.filter("list_source = 'manual'")
    top = L.ranked_labels(L.word_votes(r.filter("list_source <> 'manual'"), "name_norm", "level1_category"), known, "ref_id", "name_norm", 1)
    got = F.coalesce(R.longest_keyword(F.col("ref_name"), KEYWORDS), F.try_element_at("top", F.lit(1)))
    joined = known.join(top.withColumnRenamed("key", "ref_id"), "ref_id", "left")
    return joined.select("ref_id", F.col("level1_category").alias("expected"), got.alias("got"), F.coalesce(got == F.col("level1_category"), F.lit(False)).alias("ok"))


_SEEDS = "SELECT lower(occupation) AS text, naics_code AS label FROM occupation_list"
_SERVED = "CASE WHEN nullif(strip(lower(contributor_employer)), '') IS NOT NULL THEN strip(lower(contributor_occupation)) || ' at ' || strip(lower(contributor_employer)) ELSE strip(lower(contributor_occupation)) END"


@add("ml_augment", f"{_SEEDS} UNION SELECT {_SERVED}, o.naics_code FROM contributors c JOIN occupation_list o ON strip(lower(c.contributor_occupation)) = lower(o.occupation) WHERE c.entity_kind = 'individual'")
def ml_augment(spark: SparkSession, d: str) -> DataFrame:
    """Seeds of the list, and individuals whose occupation it has, in the form that rows are served in."""
    o = table(spark, d, "occupation_list").select(F.lower("occupation").alias("text"), F.col("naics_code").alias("label"))
    c = table(spark, d, "contributors").filter("entity_kind = 'individual'")
    served = c.select(text.clean_key(F.col("contributor_occupation")).alias("text"), text.embed_text(F.col("contributor_occupation"), F.col("contributor_employer"), F.col("contributor_name")).alias("served"))
    return o.unionByName(served.join(o, "text").select(F.col("served").alias("text"), "label")).distinct()


def _units(width: int) -> str:
    return f"SELECT search_key, CAST(floor((n - 1) / {width}) AS BIGINT) AS batch, CAST((n - 1) % {width} AS BIGINT) AS pos FROM (SELECT search_key, row_number() OVER (ORDER BY search_key) AS n FROM (SELECT DISTINCT search_key FROM web_search_cache WHERE search_key IS NOT NULL))"


@add("llm_batching", f"SELECT 50 AS width, u.*, upper(search_key) AS answer FROM ({_units(50)}) u UNION ALL SELECT 15, u.*, upper(search_key) FROM ({_units(15)}) u")
def llm_batching(spark: SparkSession, d: str) -> DataFrame:
    """Dense batches of 50 units, and of 15 where four digits are asked for; each batch is one call, whose answers are aligned by position."""
    units = table(spark, d, "web_search_cache").filter("search_key IS NOT NULL").select("search_key").distinct()
    n = cut(numbered(units, "search_key", "n"), "units")
    out = [files.answered(n.withColumn("batch", F.floor((F.col("n") - 1) / w)).withColumn("pos", (F.col("n") - 1) % w), "search_key", _answers).select(F.lit(w).alias("width"), "search_key", "batch", "pos", "answer") for w in (50, 15)]
    return out[0].unionByName(out[1])


def _answers(units: list[str]) -> list[str]:
    """A client that answers a batch in its order."""
    return [u.upper() for u in units]


@add("llm_retry_pass", "SELECT search_id, CASE WHEN coalesce(industry_summary, '') IN ('', 'Did not find') THEN CASE WHEN search_id % 3 = 0 THEN industry_summary ELSE 'second ' || search_id END ELSE industry_summary END AS summary, CAST(CASE WHEN coalesce(industry_summary, '') IN ('', 'Did not find') THEN 2 ELSE 1 END AS INTEGER) AS pass FROM web_search_cache")
def llm_retry_pass(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a bad or blank summary are asked again; the second answer counts unless it is bad too."""
    bad = lambda c: F.coalesce(c, F.lit("")).isin("", "Did not find")
    w = table(spark, d, "web_search_cache").select("search_id", "industry_summary")
    again = files.looked_up(w.filter(bad(F.col("industry_summary"))).select(F.col("search_id").cast("string").alias("key")), spark.createDataFrame([], "key string, result string"), "key", fetch=_second)
    answers = again.select(F.col("key").cast("bigint").alias("search_id"), F.get_json_object("result", "$.summary").alias("again"))
    asked = bad(F.col("industry_summary"))
    return w.join(answers, "search_id", "left").select("search_id", F.when(asked & ~bad(F.col("again")), F.col("again")).otherwise(F.col("industry_summary")).alias("summary"), F.when(asked, 2).otherwise(1).alias("pass"))


def _second(key: str) -> dict:
    return {"summary": "Did not find" if int(key) % 3 == 0 else f"second {key}"}


@add("llm_backoff", "SELECT ref_id, CASE WHEN ref_id % 3 = 0 THEN 'error' ELSE 'fetched' END AS status FROM running_list")
def llm_backoff(spark: SparkSession, d: str) -> DataFrame:
    """A client that fails for some keys: tried again after each wait, then reported; all rows, in the tasks they lie in."""
    keys = table(spark, d, "running_list").select(F.col("ref_id").cast("string").alias("key"))
    empty = spark.createDataFrame([], "key string, result string")
    return files.looked_up(keys, empty, "key", fetch=files.retrying(_client, waits=(0.0, 0.0, 0.0))).select(F.col("key").cast("bigint").alias("ref_id"), "status")


def _client(key: str) -> dict:
    if int(key) % 3 == 0:
        raise ConnectionError(key)
    return {"key": key}


@add("llm_provider_dispatch", "SELECT search_id, CASE search_id % 3 WHEN 0 THEN 'a:' || search_id WHEN 1 THEN 'b:' || search_id ELSE 'c:' || search_id END AS reply FROM web_search_cache")
def llm_provider_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Three providers behind one function, chosen by name; an unknown name is an error."""
    providers = {"first": _provider("a"), "second": _provider("b"), "third": _provider("c")}
    name = F.element_at(F.array(*[F.lit(n) for n in providers]), (F.col("search_id") % 3 + 1).cast("int"))
    w = table(spark, d, "web_search_cache").select("search_id", F.concat_ws("|", name, "search_id").alias("key"))
    got = files.looked_up(w.select("key"), spark.createDataFrame([], "key string, result string"), "key", fetch=files.dispatched(providers))
    return w.join(got, "key").select("search_id", F.get_json_object("result", "$.reply").alias("reply"))


def _provider(letter: str):
    return lambda key: {"reply": f"{letter}:{key}"}

