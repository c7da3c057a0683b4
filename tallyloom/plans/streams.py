"""Streams over events, and sources and sinks written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.registry import Registry
from tallyloom.session import shared_dir, table
from tallyloom.sources import files
from tallyloom.streaming import streams as S

registry = Registry()
add = registry.add


def _events(spark: SparkSession, d: str) -> DataFrame:
    return S.stream_table(spark, d, "events")


def _place(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@add("st_incremental_append", "SELECT event_id, user_id, event_type FROM events")
def st_incremental_append(spark: SparkSession, d: str) -> DataFrame:
    return S.run_available(S.first_seen(_events(spark, d), "event_id", "ts").select("event_id", "user_id", "event_type"))


#: Windows that the watermark, a day behind the latest event, has closed; later ones are still open and not given yet.
_CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM events)"


@add("st_tumbling", f"SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, value FROM events) WHERE start + INTERVAL 1 HOUR <= {_CLOSED} GROUP BY 1, 2")
def st_tumbling(spark: SparkSession, d: str) -> DataFrame:
    w = S.tumbling(_events(spark, d), "ts", "1 hour", "event_type", n=F.count(F.lit(1)), total=F.round(F.sum("value"), 4))
    return S.run_available(w).select("start", "event_type", "n", "total")


@add("st_sliding", f"SELECT b + INTERVAL (i * 30) MINUTE AS start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events), (SELECT unnest([0, -1]) AS i) WHERE b + INTERVAL (i * 30 + 60) MINUTE <= {_CLOSED} GROUP BY 1")
def st_sliding(spark: SparkSession, d: str) -> DataFrame:
    return S.run_available(S.sliding(_events(spark, d), "ts", "1 hour", "30 minutes", n=F.count(F.lit(1)))).select("start", "n")


@add(
    "st_session",
    f"""SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s
        HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}""",
)
def st_session(spark: SparkSession, d: str) -> DataFrame:
    return S.run_available(S.sessions(_events(spark, d), "ts", "30 minutes", "user_id", n=F.count(F.lit(1)))).select("user_id", "start", "n")


@add("src_csv_text", "SELECT filer_id, coalesce(naml, '') AS naml FROM filers")
def src_csv_text(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "csv")
    table(spark, d, "filers").select("filer_id", F.coalesce("naml", F.lit("")).alias("naml")).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return files.read_csv(spark, path, ["filer_id", "naml"])


@add("src_csv_infer", "SELECT name_id, CAST(contributor_zip_code AS VARCHAR) AS zip, try_cast(contributor_zip_code AS BIGINT) AS number FROM contributors WHERE contributor_zip_code IS NOT NULL")
def src_csv_infer(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "csv")
    table(spark, d, "contributors").filter("contributor_zip_code IS NOT NULL").select("name_id", F.col("contributor_zip_code").alias("zip"), F.col("contributor_zip_code").alias("number")).write.option("header", True).csv(path)
    return files.read_csv_typed(spark, path, {"name_id": "bigint", "number": "bigint"})


@add("src_tsv_lenient", "SELECT occ_id::VARCHAR AS occ_id, occupation FROM occupation_list")
def src_tsv_lenient(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "tsv")
    lines = table(spark, d, "occupation_list").select(F.concat_ws("\t", F.col("occ_id").cast("string"), "occupation").alias("value"))
    lines.unionByName(spark.createDataFrame([("a\tb\tc\td",)], "value string")).coalesce(1).write.text(path)
    return spark.read.option("sep", "\t").option("mode", "DROPMALFORMED").option("quote", "").schema(files.text_schema(["occ_id", "occupation"])).csv(path)


@add("src_filtered_scan", "SELECT row_id FROM contributions WHERE transaction_type = 'Monetary Contribution' AND recipient_committee_id IN (SELECT filer_id FROM filers WHERE filer_type = 'CANDIDATE')")
def src_filtered_scan(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "filers").filter("filer_type = 'CANDIDATE'").select(F.col("filer_id").alias("recipient_committee_id"))
    return files.filtered_scan(table(spark, d, "contributions").select("row_id", "transaction_type", "recipient_committee_id"), ids, "recipient_committee_id", "transaction_type = 'Monetary Contribution'").select("row_id")


@add("src_rest_paged", "SELECT filer_id, naml FROM filers WHERE naml IS NOT NULL")
def src_rest_paged(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "filers").filter("naml IS NOT NULL").select(F.array("filer_id", "naml").alias("r"), F.pmod(F.xxhash64("filer_id"), F.lit(7)).alias("page"))
    pages = rows.groupBy("page").agg(F.to_json(F.struct(F.array(F.lit("filer_id"), F.lit("naml")).alias("columns"), F.collect_list("r").alias("rows"))).alias("page_text"))
    return files.json_pages(pages, "page_text").select(F.col("fields")["filer_id"].alias("filer_id"), F.col("fields")["naml"].alias("naml"))


@add("src_html_table", "SELECT ref_id, name_norm AS name, coalesce(naics_code, '') AS code FROM running_list")
def src_html_table(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<table><tr><th>name</th><th>code</th></tr><tr class='x'><td>"), "name_norm", F.lit("</td><td><b>"), F.coalesce("naics_code", F.lit("")), F.lit("</b></td></tr></table>"))
    rows = files.html_rows(table(spark, d, "running_list").select("ref_id", page.alias("html")), "ref_id", "html")
    return rows.filter("n = 1").select("ref_id", F.col("cells")[0].alias("name"), F.col("cells")[1].alias("code"))


@add("src_company_api", "SELECT ref_id, naics_code AS codes FROM running_list WHERE naics_code IS NOT NULL")
def src_company_api(spark: SparkSession, d: str) -> DataFrame:
    reply = F.concat(F.lit('{"industry_codes":[{"code":"'), "naics_code", F.lit('","code_scheme_id":"us_naics"},{"code":"x","code_scheme_id":"other"}]}'))
    return files.nested_codes(table(spark, d, "running_list").filter("naics_code IS NOT NULL").select("ref_id", reply.alias("j")), "ref_id", "j", "us_naics")


@add("src_remote_lookup", "SELECT e.employer_norm, CASE WHEN r.name_norm IS NULL THEN 'missing' ELSE 'cached' END AS status FROM (SELECT DISTINCT employer_norm FROM employers) e LEFT JOIN running_list r ON r.name_norm = e.employer_norm")
def src_remote_lookup(spark: SparkSession, d: str) -> DataFrame:
    cache = table(spark, d, "running_list").select(F.col("name_norm").alias("employer_norm"), F.to_json(F.struct("naics_code")).alias("result"))
    return files.looked_up(table(spark, d, "employers"), cache, "employer_norm").select("employer_norm", "status")


@add("src_cache_consolidate", "SELECT search_key, max(search_id) AS search_id FROM web_search_cache GROUP BY 1")
def src_cache_consolidate(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "web_search_cache").select("search_key", "search_id", "confidence")
    return files.consolidated([w.filter("search_id % 2 = 0"), w.filter("search_id % 2 = 1").drop("confidence")], "search_key", "search_id").select("search_key", "search_id")


@add("sink_append", "SELECT employer_norm, min(employer_id) AS employer_id FROM employers GROUP BY 1")
def sink_append(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "append")
    e = table(spark, d, "employers").groupBy("employer_norm").agg(F.min("employer_id").alias("employer_id"))
    files.append_new(e.filter("employer_id % 2 = 0"), path, "employer_norm")
    files.append_new(e, path, "employer_norm")
    return spark.read.parquet(path).select("employer_norm", "employer_id")


@add("sink_csv", "SELECT occ_id::VARCHAR AS occ_id, occupation FROM occupation_list")
def sink_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "out")
    files.write_csv(table(spark, d, "occupation_list"), path, ["occ_id", "occupation"])
    return files.read_csv(spark, path, ["occ_id", "occupation"])


