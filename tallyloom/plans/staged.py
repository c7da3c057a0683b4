"""Files that are staged before a plan reads them, state, sinks that survive being run again, and the numbers of figures."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import values
from tallyloom.operators import groups as G
from tallyloom.plans.registry import Registry
from tallyloom.session import table
from tallyloom.sources import files

registry = Registry()
add = registry.add


@add("src_tsv_utf16", "SELECT filer_id, filer_type FROM filers WHERE filer_type IS NOT NULL")
def src_tsv_utf16(spark: SparkSession, d: str) -> DataFrame:
    path = files.fresh_path(spark, "utf16")
    f = table(spark, d, "filers").select(F.when(F.col("filer_type").isNotNull(), F.col("filer_id")).alias(" filer_id "), F.coalesce("filer_type", F.lit("?")).alias("filer_type  "))
    f.write.option("header", True).option("sep", "\t").option("encoding", "UTF-16").csv(path)
    return files.read_tsv_utf16(spark, path, "filer_id")


def _workbook(sheets: list[list[list[str]]]) -> bytes:
    """A workbook of text cells."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, rows in enumerate(sheets, 1):
            cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{escape(v)}</t></is></c>' for j, v in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


@add("src_excel", "SELECT occ_id::VARCHAR AS id, occupation AS name, coalesce(naics_code, '') AS code FROM occupation_list UNION ALL SELECT ref_id::VARCHAR, ref_name, '' FROM running_list")
def src_excel(spark: SparkSession, d: str) -> DataFrame:
    """Two sheets of one workbook, under a line of notes; the second one has a column less."""
    first = [[str(r["occ_id"]), r["occupation"], r["naics_code"] or ""] for r in table(spark, d, "occupation_list").collect()]  # fixed lists
    second = [[str(r["ref_id"]), r["ref_name"]] for r in table(spark, d, "running_list").select("ref_id", "ref_name").collect()]
    path = files.staged(spark, lambda: _workbook([[["notes"], ["id", "name", "code"], *first], [["notes"], ["id", "name"], *second]]), "book.xlsx")
    return files.read_sheets(spark, files.fetched(spark, path), (1, 2), skip=1).select("id", "name", "code")


@add("src_zip_members", "SELECT filer_id, coalesce(naml, '') AS naml, 'filers' AS member FROM filers UNION ALL SELECT occ_id::VARCHAR, occupation, 'occupations' FROM occupation_list")
def src_zip_members(spark: SparkSession, d: str) -> DataFrame:
    """Two members of an archive that holds more, found by the ends of their names, then read as files."""

    def archive() -> bytes:
        line = lambda *v: "\t".join(x.replace("\t", " ") for x in v)
        f = table(spark, d, "filers").select("filer_id", F.coalesce("naml", F.lit("")).alias("naml")).collect()  # fixed lists
        o = table(spark, d, "occupation_list").collect()
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("data/README.txt", "notes")
            z.writestr("data/CVR_FILERS.TSV", "\n".join([line("id", "name"), *(line(r["filer_id"], r["naml"]) for r in f)]))
            z.writestr("data/Occupations.tsv", "\n".join([line("id", "name"), *(line(str(r["occ_id"]), r["occupation"]) for r in o)]))
        return out.getvalue()

    found = files.zip_members(files.fetched(spark, files.staged(spark, archive, "archive.zip")), ("_filers.tsv", "occupations.tsv"))
    parts = []
    for (suffix, data), member in zip(found.items(), ("filers", "occupations")):
        path = files.staged(spark, lambda data=data: data, "member.tsv")
        parts.append(files.read_tsv(spark, path, ["filer_id", "naml"], "UTF-8").select("filer_id", F.coalesce("naml", F.lit("")).alias("naml"), F.lit(member).alias("member")))
    return parts[0].unionByName(parts[1])


@add("src_http_csv", "SELECT occ_id::VARCHAR AS occ_id, occupation FROM occupation_list")
def src_http_csv(spark: SparkSession, d: str) -> DataFrame:
    """A published sheet: fetched once on the driver by the function the caller passes in, stored, and read as a CSV."""
    rows = table(spark, d, "occupation_list").select("occ_id", "occupation").collect()  # a fixed list stands for the download
    data = "occ_id,occupation\n" + "\n".join(f'{r["occ_id"]},"{r["occupation"]}"' for r in rows)
    return files.read_csv(spark, files.staged(spark, data.encode, "sheet.csv"), ["occ_id", "occupation"])


@add("src_sheet_api", "SELECT filer_id, coalesce(filer_type, '') AS filer_type FROM filers")
def src_sheet_api(spark: SparkSession, d: str) -> DataFrame:
    """Rows as an interface gives them, cells of any type and rows cut short at empty ends, as text."""
    rows = table(spark, d, "filers").select("filer_id", "filer_type").collect()  # a fixed list
    return files.read_sheet(spark, lambda: [["filer_id", "filer_type"], *([r["filer_id"], r["filer_type"]] if r["filer_type"] else [r["filer_id"]] for r in rows)])


@add("src_json_state", "SELECT source_file AS name, count(*) AS n, 'saved' AS state FROM contributions GROUP BY 1 UNION ALL SELECT 'none', 0, 'missing' UNION ALL SELECT 'none', 0, 'broken'")
def src_json_state(spark: SparkSession, d: str) -> DataFrame:
    """State saved and loaded; where there is none, or none that can be read, the default."""
    path, broken = files.fresh_path(spark, "state"), files.fresh_path(spark, "broken")
    default = spark.createDataFrame([("none", 0)], "name string, n bigint")
    files.save_state(spark, path, default)
    files.save_state(spark, path, table(spark, d, "contributions").groupBy(F.col("source_file").alias("name")).agg(F.count(F.lit(1)).alias("n")))
    spark.createDataFrame([('{"name": "x", "n"',)], "value string").write.text(broken)
    at = lambda p, state: files.load_state(spark, p, default).select("name", "n", F.lit(state).alias("state"))
    return at(path, "saved").unionByName(at(files.fresh_path(spark, "nothing"), "missing")).unionByName(at(broken, "broken"))


@add("sink_backup", "SELECT occ_id, 'backup' AS at FROM occupation_list UNION ALL SELECT occ_id, 'now' FROM occupation_list WHERE occ_id % 2 = 0")
def sink_backup(spark: SparkSession, d: str) -> DataFrame:
    """Written over twice: the first state is in the backup, the last one in its place."""
    path = files.fresh_path(spark, "guarded")
    o = table(spark, d, "occupation_list").select("occ_id")
    for rows in (o, o.limit(0), o.filter("occ_id % 2 = 0")):
        files.backed_up(rows, path)
    return spark.read.parquet(f"{path}.bak").select("occ_id", F.lit("backup").alias("at")).unionByName(spark.read.parquet(path).select("occ_id", F.lit("now").alias("at")))


@add("sink_resume", "SELECT name_id, upper(contributor_name) AS done, CASE WHEN data_source = 'manual' THEN 1 ELSE 2 END AS run FROM contributors")
def sink_resume(spark: SparkSession, d: str) -> DataFrame:
    """A run that ended early is taken up where it stopped: each key is worked on once."""
    path = files.fresh_path(spark, "resumed")
    c = table(spark, d, "contributors").select("name_id", "contributor_name", "data_source")
    work = lambda n: lambda rows: rows.select("name_id", F.upper("contributor_name").alias("done"), F.lit(n).alias("run"))
    files.resumed(c.filter("data_source = 'manual'"), path, "name_id", work(1))
    files.resumed(c, path, "name_id", work(2))
    files.resumed(c, path, "name_id", work(3))
    return spark.read.parquet(path)


_TOTALS = "SELECT office, transaction_type, sum(amount) AS a FROM contributions WHERE amount > 0 AND office IS NOT NULL AND transaction_type IS NOT NULL GROUP BY 1, 2"


@add(
    "sink_figures",
    f"""WITH t AS ({_TOTALS}), s AS (SELECT office, transaction_type, a, 100 * a / sum(a) OVER (PARTITION BY office) AS share FROM t)
        SELECT 'pie' AS figure, office AS "group", CASE WHEN share < 5 THEN 'Other' ELSE transaction_type END AS slice, round(sum(a), 2) AS amount FROM s GROUP BY 1, 2, 3
        UNION ALL SELECT 'bar', office, transaction_type, round(share, 4) FROM s
        UNION ALL SELECT 'tier', CASE WHEN amount >= 100000 THEN '100k and more' WHEN amount >= 10000 THEN '10k to 100k' WHEN amount >= 1000 THEN '1k to 10k' ELSE 'under 1k' END, 'rows', count(*)::DOUBLE FROM contributions WHERE amount > 0 GROUP BY 2
        UNION ALL SELECT 'histogram', 'log', CAST(floor(log10(amount) * 4) AS BIGINT)::VARCHAR, count(*)::DOUBLE FROM contributions WHERE amount > 0 GROUP BY 3""",
)
def sink_figures(spark: SparkSession, d: str) -> DataFrame:
    """The numbers of each figure: pies with small slices folded, stacked bars, tiers and a histogram on a logarithmic axis."""
    c = table(spark, d, "contributions").filter("amount > 0")
    known = c.filter("office IS NOT NULL AND transaction_type IS NOT NULL")
    pie = G.folded_small(known, ["office"], "transaction_type", "amount", 5).select(F.lit("pie").alias("figure"), F.col("office").alias("group"), F.col("transaction_type").alias("slice"), F.round("amount", 2).alias("amount"))
    bar = G.shares(known, ["office"], ["transaction_type"], "amount").select(F.lit("bar"), "office", "transaction_type", F.round("share", 4))
    tier = c.groupBy(values.tier(F.col("amount")).alias("t")).agg(F.count(F.lit(1)).cast("double").alias("n")).select(F.lit("tier"), "t", F.lit("rows"), "n")
    bins = c.groupBy(values.log_bin(F.col("amount")).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n")).select(F.lit("histogram"), F.lit("log"), F.col("b").cast("string"), "n")
    return pie.union(bar).union(tier).union(bins)


@add(
    "gr_breakdown_assembly",
    """WITH c AS (SELECT row_id, contributor_id, amount FROM contributions WHERE amount IS NOT NULL), f AS (SELECT filer_id, coalesce(filer_type, 'none') AS label FROM filers),
       s AS (SELECT row_id, label, amount * share AS amount FROM c JOIN (SELECT filer_id, label, 0.75 AS share FROM f UNION ALL SELECT filer_id, 'rest', 0.25 FROM f) p ON p.filer_id = c.contributor_id)
       SELECT row_id, label, round(amount, 2) AS amount FROM s UNION ALL SELECT row_id, 'direct', round(amount, 2) FROM c WHERE row_id NOT IN (SELECT row_id FROM s)""",
)
def gr_breakdown_assembly(spark: SparkSession, d: str) -> DataFrame:
    """Rows of committees split over what their money consists of, and all other rows whole: no row is in both."""
    c = table(spark, d, "contributions").filter("amount IS NOT NULL").select("row_id", "contributor_id", "amount")
    f = table(spark, d, "filers").select(F.col("filer_id").alias("contributor_id"), F.coalesce("filer_type", F.lit("none")).alias("label"))
    parts = f.select("contributor_id", F.explode(F.array(F.struct(F.col("label").alias("label"), F.lit(0.75).alias("share")), F.struct(F.lit("rest").alias("label"), F.lit(0.25).alias("share")))).alias("p"))
    split = c.join(parts, "contributor_id").select("row_id", F.col("p.label").alias("label"), F.round(F.col("amount") * F.col("p.share"), 2).alias("amount"))
    direct = c.join(split.select("row_id"), "row_id", "left_anti").select("row_id", F.lit("direct").alias("label"), F.round("amount", 2).alias("amount"))
    return split.unionByName(direct)


def _queue(kind: str) -> str:
    return f"""WITH k AS (SELECT standardized_name AS k, count(DISTINCT contributor_name) AS n_names, coalesce(bool_and(data_source = 'manual'), false) AS confirmed FROM contributors WHERE entity_kind = '{kind}' AND standardized_name IS NOT NULL GROUP BY 1),
       m AS (SELECT k, max(t) AS most FROM (SELECT standardized_name AS k, recipient_committee_id, sum(amount) AS t FROM contributions GROUP BY 1, 2) GROUP BY 1)
       SELECT k.k AS name, n_names, round(most, 2) AS most FROM k JOIN m USING (k) WHERE n_names > 1 AND NOT confirmed AND round(most, 2) >= 1000"""


def _review_queue(spark: SparkSession, d: str, kind: str, least: float = 1000.0) -> DataFrame:
    """Groups of a kind with more than one name, not all confirmed, that gave one recipient at least `least`."""
    c = table(spark, d, "contributors").filter((F.col("entity_kind") == kind) & F.col("standardized_name").isNotNull())
    names = c.groupBy("standardized_name").agg(F.count_distinct("contributor_name").alias("n_names"), F.coalesce(F.bool_and(F.col("data_source") == "manual"), F.lit(False)).alias("confirmed")).filter("n_names > 1 AND NOT confirmed")
    money = table(spark, d, "contributions").groupBy("standardized_name", "recipient_committee_id").agg(F.sum("amount").alias("t")).groupBy("standardized_name").agg(F.round(F.max("t"), 2).alias("most"))
    return names.join(money.filter(F.col("most") >= least), "standardized_name").select(F.col("standardized_name").alias("name"), "n_names", "most")


@add("er_review_queue_org", _queue("organization"))
def er_review_queue_org(spark: SparkSession, d: str) -> DataFrame:
    return _review_queue(spark, d, "organization")


@add("er_review_queue_indiv", _queue("individual"))
def er_review_queue_indiv(spark: SparkSession, d: str) -> DataFrame:
    return _review_queue(spark, d, "individual")
