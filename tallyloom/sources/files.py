"""Sources and sinks: text files as they come, JSON pages, HTML tables, caches, and writes that add only what is new."""

from __future__ import annotations

import io
import json
import os
import re
import shutil
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    from tallyloom.session import shared_dir

    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df, or an error that names every missing column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def header_names(names: list[str]) -> list[str]:
    """Headers made alike: trimmed, upper case, dots and runs of white space as one blank."""
    return [re.sub(r"[.\s]+", " ", n).strip().upper() for n in names]


def find_column(names: list[str], *candidates: str) -> str | None:
    """The first column that equals a candidate but for case and separators."""
    bare = lambda s: re.sub(r"[^a-z0-9]", "", s.lower())
    known = {bare(n): n for n in reversed(names)}
    return next((known[bare(c)] for c in candidates if bare(c) in known), None)


def read_csv(spark: SparkSession, path: str, names: list[str] | None = None, encoding: str = "UTF-8", line_breaks: bool = False) -> DataFrame:
    """A CSV with a header, all columns text, blanks kept; a given list of names fixes the schema, so the file is read once.

    Files are split among tasks; with line_breaks, quoted values may hold line ends, and a file is one task's.
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", line_breaks).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "")
    raw = (reader.schema(text_schema(names)) if names else reader.option("inferSchema", False)).csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])  # the reader makes bare blanks null


def read_csv_typed(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A CSV as text with the named columns cast; values that don't fit become null."""
    raw = read_csv(spark, path)
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def read_tsv(spark: SparkSession, path: str, names: list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """A tab-separated file without quoting; lines with another number of fields are dropped."""
    reader = spark.read.option("header", True).option("sep", "\t").option("encoding", encoding).option("mode", "DROPMALFORMED").option("quote", "")
    return reader.schema(text_schema(names)).csv(path)


def read_tsv_utf16(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A UTF-16 tab-separated file with trimmed headers, without rows whose key is null."""
    df = spark.read.option("header", True).option("sep", "\t").option("encoding", "UTF-16").option("multiLine", True).csv(path)
    return df.toDF(*[c.strip() for c in df.columns]).filter(F.col(key).isNotNull())


def filtered_scan(df: DataFrame, ids: DataFrame, on: str, condition: str) -> DataFrame:
    """Rows that meet the condition and whose id is listed; both reach the scan or the join's build side."""
    return df.filter(condition).join(ids.select(on).distinct(), on, "left_semi")


def json_pages(pages: DataFrame, column: str = "page") -> DataFrame:
    """Pages of {"columns": [...], "rows": [[...], ...]} as rows of a map from column name to text."""
    page = F.from_json(column, "columns array<string>, rows array<array<string>>").alias("p")
    return pages.select(page).select("p.columns", F.explode("p.rows").alias("row")).select(F.map_from_arrays("columns", "row").alias("fields"))


def html_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, n, cells): the rows of an HTML page's tables, each an array of cell texts."""
    rows = F.regexp_extract_all(F.col(column), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, r"<[^>]+>|\s+", " ")))
    return df.select(key, F.posexplode(rows).alias("n", "r")).select(key, "n", cells(F.col("r")).alias("cells"))


def nested_codes(df: DataFrame, key: str, column: str, scheme: str) -> DataFrame:
    """(key, codes): the codes of one scheme in {"industry_codes": [{"code":…, "code_scheme_id":…}]}, joined by '|'."""
    found = F.from_json(column, "industry_codes array<struct<code:string,code_scheme_id:string>>").alias("j")
    kept = F.filter("j.industry_codes", lambda c: c["code_scheme_id"] == scheme)
    return df.select(key, found).select(key, F.array_join(F.transform(kept, lambda c: c["code"]), "|").alias("codes"))


def looked_up(keys: DataFrame, cache: DataFrame, key: str, fetch: Callable[[str], dict] | None = None) -> DataFrame:
    """(key, result, status): cached results first; keys not cached go to `fetch`, one at a time in each task, or are 'missing'.

    fetch gives a dict that becomes JSON text; an exception becomes the status 'error'. Keys are looked up once each.
    """
    wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    hit = wanted.join(cache.select(key, F.col("result")), key).withColumn("status", F.lit("cached"))
    miss = wanted.join(cache.select(key), key, "left_anti")
    if fetch is None:
        return hit.unionByName(miss.select(key, F.lit(None).cast("string").alias("result"), F.lit("missing").alias("status")))
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("result", T.StringType()), T.StructField("status", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in batch.column(0).to_pylist():
                try:
                    out.append((k, json.dumps(fetch(k)), "fetched"))
                except Exception:
                    out.append((k, None, "error"))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)] if out else [pa.array([], pa.string())] * 3, names=schema.names)

    return hit.unionByName(miss.mapInArrow(run, schema))


def retrying(fetch: Callable[[str], dict], waits: tuple[float, ...] = (1.0, 2.0, 4.0)) -> Callable[[str], dict]:
    """fetch, tried again after each wait in seconds; the last failure is raised."""

    def run(key: str) -> dict:
        for wait in waits:
            try:
                return fetch(key)
            except Exception:
                time.sleep(wait)
        return fetch(key)

    return run


def dispatched(providers: dict[str, Callable[[str], dict]]) -> Callable[[str], dict]:
    """One function for several providers: keys are 'provider|key'; a provider that is not known is an error."""

    def run(key: str) -> dict:
        name, _, own = key.partition("|")
        if name not in providers:
            raise KeyError(f"no provider {name}")
        return providers[name](own)

    return run


def answered(units: DataFrame, unit: str, ask: Callable[[list[str]], list[str]]) -> DataFrame:
    """units (unit, batch, pos, ...) with `answer`: each batch is one call, and its answers belong to the units by position.

    Batches are small by construction. A call that fails, or gives another number of answers, leaves its units' answers null.
    """
    schema = T.StructType([*units.schema, T.StructField("answer", T.StringType())])

    def call(batch):
        batch = batch.sort_values("pos", ignore_index=True)
        try:
            got = list(ask(batch[unit].tolist()))
        except Exception:
            got = []
        return batch.assign(answer=got if len(got) == len(batch) else None)

    return units.groupBy("batch").applyInPandas(call, schema)


def save_state(spark: SparkSession, path: str, state: DataFrame) -> None:
    """A state table as JSON lines over what was there: written beside it first, so that a failure leaves the old one."""
    fresh = fresh_path(spark, "state")
    state.write.json(fresh)
    spark.read.schema(state.schema).json(fresh).write.mode("overwrite").json(path)


def load_state(spark: SparkSession, path: str, default: DataFrame) -> DataFrame:
    """The state at path, or default if there is none, or none that can be read."""
    from tallyloom.session import cut

    if not exists(spark, path):
        return default
    read = spark.read.schema(T.StructType([*default.schema, T.StructField("_corrupt_record", T.StringType())])).json(path)
    state = cut(read, "state")  # the reader does not give its record of broken lines by itself
    n, bad = state.select(F.count(F.lit(1)), F.count("_corrupt_record")).first()
    return default if bad or not n else state.drop("_corrupt_record")


def backed_up(df: DataFrame, path: str) -> None:
    """Writes df over path; what was there the first time is kept once, at path.bak, and never written over."""
    spark = df.sparkSession
    if exists(spark, path) and not exists(spark, f"{path}.bak"):
        spark.read.parquet(path).write.mode("error").parquet(f"{path}.bak")
    df.write.mode("overwrite").parquet(path)


def resumed(df: DataFrame, path: str, key: str, work: Callable[[DataFrame], DataFrame]) -> int:
    """Appends work(rows) for the rows of df whose key is not at path yet; gives how many rows were left to do."""
    left = df
    if exists(df.sparkSession, path):
        left = df.join(df.sparkSession.read.parquet(path).select(key), key, "left_anti")
    n = left.count()
    if n:
        work(left).write.mode("append").parquet(path)
    return n


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any file system the session knows."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def staged(spark: SparkSession, fetch: Callable[[], bytes], name: str, most_mb: int = 64) -> str:
    """The path of what `fetch` gives, stored in the shared folder: downloads are made once, on the driver, before any plan."""
    data = fetch()
    if len(data) > most_mb << 20:
        raise ValueError(f"{name} has more than {most_mb} MB")
    path = f"{fresh_path(spark, 'staged')}/{name}"
    fs, where = _file_system(spark, path)
    out = fs.create(where)
    try:
        out.write(data)
    finally:
        out.close()
    return path


def fetched(spark: SparkSession, path: str, most_mb: int = 64) -> bytes:
    """The bytes of a small stored file, on the driver."""
    found = spark.read.format("binaryFile").load(path)
    row = found.select("length").first()
    if row["length"] > most_mb << 20:
        raise ValueError(f"{path} has more than {most_mb} MB")
    return bytes(found.select("content").first()["content"])


def read_sheet(spark: SparkSession, rows: Callable[[], list[list]]) -> DataFrame:
    """A sheet that an interface gives as rows, the first one its header: all cells as text, short rows filled with ''."""
    header, *body = rows()
    return spark.createDataFrame([["" if i >= len(r) or r[i] is None else str(r[i]) for i in range(len(header))] for r in body], text_schema([str(h) for h in header]))


def read_sheets(spark: SparkSession, data: bytes, sheets: tuple[int, ...] = (1,), skip: int = 0) -> DataFrame:
    """Worksheets of a workbook under one another, columns by name, absent ones ''."""
    frames = [read_xlsx(spark, data, s, skip) for s in sheets]
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f, allowMissingColumns=True)
    return both.na.fill("")


def zip_members(data: bytes, suffixes: tuple[str, ...]) -> dict[str, bytes]:
    """The first member of an archive for each suffix, whatever the case; a suffix without one is an error."""
    out = {}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for suffix in suffixes:
            name = next((n for n in z.namelist() if n.lower().endswith(suffix.lower())), None)
            if name is None:
                raise FileNotFoundError(f"no member ends with {suffix}")
            out[suffix] = z.read(name)
    return out


def consolidated(frames: list[DataFrame], key: str, order: str) -> DataFrame:
    """Earlier outputs as one: columns by name, absent ones null, the last row of each key by order."""
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f, allowMissingColumns=True)
    kept = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*kept), F.col(order)).alias("__s")).select(key, *[F.col(f"__s.{c}").alias(c) for c in kept])


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns in their agreed order, over what was there."""
    require_columns(df, columns).select(*columns).write.mode("overwrite").option("header", True).csv(path)


def append_new(df: DataFrame, path: str, key: str) -> int:
    """Appends the rows whose key the table at path does not have, one row a key; gives their number. Rows there are never changed."""
    spark = df.sparkSession
    fresh = df.filter(F.col(key).isNotNull()).dropDuplicates([key])
    try:
        there = spark.read.parquet(path).select(key)
        fresh = fresh.join(there, key, "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    from tallyloom.session import cut

    stored = cut(fresh, "fresh")
    n = stored.count()
    if n:
        stored.write.mode("append").parquet(path)
    return n


def versioned(path: str, version: str) -> str:
    """The folder of one version of an output; older ones stay."""
    if not re.fullmatch(r"[\w.-]+", version):
        raise ValueError("a version is made of letters, digits, '.', '_' and '-'")
    return f"{path.rstrip('/')}/version={version}"


def extract_members(archive: str, suffixes: tuple[str, ...], target: str) -> list[str]:
    """Extracts the members of a zip whose names end with a suffix, whatever the case; on the driver, for staging. Gives their paths.

    Members are written under their bare names, so no member can leave the target folder. A suffix without a member is an error.
    """
    os.makedirs(target, exist_ok=True)
    out = []
    with zipfile.ZipFile(archive) as z:
        for suffix in suffixes:
            name = next((n for n in z.namelist() if n.lower().endswith(suffix.lower())), None)
            if name is None:
                raise FileNotFoundError(f"no member ends with {suffix}")
            path = os.path.join(target, os.path.basename(name))
            with z.open(name) as source, open(path, "wb") as sink:
                shutil.copyfileobj(source, sink)
            out.append(path)
    return out


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def read_xlsx(spark: SparkSession, path: str | bytes, sheet: int = 1, skip: int = 0, most_mb: int = 64) -> DataFrame:
    """A worksheet as text columns, its header after `skip` rows; read on the driver, so larger files than most_mb are refused."""
    if (len(path) if isinstance(path, bytes) else os.path.getsize(path)) > most_mb << 20:
        raise ValueError(f"a workbook of more than {most_mb} MB; convert it to Parquet first")
    with zipfile.ZipFile(io.BytesIO(path) if isinstance(path, bytes) else path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        cells: list[dict[str, str]] = []
        for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{_SHEET}row"):
            found = {}
            for c in row.iter(f"{_SHEET}c"):
                value = c.findtext(f"{_SHEET}v")
                text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if c.get("t") == "inlineStr" else shared[int(value)] if c.get("t") == "s" and value else value
                found[re.sub(r"\d", "", c.get("r", ""))] = text or ""
            cells.append(found)
    columns = sorted({k for r in cells[skip:] for k in r}, key=lambda k: (len(k), k))
    header, body = cells[skip], cells[skip + 1 :]
    names = [header.get(k) or k for k in columns]
    return spark.createDataFrame([[r.get(k, "") for k in columns] for r in body], text_schema(names))
