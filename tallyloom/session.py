"""Session settings, table access and durable cuts of lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[int] = set()
#: Bytes of an Arrow batch sent to Python, so that ten thousand long texts are not held at once; a lower session setting stays.
BATCH_BYTES = 32 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once in a Spark context, so that they need no copy of the repository.

    Also bounds the bytes of a batch sent to Python in this session.
    """
    context = spark.sparkContext
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) in (None, str(2**31 - 1), f"{2**31 - 1}b"):
        spark.conf.set(bound, str(BATCH_BYTES))
    if id(context) in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyloom-"), "tallyloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    context.addPyFile(archive)
    _SHIPPED.add(id(context))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one in a local run without that setting."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    where = "file://" + folder
    spark.conf.set("spark.checkpoint.dir", where)
    return where


_CUTS: dict[int, list[str]] = {}


def swept(spark: SparkSession) -> int:
    """Deletes the tables that `cut` has stored in this context, and gives their number.

    For the caller to use once the results that read them are written or dropped; nothing is deleted while a query may need it.
    """
    paths = _CUTS.pop(id(spark.sparkContext), [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """df written once to the shared folder and read again: lineage ends there and a lost executor costs no recomputation.

    The rows are stored as Parquet, so later steps still prune columns and push filters down.
    """
    path = os.path.join(shared_dir(df.sparkSession), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _CUTS.setdefault(id(df.sparkSession.sparkContext), []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
