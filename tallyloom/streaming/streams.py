"""Structured Streaming: incremental append without repeats, windows with watermarks, sessions, and writes made once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table as a stream of its files; times without zone are read in the session's zone, as watermarks need."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet").parquet(path if _is_folder(spark, path) else f"{sf_dir}/{name}*.parquet")
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"})


def _is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def run_available(df: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives for the input there is now, as a table in the shared folder."""
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    out = f"{base}/out"
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    else:
        # each batch's whole result replaces the one before
        q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(out)).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def first_seen(df: DataFrame, key: str, time: str, late: str = "30 days") -> DataFrame:
    """Rows whose key was not seen within the watermark; the state is bounded by `late`."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def tumbling(df: DataFrame, time: str, width: str, *keys: str, late: str = "1 day", **values) -> DataFrame:
    """Aggregates of each window of `width` and key."""
    return _flat(df.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(*[v.alias(k) for k, v in values.items()]), keys, values)


def sliding(df: DataFrame, time: str, width: str, step: str, *keys: str, late: str = "1 day", **values) -> DataFrame:
    """Aggregates of each window of `width` that starts every `step`."""
    return _flat(df.withWatermark(time, late).groupBy(F.window(time, width, step), *keys).agg(*[v.alias(k) for k, v in values.items()]), keys, values)


def sessions(df: DataFrame, time: str, gap: str, *keys: str, late: str = "1 day", **values) -> DataFrame:
    """Aggregates of each run of rows of a key with gaps shorter than `gap`."""
    return _flat(df.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(*[v.alias(k) for k, v in values.items()]), keys, values, "session_window")


def _flat(df: DataFrame, keys, values, window: str = "window") -> DataFrame:
    return df.select(F.col(f"{window}.start").cast("timestamp_ntz").alias("start"), F.col(f"{window}.end").cast("timestamp_ntz").alias("end"), *keys, *values)


def append_batches(df: DataFrame, path: str, key: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Appends the stream's rows with keys that the table does not have; a batch that is run again adds nothing twice."""
    from tallyloom.sources.files import append_new

    def write(batch: DataFrame, _: int) -> None:
        append_new(batch if transform is None else transform(batch), path, key)

    df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
