"""Per-key results when a few keys hold most rows: value-frequency compression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import cut


def value_frequencies(df: DataFrame, key: str, value: str, keep: Column | None = None) -> DataFrame:
    """One row (key, value, freq) for each different pair.

    The pair, not the key, is the shuffle key, and equal pairs are counted before they are sent, so a key that holds a
    third of the rows is spread over as many tasks as it has values. Null keys and values form groups of their own.
    Other columns of df, of whatever names, are not read. An empty df gives no rows.
    """
    rows = df if keep is None else df.filter(keep)
    return rows.select(F.col(key).alias("key"), F.col(value).alias("value")).groupBy("key", "value").agg(F.count(F.lit(1)).alias("freq"))


def distinct_per_key(freqs: DataFrame) -> DataFrame:
    """(key, n_distinct, n_rows): distinct non-null values and all rows of each key, added up in partial sums before the shuffle."""
    return freqs.groupBy("key").agg(F.count("value").alias("n_distinct"), F.sum("freq").alias("n_rows"))


def mode_per_key(freqs: DataFrame) -> DataFrame:
    """(key, mode_value, mode_freq): the most frequent non-null value, the smallest one on a tie; null if a key has none."""
    top = freqs.filter("value IS NOT NULL").groupBy("key").agg(F.max("freq").alias("mode_freq"))
    ties = freqs.filter("value IS NOT NULL").join(top.withColumnRenamed("mode_freq", "freq"), ["key", "freq"])
    return ties.groupBy("key").agg(F.min("value").alias("mode_value"), F.max("freq").alias("mode_freq"))


def percentile_per_key(freqs: DataFrame, q: float) -> DataFrame:
    """(key, quantile): the smallest value with at least q of the key's non-null rows at or below it, from weighted values.

    Running weights within a key are made in two levels, so that a key with many different values is not sorted in one
    task: the values are range-partitioned, each range's weight per key is summed, and only ranges that hold the wanted
    rank are looked into.
    """
    f = freqs.filter("value IS NOT NULL")
    n = f.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")
    # stored, as ranges are sampled anew and merged anew whenever they are computed
    ranged = cut(f.repartitionByRange(int(n), "value").withColumn("part", F.spark_partition_id()), "ranges")
    per_part = ranged.groupBy("key", "part").agg(F.sum("freq").alias("w"))
    by_part = Window.partitionBy("key").orderBy("part")
    placed = (
        per_part.withColumn("upto", F.sum("w").over(by_part))
        .withColumn("rank", F.ceil(F.sum("w").over(Window.partitionBy("key")) * F.lit(q)).cast("bigint"))
        .withColumn("rank", F.greatest("rank", F.lit(1)))
        .filter("upto >= rank AND upto - w < rank")
        .select("key", "part", (F.col("rank") - (F.col("upto") - F.col("w"))).alias("rank"))
    )
    inside = ranged.join(placed, ["key", "part"])
    run = Window.partitionBy("key", "part").orderBy("value")
    return (
        inside.withColumn("run", F.sum("freq").over(run))
        .filter("run >= rank AND run - freq < rank")
        .select("key", F.col("value").alias("quantile"))
    )


def lookup_skewed(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int, share: int = 1000) -> DataFrame:
    """rows joined to groups, which has one row for each value of `on` and in `size` the number of rows that carry it.

    Groups with more than total/share rows, of which there are fewer than `share`, are broadcast, so their rows stay where
    they are; all others meet in a shuffle in which no key has more than total/share rows. Rows without a group, and with a
    null in `on`, are left out.
    """
    limit = max(total // share, 1)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    hot_keys = F.broadcast(hot.select(*on))
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(hot_keys, on, "left_anti").join(cold.hint("merge"), on))
