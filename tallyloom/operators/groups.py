"""Aggregates and group-preserving operations with defined order and ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_by(df: DataFrame, keys: list[str], value: str, order: str | None = None, name: str = "mode") -> DataFrame:
    """The most frequent non-null value of each group: the smallest on a tie, or the one seen first by `order`.

    Pairs are counted before groups, so a large group is spread over its values.
    """
    seen = F.min(order) if order else F.lit(0)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), seen.alias("__o"))
    best = F.max_by(F.struct(value), F.struct(F.col("__n"), (-F.col("__o").cast("double")).alias("o")))
    if order:
        return counts.groupBy(*keys).agg(best.getField(value).alias(name))
    top = counts.groupBy(*keys).agg(F.max("__n").alias("__n"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys] + [F.col("c.__n") == F.col("t.__n")]
    return counts.alias("c").join(top.alias("t"), same).groupBy(*[F.col(f"c.{k}").alias(k) for k in keys]).agg(F.min(F.col(f"c.{value}")).alias(name))


def first_rows(df: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first n rows of each group by `order`, whole rows; the order must be total for a defined result."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__r") <= n).drop("__r")


def best_row(df: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """One whole row a group, that with the largest `by`: a partial aggregate before the shuffle instead of a sort of the group."""
    kept = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*kept), by).alias("__s"))
    return picked.select(*keys, *[F.col(f"__s.{c}").alias(c) for c in kept])


def tied_for_max(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """All rows that share their group's largest `by`."""
    top = df.groupBy(*keys).agg(F.max(by).alias(by))
    return df.join(top, [*keys, by], "left_semi")


def last_non_null(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Of each column its last non-null value by `order`, column by column."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def duplicate_rank(df: DataFrame, keys: list[str], *order: Column, name: str = "dup_rank") -> DataFrame:
    """The ordinal of each row among rows with equal keys, from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def with_group(df: DataFrame, keys: list[str], **values: Column) -> DataFrame:
    """Group values on every row, by a join of the aggregate: a group of any size stays spread over tasks."""
    groups = df.groupBy(*keys).agg(*[v.alias(k) for k, v in values.items()])
    return df.join(groups, keys, "left")


def shares(df: DataFrame, group: list[str], part: list[str], amount: str) -> DataFrame:
    """(group, part, amount, total, share): each part's share of its group's total in per cent."""
    sums = df.groupBy(*group, *part).agg(F.coalesce(F.sum(amount), F.lit(0.0)).alias("amount"))
    w = Window.partitionBy(*group)
    return sums.withColumn("total", F.sum("amount").over(w)).withColumn("share", F.when(F.col("total") != 0, 100 * F.col("amount") / F.col("total")))


def folded_small(df: DataFrame, group: list[str], label: str, amount: str, least: float, other: str = "Other") -> DataFrame:
    """Parts below `least` per cent of their group, in one part named `other`."""
    s = shares(df, group, [label], amount)
    return s.withColumn(label, F.when(F.coalesce(F.col("share"), F.lit(0.0)) < least, other).otherwise(F.col(label))).groupBy(*group, label).agg(F.sum("amount").alias("amount"))


def sample_per_group(df: DataFrame, keys: list[str], n: int, ident: str, seed: int = 42) -> DataFrame:
    """n rows of each group, the same ones at every run: those with the smallest hash of their id and the seed."""
    return first_rows(df, keys, F.md5(F.concat(F.col(ident).cast("string"), F.lit(f"|{seed}"))), F.col(ident), n=n)


def sample_rows(df: DataFrame, n: int, ident: str, seed: int = 42) -> DataFrame:
    """n rows, the same ones at every run."""
    return df.orderBy(F.md5(F.concat(F.col(ident).cast("string"), F.lit(f"|{seed}"))), ident).limit(n)


def conflicts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n_values): groups with more than one different non-null value."""
    pairs = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values")).filter("n_values > 1")


def joined_values(c: str, sep: str = " | ") -> Column:
    """The different non-blank values of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(F.when(F.trim(F.col(c)) != "", F.col(c)))), sep)


def numbered(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows numbered from 1 by key without one task that holds them all: ranges are sorted apart and offset by the counts before them.

    Rows of equal keys are numbered in no defined order.
    """
    from tallyloom.session import cut

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored, as ranges are sampled anew and merged anew whenever they are computed
    ranged = cut(df.repartitionByRange(parts, key).withColumn("__p", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(F.lit(1)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__p", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s"))  # one row a partition
    return ranged.join(F.broadcast(starts), "__p").withColumn(name, F.row_number().over(Window.partitionBy("__p").orderBy(key)) + F.col("__s")).drop("__p", "__s")
