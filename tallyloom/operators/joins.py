"""Joins and set operations with defined null and duplicate behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.groups import duplicate_rank, first_rows


def lookup(df: DataFrame, table: DataFrame, key: str, columns: list[str], *priority: Column) -> DataFrame:
    """df with columns of the table's first row of the key by priority; null keys and keys without a row give nulls.

    No broadcast is asked for: the optimiser broadcasts the table if its size is below the session's threshold.
    """
    one = first_rows(table.filter(F.col(key).isNotNull()), [key], *priority) if priority else table.filter(F.col(key).isNotNull())
    return df.join(one.select(key, *columns), key, "left")


def prefix_longest(df: DataFrame, rules: DataFrame, code: str, prefix: str, value: str) -> DataFrame:
    """df with the value of the longest rule prefix that its code starts with; null without one.

    Codes are expanded to their prefixes and joined by equality, different codes only, so no pair is tried that can't match.
    """
    codes = df.select(code).filter(F.length(code) > 0).distinct()
    prefixes = codes.select(code, F.explode(F.transform(F.sequence(F.lit(1), F.length(code)), lambda n: F.substring(F.col(code), F.lit(1), n))).alias("__p"))
    hits = prefixes.join(rules.select(F.col(prefix).alias("__p"), F.col(value)), "__p")
    best = hits.groupBy(code).agg(F.max_by(F.col(value), F.struct(F.length("__p"), F.col(value))).alias(value))
    return df.join(best, code, "left")


def kth_to_kth(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[Column], right_order: list[Column], how: str = "left") -> DataFrame:
    """The k-th left row of a key joined to the k-th right row of it."""
    return duplicate_rank(left, keys, *left_order).join(duplicate_rank(right, keys, *right_order), [*keys, "dup_rank"], how)


def pairs_within(df: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(keys, id_a, id_b): pairs of different rows with equal non-null keys, smaller id first; meant for keys that few rows share."""
    a = df.select(*keys, F.col(ident).alias("id_a"))
    return a.join(df.select(*keys, F.col(ident).alias("id_b")), keys).filter("id_a < id_b")


def class_of(df: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(ident, class, n_links): each row's class of equal non-null keys, named by its smallest id, and its number of partners in it.

    What pairs of such rows would say, in as many rows as there are ids: a key that holds a third of all rows is one partial
    aggregate a task and one looked-up row.
    """
    kept = df
    for k in keys:
        kept = kept.filter(F.col(k).isNotNull())
    groups = kept.groupBy(*keys).agg(F.min(ident).alias("class"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return kept.join(groups, keys).select(ident, "class", "n_links")


def not_in(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of df whose keys other does not have; rows with null keys stay."""
    return df.join(other.select(*on).distinct(), on, "left_anti")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Different rows of both, columns by name, absent ones null."""
    return a.unionByName(b, allowMissingColumns=True).distinct()


def distinct_ignoring_case(df: DataFrame, columns: list[str], *order: Column) -> DataFrame:
    """The first row of each group of rows that are equal but for letter case in the columns."""
    keyed = df.select("*", *[F.lower(c).alias(f"__{c}") for c in columns])
    return first_rows(keyed, [f"__{c}" for c in columns], *order).drop(*[f"__{c}" for c in columns])


def banded_pairs(left: DataFrame, right: DataFrame, on: list[str], left_value: str, right_value: str, width: float) -> DataFrame:
    """Rows of equal keys whose values differ by at most width: each value falls into a band and meets its own and the next ones."""
    l = left.withColumn("__band", F.floor(F.col(left_value) / width))
    r = right.withColumn("__band", F.explode(F.array(*[F.floor(F.col(right_value) / width) + i for i in (-1, 0, 1)])))
    return l.join(r, [*on, "__band"]).filter(F.abs(F.col(left_value) - F.col(right_value)) <= width).drop("__band")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str, span: str = "month", width: float = 1_000_000) -> DataFrame:
    """left with the value of the latest right row of its key at or before its time; null without one, or with a null key or time.

    Of right rows of one key and time the largest value counts. A key's rows are divided into spans of time, so that a hot key is
    spread over as many tasks as it has spans; what a span starts with is carried over from the last span before it that has a
    right row. There is no join by range. Times are divided by `span`, numbers by `width`.
    """
    dated = left.schema[time].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    of = lambda c: F.date_trunc(span, c) if dated else F.floor(F.col(c) / width)
    part = of(time).alias("__span")
    known = [F.col(k).isNotNull() for k in keys]
    r = right.filter(F.col(time).isNotNull() & F.col(value).isNotNull())
    for k in known:
        r = r.filter(k)
    r = r.groupBy(*keys, F.col(time).alias("__t")).agg(F.max(value).alias("__v")).withColumn("__span", of("__t"))
    last = r.groupBy(*keys, "__span").agg(F.max_by("__v", "__t").alias("__last"))
    spans = last.select(*keys, "__span").unionByName(left.filter(F.col(time).isNotNull()).select(*keys, part)).distinct().join(last, [*keys, "__span"], "left")
    before = Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(*keys, "__span", F.last("__last", True).over(before).alias("__carried"))
    l = left.select("*", part, F.col(time).alias("__t"), F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.lit(0).alias("__right"))
    both = l.unionByName(r.withColumn("__right", F.lit(1)), allowMissingColumns=True)
    within = Window.partitionBy(*keys, "__span").orderBy("__t", F.desc("__right")).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__seen", F.last("__v", True).over(within)).filter("__right = 0").join(carried, [*keys, "__span"], "left")
    return seen.select(*left.columns, F.coalesce("__seen", "__carried").alias(value))
