"""Queries p4 and p6: several values in one field, and per-key results under skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.packed import split_packed
from tallyloom.operators.skew import distinct_per_key, mode_per_key, percentile_per_key, value_frequencies
from tallyloom.plans.registry import Registry
from tallyloom.session import table

registry = Registry()


@registry.add("p4_found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    items = split_packed(table(spark, d, "web_search_cache"), "search_id", "urls")
    return items.select("search_id", "pos", F.col("value").alias("url"))


@registry.add("p4_forms")
def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    items = split_packed(table(spark, d, "web_search_cache"), "search_id", "urls")
    return items.groupBy("form", F.coalesce("error", F.lit("none")).alias("error")).agg(F.count(F.lit(1)).alias("n"))




def _blank_free(c: str):
    return F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\s ]+", "") != ""


@registry.add(
    "p6_found",
    """SELECT contributor_employer AS employer, count(DISTINCT contributor_name) AS n_donors FROM contributions
       WHERE regexp_replace(coalesce(contributor_employer, ''), '[\\s\\x{a0}]+', '', 'g') <> '' GROUP BY 1""",
)
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    freqs = value_frequencies(table(spark, d, "contributions"), "contributor_employer", "contributor_name", _blank_free("contributor_employer"))
    return distinct_per_key(freqs).select(F.col("key").alias("employer"), F.col("n_distinct").alias("n_donors"))


@registry.add(
    "p6_mode",
    """SELECT employer, min(occupation) AS top_occupation, max(n) AS n_rows FROM (
         SELECT contributor_employer AS employer, contributor_occupation AS occupation, count(*) AS n,
                max(count(*)) OVER (PARTITION BY contributor_employer) AS most
         FROM contributions WHERE contributor_occupation IS NOT NULL
           AND regexp_replace(coalesce(contributor_employer, ''), '[\\s\\x{a0}]+', '', 'g') <> '' GROUP BY 1, 2)
       WHERE n = most GROUP BY 1""",
)
def p6_mode(spark: SparkSession, d: str) -> DataFrame:
    freqs = value_frequencies(table(spark, d, "contributions"), "contributor_employer", "contributor_occupation", _blank_free("contributor_employer"))
    return mode_per_key(freqs).select(F.col("key").alias("employer"), F.col("mode_value").alias("top_occupation"), F.col("mode_freq").alias("n_rows"))


@registry.add(
    "p6_median",
    """SELECT contributor_employer AS employer, quantile_disc(amount, 0.5) AS median_amount FROM contributions
       WHERE amount IS NOT NULL AND regexp_replace(coalesce(contributor_employer, ''), '[\\s\\x{a0}]+', '', 'g') <> '' GROUP BY 1""",
)
def p6_median(spark: SparkSession, d: str) -> DataFrame:
    freqs = value_frequencies(table(spark, d, "contributions"), "contributor_employer", "amount", _blank_free("contributor_employer"))
    return percentile_per_key(freqs, 0.5).select(F.col("key").alias("employer"), F.col("quantile").alias("median_amount"))
