"""Queries of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import sql
from tallyloom.llm.canonical import accept_business, accept_occupation, closest_entries
from tallyloom.llm.folding import collapsed, folded_copies
from tallyloom.llm.linkage import match_sources
from tallyloom.llm.names import TITLES, business_tokens
from tallyloom.llm.occupations import learned_wordings, occupation_words
from tallyloom.llm.packing import pack
from tallyloom.llm.places import clean_city, place_names, with_place, zip5
from tallyloom.llm.spelling import entity_classes, entity_pairs
from tallyloom.llm.splitting import split_texts
from tallyloom.llm.tokens import count_tokens, encode_corpus
from tallyloom.plans.registry import Registry
from tallyloom.session import cut, table

registry = Registry()

_EXACT = ["start_date", "amount", "transaction_type", "recipient_committee_id", "contributor_state", "contributor_zip_code"]
_TEXT = ["contributor_employer", "contributor_occupation", "contributor_city"]


def _copies(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "contributions").filter("amount IS NOT NULL")
    return rows, folded_copies(rows, "row_id", _EXACT, _TEXT, ["contributor_name"])


@registry.add("p2_found", sql.P2_FOUND)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _copies(spark, d)[1].select(F.col("first").alias("first_row_id"), F.col("key").alias("copy_row_id"))


@registry.add("p2_collapsed", sql.P2_COLLAPSED)
def p2_collapsed(spark: SparkSession, d: str) -> DataFrame:
    rows, copies = _copies(spark, d)
    return collapsed(rows, "row_id", copies).withColumnRenamed("first", "first_row_id")


@registry.add("p7_ids")
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text")


@registry.add("p8_containers")
def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(count_tokens(table(spark, d, "documents"), "doc_id", "text"), "sizes")
    return pack(sizes, "doc_id", "n_tokens", 2048)


@registry.add("p9_pieces")
def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(table(spark, d, "documents"), "doc_id", "text", limit=512, overlap=32)


#: The tables of p5 by the number that tells them apart in an id: id * 2 + number.
_KINDS = ("contributor", "employer")


def _named(spark: SparkSession, d: str) -> DataFrame:
    """Records of both tables as (id, name, city, zip, business), each id with the number of its table."""
    people, firms = table(spark, d, "contributors"), table(spark, d, "employers")
    first = people.select(
        (F.col("name_id") * 2).alias("id"),
        F.col("contributor_name").alias("name"),
        clean_city(F.col("contributor_city")).alias("city"),
        zip5(F.col("contributor_zip_code")).alias("zip"),
        (F.col("entity_kind") == "organization").alias("business"),
    )
    second = firms.select(
        (F.col("employer_id") * 2 + 1).alias("id"),
        F.col("employer").alias("name"),
        clean_city(F.col("employer_city")).alias("city"),
        zip5(F.col("employer_zip")).alias("zip"),
        F.lit(True).alias("business"),
    )
    return first.unionByName(second)


def _classes(spark: SparkSession, d: str) -> DataFrame:
    """(id, class): records of one table and entity share a class; the two tables go through the operator together, as places apart."""
    records = cut(_named(spark, d), "records")
    placed = with_place(records, cut(place_names(records), "places"))
    return entity_classes(placed.withColumn("place", F.concat_ws("/", F.when(F.col("place").isNotNull(), F.col("id") % 2), "place")).withColumn("place", F.nullif("place", F.lit(""))))


def _kind(column: str) -> Column:
    return F.when(F.col(column) % 2 == 0, _KINDS[0]).otherwise(_KINDS[1]).alias("kind")


@registry.add("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return entity_pairs(_classes(spark, d)).select(_kind("id_a"), F.shiftright("id_a", 1).alias("id_a"), F.shiftright("id_b", 1).alias("id_b"))


@registry.add("p5_classes")
def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d).select(_kind("id"), F.shiftright("id", 1).alias("id"), F.col("class").alias("class_id"))


def _occupations(spark: SparkSession, d: str) -> DataFrame:
    """(kind, record_id, value, person): the occupations that are written, and by whom: the parts of the name and the zip."""
    written = F.regexp_replace(F.coalesce("contributor_occupation", F.lit("")), r"[\s\x{a0}]+", "") != ""
    words = F.split(F.upper(F.trim("contributor_name")), r"[^\p{L}]+")
    name = F.array_join(F.array_sort(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*TITLES))), " ")
    zip_ = zip5(F.col("contributor_zip_code"))
    rows = table(spark, d, "contributors").filter(written)
    return rows.select(F.lit("occupation").alias("kind"), F.col("name_id").alias("record_id"), F.col("contributor_occupation").alias("value"), F.when(zip_.isNotNull(), F.concat_ws("|", name, zip_)).alias("person"))


def closest_occupations(rows: DataFrame, entries: DataFrame, learn: bool = True) -> DataFrame:
    """(value, ref_id, score): the closest of entries (ref_id, name) to each value of rows (value, person).

    If wordings are learned, values without a sure entry are looked up once more in the list with the learned ones added.
    """
    first = closest_entries(rows, entries, occupation_words, accept_occupation)
    if not learn:
        return first
    more = cut(learned_wordings(rows.select("person", "value"), first), "wordings")
    unsure = rows.select("value").distinct().join(first.filter("score >= 0.9").select("value"), "value", "left_anti")
    again = closest_entries(unsure, entries.unionByName(more), occupation_words, accept_occupation)
    return first.filter("score >= 0.9").unionByName(again)


def _mapped(spark: SparkSession, d: str, learn: bool = True) -> DataFrame:
    """(kind, record_id, value, ref_id, score) of every value that may have an entry; ref_id is null without one."""
    entries = table(spark, d, "occupation_list").select(F.col("occ_id").alias("ref_id"), F.col("occupation").alias("name"))
    occupations = _occupations(spark, d)
    firms = table(spark, d, "running_list").select("ref_id", F.col("name_norm").alias("name"))
    employers = table(spark, d, "employers").select(F.lit("employer").alias("kind"), F.col("employer_id").alias("record_id"), F.col("employer_norm").alias("value"))
    found = [
        (occupations.drop("person"), closest_occupations(occupations, entries, learn)),
        (employers, closest_entries(employers, firms, business_tokens, accept_business, parted=True)),
    ]
    parts = [rows.join(best, "value", "left") for rows, best in found]
    return parts[0].unionByName(parts[1])


@registry.add("p3_found")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).select("kind", "record_id", F.coalesce("ref_id", F.lit(-1).cast("bigint")).alias("ref_id"))


@registry.add("p3_unmatched")
def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).filter("ref_id IS NULL").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def _linked(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "employers").select(
        F.col("employer_id").alias("id"),
        F.col("employer").alias("name"),
        clean_city(F.col("employer_city")).alias("city"),
        zip5(F.col("employer_zip")).alias("zip"),
        F.col("naics_code").alias("code"),
    )
    right = table(spark, d, "edd_listings").select(
        F.col("edd_id").alias("id"),
        F.col("edd_match_name").alias("name"),
        clean_city(F.col("city")).alias("city"),
        zip5(F.col("zip_code")).alias("zip"),
        F.col("edd_naics_code").alias("code"),
    )
    places = cut(place_names(left.select("city", "zip").unionByName(right.select("city", "zip"))), "places")
    return match_sources(with_place(left, places), with_place(right, places))


@registry.add("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d).filter("confidence >= 0.5").select(F.col("left_id").alias("employer_id"), F.col("right_id").alias("edd_id"))


@registry.add("p1_confidence")
def p1_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d).select(F.col("left_id").alias("employer_id"), F.col("right_id").alias("edd_id"), "confidence")
