"""Occupations as people write them, and wordings that stand for one, learned from people who write theirs in several ways."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.names import plain

# Words that change no occupation, and texts that name none.
MODIFIERS = frozenset("SR SENIOR LEAD SELF JR JUNIOR I II III IV".split())
PLACEHOLDERS = frozenset("N/A|NA|NONE|NULL|UNKNOWN|XXX|TBD|VARIES|REFUSED|INFORMATION REQUESTED|SEE ATTACHED|SEE EMPLOYER|SAME AS ABOVE|PREFER NOT TO DISCLOSE".split("|"))


def occupation_words(value: str | None) -> tuple[str, ...]:
    """The words of an occupation as typed, without words that change none; () for a placeholder."""
    text = plain(value or "").strip()
    if text in PLACEHOLDERS:
        return ()
    tokens = re.findall(r"[A-Z0-9]+", text)
    kept = [t for t in tokens if t not in MODIFIERS]
    return tuple(kept or tokens)


def learned_wordings(written: DataFrame, closest: DataFrame, sure: float = 0.9, least: int = 3, share: float = 0.6) -> DataFrame:
    """(ref_id, name): values that stand for an entry, as people who write them also write that entry.

    written (person, value) says who wrote which value, closest (value, ref_id, score) which entry a value was found closest to.
    A person's entry is the one that most of their values scoring `sure` or more are; each value of theirs that scores less is a
    vote for it. A value is learned if at least `least` people vote for one entry, and at least a `share` of all who vote.
    Persons and values that are null have no part; a person's values are counted once each, so no group is gathered.
    """
    said = written.filter("person IS NOT NULL AND value IS NOT NULL").distinct()
    known = said.join(closest.filter(F.col("score") >= sure).select("value", "ref_id"), "value").groupBy("person", "ref_id").agg(F.count(F.lit(1)).alias("n"))
    entry = known.groupBy("person").agg(F.max(F.struct("n", (-F.col("ref_id")).alias("m"))).alias("b"), F.sum("n").alias("all")).filter("b.n * 2 > all")
    unsure = said.join(closest.filter(F.col("score") >= sure).select("value"), "value", "left_anti")
    votes = unsure.join(entry.select("person", (-F.col("b.m")).alias("ref_id")), "person").groupBy(F.upper("value").alias("name"), "ref_id").agg(F.count_distinct("person").alias("n"))
    best = votes.groupBy("name").agg(F.max(F.struct("n", (-F.col("ref_id")).alias("m"))).alias("b"), F.sum("n").alias("all"))
    return best.filter((F.col("b.n") >= least) & (F.col("b.n") >= share * F.col("all"))).select((-F.col("b.m")).alias("ref_id"), "name")
