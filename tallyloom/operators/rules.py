"""Ordered rules as data: compiled to one expression, or joined where the list is long."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """The value of the first (pattern, value) whose pattern is found in text, in list order."""
    out = F.lit(None).cast("string") if otherwise is None else otherwise
    return reduce(lambda acc, r: F.when(text.rlike(r[0]), F.lit(r[1])).otherwise(acc), reversed(rules), out)


def last_match(text: Column, rules: list[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """The value of the last (pattern, value) whose pattern is found in text."""
    return first_match(text, rules[::-1], otherwise)


def whole_word(keyword: str) -> str:
    """A pattern for the keyword as a whole word, whatever its case."""
    return r"(?i)\b" + re.escape(keyword) + r"\b"


def longest_keyword(text: Column, keywords: list[tuple[str, str]]) -> Column:
    """The value of the longest keyword that is in text as a whole word; of equally long ones the first in the list."""
    ordered = sorted(keywords, key=lambda k: -len(k[0]))
    return first_match(text, [(whole_word(k), v) for k, v in ordered])


def keywords_by_join(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """(key, keyword, value): the longest keyword (keyword, value) in each text, for lists too long for one expression.

    Texts are cut to their word sequences of up to as many words as the longest keyword has, and joined by equality. Ties go to
    the smaller keyword; null texts and keywords give none.
    """
    keywords = keywords.filter("keyword IS NOT NULL").withColumn("keyword", F.array_join(F.filter(F.split(F.lower("keyword"), r"[^\p{L}\p{N}]+"), lambda w: w != ""), " "))
    most_words = keywords.agg(F.max(F.size(F.split("keyword", " ")))).first()[0] or 1
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))

    spans = df.select(F.col(key), words.alias("w")).select(key, F.explode(F.array_distinct(F.flatten(F.array(*[of_length(n) for n in range(1, most_words + 1)])))).alias("keyword"))
    hits = spans.join(keywords, "keyword")
    return hits.groupBy(key).agg(F.min_by(F.struct("keyword", "value"), F.struct(-F.length("keyword"), "keyword", "value")).alias("b")).select(key, "b.keyword", "b.value")


def waterfall(*stages: Column) -> Column:
    """The first stage that is not null; stages are structs with their source, so one pass fills value and source."""
    return F.coalesce(*stages)


def stage(condition: Column, value: Column, source: str) -> Column:
    """struct(value, source) if the condition holds and there is a value, else null."""
    return F.when(condition & value.isNotNull(), F.struct(value.alias("value"), F.lit(source).alias("source")))


def agreed(sources: list[tuple[str, Column]], least: int = 2) -> Column:
    """The value that at least so many sources name, the first of them by order; null without one."""
    values = F.array(*[c for _, c in sources])
    enough = F.filter(values, lambda v: v.isNotNull() & (F.size(F.filter(values, lambda w: w == v)) >= least))
    return F.when(F.size(enough) > 0, F.try_element_at(enough, F.lit(1)))


def reasons(*flags: tuple[Column, str]) -> Column:
    """The names of the flags that hold, joined by ' | '; '' if none does."""
    return F.concat_ws(" | ", *[F.when(c, F.lit(name)) for c, name in flags])


def overridden(value: Column, confidence: Column, prior: Column, below: float) -> Column:
    """The prior where it differs and the value's confidence is missing or below the limit, else the value."""
    return F.when(prior.isNotNull() & (confidence.isNull() | (confidence < below)) & ~prior.eqNullSafe(value), prior).otherwise(value)
