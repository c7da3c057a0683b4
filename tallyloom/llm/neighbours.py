"""Words that small slips turn into one another: a symmetric-delete index over the different words of each block.

The index holds each different word of a block once, however many rows it stands in, and two words that meet in it are checked
before any row is touched. All joins are told to shuffle: exploded rows are never broadcast, whatever size the optimiser
expects of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.names import SOUNDS

#: Words from this length on are indexed with two deletions, shorter ones with one, and those below four letters as they are and as they sound.
LONG_TOKEN = 7
#: Two deletions are made in so many first letters: words within two slips agree there after exactly two deletions.
PREFIX = 8


def deletions(token: Column, two: bool = False) -> Column:
    """The token and what is left of it after one deletion, or up to two: its symmetric-delete neighbourhood."""

    def drop_one(t: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))

    one = drop_one(token)
    both = F.concat(F.array(token), one, F.flatten(F.transform(one, drop_one))) if two else F.concat(F.array(token), one)
    return F.array_distinct(both)


def sounding(token: Column) -> Column:
    """The word with letters that are typed for one another made equal."""
    for a, b in SOUNDS:
        token = F.replace(token, F.lit(a), F.lit(b))
    return token


def two_deletions(token: Column) -> Column:
    """What is left of the first PREFIX letters, blanks after a shorter word, when exactly two of them are left out."""
    padded = F.rpad(token, PREFIX, "$")
    part = lambda a, b: [F.substring(padded, a + 1, b - a)] if b > a else []
    return F.array(*[F.concat(*part(0, i), *part(i + 1, j), *part(j + 1, PREFIX)) for i in range(PREFIX) for j in range(i + 1, PREFIX)])


def neighbourhood(token: Column) -> Column:
    """The keys under which a word is indexed.

    Words of LONG_TOKEN letters and more have two deletions of their beginning, and a word just as long one deletion for those a
    letter shorter; shorter words have themselves and one deletion; all also how they sound.
    """
    heard = F.array(F.concat(F.lit("~"), sounding(token)))
    long = F.when(F.length(token) == LONG_TOKEN, F.concat(two_deletions(token), deletions(token))).otherwise(two_deletions(token))
    return F.when(F.length(token) >= LONG_TOKEN, F.concat(long, heard)).when(F.length(token) >= 4, F.concat(deletions(token), heard)).otherwise(F.concat(F.array(token), heard))


def neighbours(words: DataFrame, block: list[str], others: DataFrame | None = None) -> DataFrame:
    """(block columns, token, other): pairs of different words of a block (block columns, token) that are near to one another.

    Near are words within two edits or swaps, and words that sound alike. With `others`, the first word is of words and the
    second of others; else both are of words, and each pair comes both ways. Inputs hold each word of a block once. Null words
    and blocks are near to none.

    The index is sorted by one number, the hash of block and key, and its rows hold one more, that of block and word; both are
    looked up again and checked as texts, so equal hashes of different words do no harm.
    """

    def indexed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = df.select(*block, "token", F.xxhash64(*block, "token").alias("w"))
        keys = rows.select("w", *block, F.explode(neighbourhood(F.col("token"))).alias("__k"))
        return rows, keys.select("w", F.xxhash64(*block, "__k").alias("v"))

    rows, index = indexed(words)
    other_rows, other_index = (rows, index) if others is None else indexed(others)
    met = index.alias("x").hint("merge").join(other_index.alias("y"), F.col("x.v") == F.col("y.v"))
    met = met.filter(F.col("x.w") < F.col("y.w") if others is None else F.col("x.w") != F.col("y.w"))
    met = met.select(F.col("x.w").alias("w"), F.col("y.w").alias("u")).distinct()
    far = other_rows.select(F.col("w").alias("u"), *[F.col(c).alias(f"other_{c}") for c in block], F.col("token").alias("other"))
    both = met.hint("merge").join(rows, "w").hint("merge").join(far, "u")
    for c in block:
        both = both.filter(F.col(c) == F.col(f"other_{c}"))
    close = F.levenshtein("token", "other", 4) >= 0  # a swap counts two edits here; names are compared in full later
    near = both.filter((F.col("token") != F.col("other")) & (close | (sounding(F.col("token")) == sounding(F.col("other"))))).select(*block, "token", "other")
    if others is not None:
        return near
    both_ways = F.array(F.struct("token", "other"), F.struct(F.col("other").alias("token"), F.col("token").alias("other")))
    return near.select(*block, F.explode(both_ways).alias("p")).select(*block, "p.token", "p.other")
