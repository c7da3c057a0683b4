"""Typed values mapped to the closest entry of a reference list: tokens are repaired first, then whole entries are ranked.

1. Each different token of the values is joined to the list's tokens that it may stand for: by shared deletions (edit
   distance), by the letters an abbreviation must have, and by how long tokens begin (words run together). The joins are on
   different tokens, not on rows.
2. A repaired token leads to the entries of which it is one of the rarest tokens: so much of an entry's weight must be met that an
   entry that can be accepted is led to. An initial leads with another word; names of initials and words run together lead to
   theirs by their letters.
3. Value and entry are compared by soft TF-IDF over their aligned tokens; the best entry above the limit is the value's.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.names import INITIALS, align, edits, likeness, slip
from tallyloom.llm.neighbours import neighbours
from tallyloom.llm.spelling import mended
from tallyloom.session import cut

Parse = Callable[[str | None], tuple[str, ...]]
Accept = Callable[[tuple[str, ...], tuple[str, ...], float, float, float], bool]

#: Soft TF-IDF that an entry must reach.
LEAST = 0.45
#: Less than so much of an entry's weight may be missed, so one of so many of its rarest tokens is met.
MISSED = 0.26


def _tokens(df: DataFrame, parse: Parse) -> DataFrame:
    """df (key, name) with the tokens of its names; rows without tokens are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(parse(x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["key", "tokens"])

    return df.select("key", "name").mapInArrow(run, f"key {df.schema['key'].dataType.simpleString()}, tokens array<string>").filter("size(tokens) > 0")


def soft_tfidf(value: tuple[str, ...], entry: tuple[str, ...], value_weights: tuple[float, ...], entry_weights: tuple[float, ...]) -> tuple[float, float, float]:
    """(soft TF-IDF of the aligned tokens, share of the entry's weight that is met, share of the value's weight that is met)."""
    scores, iv, ie = align(value, entry, False)
    wv, we = list(value_weights), list(entry_weights)
    # a repaired token weighs what the entry's token weighs, so that a misspelling is not the rarest word of all
    for i, j in zip(iv, ie):
        wv[i] = we[j]
    norm = math.sqrt(sum(w * w for w in wv)) * math.sqrt(sum(w * w for w in we))
    dot = sum(s * wv[i] * we[j] for s, i, j in zip(scores, iv, ie))
    met = sum(we[j] * s for s, j in zip(scores, ie)) / (sum(we) or 1.0)
    used = sum(wv[i] * s for s, i in zip(scores, iv)) / (sum(wv) or 1.0)
    return (dot / norm if norm else 0.0), met, used


def abbreviation_keys(short: Column) -> Column:
    """The letters that a word must have for a token to be short for it: its first, second and last; without an S at its end, too."""
    start, size = F.substring(short, 1, 2), F.length(short)
    whole = F.when(size == 2, start).otherwise(F.concat(start, F.expr("right(token, 1)")))
    bare = F.concat(start, F.when(size == 4, F.lit("")).otherwise(F.expr("substring(token, length(token) - 1, 1)")))
    cut_s = F.when(size == 4, F.concat(start, F.substring(short, 3, 1))).otherwise(bare)
    return F.when(F.expr("right(token, 1) = 'S'") & (size > 3), F.array(whole, cut_s)).otherwise(F.array(whole))


def word_keys(word: Column) -> Column:
    """The keys of all tokens that a word may be abbreviated to: its first letter, and one or two of its later letters in order."""
    first = F.substring(word, 1, 1)
    later = F.sequence(F.lit(2), F.length(word))
    two = F.transform(later, lambda i: F.concat(first, F.substring(word, i, F.lit(1))))
    three = F.flatten(F.transform(later, lambda i: F.transform(F.sequence(i, F.length(word)), lambda j: F.concat(first, F.substring(word, i, F.lit(1)), F.substring(word, j, F.lit(1))))))
    return F.array_distinct(F.concat(two, three))


def token_repairs(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, word, sim): the vocabulary words (word) that each token (token) may stand for; a token of the vocabulary for itself, too.

    Both inputs hold different tokens only. A token may stand for several words, either short for the other; one with no word near
    it has no row. Initials are left out: any word of their letter is near.
    """
    known = tokens.join(vocabulary.withColumnRenamed("word", "token"), "token", "left_semi").select("token", F.col("token").alias("word"), F.lit(1.0).alias("sim"))
    whole = cut(tokens.filter("length(token) > 1"), "whole")
    listed = vocabulary.select(F.lit(0).alias("list"), F.col("word").alias("token"))
    near = neighbours(whole.select(F.lit(0).alias("list"), "token"), ["list"], listed).select("token", F.col("other").alias("word"))
    near = cut(near, "near")
    in_order = F.expr("word RLIKE concat('^', regexp_replace(token, '(.)', '$1.*')) OR startswith(word, left(token, length(token) - 1))")

    def shortened(short: DataFrame, long: DataFrame) -> DataFrame:
        """Pairs of short (token) and long (word) of which one may be short for the other."""
        keyed = short.filter("length(token) > 1").select("token", F.explode(abbreviation_keys(F.col("token"))).alias("k"))
        full = long.filter("length(word) > 2").select("word", F.explode(word_keys(F.col("word"))).alias("k"))
        return keyed.hint("merge").join(full, "k").filter("length(word) > length(token)").filter(in_order).select("token", "word")

    turned = shortened(vocabulary.select(F.col("word").alias("token")), whole.select(F.col("token").alias("word")))
    turned = cut(turned.select(F.col("word").alias("token"), F.col("token").alias("word")), "brief")
    brief = cut(shortened(whole, vocabulary), "brief").unionByName(turned)
    ends = whole.join(known, "token", "left_anti").filter("length(token) >= 12").select("token", F.explode(F.sequence(F.lit(6), F.length("token") - 4)).alias("n"))
    run = ends.select("token", F.substring("token", F.lit(1), F.col("n")).alias("word")).hint("merge").join(vocabulary, "word").select("token", "word")
    pairs = near.unionByName(brief).distinct()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in range(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([likeness(x, y, False) for x, y in zip(a, b)], pa.float64())], names=["token", "word", "sim"])

    scored = pairs.mapInArrow(score, "token string, word string, sim double").filter("sim > 0")
    return known.unionByName(scored).unionByName(run.withColumn("sim", F.lit(0.5)))


def closest_entries(values: DataFrame, entries: DataFrame, parse: Parse, accept: Accept, parted: bool = False, least: float = LEAST) -> DataFrame:
    """(value, ref_id, score): the closest entry of (ref_id, name) for each different value of (value) that has one.

    An entry may stand under several names. parse gives a text's tokens, and with `parted` those that are run together are parted;
    accept decides from the tokens of value and entry, the soft TF-IDF and the two shares met, if the soft TF-IDF is `least` or
    more. Null values and values without tokens have no entry; of equally close entries the one with the smallest ref_id is
    taken. Work follows the number of different values and tokens.
    """
    listed = _tokens(entries.filter("name IS NOT NULL").select(F.struct("ref_id", "name").alias("key"), "name"), parse)
    typed = _tokens(values.filter("value IS NOT NULL").select(F.struct(F.lit(None).cast("bigint").alias("ref_id"), F.col("value").alias("name")).alias("key"), F.col("value").alias("name")).distinct(), parse)
    both = cut(listed.unionByName(typed).select(F.struct("key", F.monotonically_increasing_id().alias("i")).alias("key"), "tokens"), "tokens")
    if parted:
        both = cut(mended(both), "mended")
    names = both.filter("key.key.ref_id IS NOT NULL").select(F.col("key.key.ref_id").alias("ref_id"), F.col("key.i").alias("entry"), "tokens")
    parsed = both.filter("key.key.ref_id IS NULL").select(F.col("key.key.name").alias("value"), "tokens")
    held = names.select("entry", F.explode(F.array_distinct("tokens")).alias("word"))
    words = cut(held.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "vocabulary")
    rank_of = F.row_number().over(Window.partitionBy("entry").orderBy("n", "word"))
    size = names.select("entry", F.size("tokens").alias("size"))
    leads = held.join(words, "word").withColumn("r", rank_of).join(size, "entry").filter(F.col("r") <= 1 + F.floor(F.col("size") * MISSED)).select("word", "entry")
    leads = cut(leads, "leads")
    used = cut(parsed.select("value", F.explode(F.array_distinct("tokens")).alias("token")), "used")
    repairs = cut(token_repairs(used.select("token").distinct(), words.select("word")), "repairs")
    first = lambda t: F.array_join(F.array_sort(F.transform(t, lambda w: F.substring(w, 1, 1))), "")
    initials = names.filter("size(tokens) > 1").select("entry", F.array_join(F.transform("tokens", lambda t: F.substring(t, 1, 1)), "").alias("run"))
    letters = names.filter("size(tokens) > 1").select("entry", first(F.col("tokens")).alias("run"))
    runs = names.select("entry", F.array_join("tokens", "").alias("run"))
    squashed = cut(parsed.select("value", F.array_join("tokens", "").alias("run"), F.when(F.array_max(F.transform("tokens", F.length)) == 1, first(F.col("tokens"))).alias("letters")), "squashed")
    met = cut(used.hint("merge").join(repairs, "token").select("value", "word").distinct(), "met")
    pairs = met.join(leads, "word").select("value", "entry")
    pairs = pairs.unionByName(squashed.hint("merge").join(initials, "run").select("value", "entry"))
    pairs = pairs.unionByName(squashed.select("value", F.col("letters").alias("run")).filter("run IS NOT NULL").hint("merge").join(letters, "run").select("value", "entry"))
    pairs = pairs.unionByName(squashed.hint("merge").join(runs, "run").select("value", "entry"))
    # an initial of the value or of the entry stands for a word, if another word is met
    letter = lambda side, c: F.concat(F.lit(side), F.substring(c, 1, 1))
    sides = lambda c, one, long: F.when(F.length(c) == 1, letter(one, c)).when(F.length(c) > 4, letter(long, c))
    asked = used.select("value", sides("token", "v", "e").alias("s")).filter("s IS NOT NULL").join(met, "value").distinct()
    stands = leads.select("entry", F.col("word").alias("lead"), sides("word", "e", "v").alias("s")).filter("s IS NOT NULL").join(held, "entry").filter("word <> lead")
    pairs = cut(pairs, "led").unionByName(cut(asked.hint("merge").join(stands, ["s", "word"]).select("value", "entry"), "led"))
    # runs of letters within two slips: those that can be accepted begin alike
    head = F.substring("run", 1, 6).alias("head")
    mine, its = squashed.select(head, F.col("run").alias("token")).filter("length(token) > 8").distinct(), runs.select(head, F.col("run").alias("token")).filter("length(token) > 10").distinct()
    slips = cut(neighbours(mine, ["head"], its).select(F.col("token").alias("run"), "other"), "slips")
    pairs = pairs.unionByName(squashed.hint("merge").join(slips, "run").select("value", F.col("other").alias("run")).hint("merge").join(runs, "run").select("value", "entry"))
    pairs = cut(pairs.distinct(), "pairs")
    total = names.count()
    rare = math.log(1 + total)

    def weighed(df: DataFrame, key: str) -> DataFrame:
        """df (key, tokens) with the weight of each token: the rarer it is in the list, the more."""
        flat = df.select(key, F.posexplode("tokens").alias("i", "word")).hint("merge").join(words, "word", "left")
        weight = F.coalesce(F.log(1 + F.lit(float(total)) / F.col("n")), F.lit(rare))
        return flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "word", weight.alias("w")))).alias("t")).select(key, F.col("t.word").alias("tokens"), F.col("t.w").alias("weights"))

    of_value = cut(weighed(parsed, "value"), "weighed")
    of_entry = cut(weighed(names, "entry"), "weighed").join(names.select("entry", "ref_id"), "entry").select("entry", "ref_id", F.col("tokens").alias("entry_tokens"), F.col("weights").alias("entry_weights"))
    full = pairs.hint("merge").join(of_value, "value").join(of_entry, "entry")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for v, w, e, u in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                v, e = tuple(v), tuple(e)
                s = soft_tfidf(v, e, w, u)
                if len(v) != len(e) and ((far := edits("".join(v), "".join(e), 2)) == 0 or sum(map(len, e)) > 10 and far <= 2):  # words run together
                    s = (max(s[0], 1 - far / sum(map(len, e))), *s[1:])
                if len(e) > 1 and "".join(v) == "".join(t[0] for t in e):  # the entry's initials
                    s = (max(s[0], INITIALS), *s[1:])
                scores.append(s[0] if s[0] >= least and accept(v, e, *s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["value", "ref_id", "score"])

    ranked = full.select("value", "ref_id", "tokens", "weights", "entry_tokens", "entry_weights").mapInArrow(rank, "value string, ref_id bigint, score double").filter("score IS NOT NULL")
    best = ranked.groupBy("value").agg(F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("ref_id")).alias("minus"))).alias("m"))
    return cut(best.select("value", (-F.col("m.minus")).alias("ref_id"), F.col("m.score").alias("score")), "closest")


def accept_business(value: tuple[str, ...], entry: tuple[str, ...], score: float, met: float, used: float) -> bool:
    """Every word of either is met, and the word that names the business by itself or one slip; or both are one run of letters."""
    if len(value) != len(entry):
        a, b = "".join(value), "".join(entry)
        return len(b) > 10 and a[:6] == b[:6] and edits(a, b, 2) <= 2
    scores, iv, ie = align(value, entry, False)
    for i, j in zip(iv, ie):
        if j == 0 and not slip(value[i], entry[j]):
            return False
    return len(scores) == len(entry)


def accept_occupation(value: tuple[str, ...], entry: tuple[str, ...], score: float, met: float, used: float) -> bool:
    """All of the entry is met, a word by itself in nearly all its letters; the value may have up to three words more."""
    if value == entry or sorted(value) == sorted(entry):
        return True
    if "".join(value) == "".join(entry):
        return True  # run together
    if len(value) < len(entry):
        return "".join(value) == "".join(t[0] for t in entry)  # initials
    if max(map(len, entry)) <= 3:
        return False  # initials must stand alone
    if len(entry) == 1:
        scores, iv, _ = align(value, entry, False)
        short = value[iv[0]] if iv else ""
        if len(short) < 4 and not (len(short) == 3 and entry[0].startswith(short)):
            return False  # too few letters to be short for one word
    extra = len(value) - len(entry)
    least = 0.89 if len(entry) == 1 else 0.74
    return extra == 0 and met >= least or extra <= 3 and met >= 0.999 and used >= 0.2
