"""Variant spellings of the names of people and businesses, linked: symmetric deletes on tokens, then optimal token alignment.

1. Records of one place with the same tokens are one form; everything below works on forms, so copies cost nothing.
2. The different words of a place are indexed once by their deletions and abbreviations, and checked as words.
3. Each form looks for others by words that must have a partner if the two are to be one: a business by its rarest, a person by
   family names. Names of businesses whose words are run together meet as runs of letters.
4. A word that meets very many forms at a place is joined together with a second word of the form, which must have a partner
   too, by keys that all pairs of words with any likeness share.
5. Forms that meet are compared once, by the best assignment of their tokens.
6. Linked forms make classes by the smallest label spread along links; a record belongs to the class of its form.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.names import HEAD, INITIALS, LEGAL, ROOTS, business_tokens, family_name, person_tokens, plain, same_business, same_person
from tallyloom.llm.neighbours import neighbours, sounding
from tallyloom.operators.graph import components
from tallyloom.session import cut

#: A word that meets more forms than this at one place is joined together with a second word; links are the same either way.
HOT = 2000
#: A word is split where its end is a word that so many times as many names hold.
TAIL = 20

_PARSED = "id bigint, place string, business boolean, mark string, tokens array<string>, first int, people array<string>, formal int"


def parsed_names(records: DataFrame) -> DataFrame:
    """records (id, place, name, business) with their tokens.

    first is the number of a person's tokens before the comma, or -1. Where business is null, tokens are those of a business,
    people those of a person, and formal counts the signs of either that the writing itself shows.
    """
    formal_word = frozenset(LEGAL - {"A", "AN", "AND", "OF", "THE"})

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, tokens, firsts, people, formals = [], [], [], [], []
            for name, business in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                mark, first, other, formal = "", -1, None, 0
                if business:
                    t = business_tokens(name)
                elif business is None:
                    t, (other, mark, first) = business_tokens(name), person_tokens(name)
                    formal = 3 * any(w in formal_word for w in re.split(r"[^A-Z]+", plain(name))) - 2 * ("," in name) + 1
                else:
                    t, mark, first = person_tokens(name)
                marks.append(mark), tokens.append(list(t)), firsts.append(first), people.append(other), formals.append(formal)
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(marks, pa.string()), pa.array(tokens, strings), pa.array(firsts, pa.int32()), pa.array(people, strings), pa.array(formals, pa.int32())],
                names=["id", "place", "business", "mark", "tokens", "first", "people", "formal"],
            )

    return records.select("id", "place", "name", "business").filter("name IS NOT NULL").mapInArrow(parse, _PARSED)


def with_kind(parsed: DataFrame) -> DataFrame:
    """Parsed names without a kind get one: by how often their words stand in names of businesses and of people."""
    told = parsed.filter("business IS NOT NULL").select("business", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = told.groupBy("token").agg(F.count_if("business").alias("firms"), F.count_if(~F.col("business")).alias("persons"))
    open_ = parsed.filter("business IS NULL")
    used = open_.select("id", F.explode(F.array_union("tokens", "people")).alias("token")).hint("merge").join(counts, "token")
    odds = F.greatest(F.lit(-3.0), F.least(F.lit(3.0), F.log((F.col("firms") + 0.5) / (F.col("persons") + 0.5))))
    evidence = used.groupBy("id").agg(F.sum(odds).alias("odds"))
    firm = F.col("formal") + F.coalesce("odds", F.lit(0.0)) > 0
    guessed = open_.join(evidence, "id", "left").select(
        "id", "place", firm.alias("business"), F.when(firm, "").otherwise(F.col("mark")).alias("mark"), F.when(firm, F.col("tokens")).otherwise(F.col("people")).alias("tokens"), F.when(firm, -1).otherwise(F.col("first")).alias("first")
    )
    return parsed.filter("business IS NOT NULL").select(*guessed.columns).unionByName(guessed)


def parted_words(counts: DataFrame, rounds: int = 3) -> DataFrame:
    """(token, parts): words of businesses (token, n) that are run together, as their head and the frequent words at their end.

    A word ends in another if at least TAIL times as many names hold the other; the longest such end is taken, up to `rounds`
    times, and a head of four letters at least is left.
    """
    tails = cut(counts.filter(F.length("token").between(3, 15) & (F.col("n") >= TAIL)).select(F.col("token").alias("tail"), F.col("n").alias("m")), "tails")
    at = cut(counts.filter("length(token) >= 9").select("token", "n", F.col("token").alias("head"), F.array().cast("array<string>").alias("ends")), "long")
    out = None
    for _ in range(rounds):
        ends = at.filter("length(head) >= 8").select("token", "n", "head", "ends", F.explode(F.sequence(F.lit(3), F.least(F.lit(15), F.length("head") - 4))).alias("k"))
        met = ends.withColumn("tail", F.expr("right(head, k)")).join(tails.hint("merge"), "tail").filter(F.col("m") >= TAIL * F.col("n")).filter((F.col("k") > 3) | (F.size("ends") > 0))
        best = met.groupBy("token").agg(F.max(F.struct("k", "n", "head", "ends", "tail")).alias("b"))
        at = cut(best.select("token", "b.n", F.expr("left(b.head, length(b.head) - b.k)").alias("head"), F.concat(F.array("b.tail"), "b.ends").alias("ends")), "parted")
        found = at.select("token", F.concat(F.array("head"), "ends").alias("parts"))
        out = found if out is None else out.unionByName(found)
    return out.groupBy("token").agg(F.max_by("parts", F.size("parts")).alias("parts"))


def mended(names: DataFrame, all_names: bool = True) -> DataFrame:
    """names (key, tokens) of businesses with words that are run together parted; only those that have some, if not all_names."""
    parts = parted_words(names.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    split = names.select("key", F.posexplode("tokens").alias("i", "token")).hint("merge").join(parts, "token")
    whole = split.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("i", "parts"))).alias("at"))
    fresh = F.flatten(F.transform("tokens", lambda t, i: F.coalesce(F.try_element_at("at", i), F.array(t))))
    return names.join(whole, "key", "left" if all_names else "inner").select("key", fresh.alias("tokens"))


def formed(named: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records with the form they have, forms, words) of parsed names with a kind.

    forms: (form, block, business, tokens), where a block is a place and a generation mark. words: (business, token, n, before):
    how many forms hold a word, and in what share of the names with a comma that hold it, it stands before the comma.
    """
    def grouped(df: DataFrame) -> DataFrame:
        return df.groupBy("block", "business", "key").agg(F.min("id").alias("form"), F.min("tokens").alias("tokens"))

    rows = named.select("id", F.concat_ws("|", "place", F.nullif("mark", F.lit(""))).alias("block"), "business", "tokens", "first").filter("size(tokens) > 0")
    rough = cut(rows.withColumn("key", F.array_sort("tokens")), "rough")
    firm = grouped(rough.filter("business"))
    fresh = mended(firm.select(F.struct("block", "business", "key").alias("key"), "tokens"), False).select("key.*", F.col("tokens").alias("fresh"))
    rows = rough.join(fresh, ["block", "business", "key"], "left").withColumn("tokens", F.coalesce("fresh", "tokens")).withColumn("key", F.array_sort("tokens")).drop("fresh")
    rows = cut(rows, "named")
    forms = cut(grouped(rows), "forms")
    comma = rows.filter("first > 0").select(F.posexplode("tokens").alias("i", "token"), "first").groupBy("token").agg(F.avg((F.col("i") < F.col("first")).cast("double")).alias("before"))
    words = forms.select("business", F.explode(F.array_distinct("tokens")).alias("token")).filter("length(token) > 1").groupBy("business", "token").agg(F.count(F.lit(1)).alias("n"))
    words = cut(words.join(comma, "token", "left").select("business", "token", "n", F.when(~F.col("business"), F.col("before")).alias("before")), "words")
    return rows, forms, words


def near_words(asking: DataFrame, words: DataFrame, block: list[str]) -> DataFrame:
    """(block columns, token, other): asking words (block columns, token) with all others of words that may stand for them.

    These are all pairs of different words that `likeness` gives 0.8 or more: within two slips, of one sound, one short for the
    other (of businesses), or short forms of one given name (of people).
    """
    asking, words = (df.filter("length(token) > 1") for df in (asking, words))
    found = neighbours(asking, block, words)
    # a short form has its word's first letter, and its second one is a later letter of the word
    short = lambda df: df.filter("business").withColumn("k", F.substring("token", 1, 2))
    later = lambda t: F.array_distinct(F.transform(F.sequence(F.lit(2), F.length(t)), lambda i: F.concat(F.substring(t, 1, 1), F.substring(t, i, F.lit(1)))))
    long = lambda df: df.filter("business AND length(token) > 2").withColumn("k", F.explode(later(F.col("token"))))
    in_order = F.expr("short <> word AND length(short) < length(word) AND (word RLIKE concat('^', regexp_replace(short, '(.)', '$1.*')) OR startswith(word, left(short, length(short) - 1)))")
    for mine, its, a, b in ((short(asking), long(words), "short", "word"), (long(asking), short(words), "word", "short")):
        met = mine.withColumnRenamed("token", a).hint("merge").join(its.withColumnRenamed("token", b), [*block, "k"]).filter(in_order)
        found = found.unionByName(met.select(*block, F.col(a).alias("token"), F.col(b).alias("other")))
    named = lambda df: df.filter(~F.col("business") & F.col("token").isin(sorted(ROOTS))).withColumn("k", F.explode(F.split(F.element_at(_roots(), F.col("token")), ",")))
    met = named(asking).hint("merge").join(named(words).withColumnRenamed("token", "other"), [*block, "k"]).filter("token <> other")
    return found.unionByName(met.select(*block, "token", "other")).distinct()


def candidates(forms: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b): pairs of different forms of one block, a < b: all that `same_business` or `same_person` may take for one, and more.

    * Businesses of equally many words: the rarest word of each has a partner, so it looks for it; a word hardly the same is
      allowed beside two equal ones, of which one is then among the two rarest of a name.
    * Businesses of unequally many words are one run of letters within two slips.
    * People: a family name of one of them has a partner, so all family names look for theirs; names without one look by a word.

    HOT decides how a word is asked, not what is linked: second words of names that compare as one share a key.
    """
    block = ["block", "business", "fit"]
    fit = F.when(F.col("business"), F.size("tokens")).otherwise(0)
    at = forms.select("form", "block", "business", fit.alias("fit"), F.size("tokens").alias("size"), F.posexplode("tokens").alias("i", "token")).hint("merge").join(words, ["business", "token"], "left")
    of_form = Window.partitionBy("form")
    family = ~F.col("business") & F.coalesce(F.col("before") >= 0.5, (F.length("token") > 1) & ~F.col("token").isin(sorted(ROOTS)))
    n = F.coalesce("n", F.lit(1))
    entered = at.select("form", *block, "size", "i", "token", n.alias("n"), family.alias("family"))
    entered = entered.withColumns({"r": F.row_number().over(of_form.orderBy(F.length("token") == 1, "n", "i")), "told": F.max("family").over(of_form), "most": F.max("n").over(of_form)})
    entered = cut(entered, "entered")
    asks = F.when(F.col("business"), (F.col("r") == 1) & (F.length("token") > 1)).otherwise(F.col("family") | ~F.col("told") & (F.col("r") == 1))
    probes = entered.filter(asks).select("form", *block, "i", "token")
    held = cut(entered.groupBy(*block, "token").agg(F.count(F.lit(1)).alias("held")), "held")
    near = cut(near_words(probes.select(*block, "token").distinct(), held.select(*block, "token"), block), "near")
    counted = near.hint("merge").join(held.select(*block, F.col("token").alias("other"), "held"), [*block, "other"]).groupBy(*block, "token").agg(F.sum("held").alias("more"))
    cost = held.join(counted, [*block, "token"], "left").select(*block, "token", (F.col("held") + F.coalesce("more", F.lit(0))).alias("cost"))
    probes = cut(probes.hint("merge").join(cost, [*block, "token"]), "probes")

    def reached(asking: DataFrame) -> DataFrame:
        """Each asking row (block, token, ...) with the words (other) of its block that its word is equal or near to."""
        return asking.withColumn("other", F.col("token")).unionByName(asking.hint("merge").join(near, [*block, "token"]))

    few = reached(probes.filter(F.col("cost") <= HOT)).select(F.col("form").alias("x"), *block, "other")
    pairs = few.hint("merge").join(entered.select(F.col("form").alias("y"), *block, F.col("token").alias("other")), [*block, "other"]).select("x", "y")
    hot = probes.filter(F.col("cost") > HOT).drop("cost")
    seconds = entered.select("form", "size", F.col("i").alias("j"), F.col("token").alias("second"))
    if hot.limit(1).count():
        # a word that meets very many forms asks together with a second word of its form
        another = (F.col("i") != F.col("j")) | (F.col("size") == 1)
        asked = hot.hint("merge").join(seconds, "form").filter(another).select("form", *block, "token", F.explode(second_keys()).alias("key")).distinct()
        x = reached(asked).select(F.col("form").alias("x"), *block, "other", "key")
        wanted = reached(hot.select(*block, "token").distinct()).select(*block, "other").distinct()
        y = entered.select("form", *block, "i", F.col("token").alias("other")).hint("merge").join(wanted, [*block, "other"]).hint("merge").join(seconds, "form").filter(another)
        y = y.select(F.col("form").alias("y"), *block, "other", F.explode(second_keys()).alias("key")).distinct()
        pairs = pairs.unionByName(x.hint("merge").join(y, [*block, "other", "key"]).select("x", "y"))
    two = entered.filter("business AND size > 2").hint("merge").join(seconds.drop("size"), "form").filter("i <> j")
    side = lambda df, s: df.select(F.col("form").alias(s), *block, "token", "second", "n", F.col("most").alias(f"{s}_most"))
    odd = side(two.filter("r <= 2"), "x").hint("merge").join(side(two, "y").drop("n"), [*block, "token", "second"]).filter(F.col("n") * HEAD <= F.greatest("x_most", "y_most"))
    pairs = pairs.unionByName(odd.select("x", "y")).unionByName(runs_together(forms))
    return pairs.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def runs_together(forms: DataFrame) -> DataFrame:
    """(x, y): businesses of one block and unequally many words that are one run of letters within two slips, as written or sorted."""
    block = ["block", "sorted"]
    run = lambda k, t: F.struct(F.lit(k).alias("sorted"), F.array_join(t, "").alias("token"))
    runs = forms.filter("business").select("form", "block", F.size("tokens").alias("size"), F.explode(F.array(run(0, F.col("tokens")), run(1, F.array_sort("tokens")))).alias("s"))
    runs = cut(runs.select("form", "block", "size", "s.*").filter("length(token) >= 7"), "runs")
    different = runs.select(*block, "token").distinct()
    near = neighbours(different, block).unionByName(different.withColumn("other", F.col("token")))
    x = runs.select(F.col("form").alias("x"), *block, "token", F.col("size").alias("x_size")).hint("merge").join(near, [*block, "token"])
    y = runs.select(F.col("form").alias("y"), *block, F.col("token").alias("other"), "size")
    return x.hint("merge").join(y, [*block, "other"]).filter("size <> x_size").select("x", "y")


def _roots() -> Column:
    """The given names that a name is short for, with commas, by name."""
    return F.create_map(*[F.lit(x) for name, stand in sorted(ROOTS.items()) for x in (name, ",".join(sorted(stand)))])


def second_keys() -> Column:
    """Keys of a second word (second) of a name of so many words (size); two words with any likeness to one another share one.

    The first letter, as written, as it sounds and of the names the word is short for, serves initials, short forms and sounds;
    one slip leaves the first letter or the last; two slips in seven letters or more leave one of these or three letters
    in the middle, moved by one place at most. A name of one word has a key of its own.
    """
    second = F.col("second")
    stand = F.coalesce(F.split(F.element_at(_roots(), second), ","), F.array().cast("array<string>"))
    first = lambda c: F.concat(F.lit("f:"), F.substring(c, 1, 1))
    middle = F.when(F.length(second) >= 7, F.array(*[F.concat(F.lit("m:"), F.substring(second, i, 3)) for i in (2, 3, 4)])).otherwise(F.array().cast("array<string>"))
    word = F.array_distinct(F.concat(F.array(first(second), first(sounding(second)), F.concat(F.lit("e:"), F.expr("right(second, 1)"))), F.transform(stand, first), middle))
    return F.when(F.col("size") == 1, F.array(F.lit("s:"))).when(F.length("second") == 1, F.array(first(second), first(sounding(second)))).otherwise(word)


def form_links(forms: DataFrame, words: DataFrame, least: float = 0.75) -> DataFrame:
    """(a, b): pairs of forms of one entity, a < b.

    Two people's names that agree in a family name and initials alone are linked only if all forms that the shorter one fits
    are one class without it.
    """
    pairs = candidates(forms, words)
    held = forms.select("form", "business", F.posexplode("tokens").alias("i", "token")).hint("merge").join(words, ["business", "token"], "left")
    info = held.groupBy("form").agg(F.array_sort(F.collect_list(F.struct("i", "token", F.coalesce("n", F.lit(1)).alias("n"), "before"))).alias("w"), F.first("business").alias("business"))
    info = cut(info.select("form", "business", "w.token", "w.n", "w.before"), "info")
    side = lambda s: info.select(F.col("form").alias(s), *([F.col("business")] if s == "a" else []), *[F.col(c).alias(f"{s}_{c}") for c in ("token", "n", "before")])
    full = pairs.hint("merge").join(side("a"), "a").hint("merge").join(side("b"), "b")
    squashed = lambda s: F.length(F.array_join(f"{s}_token", ""))
    full = full.filter(~F.col("business") | (F.size("a_token") == F.size("b_token")) | (F.abs(squashed("a") - squashed("b")) <= 2))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for business, x, y, n, m, p, q in zip(*(batch.column(i).to_pylist() for i in range(2, 9))):
                x, y = tuple(x), tuple(y)
                if business:
                    scores.append(same_business(x, y, tuple(n), tuple(m)))
                else:
                    scores.append(same_person(x, y, tuple(map(family_name, x, p)), tuple(map(family_name, y, q))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["a", "b", "score"])

    scored = full.select("a", "b", "business", "a_token", "b_token", "a_n", "b_n", "a_before", "b_before").mapInArrow(compare, "a bigint, b bigint, score double")
    scored = cut(scored.filter((F.col("score") >= least) | (F.col("score") == INITIALS)), "scored")
    strong = scored.filter(F.col("score") >= least).select("a", "b")
    weak = scored.filter(F.col("score") < least)
    if not weak.limit(1).count():
        return strong
    long_of = info.select("form", F.length(F.array_join("token", "")).alias("l"))
    ends = weak.join(long_of.withColumnRenamed("form", "a").withColumnRenamed("l", "la"), "a").join(long_of.withColumnRenamed("form", "b").withColumnRenamed("l", "lb"), "b")
    short = F.when(F.col("la") <= F.col("lb"), F.struct(F.col("a").alias("x"), F.col("b").alias("form"))).otherwise(F.struct(F.col("b").alias("x"), F.col("a").alias("form")))
    ends = ends.select(short.alias("s")).select("s.x", "s.form")
    known = components(strong).select(F.col("node").alias("form"), "component")
    fits = ends.join(known, "form", "left").withColumn("component", F.coalesce("component", "form"))
    one = fits.groupBy("x").agg(F.count_distinct("component").alias("n"), F.min("form").alias("form")).filter("n = 1")
    return strong.unionByName(one.select(F.least("x", "form").alias("a"), F.greatest("x", "form").alias("b")))


def entity_classes(records: DataFrame, least: float = 0.75) -> DataFrame:
    """(id, class) of the records (id, place, name, business) that can be placed and named: records of one entity share a class.

    id is unique; class is a number that means nothing by itself. Records with a null place, or a name without letters and
    digits, are compared with none and left out. business null is guessed from the name. Equal names at one place are one class
    (people's with the same generation mark). Work follows the number of different forms, not of records.
    """
    parsed = cut(parsed_names(records), "parsed")
    named, forms, words = formed(with_kind(parsed).filter("place IS NOT NULL"))
    links = cut(form_links(forms, words, least), "links")
    classes = components(links).select(F.col("node").alias("form"), F.col("component").alias("class"))
    by_form = forms.join(classes, "form", "left").select("block", "business", "key", F.coalesce("class", "form").alias("class"))
    return named.join(by_form, ["block", "business", "key"]).select("id", "class")


def entity_pairs(classes: DataFrame) -> DataFrame:
    """(id_a, id_b): all pairs of records of one class, smaller id first; as many rows as the result has, and no others."""
    sizes = classes.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class")
    members = classes.join(sizes, "class")
    return members.withColumnRenamed("id", "id_a").join(members.withColumnRenamed("id", "id_b"), "class").filter("id_a < id_b").select("id_a", "id_b")
