"""Text features, nearest neighbours and classifiers on built-in transformers and joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def words(c):
    """The words of a text in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_grams(c):
    """The words of a text and its pairs of words that follow each other."""
    w = words(c)
    pairs = F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1))))
    return F.concat(w, F.coalesce(pairs, F.array().cast("array<string>")))


def char_grams(c, least: int = 2, most: int = 5):
    """The grams of `least` to `most` characters of a text's words, each word between two blanks."""
    of = lambda w: F.flatten(F.transform(F.sequence(F.lit(least), F.least(F.lit(most), F.length(w))), lambda n: F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, n))))
    return F.flatten(F.transform(words(c), lambda w: of(F.concat(F.lit(" "), w, F.lit(" ")))))


def tfidf(df: DataFrame, key: str, text: str, least: int = 2, most: float = 0.9, terms=words, limit: int | None = None) -> DataFrame:
    """(key, term, weight): sublinear TF-IDF, unit length, of terms (words, if not given) that at least `least` rows and at most a share `most` of rows hold.

    idf is ln((1 + n) / (1 + df)) + 1. Terms are rows, so the vocabulary is not bounded by memory; with a limit, only so many of
    the most frequent terms are kept, the smaller ones on a tie.
    """
    held = df.select(F.col(key).alias("key"), F.explode(terms(F.col(text))).alias("term"))
    tf = held.groupBy("key", "term").agg(F.count(F.lit(1)).alias("n"))
    n = df.count()
    counts = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("all")).filter((F.col("df") >= least) & (F.col("df") <= most * n))
    if limit is not None:
        counts = counts.orderBy(F.desc("all"), "term").limit(limit)
    weighed = tf.join(counts, "term").select("key", "term", ((1 + F.log(F.col("n").cast("double"))) * (F.log((F.lit(1.0) + n) / (1 + F.col("df"))) + 1)).alias("w"))
    length = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    return weighed.join(length, "key").select("key", "term", (F.col("w") / F.col("l")).alias("weight"))


def hashed(df: DataFrame, key: str, text: str, dims: int = 256) -> DataFrame:
    """(key, dim, value): word counts hashed into `dims` numbers and brought to unit length; a text without words gives no rows."""
    dim = F.conv(F.substring(F.md5("term"), 1, 4), 16, 10).cast("int") % dims
    counts = df.select(F.col(key).alias("key"), F.explode(words(F.col(text))).alias("term")).groupBy("key", dim.alias("dim")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    length = counts.groupBy("key").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("l"))
    return counts.join(length, "key").select("key", "dim", (F.col("n") / F.col("l")).alias("value"))


def word_votes(train: DataFrame, text: str, label: str) -> DataFrame:
    """(term, label, share): of the training rows that hold a word, the share of each label; a model as rows, of any vocabulary."""
    held = train.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
    counts = held.groupBy("term", "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(counts.groupBy("term").agg(F.sum("n").alias("all")), "term").select("term", "label", (F.col("n") / F.col("all")).alias("share"))


def ranked_labels(model: DataFrame, rows: DataFrame, key: str, text: str, k: int = 3) -> DataFrame:
    """(key, top): the k labels with the most votes of each row's different words, in order; ties by label. Rows without a known word have no row."""
    held = rows.select(F.col(key).alias("key"), F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
    votes = held.join(model, "term").groupBy("key", "label").agg(F.round(F.sum("share"), 9).alias("s"))
    best = votes.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), "label"))), 1, k).alias("b"))  # as many entries as there are labels
    return best.select("key", F.col("b.label").alias("top"))


def in_top(truth, top, k: int, normalise=lambda c: F.upper(F.trim(c))):
    """Whether a label is among the first k of a list, both normalised; false without a list."""
    return F.coalesce(F.array_contains(F.transform(F.slice(top, 1, k), normalise), normalise(truth)), F.lit(False))


def split_by_hash(df: DataFrame, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """df with `held_out`: a share of every label's rows, by the hash of key and seed, so the same at every run and without a sort."""
    return df.withColumn("held_out", F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), 1, 4), 16, 10).cast("int") < int(share * 65536))


def trainable(df: DataFrame, label: str, least: int = 5, rows: int = 100) -> DataFrame:
    """Rows with labels that at least `least` rows have; none at all if fewer than `rows` are left, as that is too little to train on."""
    kept = df.filter(F.col(label).isNotNull())
    supported = kept.groupBy(label).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= least).select(label)
    out = kept.join(supported, label)
    return out if out.limit(rows).count() == rows else out.limit(0)


def nearest_by_terms(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(query, item, sim): the k most similar items by the dot product of TF-IDF rows (key, term, weight); ties by the smaller item."""
    dots = (
        queries.select(F.col("key").alias("query"), "term", F.col("weight").alias("q"))
        .join(items.select(F.col("key").alias("item"), "term", F.col("weight").alias("i")), "term")
        .groupBy("query", "item")
        .agg(F.sum(F.col("q") * F.col("i")).alias("sim"))
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("sim", 9)), "item"))
    return dots.withColumn("r", rank).filter(F.col("r") <= k).drop("r")


def stacked_tfidf(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, weight): TF-IDF of words and word pairs beside that of character grams, each of unit length, brought to it together."""
    both = [tfidf(df, key, text, terms=t).withColumn("term", F.concat(F.lit(p), "term")) for p, t in (("w:", word_grams), ("c:", char_grams))]
    stacked = both[0].unionByName(both[1])
    length = stacked.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("l"))
    return stacked.join(length, "key").select("key", "term", (F.col("weight") / F.col("l")).alias("weight"))


#: Rows of a block of nearest_in_blocks.
BLOCK_ROWS = 1000


def nearest_in_blocks(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """As nearest_by_terms, for terms that many rows hold: blocks of rows are multiplied in tasks, so no product is a shuffled row."""

    def dealt(side: DataFrame, own: str, other: str, others: int, blocks: int) -> DataFrame:
        rows = side.select(F.lit(own).alias("side"), "key", "term", "weight", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias(own))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    n_q, n_i = (max(1, -(-x.select("key").distinct().count() // BLOCK_ROWS)) for x in (queries, items))
    sent = dealt(queries, "q", "i", n_i, n_q).unionByName(dealt(items, "i", "q", n_q, n_i))

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        code, _ = pd.factorize(group["term"])
        first = (group["side"] == "q").to_numpy()
        sides = []
        for mine in (first, ~first):
            row, names = pd.factorize(group["key"][mine])
            order = np.argsort(code[mine], kind="stable")
            terms, start = np.unique(code[mine][order], return_index=True)
            end = np.append(start[1:], len(order))
            sides.append((names.to_numpy(), row[order], group["weight"].to_numpy()[mine][order], dict(zip(terms, zip(start, end)))))
        (q_names, q_row, q_weight, q_at), (i_names, i_row, i_weight, i_at) = sides
        dot = np.zeros((len(q_names), len(i_names)))
        for term, (a, b) in q_at.items():
            if term in i_at:
                c, e = i_at[term]
                dot[np.ix_(q_row[a:b], i_row[c:e])] += np.outer(q_weight[a:b], i_weight[c:e])
        out = []
        by_name = np.argsort(i_names)
        for x, sims in zip(q_names, dot):
            best = by_name[np.argsort(-np.round(sims[by_name], 9), kind="stable")[:k]]
            out += [(x, i_names[y], float(sims[y])) for y in best if sims[y] > 0]
        return pd.DataFrame(out, columns=["query", "item", "sim"])

    best = sent.groupBy("q", "i").applyInPandas(multiply, "query string, item string, sim double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("sim", 9)), "item"))
    return best.withColumn("r", rank).filter(F.col("r") <= k).drop("r")


def vote(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(query, label, confidence): similarity-weighted votes of neighbours (query, item, sim) with labels (item, label)."""
    votes = neighbours.join(labels, "item").groupBy("query", "label").agg(F.sum("sim").alias("v"))
    best = votes.groupBy("query").agg(F.max(F.struct(F.round("v", 9).alias("v"), "label")).alias("b"), F.sum("v").alias("all"))
    return best.select("query", "b.label", F.when(F.col("all") > 0, F.col("b.v") / F.col("all")).otherwise(0.0).alias("confidence"))


def dot(a, b):
    """The dot product of two arrays of numbers, inside code generation."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def prototypes(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, centre): the mean vector of each label, summed by position before it is sent."""
    spread = df.select(F.col(label).alias("label"), F.posexplode(vector).alias("i", "x"))
    return spread.groupBy("label", "i").agg(F.avg("x").alias("x")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centre"))


def nearest_prototype(df: DataFrame, key: str, vector: str, centres: DataFrame, most: int = 1000) -> DataFrame:
    """(key, label, sim, confidence): the prototype with the largest cosine, and its softmax over 10 times the cosines.

    The prototypes are a small list, checked to be at most `most`; they are one array on every row, so no row is multiplied.
    """
    rows = centres.orderBy("label").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} prototypes")
    norm = lambda v: F.sqrt(dot(v, v))
    sims = F.array(*[F.struct((dot(F.col(vector), F.lit(list(r["centre"]))) / (norm(F.col(vector)) * float(sum(x * x for x in r["centre"]) ** 0.5))).alias("sim"), F.lit(r["label"]).alias("label")) for r in rows])
    best = df.select(key, sims.alias("s")).select(key, F.array_max("s").alias("b"), "s")
    return best.select(key, "b.label", "b.sim", (F.exp(10 * F.col("b.sim")) / F.aggregate("s", F.lit(0.0), lambda t, x: t + F.exp(10 * x["sim"]))).alias("confidence"))


def train_classifier(df: DataFrame, text: str, label: str, least: int = 5, features: int = 1 << 12, rounds: int = 20) -> PipelineModel:
    """A logistic regression on hashed words, on labels with at least `least` rows."""
    kept = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= least)
    data = df.join(kept.select(label), label).select(F.coalesce(F.col(text), F.lit("")).alias("__text"), F.col(label).alias("__label"))
    steps = [Tokenizer(inputCol="__text", outputCol="__words"), HashingTF(inputCol="__words", outputCol="__f", numFeatures=features), StringIndexer(inputCol="__label", outputCol="__y", handleInvalid="skip", stringOrderType="alphabetAsc")]
    return Pipeline(stages=[*steps, LogisticRegression(featuresCol="__f", labelCol="__y", maxIter=rounds, regParam=0.001)]).fit(data)


def predict(model: PipelineModel, df: DataFrame, key: str, text: str, k: int = 3) -> DataFrame:
    """(key, label, confidence, top): the likeliest label, its probability, and the k likeliest ones in order."""
    names = model.stages[2].labels
    data = df.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    for step in (model.stages[0], model.stages[1], model.stages[3]):
        data = step.transform(data)
    p = vector_to_array("probability")
    ranked = F.reverse(F.array_sort(F.transform(p, lambda x, i: F.struct(x.alias("p"), (-i).alias("i")))))
    names_array = F.array(*[F.lit(n) for n in names])
    return data.select(F.col("__key").alias(key), ranked.alias("r")).select(
        key, F.element_at(names_array, 1 - F.col("r")[0]["i"]).alias("label"), F.col("r")[0]["p"].alias("confidence"), F.transform(F.slice("r", 1, k), lambda s: F.element_at(names_array, 1 - s["i"])).alias("top")
    )


def held_out(key, parts: int = 5):
    """Whether a row belongs to the held-out fifth: by the hash of its key, the same at every run."""
    return F.pmod(F.xxhash64(key), F.lit(parts)) == 0
