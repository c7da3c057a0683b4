"""Entity resolution by rules: name variants, cascades of exact links, scored pairs, registries and conflicts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.similarity import bigram_cosine, jaro_winkler, jaro_winkler_at_most, jaro_winkler_pairs, letters
from tallyloom.operators.graph import components
from tallyloom.operators.joins import not_in, pairs_within
from tallyloom.session import cut, ship


def name_variants(c: Column) -> list[Column]:
    """Ever shorter forms of a name: standardised, without committee ids, without parentheses, without its legal form."""
    v1 = text.standardize_name(c)
    v2 = text.committee_core(v1)
    v3 = text.without_parentheses(v2)
    return [v1.alias("v1"), v2.alias("v2"), v3.alias("v3"), text.business_core(v3).alias("v4")]


def exact_cascade(df: DataFrame, ident: str, variants: list[str]) -> DataFrame:
    """(ident, key, level): each row by the first variant that it shares with another row not yet matched.

    A row matched at one level leaves the pool of the next ones. Keys are counted, not paired, so a key that many rows share
    costs one row. Blank and null variants match nothing.
    """
    pool, out = df, None
    for level, v in enumerate(variants, 1):
        shared = pool.filter(F.col(v) != "").groupBy(v).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(v)
        hit = pool.join(shared, v, "left_semi").select(ident, F.col(v).alias("key"), F.lit(level).alias("level"))
        out = hit if out is None else out.unionByName(hit)
        pool = pool.join(hit.select(ident), ident, "left_anti")
    return out


def scored_pairs(df: DataFrame, block: list[str], ident: str, name: str, auto: float = 0.9, review: float = 0.85) -> DataFrame:
    """(id_a, id_b, jw, cosine, link): pairs within a block whose names are alike by both measures, linked or to be reviewed.

    Blocks should be keys that few different names share; equal names are compared once.
    """
    names = df.filter(F.col(name).isNotNull()).groupBy(*block, name).agg(F.min(ident).alias(ident))
    left = names.select(*block, F.col(ident).alias("id_a"), F.col(name).alias("a"))
    right = names.select(*block, F.col(ident).alias("id_b"), F.col(name).alias("b"))
    pairs = left.join(right, block).filter("id_a < id_b").withColumn("cosine", bigram_cosine(F.col("a"), F.col("b"))).filter("cosine >= 0.5")
    return _linked(pairs, auto, review)


def _linked(pairs: DataFrame, auto: float, review: float) -> DataFrame:
    scored = pairs.withColumn("jw", jaro_winkler(F.col("a"), F.col("b"))).filter("jw >= 0.7")
    return scored.select("id_a", "id_b", "jw", "cosine", _link(auto, review))


def _link(auto: float, review: float) -> Column:
    mean = (F.col("jw") + F.col("cosine")) / 2
    return F.when(mean >= auto, "auto").when(mean >= review, "review").otherwise("none").alias("link")


#: Different names in a block of similar_pairs, of which so many are multiplied at a time, and bigrams counted at a time.
BLOCK_NAMES, BLOCK_ROWS, BLOCK_GRAMS = 4096, 256, 1024


def _gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(text, bigram, how often) of bigrams numbered by how they come among all texts, and the number of different ones."""
    length = np.array([len(t) for t in texts], "i8")
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype("i8")
    row = np.repeat(np.arange(len(texts)), length)
    within = row[1:] == row[:-1]
    grams, number = np.unique((points[:-1] << 21 | points[1:])[within], return_inverse=True)
    cells, many = np.unique(row[:-1][within] * len(grams) + number, return_counts=True)
    return cells // len(grams), cells % len(grams), many, len(grams)


def _alike(texts: list[str], split: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine): texts before `split` and from there on, whose bigram cosine is at least `least`."""
    row, gram, many, grams = _gram_counts(texts)
    norm = np.sqrt(np.bincount(row, many.astype("float64") ** 2, len(texts)))
    # the error of a cosine times both norms stays far below a half
    kind = "float32" if norm.max(initial=0) < 100 else "float64"
    share = (many / norm[row]).astype(kind)
    cosine = np.zeros((split, len(texts) - split), kind)
    for g in range(0, grams, BLOCK_GRAMS):
        held = (gram >= g) & (gram < g + BLOCK_GRAMS)
        matrix = np.zeros((len(texts), min(BLOCK_GRAMS, grams - g)), kind)
        matrix[row[held], gram[held] - g] = share[held]
        for s in range(0, split, BLOCK_ROWS):
            e = min(s + BLOCK_ROWS, split)
            cosine[s:e] += matrix[s:e] @ matrix[split:].T
    found = []
    for s in range(0, split, BLOCK_ROWS):
        part = cosine[s : s + BLOCK_ROWS]
        i, j = np.divmod(np.flatnonzero(part.ravel() >= least - 1e-4), part.shape[1])
        # the product of counts is a whole number, so rounding makes it exact
        exact = np.rint(part[i, j].astype("float64") * norm[s + i] * norm[split + j]) / (norm[s + i] * norm[split + j])
        kept = exact >= least
        found.append((s + i[kept], split + j[kept], exact[kept]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def similar_pairs(df: DataFrame, ident: str, name: str, auto: float = 0.9, review: float = 0.85, least: float = 0.5) -> DataFrame:
    """(id_a, id_b, jw, cosine, link): as scored_pairs, but over all pairs of different names; ident is unique.

    A bigram cosine of 0.5 is too low for an index that loses nothing, as one frequent ending reaches it. So names are dealt to
    blocks, and each pair of blocks is a task that multiplies their bigram counts and compares those that are alike many at a
    time; its work is the square of the different names.
    """
    ship(df.sparkSession)
    names = cut(df.filter(F.length(name) > 1).groupBy(F.col(name).alias("text")).agg(F.min(ident).alias("id")), "names")
    blocks = max(1, -(-names.count() // BLOCK_NAMES))
    dealt = names.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = dealt.select("id", "text", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        left, right = group[group["own"] == i], group[group["own"] == j]
        both = pd.concat([left, right])
        texts, ids = both["text"].tolist(), both["id"].to_numpy()
        a, b, cosine = _alike(texts, len(left), least) if len(left) and len(right) else (np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0))
        turn = ids[a] > ids[b]
        if i == j:
            a, b, cosine = (x[ids[a] < ids[b]] for x in (a, b, cosine))
        else:
            a, b = np.where(turn, b, a), np.where(turn, a, b)
        jw = jaro_winkler_pairs(texts, a, b)
        kept = jw >= 0.7
        return pd.DataFrame({"id_a": ids[a[kept]], "id_b": ids[b[kept]], "jw": jw[kept], "cosine": cosine[kept]})

    kind = dict(names.dtypes)["id"]
    pairs = sent.groupBy("i", "j").applyInPandas(multiply, f"id_a {kind}, id_b {kind}, jw double, cosine double")
    return pairs.select("id_a", "id_b", "jw", "cosine", _link(auto, review))


def similar_by_rare_words(df: DataFrame, ident: str, name: str, least: float, words: int = 2) -> DataFrame:
    """(id_a, id_b, jw): pairs of different names that share one of their `words` rarest words and are alike by Jaro-Winkler.

    df holds each name once. Pairs whose letters are too different are dropped by counts of them, before any text is compared. A word that is frequent in the table is a key only of names that have no rarer ones; two names with
    slips in all their rarest words are not met.
    """
    held = df.select(ident, name, F.explode(F.array_distinct(F.filter(F.split(name, " "), lambda w: w != ""))).alias("__w"))
    counts = held.groupBy("__w").agg(F.count(F.lit(1)).alias("__n"))
    order = F.row_number().over(Window.partitionBy(name).orderBy("__n", "__w"))
    keys = held.hint("merge").join(counts, "__w").withColumn("__r", order).filter(F.col("__r") <= words).select("__w", ident, name)
    keys = cut(keys.withColumn("__l", letters(F.col(name))), "keys")
    left, right = (keys.select("__w", F.col(ident).alias(f"id_{x}"), F.col(name).alias(x), F.col("__l").alias(f"{x}_l")) for x in "ab")
    most = jaro_winkler_at_most(F.col("a"), F.col("b"), F.col("a_l"), F.col("b_l"))
    pairs = left.hint("merge").join(right, "__w").filter("id_a < id_b").filter(most >= least - 1e-9).select("id_a", "id_b", "a", "b").distinct()
    return pairs.withColumn("jw", jaro_winkler(F.col("a"), F.col("b"))).filter(F.col("jw") >= least).select("id_a", "id_b", "jw")


def two_blocks(df: DataFrame, ident: str, first: list[str], second: list[str], first_name: str, second_name: str) -> DataFrame:
    """(ident, class of the first keys, class of the second, n_links): rows that meet by equal keys of either block.

    A class is named by its smallest id, null where a key is null; n_links counts the different partners in both. No pair is made.
    """
    both = list(dict.fromkeys([*first, *second]))
    known = lambda keys: F.lit(True) if not keys else sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0)) == 0
    out = df
    for keys, name, n in ((first, first_name, "__a"), (second, second_name, "__b"), (both, "__both", "__ab")):
        groups = df.filter(known(keys)).groupBy(*keys).agg(F.min(ident).alias(name), F.count(F.lit(1)).alias(n))
        out = out.join(groups, keys, "left")
    one = lambda c: F.coalesce(c, F.lit(1))
    return out.select(ident, first_name, second_name, (one("__a") + one("__b") - one("__ab") - 1).alias("n_links"))


def weighted_score(parts: list[tuple[Column, float, Column]]) -> Column:
    """Scores (score, weight, informative) with the weights of the informative ones brought to a sum of 1; null if none is."""
    total = sum((F.when(known, F.lit(w)).otherwise(0.0) for _, w, known in parts), F.lit(0.0))
    summed = sum((F.when(known, s * w).otherwise(0.0) for s, w, known in parts), F.lit(0.0))
    return F.when(total > 0, summed / total)


def entity_groups(df: DataFrame, scope: str, name: str, ident: str) -> DataFrame:
    """(scope, name, entity): names of one scope joined by shared ids; names with more than one id join nothing.

    Nodes are texts 'scope|name:' and 'scope|id:', so one run of components serves all scopes.
    """
    clear = df.filter(F.col(name).isNotNull()).groupBy(scope, name).agg(F.count_distinct(ident).alias("__n"), F.min(ident).alias("__id"))
    node = F.concat_ws("|", F.col(scope).cast("string"), F.concat(F.lit("name:"), F.col(name)))
    linked = clear.filter("__n = 1").select(node.alias("a"), F.concat_ws("|", F.col(scope).cast("string"), F.concat(F.lit("id:"), F.col("__id"))).alias("b"))
    found = components(linked)
    return clear.withColumn("node", node).join(found, "node", "left").select(scope, name, F.coalesce("component", "node").alias("entity"))


def registry_links(names: DataFrame, registry: DataFrame) -> DataFrame:
    """names (cluster, name) against registry (name, entity): (cluster, entity, status) with 0, 1 or many registered entities."""
    hits = names.join(registry, "name", "left").groupBy("cluster").agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("entity"))
    new = F.concat(F.lit("N"), F.substring(F.sha2(F.col("cluster").cast("string"), 256), 1, 12))
    return hits.select("cluster", F.when(F.col("n") == 0, new).otherwise(F.col("entity")).alias("entity"), F.when(F.col("n") == 0, "new").when(F.col("n") == 1, "reuse").otherwise("conflict").alias("status"))


def appended_names(registry: DataFrame, names: DataFrame) -> DataFrame:
    """The registry with names it did not have, unconfirmed; names it has are never changed."""
    fresh = not_in(names.select("name", "entity").dropDuplicates(["name"]), registry, ["name"])
    return registry.select("name", "entity", F.lit(True).alias("confirmed")).unionByName(fresh.select("name", "entity", F.lit(False).alias("confirmed")))


__all__ = ["appended_names", "entity_groups", "exact_cascade", "name_variants", "pairs_within", "registry_links", "scored_pairs", "similar_by_rare_words", "similar_pairs", "two_blocks", "weighted_score"]
