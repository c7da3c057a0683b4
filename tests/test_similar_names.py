"""Pairs of names are dropped by their letters only if they can't be alike."""

import random

from pyspark.sql import functions as F

from tallyloom.functions.similarity import jaro_winkler_at_most, jaro_winkler_text, letters
from tallyloom.operators import entities


def test_the_bound_is_never_below_the_similarity(spark):
    random.seed(5)
    text = lambda: "".join(random.choices("AB CDÉ9", k=random.randrange(0, 30)))
    rows = [(a, random.choice([text(), a[:-1], a[::-1], a + "X", a.replace("A", "B", 1)])) for a in (text() for _ in range(600))]
    most = jaro_winkler_at_most(F.col("a"), F.col("b"), letters(F.col("a")), letters(F.col("b")))
    got = spark.createDataFrame([r for r in rows if r[0] and r[1]], "a string, b string").select("a", "b", most.alias("m")).collect()
    assert all(r["m"] >= jaro_winkler_text(r["a"], r["b"]) - 1e-9 for r in got)


def test_few_of_the_pairs_of_a_frequent_word_are_compared_as_texts(spark, monkeypatch):
    random.seed(6)
    name = lambda: "".join(random.choices("BCDFGHJKLMNPRSTVWXZ", k=9)) + " SERVICES"
    different = sorted({name() for _ in range(120)})
    rows = list(enumerate([*different, different[0].replace(" ", "Q ")]))
    # what goes into the comparison comes out of it
    monkeypatch.setattr(entities, "jaro_winkler", lambda a, b: F.lit(1.0))
    compared = entities.similar_by_rare_words(spark.createDataFrame(rows, "id long, v string"), "id", "v", 0.97).count()
    monkeypatch.undo()
    assert 1 <= compared < 0.05 * len(rows) ** 2 / 2
    found = entities.similar_by_rare_words(spark.createDataFrame(rows, "id long, v string"), "id", "v", 0.97)
    assert [(r["id_a"], r["id_b"]) for r in found.collect()] == [(0, len(rows) - 1)]


def test_pairs_compared_together_are_as_alike_as_one_by_one(spark, monkeypatch):
    import numpy as np

    from tallyloom.functions import similarity

    random.seed(7)
    texts = ["".join(random.choices("ABC É9𝔘", k=random.choice([0, 1, 2, 5, 12, 30, 64, 65, 90]))) for _ in range(120)]
    texts += [t[1:] + t[:1] for t in texts[:40]] + [texts[5], "ZORAN SERVICES", "OZRAN SERVICES"]
    left, right = (np.array([random.randrange(len(texts)) for _ in range(20_000)]) for _ in "ab")
    want = [jaro_winkler_text(texts[i], texts[j]) for i, j in zip(left, right)]
    assert list(similarity.jaro_winkler_pairs(texts, left, right)) == want
    monkeypatch.setattr(similarity, "MASKS", 3)
    assert list(similarity.jaro_winkler_pairs(texts, left[:500], right[:500])) == want[:500]


def test_names_of_all_pairs_are_not_sent_or_compared_one_by_one(spark, monkeypatch):
    def one_by_one(a, b):
        raise AssertionError("a pair's texts are sent")

    monkeypatch.setattr(entities, "jaro_winkler", one_by_one)
    names = spark.createDataFrame([(i, n) for i, n in enumerate(["ZORAN SERVICES", "OZRAN SERVICES", "ACME", "A"])], "id long, v string")
    assert [(r["id_a"], r["id_b"], r["link"]) for r in entities.similar_pairs(names, "id", "v").collect()] == [(0, 1, "auto")]
