"""Queries that must use every row of their tables, against brute force on small tables written for the test."""

import pytest

from tallyloom.plans import core

QUERIES = core().queries


@pytest.fixture
def graph_tables(spark, tmp_path):
    """Ten suppliers; rows of all quantities and line numbers, none of them both 50 and first."""
    rows = [(1, 12, 1.0, 1, 100.0), (2, 3, 49.0, 1, 40.0), (3, 1, 50.0, 2, 60.0), (4, 1, 7.0, 3, 25.0), (1, 2, 3.0, 4, 11.5), (5, 5, 50.0, 2, 9.0)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_quantity double, l_linenumber int, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(10)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    edges = {}
    for parent, part, _, _, price in rows:
        if parent != part % 10:
            edges[parent, part % 10] = edges.get((parent, part % 10), 0.0) + price
    return str(tmp_path), edges


def test_cycles_come_from_all_rows(spark, graph_tables):
    d, edges = graph_tables
    left = set(edges)
    while gone := {e for e in left if e[1] not in {p for p, _ in left}}:
        left -= gone
    want = {p for p, _ in left}
    assert want == {1, 2, 3, 4}
    assert {r["node"] for r in QUERIES["gr_cycles"](spark, d).collect()} == want


def test_industries_come_from_all_rows(spark, graph_tables):
    d, edges = graph_tables
    whole = {i: 50000.0 + sum(a for (p, _), a in edges.items() if p == i) for i in range(10)}
    own = {(i, f"N{i % 3}"): 50000.0 for i in range(10)}
    now = own
    for _ in range(5):
        new = dict(own)
        for (p, c), a in edges.items():
            for (node, label), x in now.items():
                if node == c:
                    new[p, label] = new.get((p, label), 0.0) + a * x / whole[c]
        now = new
    got = {(r["node"], r["label"]): r["amount"] for r in QUERIES["gr_industry_distribution"](spark, d).collect()}
    assert got == {k: pytest.approx(v, abs=0.011) for k, v in now.items()}


def test_people_are_compared_across_zips_and_slips(spark, tmp_path):
    fields = "name_id long, contributor_name string, contributor_employer string, contributor_occupation string, contributor_city string, contributor_zip_code string, entity_kind string"
    rows = [
        (1, "SMITH, ANN", "ACME PLUMBING", "PLUMBER", "ELK FERRY", "90001", "individual"),
        (2, "SMITH, ANN", "ACME PLUMBING", "PLUMBER", "ELK FERRY", "90777", "individual"),
        (3, "SMITH, ANN", None, None, "ELK FERRY", None, "individual"),
        (4, "SMYTH, BO", "RETIRED", "RETIRED", "ELK FERRY", "90001", "individual"),
        (5, "JONES, ANN", "ACME PLUMBING", "PLUMBER", "ELK FERRY", "90001", "individual"),
    ]
    spark.createDataFrame(rows, fields).write.parquet(f"{tmp_path}/contributors.parquet")
    got = {(r["id_a"], r["id_b"]): r["score"] for r in QUERIES["er_indiv_compare"](spark, str(tmp_path)).collect()}
    assert set(got) == {(1, 2), (1, 3), (2, 3), (1, 4)}
    assert {(r["name_id"], r["n_links"]) for r in QUERIES["er_indiv_block"](spark, str(tmp_path)).collect()} == {(1, 3), (2, 2), (3, 2), (4, 1), (5, 0)}
    assert got[1, 2] == pytest.approx(0.93)
    assert got[1, 3] == pytest.approx((0.3 + 0.25 + 0.03) / 1)
    # SMITH/SMYTH have a Jaro-Winkler of 0.893333, ANN/BO of 0; one side tells an employer and an occupation
    assert got[1, 4] == pytest.approx(0.3 * 0.893333 + 0.07 + 0.03, abs=2e-6)


def test_organisations_meet_without_zip_and_after_slips(spark, tmp_path, monkeypatch):
    import math
    import random
    from collections import Counter

    from tallyloom.functions.similarity import jaro_winkler_text
    from tallyloom.operators import entities

    monkeypatch.setattr(entities, "BLOCK_NAMES", 25)
    random.seed(4)
    names = ["ZORAN COMMUNITY SERVICES", "OZRAN COMMUNITY SERVICES", "A", ""] + [" ".join(random.sample(["ACME", "ZORAN", "COMMUNITY", "SERVICES", "PLUMBING", "CO", "AACME"], 3)) for _ in range(60)]
    rows = [(i, n, random.choice([None, "90001", "90777"])) for i, n in enumerate(names)] + [(200, "ACME", None), (201, None, None)]
    spark.createDataFrame(rows, "employer_id long, employer_norm string, employer_zip string").write.parquet(f"{tmp_path}/employers.parquet")
    first = {}
    for i, n, _ in rows:
        if n and len(n) > 1:
            first.setdefault(n, i)
    want = {}
    for a in first:
        for b in first:
            x, y = (Counter(t[k : k + 2] for k in range(len(t) - 1)) for t in (a, b))
            cosine = sum(x[g] * y[g] for g in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
            if first[a] < first[b] and cosine >= 0.5 - 1e-12 and jaro_winkler_text(a, b) >= 0.7:
                want[first[a], first[b]] = round(cosine, 6)
    assert (0, 1) in want
    got = {(r["id_a"], r["id_b"]): r["cosine"] for r in QUERIES["er_org_links"](spark, str(tmp_path)).collect()}
    assert got == {k: pytest.approx(v, abs=2e-6) for k, v in want.items()}


def test_votes_of_neighbours_by_words_and_characters(spark, tmp_path):
    import math
    from collections import Counter

    listed = [(0, "ZORAN ROOFING CO", "Construction"), (1, "ACME FARMS INC", "Farming"), (2, "ACME FARMS INC", "Farming"), (3, "BAXTER INC", "Health"), (4, "UNKNOWN", None)]
    firms = [(0, "ZORANN ROFING"), (1, "ACME FARMS INC"), (2, "QUILL INC"), (3, "ZORANN ROFING"), (4, "BAXTRE")]
    spark.createDataFrame(listed, "ref_id long, name_norm string, level1_category string").write.parquet(f"{tmp_path}/running_list.parquet")
    spark.createDataFrame(firms, "employer_id long, employer_norm string").write.parquet(f"{tmp_path}/employers.parquet")
    texts = {f"r{i}": t.lower() for i, t, label in listed if label} | {f"e{i}": t.lower() for i, t in firms}

    def grams(t):
        w = t.split()
        word = Counter(w + [" ".join(x) for x in zip(w, w[1:])])
        return word, Counter(f" {x} "[i : i + n] for x in w for n in range(2, 6) for i in range(len(x) + 3 - n))

    vectors = {k: {} for k in texts}
    for kind in (0, 1):
        df = Counter(g for t in texts.values() for g in grams(t)[kind])
        for k, t in texts.items():
            v = {g: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in grams(t)[kind].items() if 2 <= df[g] <= 0.9 * len(texts)}
            length = math.sqrt(sum(x * x for x in v.values()))
            vectors[k] |= {(kind, g): x / length for g, x in v.items()}
    want = {}
    for i, _ in firms:
        norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
        q = vectors[f"e{i}"]
        sims = sorted((-round(sum(x * v.get(g, 0) for g, x in q.items()) / norm(q) / norm(v), 9), k) for k, v in vectors.items() if k[0] == "r")
        votes = Counter()
        for s, k in sims[:3]:
            if s < 0:
                votes[listed[int(k[1:])][2]] -= s
        label, best = max(votes.items(), key=lambda x: x[1])
        want[i] = (label, pytest.approx(best / sum(votes.values()), abs=2e-6))
    assert want[0][0] == "Construction" and want[4][0] == "Health"
    got = {r["employer_id"]: (r["label"], r["confidence"]) for r in QUERIES["ml_knn_vote"](spark, str(tmp_path)).collect()}
    assert got == want


@pytest.mark.parametrize("nodes", [0, 1 << 18])
def test_rows_of_walks_are_not_shuffled(spark, monkeypatch, nodes):
    import random

    from pyspark.sql import functions as F

    from tallyloom.operators import graph

    for name, value in (("MATRIX_NODES", nodes), ("MATRIX_BYTES", 2000), ("CHUNK", 100), ("CACHED", 64), ("BATCH", 200)):
        monkeypatch.setattr(graph, name, value, raising=False)
    random.seed(11)
    pairs = {(f"n{random.randrange(190)}", f"n{int(190 * random.random() ** 2)}") for _ in range(900)}
    edges = spark.createDataFrame([*pairs, *list(pairs)[:50]], "parent string, child string")
    want = {}
    for seed in {a for a, _ in pairs}:
        at, want[seed, seed] = {seed}, 0
        for d in range(1, 6):
            at = {b for a, b in pairs if a in at}
            for n in at:
                want.setdefault((seed, n), d)
    df = graph.reachable(edges, edges.select(F.col("parent").alias("node")), 5)
    rows = df.collect()
    assert len(rows) == len(want) and {(r["seed"], r["node"]): r["depth"] for r in rows} == want
    # what makes seeds of groups comes last: no join or exchange has a row for each seed and node
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.partition("Generate" if nodes == 0 else "MapInArrow")[0]
