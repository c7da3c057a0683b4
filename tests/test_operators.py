"""Operators on small literal tables: nulls, ties, repeats, empty tables and clashing names."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import similarity, text, values
from tallyloom.operators import entities, graph, groups, joins, learning, rules, skew
from tallyloom.operators.packed import parse_packed, split_packed
from tallyloom.plans.registry import expanded
from tallyloom.sources import files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_packed_values_of_every_form():
    got = lambda s: [v for _, v, _, e in parse_packed(s) if e != "not a value"]
    assert got('["http:\\/\\/a.test\\/x", "https://b.test/q?t=\\"s\\"\\u0026z=1"]') == ["http://a.test/x", 'https://b.test/q?t="s"&z=1']
    assert got("['https://a.test/annual report.pdf', \"http://b.test/o'd\"]") == ["https://a.test/annual report.pdf", "http://b.test/o'd"]
    assert got('"http://a.test/q?t=""s""", www.b.test | HTTPS://c.test/d,w5;') == ['http://a.test/q?t="s"', "www.b.test", "HTTPS://c.test/d,w5"]
    assert got("1. http://a.test/x 2) https://b.test/list?t=a|b\n• http://a.test/x") == ["http://a.test/x", "https://b.test/list?t=a|b", "http://a.test/x"]
    assert got("http://a.test/x;jsessionid=1, ;https://b.test\r\n") == ["http://a.test/x;jsessionid=1", "https://b.test"]
    for nothing in (None, "", " ", "N/A", "none", "[]", "[ ]", "Did not find", "null", '[""]'):
        assert got(nothing) == []


def test_packed_values_flag_malformed_quotes():
    found = parse_packed('"http://a.test/x, http://b.test/y')
    assert [v for _, v, _, _ in found] == ["http://a.test/x", "http://b.test/y"]
    assert found[0][3] == "unclosed quote"


def test_packed_values_take_a_very_long_text_and_keep_positions():
    many = ", ".join(f"http://a.test/{i}" for i in range(20_000))
    found = parse_packed(many)
    assert len(found) == 20_000 and found[-1][0] == 20_000


def test_packed_values_after_stray_text_are_kept():
    assert [(p, v) for p, v, _, _ in parse_packed("Source: https://a.example/x, [1] https://b.example")] == [(1, "https://a.example/x"), (2, "https://b.example")]


@pytest.mark.parametrize("text", ['"a' * 500_000, "'\"x " * 250_000, "(" * 1_000_000, "(" * 500_000 + "x)", "http://a.test/" + "," * 1_000_000 + "x", '"' + "\\" * 1_000_000])
def test_a_megabyte_of_broken_quotes_is_read_in_a_second(text):
    start = time.time()
    parse_packed(text)
    assert time.time() - start < 2


def test_split_packed_with_clashing_columns_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.test http://a.test", "x", 7), (2, None, "y", 8), (None, "www.b.test", "z", 9)], "id long, urls string, value string, pos int")
    assert rows(split_packed(df.filter("id = 1"), "id", "urls").select("id", "pos", "value")) == [(1, 1, "http://a.test"), (1, 2, "http://a.test")]
    assert split_packed(df, "id", "urls").count() == 3
    assert split_packed(df.limit(0), "id", "urls").count() == 0


@pytest.fixture
def skewed(spark):
    random.seed(5)
    data = [("hot" if random.random() < 0.6 else random.choice("abc"), random.choice([None, *range(9)]), 1) for _ in range(600)] + [(None, 3, 1)]
    return spark.createDataFrame(data, "k string, v long, key int"), data


def test_frequencies_give_distinct_mode_and_percentile(spark, skewed):
    df, data = skewed
    freqs = skew.value_frequencies(df, "k", "v")
    by = {}
    for k, v, _ in data:
        by.setdefault(k, []).append(v)
    distinct = {r["key"]: (r["n_distinct"], r["n_rows"]) for r in skew.distinct_per_key(freqs).collect()}
    assert distinct == {k: (len({x for x in vs if x is not None}), len(vs)) for k, vs in by.items()}
    solid = {k: sorted(x for x in vs if x is not None) for k, vs in by.items() if k is not None}
    modes = {r["key"]: r["mode_value"] for r in skew.mode_per_key(freqs.filter("key IS NOT NULL")).collect()}
    assert modes == {k: min(set(vs), key=lambda x: (-vs.count(x), x)) for k, vs in solid.items()}
    medians = {r["key"]: r["quantile"] for r in skew.percentile_per_key(freqs.filter("key IS NOT NULL"), 0.5).collect()}
    assert medians == {k: vs[-(-len(vs) // 2) - 1] for k, vs in solid.items()}
    assert skew.distinct_per_key(skew.value_frequencies(df.limit(0), "k", "v")).count() == 0


def test_skewed_lookup_loses_nothing(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    sizes = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("tag", F.col("k") * 10)
    got = skew.lookup_skewed(left, sizes, ["k"], "n", 3000, share=10)
    assert got.count() == 3000 and got.filter("tag <> k * 10").count() == 0


def test_groups_have_defined_ties(spark):
    df = spark.createDataFrame([("a", "y", 1), ("a", "x", 2), ("a", None, 3), (None, "z", 4)], "k string, v string, o long")
    assert {(r["k"], r["mode"]) for r in groups.mode_by(df, ["k"], "v").collect()} == {("a", "x"), (None, "z")}
    assert {(r["k"], r["mode"]) for r in groups.mode_by(df, ["k"], "v", order="o").collect()} == {("a", "y"), (None, "z")}
    assert groups.last_non_null(df, ["k"], "o", ["v"]).filter("k = 'a'").first()["v"] == "x"
    assert groups.conflicts(df, ["k"], "v").first()["n_values"] == 2
    assert groups.sample_rows(df, 2, "o").count() == 2


def test_joins(spark):
    codes = spark.createDataFrame([(1, "5221"), (2, "52"), (3, None), (4, "99")], "id long, code string")
    table = spark.createDataFrame([("52", "money"), ("522", "banks")], "p string, v string")
    assert rows(joins.prefix_longest(codes, table, "code", "p", "v").select("id", F.coalesce("v", F.lit("-")))) == [(1, "banks"), (2, "money"), (3, "-"), (4, "-")]
    a = spark.createDataFrame([("k", 1), ("k", 2), (None, 3)], "k string, i long")
    assert rows(joins.pairs_within(a, ["k"], "i").select("id_a", "id_b")) == [(1, 2)]
    assert rows(joins.not_in(a, a.filter("k = 'k'"), ["k"]).select("i")) == [(3,)]
    left = spark.createDataFrame([("k", 5), ("k", 1)], "k string, t long")
    right = spark.createDataFrame([("k", 2, "old"), ("k", 4, "new")], "k string, t long, v string")
    assert {(r["t"], r["v"]) for r in joins.as_of(left, right, ["k"], "t", "v").collect()} == {(5, "new"), (1, None)}


def test_as_of_carries_values_over_spans_of_a_hot_key(spark):
    random.seed(3)
    right = [("k" if random.random() < 0.9 else "q", random.randrange(400), i) for i in range(60)] + [(None, 5, 1), ("k", None, 2), ("k", 7, None)]
    left = [(i, random.choice(["k", "k", "q", "none", None]), random.choice([None, random.randrange(450)])) for i in range(200)]
    l, r = spark.createDataFrame(left, "id long, k string, t long"), spark.createDataFrame(right, "k string, t long, v long")
    got = {x["id"]: x["v"] for x in joins.as_of(l, r, ["k"], "t", "v", width=20).collect()}

    def latest(k, t):
        seen = [(rt, v) for rk, rt, v in right if None not in (rk, rt, v, k, t) and rk == k and rt <= t]
        return max(seen)[1] if seen else None

    assert got == {i: latest(k, t) for i, k, t in left}
    assert joins.as_of(l.limit(0), r, ["k"], "t", "v").count() == 0 and joins.as_of(l, r.limit(0), ["k"], "t", "v").filter("v IS NULL").count() == 200


def test_classes_say_what_pairs_would(spark):
    random.seed(5)
    data = [(i, random.choice(["a", "b", None]), random.choice(["x", "y", None]), random.choice([1, 2])) for i in range(60)]
    df = spark.createDataFrame(data, "id long, p string, q string, n int")
    alike = lambda a, b, ks: all(a[k] is not None and a[k] == b[k] for k in ks)
    partners = {a[0]: {b[0] for b in data if a[0] != b[0] and (alike(a, b, (1,)) or alike(a, b, (2, 3)))} for a in data}
    got = {r["id"]: r["n_links"] for r in entities.two_blocks(df, "id", ["p"], ["q", "n"], "by_p", "by_q").collect()}
    assert got == {k: len(v) for k, v in partners.items()}
    one = {r["id"]: (r["class"], r["n_links"]) for r in joins.class_of(df, ["p"], "id").collect()}
    assert one == {a[0]: (min(b[0] for b in data if b[1] == a[1]), sum(b[1] == a[1] for b in data) - 1) for a in data if a[1] is not None}
    assert joins.class_of(df.limit(0), ["p"], "id").count() == 0


def brute_components(edges):
    of = {}
    for a, b in edges:
        of.setdefault(a, a), of.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(of[a], of[b])
            changed |= of[a] != low or of[b] != low
            of[a] = of[b] = low
    return of


def test_components_of_chains_cycles_and_loops(spark):
    random.seed(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 200)] + [(random.randint(300, 400), random.randint(300, 400)) for _ in range(60)]
    df = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    assert {r["node"]: r["component"] for r in graph.components(df).collect()} == brute_components(edges)
    assert graph.components(df.limit(0)).count() == 0


def test_walks_of_many_seeds_take_the_fewest_steps(spark):
    random.seed(8)
    edges = [(random.randrange(150), random.randrange(150)) for _ in range(260)] + [(None, 1), (1, None)]
    df = spark.createDataFrame(edges, "parent long, child long")
    want = {}
    for seed in range(150):
        at, want[seed, seed] = {seed}, 0
        for d in range(1, 4):
            at = {b for a, b in edges if a in at and b is not None}
            for n in at:
                want.setdefault((seed, n), d)
    seeds = spark.createDataFrame([(i,) for i in [*range(150), 3, None]], "node long")
    assert {(r["seed"], r["node"]): r["depth"] for r in graph.reachable(df, seeds, 3).collect()} == want
    assert graph.reachable(df.limit(0), seeds.filter("node < 2"), 3).count() == 2 and graph.reachable(df, seeds.limit(0), 3).count() == 0


def test_layers_leave_cycles_out(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (10, 11), (11, 10), (12, 10)], "parent long, child long")
    assert {r["node"]: r["layer"] for r in graph.layers(e).collect()} == {3: 0, 2: 1, 1: 2, 10: None, 11: None, 12: None}


def test_money_is_conserved_without_cycles(spark):
    e = spark.createDataFrame([(1, 2, 30.0), (1, 3, 10.0), (2, 3, 5.0)], "parent long, child long, amount double")
    own = spark.createDataFrame([(1, "a", 60.0), (2, "b", 15.0), (3, "c", 7.0)], "node long, label string, amount double")
    got = {(r["node"], r["label"]): round(r["amount"], 6) for r in graph.passed_down(e, own, 4).collect()}
    assert got[(3, "c")] == 7.0 and got[(2, "c")] == 5.0
    assert sum(v for (n, _), v in got.items() if n == 1) == pytest.approx(100.0)


def test_rules(spark):
    df = spark.createDataFrame([("First Union Bank",), ("credit union of x",), (None,)], "t string")
    rule = [("bank", "F"), ("credit union", "C"), ("union", "L")]
    assert [r[0] for r in df.select(rules.longest_keyword(F.col("t"), rule)).collect()] == ["L", "C", None]
    assert [r[0] for r in df.select(rules.last_match(F.lower("t"), rule)).collect()] == ["L", "L", None]
    three = [("a", F.lit("1")), ("b", F.lit(None).cast("string")), ("c", F.lit("1"))]
    assert df.select(rules.agreed(three)).first()[0] == "1"


@pytest.mark.parametrize(
    ("name", "person"),
    [("SMITH, PEGGY AND MIKE", True), ("FIORE, JR, MAURO", True), ("HILL, JD, DR DONALD", True), ("LIN, ,, SOPHIA", True), ("REITER, USAF (RET), MAJ RICHARD", True), ("FITZGERALD, ALVAREZ, AND CIUMMO", False), ("ACME INC", False), (None, False), ("", False)],
)
def test_people_and_firms(spark, name, person):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(text.is_individual(F.col("n"))).first()[0] is person


def test_person_name_parts(spark):
    df = spark.createDataFrame([("REITER, USAF (RET), MAJ RICHARD",), ("DE LA CRUZ JR, ANA MARIA",), ("SMITH",), (None,)], "n string")
    got = [tuple(r["p"]) for r in df.select(text.person_name(F.col("n")).alias("p")).collect()]
    assert got == [("REITER", "RICHARD", None, "USAF", "MAJ"), ("DE LA CRUZ", "ANA", "MARIA", "JR", None), ("SMITH", None, None, None, None), (None, None, None, None, None)]


def test_dates_amounts_and_addresses(spark):
    df = spark.createDataFrame([("3/4/2025 10:30:00", "$1,234.50", "https://WWW.Wow.Example/x"), ("20250304", "abc", "www.a.test"), ("soon", None, None)], "d string, a string, u string")
    got = df.select(values.iso_date(F.col("d")), values.clean_amount(F.col("a")), text.url_domain(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("2025-03-04", 1234.5, "wow.example"), ("2025-03-04", None, "a.test"), ("soon", None, None)]


def test_similarity(spark):
    assert similarity.jaro_winkler_text("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4)
    assert similarity.jaro_winkler_text("", "X") == 0.0
    df = spark.createDataFrame([("NIGHT", "NACHT"), ("", "X"), (None, "X")], "a string, b string")
    assert [r[0] for r in df.select(F.round(similarity.bigram_cosine(F.col("a"), F.col("b")), 4)).collect()] == [0.25, 0.0, None]


@pytest.mark.parametrize("word,key", [("Knight", "NT"), ("Wright", "RT"), ("Schmidt", "SKMTT"), ("Philips", "FLPS"), ("Xavier", "SFR"), ("Church", "XRX"), ("Science", "SNS"), ("Edge", "EJ"), ("Nation", "NXN"), ("Lamb", "LM"), ("Whale", "WL"), ("Cat", "KT"), ("", ""), (None, None), ("1-2", "")])
def test_metaphone_by_literal_words(word, key):
    assert similarity.metaphone_text(word) == key


@pytest.mark.parametrize(
    "function,typed,want",
    [
        (text.standardize_name, "Smith & Jones #4, , Inc.", "SMITH AND JONES NUMBER4, INC"),
        (text.standardize_name, "Local No 5 Workers?", "LOCAL NUMBER 5 WORKERS"),
        (text.business_core, "CAFÉ-BAR (EAST) LLC", "CAFÉ BAR (EAST)"),
        (text.business_core, "ACME AND AFFILIATED ENTITIES INC", "ACME"),
        (text.business_core, "ACME MGMT CO", "ACME MANAGEMENT"),
        (text.committee_core, "ACME PAC ALL PURPOSE ACCOUNT", "ACME ACCOUNT"),
        (text.committee_core, "ACME POLITICAL ACTION COMMITTEE STATE PAC", "ACME"),
        (text.committee_core, "ACME INC FED PAC ID C00377952", "ACME INC"),
        (text.committee_core, "NURSES SMALL CONTRIBUTOR COMMITTEE (FPPC 123)", "NURSES"),
        (text.committee_core, "JANE DOE MAJOR DONOR ACCOUNT", "JANE DOE"),
    ],
)
def test_rewrites_by_literal_rows(spark, function, typed, want):
    assert spark.createDataFrame([(typed,)], "t string").select(function(F.col("t"))).first()[0] == want


def test_entity_cascade_takes_each_row_once(spark):
    df = spark.createDataFrame([(1, "A", "X"), (2, "A", "X"), (3, "B", "X"), (4, "C", "X"), (5, None, "")], "i long, v1 string, v2 string")
    assert rows(entities.exact_cascade(df, "i", ["v1", "v2"])) == [(1, "A", 1), (2, "A", 1), (3, "X", 2), (4, "X", 2)]


def test_neighbours_and_votes(spark):
    df = spark.createDataFrame([("q", "red bank loans"), ("a", "red bank"), ("b", "bank loans"), ("c", "green farm")], "k string, t string")
    w = learning.tfidf(df, "k", "t", least=1, most=1.0)
    near = learning.nearest_by_terms(w.filter("key = 'q'"), w.filter("key <> 'q'"), 2)
    assert {r["item"] for r in near.collect()} == {"a", "b"}
    assert learning.vote(near, spark.createDataFrame([("a", "F"), ("b", "F")], "item string, label string")).first()["label"] == "F"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "x.csv").write_text('name,amount\n"a, b",1\n,x\n')
    got = files.read_csv_typed(spark, str(tmp_path / "x.csv"), {"amount": "double"}).collect()
    assert [tuple(r) for r in got] == [("a, b", 1.0), ("", None)]
    (tmp_path / "u.tsv").write_bytes("k\t v \na\té\n".encode("utf-16"))
    assert [tuple(r) for r in files.read_tsv_utf16(spark, str(tmp_path / "u.tsv"), "k").collect()] == [("a", "é")]
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k long, v string")
    assert files.append_new(df.filter("v <> 'b'"), out, "k") == 2
    assert files.append_new(df, out, "k") == 0
    with pytest.raises(ValueError, match="missing columns: zz"):
        files.require_columns(df, ["k", "zz"])
    looked = files.looked_up(spark.createDataFrame([("a",), ("b",), ("bad",)], "k string"), spark.createDataFrame([("a", "{}")], "k string, result string"), "k", fetch=lambda k: {"v": k} if k == "b" else 1 / 0)
    assert {r["k"]: r["status"] for r in looked.collect()} == {"a": "cached", "b": "fetched", "bad": "error"}


def test_sql_macros_nest():
    assert "strip(" not in expanded("SELECT lower(strip(coalesce(strip(a), ''))) FROM t")


def test_pushdown_and_pruning(spark, sf):
    plan = spark.read.parquet(f"{sf}/contributions.parquet").filter("amount >= 5000").select("row_id", "amount")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(amount), GreaterThanOrEqual(amount,5000.0)]" in plan and "ReadSchema: struct<row_id:bigint,amount:double>" in plan


def test_staged_archives_and_sheets(spark, tmp_path):
    import zipfile

    archive = tmp_path / "a.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("Data/Names.TSV", "k\n1\n")
        z.writestr("../evil.tsv", "no")
    (out,) = files.extract_members(str(archive), ("names.tsv",), str(tmp_path / "out"))
    assert open(out).read() == "k\n1\n" and out.startswith(str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError, match="other.tsv"):
        files.extract_members(str(archive), ("other.tsv",), str(tmp_path / "out"))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = tmp_path / "b.xlsx"
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>name</t></si><si><t>Acme</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1"><v>title</v></c></row><row><c r="A2" t="s"><v>0</v></c><c r="B2" t="inlineStr"><is><t>n</t></is></c></row><row><c r="A3" t="s"><v>1</v></c></row></sheetData></worksheet>')
    sheet = files.read_xlsx(spark, str(book), skip=1)
    assert sheet.columns == ["name", "n"] and rows(sheet) == [("Acme", "")]


def test_retries_end():
    tried = []

    def fetch(key):
        tried.append(key)
        if len(tried) < 3:
            raise ConnectionError
        return {}

    assert files.retrying(fetch, waits=(0.0, 0.0))("k") == {} and len(tried) == 3


def test_state_backups_and_resumed_runs(spark, tmp_path):
    at = lambda n: f"file://{tmp_path}/{n}"
    default = spark.createDataFrame([("none", 0)], "name string, n long")
    assert rows(files.load_state(spark, at("state"), default)) == [("none", 0)]
    files.save_state(spark, at("state"), spark.createDataFrame([("a", 1), ("b", None)], "name string, n long"))
    assert {tuple(r) for r in files.load_state(spark, at("state"), default).collect()} == {("a", 1), ("b", None)}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text('{"name": "a", "n": 1}\n{"name":')
    assert rows(files.load_state(spark, at("bad"), default)) == [("none", 0)]
    one = spark.range(3)
    for df in (one, one.limit(1), one.limit(0)):
        files.backed_up(df, at("out"))
    assert spark.read.parquet(at("out.bak")).count() == 3 and spark.read.parquet(at("out")).count() == 0
    work = lambda df: df
    assert [files.resumed(one.filter("id < 2"), at("run"), "id", work), files.resumed(one, at("run"), "id", work), files.resumed(one, at("run"), "id", work)] == [2, 1, 0]
    assert spark.read.parquet(at("run")).count() == 3


def test_batches_are_aligned_by_position_and_providers_by_name(spark):
    units = groups.numbered(spark.createDataFrame([(f"u{i:02}",) for i in range(23)], "u string"), "u", "n")
    assert rows(units.select("n", "u")) == [(i + 1, f"u{i:02}") for i in range(23)]
    cut = units.withColumn("batch", F.floor((F.col("n") - 1) / 10)).withColumn("pos", (F.col("n") - 1) % 10)
    got = files.answered(cut, "u", lambda us: [x.upper() for x in us] if len(us) == 10 else ["too few"])
    assert {r["u"]: r["answer"] for r in got.collect()} == {f"u{i:02}": f"U{i:02}" if i < 20 else None for i in range(23)}
    run = files.dispatched({"a": lambda k: {"k": k}})
    assert run("a|x|y") == {"k": "x|y"}
    with pytest.raises(KeyError):
        run("b|x")


def test_a_csv_is_split_unless_it_has_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"two\nlines"\n2,\n')
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv"), line_breaks=True)) == [("1", "two\nlines"), ("2", "")]
    assert files.read_sheet(spark, lambda: [["a", "b"], [1, None], [2]]).collect() == [("1", ""), ("2", "")]


def test_windows_leave_late_rows_out(spark, tmp_path):
    from tallyloom.streaming import streams

    def put(name, times):
        spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    put("in", ["2025-01-01 00:10:00", "2025-01-01 00:20:00", "2025-01-05 00:00:00"])
    df = spark.readStream.schema("ts timestamp").parquet(str(tmp_path / "in"))
    got = streams.run_available(streams.tumbling(df, "ts", "1 hour", n=F.count(F.lit(1))))
    assert [r["n"] for r in got.collect()] == [2]  # the last window is still open


def test_stored_tables_can_be_swept(spark):
    from tallyloom import session

    kept = session.cut(spark.range(5), "sweep")
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert kept.count() == 5 and files.exists(spark, path)
    assert session.swept(spark) >= 1 and not files.exists(spark, path) and session.swept(spark) == 0


def test_header_tolerance():
    assert files.header_names([" Contributor.Name ", "Ballot  Measure(s)"]) == ["CONTRIBUTOR NAME", "BALLOT MEASURE(S)"]
    assert files.find_column(["Contributor.Name", "x"], "contributor name") == "Contributor.Name" and files.find_column([], "a") is None
