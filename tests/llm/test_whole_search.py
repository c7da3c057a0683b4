"""Candidate search finds every pair that the comparison takes for one, and the same pairs however much is loaded."""

import random

from tallyloom.llm import names, spelling

SCHEMA = "id long, place string, name string, business boolean"
FIRMS = [
    "XENQ PHARMACEUTICALS", "XENQ PHARM", "KORBLIT INTL", "KORBLIT INTERNATIONAL", "QVMNTRL HLTH", "QVMNTRL HEALTH",  # short for the rarest word
    "AB CDEFGHIJKL", "ABCDEFGHIJKL", "GOLDEN GATE PARK", "GOLDENGATE PARKK",  # run together
    "ZED KIM OPTICS", "ZED CIM OPTICS", "TRAVENSO ROOFING SUPPLY", "TRAVENSO RUFFN SUPPLY", "WALLA WALLA", "WALLA WALA", "MARLBECKS TILE", "NARLBECKT TILE",
]
PEOPLE = [
    "BOB WESSKI", "ROBERT WESSKI", "WESSKI BOBBY", "ALVAREZ MORETTI, ANA", "ALVAREZ, ANA", "MORETTI, ANA", "JIM JAMES", "JAMES JAMES", "KIM, SUE", "CIM, SUSAN",
    "A B C", "A B C D", "GARBANOLIS, PETERSEN", "BARBANOLIT, PETERSEN", "PHILLIPA TORVANE", "FILLIPA TORVANE",
]


def searched(spark, firms, people):
    """(pairs that compare as one, candidates) of names at one place."""
    rows = [(i, "ELK", n, i < len(firms)) for i, n in enumerate([*firms, *people])]
    _, forms, words = spelling.formed(spelling.with_kind(spelling.parsed_names(spark.createDataFrame(rows, SCHEMA))))
    kept = sorted(forms.collect(), key=lambda r: r["form"])
    counts = {(r["business"], r["token"]): (r["n"], r["before"]) for r in words.collect()}
    want = set()
    for k, a in enumerate(kept):
        for b in kept[k + 1 :]:
            if (a["block"], a["business"]) == (b["block"], b["business"]):
                x, y = tuple(a["tokens"]), tuple(b["tokens"])
                at = lambda t, i: tuple(counts.get((a["business"], w), (1, None))[i] for w in t)
                family = lambda t: tuple(names.family_name(w, c) for w, c in zip(t, at(t, 1)))
                score = names.same_business(x, y, at(x, 0), at(y, 0)) if a["business"] else names.same_person(x, y, family(x), family(y))
                if score >= 0.75 or score == names.INITIALS:
                    want.add((a["form"], b["form"]))
    return want, {tuple(r) for r in spelling.candidates(forms, words).collect()}


def slipped(w):
    i = random.randrange(len(w) - 1)
    return random.choice([w[:i] + w[i + 1 :], w[:i] + "E" + w[i:], w[:i] + "X" + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[: len(w) // 2 + 1], w.replace("A", "")])


def test_no_pair_that_compares_as_one_is_left_out(spark, monkeypatch):
    random.seed(21)
    heads = ["".join(random.choices("BCDFGKLMNPRSTVZ", k=2)) + random.choice(["ANDEX", "OLIMARK", "ENT", "URBASTEN"]) for _ in range(12)]
    kinds = ["ROOFING SUPPLY", "HEALTH SERVICES", "TILE", "COMMUNITY HEALTH SERVICES"]
    firms = FIRMS + [" ".join(slipped(w) if random.random() < 0.4 else w for w in f"{random.choice(heads)} {random.choice(kinds)}".split()) for _ in range(150)]
    given = ["ROBERT", "BOB", "R", "ELIZABETH", "BETSY", "JAMES", "ANA"]
    family = ["GARBANOLIS", "ALVAREZ", "JAMES", "KIM", "TORVANE"]
    people = PEOPLE + [random.choice(["{0}, {1}", "{1} {0}", "{0} {2}, {1}"]).format(slipped(random.choice(family)), random.choice(given), random.choice(family)) for _ in range(150)]
    want, got = searched(spark, firms, people)
    assert len(want) > 300 and not want - got
    monkeypatch.setattr(spelling, "HOT", 1)
    assert not want - searched(spark, firms, people)[1]
