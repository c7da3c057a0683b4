"""Every entry that can be accepted is compared with the value, whichever of its words is repaired."""

from tallyloom.llm.canonical import accept_business, accept_occupation, closest_entries
from tallyloom.llm.names import business_tokens
from tallyloom.llm.occupations import occupation_words


def closest(spark, values, entries, parse, accept):
    found = closest_entries(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame(list(enumerate(entries)), "ref_id long, name string"), parse, accept)
    return {r["value"]: entries[r["ref_id"]] for r in found.collect()}


def test_businesses_are_led_to_by_any_likeness(spark):
    want = {
        "KORBLIT INTERNATIONAL": "KORBLIT INTL",  # the entry is short for the value
        "TILE VARNEM": "TILES VARNEM",  # a word of the list, near to another one
        "GOLDENGATE PARKK": "GOLDEN GATE PARK",  # run together, with a slip
        "KYM TORVANE": "KIM TORVANE",  # a short word of one sound
        "TORVANE K BASKETS": "TORVANE KNITTED BASKETS",
    }
    assert closest(spark, want, [*want.values(), "TILE QUORVEN"], business_tokens, accept_business) == want


def test_occupations_are_led_to_by_initials_and_without_their_rarest_word(spark):
    want = {"P ZITHERIST": "PRINCIPAL ZITHERIST", "XQZ BETA GAMMA DELTA": "ALPHA BETA GAMMA DELTA", "V T": "TURNER VARNISHER"}
    assert closest(spark, want, list(want.values()), occupation_words, accept_occupation) == want
