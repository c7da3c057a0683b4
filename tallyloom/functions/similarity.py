"""How alike two texts are: built from array functions where they can express it, else Arrow-batched."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def _grams(c: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))


def bigram_cosine(a: Column, b: Column, n: int = 2) -> Column:
    """The cosine of two texts' n-gram counts; 0 if either is empty, null if either is null."""
    ga, gb = _grams(a, n), _grams(b, n)
    count = lambda grams, g: F.size(F.filter(grams, lambda x: x == g)).cast("double")
    dot = F.aggregate(F.array_intersect(ga, gb), F.lit(0.0), lambda s, g: s + count(ga, g) * count(gb, g))
    norm = lambda grams: F.sqrt(F.aggregate(F.array_distinct(grams), F.lit(0.0), lambda s, g: s + count(grams, g) * count(grams, g)))
    both = (F.length(a) >= n) & (F.length(b) >= n)
    return F.when(a.isNull() | b.isNull(), None).when(both, dot / (norm(ga) * norm(gb))).otherwise(0.0)


def jaro_winkler_text(a: str, b: str, p: float = 0.1) -> float:
    """Jaro-Winkler similarity with prefix weight p over up to four characters, whatever the Jaro similarity."""
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    taken, matched = [False] * m, []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                matched.append(x)
                break
    k = len(matched)
    if not k:
        return 0.0
    moved = sum(x != y for x, y in zip(matched, (b[j] for j in range(m) if taken[j]))) // 2
    jaro = (k / n + k / m + (k - moved) / k) / 3
    prefix = 0
    while prefix < min(4, n, m) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * p * (1 - jaro)


#: Pairs compared at a time, so that their masks stay in a core's cache; the most different characters that get masks.
PAIRS, MASKS = 1 << 13, 512


def jaro_winkler_pairs(texts: list[str], left: np.ndarray, right: np.ndarray, p: float = 0.1) -> np.ndarray:
    """jaro_winkler_text of texts[left] and texts[right], many at a time: places of a character are the bits of a number.

    Texts of more than 64 characters are compared one by one, and all are if they hold more than MASKS different characters.
    """
    out = np.zeros(len(left))
    length = np.array([len(t) for t in texts], "i8")
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    known, codes = np.unique(points, return_inverse=True)
    size = len(known) + 1  # the last is no character
    short = (length[left] <= 64) & (length[right] <= 64) & (size <= MASKS)
    for i in np.flatnonzero(~short):
        out[i] = jaro_winkler_text(texts[left[i]], texts[right[i]], p)
    row = np.repeat(np.arange(len(texts)), length)
    place = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    fits = (place < 64) & (size <= MASKS)
    chars = np.full((len(texts), 64), size - 1, "i8")
    chars[row[fits], place[fits]] = codes[fits]
    masks = np.zeros(len(texts) * size if size <= MASKS else 0, "u8")
    np.bitwise_or.at(masks, row[fits] * size + codes[fits], np.left_shift(np.uint64(1), place[fits].astype("u8")))
    at = np.arange(64)
    below = np.array([(1 << k) - 1 for k in range(65)], "u8")
    window = below[np.minimum(at[:, None] + np.arange(33) + 1, 64)] & ~below[np.maximum(at[:, None] - np.arange(33), 0)]
    whole = np.flatnonzero(short)
    whole = whole[np.argsort(length[left[whole]], kind="stable")]  # as many steps as the longest left text of a part has characters
    for s in range(0, len(whole), PAIRS):
        part = whole[s : s + PAIRS]
        a, b = left[part], right[part]
        n, m, steps = length[a], length[b], int(length[a].max())
        reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
        own, base = chars[a].T.copy(), b * size
        taken = np.zeros(len(part), "u8")
        hits, places = [], []
        for i in range(steps):
            of = masks[base + own[i]]
            free = of & window[i][reach] & ~taken
            first = free & (~free + np.uint64(1))
            taken |= first
            hits.append(first != 0)
            places.append(of)
        k = np.bitwise_count(taken).astype("i8")
        moved = np.zeros(len(part), "i8")
        for hit, of in zip(hits, places):
            first = taken & (~taken + np.uint64(1))
            moved += hit & (of & first == 0)
            taken ^= np.where(hit, first, np.uint64(0))
        other = chars[b].T
        prefix, alike = np.zeros(len(part), "i8"), np.ones(len(part), bool)
        for i in range(4):
            alike &= (own[i] == other[i]) & (own[i] < size - 1)
            prefix += alike
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = (k / n + k / m + (k - moved // 2) / k) / 3
        out[part] = np.where(k > 0, jaro + prefix * p * (1 - jaro), 0.0)
    same = np.array([texts[i] == texts[j] for i, j in zip(left, right)], bool) if len(set(texts)) < len(texts) else left == right
    out[same] = 1.0
    return out


def _jaro(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, float | None] = {}  # equal pairs of a batch are compared once
    for pair in zip(a, b):
        if pair not in known:
            known[pair] = None if pair[0] is None or pair[1] is None else jaro_winkler_text(*pair)
    return pd.Series([known[pair] for pair in zip(a, b)], dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity; null if either text is null."""
    return F.pandas_udf(_jaro, DoubleType())(a, b)


#: Letters fall into so many classes, and so many of a class are told apart, as the bits of four numbers.
LETTER_CLASSES, LETTER_COUNT = 32, 8


def _letters(s: pd.Series) -> pd.DataFrame:
    rows = []
    for text in s:
        counts, bits = [0] * LETTER_CLASSES, 0
        for c in text or "":
            k = ord(c) % LETTER_CLASSES
            if counts[k] < LETTER_COUNT:
                bits |= 1 << (k * LETTER_COUNT + counts[k])
                counts[k] += 1
        rows.append([int.from_bytes(bits.to_bytes(32, "little")[i : i + 8], "little", signed=True) for i in range(0, 32, 8)])
    return pd.DataFrame(rows, columns=list("wxyz"), dtype="int64")


def letters(c: Column) -> Column:
    """How often a text holds each letter, as a struct of four numbers for `jaro_winkler_at_most`."""
    return F.pandas_udf(_letters, "w long, x long, y long, z long")(c)


def jaro_winkler_at_most(a: Column, b: Column, a_letters: Column, b_letters: Column, p: float = 0.1) -> Column:
    """No less than the Jaro-Winkler similarity of two texts: what it were if all letters that both hold matched in order."""
    n, m = F.length(a), F.length(b)
    apart = sum((F.bit_count(a_letters[f].bitwiseXOR(b_letters[f])) for f in "wxyz"), F.lit(0))
    shared = F.least(n, m, (n + m - apart) / 2)
    jaro = F.least(F.lit(1.0), (shared / n + shared / m + 1) / 3)
    alike = lambda k: F.substring(a, 1, k) == F.substring(b, 1, k)
    prefix = F.when(alike(4), 4).when(alike(3), 3).when(alike(2), 2).when(alike(1), 1).otherwise(0)
    return jaro + prefix * p * (1 - jaro)


def _phonetic(word: str | None) -> str | None:
    if word is None:
        return None
    w = "".join(c for c in word.upper() if "A" <= c <= "Z")
    for a, b in (("PH", "F"), ("GH", ""), ("KN", "N"), ("WR", "R"), ("SCH", "SK"), ("CK", "K"), ("TH", "0"), ("SH", "X"), ("CH", "X"), ("CE", "S"), ("CI", "S"), ("CY", "S"), ("Q", "K"), ("X", "KS"), ("Z", "S"), ("V", "F"), ("DG", "J"), ("C", "K")):
        w = w.replace(a, b)
    out = ""
    for i, c in enumerate(w):
        if (c in "AEIOUYWH" and i) or out[-1:] == c:
            continue
        out += c
    return out


def _phonetics(s: pd.Series) -> pd.Series:
    return s.map(_phonetic)


def phonetic_key(c: Column) -> Column:
    """A consonant key that names which sound alike share; null for null."""
    return F.pandas_udf(_phonetics, StringType())(c)


_VOWELS = frozenset("AEIOU")
_SILENT_START = ("KN", "GN", "PN", "AE", "WR")
_PLAIN = {"F": "F", "J": "J", "L": "L", "M": "M", "N": "N", "Q": "K", "R": "R", "V": "F", "X": "KS", "Z": "S"}


def metaphone_text(word: str | None) -> str | None:
    """The Metaphone key of a word by Philips' rules of 1990; letters other than A to Z are left out, null stays null."""
    if word is None:
        return None
    w = re.sub(r"([ABD-Z])\1+", r"\1", re.sub(r"[^A-Z]", "", word.upper()))  # doubled letters count once, but for C
    if w[:2] in _SILENT_START:
        w = w[1:]
    elif w[:1] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out = []
    for i, c in enumerate(w):
        before, after = w[i - 1] if i else "", w[i + 1 : i + 2]
        soft = after in ("E", "I", "Y") and after != ""
        if c in _VOWELS:
            key = c if i == 0 else ""
        elif c == "B":
            key = "" if before == "M" and i == len(w) - 1 else "B"
        elif c == "C":
            if soft:
                key = "" if before == "S" else "X" if w[i + 1 : i + 3] == "IA" else "S"
            else:
                key = "X" if after == "H" and before != "S" else "K"
        elif c == "D":
            key = "J" if after == "G" and w[i + 2 : i + 3] in tuple("EIY") else "T"
        elif c == "G":
            if after == "H" and w[i + 2 : i + 3] not in _VOWELS or after == "N" and w[i + 2 :] in ("", "ED") or before == "D" and soft:
                key = ""
            else:
                key = "J" if soft and before != "G" else "K"
        elif c == "H":
            key = "H" if after in _VOWELS and before not in tuple("CGPST") else ""
        elif c == "K":
            key = "" if before == "C" else "K"
        elif c == "P":
            key = "F" if after == "H" else "P"
        elif c == "S":
            key = "X" if after == "H" or w[i + 1 : i + 3] in ("IO", "IA") else "S"
        elif c == "T":
            key = "X" if w[i + 1 : i + 3] in ("IO", "IA") else "0" if after == "H" else "" if w[i + 1 : i + 3] == "CH" else "T"
        elif c in "WY":
            key = c if after in _VOWELS else ""
        else:
            key = _PLAIN[c]
        out.append(key)
    return "".join(out)


def _metaphones(s: pd.Series) -> pd.Series:
    return s.map(metaphone_text)


def metaphone(c: Column) -> Column:
    """The Metaphone key of a word; null for null. Meant for different words, which are few beside rows."""
    return F.pandas_udf(_metaphones, StringType())(c)


def substring_either(a: Column, b: Column) -> Column:
    """Whether one of two non-empty texts holds the other."""
    return F.coalesce((a != "") & (b != "") & (a.contains(b) | b.contains(a)), F.lit(False))
