"""Several values in one text field: a parsing expression grammar with ordered alternatives.

    field   <- ws (list / items) ws
    list    <- '[' ws (item (ws delim* ws item)*)? ws ']'
    items   <- (delim / ws / bullet / item)*
    item    <- quoted / bracketed / bare
    quoted  <- q (escape / qq / !close char)* close         with q a single or double quote, qq the doubled quote
    close   <- q &(ws (delim / ']' / end / value start))
    bare    <- start (!stop char)*
    stop    <- space / delim+ (ws delim+)* (ws (start / q) / ws end)

The first alternative that matches is taken; if a quoted value finds no closing quote, the parser goes back to where the
quote stood, flags the error and reads on as a bare value. What was found on the way is remembered, so the work grows with the
text's length however its quotes and brackets are broken.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that stand for "no value", compared in lower case.
PLACEHOLDERS = frozenset({"", "-", "[]", "did not find", "n/a", "na", "nan", "nil", "none", "not found", "null", "unknown"})

_START = r"(?:https?://|www\.)"
_BARE_START = re.compile(_START, re.I)
_SKIP = re.compile(r"[\s,;|\ufeff]+")
_BULLET = re.compile(r"(?:[•*\-–·▪]+|\(?\d{1,4}[.)])(?=\s|https?://|www\.|[\"'])", re.I)
_STOP = re.compile(r"\s|(?<![,;|])[,;|](?>[\s,;|]*)(?=" + _START + r"|[\"'\[\]]|$)", re.I)
_CLOSE = re.compile(r"\s*(?:$|[,;|\]>)]|" + _START + r"|[\"'])", re.I)
_AFTER = re.compile(r"\s*(?:$|[,;|\]>)])")
_PAIRS = {"[": "]", "(": ")", "<": ">", "{": "}", "“": "”", "‘": "’", "«": "»"}
_JSON_ESCAPE = re.compile(r'\\(?:u([0-9a-fA-F]{4})|(.))', re.S)
_SPECIAL = {q: re.compile(rf"[\\{q}]") for q in "\"'"}
_SIMPLE = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(body: str) -> str:
    if "\\" not in body:
        return body
    if '"' not in body.replace('\\"', ""):
        try:
            return json.loads(f'"{body}"', strict=False)
        except ValueError:
            pass
    return _JSON_ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else _SIMPLE.get(m[2], m[2]), body)


class _Parser:
    """What was found out about one text, so that going back does not read it again: every place is looked at once."""

    def __init__(self, text: str):
        self.text = text
        self.closed: dict[tuple[str, int], int] = {}
        self.brackets: dict[str, int] = {}

    def quoted(self, i: int) -> tuple[str, int] | None:
        """The value of the quoted text that opens at i and the place after it, or None if no quote closes it."""
        s, q = self.text, self.text[i]
        special = _SPECIAL[q]
        j, passed, end = i + 1, [], -1
        while m := special.search(s, j):
            j = m.start()
            if j > i + 1 and (q, j) in self.closed:
                end = self.closed[q, j]
                break
            if s[j] == "\\":
                passed.append(j)
                j += 2
            elif s.startswith(q, j + 1) and not (j == i + 1 and _AFTER.match(s, j + 2)) and not _BARE_START.match(s, j + 2):
                passed.append(j)
                j += 2
            elif _CLOSE.match(s, j + 1):
                end = j
                break
            else:
                passed.append(j)
                j += 1
        for p in passed:
            if p > i + 1:  # the first place alone may be read as an empty value
                self.closed[q, p] = end
        if end < 0:
            return None
        return _unescape(s[i + 1 : end].replace(q + q, q)), end + 1

    def closing(self, bracket: str, i: int) -> int:
        """The place of the next closing bracket from i on, or -1."""
        at = self.brackets.get(bracket, 0)
        if 0 <= at < i or bracket not in self.brackets:
            at = self.brackets[bracket] = self.text.find(bracket, i)
        return at


def parse_packed(text: str | None) -> list[tuple[int, str, str, str | None]]:
    """(pos, value, form, error) of each value; pos counts from 1, form is quoted, bracketed or bare.

    Null, blank and placeholder texts give no values. An error is named where the grammar had to go back: 'unclosed quote',
    'unclosed bracket', or 'not a value' for text that starts no value and is skipped up to the next delimiter.
    """
    out: list[tuple[int, str, str, str | None]] = []
    if text is None or text.strip().lower() in PLACEHOLDERS:
        return out
    i, n, error = 0, len(text), None
    parser = _Parser(text)

    def emit(value: str, form: str) -> None:
        nonlocal error
        value = value.strip()
        if value.lower() not in PLACEHOLDERS:
            out.append((len(out) + 1, value, form, error))
        error = None

    while i < n:
        if m := _SKIP.match(text, i):
            i = m.end()
            continue
        c = text[i]
        if c in "\"'":
            if hit := parser.quoted(i):
                emit(hit[0], "quoted")
                i = hit[1]
                continue
            error, i = "unclosed quote", i + 1
            continue
        if c == "[":
            i += 1  # the list's own bracket; its items follow
            continue
        if c == "]":
            i += 1
            continue
        if c in _PAIRS:
            close = parser.closing(_PAIRS[c], i + 1)
            if close > 0 and _CLOSE.match(text, close + 1) and (_BARE_START.match(text, i + 1) or c in "“‘«<"):
                emit(text[i + 1 : close], "bracketed")
                i = close + 1
            else:
                if _BARE_START.match(text, i + 1):
                    error = "unclosed bracket"
                i += 1
            continue
        if _BARE_START.match(text, i):
            stop = _STOP.search(text, i)
            end = stop.start() if stop else n
            value = text[i:end]
            while value and value[-1] in "\"'" or value.endswith("]") and value.count("[") < value.count("]"):
                value = value[:-1]
            emit(value.rstrip(",;|"), "bare")
            i = end
            continue
        if m := _BULLET.match(text, i):
            i = m.end()
            continue
        stop = _STOP.search(text, i)
        end = max(stop.start() if stop else n, i + 1)
        error = error or "not a value"
        i = end
    return out


def split_packed(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, pos, value, form, error): one row for each value packed in column, with its position from 1.

    Rows whose text is null, blank, a placeholder or holds no value give no rows; repeated values keep their positions; a
    repeated key gives the values of each of its rows. Only the two named columns are read, so further columns may have any
    names. Each row is parsed where it lies: nothing is shuffled, and the text's length is bounded by its row alone.
    """
    key_type = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("pos", T.IntegerType()),
            T.StructField("value", T.StringType()),
            T.StructField("form", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse_packed(x) for x in batch.column(1).to_pylist()]
            take = pa.array([i for i, items in enumerate(found) for _ in items], pa.int32())
            pos, value, form, error = zip(*(item for items in found for item in items)) if len(take) else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(pos, pa.int32()), pa.array(value, pa.string()), pa.array(form, pa.string()), pa.array(error, pa.string())],
                names=schema.names,
            )

    return df.filter(F.col(column).isNotNull()).select(F.col(key), F.col(column)).mapInArrow(parse, schema)
