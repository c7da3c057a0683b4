"""Cutting long texts into overlapping pieces at natural boundaries: balanced targets snapped to the strongest boundary near.

A text of T tokens needs at least n = ceil((T - overlap) / (limit - overlap)) pieces. The n - 1 cuts are placed so that all
pieces are equally long; each is moved to the strongest boundary (paragraph, line, sentence, word) within its slack, to the
nearest of equally strong ones, as long as the pieces to come can still stay within the limit, and what is left is divided
equally again. If a cut finds no word end, one more piece is allowed; if that does not help either, as in an unbroken run, it
falls on a joint of words or a token boundary that parts no character, and the rest of the text is balanced as before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.tokens import SPACE, encode_batch, gather, sent_replay, ship_vocabulary, vocabulary_file, words_of

PARAGRAPH, LINE, SENTENCE, WORD, JOINT = 5, 4, 3, 2, 1
_BLANK = re.compile(f"[{SPACE}]+")
_STARTS_BLANK = re.compile(f"[{SPACE}]")
_SENTENCE_END = re.compile(r"""[.!?…]["'”’)\]]*$""")
_WIDE_END = re.compile(r"""[。！？]["'”’」』)\]]*$""")


def word_marks(words: list[str]) -> np.ndarray:
    """Of each word: line ends, is blank, starts blank, ends a sentence, ends one without a following blank."""
    return np.array(
        [(w.count("\n"), bool(_BLANK.fullmatch(w)), bool(_STARTS_BLANK.match(w)), bool(_SENTENCE_END.search(w)), bool(_WIDE_END.search(w))) for w in words], np.int32
    ).reshape(-1, 5)


def boundary_strengths(marks: np.ndarray) -> np.ndarray:
    """The strength of the boundary before each word of one text; 0 before the first."""
    n = len(marks)
    lines, blank, starts, ends, wide = (marks[:, i] for i in range(5))
    strength = np.full(n, JOINT, np.int8)
    prev_blank = np.concatenate([[0], blank[:-1]]).astype(bool)
    strength[(starts > 0) | prev_blank] = WORD
    at = np.arange(n)
    last_solid = np.maximum.accumulate(np.where(blank > 0, -1, at))  # the word before, blanks passed over
    before = np.concatenate([[-1], last_solid[:-1]])
    has = before >= 0
    strength[has & (ends[before] > 0) & (strength == WORD)] = SENTENCE
    strength[has & (wide[before] > 0) & (before == at - 1)] = SENTENCE
    strength[has & (wide[before] > 0) & (strength == WORD)] = SENTENCE
    upto = np.concatenate([[0], np.cumsum(lines)])
    breaks = upto[at] - upto[before + 1]  # line ends in the run of blanks just before
    solid = blank == 0
    strength[solid & (breaks == 1)] = LINE
    strength[solid & (breaks >= 2)] = PARAGRAPH
    if n:
        strength[0] = 0
    return strength


def nearest(sorted_: np.ndarray, low: float, high: float, target: float) -> int | None:
    """The number of sorted_ in low..high that is nearest to target, the smaller one on a tie; None if there is none."""
    a, b = np.searchsorted(sorted_, low, "left"), np.searchsorted(sorted_, high, "right")
    if b <= a:
        return None
    k = int(np.searchsorted(sorted_[a:b], target)) + a
    if k == b or k > a and target - sorted_[k - 1] <= sorted_[k] - target:
        k -= 1
    return int(sorted_[k])


def choose_cuts(total: int, at: np.ndarray, strength: np.ndarray, limit: int, overlap: int, safe: np.ndarray | None = None) -> list[int]:
    """Token positions of the cuts of a text of `total` tokens; `at` are the word ends and joints, safe those that part no character.

    What is left is always divided into equal parts, so an unbroken run or an added piece upsets only its own cuts. Each cut is
    one search in a sorted list of boundaries of each strength, whatever the length of the text.
    """
    most = limit - overlap
    levels = [at[strength >= s] for s in (PARAGRAPH, LINE, SENTENCE, WORD)]
    cuts: list[int] = []
    prev = overlap  # the first piece repeats nothing, so it may hold that much more
    left = -(-(total - prev) // most)
    while total - prev > most:
        left = max(left, -(-(total - prev) // most))
        step = (total - prev) / left
        target, slack = prev + step, max(int(step / 3), 1)
        high = min(prev + most, total - 1)
        lowest = min(prev + overlap + 1 if cuts else overlap + 1, high)
        keep = max(lowest, total - (left - 1) * most)  # before it, the rest needs one more piece
        spans = ((levels, max(keep, target - slack), min(high, target + slack)), (levels, keep, high), (levels, lowest, keep - 1), ([at], keep, high), ([] if safe is None else [safe], keep, high))
        cut = next((c for lists, low, top in spans for sorted_ in lists if (c := nearest(sorted_, low, top, target)) is not None), None)
        prev = cut if cut is not None else min(high, max(keep, round(target)))
        cuts.append(prev)
        left -= 1
    return cuts


def split_texts(df: DataFrame, key: str, text: str, limit: int = 512, overlap: int = 32, path: str | None = None) -> DataFrame:
    """(key, piece, n_pieces, start_token, end_token, n_tokens, n_repeated, boundary, text): the pieces of each text, in order.

    piece counts from 1. A piece holds the tokens start_token to end_token - 1 of the text, at most `limit`; all but the first
    repeat the last n_repeated = overlap tokens of the piece before. boundary tells what the piece ends at: end, paragraph,
    line, sentence, word, joint or token. text is the piece's text; where a repeated token starts inside a character, text
    starts at the next whole one. A text within the limit is one piece; null and empty texts give none. Every row of df is cut
    by itself, where it lies; columns that are not named are not read.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    name = ship_vocabulary(df.sparkSession, path or vocabulary_file())
    schema = T.StructType(
        [
            df.schema[key],
            *(T.StructField(n, T.IntegerType()) for n in ("piece", "n_pieces", "start_token", "end_token", "n_tokens", "n_repeated")),
            T.StructField("boundary", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    names = {PARAGRAPH: "paragraph", LINE: "line", SENTENCE: "sentence", WORD: "word", JOINT: "joint"}

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent_replay(name)
        for batch in batches:
            e = encode_batch(batch.column(1), model)
            sizes = (model.starts[e.code + 1] - model.starts[e.code])[e.word]
            upto = np.concatenate([[0], np.cumsum(sizes)])
            marks = word_marks(e.words)
            texts, rows, out = batch.column(2), [], [[] for _ in range(8)]
            for row in range(len(batch)):
                a, b = e.row_words[row], e.row_words[row + 1]
                total = int(upto[b] - upto[a])
                if not total:
                    continue
                whole = texts[row].as_py()
                if total <= limit:
                    pieces = [(0, total, "end", whole)]
                else:
                    at = upto[a:b] - upto[a]
                    strength = boundary_strengths(marks[e.word[a:b]])
                    ids, _ = gather(model.flat, model.starts, e.code[e.word[a:b]])
                    token_ends = np.concatenate([[0], np.cumsum(model.token_sizes[ids])])
                    raw = whole.encode("utf-8", "surrogatepass")
                    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
                    safe = np.append(lead, True)[token_ends]
                    cuts = choose_cuts(total, at, strength, limit, overlap, np.flatnonzero(safe))
                    pieces = []
                    for i, (start, end) in enumerate(zip([0, *cuts], [*cuts, total])):
                        start = start - overlap if i else 0
                        where = np.searchsorted(at, end)
                        kind = "end" if end == total else names[int(strength[where])] if where < len(at) and at[where] == end else "token"
                        piece = raw[token_ends[start] : token_ends[end]]
                        skip = 0
                        while skip < len(piece) and piece[skip] & 0xC0 == 0x80:
                            skip += 1
                        pieces.append((start, end, kind, piece[skip:].decode("utf-8", "ignore")))
                for i, (start, end, kind, piece) in enumerate(pieces):
                    rows.append(row)
                    for column, value in zip(out, (i + 1, len(pieces), start, end, end - start, overlap if i else 0, kind, piece)):
                        column.append(value)
            kinds = [pa.int32()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *(pa.array(c, k) for c, k in zip(out, kinds))], names=schema.names)

    return df.select(F.col(key), words_of(F.col(text)).alias("__words"), F.col(text)).mapInArrow(split, schema)
