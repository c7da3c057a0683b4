"""Records that are the same but for white space, letter case, punctuation or the order of parts, collapsed into one.

Text is read as the bytes of its Arrow buffer. A skip-and-fold table gives each character its folded value, or 0 to skip it;
the values run into polynomial hashes whose prefix sums give the hash of any row or part, so no canonical string is made.
Rows whose hashes collide are then compared with two pointers that skip what the table skips, all rows in step.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.skew import lookup_skewed
from tallyloom.session import cut

#: Odd bases of the two polynomial hashes modulo 2**64, and multipliers of the columns they are combined with.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Marks inside a part of a name: JR and J.R. are one part.
JOINERS = ".'`‘’ʼ"
_NULL = np.uint64(0x5851F42D4C957F2D)
_TOP = 0x20000


@functools.lru_cache(maxsize=1)
def fold_table() -> tuple[np.ndarray, np.ndarray]:
    """(folded value or 0 by code point, whether the code point parts what stands around it)."""
    fold = np.zeros(_TOP, np.uint64)
    for c in range(_TOP):
        x = chr(c)
        if x.isalnum() or unicodedata.category(x)[0] == "M":
            low = x.lower()
            fold[c] = ord(low) if len(low) == 1 else c
    parts = fold == 0
    parts[[ord(c) for c in JOINERS]] = False
    return fold, parts


@dataclass
class Folded:
    """The characters of a column, one row after another."""

    value: np.ndarray  # 0: skipped
    parts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    null: np.ndarray

    @functools.cached_property
    def next_kept(self) -> np.ndarray:
        """The first place from i on that is not skipped."""
        n = len(self.value)
        at = np.where(self.value != 0, np.arange(n), n)
        return np.concatenate([np.minimum.accumulate(at[::-1])[::-1], [n, n]])


def folded(column: pa.Array) -> Folded:
    column = column.cast(pa.string())
    null = np.asarray(column.is_null())
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1 + column.offset)[column.offset :].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if (raw < 0x80).all():
        points = raw
    else:
        points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        offsets = leads[offsets]
    fold, parts = fold_table()
    if points.dtype == np.uint8:
        value, apart, high = fold[points], parts[points], np.zeros(0, bool)
    else:
        low = np.minimum(points, _TOP - 1)
        value, apart, high = fold[low], parts[low], points >= _TOP
    if high.any():  # beyond the table: ideographs stand for themselves, the rest is skipped
        keep = high & (points < 0x40000)
        value, apart = np.where(high, np.where(keep, points, 0), value).astype(np.uint64), np.where(high, ~keep, apart)
    starts, ends = offsets[:-1], offsets[1:]
    return Folded(value, apart, starts, np.where(null, starts, ends), null)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretch_hashes(f: Folded, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The rolling hash of the kept characters in each stretch: a difference of two prefix sums, brought back to power 0."""
    kept = np.concatenate([[0], np.cumsum(f.value != 0)])
    total = int(kept[-1])
    up, down = _powers(base, total), _powers(pow(base, -1, 2**64), total)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(f.value * up[kept[:-1]], dtype=np.uint64)])
    return _mix((prefix[ends] - prefix[starts]) * down[kept[starts]] + (kept[ends] - kept[starts]).astype(np.uint64))


def part_bounds(f: Folded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of each part: a stretch of kept characters and joiners between characters that part."""
    kept = np.flatnonzero(f.value != 0)
    if not len(kept):
        none = np.zeros(0, np.int64)
        return none, none, none
    row = np.searchsorted(f.starts, kept, side="right") - 1
    apart = np.concatenate([[0], np.cumsum(f.parts)])
    opens = np.concatenate([[True], (np.diff(row) > 0) | (apart[kept[1:]] > apart[kept[:-1]])])
    first = np.flatnonzero(opens)
    last = np.concatenate([first[1:] - 1, [len(kept) - 1]])
    return row[first], kept[first], kept[last] + 1


def column_hash(f: Folded, base: int, reorder: bool) -> np.ndarray:
    if reorder:
        row, starts, ends = part_bounds(f)
        out = np.zeros(len(f.starts), np.uint64)
        np.add.at(out, row, stretch_hashes(f, starts, ends, base))
        out = _mix(out)
    else:
        out = stretch_hashes(f, f.starts, f.ends, base)
    return np.where(f.null, _NULL, out)


def same_stretches(a: Folded, a_starts: np.ndarray, a_ends: np.ndarray, b: Folded, b_starts: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Whether each stretch of a equals its stretch of b: two pointers that skip, moved for all stretches in step."""
    same = np.zeros(len(a_starts), bool)
    live = np.arange(len(a_starts))
    i, j = a.next_kept[a_starts], b.next_kept[b_starts]
    while len(live):
        a_over, b_over = i >= a_ends[live], j >= b_ends[live]
        same[live[a_over & b_over]] = True
        go = ~(a_over | b_over)
        live, i, j = live[go], i[go], j[go]
        go = a.value[i] == b.value[j]
        live, i, j = live[go], a.next_kept[i[go] + 1], b.next_kept[j[go] + 1]
    return same


def same_rows(left: pa.Array, right: pa.Array, reorder: bool) -> np.ndarray:
    """Whether each text of left equals that of right but for what the table skips and folds, and the order of parts."""
    a, b = folded(left), folded(right)
    same = same_stretches(a, a.starts, a.ends, b, b.starts, b.ends) & (a.null == b.null)
    if not reorder or same.all():
        return same
    (ra, sa, ea), (rb, sb, eb) = part_bounds(a), part_bounds(b)
    counts = [np.bincount(r, minlength=len(same)) for r in (ra, rb)]
    open_rows = ~same & (counts[0] == counts[1]) & (a.null == b.null)
    both = []
    for f, r, s, e in ((a, ra, sa, ea), (b, rb, sb, eb)):
        of = open_rows[r]
        r, s, e = r[of], s[of], e[of]
        order = np.lexsort((s, stretch_hashes(f, s, e, BASES[1]), r))  # equal parts of a row stand at equal places
        both.append((r[order], s[order], e[order]))
    alike = same_stretches(a, both[0][1], both[0][2], b, both[1][1], both[1][2])
    wrong = np.bincount(both[0][0][~alike], minlength=len(same)) > 0
    return same | open_rows & ~wrong


def _exact(df: DataFrame, columns: list[str], prefix: str = "") -> list[Column]:
    """The columns as they are compared; 0.0 and -0.0 are one number."""
    out = []
    for c in columns:
        number = isinstance(df.schema[c].dataType, T.FloatType | T.DoubleType)
        out.append((F.col(c) + F.lit(0.0) if number else F.col(c)).alias(prefix + c))
    return out


def fold_hashes(df: DataFrame, key: str, exact: list[str], text: list[str], reorder: list[str]) -> DataFrame:
    """(key, h1, h2): two 64-bit hashes of each row over its exact and folded columns."""
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])
    same = _exact(df, exact)
    nulls = F.concat_ws("", *[c.isNull().cast("string") for c in same]) if same else F.lit("")
    columns = reorder + text

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(1 + i).to_numpy(zero_copy_only=False).view(np.uint64).copy() for i in range(2)]
            for n, name in enumerate(columns):
                f = folded(batch.column(3 + n))
                for i, base in enumerate(BASES):
                    h[i] = _mix(h[i] * np.uint64(base) + column_hash(f, base, name in reorder))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x.view(np.int64)) for x in h)], names=schema.names)

    seeds = [F.xxhash64(F.lit(i), nulls, *same).alias(f"e{i}") for i in range(2)]
    return df.select(F.col(key).alias("key"), *seeds, *[F.col(c).cast("string") for c in columns]).mapInArrow(hashes, schema)


def _verified(pairs: DataFrame, exact: list[str], text: list[str], reorder: list[str]) -> DataFrame:
    """pairs (first, key, a_*, b_*) as (first, key, same)."""
    kind = pairs.schema["key"].dataType
    schema = T.StructType([T.StructField("first", kind), T.StructField("key", kind), T.StructField("same", T.BooleanType())])
    columns = reorder + text
    equal = F.lit(True)
    for c in exact:
        equal = equal & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for n, c in enumerate(columns):
                same = same & same_rows(batch.column(3 + 2 * n), batch.column(4 + 2 * n), c in reorder)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same)], names=schema.names)

    texts = [F.col(f"{side}_{c}").cast("string").alias(f"{side}_{c}") for c in columns for side in "ab"]
    return pairs.select("first", "key", equal.alias("equal"), *texts).mapInArrow(compare, schema)


def folded_copies(df: DataFrame, key: str, exact: list[str], text: list[str], reorder: list[str]) -> DataFrame:
    """(first, key): each row that is a copy of another, with the smallest key of its class.

    Two rows are copies if the exact columns are equal (null equals null), the text columns are equal but for white space,
    letter case and punctuation, and the reorder columns also but for the order of their parts. A null text equals a null
    text only; texts of nothing but punctuation equal the empty one. key must be unique; rows without copies, and an empty
    df, give nothing. Columns of df that are not named are not read.

    Only hashes and keys meet in the first shuffle, counted before they are sent. A class that holds more than a thousandth
    of all rows is broadcast as one row instead of being gathered. Texts are fetched for members of classes only. A row that
    shares its hashes but fails the comparison is compared again, by canonical text, among such rows of its class.
    """
    hashed = cut(fold_hashes(df, key, exact, text, reorder), "fold")
    total = hashed.count()
    classes = hashed.groupBy("h1", "h2").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = lookup_skewed(hashed, classes, ["h1", "h2"], "n", total).select("key", "first", "n")
    columns = exact + reorder + text
    rows = df.select(F.col(key).alias("key"), *_exact(df, exact), *[F.col(c) for c in reorder + text])
    full = cut(members.hint("shuffle_hash").join(rows, "key"), "copies")
    firsts = full.filter("key = first").select("first", "n", *[F.col(c).alias(f"a_{c}") for c in columns])
    others = full.filter("key <> first").select("key", "first", *[F.col(c).alias(f"b_{c}") for c in columns])
    checked = cut(_verified(lookup_skewed(others, firsts, ["first"], "n", total), exact, text, reorder), "same")
    good = checked.filter("same").select("first", "key")
    failed = checked.filter("NOT same").select("key")
    if not failed.head(1):
        return good
    # different records with the same 128 bits of hash: told apart by canonical text
    again = df.join(failed.select(F.col("key").alias(key)), key, "left_semi").select(
        F.col(key).alias("key"), *_exact(df, exact), *[_canonical(c, False).alias(c) for c in text], *[_canonical(c, True).alias(c) for c in reorder]
    )
    more = again.groupBy(*columns).agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return good.unionByName(again.alias("l").join(more.alias("r"), same).select("r.first", "l.key").filter("key <> first"))


def _canonical(column: str, reorder: bool) -> Column:
    low = F.lower(F.col(column).cast("string"))
    if not reorder:
        return F.regexp_replace(low, r"[^\p{L}\p{N}\p{M}]+", "")
    joined = F.regexp_replace(low, f"[{JOINERS}]", "")
    return F.concat_ws(" ", F.array_sort(F.filter(F.split(joined, r"[^\p{L}\p{N}\p{M}]+"), lambda x: x != "")))


def collapsed(df: DataFrame, key: str, copies: DataFrame) -> DataFrame:
    """(first, n_copies): one row for each record of df, with the number of rows it was found in."""
    counts = copies.groupBy("first").agg((F.count(F.lit(1)) + 1).alias("n_copies"))
    keys = df.select(F.col(key).alias("first")).join(copies.select(F.col("key").alias("first")), "first", "left_anti")
    return keys.join(counts, "first", "left").select("first", F.coalesce("n_copies", F.lit(1).cast("bigint")).alias("n_copies"))
