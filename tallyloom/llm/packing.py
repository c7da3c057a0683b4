"""Filling containers of one capacity with items of varying size: harmonic packing with the left-over space used again.

Sizes are whole numbers, so a size s belongs to the reciprocal class k = capacity // s, whose containers hold exactly k items
of that size. A container of class k leaves capacity - k * s free; that space is offered to the smaller classes before they
open containers of their own, again with a fixed number of items a container. The plan follows from the histogram of sizes
alone, which has at most capacity + 1 rows whatever the data, and says for every size which ranks of its items go to which
run of containers. Workers then place their items independently: an item needs its size and its rank among equal sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one size that one task ranks; a size with more rows is ranked in several shares.
SHARE_ROWS = 500_000


def plan_containers(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(size, first rank, first container, items a container) of each run, by size and rank; and the number of containers."""
    runs: list[tuple[int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # space left: (first container, how many)
    spaces: list[int] = []
    opened = 0

    def offer(space: int, first: int, count: int) -> None:
        if space > 0 and count > 0:
            free.setdefault(space, []).append((first, count))

    for size in sorted((s for s in histogram if s > 0), reverse=True):
        left, rank = histogram[size], 0
        spaces = sorted(s for s in free if s >= size)
        for space in spaces:  # the tightest fit first
            a_bin = space // size
            groups = free.pop(space)
            while groups and left:
                first, count = groups.pop()
                full = min(count, left // a_bin)
                if full:
                    runs.append((size, rank, first, a_bin))
                    offer(space - a_bin * size, first, full)
                    rank, left = rank + full * a_bin, left - full * a_bin
                if full < count and left:
                    runs.append((size, rank, first + full, left))
                    offer(space - left * size, first + full, 1)
                    if count - full > 1:
                        groups.append((first + full + 1, count - full - 1))
                    rank, left = rank + left, 0
                elif full < count:
                    groups.append((first + full, count - full))
            if groups:
                free.setdefault(space, []).extend(groups)
            if not left:
                break
        if left:
            a_bin = capacity // size
            full, rest = divmod(left, a_bin)
            if full:
                runs.append((size, rank, opened, a_bin))
                offer(capacity - a_bin * size, opened, full)
                rank, opened = rank + full * a_bin, opened + full
            if rest:
                runs.append((size, rank, opened, rest))
                offer(capacity - rest * size, opened, 1)
                opened += 1
    if histogram.get(0):  # nothing to hold: spread over the containers there are
        opened = max(opened, 1)
        runs.append((0, 0, 0, -(-histogram[0] // opened)))
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3], opened


def items_of(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, part, size): items no larger than capacity; an oversized one is cut into full parts and a rest. part counts from 1."""
    parts = F.greatest(F.ceil(F.col(size) / F.lit(capacity)).cast("int"), F.lit(1))
    return sizes.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("whole"), F.explode(F.sequence(F.lit(1), parts)).alias("part")).select(
        "key", "part", F.least(F.lit(capacity).cast("bigint"), F.col("whole") - (F.col("part") - 1) * F.lit(capacity)).alias("size")
    )


def pack(sizes: DataFrame, key: str, size: str, capacity: int = 2048) -> DataFrame:
    """(key, part, size, container) of every row of sizes (key, size); a container's sizes add up to capacity at most.

    Only an item above the capacity has more than one part. Items of size 0 are spread over the containers. Null sizes count
    as 0; repeated keys are items of their own; an empty table gives no rows. sizes is read three times, so it should be a
    stored table. The result depends on keys and sizes only, not on how rows are spread.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    items = items_of(sizes.select(key, F.coalesce(F.col(size), F.lit(0)).alias(size)), key, size, capacity)
    histogram = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity + 1 rows at most
    shares = max(1, -(-max(histogram.values(), default=0) // SHARE_ROWS))
    shared = items.withColumn("share", F.pmod(F.xxhash64("key", "part"), F.lit(shares)).cast("int"))
    within = Window.partitionBy("size", "share").orderBy("key", "part")
    ranked = shared.withColumn("rank", F.row_number().over(within).cast("bigint") - 1)
    if shares > 1:  # ranks of a size follow on from share to share
        counts = shared.groupBy("size", "share").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("size").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("size", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from"))
        ranked = ranked.join(starts.hint("merge"), ["size", "share"]).withColumn("rank", F.col("rank") + F.col("from"))
    run_size, run_rank, run_first, run_each, _ = plan_containers(histogram, capacity)
    schema = T.StructType([sizes.schema[key], T.StructField("part", T.IntegerType()), T.StructField("size", T.LongType()), T.StructField("container", T.LongType())])
    top = int(max(histogram.values(), default=0)) + 1
    composite = run_size * top + run_rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, r = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            at = np.searchsorted(composite, s * top + r, side="right") - 1
            container = run_first[at] + (r - run_rank[at]) // run_each[at]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(container)], names=schema.names)

    return ranked.select(F.col("key").alias(key), "part", "size", "rank").mapInArrow(place, schema)
