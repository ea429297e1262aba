"""Containers of fixed capacity, filled with as little free space as possible.

Packing needs only the multiset of sizes, which has at most ``capacity`` different values however many items
there are. The driver fills one container after another by minimum bin slack: a bitset subset-sum over the
sizes that are left finds the fill closest to the capacity, backtracking gives the count of each size, and
the same fill is repeated for as long as its sizes last. So the plan has about as many distinct fills as
there are sizes. Executors then give the i-th item of each size its place in the plan.

Defined results: an item larger than the capacity is cut into full pieces and a rest, no other item is cut;
an item of size 0 (null or empty text) goes into container 0; sizes are never dropped. The order of equal
sizes is that of the stored rows; every row gets its place once, repeated keys included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lodegraph.plans.session import cut

CAPACITY = 8192


def best_fill(sizes: list[int], left: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts by size of the fill closest to the capacity; sizes run from large to small, the largest is in."""
    first = sizes[0]
    room = capacity - first
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for i, s in enumerate(sizes):
        n = left[s] - (1 if i == 0 else 0)
        if s > room or n <= 0:
            continue
        # counts by doubling: 1, 2, 4, ... copies and a rest reach every count up to n
        n = min(n, room // s)
        k = 1
        while n > 0:
            k = min(k, n)
            steps.append((s, k, reach))
            reach |= (reach << (s * k)) & full
            n -= k
            k *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    fill = {first: 1}
    for s, k, before in reversed(steps):
        if not before >> total & 1:
            total -= s * k
            fill[s] = fill.get(s, 0) + k
    return fill


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, counts by size) until nothing is left; sizes are 1 to capacity."""
    left = {s: n for s, n in histogram.items() if n > 0}
    if left and not (1 <= min(left) and max(left) <= capacity):
        raise ValueError("sizes are between 1 and the capacity")
    out = []
    sizes = sorted(left, reverse=True)
    while sizes:
        fill = best_fill(sizes, left, capacity)
        times = min(left[s] // k for s, k in fill.items())
        for s, k in fill.items():
            left[s] -= k * times
        out.append((times, fill))
        sizes = [s for s in sizes if left[s]]
    return out


def runs_of(fills: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """size -> rows (first rank, first container, items of the size in each container), by rank."""
    ranks: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int]]] = {}
    container = 0
    for times, fill in fills:
        for s, k in fill.items():
            r = ranks.get(s, 0)
            runs.setdefault(s, []).append((r, container, k))
            ranks[s] = r + k * times
        container += times
    return {s: np.array(x, np.int64) for s, x in runs.items()}


def pack(items: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """(key, piece_no, size, container): a row for each item, or for each piece of an item that is too large."""
    kind = dict(items.dtypes)[key]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cut large items; count up each size within the task."""
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            which, piece, sizes, rank = [], [], [], []
            for i, n in enumerate(b.column(1).to_pylist()):
                n = n or 0
                for p in range(max(1, -(-n // capacity))):
                    s = min(capacity, n - p * capacity)
                    which.append(i)
                    piece.append(p + 1)
                    sizes.append(s)
                    rank.append(seen.get(s, 0))
                    seen[s] = seen.get(s, 0) + 1
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(which, pa.int32())), pa.array(piece, pa.int32()), pa.array(sizes, pa.int32()), pa.array([part] * len(which), pa.int32()), pa.array(rank, pa.int64())], [key, "piece_no", "size", "part", "rank"])

    placed = cut(items.select(key, F.col(size).cast("long").alias("n")).mapInArrow(number, f"`{key}` {kind}, piece_no int, size int, part int, rank bigint"))
    by_part = cut(placed.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")))
    # at most `capacity` sizes, so this is bounded
    histogram = {r.size: r.n for r in by_part.filter("size > 0").groupBy("size").agg(F.sum("n").alias("n")).collect()}
    runs = runs_of(plan(histogram, capacity))
    before = by_part.withColumn("base", F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("size", "part", F.coalesce("base", F.lit(0)).alias("base"))
    ranked = placed.join(before, ["size", "part"])
    shared = items.sparkSession.sparkContext.broadcast(runs)  # one row a size and fill, bounded by the distinct sizes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            sizes, rank = b.column(2).to_numpy(), b.column(3).to_numpy() + b.column(4).to_numpy()
            out = np.zeros(len(sizes), np.int64)
            for s in np.unique(sizes):
                if s:
                    at = np.nonzero(sizes == s)[0]
                    t = table[int(s)]
                    i = np.searchsorted(t[:, 0], rank[at], "right") - 1
                    out[at] = t[i, 1] + (rank[at] - t[i, 0]) // t[i, 2]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out)], [key, "piece_no", "size", "container"])

    return ranked.select(key, "piece_no", "size", "rank", "base").mapInArrow(place, f"`{key}` {kind}, piece_no int, size int, container bigint")
