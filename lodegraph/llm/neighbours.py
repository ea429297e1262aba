"""Most similar vectors for every vector: navigable small-world graphs by shard, results merged.

A coarse partition of the space (spherical k-means on a bounded sample) gives each vector the cell it is
indexed in and the next cells it is searched in. A cell is a shard; a cell of more than ``MAX_SHARD`` vectors
is several shards by hash of the vector, all of which are searched. Each shard builds one graph, answers its
own vectors while they are inserted, then those that come from other cells.

Equal vectors under several ids are indexed once. For pairs (``similar``) a task keeps the first id of a vector
and links the others to it (a star, not all pairs of the group), before anything is shuffled. For the best of each
asked id (``nearest``) a vector goes by its digest: it is asked if any of its ids is, searched once, and what it
finds is given to all its asked ids, with the ids of the vectors found in place of the vectors.

Defined results: vectors that are null, of another length, zero or with a null, NaN or infinite element take
no part; rows of one id and vector are one; an id may have several different vectors; an id is never its own
neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lodegraph.llm.hnsw import Graph, centroids
from lodegraph.plans.session import cut, spread

DIM = 64
#: Vectors a cell should have; cells of a table at most. The partition is fitted on about SAMPLE vectors of a table,
#: or PER_CELL a cell where that is more: never more than twice PER_CELL * MAX_CELLS (65,536) rows.
CELL, MAX_CELLS, SAMPLE, PER_CELL = 2_000, 4_096, 8_192, 8
#: Vectors a shard may have.
MAX_SHARD = 16_384
#: Cells each vector is searched in, its own included, where pairs from a floor on are sought.
PROBES = 5
M, EF = 10, 24
#: Where the k best are sought, so many cells are searched that they hold SHARE of the k nearest of PROBE_ROWS rows
#: of the sample within the sample. Those are further away than the nearest of all rows, so the number errs upwards.
SHARE, PROBE_ROWS = 0.98, 512


def unit_vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, unit vectors) of the usable elements of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False))
    rows = np.nonzero(size == dim)[0]
    if not len(rows):
        return rows, np.empty((0, dim), "f4")
    values = column.take(pa.array(rows)).flatten().cast(pa.float32())
    x = values.to_numpy(zero_copy_only=False).reshape(-1, dim).astype("f4")  # null elements become NaN
    with np.errstate(all="ignore"):
        norm = np.sqrt((x.astype("f8") ** 2).sum(1))
        ok = np.isfinite(norm) & (norm > 0)
        return rows[ok], (x[ok] / norm[ok, None]).astype("f4")


def fit_cells(vectors: DataFrame, dim: int = DIM, cell: int = CELL, k: int = 1) -> dict[str, tuple[np.ndarray, int]]:
    """table_name -> (centroids, cells to search for the k best). The sample is bounded; the counts are over all rows."""
    out = {}
    # one row a table of the collection
    counts = {r.table_name: r.n for r in vectors.groupBy("table_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    for name, n in counts.items():
        want = max(SAMPLE, PER_CELL * min(MAX_CELLS, -(-n // cell)))
        every = max(1, n // want)
        part = vectors.filter((F.col("table_name") == name) & (F.pmod(F.xxhash64("id"), F.lit(every)) == 0)).select("embedding").limit(2 * want)
        x = unit_vectors(part.toArrow().column(0), dim)[1]
        x = np.unique(x, axis=0)
        cells = int(min(MAX_CELLS, max(1, -(-n // cell)), max(1, len(x) // PER_CELL)))
        c = centroids(x, cells) if len(x) else np.zeros((1, dim), "f4")
        out[name] = c, needed_probes(x, c, k)
    return out


def needed_probes(x: np.ndarray, cells: np.ndarray, k: int) -> int:
    """Cells, best first, in which SHARE of the k nearest of PROBE_ROWS rows of a sample lie."""
    if len(cells) <= 1 or len(x) <= k:
        return len(cells)
    at = np.unique(np.linspace(0, len(x) - 1, PROBE_ROWS).astype(int))
    s = x[at] @ x.T
    s[np.arange(len(at)), at] = -2
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    own = np.concatenate([(x[i : i + 4096] @ cells.T).argmax(1) for i in range(0, len(x), 4096)])
    ranks = np.argsort(np.argsort(-(x[at] @ cells.T), axis=1, kind="stable"), axis=1)
    found = np.sort(np.take_along_axis(ranks, own[near], axis=1).ravel())
    return int(found[min(len(found) - 1, int(np.ceil(SHARE * len(found))) - 1)]) + 1


def similar(vectors: DataFrame, k: int, floor: float, probes: int | None = PROBES, queries: DataFrame | None = None, m: int = M, ef: int = EF, search_ef: int | None = None, dim: int = DIM, cell: int = CELL) -> DataFrame:
    """(table_name, id_a, id_b, cosine), id_a < id_b: of each vector its k best and all of cosine >= floor.

    ``vectors`` has (table_name, id, embedding). With ``queries`` (table_name, id) only those rows are searched
    for, against all; ``probes`` None searches the measured number of cells. ``ef`` is the beam while graphs are
    built, ``search_ef`` (the same unless given) that of searches in built graphs.
    """
    placed = _placed(vectors, probes, queries, dim, cell, False, max(k, 1))
    met = _met(placed, k, floor, m, ef, search_ef, dim)
    links = placed.filter("link is not null and link <> id").select("table_name", F.least("id", "link").alias("id_a"), F.greatest("id", "link").alias("id_b"), F.lit(1.0).alias("cosine"))
    return met.unionByName(links).groupBy("table_name", "id_a", "id_b").agg(F.max("cosine").alias("cosine"))


def nearest(vectors: DataFrame, k: int, queries: DataFrame, probes: int | None = PROBES, m: int = M, ef: int = EF, search_ef: int | None = None, dim: int = DIM, cell: int = CELL) -> DataFrame:
    """(table_name, id, rank, other, cosine): the k best others of each asked id, ties by id.

    ``queries`` is (table_name, id); ``probes`` None searches the measured number of cells. All ids of one vector
    are neighbours of cosine 1.
    """
    placed = _placed(vectors, probes, queries, dim, cell, True, k)
    # link is the vector's digest; each pair of a vector and an id once
    members = cut(placed.groupBy("table_name", F.col("link").alias("vector"), "id").agg(F.max("ask").alias("ask")))
    # one row; 1 unless an id has several vectors
    each = members.groupBy("table_name", "id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 1
    # so many entries hold k other ids, though an id be met once for each of its vectors
    want = (k + 1) * each
    one = placed.filter("v is not null").withColumn("id", F.col("link"))
    pairs = _met(one, want, 2.0, m, ef, max(search_ef or ef, want), dim, ["table_name", "id"])
    asked = members.filter("ask").select("table_name", "vector", "id")
    # not a union of both directions, which would build the graphs twice
    ways = F.array(*[F.struct(F.col(a).alias("vector"), F.col(b).alias("found")) for a, b in (("id_a", "id_b"), ("id_b", "id_a"))])
    both = pairs.select("table_name", F.explode(ways).alias("way"), "cosine").select("table_name", "way.*", "cosine")
    keys = asked.select("table_name", "vector").distinct()
    # a pair is met from both sides if both are asked
    both = both.join(keys, ["table_name", "vector"], "left_semi").groupBy("table_name", "vector", "found").agg(F.max("cosine").alias("cosine")).unionByName(keys.withColumns({"found": F.col("vector"), "cosine": F.lit(1.0)}))
    # of ids of one vector only the first can be among the k best; the asked id itself may be one of them
    w = Window.partitionBy("table_name", "vector").orderBy("id")
    heads = members.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1).select("table_name", F.col("vector").alias("found"), "id")
    best = F.array_sort(F.collect_list(F.struct((-F.least("cosine", F.lit(1.0))).alias("far"), "id")))
    lists = both.join(heads, ["table_name", "found"]).groupBy("table_name", "vector").agg(F.slice(best, 1, want).alias("best"))
    got = asked.join(lists, ["table_name", "vector"]).select("table_name", "id", F.explode("best").alias("b")).filter("b.id <> id")
    got = got.groupBy("table_name", "id", F.col("b.id").alias("other")).agg((-F.min("b.far")).alias("cosine"))
    w = Window.partitionBy("table_name", "id").orderBy(F.desc("cosine"), "other")
    return got.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("table_name", "id", "rank", "other", "cosine")


def _placed(vectors: DataFrame, probes: int | None, queries: DataFrame | None, dim: int, cell: int, digests: bool, k: int) -> DataFrame:
    """(table_name, id, link, ask, v, cells): of the copies of a vector one a task has v and cells.

    ``link`` of the others is that one's id. With ``digests`` it is the digest of the vector in every row, and v
    and cells come again with the first asked copy of a task if the one before was not asked.
    """
    vectors = vectors.select("table_name", F.col("id").cast("string").alias("id"), "embedding").filter("id is not null and embedding is not null")
    cells = fit_cells(vectors, dim, cell, k)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(cells)  # at most MAX_CELLS x dim floats a table
    if queries is not None:
        vectors = vectors.join(queries.select("table_name", F.col("id").cast("string").alias("id"), F.lit(True).alias("ask")).distinct(), ["table_name", "id"], "left")
    else:
        vectors = vectors.withColumn("ask", F.lit(True))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a vector with its cells, best first; further ids of a vector of this task become links."""
        first: dict[tuple[str, bytes], str] = {}
        asked: set[tuple[str, str]] = set()
        for b in batches:
            names, ids, ask = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()
            rows, x = unit_vectors(b.column(2), dim)
            got = {c: [] for c in ("table_name", "id", "link", "ask", "v", "cells")}
            near = np.empty((len(rows), 0), int)
            owner = np.array([names[r] for r in rows], dtype=object)
            best: dict[int, np.ndarray] = {}
            for name in set(owner):
                at = np.nonzero(owner == name)[0]
                centre, needed = shared.value[name]
                s = x[at] @ centre.T
                p = min(needed if probes is None else probes, s.shape[1])
                top = np.argpartition(-s, p - 1, axis=1)[:, :p] if p < s.shape[1] else np.broadcast_to(np.arange(p), s.shape)
                near = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), 1, kind="stable"), 1)
                best.update(zip(at, near.astype("i4")))
            for i, r in enumerate(rows):
                v = x[i].tobytes()
                if digests:
                    link = blake2b((x[i] + 0.0).tobytes(), digest_size=16).hexdigest()
                    key = (names[r], link)
                    new = key not in first or bool(ask[r]) and key not in asked
                    first.setdefault(key, link)
                    if ask[r]:
                        asked.add(key)
                else:
                    old = first.setdefault((names[r], v), ids[r])
                    new = old is ids[r]
                    if not new and old == ids[r]:
                        continue  # the same row again
                    link = None if new else old
                got["table_name"].append(names[r])
                got["id"].append(ids[r])
                got["link"].append(link)
                got["ask"].append(bool(ask[r]))
                got["v"].append(v if new else None)
                got["cells"].append(best[i] if new else None)
            yield pa.RecordBatch.from_arrays([pa.array(got["table_name"], pa.string()), pa.array(got["id"], pa.string()), pa.array(got["link"], pa.string()), pa.array(got["ask"], pa.bool_()), pa.array(got["v"], pa.binary()), pa.array(got["cells"], pa.list_(pa.int32()))], list(got))

    return cut(spread(vectors).mapInArrow(assign, "table_name string, id string, link string, ask boolean, v binary, cells array<int>"))


def _met(placed: DataFrame, k: int, floor: float, m: int, ef: int, search_ef: int | None, dim: int, once: list[str] | None = None) -> DataFrame:
    """(table_name, id_a, id_b, cosine) of the pairs that the shards' graphs meet; vectors asked for by ``ask``.

    ``once`` is the key of a vector if it may have come from several tasks and shall visit other shards once.
    """
    spark = placed.sparkSession
    one = placed.filter("v is not null")
    # at most MAX_CELLS rows a table
    counts = one.groupBy("table_name", F.col("cells")[0].alias("cell")).agg(F.count(F.lit(1)).alias("n")).withColumn("subs", F.ceil(F.col("n") / MAX_SHARD).cast("int")).collect()
    subs = spark.createDataFrame([(r.table_name, r.cell, r.subs) for r in counts], "table_name string, cell int, subs int")
    own = one.select("table_name", "id", "v", F.col("cells")[0].alias("cell"), F.lit(True).alias("own"), "ask")
    # a vector that is not asked for need not leave its own shard
    visit = one.filter("ask").dropDuplicates(once) if once else one.filter("ask")
    other = visit.select("table_name", "id", "v", F.explode("cells").alias("cell"), F.lit(False).alias("own"), "ask")
    homes = own.join(F.broadcast(subs), ["table_name", "cell"]).withColumn("sub", F.pmod(F.xxhash64("v"), F.col("subs")).cast("int")).drop("subs")
    guests = other.join(F.broadcast(subs), ["table_name", "cell"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).drop("subs")
    shards = homes.unionByName(guests.select(homes.columns))
    n_shards = sum(r.subs for r in counts)
    # about one shard a task: some MB and a second of work each
    parts = max(1, min(n_shards, 100_000))

    def shard(table: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(table.column("v").to_pylist()), "f4").reshape(-1, dim)
        ids = np.array(table.column("id").to_pylist(), dtype=object)
        here, ask = table.column("own").to_numpy(zero_copy_only=False).astype(bool), table.column("ask").to_numpy(zero_copy_only=False).astype(bool)
        out: list[tuple[str, str, float]] = []

        def add(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> None:
            out.extend((p, q, float(w)) if p < q else (q, p, float(w)) for p, q, w in zip(a, b, s) if p != q)

        nodes, first_at, inverse = np.unique(x[here], axis=0, return_index=True, return_inverse=True)
        inverse = inverse.reshape(-1)
        home_ids = ids[here]
        names = home_ids[first_at]
        add(names[inverse], home_ids, np.ones(len(home_ids)))  # the same vector from several tasks
        if len(nodes):
            asked = np.zeros(len(nodes), bool)
            np.logical_or.at(asked, inverse, ask[here])
            g = Graph(nodes, m, ef)
            for a, b, s in g.build(k, floor):
                w = asked[a] | asked[b]
                add(names[a[w]], names[b[w]], s[w])
            known = {r.tobytes() for r in nodes}
            guests = np.nonzero(~here)[0]
            # its own vectors were answered while they were inserted
            guests = np.array([i for i in guests if x[i].tobytes() not in known], int)
            if k > 0 and asked.any():
                # of an inserted vector only earlier ones were met in full: ask again for its k best
                at = np.nonzero(asked)[0]
                for a, b, s in g.query(nodes[at], k + 1, 2.0, search_ef):
                    add(names[at[a]], names[b], s)
            for a, b, s in g.query(x[guests], k, floor, search_ef):
                add(ids[guests[a]], names[b], s)
        best = dict(((a, b), s) for a, b, s in out)
        name = table.column("table_name")[0].as_py() if table.num_rows else None
        return pa.table({"table_name": pa.array([name] * len(best), pa.string()), "id_a": pa.array([a for a, _ in best], pa.string()), "id_b": pa.array([b for _, b in best], pa.string()), "cosine": pa.array(list(best.values()), pa.float64())})

    schema = "table_name string, id_a string, id_b string, cosine double"
    return shards.repartition(parts, "table_name", "cell", "sub").groupBy("table_name", "cell", "sub").applyInArrow(shard, schema)


def top_k(pairs: DataFrame, k: int) -> DataFrame:
    """(table_name, id, rank, other, cosine): both directions of the pairs, k best of each id; ties by id."""
    both = pairs.select("table_name", F.col("id_a").alias("id"), F.col("id_b").alias("other"), "cosine").unionByName(pairs.select("table_name", F.col("id_b").alias("id"), F.col("id_a").alias("other"), "cosine"))
    w = Window.partitionBy("table_name", "id").orderBy(F.desc("cosine"), "other")
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("table_name", "id", "rank", "other", "cosine")
