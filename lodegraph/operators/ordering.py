"""Operators on ordered rows: as-of joins, islands, carried values, global numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodegraph.plans.session import cut, shuffle_parts


_POS = (1 << 33) - 1


def _ranged(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows sorted by (by, order) over range partitions, with __part and __pos, written to the shared folder.

    A key of any size is spread over as many parts as it fills, so no task gets a hot key whole.
    """
    parts = shuffle_parts(df.sparkSession)
    d = df.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order).withColumn("__m", F.monotonically_increasing_id())
    return cut(d).withColumns({"__part": F.shiftright("__m", 33), "__pos": F.col("__m").bitwiseAND(F.lit(_POS))}).drop("__m")


def _within(by: list[str]):
    return Window.partitionBy("__part", *by).orderBy("__pos")


def _carried(d: DataFrame, by: list[str], cols: list[str], combine) -> DataFrame:
    """``d`` with ``in_<col>``: what the parts before hand on to a row's key, null if nothing.

    ``cols`` are running values; of each part only those at its last row are collected, one row a part.
    """
    spark = d.sparkSession
    ends = d.groupBy("__part").agg(F.max_by(F.struct(*by, *cols), "__pos").alias("s"))
    key, state, rows = None, None, []
    for r in sorted(ends.collect(), key=lambda r: r[0]):
        if key is not None:
            rows.append((r[0], *key, *state))
        k, v = tuple(r.s[c] for c in by), [r.s[c] for c in cols]
        state = [combine(old, new) for old, new in zip(state, v)] if k == key else v
        key = k
    names = ["__part", *[f"__k{i}" for i in range(len(by))], *[f"in_{c}" for c in cols]]
    types = [d.schema["__part"].dataType, *[d.schema[c].dataType for c in by], *[d.schema[c].dataType for c in cols]]
    table = spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in zip(names, types)]))
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    got = d.join(F.broadcast(table), "__part", "left")  # one row a part
    return got.withColumns({f"in_{c}": F.when(same, F.col(f"in_{c}")) for c in cols}).drop(*[f"__k{i}" for i in range(len(by))])


def _newer(old, new):
    return old if new is None else new


def carry_forward(df: DataFrame, by: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Fill nulls of ``cols`` with the last value before, within ``by``; ``order`` is a total order."""
    d = _ranged(df, by, order)
    d = d.withColumns({c: F.last(c, ignorenulls=True).over(_within(by).rowsBetween(Window.unboundedPreceding, 0)) for c in cols})
    d = _carried(d, by, cols, _newer)
    return d.select(*[F.coalesce(c, f"in_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, value: list[str], prefix: str = "asof_") -> DataFrame:
    """Each left row with the values of the last right row of the same ``by`` whose ``on`` is not later.

    Both sides are merged in order and the right side's values carried forward; no pair of rows is ever formed.
    Left rows without a match get nulls; of right rows at the same point one of the last values is taken.
    """
    a = left.withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast("struct<" + ",".join(f"{c}:{right.schema[c].dataType.simpleString()}" for c in value) + ">"))
    b = right.select(*[F.col(c) for c in by], F.col(on), F.struct(*value).alias("__v")).withColumn("__side", F.lit(0))
    got = carry_forward(a.unionByName(b, allowMissingColumns=True), by, [on, "__side", "__v"], ["__v"]).filter("__side = 1")
    return got.select(*left.columns, *[F.col(f"__v.{c}").alias(f"{prefix}{c}") for c in value])


def islands(df: DataFrame, by: list[str], order: list[str], gap: Column, name: str = "island") -> DataFrame:
    """Number runs of rows: a row for which ``gap`` (may use ``prev_<order[0]>``) holds starts a new one.

    ``order`` is a total order whose first column is not null.
    """
    x, prev = order[0], f"prev_{order[0]}"
    d = _carried(_ranged(df, by, order), by, [x], _newer)
    d = d.withColumn(prev, F.coalesce(F.lag(x).over(_within(by)), f"in_{x}")).drop(f"in_{x}")
    d = d.withColumn("__new", F.when(F.col(prev).isNull() | gap, 1).otherwise(0).cast("bigint"))
    d = d.withColumn("__sum", F.sum("__new").over(_within(by).rowsBetween(Window.unboundedPreceding, 0)))
    d = _carried(d, by, ["__sum"], lambda old, new: old + new)
    return d.select(*df.columns, (F.col("__sum") + F.coalesce("in___sum", F.lit(0))).alias(name))


def global_row_number(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Dense numbers from 1 over all rows in the given (total) order, without one task seeing them all.

    Rows are range-partitioned and sorted, the parts counted (one number a part goes to the driver), and each
    row gets its part's offset plus its place.
    """
    parts = shuffle_parts(df.sparkSession)
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id())
    placed = cut(placed)
    part = F.shiftright("__m", 33)
    sizes = sorted((r.p, r.n) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    offset, total = {}, 0
    for p, n in sizes:
        offset[p] = total
        total += n
    base = df.sparkSession.createDataFrame(list(offset.items()), "__grn_part bigint, __grn_base bigint")  # one row a part
    d = placed.withColumn("__grn_part", part.cast("bigint")).join(F.broadcast(base), "__grn_part", "left")
    return d.select(*df.columns, (F.col("__grn_base") + F.col("__m").bitwiseAND(F.lit(_POS)) + 1).alias(name))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
