"""Lookup joins that survive hot keys.

A lookup side with one row a key can still starve a shuffle join when one key holds a third of the other
side. The keys that hold at least ``1 / HOT_PARTS`` of the rows are at most ``HOT_PARTS`` by counting, so they
and their lookup rows may be broadcast; all other keys go through an ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

#: Keys with at least 1/HOT_PARTS of all rows are hot; there are never more of them than HOT_PARTS.
HOT_PARTS = 128


def hot_keys(counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """At most HOT_PARTS keys, from a table of (key, n) whose n add up to total."""
    least = max(2, -(-total // HOT_PARTS))
    return counts.filter(F.col(n) >= F.lit(least)).select(key)


def few_hot(counts: DataFrame, key: str, n: str) -> DataFrame:
    """``hot_keys`` of a table of (key, n), worked out now in one pass: a local table of at most HOT_PARTS keys."""
    seen = Observation()
    rows = counts.observe(seen, F.sum(n).alias("total")).filter(F.col(key).isNotNull()).orderBy(F.desc(n)).limit(HOT_PARTS).select(key, n).collect()
    least = max(2, -(-(seen.get["total"] or 0) // HOT_PARTS))
    return counts.sparkSession.createDataFrame([(r[0],) for r in rows if r[1] >= least], counts.select(key).schema)


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` joined with ``lookup`` (one row a key) where ``hot`` lists the at most HOT_PARTS hot keys.

    Null keys match nothing, never meet in one task and are kept by a left join. The order of columns is key, rows,
    lookup.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    flag = hot.select(key).distinct().withColumn("__hot", F.lit(True))
    tagged = rows.join(F.broadcast(flag), key, "left")
    few = lookup.join(F.broadcast(flag.select(key)), key, "left_semi")
    a = tagged.filter("__hot").drop("__hot").join(F.broadcast(few), key, how)
    b = tagged.filter(F.col("__hot").isNull() & F.col(key).isNotNull()).drop("__hot").join(lookup, key, how)
    if how == "inner":
        return a.unionByName(b)
    return a.unionByName(b).unionByName(rows.filter(F.col(key).isNull()), allowMissingColumns=True)
