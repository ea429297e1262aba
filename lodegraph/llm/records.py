"""Records that differ only in formatting: one record each, with the number of its copies.

Each row gets a canonical text (characters, letter case, white space, punctuation; in a list field also the
order and separators of its items) and its 128-bit hash. Counts are aggregated by hash with map-side
combining; a second, independent hash travels along, and where one 128-bit hash carries two of them (a
collision) those groups are counted again by the canonical text itself.

Defined results: a null field equals an empty one and one without letter or digit; a decimal point between
digits and a minus sign before a number count, and so does the attribute of an item; rows of which all
fields are null are one record. Row ids are taken as they come: a row that is delivered twice counts twice in
``n_copies``, and ``copies`` names a pair of ids once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.llm.canonical import key_of, with_folded
from lodegraph.operators.skew import hot_keys, lookup_join
from lodegraph.plans.session import cut

_SYMBOL = r"[^\p{L}\p{N}\p{M}.]+"
_POINT = r"(?<![0-9])\.|\.(?![0-9])"


def plain_key(folded: Column) -> Column:
    """Letters, digits and decimal points of a text, in lower case. Null gives the empty text."""
    low = key_of(F.coalesce(folded, F.lit("")))
    # marks are taken out before points are judged, so that "1 . 5" does not become a number
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(low, _POINT, ""), _SYMBOL, ""), r"\s", "")


def list_key(folded: Column) -> Column:
    """Sorted items of a list such as ``W=10; H=20, STD``; an item is ``attribute=value`` or a bare value."""
    low = key_of(F.regexp_replace(F.coalesce(folded, F.lit("")), r"[\r\n]+", ";"))
    # thousands commas are no separators; white space splits before an attribute
    low = F.regexp_replace(low, r"(?<=[0-9]),(?=[0-9]{3}(?![0-9]))", "")
    low = F.regexp_replace(low, r"\s*[=:]\s*", "=")
    low = F.regexp_replace(low, r"\s+(?=[\p{L}_][\p{L}\p{N}_.-]*=)", ";")
    low = F.regexp_replace(low, r"(?<==)-(?=[0-9.])", "\u0001")
    low = F.regexp_replace(low, r"(?<![\p{L}\p{N}])-(?=[0-9])", "\u0001")

    def item(x: Column) -> Column:
        x = F.regexp_replace(F.regexp_replace(x, _POINT, ""), r"[^\p{L}\p{N}\p{M}.=\u0001]+", "")
        return F.translate(F.regexp_replace(x, r"=+", "="), "\u0001", "-")

    items = F.filter(F.transform(F.split(low, r"[;,|/\t]+"), item), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    return F.array_join(F.array_sort(items), ";")


def canonical_rows(df: DataFrame, row_id: str, fields: list[str], lists: list[str]) -> DataFrame:
    """(row_id, canon) with canon the canonical text of the record."""
    cols = df.select(F.col(row_id).alias("row_id"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)])
    done = with_folded(cols, [f"f{i}" for i in range(len(fields))], "_v")
    keys = [(list_key if f in lists else plain_key)(F.col(f"f{i}_v")) for i, f in enumerate(fields)]
    return done.select("row_id", F.concat_ws("\u0002", *keys).alias("canon"))


def record_groups(df: DataFrame, row_id: str, fields: list[str], lists: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (row_id, rec) and groups (rec, keep_row_id, n_copies), rec being a binary key."""
    canon = canonical_rows(df, row_id, fields, list(lists))
    rows = cut(canon.select("row_id", F.unhex(F.md5("canon")).alias("rec"), F.xxhash64("canon").alias("h2")))
    agg = [F.min("row_id").alias("keep_row_id"), F.count(F.lit(1)).alias("n_copies"), F.min("h2").alias("lo"), F.max("h2").alias("hi")]
    groups = cut(rows.groupBy("rec").agg(*agg))
    clash = groups.filter("lo <> hi")
    if not clash.isEmpty():
        # two texts under one hash: tell them apart by the text itself, whose key is then longer than 128 bits
        own = canon.withColumn("rec", F.unhex(F.md5("canon"))).join(clash.select("rec"), "rec", "left_semi")
        redone = own.select("row_id", F.encode("canon", "UTF-8").alias("rec"), F.xxhash64("canon").alias("h2"))
        rows = rows.join(clash.select("rec"), "rec", "left_anti").select("row_id", "rec", "h2").unionByName(redone)
        groups = groups.filter("lo = hi").unionByName(redone.groupBy("rec").agg(*agg))
    return rows.select("row_id", "rec"), groups.select("rec", "keep_row_id", "n_copies")


def copies(df: DataFrame, row_id: str, fields: list[str], lists: list[str] = ()) -> DataFrame:
    """(keep_row_id, copy_row_id) of every row that is not the smallest of its record."""
    rows, groups = record_groups(df, row_id, fields, lists)
    total = groups.agg(F.sum("n_copies")).first()[0] or 0
    many = groups.filter("n_copies > 1")
    got = lookup_join(rows, many, "rec", hot_keys(many, "rec", "n_copies", total), "inner")
    return got.filter("row_id <> keep_row_id").select("keep_row_id", F.col("row_id").alias("copy_row_id")).distinct()
