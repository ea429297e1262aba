"""Graph normalisation: names, representatives, direction repair, outliers, integrity, ids, garbage, duplicates."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodegraph.operators import rules
from lodegraph.operators.ordering import global_row_number, latest
from lodegraph.operators.skew import few_hot, lookup_join
from lodegraph.plans.session import ship_here


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition, once for each distinct value of a batch."""
    codes, values = pd.factorize(s, use_na_sentinel=True)
    out = [unicodedata.normalize("NFKC", v) for v in values] + [None]
    return pd.Series([out[c] for c in codes], dtype=object)


def _tidy(t: Column) -> Column:
    t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    t = F.regexp_replace(F.regexp_replace(t, r"\s*\(\s*", "("), r"\s*\)\s*", ")")
    for a, b in rules.UNIT_SIGNS.items():
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def normal_name(name: Column, type_: Column | None = None) -> Column:
    """Diameter sign before a number out, NFKC, white space squeezed, none at parentheses, unit signs. Null is ''.

    Given the type, the spaced-out trades of labour names are written together.
    """
    ship_here()
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"[φΦø∅ɸ]\s*(?=\d)", "")
    # plain ASCII and Hangul syllables are composed already and need no Python
    odd = bare.rlike(r"[^\x00-\x7f가-힣]")
    t = F.when(odd, nfkc(F.when(odd, bare))).otherwise(bare)
    if type_ is not None:
        whole = t
        for trade in rules.SPACED_TRADES:
            whole = F.replace(whole, F.lit(" ".join(trade)), F.lit(trade))
        t = F.when(type_ == "Labor", whole).otherwise(t)
    return _tidy(t)


def normal_spec(spec: Column) -> Column:
    return F.when(spec.isNull() | F.trim(spec).isin(*rules.BLANK_SPECS), "").otherwise(normal_name(spec))


def representatives(e: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: the row of highest confidence, best method, lowest row_id; with the sorted chunk ids of the
    group, its longest spec and its highest confidence. Aggregates only, so hot groups combine map-side."""
    rank = rules.lookup(F.col("source_method"), rules.METHOD_RANK, 9)
    order = F.struct((-F.coalesce("confidence", F.lit(0.0))).alias("c"), rank.alias("m"), F.col("row_id").alias("r"))
    longest = F.struct(F.coalesce(F.length("spec"), F.lit(-1)).alias("n"), F.col("spec").alias("s"))
    return e.groupBy(*keys).agg(
        F.min(order).alias("o"), F.count(F.lit(1)).alias("n_rows"), F.max("confidence").alias("confidence"), F.max(longest).alias("l"), F.countDistinct(F.nullif(F.trim("source_chunk_id"), F.lit(""))).alias("n_chunks")
    ).select(*keys, F.col("o.r").alias("row_id"), "n_rows", "confidence", F.col("l.s").alias("longest_spec"), "n_chunks")


def chunk_heads(e: DataFrame, chunk: str = "source_chunk_id", order: str = "row_id") -> DataFrame:
    """(chunk, work, section): the first WorkType and the first Section of each chunk; blank ids are none."""
    first = lambda t: F.min_by("name", F.when((F.col("type") == t) & (F.trim("name") != ""), F.col(order)))
    return e.filter(F.trim(chunk) != "").groupBy(chunk).agg(first("WorkType").alias("work"), first("Section").alias("section"))


def repair_directions(r: DataFrame, heads: DataFrame, chunk: str = "source_chunk_id") -> DataFrame:
    """``r`` with action and the ends that follow from it, by the table of allowed directions.

    keep: an allowed or unknown relation. note: the target of HAS_NOTE that is called a WorkType reads like a note
    and becomes one. work: a source that is not allowed becomes the chunk's first WorkType; for labour, equipment
    and material whatever the target is, for other relations if the target is of the right type. section: there
    is no WorkType, and a material may hang on the chunk's Section. drop: everything else, notes of notes among it.
    """
    d = lookup_join(r, heads, chunk, few_hot(r.groupBy(chunk).agg(F.count(F.lit(1)).alias("n")), chunk, "n"))
    rel, st, tt = F.col("type"), F.col("source_type"), F.col("target_type")
    sources = rules.lookup(rel, {k: ",".join(v[0]) for k, v in rules.DIRECTIONS.items()})
    goal = rules.lookup(rel, {k: v[1] for k, v in rules.DIRECTIONS.items()})
    source_ok = F.coalesce(F.array_contains(F.split(sources, ","), st), F.lit(False))
    target_ok = F.coalesce(tt == goal, F.lit(False))
    resource = rel.isin("REQUIRES_LABOR", "REQUIRES_EQUIPMENT", "USES_MATERIAL")
    note = (rel == "HAS_NOTE") & F.coalesce((tt == "WorkType") & F.col("target").rlike(rules.NOTE_LIKE), F.lit(False))
    loop = (rel == "HAS_NOTE") & F.coalesce((st == "Note") & (tt == "Note"), F.lit(False))
    action = (
        F.when(goal.isNull() | source_ok & target_ok, "keep")
        .when(source_ok, F.when(note, "note").otherwise("drop"))
        .when(resource, F.when(F.col("work").isNotNull(), "work").when(F.col("section").isNotNull() & (rel == "USES_MATERIAL"), "section").otherwise("drop"))
        .when(~loop & target_ok & F.col("work").isNotNull(), "work")
        .otherwise("drop")
    )
    d = d.withColumn("action", action)
    named = {"work": ("work", "WorkType"), "section": ("section", "Section")}
    pick = lambda i, own: rules.switch(F.col("action"), {a: F.col(v[0]) if i == 0 else F.lit(v[1]) for a, v in named.items()}, own)
    fixed = {"source": pick(0, F.col("source")), "source_type": pick(1, st), "target_type": F.when(F.col("action") == "note", "Note").otherwise(tt)}
    return d.withColumns(fixed).drop("work", "section").select(*r.columns, "action")


def flag_outliers(r: DataFrame) -> DataFrame:
    """Zero quantities out; quantities above the relation's limit flagged with low confidence."""
    limit = rules.lookup(F.col("type"), rules.OUTLIER)
    high = F.coalesce(F.col("quantity") > limit, F.lit(False))
    return r.filter("quantity is null or quantity <> 0").withColumn("outlier", high).withColumn("confidence", F.when(high, 0.3).otherwise(F.col("confidence")))


def edge_states(edges: DataFrame, ids: DataFrame, source: str = "source_id", target: str = "target_id") -> DataFrame:
    """``edges`` with state ok, source, target or both: which ends have no node. Null ends have none."""
    known, d = ids.select("id").distinct(), edges
    for end, flag in ((source, "s_ok"), (target, "t_ok")):
        hot = few_hot(edges.groupBy(end).agg(F.count(F.lit(1)).alias("n")), end, "n")
        d = lookup_join(d, known.select(F.col("id").alias(end), F.lit(True).alias(flag)), end, hot)
    state = F.when(F.col("s_ok") & F.col("t_ok"), "ok").when(F.col("s_ok"), "target").when(F.col("t_ok"), "source").otherwise("both")
    return d.select(*edges.columns, state.alias("state"))


def first_of_each(edges: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Null-safe duplicates out, the first by order stays."""
    return latest(edges, keys, [F.col(order)])


def known_type(type_: Column) -> Column:
    """A type in its own spelling if case, blanks and punctuation are all that differ; others as they are."""
    key = F.regexp_replace(F.lower(type_), r"[^\p{L}\p{N}]", "")
    return F.coalesce(rules.lookup(key, {t.lower(): t for t in rules.TYPE_PREFIX}), type_)


def assign_ids(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``id`` as prefix and dense number within the type, by order; all unknown types are X in one sequence.

    Types are few and large, so the numbers come from one global numbering less the rows of the prefixes before.
    """
    d = nodes.withColumn("__p", rules.lookup(F.col("type"), rules.TYPE_PREFIX, "X"))
    d = global_row_number(d, ["__p", "type", *order], "__n")
    first = d.groupBy("__p").agg(F.min("__n").alias("__first"))  # one row a prefix
    d = d.join(F.broadcast(first), "__p")
    return d.withColumn("id", F.format_string("%s-%04d", F.col("__p"), F.col("__n") - F.col("__first") + 1)).drop("__p", "__n", "__first")


def resolve_ids(ends: DataFrame, nodes: DataFrame) -> DataFrame:
    """(…, entity_id): by (type, name, spec), else by (type, name), else ''. A null spec is a blank one."""
    key = lambda *c: F.concat_ws("\u0001", *[F.coalesce(x, F.lit("\u0000")) for x in c])
    spec = F.coalesce("spec", F.lit(""))
    exact = nodes.groupBy(key(F.col("type"), F.col("name"), spec).alias("__k")).agg(F.max("id").alias("exact"))
    loose = nodes.groupBy(key(F.col("type"), F.col("name")).alias("__k")).agg(F.min("id").alias("loose"))
    d = ends
    for keys, table in (((F.col("type"), F.col("name"), spec), exact), ((F.col("type"), F.col("name")), loose)):
        # an end without type or name has no node
        d = d.withColumn("__k", F.when(F.col("type").isNotNull() & F.col("name").isNotNull(), key(*keys)))
        d = lookup_join(d, table, "__k", few_hot(d.groupBy("__k").agg(F.count(F.lit(1)).alias("n")), "__k", "n")).drop("__k")
    return d.select(*ends.columns, F.coalesce("exact", "loose", F.lit("")).alias("entity_id"))


def garbage_reason(name: Column) -> Column:
    """Why a name is none: null for good ones."""
    t = F.trim(F.coalesce(name, F.lit("")))
    return F.when(t == "", "blank").when(~t.rlike(r"[A-Za-z0-9가-힣]"), "symbols").when(t.rlike(r"^[\d.,]+$"), "number").when(t.rlike(r"^[\d.,]+\s*(mm|cm|m|kg|t|kW|개|인|%)$"), "quantity").when(t.rlike(r"^[:：]"), "colon").when(F.length(t) == 1, "short")


def drop_with_edges(nodes: DataFrame, edges: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Nodes without the bad ones, edges without those that touch them."""
    gone = nodes.filter(bad).select("id").distinct()
    good = nodes.filter(~F.coalesce(bad, F.lit(False)))
    for end in ("source_id", "target_id"):
        edges = edges.join(gone.select(F.col("id").alias(end)), end, "left_anti")
    return good, edges


def repeated_tables(chunks: DataFrame) -> DataFrame:
    """(signature, scope, n, first_chunk): tables that several chunks of a base section have with equal content."""
    from lodegraph.operators.segments import base_id
    from lodegraph.operators.tables import signature

    t = chunks.select("chunk_id", base_id(F.col("section_id")).alias("scope"), F.explode("tables").alias("t"))
    return t.groupBy("scope", signature(F.col("t")).alias("signature")).agg(F.countDistinct("chunk_id").alias("n"), F.min("chunk_id").alias("first_chunk")).filter("n > 1")


def dense_renumber(nodes: DataFrame, edges: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """New dense ids for nodes; edge ends follow."""
    new = assign_ids(nodes.withColumnRenamed("id", "old_id"), order)
    names = new.select("old_id", F.col("id").alias("new_id"))
    for end in ("source_id", "target_id"):
        edges = edges.join(names.withColumnRenamed("old_id", end), end, "left").withColumn(end, F.coalesce("new_id", F.col(end))).drop("new_id")
    return new, edges


def sample_by_group(df: DataFrame, by: list[str], key: str, n: int) -> DataFrame:
    """Deterministic stratified sample: the n smallest hashes of each group."""
    w = Window.partitionBy(*by).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")
