"""Merging extractors and building relations: keys, full outer merge, hierarchy, references, repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.operators.segments import valid_section

SPEC_TYPES = ("WorkType", "Equipment", "Material")


def entity_key(type_: Column, norm: Column, spec: Column, sub: Column) -> Column:
    """type::name[::spec][::sub]; spec counts for three types; parts without a value are left out."""
    part = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.concat_ws("::", type_, F.lower(norm), F.when(type_.isin(*SPEC_TYPES), part(spec)), part(sub))


def relation_key(type_: Column, source: Column, target: Column, basis: Column) -> Column:
    flat = lambda c: F.lower(F.replace(c, F.lit(" "), F.lit("")))
    return F.concat_ws("::", type_, flat(source), flat(target), F.nullif(F.trim(basis), F.lit("")))


def merge_extractors(base: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Full outer merge of two extractions of one row a key: ``other`` overrides quantity and unit, the higher
    confidence wins, origin tells where a key came from."""
    a = base.select(*on, *[F.col(c).alias(f"a_{c}") for c in ("quantity", "unit", "confidence")], F.lit(True).alias("in_a"))
    b = other.select(*on, *[F.col(c).alias(f"b_{c}") for c in ("quantity", "unit", "confidence")], F.lit(True).alias("in_b"))
    m = a.join(b, on, "full")
    origin = F.when(F.col("in_a") & F.col("in_b"), "merged").when(F.col("in_a"), "base").otherwise("other")
    return m.select(*on, F.coalesce("b_quantity", "a_quantity").alias("quantity"), F.coalesce("b_unit", "a_unit").alias("unit"), F.greatest("a_confidence", "b_confidence").alias("confidence"), origin.alias("origin"))


def inherit_sub_section(e: DataFrame) -> DataFrame:
    """A blank sub_section is that of a row of the same chunk, type, name and spec; rows without a chunk inherit
    from any chunk. The smallest value is taken, so the result does not depend on order."""
    own = F.nullif(F.trim("sub_section"), F.lit(""))
    chunk = F.nullif(F.trim("source_chunk_id"), F.lit(""))
    keys = ["type", "normalized_name", "spec"]
    have = e.filter(own.isNotNull())
    near = have.filter(chunk.isNotNull()).groupBy("source_chunk_id", *[F.coalesce(F.col(k), F.lit("")).alias(f"k_{k}") for k in keys]).agg(F.min(own).alias("near"))
    far = have.groupBy(*[F.coalesce(F.col(k), F.lit("")).alias(f"k_{k}") for k in keys]).agg(F.min(own).alias("far"))
    d = e.withColumns({f"k_{k}": F.coalesce(F.col(k), F.lit("")) for k in keys})
    kk = [f"k_{k}" for k in keys]
    d = d.join(near, ["source_chunk_id", *kk], "left").join(far, kk, "left")
    return d.withColumn("sub_section", F.coalesce(own, F.col("near"), F.when(chunk.isNull(), F.col("far")))).drop(*kk, "near", "far")


def belongs_to(e: DataFrame, chunks: DataFrame) -> DataFrame:
    """(source, spec, target) of work types and their chunk's section; an invalid section is its division's."""
    c = chunks.groupBy(F.col("chunk_id").alias("source_chunk_id")).agg(F.min("section_id").alias("section_id"), F.min("department").alias("department"))
    ok, sid = valid_section(F.col("section_id"))
    target = F.when(ok, sid).when(F.trim("department") != "", F.concat(F.lit("dept_"), F.trim("department")))
    return e.filter("type = 'WorkType'").join(c, "source_chunk_id").select(F.col("name").alias("source"), "spec", target.alias("target")).filter("target is not null").distinct()


def has_child(ids: DataFrame) -> DataFrame:
    """(parent, child, level) where the parent, the id without its last part, is an id itself."""
    d = ids.select("id").distinct()
    kids = d.withColumn("parent", F.regexp_replace("id", r"-\d+$", "")).filter("parent <> id")
    return kids.join(d.select(F.col("id").alias("parent")), "parent").select("parent", F.col("id").alias("child"), F.size(F.split("id", "-")).alias("level"))


def references(chunks: DataFrame) -> DataFrame:
    """(source, target) of cross references with a valid id (or the first one in their context), none to itself."""
    x = chunks.select("section_id", F.explode("cross_references").alias("x"))
    named = F.nullif(F.trim("x.target_section_id"), F.lit(""))
    found = F.nullif(F.regexp_extract("x.context", r"(\d{1,2}-\d{1,2}(?:-\d{1,3})?)", 1), F.lit(""))
    ok, target = valid_section(F.coalesce(named, found))
    source_ok, source = valid_section(F.col("section_id"))
    return x.filter(ok & source_ok).select(source.alias("source"), target.alias("target")).filter("source <> target").distinct()


def missing_links(have: DataFrame, want: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted rows that are not there yet."""
    return want.join(have.select(*keys).distinct(), keys, "left_anti")


def resolve_types(edges: DataFrame, entities: DataFrame, default: str = "WorkType") -> DataFrame:
    """(rel_id, source_type) with blank types filled by the name's type, else the default."""
    by_name = entities.groupBy(F.col("name").alias("source")).agg(F.min("type").alias("found"))
    return edges.join(by_name, "source", "left").select("rel_id", F.coalesce(F.nullif(F.trim("source_type"), F.lit("")), "found", F.lit(default)).alias("source_type"))


def union_rows(valid: DataFrame, recovered: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, origin): rows of both sides, each key once; a key on both sides is valid. Groups are never gathered."""
    u = valid.withColumn("__o", F.lit(0)).unionByName(recovered.withColumn("__o", F.lit(1)))
    return u.groupBy(*keys).agg(F.min("__o").alias("__o")).select(*keys, F.when(F.col("__o") == 0, "valid").otherwise("recovered").alias("origin"))
