"""Queries of the quality checks (operators H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import normalise as N, ordering, quality as Q, rules
from lodegraph.operators.tables import flat_text
from lodegraph.plans.session import load


def _c(spark, d):
    return load(spark, d, "graph_chunks")


def _e(spark, d):
    return load(spark, d, "entities")


def _g(spark, d):
    return load(spark, d, "graph_entities")


def _r(spark, d):
    return load(spark, d, "relationships")


def _gr(spark, d):
    return load(spark, d, "graph_relationships")


def _all_text(c: DataFrame) -> DataFrame:
    return c.withColumn("all_text", F.concat_ws(" ", "text", flat_text(F.col("tables")), F.array_join("notes", " ")))


def h01_section_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Q.coverage(_c(spark, d).select(F.col("section_id").alias("key")), load(spark, d, "toc"), "key")


def h02_table_parse_rate(spark: SparkSession, d: str) -> DataFrame:
    t = _c(spark, d).select(F.explode("tables").alias("t"))
    return Q.ratio_check(t, "table_parse_rate", F.col("t.parsed_row_count") >= F.col("t.raw_row_count"), least=0.9)


def h03_empty_chunks(spark: SparkSession, d: str) -> DataFrame:
    blank = (F.coalesce(F.trim("text"), F.lit("")) == "") & (F.coalesce(F.size("tables"), F.lit(0)) <= 0)
    return Q.ratio_check(_c(spark, d), "empty_chunks", blank, most=0.05)


def h05_blank_fields(spark: SparkSession, d: str) -> DataFrame:
    return Q.blank_fields(_c(spark, d), "chunk_id", ["section_id", "title", "department", "chapter", "revision_year", "text"])


def h06_repeated_chunks(spark: SparkSession, d: str) -> DataFrame:
    return Q.repeated_keys(_c(spark, d), "chunk_id")


def h07_departments(spark: SparkSession, d: str) -> DataFrame:
    return _c(spark, d).groupBy("department").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.coalesce(F.size("tables"), F.lit(0))).alias("tables"), F.countDistinct("section_id").alias("sections"))


def h08_report(spark: SparkSession, d: str) -> DataFrame:
    return Q.report([h02_table_parse_rate(spark, d), h03_empty_chunks(spark, d), h21_chunk_coverage(spark, d), h23_units(spark, d)])


def h11_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return Q.foreign_sections(_c(spark, d).select("chunk_id", "section_id", "text"), load(spark, d, "toc")).distinct()


def h12_reference_validity(spark: SparkSession, d: str) -> DataFrame:
    x = _c(spark, d).select("chunk_id", F.explode("cross_references").alias("x")).select("chunk_id", F.col("x.target_section_id").alias("id"))
    known = load(spark, d, "toc").select(F.col("id"), F.lit(True).alias("ok")).distinct()
    return Q.ratio_check(x.join(known, "id", "left"), "reference_validity", F.col("ok").isNotNull(), least=1.0)


def h13_note_recall(spark: SparkSession, d: str) -> DataFrame:
    c = _c(spark, d).groupBy("section_id").agg(F.bool_or(F.coalesce(F.col("text").contains("[주]"), F.lit(False))).alias("marked"), F.bool_or(F.coalesce(F.size("notes") > 0, F.lit(False))).alias("kept"))
    return Q.ratio_check(c.filter("marked"), "note_recall", F.col("kept"), least=0.95)


def h15_isolation(spark: SparkSession, d: str) -> DataFrame:
    return _c(spark, d).groupBy("section_id").agg(F.countDistinct("department").alias("departments")).filter("departments > 1")


def h20_sample(spark: SparkSession, d: str) -> DataFrame:
    return N.sample_by_group(_c(spark, d).select("department", "chunk_id").distinct(), ["department"], "chunk_id", 20)


def h21_chunk_coverage(spark: SparkSession, d: str) -> DataFrame:
    used = _e(spark, d).select(F.col("source_chunk_id").alias("chunk_id")).distinct().withColumn("used", F.lit(True))
    return Q.ratio_check(_c(spark, d).select("chunk_id").distinct().join(used, "chunk_id", "left"), "chunk_coverage", F.col("used").isNotNull(), least=0.9)


def h22_edge_integrity(spark: SparkSession, d: str) -> DataFrame:
    s = N.edge_states(_gr(spark, d).withColumnRenamed("id", "edge"), _g(spark, d))
    return s.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def h23_units(spark: SparkSession, d: str) -> DataFrame:
    r = _r(spark, d).filter("quantity is not null and quantity <> 0")
    return Q.ratio_check(r, "quantity_units", F.coalesce(F.trim("unit"), F.lit("")) != "", least=0.95)


def h24_isolated(spark: SparkSession, d: str) -> DataFrame:
    return Q.isolated_edges(_gr(spark, d), _g(spark, d).select("id", "type").distinct()).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def h25_name_stages(spark: SparkSession, d: str) -> DataFrame:
    """How each entity's name is found in its chunk."""
    c = _all_text(_c(spark, d)).groupBy(F.col("chunk_id").alias("source_chunk_id")).agg(F.max("all_text").alias("t")).withColumn("t", Q.flat(F.col("t")))
    e = _e(spark, d).select("row_id", "name", "source_chunk_id").join(c, "source_chunk_id")
    return e.groupBy(F.coalesce(Q.name_stage(F.col("name"), F.col("t")), F.lit("none")).alias("stage")).agg(F.count(F.lit(1)).alias("n"))


def h27_verdict(spark: SparkSession, d: str) -> DataFrame:
    return Q.verdict(h08_report(spark, d))


def h28_strict(spark: SparkSession, d: str) -> DataFrame:
    return Q.strict_split(_e(spark, d), _all_text(_c(spark, d))).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


def h29_quantity_evidence(spark: SparkSession, d: str) -> DataFrame:
    c = _all_text(_c(spark, d)).groupBy(F.col("chunk_id").alias("source_chunk_id")).agg(F.max("all_text").alias("t"))
    r = _r(spark, d).filter("quantity is not null").select("rel_id", "quantity", "source_chunk_id").distinct().join(c, "source_chunk_id")
    return r.select("rel_id", Q.quantity_in_text(F.col("quantity"), F.col("t")).alias("seen")).groupBy("seen").agg(F.count(F.lit(1)).alias("n"))


def h31_audit(spark: SparkSession, d: str) -> DataFrame:
    t = _c(spark, d).select(F.substring_index("section_id", "#", 1).alias("base_id"), F.explode("tables").alias("t"))
    return Q.coverage_bands(t.select("base_id", F.col("t.raw_row_count").alias("n")), t.select("base_id", F.col("t.parsed_row_count").alias("n")), "base_id")


def h36_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.counts(spark, {n: load(spark, d, n) for n in ("toc", "graph_chunks", "entities", "relationships", "graph_entities", "graph_relationships", "documents")})


def h37_top_names(spark: SparkSession, d: str) -> DataFrame:
    return Q.top_names(_r(spark, d).filter("target is not null"), "target", 10)


def h38_orphan_ends(spark: SparkSession, d: str) -> DataFrame:
    g = _g(spark, d).select("id").distinct()
    a = _gr(spark, d).select("source_id").join(g.withColumnRenamed("id", "source_id"), "source_id", "left_anti").agg(F.count(F.lit(1)).alias("n")).withColumn("end", F.lit("source"))
    return a.unionByName(_gr(spark, d).select("target_id").join(g.withColumnRenamed("id", "target_id"), "target_id", "left_anti").agg(F.count(F.lit(1)).alias("n")).withColumn("end", F.lit("target")))


def h39_nulls(spark: SparkSession, d: str) -> DataFrame:
    return Q.null_census(_g(spark, d), ["id", "name", "type", "source_section", "embedding", "is_active"])


def h40_dimensions(spark: SparkSession, d: str) -> DataFrame:
    return _g(spark, d).filter("embedding is not null").groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))


def h41_labour_range(spark: SparkSession, d: str) -> DataFrame:
    q = _r(spark, d).filter("type = 'REQUIRES_LABOR' and quantity is not null")
    return Q.ratio_check(q, "labour_range", F.col("quantity").between(0.001, 100.0), least=0.95)


def h42_same_chunk_ends(spark: SparkSession, d: str) -> DataFrame:
    """Relation ends that are names of entities of the same chunk."""
    names = _e(spark, d).select("source_chunk_id", F.explode(F.array("name", "normalized_name")).alias("n")).filter("n is not null").distinct().withColumn("ok", F.lit(True))
    r = _r(spark, d).select("rel_id", "source_chunk_id", F.col("source").alias("n")).distinct()
    return Q.ratio_check(r.join(names, ["source_chunk_id", "n"], "left"), "same_chunk_source", F.col("ok").isNotNull(), least=0.95)


def h43_directions(spark: SparkSession, d: str) -> DataFrame:
    return Q.ratio_check(Q.valid_directions(_r(spark, d)), "directions", F.coalesce("ok", F.lit(False)), least=0.95)


def h44_spec_variants(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).groupBy("type", "name").agg(F.countDistinct("spec").alias("variants")).filter("variants >= 5")


def h45_name_lints(spark: SparkSession, d: str) -> DataFrame:
    e = _e(spark, d).select("row_id", F.explode(Q.name_lints(F.col("name"), F.col("normalized_name"))).alias("lint"))
    return e.groupBy("lint").agg(F.count(F.lit(1)).alias("n"))


def h45_field_rules(spark: SparkSession, d: str) -> DataFrame:
    e = _e(spark, d)
    return e.agg(F.count_if(F.col("quantity") < 0).alias("negative"), F.count_if(~F.col("confidence").between(0, 1)).alias("confidence_range"), F.count_if(~F.col("type").isin(*rules.TYPE_PREFIX)).alias("unknown_type"), F.count_if(F.coalesce(F.trim("name"), F.lit("")) == "").alias("blank_name"))


def h46_reported(spark: SparkSession, d: str) -> DataFrame:
    """Sizes as recorded against sizes as counted."""
    c = _c(spark, d).withColumn("size", F.ceil(F.coalesce(F.length("text"), F.lit(0)) / 2).cast("int"))
    return c.groupBy(F.when(F.col("token_count").isNull(), "null").when(F.col("token_count") == F.col("size"), "equal").otherwise("stale").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def h47_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each chunk in every stage."""
    return Q.stage_counts({"chunks": _c(spark, d).select("chunk_id"), "entities": _e(spark, d).select(F.col("source_chunk_id").alias("chunk_id")), "relationships": _r(spark, d).select(F.col("source_chunk_id").alias("chunk_id")), "edges": _gr(spark, d).select(F.col("source_chunk_id").alias("chunk_id"))}, "chunk_id")


def h48_methods(spark: SparkSession, d: str) -> DataFrame:
    """Entities by type, one column an extractor."""
    return _e(spark, d).filter(F.col("type").isin(*rules.TYPE_PREFIX)).groupBy("type").pivot("source_method", ["llm", "merged", "table_rule"]).agg(F.count(F.lit(1))).na.fill(0)


def h48_methods_all(spark: SparkSession, d: str) -> DataFrame:
    """``h48_methods`` of every row, other spellings of a type counted with it."""
    return _e(spark, d).groupBy(N.known_type(F.col("type")).alias("type")).pivot("source_method", ["llm", "merged", "table_rule"]).agg(F.count(F.lit(1))).na.fill(0)


def h49_unit_classes(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).groupBy(Q.unit_class(F.col("unit")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def h51_orphan_profile(spark: SparkSession, d: str) -> DataFrame:
    g = _g(spark, d).select("id", "type").distinct()
    lone = Q.isolated_edges(_gr(spark, d), g).select("id", F.lit(1).alias("lone")).distinct()
    return g.join(lone, "id", "left").groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count("lone").alias("lone"))


def h53_chunk_groups(spark: SparkSession, d: str) -> DataFrame:
    """Chunks by section and file, numbered in their group; a group of any size is spread over tasks."""
    c = _c(spark, d).select("section_id", "source_file", "chunk_id").distinct()
    return ordering.islands(c.withColumn("__one", F.lit(1)), ["section_id", "source_file"], ["chunk_id"], F.lit(True), "position").drop("__one")


def h59_summary(spark: SparkSession, d: str) -> DataFrame:
    return h31_audit(spark, d).groupBy("band").agg(F.count(F.lit(1)).alias("sections"), F.sum("src_rows").alias("src_rows"), F.sum("got_rows").alias("got_rows"))


def h60_marker_census(spark: SparkSession, d: str) -> DataFrame:
    c = _c(spark, d)
    n = lambda p: F.sum(F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0)))
    return c.groupBy("source_file").agg(n("<!-- SECTION:").alias("sections"), n("<!-- PAGE ").alias("pages"), n("<table").alias("tables"))


def h61_recoverable(spark: SparkSession, d: str) -> DataFrame:
    """Chunks without text whose section has others with text."""
    c = _c(spark, d).select("chunk_id", "section_id", (F.coalesce(F.trim("text"), F.lit("")) == "").alias("blank"))
    s = c.groupBy("section_id").agg(F.bool_or(~F.col("blank")).alias("has_text"))
    return c.filter("blank").join(s, "section_id").select("chunk_id", "has_text")


def h62_lost_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks with relations of which none reached the graph."""
    a = _r(spark, d).select("source_chunk_id").distinct()
    return a.join(_gr(spark, d).select("source_chunk_id").distinct(), "source_chunk_id", "left_anti").filter("source_chunk_id <> ''")


QUERIES = {k: v for k, v in globals().items() if k[:1] == "h" and k[1:3].isdigit()}

_RATIO = lambda name, frm, hit, op: f"SELECT '{name}' AS \"check\", count(*) AS total, count(*) FILTER ({hit}) AS hits, round(CASE WHEN count(*) = 0 THEN 1.0 ELSE CAST(count(*) FILTER ({hit}) AS DOUBLE) / count(*) END, 6) AS ratio, round(CASE WHEN count(*) = 0 THEN 1.0 ELSE CAST(count(*) FILTER ({hit}) AS DOUBLE) / count(*) END, 6) {op} OR count(*) = 0 AS passed FROM {frm}"
_FLAT = "coalesce(array_to_string(flatten(list_transform(tables, lambda t: list_concat(t.headers, flatten(list_transform(t.rows, lambda r: list_transform(map_values(r), lambda c: coalesce(c.s, ''))))))), ' '))"
_ALL = f"concat_ws(' ', text, {_FLAT}, array_to_string(notes, ' '))"
_TYPES = ", ".join(repr(x) for x in rules.TYPE_PREFIX)
_OK = "CASE type " + " ".join(f"WHEN '{r}' THEN source_type IN ({', '.join(repr(x) for x in a)}) AND target_type = '{b}'" for r, (a, b) in rules.DIRECTIONS.items()) + " ELSE true END"
_AUD = "t AS (SELECT split_part(section_id, '#', 1) AS base_id, unnest(tables) AS t FROM graph_chunks), a AS (SELECT base_id, CAST(sum(t.raw_row_count) AS BIGINT) AS src_rows, CAST(sum(t.parsed_row_count) AS BIGINT) AS got_rows FROM t GROUP BY 1), b AS (SELECT *, CASE WHEN src_rows > 0 THEN round(got_rows * 100.0 / src_rows, 2) END AS pct FROM a), x AS (SELECT *, CASE WHEN src_rows = 0 THEN 'extra' WHEN got_rows = 0 THEN 'missing' WHEN pct < 50 THEN 'critical' WHEN pct < 80 THEN 'warn' WHEN pct < 95 THEN 'info' ELSE 'ok' END AS band FROM b)"

SQL = {
    "h01_section_coverage": "WITH c AS (SELECT DISTINCT section_id AS key FROM graph_chunks) SELECT (SELECT count(*) FROM c WHERE key IN (SELECT key FROM toc)) AS mapped, (SELECT count(*) FROM toc WHERE key NOT IN (SELECT key FROM c WHERE key IS NOT NULL)) AS missing, (SELECT count(*) FROM c WHERE key NOT IN (SELECT key FROM toc)) AS extra, round(CAST((SELECT count(*) FROM c WHERE key IN (SELECT key FROM toc)) AS DOUBLE) / (SELECT count(*) FROM toc), 6) AS ratio",
    "h02_table_parse_rate": _RATIO("table_parse_rate", "(SELECT unnest(tables) AS t FROM graph_chunks)", "t.parsed_row_count >= t.raw_row_count", ">= 0.9"),
    "h03_empty_chunks": _RATIO("empty_chunks", "graph_chunks", "coalesce(trim(text, ' '), '') = '' AND coalesce(len(tables), 0) = 0", "<= 0.05"),
    "h05_blank_fields": " UNION ALL ".join(f"SELECT chunk_id, '{f}' AS field FROM graph_chunks WHERE coalesce(trim({f}, ' '), '') = ''" for f in ("section_id", "title", "department", "chapter", "revision_year", "text")),
    "h06_repeated_chunks": "SELECT chunk_id, count(*) AS n FROM graph_chunks GROUP BY 1 HAVING count(*) > 1",
    "h07_departments": "SELECT department, count(*) AS chunks, CAST(sum(coalesce(len(tables), 0)) AS BIGINT) AS tables, count(DISTINCT section_id) AS sections FROM graph_chunks GROUP BY 1",
    "h12_reference_validity": _RATIO("reference_validity", "(SELECT unnest(cross_references) AS x FROM graph_chunks) LEFT JOIN (SELECT DISTINCT id FROM toc) k ON k.id = x.target_section_id", "k.id IS NOT NULL", ">= 1.0"),
    "h13_note_recall": _RATIO("note_recall", "(SELECT section_id, bool_or(coalesce(contains(text, '[주]'), false)) AS m, bool_or(coalesce(len(notes) > 0, false)) AS k FROM graph_chunks GROUP BY 1) WHERE m", "k", ">= 0.95"),
    "h15_isolation": "SELECT section_id, count(DISTINCT department) AS departments FROM graph_chunks GROUP BY 1 HAVING count(DISTINCT department) > 1",
    "h20_sample": "SELECT department, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY department ORDER BY md5(chunk_id), chunk_id) AS r FROM (SELECT DISTINCT department, chunk_id FROM graph_chunks)) WHERE r <= 20",
    "h21_chunk_coverage": _RATIO("chunk_coverage", "(SELECT DISTINCT chunk_id FROM graph_chunks)", "chunk_id IN (SELECT source_chunk_id FROM entities WHERE source_chunk_id IS NOT NULL)", ">= 0.9"),
    "h22_edge_integrity": "SELECT state, count(*) AS n FROM (SELECT CASE WHEN s.id IS NOT NULL AND t.id IS NOT NULL THEN 'ok' WHEN s.id IS NOT NULL THEN 'target' WHEN t.id IS NOT NULL THEN 'source' ELSE 'both' END AS state FROM graph_relationships r LEFT JOIN (SELECT DISTINCT id FROM graph_entities) s ON s.id = r.source_id LEFT JOIN (SELECT DISTINCT id FROM graph_entities) t ON t.id = r.target_id) GROUP BY 1",
    "h23_units": _RATIO("quantity_units", "relationships WHERE quantity <> 0", "coalesce(trim(unit, ' '), '') <> ''", ">= 0.95"),
    "h24_isolated": "SELECT type, count(*) AS n FROM (SELECT DISTINCT id, type FROM graph_entities g WHERE NOT EXISTS (SELECT 1 FROM graph_relationships r WHERE r.source_id = g.id) AND NOT EXISTS (SELECT 1 FROM graph_relationships r WHERE r.target_id = g.id)) GROUP BY 1",
    "h25_name_stages": rf"""WITH c AS (SELECT chunk_id, decode(max(encode({_ALL}))) AS t FROM graph_chunks GROUP BY 1), e AS (SELECT name, lower(regexp_replace(t, '\s+', '', 'g')) AS t, regexp_replace(name, '\([^)]*\)', '', 'g') AS bare FROM entities JOIN c ON c.chunk_id = source_chunk_id),
        f AS (SELECT t, name, lower(regexp_replace(name, '\s+', '', 'g')) AS n1, lower(regexp_replace(bare, '\s+', '', 'g')) AS n2, lower(regexp_replace(regexp_replace(bare, '[\d.,]+\s*(?:mm|cm|m|kg|t|kW|%)?', '', 'g'), '\s+', '', 'g')) AS n3, list_filter(regexp_split_to_array(name, '[\s()/·,]+'), lambda w: length(w) >= 2) AS ws FROM e)
        SELECT CASE WHEN contains(t, n1) THEN 'exact' WHEN n2 <> '' AND contains(t, n2) THEN 'no_parens' WHEN length(n3) >= 2 AND contains(t, n3) THEN 'no_numbers' WHEN len(ws) > 0 AND len(list_filter(ws, lambda w: NOT contains(t, lower(w)))) = 0 THEN 'words' WHEN length(n1) >= 4 AND contains(t, substr(n1, 1, 4)) THEN 'prefix' ELSE 'none' END AS stage, count(*) AS n FROM f GROUP BY 1""",
    "h31_audit": f"WITH {_AUD} SELECT base_id, src_rows, got_rows, pct, band FROM x",
    "h36_counts": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in ("toc", "graph_chunks", "entities", "relationships", "graph_entities", "graph_relationships", "documents")),
    "h37_top_names": "SELECT target, count(*) AS n FROM relationships WHERE target IS NOT NULL GROUP BY 1 ORDER BY n DESC, encode(target) LIMIT 10",
    "h38_orphan_ends": "SELECT count(*) AS n, 'source' AS \"end\" FROM graph_relationships r WHERE NOT EXISTS (SELECT 1 FROM graph_entities g WHERE g.id = r.source_id) UNION ALL SELECT count(*), 'target' FROM graph_relationships r WHERE NOT EXISTS (SELECT 1 FROM graph_entities g WHERE g.id = r.target_id)",
    "h39_nulls": " UNION ALL ".join(f"SELECT '{f}' AS field, count({f}) AS filled, count(*) - count({f}) AS empty FROM graph_entities" for f in ("id", "name", "type", "source_section", "embedding", "is_active")),
    "h40_dimensions": "SELECT CAST(len(embedding) AS INT) AS dims, count(*) AS n FROM graph_entities WHERE embedding IS NOT NULL GROUP BY 1",
    "h41_labour_range": _RATIO("labour_range", "relationships WHERE type = 'REQUIRES_LABOR' AND quantity IS NOT NULL", "quantity BETWEEN 0.001 AND 100", ">= 0.95"),
    "h42_same_chunk_ends": _RATIO("same_chunk_source", "(SELECT DISTINCT rel_id, source_chunk_id, source FROM relationships) r", "EXISTS (SELECT 1 FROM entities e WHERE e.source_chunk_id = r.source_chunk_id AND (e.name = r.source OR e.normalized_name = r.source))", ">= 0.95").replace("count(*) FILTER (EXISTS", "count(*) FILTER (EXISTS"),
    "h43_directions": _RATIO("directions", "relationships", f"coalesce({_OK}, false)", ">= 0.95"),
    "h44_spec_variants": "SELECT type, name, count(DISTINCT spec) AS variants FROM entities GROUP BY 1, 2 HAVING count(DISTINCT spec) >= 5",
    "h45_name_lints": r"""WITH l AS (SELECT 'double_space' AS lint, regexp_matches(name, '\s{2,}') AS b FROM entities UNION ALL SELECT 'edges', regexp_matches(name, '^\s|\s$') FROM entities UNION ALL SELECT 'space_in_normal', contains(normalized_name, ' ') FROM entities UNION ALL SELECT 'one_char', length(trim(name, ' ')) = 1 FROM entities
        UNION ALL SELECT 'long', length(name) > 200 FROM entities UNION ALL SELECT 'control', regexp_matches(name, '[\x00-\x08\x0b-\x1f]') FROM entities UNION ALL SELECT 'wide_parens', regexp_matches(name, '[（）]') FROM entities UNION ALL SELECT 'blank', trim(name, ' ') = '' FROM entities) SELECT lint, count(*) AS n FROM l WHERE b GROUP BY 1""",
    "h45_field_rules": f"SELECT count(*) FILTER (quantity < 0) AS negative, count(*) FILTER (NOT confidence BETWEEN 0 AND 1) AS confidence_range, count(*) FILTER (type NOT IN ({_TYPES})) AS unknown_type, count(*) FILTER (coalesce(trim(name, ' '), '') = '') AS blank_name FROM entities",
    "h46_reported": "SELECT CASE WHEN token_count IS NULL THEN 'null' WHEN token_count = ceil(coalesce(length(text), 0) / 2.0) THEN 'equal' ELSE 'stale' END AS state, count(*) AS n FROM graph_chunks GROUP BY 1",
    "h47_lineage": "WITH u AS (SELECT chunk_id, 1 a, 0 b, 0 c, 0 e FROM graph_chunks UNION ALL SELECT source_chunk_id, 0, 1, 0, 0 FROM entities UNION ALL SELECT source_chunk_id, 0, 0, 1, 0 FROM relationships UNION ALL SELECT source_chunk_id, 0, 0, 0, 1 FROM graph_relationships) SELECT chunk_id, CAST(sum(a) AS BIGINT) AS chunks, CAST(sum(b) AS BIGINT) AS entities, CAST(sum(c) AS BIGINT) AS relationships, CAST(sum(e) AS BIGINT) AS edges FROM u GROUP BY 1",
    "h48_methods_all": f"SELECT coalesce(CASE lower(regexp_replace(type, '[^\\p{{L}}\\p{{N}}]', '', 'g')) WHEN 'worktype' THEN 'WorkType' WHEN 'labor' THEN 'Labor' WHEN 'equipment' THEN 'Equipment' WHEN 'material' THEN 'Material' WHEN 'section' THEN 'Section' WHEN 'note' THEN 'Note' WHEN 'standard' THEN 'Standard' END, type) AS type, count(*) FILTER (source_method = 'llm') AS llm, count(*) FILTER (source_method = 'merged') AS merged, count(*) FILTER (source_method = 'table_rule') AS table_rule FROM entities GROUP BY 1",
    "h48_methods": f"SELECT type, count(*) FILTER (source_method = 'llm') AS llm, count(*) FILTER (source_method = 'merged') AS merged, count(*) FILTER (source_method = 'table_rule') AS table_rule FROM entities WHERE type IN ({_TYPES}) GROUP BY 1",
    "h49_unit_classes": "SELECT CASE WHEN coalesce(trim(unit, ' '), '') = '' THEN 'blank' WHEN contains(unit, '/') THEN 'compound' WHEN regexp_matches(unit, '[가-힣]') THEN 'hangul' WHEN regexp_full_match(unit, '[A-Za-z0-9 .,]+') THEN 'latin' ELSE 'symbol' END AS kind, count(*) AS n FROM entities GROUP BY 1",
    "h51_orphan_profile": "WITH g AS (SELECT DISTINCT id, type FROM graph_entities) SELECT type, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM graph_relationships r WHERE r.source_id = g.id) AND NOT EXISTS (SELECT 1 FROM graph_relationships r WHERE r.target_id = g.id)) AS lone FROM g GROUP BY 1",
    "h28_strict": rf"""WITH c AS (SELECT chunk_id, lower(regexp_replace(decode(max(encode({_ALL}))), '\s+', '', 'g')) AS t FROM graph_chunks GROUP BY 1),
        e AS (SELECT row_id, type, t, lower(name) AS n FROM entities LEFT JOIN c ON chunk_id = source_chunk_id)
        SELECT type = 'Note' OR coalesce(len(list_filter(regexp_split_to_array(n, '[^0-9a-z_가-힣]+'), lambda w: length(w) >= 2 AND contains(t, w))) > 0 OR contains(t, regexp_replace(n, '\s+', '', 'g')), false) AS valid, count(*) AS n FROM e GROUP BY 1""",
    "h29_quantity_evidence": rf"""WITH c AS (SELECT chunk_id, regexp_replace(decode(max(encode({_ALL}))), '[\s,]+', '', 'g') AS t FROM graph_chunks GROUP BY 1), r AS (SELECT DISTINCT rel_id, CAST(quantity AS VARCHAR) AS q, source_chunk_id FROM relationships WHERE quantity IS NOT NULL)
        SELECT contains(t, q) OR contains(t, regexp_replace(q, '\.0$', '')) AS seen, count(*) AS n FROM r JOIN c ON chunk_id = source_chunk_id GROUP BY 1""",
    "h53_chunk_groups": "SELECT *, row_number() OVER (PARTITION BY section_id, source_file ORDER BY chunk_id) AS position FROM (SELECT DISTINCT section_id, source_file, chunk_id FROM graph_chunks)",
    "h59_summary": f"WITH {_AUD} SELECT band, count(*) AS sections, CAST(sum(src_rows) AS BIGINT) AS src_rows, CAST(sum(got_rows) AS BIGINT) AS got_rows FROM x GROUP BY 1",
    "h60_marker_census": "SELECT source_file, CAST(sum(coalesce(len(regexp_extract_all(text, '<!-- SECTION:')), 0)) AS BIGINT) AS sections, CAST(sum(coalesce(len(regexp_extract_all(text, '<!-- PAGE ')), 0)) AS BIGINT) AS pages, CAST(sum(coalesce(len(regexp_extract_all(text, '<table')), 0)) AS BIGINT) AS tables FROM graph_chunks GROUP BY 1",
    "h61_recoverable": "SELECT chunk_id, EXISTS (SELECT 1 FROM graph_chunks o WHERE o.section_id = c.section_id AND trim(o.text, ' ') <> '') AS has_text FROM graph_chunks c WHERE coalesce(trim(text, ' '), '') = ''",
    "h62_lost_chunks": "SELECT DISTINCT source_chunk_id FROM relationships WHERE source_chunk_id <> '' AND source_chunk_id NOT IN (SELECT source_chunk_id FROM graph_relationships WHERE source_chunk_id IS NOT NULL)",
}
SQL["h08_report"] = " UNION ALL ".join(SQL[k] for k in ("h02_table_parse_rate", "h03_empty_chunks", "h21_chunk_coverage", "h23_units"))
SQL["h27_verdict"] = f"SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS failed, count(*) AS checks FROM ({SQL['h08_report']})"
