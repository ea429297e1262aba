"""Queries of composed stages: chunking, extraction, graph building, repairs of stored tables, more search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lodegraph.operators import chunking, extract, normalise as N, quality as Q, relations as R, retrieval as V, segments, tables as T
from lodegraph.operators.ordering import latest
from lodegraph.plans import pipeline as P
from lodegraph.plans.session import load


def _one_chunk(spark, d):
    """Chunks, repeated deliveries once."""
    return latest(load(spark, d, "graph_chunks"), ["chunk_id"], [F.desc("created_at")])


def a19_restore_tables(spark: SparkSession, d: str) -> DataFrame:
    """Stored tables a local copy lacks are put back: sections whose chunks were cut to their first table."""
    t = load(spark, d, "graph_chunks").select("section_id", F.explode("tables").alias("t")).select("section_id", T.signature(F.col("t")).alias("sig"))
    local = load(spark, d, "graph_chunks").select("section_id", T.signature(F.get("tables", F.lit(0))).alias("sig")).filter("sig is not null")
    return t.distinct().join(local.distinct(), ["section_id", "sig"], "left_anti").groupBy("section_id").agg(F.count(F.lit(1)).alias("restored"))


def a20_repair_targets(spark: SparkSession, d: str) -> DataFrame:
    """For each base section the chunk with the fewest tables, which takes a missing one."""
    c = load(spark, d, "graph_chunks").select(segments.base_id(F.col("section_id")).alias("base_id"), "chunk_id", F.coalesce(F.size("tables"), F.lit(0)).alias("n"))
    return c.groupBy("base_id").agg(F.min(F.struct("n", "chunk_id")).alias("o")).select("base_id", F.col("o.chunk_id").alias("target"), F.col("o.n").alias("tables"))


def a21_new_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Rows for contents entries without a chunk, numbered by key."""
    miss = load(spark, d, "toc").select("key", "title").join(load(spark, d, "graph_chunks").select(F.col("section_id").alias("key")).distinct(), "key", "left_anti")
    from lodegraph.operators.ordering import global_row_number

    return global_row_number(miss, ["key"]).select(F.format_string("C-NEW-%04d", F.col("row_no")).alias("chunk_id"), "key", F.substring("title", 1, 500).alias("text"))


def a26_outside_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Text lines (events) that lie in no box (other events) of their page (user): boxes of a page are merged to
    intervals first, then each line is held against the last one that starts before it."""
    e = load(spark, d, "events").select("user_id", "event_id", "event_type", F.round("value", 3).alias("y"))
    kind = e.agg(F.min("event_type").alias("k")).first().k
    boxes = e.filter(F.col("event_type") == kind).select("user_id", "y", F.round(F.col("y") + 2.0, 3).alias("y1"))
    w = Window.partitionBy("user_id").orderBy("y", "y1").rowsBetween(Window.unboundedPreceding, 0)
    boxes = boxes.withColumn("foot", F.max("y1").over(w))
    from lodegraph.operators.ordering import asof_join

    lines = e.filter(F.col("event_type") != kind).select("user_id", "event_id", "y")
    return asof_join(lines, boxes, ["user_id"], "y", ["foot"]).filter("asof_foot is null or asof_foot < y").select("user_id", "event_id")


def a30_usage(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "graph_chunks")
    return c.groupBy("department").agg(F.count(F.lit(1)).alias("calls"), F.sum(F.coalesce("token_count", F.lit(0))).alias("tokens"))


def b18_inject_markers(spark: SparkSession, d: str) -> DataFrame:
    """A marker before each line that starts with a three-level id; the contents' own lines are the input."""
    t = load(spark, d, "toc").select("key", F.concat_ws("\n", F.concat_ws(" ", "id", "title"), F.lit("body")).alias("text"))
    return t.select("key", segments.inject_markers(F.col("text")).alias("text"))


def b19_footers(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "graph_chunks").select("chunk_id", F.concat_ws(" | ", "department", "chapter", F.col("page").cast("string")).alias("line"))
    return c.select("chunk_id", *segments.footer_fields(F.col("line")))


def c22_material_names(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", T.material_name(F.col("p_name")).alias("name"))


def c26_first_grid(spark: SparkSession, d: str) -> DataFrame:
    return T.grids(load(spark, d, "documents").select("doc_id", "text"), "doc_id").filter("table_no = 1").select("doc_id", F.size("grid").alias("rows"))


def c30_base_ids(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "graph_chunks")
    return c.select("chunk_id", F.regexp_replace(segments.base_id(F.col("section_id")), r"-[A-F]$", "").alias("base_id"))


def d12_table_groups(spark: SparkSession, d: str) -> DataFrame:
    """Tables packed under 60: rows of a chunk before and after."""
    c = _one_chunk(spark, d).filter("size(tables) > 0").select("chunk_id", F.explode(chunking.table_groups(F.col("tables"), 60)).alias("g"))
    return c.groupBy("chunk_id").agg(F.sum(F.aggregate("g", F.lit(0), lambda a, t: a + F.size(t["rows"]))).alias("n_rows"))


def d13_section_parts(spark: SparkSession, d: str) -> DataFrame:
    """Sections cut to parts at the real limit: which strategy each took, and what its parts hold in all."""
    parts = chunking.section_parts(_one_chunk(spark, d).select("chunk_id", "text", "tables", "notes"))
    rows = F.coalesce(F.aggregate("tables", F.lit(0), lambda a, t: a + F.size(t["rows"])), F.lit(0))
    letters = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", ""))
    p = parts.select("chunk_id", "part_no", "n_parts", rows.alias("r"), letters.alias("c"), F.coalesce(F.size("notes"), F.lit(0)).alias("n"), (F.coalesce(F.size("tables"), F.lit(0)) > 0).alias("t"))
    lone = F.sum(F.when(F.col("t") & (F.col("c") > 0), 1).otherwise(0)) == 0
    return p.groupBy("chunk_id").agg((F.max("n_parts") > 1).alias("cut"), F.sum("r").alias("n_rows"), F.sum("c").alias("n_letters"), F.sum("n").alias("n_notes"), (F.sum(F.when(F.col("part_no") == 1, F.col("n"))) == F.sum("n")).alias("notes_first"), lone.alias("tables_alone"))


def d14_chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of sections in order of their id, without the letters of the parts."""
    parts = chunking.section_parts(_one_chunk(spark, d).select("chunk_id", "text", "tables").withColumnRenamed("chunk_id", "sec"), 300)
    return chunking.number_chunks(parts, ["sec"]).select("sec", F.regexp_replace("chunk_id", r"-[A-Z0-9]+$", "").alias("x"), F.substring("chunk_id", 1, 6).alias("number")).select("sec", "number").distinct()


def e02_role_map(spark: SparkSession, d: str) -> DataFrame:
    return extract.table_cells(_one_chunk(spark, d)).filter("row_no = 1").groupBy("chunk_id", "table_id", "role").agg(F.count(F.lit(1)).alias("n"), F.min("col_no").alias("first_col"))


def e14_extract(spark: SparkSession, d: str) -> DataFrame:
    """Entities and relations of all chunks by the table extractor, counted by type."""
    e, r = P.extract_graph(_one_chunk(spark, d))
    a = e.groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("entity"))
    return a.unionByName(r.groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("relation")))


def e21_finalise(spark: SparkSession, d: str) -> DataFrame:
    """Chunks by how many entities each extractor gave them."""
    e = load(spark, d, "entities").filter("source_chunk_id <> ''").groupBy("source_chunk_id", "source_method").agg(F.count(F.lit(1)).alias("n"))
    return e.groupBy("source_method").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("entities"), F.max("n").alias("most"))


def f12_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Rows of low confidence against verdicts (here: the same record elsewhere with high confidence)."""
    e = load(spark, d, "entities")
    verdict = e.filter("confidence >= 0.9").select("type", "normalized_name").distinct().withColumn("ok", F.lit(True))
    q = e.filter("confidence < 0.55").join(verdict, ["type", "normalized_name"], "left")
    return q.groupBy(F.when(F.col("ok"), "recovered").otherwise("discarded").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def g01_build_graph(spark: SparkSession, d: str) -> DataFrame:
    """Edges of the graph built from all mentions, by relation."""
    return P.build_graph(load(spark, d, "entities"), load(spark, d, "relationships"))[1].groupBy("relation").agg(F.count(F.lit(1)).alias("edges"), F.sum("mentions").alias("mentions"))


def h26_sample(spark: SparkSession, d: str) -> DataFrame:
    """Stratified sample for a scorer: about 100 rows, each type by its share."""
    return Q.proportional_sample(load(spark, d, "entities").filter("type is not null").select("row_id", "type"), "type", "row_id", 100)


def h52_source_text(spark: SparkSession, d: str) -> DataFrame:
    """Text of each (section, file); of repeated deliveries the last."""
    c = latest(load(spark, d, "graph_chunks"), ["section_id", "source_file"], [F.desc("created_at"), F.desc("chunk_id")])
    return c.select("section_id", "source_file", "chunk_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))


def h55_source_cells(spark: SparkSession, d: str) -> DataFrame:
    g = T.grids(load(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return g.groupBy("doc_id").agg(F.sum(F.size(F.filter(F.flatten("grid"), lambda c: c != ""))).alias("cells"))


def h57_fact_search(spark: SparkSession, d: str) -> DataFrame:
    """One fact (a name with its quantity) followed through entities and relationships."""
    e = load(spark, d, "entities").filter("quantity is not null").select("name", "quantity").distinct()
    r = load(spark, d, "relationships").filter("quantity is not null").select(F.col("target").alias("name"), "quantity").distinct()
    return e.join(r.withColumn("in_relations", F.lit(True)), ["name", "quantity"], "left").groupBy("in_relations").agg(F.count(F.lit(1)).alias("n"))


def i03_section_chunks(spark: SparkSession, d: str) -> DataFrame:
    """For every section the two chunks nearest to its first one, in the section itself."""
    c = _one_chunk(spark, d).filter(V.valid_vector(F.col("embedding"), 64))
    first = c.groupBy("section_id").agg(F.min_by("embedding", "chunk_id").alias("vector"))
    return V.sections_top_chunks(first, c).select("section_id", "chunk_id", F.round("similarity", 4).alias("similarity"), "rank")


def j06_abbreviations(spark: SparkSession, d: str) -> DataFrame:
    """Titles with the names an abbreviation in them stands for."""
    short = {"PE": "polyethylene", "PVC": "polyvinyl", "SCH": "schedule", "DN": "nominal"}
    e = load(spark, d, "entities").filter("spec is not null").select("row_id", F.upper("spec").alias("s"))
    hits = F.array_compact(F.array(*[F.when(F.col("s").contains(k), F.lit(v)) for k, v in short.items()]))
    return e.select("row_id", F.explode(hits).alias("alias"))


def j16_own_terms(spark: SparkSession, d: str) -> DataFrame:
    """Words of a title that the section's name neither holds nor is held by."""
    t = load(spark, d, "toc").select("key", V.words(F.col("title")).alias("w"), F.lower("section").alias("s"))
    return t.select("key", F.array_join(F.array_sort(V.drop_contained_terms(F.col("w"), F.col("s"))), " ").alias("terms"))


def j17_penalty(spark: SparkSession, d: str) -> DataFrame:
    """Section nodes without chunks lose 0.3."""
    n = load(spark, d, "graph_entities").filter("type = 'Section'").select("id", "source_section").distinct()
    c = load(spark, d, "graph_chunks").select(F.col("section_id").alias("source_section"), F.lit(True).alias("has")).distinct()
    return n.join(c, "source_section", "left").select("id", F.when(F.col("has"), F.lit(0.8)).otherwise(F.lit(0.5)).alias("similarity"))


def j20_scores(spark: SparkSession, d: str) -> DataFrame:
    """Works and sections for each title, scored: 50 exact, 30 all words, 10 a word, 5 less for sections."""
    q = load(spark, d, "toc").select(F.col("key").alias("qid"), F.col("title").alias("question"))
    n = load(spark, d, "graph_entities").filter("coalesce(is_active, true) and type in ('WorkType', 'Section')").groupBy("id").agg(F.min("name").alias("name"), F.min("type").alias("type"))
    h = V.keyword_hits(q, n).join(n, "id").join(q, "qid")
    score = F.when(F.col("name") == F.col("question"), 50).when(F.col("hits") == F.col("asked"), 30).otherwise(10) - F.when(F.col("type") == "Section", 5).otherwise(0)
    return h.groupBy("qid").agg(F.max(score).alias("best"), F.count(F.lit(1)).alias("found"))


def j21_section_resolve(spark: SparkSession, d: str) -> DataFrame:
    """For each section: its works, its sub-sections, its notes."""
    e = load(spark, d, "entities").filter("source_section_id is not null")
    return e.groupBy("source_section_id").agg(F.count_if(F.col("type") == "WorkType").alias("works"), F.countDistinct(F.when(F.trim("sub_section") != "", F.col("sub_section"))).alias("sub_sections"), F.count_if(F.col("type") == "Note").alias("notes"))


def k01_expand(spark: SparkSession, d: str) -> DataFrame:
    """Everything around a node at once: outgoing edges, virtual edges to siblings."""
    n = load(spark, d, "graph_entities").filter("coalesce(is_active, true)").groupBy("id").agg(F.min("name").alias("name"), F.min("type").alias("type"), F.min("source_section").alias("source_section"))
    e = load(spark, d, "graph_relationships").select("source_id", "target_id", "relation").distinct()
    out = V.one_hop(e, n, n.select("id")).select("id", "relation", "related_id")
    sib = V.siblings(n, e).select(F.col("section").alias("id"), F.lit("CONTAINS_WORK").alias("relation"), F.col("work").alias("related_id"))
    return out.unionByName(sib).groupBy("relation").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("sources"))


def k18_usage(spark: SparkSession, d: str) -> DataFrame:
    """Per department: chunks, their estimated tokens, sections."""
    c = load(spark, d, "graph_chunks")
    return c.groupBy("department").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.ceil(F.coalesce(F.length("text"), F.lit(0)) / 2)).alias("tokens"), F.countDistinct("section_id").alias("sections"))


QUERIES = {k: v for k, v in globals().items() if k[:1] in "abcdefghijk" and k[1:3].isdigit()}

_ONE = "one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY created_at DESC) AS rn FROM graph_chunks) WHERE rn = 1)"
_SIG = "{0}.headers, list_transform({0}.rows, lambda r: list_sort(list_transform(map_entries(r), lambda e: e.key || '=' || coalesce(e.value.s, ''))))"
_W = lambda c: f"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^0-9a-z가-힣]+'), lambda w: length(w) >= 2))"
_N = "n AS (SELECT id, decode(min(encode(name))) AS name, min(type) AS type, min(source_section) AS source_section FROM graph_entities WHERE coalesce(is_active, true) GROUP BY 1), e AS (SELECT DISTINCT source_id, target_id, relation FROM graph_relationships)"

SQL = {
    "a19_restore_tables": f"""WITH t AS (SELECT section_id, unnest(tables) AS t FROM graph_chunks), s AS (SELECT DISTINCT section_id, {_SIG.format('t')[:9]} AS h, {_SIG.format('t')[11:]} AS r FROM t), l AS (SELECT DISTINCT section_id, t.headers AS h, {_SIG.format('t')[11:]} AS r FROM (SELECT section_id, tables[1] AS t FROM graph_chunks WHERE len(tables) > 0))
        SELECT section_id, count(*) AS restored FROM (SELECT * FROM s EXCEPT SELECT * FROM l) GROUP BY 1""",
    "a20_repair_targets": "SELECT base_id, (arg_min(chunk_id, (n, chunk_id))) AS target, CAST(min(n) AS INT) AS tables FROM (SELECT trim(split_part(section_id, '#', 1)) AS base_id, chunk_id, coalesce(len(tables), 0) AS n FROM graph_chunks) GROUP BY 1",
    "a21_new_chunks": "SELECT 'C-NEW-' || lpad(CAST(row_number() OVER (ORDER BY encode(key)) AS VARCHAR), 4, '0') AS chunk_id, key, substr(title, 1, 500) AS text FROM toc WHERE key NOT IN (SELECT section_id FROM graph_chunks WHERE section_id IS NOT NULL)",
    "a26_outside_boxes": "WITH e AS (SELECT user_id, event_id, event_type, round(value, 3) AS y FROM events), k AS (SELECT min(event_type) AS k FROM events) SELECT user_id, event_id FROM e l WHERE event_type <> (SELECT k FROM k) AND NOT EXISTS (SELECT 1 FROM e b WHERE b.event_type = (SELECT k FROM k) AND b.user_id = l.user_id AND b.y <= l.y AND round(b.y + 2.0, 3) >= l.y)",
    "a30_usage": "SELECT department, count(*) AS calls, CAST(sum(coalesce(token_count, 0)) AS BIGINT) AS tokens FROM graph_chunks GROUP BY 1",
    "b18_inject_markers": r"SELECT key, CASE WHEN regexp_matches(id, '^\d{1,2}-\d{1,2}-\d{1,3}$') THEN '<!-- SECTION: ' || id || ' | ' || title || ' -->' || chr(10) ELSE '' END || id || ' ' || title || chr(10) || 'body' AS text FROM toc",
    "b19_footers": r"SELECT chunk_id, nullif(regexp_extract(department, '([^ \t\n]+부문)', 1), '') AS department, nullif(regexp_extract(chapter || CASE WHEN page IS NULL THEN '' ELSE ' ' END, '(제\s*\d+\s*장[^\d|]*)', 1), '') AS chapter, CASE WHEN page IS NOT NULL THEN CAST(page AS VARCHAR) END AS page FROM graph_chunks",
    "c30_base_ids": "SELECT chunk_id, regexp_replace(trim(split_part(section_id, '#', 1)), '-[A-F]$', '') AS base_id FROM graph_chunks",
    "c22_material_names": r"SELECT p_partkey, regexp_replace(regexp_replace(p_name, '\s+', '', 'g'), '^(.+?)((?:KSD?|SCH|STD)[-\w]*)$', '\1(\2)') AS name FROM part",
    "d12_table_groups": f"WITH {_ONE} SELECT chunk_id, CAST(list_sum(list_transform(tables, lambda t: len(t.rows))) AS BIGINT) AS n_rows FROM one WHERE len(tables) > 0",
    "i03_section_chunks": f"""WITH {_ONE}, c AS (SELECT section_id, chunk_id, CAST(embedding AS DOUBLE[]) AS e FROM one WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0), q AS (SELECT section_id, arg_min(e, chunk_id) AS v FROM c GROUP BY 1),
        s AS (SELECT section_id, chunk_id, list_cosine_similarity(e, v) AS s FROM c JOIN q USING (section_id) WHERE list_sum(list_transform(e, lambda x: x * x)) > 0 AND list_sum(list_transform(v, lambda x: x * x)) > 0)
        SELECT section_id, chunk_id, round(s, 4) AS similarity, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY section_id ORDER BY round(s, 9) DESC, chunk_id) AS rank FROM s) WHERE rank <= 2""",
    "d13_section_parts": f"""WITH {_ONE}, tok AS (SELECT *, len(tables) AS nt, ceil(coalesce(length(text), 0) / 2.0) AS tx, coalesce(list_sum(list_transform(tables, lambda t: coalesce(list_sum(list_transform(t.rows, lambda r: coalesce(list_sum(list_transform(map_values(r), lambda c: ceil(coalesce(length(c.s), 0) / 2.0))), 0))), 0))), 0) AS tt,
            coalesce(list_sum(list_transform(notes, lambda n: ceil(length(n) / 2.0))), 0) AS nn, length(regexp_replace(coalesce(text, ''), '\\s+', '', 'g')) AS c FROM one)
        SELECT chunk_id, tx + tt + nn > 1500 AND NOT (coalesce(nt, 0) = 0 AND (tx <= 1500 OR len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) <= 1)) AND NOT (nt > 1 AND tt <= 1500 AND (tx <= 1500 OR len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) <= 1)) AND NOT (nt = 1 AND tt <= 1500 AND (tx <= greatest(1500 - tt, 300) OR len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) <= 1)) AS cut,
        CAST(coalesce(list_sum(list_transform(tables, lambda t: len(t.rows))), 0) AS BIGINT) AS n_rows, CAST(c AS BIGINT) AS n_letters, CAST(coalesce(len(notes), 0) AS BIGINT) AS n_notes, true AS notes_first, coalesce(nt, 0) = 0 OR c = 0 OR tx + tt + nn > 1500 AND nt = 1 AND tt > 1500 AS tables_alone FROM tok""",
    "d14_chunk_ids": f"WITH {_ONE} SELECT chunk_id AS sec, 'C-' || lpad(CAST(row_number() OVER (ORDER BY chunk_id) AS VARCHAR), 4, '0') AS number FROM one WHERE coalesce(trim(text, ' '), '') <> '' OR len(tables) > 0",
    "e21_finalise": "SELECT source_method, count(*) AS chunks, CAST(sum(n) AS BIGINT) AS entities, max(n) AS most FROM (SELECT source_chunk_id, source_method, count(*) AS n FROM entities WHERE source_chunk_id <> '' GROUP BY 1, 2) GROUP BY 1",
    "f12_quarantine": "WITH v AS (SELECT DISTINCT type, normalized_name FROM entities WHERE confidence >= 0.9) SELECT CASE WHEN EXISTS (SELECT 1 FROM v WHERE v.type = e.type AND v.normalized_name = e.normalized_name) THEN 'recovered' ELSE 'discarded' END AS state, count(*) AS n FROM entities e WHERE confidence < 0.55 GROUP BY 1",
    "h26_sample": "WITH s AS (SELECT type, count(*) AS n, greatest(1, floor(count(*) * 100.0 / sum(count(*)) OVER ())) AS q FROM entities WHERE type IS NOT NULL GROUP BY 1), r AS (SELECT row_id, type, row_number() OVER (PARTITION BY type ORDER BY md5(CAST(row_id AS VARCHAR)), row_id) AS rn FROM entities WHERE type IS NOT NULL) SELECT row_id, r.type FROM r JOIN s USING (type) WHERE rn <= q",
    "h52_source_text": "SELECT section_id, source_file, chunk_id, CAST(coalesce(length(text), 0) AS INT) AS chars FROM (SELECT *, row_number() OVER (PARTITION BY section_id, source_file ORDER BY created_at DESC, chunk_id DESC) AS rn FROM graph_chunks) WHERE rn = 1",
    "h57_fact_search": "WITH r AS (SELECT DISTINCT target, quantity FROM relationships WHERE quantity IS NOT NULL) SELECT CASE WHEN r.target IS NOT NULL THEN true END AS in_relations, count(*) AS n FROM (SELECT DISTINCT name, quantity FROM entities WHERE quantity IS NOT NULL) e LEFT JOIN r ON r.target = e.name AND r.quantity = e.quantity GROUP BY 1",
    "j06_abbreviations": "SELECT row_id, v AS alias FROM entities, (VALUES ('PE', 'polyethylene'), ('PVC', 'polyvinyl'), ('SCH', 'schedule'), ('DN', 'nominal')) AS a(k, v) WHERE contains(upper(spec), k)",
    "j16_own_terms": f"SELECT key, array_to_string(list_sort(list_filter({_W('title')}, lambda w: NOT (contains(lower(section), w) OR contains(w, lower(section))))), ' ') AS terms FROM toc",
    "j17_penalty": "SELECT id, CAST(CASE WHEN source_section IN (SELECT section_id FROM graph_chunks) THEN 0.8 ELSE 0.5 END AS DOUBLE) AS similarity FROM (SELECT DISTINCT id, source_section FROM graph_entities WHERE type = 'Section')",
    "j20_scores": f"""WITH n AS (SELECT id, decode(min(encode(name))) AS name, min(type) AS type FROM graph_entities WHERE coalesce(is_active, true) AND type IN ('WorkType', 'Section') GROUP BY 1), q AS (SELECT key AS qid, title, {_W('title')} AS ws FROM toc), qw AS (SELECT qid, title, len(ws) AS asked, unnest(ws) AS w FROM q), nw AS (SELECT id, name, type, unnest({_W('name')}) AS w FROM n),
        h AS (SELECT qid, title, asked, id, name, type, count(*) AS hits FROM qw JOIN nw USING (w) GROUP BY ALL) SELECT qid, CAST(max(CASE WHEN name = title THEN 50 WHEN hits = asked THEN 30 ELSE 10 END - CASE WHEN type = 'Section' THEN 5 ELSE 0 END) AS INT) AS best, count(*) AS found FROM h GROUP BY 1""",
    "j21_section_resolve": "SELECT source_section_id, count(*) FILTER (type = 'WorkType') AS works, count(DISTINCT CASE WHEN trim(sub_section, ' ') <> '' THEN sub_section END) AS sub_sections, count(*) FILTER (type = 'Note') AS notes FROM entities WHERE source_section_id IS NOT NULL GROUP BY 1",
    "k01_expand": f"""WITH {_N}, o AS (SELECT s.id, e.relation, t.id AS related_id FROM n s JOIN e ON e.source_id = s.id JOIN n t ON t.id = e.target_id), s AS (SELECT source_section, min(id) AS section FROM n WHERE type = 'Section' AND source_section IS NOT NULL GROUP BY 1), p AS (SELECT section, n.id AS work, n.name FROM n JOIN s USING (source_section) WHERE n.type = 'WorkType'),
        v AS (SELECT section, work FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY encode(name), work) AS rn FROM p WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.target_id = p.section AND e.source_id = p.work)) WHERE rn <= 30)
        SELECT relation, count(*) AS n, count(DISTINCT id) AS sources FROM (SELECT * FROM o UNION ALL SELECT section, 'CONTAINS_WORK', work FROM v) GROUP BY 1""",
    "k18_usage": "SELECT department, count(*) AS chunks, CAST(sum(ceil(coalesce(length(text), 0) / 2.0)) AS BIGINT) AS tokens, count(DISTINCT section_id) AS sections FROM graph_chunks GROUP BY 1",
}
