"""Queries of the sources and of document segmentation (operators A and B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lodegraph.operators import ordering, segments
from lodegraph.plans.session import load
from lodegraph.sources import stores


def a03_toc_parse(spark: SparkSession, d: str) -> DataFrame:
    """Write the contents as text lines, then read them back with carried division and chapter."""
    return segments.parse_toc_lines(segments.toc_lines(load(spark, d, "toc")))


def a04_page_specs(spark: SparkSession, d: str) -> DataFrame:
    specs = spark.createDataFrame([("5-15", 12), ("20-", 25), ("-10", 30), ("1,3,5-7", 6), ("10", 8), ("4,4,9-", 9)], "spec string, total int")
    return stores.pages_of(specs, "spec", "total")


def a06_markers(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc")
    return t.select("key", stores.section_marker(F.col("key"), F.col("title"), F.col("chapter"), F.col("section")).alias("marker"), stores.page_marker(F.coalesce("page", F.lit(0)), F.col("section")).alias("page_marker"))


def a08_upsert_relationships(spark: SparkSession, d: str) -> DataFrame:
    """Redelivered edges: rows of the first delivery, updated by the later ones."""
    r = load(spark, d, "relationships").select("rel_id", "source", "target", "type", "quantity", "loaded_at")
    first = ordering.latest(r, ["rel_id"], [F.col("loaded_at")])
    later = r.join(first.select("rel_id", F.col("loaded_at").alias("f")), "rel_id").filter("loaded_at > f").drop("f")
    return stores.upsert(first, later, ["rel_id"], [F.desc("loaded_at")])


def a09_append_numbers(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "entities").select("row_id", "source_chunk_id")
    return stores.append_numbered(t, ["source_chunk_id", "row_id"], first=1001)


def a11_positional_update(spark: SparkSession, d: str) -> DataFrame:
    g = ordering.latest(load(spark, d, "graph_entities"), ["id"], [F.desc("created_at"), F.col("name")]).select("id", "embedding")
    """Every id gets a vector as long as its own name, sent in arrays of ids and values that match by position."""
    block = F.pmod(F.xxhash64("id"), F.lit(stores.blocks_of(g.count())))
    pairs = F.array_sort(F.collect_list(F.struct("id", F.array_repeat(F.lit(1.0).cast("float"), F.length("id")).alias("v"))))
    ups = g.groupBy(block.alias("b")).agg(pairs.alias("p")).select(F.col("p.id").alias("ids"), F.col("p.v").alias("vals"))
    return stores.positional_update(g, "graph_entities", "id", "embedding", ups).select("id", F.size("embedding").alias("dims"))


def a12_without_vector(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "graph_entities").filter(F.col("embedding").isNull()).select("id", "type", "name")


def a14_json_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields out of a JSON column, blank as null, numbers tried."""
    e = load(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", F.nullif(k, F.lit("")).try_cast("decimal(18,2)").cast("double").alias("k"), F.get_json_object("props", "$.absent").alias("absent"))


def a15_last_wins(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "entities").filter("type is not null and normalized_name is not null")
    return ordering.latest(e, ["type", "normalized_name", "spec", "unit"], [F.desc("row_id")]).select("row_id", "type", "normalized_name", "spec", "unit")


def a16_resume(spark: SparkSession, d: str) -> DataFrame:
    done = load(spark, d, "entities").filter("source_method = 'llm'").select(F.col("source_chunk_id").alias("chunk_id"))
    return stores.not_done(load(spark, d, "graph_chunks").select("chunk_id", "section_id"), done, "chunk_id")


def a23_property_rows(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "entities")
    m = stores.property_row({"spec": F.col("spec"), "code": F.col("code"), "unit": F.col("unit"), "source_method": F.col("source_method")}, F.col("properties"))
    text = F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), "|")
    return e.select("row_id", text.alias("props"))


def a25_box_repair(spark: SparkSession, d: str) -> DataFrame:
    """Events as boxes of a page (user): too low boxes grow to just above the next one."""
    e = load(spark, d, "events").select(F.col("user_id").alias("page"), "event_id", F.round(F.col("value"), 3).alias("y0"))
    return segments.repair_boxes(e.withColumn("y1", F.round(F.col("y0") + 4.0, 3)), "page", "event_id", height=900.0)


def a27_text_regions(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").select(F.col("user_id").alias("page"), "event_id", F.round(F.col("value"), 3).alias("y0"))
    return segments.text_regions(e.withColumn("y1", F.round(F.col("y0") + 4.0, 3)), "page", "event_id", height=900.0)


def a31_flatten_properties(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "graph_relationships").select("id", "relation", F.explode("properties").alias("prop", "value"))


def b01_section_markers(spark: SparkSession, d: str) -> DataFrame:
    return segments.markers(load(spark, d, "graph_chunks").select("chunk_id", "created_at", "text"), "SECTION").drop("created_at", "end_pos")


def b02_page_markers(spark: SparkSession, d: str) -> DataFrame:
    return segments.markers(load(spark, d, "graph_chunks").select("chunk_id", "created_at", "text"), "PAGE").select("chunk_id", "marker_no", "start_pos", "page", "context")


def b03_asof(spark: SparkSession, d: str) -> DataFrame:
    """Every purchase with the same user's last earlier view."""
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    kinds = [r.event_type for r in e.select("event_type").distinct().orderBy("event_type").limit(2).collect()]
    left, right = e.filter(F.col("event_type") == kinds[0]).drop("event_type"), e.filter(F.col("event_type") == kinds[1]).drop("event_type")
    return ordering.asof_join(left, right.withColumn("view_id", F.col("event_id")), ["user_id"], "ts", ["view_id"]).select("event_id", "user_id", "asof_view_id")


def b04_islands(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user within an hour of the one before are one island."""
    e = load(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    got = ordering.islands(e, ["user_id"], ["t", "event_id"], (F.col("t") - F.col("prev_t")) > 3_600_000_000)
    return got.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def b06_toc_key(spark: SparkSession, d: str) -> DataFrame:
    """Contents key of each chunk by (base id, chapter), its own section id where there is none."""
    c = load(spark, d, "graph_chunks").select("chunk_id", "section_id", "chapter", "created_at")
    return segments.with_toc_key(c, load(spark, d, "toc")).select("chunk_id", "section_id", "toc_key")


def b08_title_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Contents entries without a chunk, looked for as line starts of other chunks of their chapter."""
    return segments.title_fallback(load(spark, d, "toc"), load(spark, d, "graph_chunks").select("chunk_id", "section_id", "chapter", "text"))


def b10_disambiguate(spark: SparkSession, d: str) -> DataFrame:
    return segments.disambiguate(load(spark, d, "toc").select("key", "id", "page"), "id", ["page", "key"]).select("key", "id", "unique_id")


def b11_chapter_repair(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc").select("key", "id", F.regexp_extract("chapter", r"(\d+)", 1).try_cast("int").alias("n"))
    cut_id = F.when(F.col("n") >= 10, F.regexp_replace("id", r"^\d", "")).otherwise(F.col("id"))
    return t.select("key", cut_id.alias("cut_id"), segments.repair_chapter(cut_id, F.col("n")).alias("repaired"))


def b12_spaced_syllables(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc").select("key", "title", F.concat_ws(" ", F.split(F.regexp_replace("title", " ", ""), "")).alias("spaced"))
    return t.select("key", segments.join_syllables(F.trim("spaced")).alias("joined"), segments.join_syllables(F.col("title")).alias("kept"))


def b14_page_sections(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc").filter("page > 0")
    return t.groupBy("page").agg(F.array_join(F.sort_array(F.collect_list("key")), ",").alias("sections"))


def b15_active_section(spark: SparkSession, d: str) -> DataFrame:
    """The section that is open on each chunk's page."""
    pages = load(spark, d, "graph_chunks").filter("page > 0").select("page").distinct()
    t = load(spark, d, "toc").filter("page > 0").groupBy("page").agg(F.max("key").alias("key"))
    one = F.lit(1).alias("book")
    return ordering.asof_join(pages.select(one, "page"), t.select(one, "page", "key"), ["book"], "page", ["key"]).select("page", F.col("asof_key").alias("section"))


def b16_running_context(spark: SparkSession, d: str) -> DataFrame:
    """Division carried forward over the pages of each chunk file."""
    c = load(spark, d, "graph_chunks").select("source_file", "chunk_id", "page", "created_at", F.nullif(F.trim("revision_year"), F.lit("")).alias("revision_year"))
    c = c.groupBy("source_file", "chunk_id").agg(F.min("page").alias("page"), F.max("revision_year").alias("revision_year"))
    return ordering.carry_forward(c, ["source_file"], ["page", "chunk_id"], ["revision_year"])


def b17_breadcrumb(spark: SparkSession, d: str) -> DataFrame:
    part = lambda c: F.nullif(F.trim(c), F.lit(""))
    return load(spark, d, "graph_chunks").select("chunk_id", F.concat_ws(" > ", *[part(c) for c in ("department", "chapter", "section", "title")]).alias("breadcrumb"))


def b22_base_id(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc")
    valid, clean = segments.valid_section(F.col("key"))
    return t.select("key", segments.base_id(F.col("key")).alias("base_id"), valid.alias("valid"), clean.alias("checked_id"))


def b20_reflow(spark: SparkSession, d: str) -> DataFrame:
    """Wrapped lines joined; checked against the text without white space, which must not change."""
    c = load(spark, d, "graph_chunks").select("chunk_id", "created_at", "text").filter("text is not null")
    flow = segments.reflow(F.col("text"))
    return c.select("chunk_id", "created_at", F.md5(F.regexp_replace(flow, r"[ \t\n\r\f\v]+", "")).alias("ink")).drop("created_at")


def b21_sentence_ends(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "documents").filter("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count_if(segments.ends_sentence(F.col("line"))).alias("sentence_lines"), F.count(F.lit(1)).alias("lines"))


QUERIES = {k: v for k, v in globals().items() if k[:1] in "ab" and k[1:3].isdigit()}

_SEC = r"<!-- SECTION: (\S+) \| (.+?) \| 부문:(.+?) \| 장:(.+?) -->"
_PAGE = r"<!-- PAGE (\d+) \| (.+?) -->"


def _positions(pattern: str) -> str:
    """SQL for the matches of a pattern with their offsets, by cutting the text at the matches."""
    return f"""WITH m AS (SELECT chunk_id, text, regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_split_to_array(text, '{pattern}') AS parts FROM graph_chunks WHERE regexp_matches(text, '{pattern}')),
    x AS (SELECT chunk_id, hits[i] AS hit, CAST(i AS INT) AS marker_no,
        CAST(list_sum(list_transform(parts[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda p: length(p))), 0) AS INT) AS start_pos
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m))"""


SQL = {
    "a03_toc_parse": "SELECT key, id, chapter, section, title, page FROM toc",
    "a04_page_specs": """WITH s(spec, total, lo, hi) AS (VALUES ('5-15', 12, 5, 15), ('20-', 25, 20, 25), ('-10', 30, 1, 10), ('1,3,5-7', 6, 1, 1), ('1,3,5-7', 6, 3, 3), ('1,3,5-7', 6, 5, 7), ('10', 8, 1, 10), ('4,4,9-', 9, 4, 4), ('4,4,9-', 9, 9, 9))
        SELECT DISTINCT spec, total, CAST(p - 1 AS INT) AS page FROM s, unnest(range(1, 40)) AS r(p) WHERE p BETWEEN lo AND least(hi, total)""",
    "a06_markers": "SELECT key, '<!-- SECTION: ' || key || ' | ' || title || ' | 부문:' || chapter || ' | 장:' || section || ' -->' AS marker, '<!-- PAGE ' || coalesce(page, 0) || ' | ' || section || ' -->' AS page_marker FROM toc",
    "a08_upsert_relationships": "SELECT rel_id, source, target, type, quantity, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY rel_id ORDER BY loaded_at DESC) rn FROM relationships) WHERE rn = 1",
    "a09_append_numbers": "SELECT row_id, source_chunk_id, 1000 + row_number() OVER (ORDER BY source_chunk_id NULLS FIRST, row_id) AS id FROM entities",
    "a11_positional_update": "SELECT DISTINCT id, CAST(length(id) AS INT) AS dims FROM graph_entities",
    "a12_without_vector": "SELECT id, type, name FROM graph_entities WHERE embedding IS NULL",
    "a14_json_fields": "SELECT event_id, CAST(TRY_CAST(nullif(json_extract_string(props, '$.k'), '') AS DECIMAL(18,2)) AS DOUBLE) AS k, json_extract_string(props, '$.absent') AS absent FROM events",
    "a15_last_wins": "SELECT max(row_id) AS row_id, type, normalized_name, spec, unit FROM entities WHERE type IS NOT NULL AND normalized_name IS NOT NULL GROUP BY ALL",
    "a16_resume": "SELECT chunk_id, section_id FROM graph_chunks c WHERE NOT EXISTS (SELECT 1 FROM entities e WHERE e.source_method = 'llm' AND e.source_chunk_id = c.chunk_id)",
    "a23_property_rows": """WITH kv AS (
        SELECT row_id, unnest(map_keys(properties)) AS k, unnest(map_values(properties)) AS v, 1 AS pri FROM entities
        UNION ALL SELECT row_id, 'spec', spec, 2 FROM entities UNION ALL SELECT row_id, 'code', code, 2 FROM entities
        UNION ALL SELECT row_id, 'unit', unit, 2 FROM entities UNION ALL SELECT row_id, 'source_method', source_method, 2 FROM entities),
        best AS (SELECT row_id, k, arg_min(v, pri) AS v FROM kv WHERE v IS NOT NULL GROUP BY 1, 2)
        SELECT e.row_id, coalesce(string_agg(k || '=' || v, '|' ORDER BY encode(k || '=' || v)), '') AS props FROM entities e LEFT JOIN best b ON b.row_id = e.row_id GROUP BY 1""",
    "a25_box_repair": """WITH b AS (SELECT user_id AS page, event_id, round(value, 3) AS y0, round(round(value, 3) + 4.0, 3) AS y1 FROM events),
        n AS (SELECT *, lead(y0) OVER (PARTITION BY page ORDER BY y0, event_id) AS nxt FROM b)
        SELECT page, event_id, y0, CASE WHEN y1 - y0 < 10 THEN round(greatest(coalesce(nxt - 5, least(0.85 * 900, 900 - 30.0)), y1), 3) ELSE y1 END AS y1 FROM n""",
    "a27_text_regions": """WITH b AS (SELECT user_id AS page, event_id, round(value, 3) AS y0, round(round(value, 3) + 4.0, 3) AS y1 FROM events),
        g AS (SELECT page, coalesce(max(y1) OVER (PARTITION BY page ORDER BY y0, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS top, y0 AS bottom FROM b
              UNION ALL SELECT page, max(y1), 900.0 FROM b GROUP BY 1)
        SELECT page, top, bottom FROM g WHERE bottom - top >= 5""",
    "a31_flatten_properties": "SELECT id, relation, unnest(map_keys(properties)) AS prop, unnest(map_values(properties)) AS value FROM graph_relationships",
    "b01_section_markers": _positions(_SEC.replace("(", "(?:").replace("(?:?", "(?")) + f" SELECT chunk_id, marker_no, start_pos, regexp_extract(hit, '{_SEC}', 1) AS section_id, regexp_extract(hit, '{_SEC}', 2) AS title, regexp_extract(hit, '{_SEC}', 3) AS department, regexp_extract(hit, '{_SEC}', 4) AS chapter FROM x",
    "b02_page_markers": _positions(_PAGE.replace("(", "(?:")) + f" SELECT chunk_id, marker_no, start_pos, CAST(regexp_extract(hit, '{_PAGE}', 1) AS INT) AS page, regexp_extract(hit, '{_PAGE}', 2) AS context FROM x",
    "b03_asof": """WITH k AS (SELECT DISTINCT event_type FROM events ORDER BY 1 LIMIT 2), l AS (SELECT * FROM events WHERE event_type = (SELECT min(event_type) FROM k)), r AS (SELECT * FROM events WHERE event_type = (SELECT max(event_type) FROM k))
        SELECT l.event_id, l.user_id, (SELECT arg_max(r.event_id, (r.ts, r.event_id)) FROM r WHERE r.user_id = l.user_id AND r.ts <= l.ts) AS asof_view_id FROM l""",
    "b04_islands": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 1 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS island FROM g) SELECT user_id, island, count(*) AS n, min(event_id) AS first_event FROM s GROUP BY 1, 2""",
    "b06_toc_key": "WITH r AS (SELECT id, chapter, max(key) AS key FROM toc GROUP BY 1, 2) SELECT chunk_id, section_id, coalesce(r.key, section_id) AS toc_key FROM graph_chunks c LEFT JOIN r ON r.id = trim(split_part(c.section_id, '#', 1)) AND r.chapter = c.chapter",
    "b08_title_fallback": r"""WITH miss AS (SELECT key, id, chapter FROM toc t WHERE NOT EXISTS (SELECT 1 FROM graph_chunks c WHERE c.section_id = t.key)),
        hits AS (SELECT DISTINCT chapter, chunk_id, unnest(regexp_extract_all(text, '(?m)^(\d{1,2}-\d{1,2}(?:-\d{1,3})?)[ \t]+', 1)) AS id FROM graph_chunks)
        SELECT key, min(chunk_id) AS found_in FROM miss LEFT JOIN hits USING (id, chapter) GROUP BY 1""",
    "b10_disambiguate": "SELECT key, id, CASE WHEN rn = 1 THEN id ELSE id || '#' || rn END AS unique_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page NULLS FIRST, key) rn FROM toc)",
    "b11_chapter_repair": r"""WITH t AS (SELECT key, id, TRY_CAST(regexp_extract(chapter, '(\d+)', 1) AS INT) AS n FROM toc), c AS (SELECT key, n, CASE WHEN n >= 10 THEN substr(id, 2) ELSE id END AS cut_id FROM t)
        SELECT key, cut_id, CASE WHEN n >= 10 AND TRY_CAST(split_part(cut_id, '-', 1) AS INT) = n % 10 THEN CAST(n // 10 AS VARCHAR) || cut_id ELSE cut_id END AS repaired FROM c""",
    "b12_spaced_syllables": "SELECT key, CASE WHEN regexp_full_match(replace(title, ' ', ''), '[가-힣]+') THEN replace(title, ' ', '') ELSE array_to_string(list_filter(string_split(replace(title, ' ', ''), ''), lambda x: x <> ''), ' ') END AS joined, title AS kept FROM toc",
    "b14_page_sections": "SELECT page, string_agg(key, ',' ORDER BY encode(key)) AS sections FROM toc WHERE page > 0 GROUP BY 1",
    "b15_active_section": "SELECT p.page, (SELECT arg_max(key, (t.page, encode(key))) FROM toc t WHERE t.page > 0 AND t.page <= p.page) AS section FROM (SELECT DISTINCT page FROM graph_chunks WHERE page > 0) p",
    "b16_running_context": "WITH c AS (SELECT source_file, chunk_id, min(page) AS page, max(nullif(trim(revision_year), '')) AS y FROM graph_chunks GROUP BY 1, 2) SELECT source_file, chunk_id, page, last_value(y IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY page NULLS FIRST, chunk_id) AS revision_year FROM c",
    "b17_breadcrumb": "SELECT chunk_id, concat_ws(' > ', nullif(trim(department), ''), nullif(trim(chapter), ''), nullif(trim(section), ''), nullif(trim(title), '')) AS breadcrumb FROM graph_chunks",
    "b20_reflow": r"SELECT chunk_id, md5(regexp_replace(text, '[ \t\n\r\f\v]+', '', 'g')) AS ink FROM graph_chunks WHERE text IS NOT NULL",
    "b22_base_id": r"SELECT key, trim(split_part(key, '#', 1)) AS base_id, regexp_full_match(trim(split_part(key, '#', 1)), '\d{1,2}-\d{1,2}(-\d{1,3})?') AS valid, CASE WHEN regexp_full_match(trim(split_part(key, '#', 1)), '\d{1,2}-\d{1,2}(-\d{1,3})?') THEN trim(split_part(key, '#', 1)) ELSE 'unknown' END AS checked_id FROM toc",
    "b21_sentence_ends": r"SELECT doc_id, count(*) FILTER (regexp_matches(line, '(다|요|함|음|임|것|[.!?:;])[.)\]]?[ \t]*$')) AS sentence_lines, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) GROUP BY 1",
}
