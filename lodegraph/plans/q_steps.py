"""Queries of the remaining single steps, one an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import chunking, extract, normalise as N, quality as Q, segments, tables as T, texts as X
from lodegraph.operators.ordering import carry_forward, latest
from lodegraph.plans import answer, pipeline as P
from lodegraph.plans.session import load


def _c(spark, d):
    return load(spark, d, "graph_chunks")


def _grids(spark, d):
    return T.grids(load(spark, d, "documents").select("doc_id", "text"), "doc_id")


def a01_source_files(spark: SparkSession, d: str) -> DataFrame:
    """Source files with the start page in their name, 0 if there is none."""
    f = _c(spark, d).select("source_file").distinct()
    return f.select("source_file", F.coalesce(F.regexp_extract("source_file", r"(\d+)-\d+", 1).try_cast("int"), F.lit(0)).alias("first_page"))


def a02_toc_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Contents through their JSON form and back."""
    j = load(spark, d, "toc").select("key", F.to_json(F.struct("id", "chapter", "section", "title", "page")).alias("j"))
    return j.select("key", F.from_json("j", "struct<id:string,chapter:string,section:string,title:string,page:int>").alias("e")).select("key", "e.*")


def a22_requests(spark: SparkSession, d: str) -> DataFrame:
    """Documents as questions: trimmed to 500 characters, blank ones out."""
    return answer.requests(load(spark, d, "documents").select(F.col("doc_id").alias("qid"), F.col("text").alias("question"))).select("qid", F.length("question").alias("chars"))


def a29_page_context(spark: SparkSession, d: str) -> DataFrame:
    """Division of each contents page: its own, else the one before."""
    t = load(spark, d, "toc").filter("page > 0").groupBy("page").agg(F.min(F.when(F.col("key").endswith("1"), F.col("chapter"))).alias("chapter"))
    return carry_forward(t.withColumn("book", F.lit(1)), ["book"], ["page"], ["chapter"]).select("page", "chapter")


def a32_chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    cols = ["chunk_id", "section_id", "title", "department", "chapter", "section", "text", "unit_basis", "token_count"]
    return _c(spark, d).select(*cols)


def a33_chunks_without_vector(spark: SparkSession, d: str) -> DataFrame:
    return _c(spark, d).filter(F.col("embedding").isNull()).select("chunk_id", "title")


def b05_shared_text(spark: SparkSession, d: str) -> DataFrame:
    """Text behind the markers of each chunk, divided among their sections."""
    docs = _c(spark, d).dropDuplicates(["chunk_id"]).select(F.col("chunk_id").alias("file"), "text")
    titles = load(spark, d, "toc").select(F.col("key").alias("section_id"), "title")
    return segments.spread_text(segments.sections_of(docs), titles).select("file", "section_id", F.length("part").alias("chars"))


def b07_sections(spark: SparkSession, d: str) -> DataFrame:
    docs = _c(spark, d).dropDuplicates(["chunk_id"]).select(F.col("chunk_id").alias("file"), "text")
    return P.split_documents(docs, load(spark, d, "toc")).select("file", "section_id", "has_content")


def b23_valid_ids(spark: SparkSession, d: str) -> DataFrame:
    ok, clean = segments.valid_section(F.col("section_id"))
    return _c(spark, d).select("chunk_id", ok.alias("valid"), clean.alias("section"))


def c05_clean_cells(spark: SparkSession, d: str) -> DataFrame:
    return T.long_cells(_c(spark, d), ["chunk_id"]).filter("s is not null").groupBy(T.clean_cell(F.col("s")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def c06_header_depths(spark: SparkSession, d: str) -> DataFrame:
    return _grids(spark, d).select("doc_id", "table_no", T.header_depth(F.col("grid")).alias("depth"), F.size("grid").alias("rows"))


def c08_headers(spark: SparkSession, d: str) -> DataFrame:
    return _grids(spark, d).select("doc_id", "table_no", F.array_join(T.composite_headers(F.col("grid"), T.header_depth(F.col("grid"))), "|").alias("headers"))


def c12_parsed_tables(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("section_id"), F.col("text").alias("raw_text"))
    got = P.parse_tables(docs).filter("tables is not null").select("section_id", F.explode("tables").alias("t"))
    return got.select("section_id", "t.table_id", "t.type", F.size("t.headers").alias("headers"), F.size("t.rows").alias("rows"))


def c31_matrices(spark: SparkSession, d: str) -> DataFrame:
    t = _c(spark, d).select(F.explode("tables").alias("t"))
    return t.groupBy(F.size("t.headers").alias("headers"), T.is_matrix(F.col("t.headers"), 2).alias("matrix")).agg(F.count(F.lit(1)).alias("n"))


def d08_clean_sections(spark: SparkSession, d: str) -> DataFrame:
    s = _c(spark, d).select("chunk_id", F.col("text"), "tables", F.lit("").alias("raw_text"))
    got = P.clean_sections(s)
    return got.select("chunk_id", F.size("notes").alias("notes"), F.size("conditions").alias("conditions"), F.size("cross_references").alias("references"), F.length("text").alias("chars"))


def d15_hard_limit(spark: SparkSession, d: str) -> DataFrame:
    """Stored chunks over the hard limit cut again: pieces of each, and what they hold in all."""
    c = latest(_c(spark, d), ["chunk_id"], [F.desc("created_at")]).select("chunk_id", "text", "tables", "notes")
    p = chunking.hard_parts(c)
    rows = F.coalesce(F.aggregate("tables", F.lit(0), lambda a, t: a + F.size(t["rows"])), F.lit(0))
    letters = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", ""))
    p = p.select("chunk_id", "n_subs", rows.alias("r"), letters.alias("c"), F.coalesce(F.size("notes"), F.lit(0)).alias("n"), ((F.coalesce(F.size("tables"), F.lit(0)) > 0) & (letters > 0)).alias("mixed"))
    return p.groupBy("chunk_id").agg((F.max("n_subs") > 1).alias("cut"), F.sum("r").alias("n_rows"), F.sum("c").alias("n_letters"), F.sum("n").alias("n_notes"), F.bool_or("mixed").alias("mixed")).filter("cut")


def d16_chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    return _c(spark, d).select("chunk_id", F.concat_ws(" ", "section_id", "title").alias("subsection"), F.concat_ws("/", "department", "chapter", "section").alias("place"))


def e03_cell_values(spark: SparkSession, d: str) -> DataFrame:
    c = T.long_cells(_c(spark, d), ["chunk_id"])
    return c.groupBy("header").agg(F.count(T.cell_quantity(F.col("s"))).alias("quantities"), F.count(F.lit(1)).alias("cells"))


def e09_compound_headers(spark: SparkSession, d: str) -> DataFrame:
    """Facts by the leaf of their header, with its unit in parentheses taken out."""
    f = extract.matrix_facts(_c(spark, d).dropDuplicates(["chunk_id"]).select("chunk_id", "tables"))
    leaf = F.trim(F.regexp_replace(extract.header_leaf(F.col("header")), r"\([^)]*\)", ""))
    return f.groupBy(leaf.alias("resource")).agg(F.count(F.lit(1)).alias("facts"), F.round(F.sum("quantity"), 4).alias("total"))


def e17_sub_headings(spark: SparkSession, d: str) -> DataFrame:
    """Number of a table in its chunk, from its id, with a label."""
    t = _c(spark, d).select("chunk_id", F.explode("tables").alias("t"))
    n = F.regexp_extract("t.table_id", r"-(\d+)$", 1).try_cast("int")
    return t.select("chunk_id", F.col("t.table_id").alias("table_id"), F.format_string("table %d", n).alias("label"))


def g15_renames(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose target's name normalising changes."""
    n = load(spark, d, "graph_entities").groupBy(F.col("id").alias("target_id")).agg(F.min("name").alias("name"))
    n = n.withColumn("new", N.normal_name(F.col("name"))).filter("name <> new")
    return load(spark, d, "graph_relationships").select("id", "target_id").distinct().join(n, "target_id").select("id", "target_id", "new")


def h16_tokens(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.size(Q.token_set(F.col("text"))).alias("tokens"))


def h18_number_matches(spark: SparkSession, d: str) -> DataFrame:
    """Quantities of rows that their own property texts hold, in some spelling."""
    e = load(spark, d, "entities").filter("quantity is not null and size(properties) > 0").select("row_id", F.col("quantity").cast("string").alias("q"), F.array_join(F.map_values("properties"), " ").alias("t"))
    return e.select("row_id", Q.number_kept(F.col("q"), F.col("t")).alias("kept")).groupBy("kept").agg(F.count(F.lit(1)).alias("n"))


def h32_audit_driver(spark: SparkSession, d: str) -> DataFrame:
    """Sections of the contents against sections of the chunks: on both sides, on one only."""
    a = load(spark, d, "toc").select(F.col("key").alias("k")).distinct().withColumn("a", F.lit(True))
    b = _c(spark, d).select(F.col("section_id").alias("k")).distinct().withColumn("b", F.lit(True))
    state = F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "contents").otherwise("chunks")
    return a.join(b, "k", "full").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def h35_line_audit(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each section's texts that hold a table row, largest difference to the parsed rows first."""
    raw = _c(spark, d).groupBy("section_id").agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(r"(?i)<tr[ >]")), F.lit(0))).alias("raw_rows"), F.sum(F.coalesce(F.aggregate("tables", F.lit(0), lambda x, t: x + F.size(t["rows"])), F.lit(0))).alias("parsed_rows"))
    return raw.withColumn("gap", F.abs(F.col("raw_rows") - F.col("parsed_rows")))


QUERIES = {k: v for k, v in globals().items() if k[:1] in "abcdegh" and k[1:3].isdigit()}

_T = "(SELECT chunk_id, unnest(tables) AS t FROM graph_chunks)"
_CELLS = f"(SELECT unnest(map_keys(r)) AS header, unnest(map_values(r)).s AS s FROM (SELECT unnest(t.rows) AS r FROM {_T}))"
_VALID = r"regexp_full_match(trim(split_part(section_id, '#', 1)), '\d{1,2}-\d{1,2}(-\d{1,3})?')"

_ONE = "one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY created_at DESC) AS rn FROM graph_chunks) WHERE rn = 1)"

SQL = {
    "d15_hard_limit": f"""WITH {_ONE}, tok AS (SELECT *, coalesce(len(tables), 0) AS nt, ceil(coalesce(length(text), 0) / 2.0) AS tx, coalesce(list_sum(list_transform(tables, lambda t: coalesce(list_sum(list_transform(t.rows, lambda r: coalesce(list_sum(list_transform(map_values(r), lambda c: ceil(coalesce(length(c.s), 0) / 2.0))), 0))), 0))), 0) AS tt,
            coalesce(list_sum(list_transform(notes, lambda n: ceil(length(n) / 2.0))), 0) AS nn, length(regexp_replace(coalesce(text, ''), '\\s+', '', 'g')) AS c FROM one)
        SELECT chunk_id, true AS cut, CAST(coalesce(list_sum(list_transform(tables, lambda t: len(t.rows))), 0) AS BIGINT) AS n_rows, CAST(c AS BIGINT) AS n_letters, CAST(coalesce(len(notes), 0) AS BIGINT) AS n_notes, false AS mixed FROM tok
        WHERE tx + tt + nn > 2000 AND (nt > 0 AND c > 0 OR nt > 1 OR c > 0 AND tx > 1900 AND len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) > 1)""",
    "a01_source_files": r"SELECT DISTINCT source_file, coalesce(TRY_CAST(regexp_extract(source_file, '(\d+)-\d+', 1) AS INT), 0) AS first_page FROM graph_chunks",
    "a02_toc_lookup": "SELECT key, id, chapter, section, title, page FROM toc",
    "a22_requests": "SELECT doc_id AS qid, CAST(length(substr(trim(text, ' '), 1, 500)) AS INT) AS chars FROM documents WHERE trim(text, ' ') <> ''",
    "a29_page_context": "SELECT page, last_value(c IGNORE NULLS) OVER (ORDER BY page) AS chapter FROM (SELECT page, decode(min(CASE WHEN key LIKE '%1' THEN encode(chapter) END)) AS c FROM toc WHERE page > 0 GROUP BY 1)",
    "a32_chunk_rows": "SELECT chunk_id, section_id, title, department, chapter, section, text, unit_basis, token_count FROM graph_chunks",
    "a33_chunks_without_vector": "SELECT chunk_id, title FROM graph_chunks WHERE embedding IS NULL",
    "b23_valid_ids": f"SELECT chunk_id, {_VALID} AS valid, CASE WHEN {_VALID} THEN trim(split_part(section_id, '#', 1)) ELSE 'unknown' END AS section FROM graph_chunks",
    "c05_clean_cells": rf"SELECT trim(regexp_replace(s, '[\s\x{{A0}}]+', ' ', 'g')) AS cell, count(*) AS n FROM {_CELLS} WHERE s IS NOT NULL GROUP BY 1",
    "c31_matrices": rf"SELECT CAST(len(t.headers) AS INT) AS headers, len(t.headers) >= 2 AND len(list_filter(t.headers, lambda h: regexp_full_match(h, '\s*[\d,.]+\s*'))) >= len(t.headers) * 0.5 AS matrix, count(*) AS n FROM {_T} GROUP BY 1, 2",
    "d16_chunk_rows": "SELECT chunk_id, concat_ws(' ', section_id, title) AS subsection, concat_ws('/', department, chapter, section) AS place FROM graph_chunks",
    "e03_cell_values": rf"SELECT header, count(TRY_CAST(replace(regexp_replace(trim(s), '^\((.*)\)$', '\1'), ',', '') AS DOUBLE)) AS quantities, count(*) AS cells FROM {_CELLS} GROUP BY 1",
    "e17_sub_headings": rf"SELECT chunk_id, t.table_id AS table_id, 'table ' || CAST(CAST(regexp_extract(t.table_id, '-(\d+)$', 1) AS INT) AS VARCHAR) AS label FROM {_T}",
    "h16_tokens": r"SELECT doc_id, CAST(len(list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace(coalesce(text, ''), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g')), '[^0-9A-Za-z_가-힣]+'), lambda x: x <> ''))) AS INT) AS tokens FROM documents",
    "h32_audit_driver": "SELECT state, count(*) AS n FROM (SELECT CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'contents' ELSE 'chunks' END AS state FROM (SELECT DISTINCT key AS k FROM toc) a FULL JOIN (SELECT DISTINCT section_id AS k FROM graph_chunks) b ON a.k = b.k) GROUP BY 1",
    "h35_line_audit": "SELECT section_id, raw_rows, parsed_rows, abs(raw_rows - parsed_rows) AS gap FROM (SELECT section_id, CAST(sum(coalesce(len(regexp_extract_all(text, '(?i)<tr[ >]')), 0)) AS BIGINT) AS raw_rows, CAST(sum(coalesce(list_sum(list_transform(tables, lambda t: len(t.rows))), 0)) AS BIGINT) AS parsed_rows FROM graph_chunks GROUP BY 1)",
}
