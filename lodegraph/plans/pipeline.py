"""The whole way from marked documents to a graph, as a chain of DataFrame stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodegraph.operators import chunking, extract, normalise as N, rules, segments, tables as T, texts as X
from lodegraph.operators.ordering import latest
from lodegraph.plans.session import cut

TABLE = "struct<table_id:string,type:string,headers:array<string>,rows:array<map<string,struct<s:string,n:double>>>,notes_in_table:array<string>>"


def split_documents(docs: DataFrame, toc: DataFrame) -> DataFrame:
    """(file, section_id, title, department, chapter, raw_text, has_content) from documents (file, text)."""
    groups = segments.sections_of(docs)
    m = segments.markers(docs.select("file", "text"), "SECTION")
    titles = m.groupBy("section_id").agg(F.min("title").alias("title"))
    parts = segments.spread_text(groups, titles)
    named = latest(m.select("file", "section_id", "title", "department", "chapter", "start_pos"), ["file", "section_id"], [F.col("start_pos")]).drop("start_pos")
    d = parts.join(named, ["file", "section_id"]).withColumn("raw_text", F.col("part")).drop("part", "group")
    keyed = segments.with_toc_key(d.withColumn("base", F.col("section_id")), toc.select("id", "key", F.col("chapter")))
    return keyed.select("file", F.col("toc_key").alias("section_id"), "title", "department", "chapter", "raw_text", (F.length("raw_text") > 10).alias("has_content"))


def parse_tables(sections: DataFrame) -> DataFrame:
    """``sections`` with tables (parsed) and text (without them)."""
    g = T.grids(sections.select("section_id", "raw_text"), "section_id", "raw_text")
    depth = T.header_depth(F.col("grid"))
    g = g.withColumn("depth", depth).withColumn("headers", T.composite_headers(F.col("grid"), F.col("depth")))
    names = F.transform("headers", lambda h, i: F.when(h == "", F.concat(F.lit("col_"), i.cast("string"))).otherwise(h))
    body = F.slice("grid", F.col("depth") + 1, F.greatest(F.size("grid") - F.col("depth"), F.lit(0)))
    g = g.withColumn("names", names).withColumn("body", F.filter(body, lambda r: F.exists(r, lambda c: ~c.isin("", "0"))))
    notes = F.transform(F.filter("body", T.is_note_row), lambda r: F.trim(F.array_join(F.array_distinct(r), " ")))
    cell = lambda c: F.struct(c.alias("s"), T.number_of(c).alias("n"))
    # of equal headers the last column wins
    last = F.filter(F.transform("names", lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda x: x["i"] == F.size("names") - F.array_position(F.reverse("names"), x["h"]))
    row = lambda r: F.map_from_entries(F.transform(last, lambda x: F.struct(x["h"].alias("key"), cell(F.coalesce(F.get(r, x["i"]), F.lit(""))).alias("value"))))
    rows = F.transform(F.filter("body", lambda r: ~T.is_note_row(r)), row)
    first = F.transform("body", lambda r: F.coalesce(F.get(r, F.lit(0)), F.lit("")))
    t = g.select("section_id", "table_no", F.struct(F.format_string("T-%s-%02d", F.col("section_id"), F.col("table_no")).alias("table_id"), T.table_type(F.col("names"), first).alias("type"), F.array_distinct("names").alias("headers"), rows.alias("rows"), notes.alias("notes_in_table")).alias("t"))
    by = t.groupBy("section_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("table_no", F.col("t.table_id").alias("id"), F.to_json("t").alias("j")))), lambda x: F.from_json(x["j"], TABLE)).alias("tables"))
    return sections.join(by, "section_id", "left").withColumn("text", T.without_tables(F.col("raw_text")))


def clean_sections(sections: DataFrame) -> DataFrame:
    """Notes, conditions, references, revision year and basis taken out of the text; the text cleaned."""
    t = F.col("text")
    table_notes = F.flatten(F.transform("tables", lambda x: x["notes_in_table"]))
    return (
        sections.withColumns({"notes": X.drop_contained(X.notes(t), table_notes), "conditions": X.rates(t), "cross_references": X.cross_references(t), "revision_year": X.revision_year(t), "unit_basis": X.unit_basis(t)})
        .withColumn("text", X.clean_text(X.without_notes(t)))
        .drop("raw_text")
    )


def make_chunks(sections: DataFrame, soft: int = chunking.SOFT, hard: int = chunking.HARD) -> DataFrame:
    parts = chunking.hard_parts(chunking.section_parts(sections, soft), soft, hard)
    c = chunking.number_chunks(parts, ["section_id"])
    return c.withColumn("subsection", F.concat_ws(" ", "section_id", "title")).withColumn("token_count", X.chunk_tokens(F.col("text"), F.col("tables"), F.col("notes")))


def extract_graph(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, relationships): row entities of the tables, a section and a work type a chunk, its notes."""
    rows = extract.row_entities(chunks.select("chunk_id", "tables"))
    c = chunks.select("chunk_id", "section_id", "title", "notes")
    e_rows = rows.join(c.select("chunk_id", "section_id", "title"), "chunk_id").select("chunk_id", "section_id", extract.type_of_name(F.col("name")).alias("type"), "name", "spec", "unit", "quantity", F.lit("table_rule").alias("source_method"), F.lit(1.0).alias("confidence"), "title")
    base = lambda type_, name: c.select("chunk_id", "section_id", F.lit(type_).alias("type"), name.alias("name"), F.lit(None).cast("string").alias("spec"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("double").alias("quantity"), F.lit("auto").alias("source_method"), F.lit(1.0).alias("confidence"), "title")
    notes = c.withColumn("note", F.explode("notes")).select("chunk_id", "section_id", F.lit("Note").alias("type"), F.col("note").alias("name"), F.lit(None).cast("string").alias("spec"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("double").alias("quantity"), F.lit("auto").alias("source_method"), F.lit(1.0).alias("confidence"), "title")
    e = e_rows.unionByName(base("Section", F.col("section_id"))).unionByName(base("WorkType", F.col("title"))).unionByName(notes).filter("trim(name) <> ''")
    e = e.withColumn("normalized_name", F.lower(F.regexp_replace(N.normal_name(F.col("name")), r"\s+", "")))
    rel = rules.lookup(F.col("type"), {"Labor": "REQUIRES_LABOR", "Equipment": "REQUIRES_EQUIPMENT", "Material": "USES_MATERIAL", "Note": "HAS_NOTE", "Section": "BELONGS_TO"})
    r = e.filter("type <> 'WorkType'").select("chunk_id", F.col("title").alias("source"), F.lit("WorkType").alias("source_type"), F.col("name").alias("target"), F.col("type").alias("target_type"), rel.alias("type"), "quantity", "unit", "confidence")
    return e.drop("title"), r


def build_graph(entities: DataFrame, relationships: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): names normalised, one node a (type, name) with a dense id, edges between nodes that exist,
    allowed by direction, without zero quantities, self-loops, bad names and duplicates."""
    norm = lambda c: F.lower(F.regexp_replace(N.normal_name(F.col(c)), r"\s+", ""))
    entities = entities.withColumn("type", N.known_type(F.col("type")))
    relationships = relationships.withColumns({c: N.known_type(F.col(c)) for c in ("source_type", "target_type")})
    good = entities.withColumn("k", norm("name")).filter(N.garbage_reason(F.col("k")).isNull() & F.col("type").isNotNull())
    one = good.groupBy("type", "k").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "name")).alias("o"), F.count(F.lit(1)).alias("mentions"))
    nodes = N.assign_ids(one.select("type", "k", F.col("o.name").alias("name"), "mentions"), ["k"])
    r = N.flag_outliers(relationships)
    chunk = "source_chunk_id" if "source_chunk_id" in entities.columns else "chunk_id"
    if chunk not in entities.columns:  # mentions that name no chunk
        entities, r = entities.withColumn(chunk, F.lit(None).cast("string")), r.withColumn(chunk, F.lit(None).cast("string"))
    r = N.repair_directions(r, N.chunk_heads(entities, chunk, "row_id" if "row_id" in entities.columns else "name"), chunk).filter("action <> 'drop'")
    r = r.select(F.col("source_type").alias("st"), norm("source").alias("sk"), F.col("target_type").alias("tt"), norm("target").alias("tk"), F.col("type").alias("relation"), "quantity", "unit", "outlier")
    ids = nodes.select("type", "k", "id")
    r = r.join(ids.select(F.col("type").alias("st"), F.col("k").alias("sk"), F.col("id").alias("source_id")), ["st", "sk"]).join(ids.select(F.col("type").alias("tt"), F.col("k").alias("tk"), F.col("id").alias("target_id")), ["tt", "tk"])
    edges = r.filter("source_id <> target_id").groupBy("source_id", "target_id", "relation", "quantity", "unit").agg(F.bool_or("outlier").alias("outlier"), F.count(F.lit(1)).alias("mentions"))
    return nodes.drop("k"), edges


def documents_to_graph(docs: DataFrame, toc: DataFrame) -> dict[str, DataFrame]:
    """All stages by name: sections, chunks, entities, relationships, nodes, edges. Stages that several later ones
    read are written to the shared folder."""
    sections = cut(clean_sections(parse_tables(split_documents(docs, toc))))
    chunks = cut(make_chunks(sections))
    entities, relationships = map(cut, extract_graph(chunks))
    nodes, edges = build_graph(entities, relationships)
    return {"sections": sections, "chunks": chunks, "entities": entities, "relationships": relationships, "nodes": nodes, "edges": edges}
