"""Further queries: single steps of tables, extraction, audits and search that the larger stages are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import chunking, extract, normalise as N, quality as Q, relations as R, retrieval as V, rules, segments, tables as T, texts as X
from lodegraph.plans import answer
from lodegraph.plans.session import load
from lodegraph.streaming import stateful as S


def _c(spark, d):
    return load(spark, d, "graph_chunks")


def _t(spark, d):
    return _c(spark, d).select("chunk_id", F.explode("tables").alias("t"))


def _nodes(spark, d):
    return load(spark, d, "graph_entities").filter("coalesce(is_active, true)").groupBy("id").agg(F.min("name").alias("name"), F.min("type").alias("type"))


def b09_context_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Contents ids no chunk has, looked for in any marker of any chunk; the first chunk wins."""
    ids = F.regexp_extract_all("text", F.lit(r"<!-- (?:SECTION|CONTEXT): (\S+) \|"), F.lit(1))
    hits = _c(spark, d).select("chunk_id", F.explode(ids).alias("id"))
    miss = load(spark, d, "toc").select("key", "id").join(_c(spark, d).select(F.col("section_id").alias("key")).distinct(), "key", "left_anti")
    return miss.join(hits, "id", "left").groupBy("key").agg(F.min("chunk_id").alias("found_in"))


def b13_inline_chapters(spark: SparkSession, d: str) -> DataFrame:
    """A title and the chapter behind it on one line become two rows."""
    t = load(spark, d, "toc").select("key", F.concat_ws(" ", "title", "chapter").alias("line"))
    cut = F.regexp_extract("line", r"^(.*\S)\s+(제\d+장\s.*)$", 1)
    two = F.when(cut != "", F.array(cut, F.regexp_extract("line", r"^(.*\S)\s+(제\d+장\s.*)$", 2))).otherwise(F.array("line"))
    return t.select("key", F.posexplode(two).alias("i", "part")).select("key", (F.col("i") + 1).alias("n"), "part")


def c14_flat_headers(spark: SparkSession, d: str) -> DataFrame:
    h = _t(spark, d).select("chunk_id", F.explode("t.headers").alias("h"))
    return h.select("chunk_id", F.trim(F.regexp_replace("h", r"(?i)<br\s*/?>", " ")).alias("header"))


def c15_source_census(spark: SparkSession, d: str) -> DataFrame:
    """Tables, header cells and data cells of each document's own HTML."""
    n = lambda p: F.regexp_count("text", F.lit(p))
    return load(spark, d, "documents").filter("text is not null").select("doc_id", n("(?i)<table").alias("tables"), n("(?i)<tr[ >]").alias("rows"), n("(?i)<td[ >]").alias("cells")).filter("tables > 0")


def c18_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).groupBy(T.has_ranges(F.col("t.rows")).alias("ranges"), T.is_matrix(F.col("t.headers"), 3).alias("matrix")).agg(F.count(F.lit(1)).alias("n"))


def c32_row_words(spark: SparkSession, d: str) -> DataFrame:
    """Tables with a trade among the first cells of their first five rows, and their rows with a number."""
    first = F.transform(F.slice("t.rows", 1, 5), lambda r: F.coalesce(F.get(F.map_values(r), F.lit(0))["s"], F.lit("")))
    job = F.exists(first, lambda s: s.rlike("|".join(rules.HEADER_ROLES["labor"])))
    numeric = F.size(F.filter("t.rows", lambda r: F.exists(F.map_values(r), lambda c: F.coalesce(c["n"].isNotNull(), F.lit(False)))))
    return _t(spark, d).groupBy(job.alias("has_trade")).agg(F.count(F.lit(1)).alias("tables"), F.sum(numeric).alias("numeric_rows"))


def d19_estimates(spark: SparkSession, d: str) -> DataFrame:
    c = _c(spark, d).filter("tables is not null")
    return c.select("chunk_id", F.aggregate("tables", F.lit(0), lambda a, t: a + chunking.table_size(t)).alias("size"))


def f03_entity_keys(spark: SparkSession, d: str) -> DataFrame:
    k = R.entity_key(F.col("type"), F.col("normalized_name"), F.col("spec"), F.col("sub_section"))
    return load(spark, d, "entities").groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def g04_dedup_keys(spark: SparkSession, d: str) -> DataFrame:
    """Groups by the key their type has: name and spec, name and section for notes, code for sections, else name."""
    e = load(spark, d, "entities")
    x = lambda c: F.coalesce(F.col(c), F.lit(""))
    extra = F.when(F.col("type").isin("WorkType", "Equipment", "Material"), x("spec")).when(F.col("type") == "Note", x("source_section_id")).when(F.col("type") == "Section", x("code")).otherwise("")
    name = F.when(F.col("type") == "Section", "").otherwise(x("normalized_name"))
    return e.groupBy("type", name.alias("name"), extra.alias("extra")).agg(F.count(F.lit(1)).alias("n"))


def g18_flat_edges(spark: SparkSession, d: str) -> DataFrame:
    keys = ["source", "target", "type", "quantity", "unit", "per_unit"]
    return load(spark, d, "relationships").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def g23_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Names that normalising changes, by kind of change."""
    e = load(spark, d, "entities").select("row_id", "name", N.normal_name(F.col("name")).alias("n"))
    kind = F.when(F.col("name") == F.col("n"), "same").when(F.regexp_replace("name", r"\s+", "") == F.regexp_replace("n", r"\s+", ""), "space").otherwise("character")
    return e.groupBy(kind.alias("change")).agg(F.count(F.lit(1)).alias("rows"))


def h04_token_distribution(spark: SparkSession, d: str) -> DataFrame:
    return X.picked_percentiles(_c(spark, d).withColumn("size", X.token_count(F.col("text"))), "size", [0.25, 0.5, 0.75, 0.95])


def h17_numbers(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.size(Q.numbers(F.col("text"))).alias("numbers"), F.size(F.array_distinct(Q.numbers(F.col("text")))).alias("different"))


def h30_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = F.filter(F.split(F.lower(F.regexp_replace("name", r"[^0-9A-Za-z_가-힣]+", " ")), " "), lambda w: w != "")
    return load(spark, d, "entities").filter("name is not null").select("row_id", F.array_join(F.array_sort(F.array_distinct(t)), " ").alias("tokens"))


def h33_table_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sections with more table markup in their texts than parsed tables."""
    c = _c(spark, d).groupBy("section_id").agg(F.sum(F.coalesce(F.regexp_count("text", F.lit("<table")), F.lit(0))).alias("raw"), F.sum(F.coalesce(F.size("tables"), F.lit(0))).alias("parsed"))
    return c.filter("raw > 0").withColumn("short", F.col("raw") > F.col("parsed") + 1)


def h34_header_families(spark: SparkSession, d: str) -> DataFrame:
    t = F.array_join("t.headers", " ")
    kind = F.when(t.contains("수량") & t.contains("단위"), "quantity").when(t.rlike("규격|치수|size"), "size").when(t.rlike("비고|note|remark"), "note").otherwise("other")
    return _t(spark, d).groupBy(kind.alias("family")).agg(F.count(F.lit(1)).alias("n"))


def h50_preserved(spark: SparkSession, d: str) -> DataFrame:
    """Named relations whose ends the graph has, by which end is missing."""
    names = load(spark, d, "graph_entities").select("type", "name").distinct()
    r = load(spark, d, "relationships").select("rel_id", "source_type", "source", "target_type", "target").distinct()
    r = r.join(names.select(F.col("type").alias("source_type"), F.col("name").alias("source"), F.lit(True).alias("s")), ["source_type", "source"], "left").join(names.select(F.col("type").alias("target_type"), F.col("name").alias("target"), F.lit(True).alias("t")), ["target_type", "target"], "left")
    return r.groupBy(F.coalesce("s", F.lit(False)).alias("source_ok"), F.coalesce("t", F.lit(False)).alias("target_ok")).agg(F.count(F.lit(1)).alias("n"))


def h56_recount(spark: SparkSession, d: str) -> DataFrame:
    """Outliers and direction errors counted anew."""
    r = Q.valid_directions(load(spark, d, "relationships"))
    high = F.col("quantity") > rules.lookup(F.col("type"), rules.OUTLIER)
    return r.agg(F.count_if(high).alias("outliers"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("direction_errors"), F.count(F.lit(1)).alias("n"))


def i08_self_query(spark: SparkSession, d: str) -> DataFrame:
    """The asked vectors (ids divisible by 100) with their 3 nearest above 0, themselves first."""
    e = load(spark, d, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    return V.vector_search(q, e, 3, 0.0, "vec_id").select("qid", "vec_id", "rank")


def j01_intent(spark: SparkSession, d: str) -> DataFrame:
    """Documents that ask for numbers."""
    ask = F.coalesce(F.lower("text").rlike("얼마|몇|how much|how many|수량"), F.lit(False))
    return load(spark, d, "documents").groupBy("lang").agg(F.count_if(ask).alias("asks"), F.count(F.lit(1)).alias("n"))


def j10_keyword_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Works and materials whose name has the first and the last word of a title, five a title."""
    q = load(spark, d, "toc").select(F.col("key").alias("qid"), F.concat_ws(" ", F.element_at(F.split("title", " "), 1), F.element_at(F.split("title", " "), -1)).alias("question"))
    n = _nodes(spark, d).filter("type in ('WorkType', 'Material')")
    return V.keyword_search(q, n, 5).join(V.keyword_hits(q, n).filter("hits = asked").select("qid", "id"), ["qid", "id"], "left_semi").select("qid", "id")


def j11_body_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Sections whose text has all words of a title."""
    q = load(spark, d, "toc").select(F.col("key").alias("qid"), F.col("title").alias("question"))
    c = _c(spark, d).filter("text is not null").select(F.col("section_id").alias("id"), "text")
    return V.keyword_hits(q, c, "text").filter("hits = asked").select("qid", "id").distinct()


def k15_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers to the titles as questions, from search, expansion and context."""
    q = answer.requests(load(spark, d, "toc").select(F.col("key").alias("qid"), F.col("title").alias("question")))
    e = load(spark, d, "graph_relationships").select("source_id", "target_id", "relation").distinct()
    return answer.answers(answer.contexts(q, _nodes(spark, d), e, _c(spark, d))).select("qid", "type", "entities", "tokens", F.md5("answer").alias("answer"))


def k17_consistent_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of each section that its entities name as their source, all of the section's if none does."""
    c = _c(spark, d).select("section_id", "chunk_id").distinct()
    named = load(spark, d, "entities").select(F.col("source_section_id").alias("section_id"), F.col("source_chunk_id").alias("chunk_id")).distinct()
    return V.first_stage([c.join(named, ["section_id", "chunk_id"], "left_semi"), c], by="section_id")


def l05_daily_windows(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return S.windowed_counts(e, "ts", [], "1 day").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n")


QUERIES = {k: v for k, v in globals().items() if k[:1] in "bcdefghijkl" and k[1:3].isdigit()}

_T = "(SELECT chunk_id, unnest(tables) AS t FROM graph_chunks)"
_FLAT = "array_to_string(flatten(list_transform(tables, lambda t: list_concat(t.headers, flatten(list_transform(t.rows, lambda r: list_transform(map_values(r), lambda c: coalesce(c.s, ''))))))), ' ')"
_W = lambda c: f"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^0-9a-z가-힣]+'), lambda w: length(w) >= 2))"
_LEN2 = "CAST(ceil(coalesce(length(text), 0) / 2.0) AS INT)"
_OK = "CASE type " + " ".join(f"WHEN '{r}' THEN source_type IN ({', '.join(repr(x) for x in a)}) AND target_type = '{b}'" for r, (a, b) in rules.DIRECTIONS.items()) + " ELSE true END"
_HIT = lambda q, body: f"q AS ({q}), qw AS (SELECT qid, len(ws) AS asked, unnest(ws) AS w FROM (SELECT qid, {_W('question')} AS ws FROM q)), bw AS ({body}), h AS (SELECT qid, id, asked, count(*) AS hits FROM qw JOIN bw USING (w) GROUP BY 1, 2, 3)"

SQL = {
    "b09_context_fallback": r"WITH h AS (SELECT chunk_id, unnest(regexp_extract_all(text, '<!-- (?:SECTION|CONTEXT): (\S+) \|', 1)) AS id FROM graph_chunks) SELECT key, min(chunk_id) AS found_in FROM toc LEFT JOIN h USING (id) WHERE key NOT IN (SELECT section_id FROM graph_chunks WHERE section_id IS NOT NULL) GROUP BY 1",
    "b13_inline_chapters": "SELECT key, CAST(1 AS INT) AS n, title AS part FROM toc UNION ALL SELECT key, 2, chapter FROM toc",
    "c14_flat_headers": "SELECT chunk_id, trim(regexp_replace(h, '(?i)<br\\s*/?>', ' ', 'g')) AS header FROM (SELECT chunk_id, unnest(t.headers) AS h FROM " + _T + ")",
    "c15_source_census": "SELECT * FROM (SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)<table')) AS INT) AS tables, CAST(len(regexp_extract_all(text, '(?i)<tr[ >]')) AS INT) AS rows, CAST(len(regexp_extract_all(text, '(?i)<td[ >]')) AS INT) AS cells FROM documents WHERE text IS NOT NULL) WHERE tables > 0",
    "c18_ranges": f"SELECT len(list_filter(flatten(list_transform(t.rows[1:10], lambda r: map_values(r))), lambda c: regexp_full_match(c.s, '\\s*[\\d.,]+\\s*[~-]\\s*[\\d.,]+\\s*'))) >= 2 AS ranges, len(t.headers) >= 3 AND len(list_filter(t.headers, lambda h: regexp_full_match(h, '\\s*[\\d,.]+\\s*'))) >= len(t.headers) * 0.5 AS matrix, count(*) AS n FROM {_T} GROUP BY 1, 2",
    "c32_row_words": f"SELECT len(list_filter(t.rows[1:5], lambda r: regexp_matches(coalesce(map_values(r)[1].s, ''), '{'|'.join(rules.HEADER_ROLES['labor'])}'))) > 0 AS has_trade, count(*) AS tables, CAST(sum(len(list_filter(t.rows, lambda r: len(list_filter(map_values(r), lambda c: c.n IS NOT NULL)) > 0))) AS BIGINT) AS numeric_rows FROM {_T} GROUP BY 1",
    "d19_estimates": "SELECT chunk_id, CAST(coalesce(list_sum(list_transform(flatten(flatten(list_transform(tables, lambda t: list_transform(t.rows, lambda r: map_values(r))))), lambda c: ceil(coalesce(length(c.s), 0) / 2.0))), 0) AS INT) AS size FROM graph_chunks WHERE tables IS NOT NULL",
    "f03_entity_keys": "SELECT concat_ws('::', type, lower(normalized_name), CASE WHEN type IN ('WorkType', 'Equipment', 'Material') THEN nullif(trim(spec, ' '), '') END, nullif(trim(sub_section, ' '), '')) AS key, count(*) AS n FROM entities GROUP BY 1 HAVING count(*) > 1",
    "g04_dedup_keys": "SELECT type, CASE WHEN type = 'Section' THEN '' ELSE coalesce(normalized_name, '') END AS name, CASE WHEN type IN ('WorkType', 'Equipment', 'Material') THEN coalesce(spec, '') WHEN type = 'Note' THEN coalesce(source_section_id, '') WHEN type = 'Section' THEN coalesce(code, '') ELSE '' END AS extra, count(*) AS n FROM entities GROUP BY 1, 2, 3",
    "g18_flat_edges": "SELECT source, target, type, quantity, unit, per_unit, count(*) AS n FROM relationships GROUP BY ALL",
    "h04_token_distribution": f"WITH s AS (SELECT list_sort(list({_LEN2})) AS v FROM graph_chunks) SELECT CAST(len(v) AS BIGINT) AS n, v[1] AS least, v[-1] AS most, v[CAST(floor(len(v) * 0.25) AS INT) + 1] AS p25, v[CAST(floor(len(v) * 0.5) AS INT) + 1] AS p50, v[CAST(floor(len(v) * 0.75) AS INT) + 1] AS p75, v[CAST(floor(len(v) * 0.95) AS INT) + 1] AS p95 FROM s",
    "h17_numbers": r"SELECT doc_id, CAST(len(n) AS INT) AS numbers, CAST(len(list_distinct(n)) AS INT) AS different FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\d+(?:,\d{3})*(?:\.\d+)?') AS n FROM documents)",
    "h30_tokens": "SELECT row_id, array_to_string(list_sort(list_distinct(list_filter(string_split(lower(regexp_replace(name, '[^0-9A-Za-z_가-힣]+', ' ', 'g')), ' '), lambda w: w <> ''))), ' ') AS tokens FROM entities WHERE name IS NOT NULL",
    "h33_table_counts": "SELECT section_id, raw, parsed, raw > parsed + 1 AS short FROM (SELECT section_id, CAST(sum(coalesce(len(regexp_extract_all(text, '<table')), 0)) AS BIGINT) AS raw, CAST(sum(coalesce(len(tables), 0)) AS BIGINT) AS parsed FROM graph_chunks GROUP BY 1) WHERE raw > 0",
    "h34_header_families": f"SELECT CASE WHEN contains(h, '수량') AND contains(h, '단위') THEN 'quantity' WHEN regexp_matches(h, '규격|치수|size') THEN 'size' WHEN regexp_matches(h, '비고|note|remark') THEN 'note' ELSE 'other' END AS family, count(*) AS n FROM (SELECT array_to_string(t.headers, ' ') AS h FROM {_T}) GROUP BY 1",
    "h50_preserved": "WITH n AS (SELECT DISTINCT type, name FROM graph_entities), r AS (SELECT DISTINCT rel_id, source_type, source, target_type, target FROM relationships) SELECT EXISTS (SELECT 1 FROM n WHERE n.type = r.source_type AND n.name = r.source) AS source_ok, EXISTS (SELECT 1 FROM n WHERE n.type = r.target_type AND n.name = r.target) AS target_ok, count(*) AS n FROM r GROUP BY 1, 2",
    "h56_recount": f"SELECT count(*) FILTER (quantity > CASE type WHEN 'REQUIRES_LABOR' THEN 75 WHEN 'REQUIRES_EQUIPMENT' THEN 3300 WHEN 'USES_MATERIAL' THEN 225 END) AS outliers, count(*) FILTER (NOT coalesce({_OK}, false)) AS direction_errors, count(*) AS n FROM relationships",
    "i08_self_query": "SELECT qid, vec_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS rank FROM (SELECT a.vec_id AS qid, b.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0) WHERE s > 0) WHERE rank <= 3",
    "j01_intent": "SELECT lang, count(*) FILTER (regexp_matches(lower(text), '얼마|몇|how much|how many|수량')) AS asks, count(*) AS n FROM documents GROUP BY 1",
    "j10_keyword_fallback": "WITH " + _HIT("SELECT key AS qid, split_part(title, ' ', 1) || ' ' || split_part(title, ' ', -1) AS question FROM toc", f"SELECT id, unnest({_W('name')}) AS w FROM (SELECT id, decode(min(encode(name))) AS name, min(type) AS type FROM graph_entities WHERE coalesce(is_active, true) GROUP BY 1) WHERE type IN ('WorkType', 'Material')") + " SELECT qid, id FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY hits * 2 + CASE WHEN hits = asked THEN 1 ELSE 0 END DESC, id) AS rank FROM h) WHERE rank <= 5 AND hits = asked",
    "j11_body_fallback": "WITH " + _HIT("SELECT key AS qid, title AS question FROM toc", f"SELECT DISTINCT section_id AS id, unnest({_W('text')}) AS w FROM graph_chunks WHERE text IS NOT NULL") + " SELECT DISTINCT qid, id FROM h WHERE hits = asked",
    "k17_consistent_chunks": "WITH c AS (SELECT DISTINCT section_id, chunk_id FROM graph_chunks), u AS (SELECT c.*, 1 AS stage FROM c WHERE EXISTS (SELECT 1 FROM entities e WHERE e.source_section_id = c.section_id AND e.source_chunk_id = c.chunk_id) UNION ALL SELECT c.*, 2 FROM c) SELECT section_id, chunk_id, stage FROM (SELECT *, min(stage) OVER (PARTITION BY section_id) AS m FROM u) WHERE stage = m",
    "l05_daily_windows": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
}
