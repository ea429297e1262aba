"""Queries of tables, text cleaning and chunking (operators C and D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import tables as T, texts as X
from lodegraph.plans.session import load


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "graph_chunks")


def _tables(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("chunk_id", F.explode("tables").alias("t"))


def c01_table_regions(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.posexplode(T.regions(F.col("text"))).alias("i", "html")).select("doc_id", (F.col("i") + 1).alias("table_no"), F.length("html").alias("chars"))


def c02_without_tables(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").filter("text like '%<table%'").select("doc_id", F.md5(T.without_tables(F.col("text"))).alias("rest"))


def c03_grid_cells(spark: SparkSession, d: str) -> DataFrame:
    g = T.grids(load(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return g.select("doc_id", "table_no", F.posexplode("grid").alias("r", "row")).select("doc_id", "table_no", (F.col("r") + 1).alias("row_no"), F.posexplode("row").alias("c", "cell")).select("doc_id", "table_no", "row_no", (F.col("c") + 1).alias("col_no"), "cell")


def c04_cell_text(spark: SparkSession, d: str) -> DataFrame:
    cells = F.regexp_extract_all("text", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))
    return load(spark, d, "documents").select("doc_id", F.explode(cells).alias("c")).select("doc_id", T.cell_text(F.col("c")).alias("cell"))


def c07_header_like(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select("chunk_id", F.col("t.table_id").alias("table_id"), T.header_like(F.col("t.headers")).alias("header_like"), (F.size(F.array_distinct("t.headers")) < F.size("t.headers")).alias("repeats"))


def c09_note_rows(spark: SparkSession, d: str) -> DataFrame:
    r = _tables(spark, d).select("chunk_id", F.col("t.table_id").alias("table_id"), F.explode("t.rows").alias("r"))
    cells = F.transform(F.map_values("r"), lambda c: F.coalesce(c["s"], F.lit("")))
    return r.groupBy("chunk_id", "table_id").agg(F.count_if(T.is_note_row(cells)).alias("note_rows"), F.count(F.lit(1)).alias("all_rows"))


def c10_numbers(spark: SparkSession, d: str) -> DataFrame:
    c = T.long_cells(_chunks(spark, d), ["chunk_id"])
    return c.select("chunk_id", "table_id", "row_no", "header", "s", T.number_of(F.col("s")).alias("number"), T.cell_quantity(F.col("s")).alias("quantity"))


def c11_table_types(spark: SparkSession, d: str) -> DataFrame:
    first = F.transform("t.rows", lambda r: F.coalesce(F.get(F.map_values(r), F.lit(0))["s"], F.lit("")))
    return _tables(spark, d).select("chunk_id", F.col("t.table_id").alias("table_id"), T.table_type(F.col("t.headers"), first).alias("kind"))


def c13_section_tables(spark: SparkSession, d: str) -> DataFrame:
    c = _chunks(spark, d)
    return c.select("chunk_id", F.coalesce(F.size("tables"), F.lit(0)).alias("n_tables"), F.coalesce(F.aggregate(F.transform("tables", lambda t: F.size(t["rows"])), F.lit(0), lambda a, x: a + x), F.lit(0)).alias("n_rows"))


def c16_row_groups(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every table packed under 40 size units with the header charged to each piece."""
    t = _tables(spark, d).select("chunk_id", F.col("t.table_id").alias("table_id"), F.transform("t.rows", T.row_text).alias("r"), X.token_count(F.array_join("t.headers", " ")).alias("h"))
    got = t.select("chunk_id", "table_id", F.posexplode(T.split_rows(F.col("r"), budget=40, header_size=F.col("h"))).alias("i", "part"))
    return got.select("chunk_id", F.concat("table_id", F.lit("-"), F.col("i") + 1).alias("piece_id"), F.size("part").alias("n_rows"))


def c17_table_patterns(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    p = F.when(F.size("t.rows") == 0, "empty").when(T.is_matrix(F.col("t.headers")), "matrix").when(T.has_ranges(F.col("t.rows")), "range").otherwise("other")
    return t.groupBy(p.alias("pattern")).agg(F.count(F.lit(1)).alias("n_tables"), F.countDistinct("chunk_id").alias("n_chunks"))


def c20_piecewise(spark: SparkSession, d: str) -> DataFrame:
    l = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    got = T.piecewise(l, "l_quantity", [(5.0, 1.0), (20.0, 1.6), (40.0, 2.0)])
    return got.select("l_orderkey", "l_linenumber", F.round("factor", 6).alias("factor"))


def c21_unpivot(spark: SparkSession, d: str) -> DataFrame:
    l = load(spark, d, "lineitem")
    return T.unpivot_wide(l, ["l_orderkey", "l_linenumber"], {"l_quantity": ("quantity", "base"), "l_discount": ("discount", "rate"), "l_tax": ("tax", "rate")}, ("measure", "class"), "value")


def c23_same_headers(spark: SparkSession, d: str) -> DataFrame:
    return T.union_same_headers(_chunks(spark, d), "section_id")


def c24_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select("chunk_id", F.col("t.table_id").alias("table_id"), F.md5(T.to_markdown(F.col("t"))).alias("markdown"))


def c25_flat_text(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).filter("tables is not null").select("chunk_id", F.md5(T.flat_text(F.col("tables"))).alias("flat"))


def c33_unhandled(spark: SparkSession, d: str) -> DataFrame:
    """Tables of the last type by section, with their number of numeric cells."""
    t = _chunks(spark, d).select("section_id", F.explode("tables").alias("t")).filter("t.type like 'D%'")
    num = F.size(F.filter(F.flatten(F.transform("t.rows", lambda r: F.map_values(r))), lambda c: c["n"].isNotNull()))
    return t.groupBy("section_id").agg(F.count(F.lit(1)).alias("n_tables"), F.sum(num).alias("numeric_cells"))


def d01_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes with a block of their own, by chunk; the oracle counts circled numbers in simple blocks."""
    c = _chunks(spark, d).filter("text is not null").select("chunk_id", F.explode(X.notes(F.col("text"))).alias("note"))
    return c.select("chunk_id", "note")


def d02_rates(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.explode(X.rates(F.col("text"))).alias("x")).select("doc_id", "x.condition", "x.rate", "x.type")


def d03_references(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ", F.transform("cross_references", lambda x: x["context"]))
    return _chunks(spark, d).select("chunk_id", F.explode(X.cross_references(text)).alias("x")).select("chunk_id", "x.*")


def d04_revision(spark: SparkSession, d: str) -> DataFrame:
    """Years written as a mark and read back, from the year column."""
    c = _chunks(spark, d).select("chunk_id", "revision_year", F.format_string("('%s년 보완)", F.substring("revision_year", 3, 2)).alias("mark"))
    return c.select("chunk_id", "revision_year", F.when(F.col("revision_year").rlike(r"^\d{4}$"), X.revision_year(F.col("mark"))).alias("read"))


def d05_unit_basis(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("chunk_id", X.unit_basis(F.concat(F.lit("("), F.coalesce("unit_basis", F.lit("")), F.lit(")"))).alias("basis"))


def d06_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).filter("text is not null").select("chunk_id", F.md5(X.clean_text(F.col("text"))).alias("clean"))


def d07_own_notes(spark: SparkSession, d: str) -> DataFrame:
    c = _chunks(spark, d).select("chunk_id", "notes", F.flatten(F.transform("tables", lambda t: t["notes_in_table"])).alias("tn"))
    return c.select("chunk_id", F.size(X.drop_contained(F.col("notes"), F.col("tn"))).alias("kept"), F.size("notes").alias("n_notes")).filter("n_notes >= 0")


def d09_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", X.token_count(F.col("text")).alias("size"), X.word_count(F.col("text")).alias("words"))


def d10_chunk_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("chunk_id", X.chunk_tokens(F.col("text"), F.col("tables"), F.col("notes")).alias("tokens"), "token_count")


def d11_parts(spark: SparkSession, d: str) -> DataFrame:
    """Paragraph packing under 300; the parts of a chunk hold all its words."""
    c = _chunks(spark, d).filter("text is not null").select("chunk_id", "text", F.posexplode(X.paragraph_parts(F.col("text"), 300)).alias("i", "part"))
    return c.groupBy("chunk_id", F.md5("text").alias("text_hash")).agg(F.sum(X.word_count(F.col("part"))).alias("words"), F.count(F.lit(1)).alias("parts")).drop("text_hash", "parts")


def d17_token_stats(spark: SparkSession, d: str) -> DataFrame:
    c = _chunks(spark, d).withColumn("size", X.token_count(F.col("text")))
    return c.groupBy("department").agg(F.count(F.lit(1)).alias("chunks"), F.min("size").alias("least"), F.max("size").alias("most"), F.round(F.avg("size"), 6).alias("mean"), F.count_if(F.col("size") > 2000).alias("over"))


def d18_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return X.picked_percentiles(_chunks(spark, d).withColumn("size", X.token_count(F.col("text"))), "size", [0.5, 0.9, 0.95, 0.99], ["department"])


QUERIES = {k: v for k, v in globals().items() if k[:1] in "cd" and k[1:3].isdigit()}

_T = "(SELECT chunk_id, section_id, unnest(tables) AS t FROM graph_chunks)"
_LEN2 = "CAST(ceil(coalesce(length({0}), 0) / 2.0) AS INT)"
_KW = lambda words, text: "(" + " + ".join(f"CAST(contains({text}, '{w}') AS INT)" for w in words) + ")"
_H = "lower(array_to_string(t.headers, ' '))"

SQL = {
    "c01_table_regions": "SELECT doc_id, CAST(i AS INT) AS table_no, CAST(length(h[i]) AS INT) AS chars FROM (SELECT doc_id, h, unnest(range(1, len(h) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '(?is)<table[^>]*>.*?</table>') AS h FROM documents))",
    "c02_without_tables": "SELECT doc_id, md5(trim(regexp_replace(text, '(?is)<table[^>]*>.*?</table>', '', 'g'))) AS rest FROM documents WHERE text LIKE '%<table%'",
    "c04_cell_text": r"SELECT doc_id, trim(regexp_replace(replace(replace(replace(regexp_replace(c, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '\s+', ' ', 'g')) AS cell FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?is)<td[^>]*>(.*?)</td>', 1)) AS c FROM documents)",
    "c07_header_like": f"SELECT chunk_id, t.table_id AS table_id, len(list_filter(t.headers, lambda x: length(x) > 0 AND NOT regexp_full_match(x, '[\\d,.\\-\\s]*'))) > len(t.headers) * 0.5 AS header_like, len(list_distinct(t.headers)) < len(t.headers) AS repeats FROM {_T}",
    "c09_note_rows": f"""WITH r AS (SELECT chunk_id, t.table_id AS table_id, unnest(t.rows) AS r FROM {_T}),
        c AS (SELECT *, list_transform(map_values(r), lambda x: coalesce(x.s, '')) AS cells FROM r), x AS (SELECT *, trim(array_to_string(cells, ' ')) AS txt, list_filter(cells, lambda x: trim(x) <> '') AS full_cells FROM c)
        SELECT chunk_id, table_id, count(*) FILTER (txt <> '' AND (regexp_matches(txt, '\\[주\\]|〔주〕|【주】|^[①-⑮㉮-㉷]|^비\\s*고') OR txt LIKE '- %' OR txt LIKE '– %'
        OR (len(full_cells) = 1 AND (length(full_cells[1]) > 50 OR regexp_matches(full_cells[1], '^\\(\\d{{4}}\\)\\s*.+') OR regexp_matches(full_cells[1], '^\\d+-\\d+(?:-\\d+)?\\s+.{{4,}}'))))) AS note_rows, count(*) AS all_rows FROM x GROUP BY 1, 2""",
    "c10_numbers": f"""WITH r AS (SELECT chunk_id, t.table_id AS table_id, unnest(t.rows) AS r, unnest(range(1, len(t.rows) + 1)) AS row_no FROM {_T}),
        c AS (SELECT chunk_id, table_id, CAST(row_no AS INT) AS row_no, unnest(map_keys(r)) AS header, unnest(map_values(r)) AS v FROM r), x AS (SELECT chunk_id, table_id, row_no, header, v.s AS s, replace(trim(v.s), ',', '') AS b FROM c)
        SELECT chunk_id, table_id, row_no, header, s, CASE WHEN regexp_full_match(b, '-?\\d+') OR (regexp_full_match(b, '-?\\d*\\.\\d+') AND b NOT LIKE '%0') THEN TRY_CAST(b AS DOUBLE) END AS number, TRY_CAST(regexp_replace(b, '^\\((.*)\\)$', '\\1') AS DOUBLE) AS quantity FROM x""",
    "c11_table_types": f"""SELECT chunk_id, t.table_id AS table_id, CASE WHEN {_KW(T.TYPE_A, _H)} >= 2 OR (len(t.rows) >= 2 AND len(list_filter(t.rows, lambda r: regexp_matches(replace(coalesce(map_values(r)[1].s, ''), ' ', ''), '{"|".join(T.TYPE_A_ROWS)}'))) >= 2) THEN 'A'
        WHEN {_KW(T.TYPE_B, _H)} > 0 THEN 'B' WHEN len(t.headers) = 2 AND {_KW(T.TYPE_C, _H)} > 0 THEN 'C' ELSE 'D' END AS kind FROM {_T}""",
    "c13_section_tables": "SELECT chunk_id, CAST(coalesce(len(tables), 0) AS INT) AS n_tables, CAST(coalesce(list_sum(list_transform(tables, lambda t: len(t.rows))), 0) AS INT) AS n_rows FROM graph_chunks",
    "c17_table_patterns": f"""SELECT CASE WHEN len(t.rows) = 0 THEN 'empty' WHEN len(t.headers) >= 4 AND len(list_filter(t.headers, lambda h: regexp_full_match(h, '\\s*[\\d,.]+\\s*'))) >= len(t.headers) * 0.5 THEN 'matrix'
        WHEN len(list_filter(flatten(list_transform(t.rows[1:10], lambda r: map_values(r))), lambda c: regexp_full_match(c.s, '\\s*[\\d.,]+\\s*[~-]\\s*[\\d.,]+\\s*'))) >= 2 THEN 'range' ELSE 'other' END AS pattern, count(*) AS n_tables, count(DISTINCT chunk_id) AS n_chunks FROM {_T} GROUP BY 1""",
    "c20_piecewise": "SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity <= 5 THEN 1.0 WHEN l_quantity <= 20 THEN 1.0 + (l_quantity - 5) * (0.6 / 15) WHEN l_quantity <= 40 THEN 1.6 + (l_quantity - 20) * (0.4 / 20) ELSE 2.0 END, 6) AS factor FROM lineitem",
    "c21_unpivot": "SELECT * FROM (SELECT l_orderkey, l_linenumber, 'quantity' AS measure, 'base' AS class, round(l_quantity, 3) AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'discount', 'rate', round(l_discount, 3) FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'tax', 'rate', round(l_tax, 3) FROM lineitem) WHERE value > 0",
    "c23_same_headers": f"SELECT section_id, array_to_string(t.headers, '|') AS headers, count(*) AS n_tables, CAST(sum(len(t.rows)) AS BIGINT) AS n_rows FROM {_T} GROUP BY 1, 2",
    "c24_markdown": f"""SELECT chunk_id, t.table_id AS table_id, md5(array_to_string(list_concat([array_to_string(t.headers, ' | '), array_to_string(list_transform(t.headers, lambda h: '---'), ' | ')], list_transform(t.rows, lambda r: array_to_string(list_transform(t.headers, lambda h: coalesce(r[h].s, '')), ' | ')), list_transform(t.notes_in_table[1:1], lambda n: substr(n, 1, 300))), chr(10))) AS markdown FROM {_T}""",
    "c25_flat_text": "SELECT chunk_id, md5(array_to_string(flatten(list_transform(tables, lambda t: list_concat(t.headers, flatten(list_transform(t.rows, lambda r: list_transform(map_values(r), lambda c: coalesce(c.s, ''))))))), ' ')) AS flat FROM graph_chunks WHERE tables IS NOT NULL",
    "c33_unhandled": f"SELECT section_id, count(*) AS n_tables, CAST(sum(len(list_filter(flatten(list_transform(t.rows, lambda r: map_values(r))), lambda c: c.n IS NOT NULL))) AS BIGINT) AS numeric_cells FROM {_T} WHERE t.type LIKE 'D%' GROUP BY 1",
    "d02_rates": r"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\n.]{2,60}?(?:경우|때|면)[^\n%]{0,60}?\d+%[^\n]{0,40}?(?:가산|감산|감하여|할증|더한다|늘려|증)')) AS x FROM documents)
        SELECT doc_id, trim(regexp_extract(x, '([^\n.]{2,60}?(?:경우|때|면))[^\n%]{0,60}?(\d+)%', 1)) AS condition, regexp_extract(x, '([^\n.]{2,60}?(?:경우|때|면))[^\n%]{0,60}?(\d+)%', 2) || '%' AS rate, CASE WHEN regexp_matches(x, '감산$|감하여$') THEN 'deduct' ELSE 'add' END AS type FROM h""",
    "d03_references": r"""WITH h AS (SELECT chunk_id, unnest(regexp_extract_all(array_to_string(list_filter(list_transform(cross_references, lambda x: x.context), lambda x: x IS NOT NULL), ' '), '(?:제\d+장\s+)?\d+-\d+(?:-\d+)?\s*(?:항?\s*)?(?:참조|준용|적용|따른다)')) AS x FROM graph_chunks)
        SELECT chunk_id, regexp_extract(x, '(\d+-\d+(?:-\d+)?)\s*(?:항?\s*)?(?:참조|준용|적용|따른다)', 1) AS target_section_id, coalesce(regexp_extract(x, '^제(\d+)장', 1), '') AS target_chapter FROM h""",
    "d04_revision": "SELECT chunk_id, revision_year, CASE WHEN regexp_full_match(revision_year, '\\d{4}') THEN CASE WHEN CAST(substr(revision_year, 3, 2) AS INT) < 50 THEN '20' ELSE '19' END || substr(revision_year, 3, 2) END AS read FROM graph_chunks",
    "d05_unit_basis": "SELECT chunk_id, CASE WHEN unit_basis LIKE '%당' THEN unit_basis ELSE '' END AS basis FROM graph_chunks",
    "d06_clean_text": r"SELECT chunk_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '(?m)^제\d+장\s+.+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS clean FROM graph_chunks WHERE text IS NOT NULL",
    "d07_own_notes": r"""WITH c AS (SELECT chunk_id, notes, flatten(list_transform(coalesce(tables, []), lambda t: t.notes_in_table)) AS tn FROM graph_chunks WHERE notes IS NOT NULL)
        SELECT chunk_id, CAST(len(list_filter(notes, lambda n: len(list_filter(tn, lambda t: regexp_replace(t, '\s+', '', 'g') <> '' AND (contains(regexp_replace(n, '\s+', '', 'g'), regexp_replace(t, '\s+', '', 'g')) OR contains(regexp_replace(t, '\s+', '', 'g'), regexp_replace(n, '\s+', '', 'g'))))) = 0)) AS INT) AS kept, CAST(len(notes) AS INT) AS n_notes FROM c""",
    "d09_token_counts": f"SELECT doc_id, {_LEN2.format('text')} AS size, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')) AS INT) AS words FROM documents",
    "d10_chunk_tokens": f"""SELECT chunk_id, CAST({_LEN2.format('text')} + coalesce(list_sum(list_transform(flatten(flatten(list_transform(tables, lambda t: list_transform(t.rows, lambda r: map_values(r))))), lambda c: ceil(coalesce(length(c.s), 0) / 2.0))), 0) + coalesce(list_sum(list_transform(notes, lambda n: ceil(length(n) / 2.0))), 0) AS INT) AS tokens, token_count FROM graph_chunks""",
    "d11_parts": "SELECT chunk_id, CAST(sum(w) AS BIGINT) AS words FROM (SELECT chunk_id, text, sum(len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> ''))) AS w FROM graph_chunks WHERE text IS NOT NULL GROUP BY 1, 2) WHERE w > 0 GROUP BY chunk_id, text",
    "d17_token_stats": f"SELECT department, count(*) AS chunks, min({_LEN2.format('text')}) AS least, max({_LEN2.format('text')}) AS most, round(avg({_LEN2.format('text')}), 6) AS mean, count(*) FILTER ({_LEN2.format('text')} > 2000) AS over FROM graph_chunks GROUP BY 1",
    "d18_percentiles": f"""WITH s AS (SELECT department, list_sort(list({_LEN2.format('text')})) AS v FROM graph_chunks GROUP BY 1)
        SELECT department, CAST(len(v) AS BIGINT) AS n, v[1] AS least, v[-1] AS most, v[CAST(floor(len(v) * 0.5) AS INT) + 1] AS p50, v[CAST(floor(len(v) * 0.9) AS INT) + 1] AS p90, v[CAST(floor(len(v) * 0.95) AS INT) + 1] AS p95, v[CAST(floor(len(v) * 0.99) AS INT) + 1] AS p99 FROM s""",
}
