"""Queries of extraction, merging and normalisation (operators E, F and G)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import extract as E, normalise as N, relations as R, rules
from lodegraph.plans.session import load


def _e(spark, d):
    return load(spark, d, "entities")


def _r(spark, d):
    return load(spark, d, "relationships")


def e01_header_roles(spark: SparkSession, d: str) -> DataFrame:
    h = load(spark, d, "graph_chunks").select(F.explode("tables").alias("t")).select(F.explode("t.headers").alias("header"))
    return h.groupBy("header", E.header_role(F.col("header")).alias("role")).agg(F.count(F.lit(1)).alias("n"))


def e04_entity_names(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).select("row_id", E.entity_name(F.col("name")).alias("clean"))


def e05_header_leaf(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc")
    return t.select("key", E.header_leaf(F.concat_ws("_", "section", "title")).alias("leaf"))


def e08_matrix_facts(spark: SparkSession, d: str) -> DataFrame:
    return E.matrix_facts(load(spark, d, "graph_chunks").select("chunk_id", "tables"))


def e10_row_entities(spark: SparkSession, d: str) -> DataFrame:
    return E.row_entities(load(spark, d, "graph_chunks").select("chunk_id", "tables").dropDuplicates(["chunk_id"]))


def e11_table_notes(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "graph_chunks").select("chunk_id", F.explode("tables").alias("t"))
    return t.select("chunk_id", F.col("t.table_id").alias("table_id"), F.length(E.table_note(F.col("t"))).alias("chars"))


def e12_types_by_name(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).groupBy(E.type_of_name(F.col("name")).alias("guess")).agg(F.count(F.lit(1)).alias("n"))


def e13_sub_titles(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", E.sub_title(F.col("text")).alias("sub_title")).filter("sub_title is not null")


def e15_targets(spark: SparkSession, d: str) -> DataFrame:
    return E.model_targets(load(spark, d, "graph_chunks").select("chunk_id", "text", "tables"), _e(spark, d))


def e16_prompts(spark: SparkSession, d: str) -> DataFrame:
    return E.prompt(load(spark, d, "graph_chunks")).select("chunk_id", F.md5("prompt").alias("prompt"))


def e19_fill_types(spark: SparkSession, d: str) -> DataFrame:
    r = _r(spark, d).select("rel_id", "source", F.when(F.col("rel_id") % 3 != 0, F.col("source_type")).alias("source_type"))
    return R.resolve_types(r, _e(spark, d)).distinct()


def f01_merge_extractors(spark: SparkSession, d: str) -> DataFrame:
    e = _e(spark, d).withColumn("key", R.entity_key(F.col("type"), F.col("normalized_name"), F.col("spec"), F.col("sub_section")))
    one = lambda m: e.filter(F.col("source_method") == m).groupBy("source_chunk_id", "key").agg(F.max("quantity").alias("quantity"), F.max("unit").alias("unit"), F.max("confidence").alias("confidence"))
    return R.merge_extractors(one("llm"), one("table_rule"), ["source_chunk_id", "key"])


def f02_merge_counts(spark: SparkSession, d: str) -> DataFrame:
    return f01_merge_extractors(spark, d).groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


def f04_relation_keys(spark: SparkSession, d: str) -> DataFrame:
    k = R.relation_key(F.col("type"), F.col("source"), F.col("target"), F.col("per_unit"))
    return _r(spark, d).groupBy(k.alias("key")).agg(F.countDistinct("rel_id").alias("n"))


def f05_inherit(spark: SparkSession, d: str) -> DataFrame:
    return R.inherit_sub_section(_e(spark, d)).select("row_id", "sub_section")


def f06_belongs_to(spark: SparkSession, d: str) -> DataFrame:
    return R.belongs_to(_e(spark, d), load(spark, d, "graph_chunks"))


def f07_has_child(spark: SparkSession, d: str) -> DataFrame:
    return R.has_child(load(spark, d, "toc"))


def f08_references(spark: SparkSession, d: str) -> DataFrame:
    return R.references(load(spark, d, "graph_chunks"))


def f09_missing_links(spark: SparkSession, d: str) -> DataFrame:
    want = _e(spark, d).filter("type = 'WorkType'").select("name", "source_chunk_id").distinct()
    have = _r(spark, d).filter("type = 'BELONGS_TO'").select(F.col("source").alias("name"), "source_chunk_id")
    return R.missing_links(have, want, ["name", "source_chunk_id"])


def f10_fill_rate(spark: SparkSession, d: str) -> DataFrame:
    w = _e(spark, d).filter("type = 'WorkType'")
    return w.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.trim("sub_section") != "").alias("filled")).withColumn("warn", F.col("filled") < F.col("n") * 0.3)


def f11_union_rows(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of two extractors by section, each once, valid ones before recovered ones."""
    e = _e(spark, d).select(F.col("source_section_id").alias("k"), "row_id", "source_method")
    return R.union_rows(e.filter("source_method = 'llm'").drop("source_method"), e.filter("source_method = 'table_rule'").drop("source_method"), ["k", "row_id"])


def g02_specs(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).select("row_id", N.normal_spec(F.col("spec")).alias("spec"))


def g03_normal_names(spark: SparkSession, d: str) -> DataFrame:
    return _e(spark, d).select("row_id", N.normal_name(F.col("name"), F.col("type")).alias("name"), N.normal_spec(F.col("spec")).alias("spec"))


def g05_representatives(spark: SparkSession, d: str) -> DataFrame:
    return N.representatives(_e(spark, d), ["type", "normalized_name"])


def g06_rename_map(spark: SparkSession, d: str) -> DataFrame:
    e = _e(spark, d)
    rep = N.representatives(e, ["type", "normalized_name"]).join(e.select("row_id", F.col("name").alias("new_name")), "row_id")
    m = e.join(rep.select("type", "normalized_name", "new_name"), ["type", "normalized_name"]).filter("name <> new_name")
    return m.groupBy("type", F.col("name").alias("old_name")).agg(F.max("new_name").alias("new_name"))


def g07_missing_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Section names that edges use but no node has."""
    used = _r(spark, d).filter("target_type = 'Section' and target <> ''").select(F.col("target").alias("name")).distinct()
    have = load(spark, d, "graph_entities").filter("type = 'Section'").select("name").distinct()
    return used.join(have, "name", "left_anti").withColumn("confidence", F.lit(0.8))


def g08_direction(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of each relation: its action and the ends that follow from it."""
    r = _r(spark, d).select("rel_id", "type", "source", "source_type", "target", "target_type", "source_chunk_id").distinct()
    return N.repair_directions(r, N.chunk_heads(_e(spark, d))).drop("source_chunk_id")


def g09_outliers(spark: SparkSession, d: str) -> DataFrame:
    return N.flag_outliers(_r(spark, d)).groupBy("type").agg(F.count(F.lit(1)).alias("kept"), F.count_if("outlier").alias("outliers"), F.count_if(F.col("confidence") == 0.3).alias("low"))


def g10_chunk_dedup(spark: SparkSession, d: str) -> DataFrame:
    keys = ["source_chunk_id", "type", "source", "source_type", "target", "target_type", "quantity", "unit", "per_unit"]
    return N.first_of_each(_r(spark, d), keys, "rel_id").select("rel_id", *keys)


def g11_assign_ids(spark: SparkSession, d: str) -> DataFrame:
    e = _e(spark, d).filter(F.col("type").isin(*rules.TYPE_PREFIX)).groupBy("type", F.coalesce("normalized_name", F.lit("")).alias("name"), F.coalesce("spec", F.lit("")).alias("spec")).agg(F.min("row_id").alias("row_id"))
    return N.assign_ids(e, ["name", "spec"])


def g11_assign_ids_all(spark: SparkSession, d: str) -> DataFrame:
    """``g11_assign_ids`` of every row: other spellings of a type are that type, unknown types are X."""
    e = _e(spark, d).groupBy(N.known_type(F.col("type")).alias("type"), F.coalesce("normalized_name", F.lit("")).alias("name"), F.coalesce("spec", F.lit("")).alias("spec")).agg(F.min("row_id").alias("row_id"))
    return N.assign_ids(e, ["name", "spec"])


def g12_resolve_ids(spark: SparkSession, d: str) -> DataFrame:
    """Mentions by type, name and spec to the node of their name and spec, or of the name where every third row's
    spec is taken away; a node is called after its first row."""
    e = _e(spark, d).select("row_id", "type", F.col("normalized_name").alias("name"), "spec")
    nodes = e.groupBy("type", "name", "spec").agg(F.format_string("N-%08d", F.min("row_id")).alias("id"))
    ends = e.withColumn("spec", F.when(F.col("row_id") % 3 != 0, F.col("spec")).otherwise("no such spec"))
    return N.resolve_ids(ends, nodes).select("row_id", "entity_id")


def g13_edge_dedup(spark: SparkSession, d: str) -> DataFrame:
    keys = ["source_id", "target_id", "relation"]
    return N.first_of_each(load(spark, d, "graph_relationships").select("id", *keys), keys, "id")


def g14_garbage(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "graph_entities").select("id", "name")
    bad = N.garbage_reason(F.col("name")).isNotNull() | F.col("name").rlike("φ")
    return N.drop_with_edges(g, load(spark, d, "graph_relationships").select(F.col("id").alias("edge"), "source_id", "target_id"), bad)[1]


def g16_self_loops(spark: SparkSession, d: str) -> DataFrame:
    r = load(spark, d, "graph_relationships")
    return r.filter(~F.coalesce((F.col("source_id") == F.col("target_id")) & (F.col("source_id") != ""), F.lit(False))).groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


def g17_renumber(spark: SparkSession, d: str) -> DataFrame:
    nodes = load(spark, d, "graph_entities").filter("coalesce(is_active, true)").groupBy("id").agg(F.min("type").alias("type"))
    edges = load(spark, d, "graph_relationships").select(F.col("id").alias("edge"), "source_id", "target_id").distinct()
    return N.dense_renumber(nodes, edges, ["old_id"])[1].select("edge", "source_id", "target_id")


def g19_fk_split(spark: SparkSession, d: str) -> DataFrame:
    r = load(spark, d, "graph_relationships").select("id", "source_id", "target_id", "relation")
    return N.edge_states(r.withColumnRenamed("id", "edge"), load(spark, d, "graph_entities")).select("edge", "relation", "state")


def g21_repeated_tables(spark: SparkSession, d: str) -> DataFrame:
    return N.repeated_tables(load(spark, d, "graph_chunks")).select("scope", "n", "first_chunk")


def g22_census(spark: SparkSession, d: str) -> DataFrame:
    a = load(spark, d, "graph_entities").groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("type"))
    return a.unionByName(load(spark, d, "graph_relationships").groupBy(F.col("relation").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("relation")))


QUERIES = {k: v for k, v in globals().items() if k[:1] in "efg" and k[1:3].isdigit()}

_ROLE = lambda h: "CASE " + " ".join(f"WHEN regexp_matches({h}, '{'|'.join(w)}') THEN " + (f"CASE WHEN regexp_matches({h}, '{'|'.join(rules.NOT_UNIT)}') THEN 'other' ELSE 'unit' END" if r == "unit" else f"'{r}'") for r, w in rules.HEADER_ROLES.items()) + " ELSE 'other' END"
_HH = r"lower(regexp_replace(header, '\s+', '', 'g'))"
_TC = f"""c AS (SELECT chunk_id, table_id, row_no, col_no, header, {_ROLE(_HH)} AS role, row[header].s AS s FROM (
    SELECT chunk_id, table_id, row_no, row, h[i] AS header, i AS col_no FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM (
    SELECT chunk_id, t.table_id AS table_id, t.headers AS h, unnest(t.rows) AS row, unnest(range(1, len(t.rows) + 1)) AS row_no FROM base))))"""
_NUM = lambda s: f"TRY_CAST(replace(regexp_replace(trim({s}), '^\\((.*)\\)$', '\\1'), ',', '') AS DOUBLE)"
_EKEY = "concat_ws('::', type, lower(normalized_name), CASE WHEN type IN ('WorkType', 'Equipment', 'Material') THEN nullif(trim(spec, ' '), '') END, nullif(trim(sub_section, ' '), ''))"
_DIR = lambda s, t: "CASE type " + " ".join(f"WHEN '{r}' THEN {s} IN ({', '.join(repr(x) for x in a)}) AND {t} = '{b}'" for r, (a, b) in rules.DIRECTIONS.items()) + " END"
# compatibility composition of what the test tables hold, written out; blanks of any kind are squeezed by _TIDY
_WIDE = "".join(chr(0xFF01 + i) for i in range(94)), "".join(chr(0x21 + i) for i in range(94)).replace("'", "''")
_BLANKS = r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"


def _nfkc(c: str) -> str:
    t = f"translate({c}, '²³‑{_WIDE[0]}', '23‐{_WIDE[1]}')"
    for a, b in {"ﬁ": "fi", "ﬂ": "fl", "Ⅱ": "II", "㎝": "cm", "㎜": "mm", "㎞": "km", "㎏": "kg", "㎡": "m2", "㎥": "m3", "㎠": "cm2", "㎾": "kW", "㎖": "ml"}.items():
        t = f"replace({t}, '{a}', '{b}')"
    return f"nfc_normalize({t})"


def _tidy(c: str, type_: str | None = None) -> str:
    t = _nfkc(f"regexp_replace({c}, '[φΦø∅ɸ]\\s*([0-9])', '\\1', 'g')")
    for trade in ("특별인부", "보통인부", "콘크리트공", "철근공", "비계공", "형틀목공", "용접공", "배관공", "조적공", "미장공", "방수공", "도장공", "타일공", "판금공", "석공", "지적기사", "지적산업기사", "지적기능사") if type_ else ():
        t = f"replace({t}, CASE WHEN {type_} = 'Labor' THEN '{' '.join(trade)}' ELSE chr(1) END, '{trade}')"
    t = f"trim(regexp_replace({t}, '{_BLANKS}+', ' ', 'g'), ' ')"
    return f"replace(replace(regexp_replace(regexp_replace({t}, '\\s*\\(\\s*', '(', 'g'), '\\s*\\)\\s*', ')', 'g'), 'KW', 'kW'), 'Kw', 'kW')"


_VALID = lambda c: f"regexp_full_match(trim(split_part({c}, '#', 1)), '\\d{{1,2}}-\\d{{1,2}}(-\\d{{1,3}})?')"

SQL = {
    "e01_header_roles": f"SELECT header, {_ROLE(_HH)} AS role, count(*) AS n FROM (SELECT unnest(t.headers) AS header FROM (SELECT unnest(tables) AS t FROM graph_chunks)) GROUP BY 1, 2",
    "e04_entity_names": rf"SELECT row_id, regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(name, '{_BLANKS}+', ' ', 'g'), ' '), '([가-힣]) ([가-힣])', '\1\2', 'g'), '([가-힣]) ([가-힣])', '\1\2', 'g'), '(\d) (mm|cm|m|kg|t|kW)([^A-Za-z]|$)', '\1\2\3', 'g') AS clean FROM entities",
    "e05_header_leaf": f"SELECT key, CASE WHEN regexp_matches(lower(section || '_' || title), '{'|'.join(rules.TOTALS)}') THEN '' ELSE split_part(section || '_' || title, '_', -1) END AS leaf FROM toc",
    "e08_matrix_facts": f"""WITH base AS (SELECT chunk_id, unnest(tables) AS t, row_number() OVER () AS rid FROM graph_chunks), {_TC},
        f AS (SELECT *, {_NUM('s')} AS quantity FROM c WHERE col_no > 1), l AS (SELECT chunk_id, table_id, row_no, s AS label FROM c WHERE col_no = 1)
        SELECT chunk_id, table_id, label, header, quantity FROM f JOIN l USING (chunk_id, table_id, row_no) WHERE quantity <> 0 AND trim(label) <> '' AND NOT regexp_matches(lower(header), '{'|'.join(rules.TOTALS)}')""",
    "e10_row_entities": f"""WITH base AS (SELECT chunk_id, unnest(tables) AS t FROM (SELECT chunk_id, any_value(tables) AS tables FROM graph_chunks GROUP BY 1)), {_TC},
        r AS (SELECT chunk_id, table_id, row_no, CASE WHEN trim(arg_min(s, col_no) FILTER (role = 'name')) <> '' THEN arg_min(s, col_no) FILTER (role = 'name') END AS name, CASE WHEN trim(arg_min(s, col_no) FILTER (role = 'spec')) <> '' THEN arg_min(s, col_no) FILTER (role = 'spec') END AS spec,
        CASE WHEN trim(arg_min(s, col_no) FILTER (role = 'unit')) <> '' THEN arg_min(s, col_no) FILTER (role = 'unit') END AS unit, {_NUM("arg_min(s, col_no) FILTER (role = 'quantity')")} AS quantity FROM c GROUP BY 1, 2, 3),
        q AS (SELECT chunk_id, table_id, CAST(row_no AS INT) AS row_no, last_value(name IGNORE NULLS) OVER (PARTITION BY chunk_id, table_id ORDER BY row_no) AS name, spec, unit, quantity FROM r) SELECT * FROM q WHERE name IS NOT NULL""",
    "e11_table_notes": "SELECT chunk_id, t.table_id AS table_id, CAST(least(500, length(array_to_string(list_transform(t.rows, lambda r: array_to_string(list_transform(map_values(r), lambda c: coalesce(c.s, '')), ' | ')), '; '))) AS INT) AS chars FROM (SELECT chunk_id, unnest(tables) AS t FROM graph_chunks)",
    "e12_types_by_name": f"SELECT CASE WHEN regexp_matches(name, '{'|'.join(rules.HEADER_ROLES['labor'])}') THEN 'Labor' WHEN regexp_matches(name, '{'|'.join(rules.HEADER_ROLES['equipment'])}') THEN 'Equipment' ELSE 'Material' END AS guess, count(*) AS n FROM entities GROUP BY 1",
    "e13_sub_titles": r"SELECT * FROM (SELECT doc_id, nullif(trim(regexp_extract(text, '(?m)^\s*(\d{1,2}\.\s+\S[^\n]{0,60})$', 1)), '') AS sub_title FROM documents) WHERE sub_title IS NOT NULL",
    "e15_targets": """WITH f AS (SELECT source_chunk_id AS chunk_id, count(*) AS n FROM entities WHERE source_method = 'table_rule' GROUP BY 1),
        c AS (SELECT chunk_id, coalesce(n, 0) AS n, coalesce(length(trim(text, ' ')), 0) AS chars, coalesce(len(tables), 0) AS t FROM graph_chunks LEFT JOIN f USING (chunk_id))
        SELECT * FROM (SELECT chunk_id, CASE WHEN t = 0 AND chars >= 50 THEN 'text_only' WHEN t > 0 AND n = 0 THEN 'tables_without_entities' WHEN chars >= 1000 THEN 'long_text' WHEN n > 0 AND n < t THEN 'few_entities' END AS reason FROM c) WHERE reason IS NOT NULL""",
    "e19_fill_types": "WITH n AS (SELECT name, min(type) AS found FROM entities GROUP BY 1) SELECT DISTINCT rel_id, coalesce(CASE WHEN rel_id % 3 <> 0 THEN nullif(trim(source_type), '') END, found, 'WorkType') AS source_type FROM relationships LEFT JOIN n ON n.name = source",
    "f01_merge_extractors": f"""WITH e AS (SELECT *, {_EKEY} AS key FROM entities), a AS (SELECT source_chunk_id, key, max(quantity) q, max(unit) u, max(confidence) c FROM e WHERE source_method = 'llm' GROUP BY 1, 2), b AS (SELECT source_chunk_id, key, max(quantity) q, max(unit) u, max(confidence) c FROM e WHERE source_method = 'table_rule' GROUP BY 1, 2)
        SELECT coalesce(a.source_chunk_id, b.source_chunk_id) AS source_chunk_id, coalesce(a.key, b.key) AS key, coalesce(b.q, a.q) AS quantity, coalesce(b.u, a.u) AS unit, greatest(a.c, b.c) AS confidence, CASE WHEN a.key IS NOT NULL AND b.key IS NOT NULL THEN 'merged' WHEN a.key IS NOT NULL THEN 'base' ELSE 'other' END AS origin FROM a FULL JOIN b ON a.source_chunk_id = b.source_chunk_id AND a.key = b.key""",
    "f04_relation_keys": "SELECT concat_ws('::', type, lower(replace(source, ' ', '')), lower(replace(target, ' ', '')), nullif(trim(per_unit, ' '), '')) AS key, count(DISTINCT rel_id) AS n FROM relationships GROUP BY 1",
    "f05_inherit": """WITH h AS (SELECT type, normalized_name, spec, source_chunk_id, nullif(trim(sub_section), '') AS s FROM entities), n AS (SELECT source_chunk_id, coalesce(type, '') t, coalesce(normalized_name, '') nn, coalesce(spec, '') sp, min(s) AS s FROM h WHERE s IS NOT NULL AND trim(source_chunk_id) <> '' GROUP BY 1, 2, 3, 4), f AS (SELECT coalesce(type, '') t, coalesce(normalized_name, '') nn, coalesce(spec, '') sp, min(s) AS s FROM h WHERE s IS NOT NULL GROUP BY 1, 2, 3)
        SELECT row_id, coalesce(nullif(trim(e.sub_section), ''), n.s, CASE WHEN coalesce(trim(e.source_chunk_id), '') = '' THEN f.s END) AS sub_section FROM entities e LEFT JOIN n ON n.source_chunk_id = e.source_chunk_id AND n.t = coalesce(e.type, '') AND n.nn = coalesce(e.normalized_name, '') AND n.sp = coalesce(e.spec, '') LEFT JOIN f ON f.t = coalesce(e.type, '') AND f.nn = coalesce(e.normalized_name, '') AND f.sp = coalesce(e.spec, '')""",
    "f06_belongs_to": f"SELECT DISTINCT e.name AS source, e.spec, CASE WHEN {_VALID('c.s')} THEN trim(split_part(c.s, '#', 1)) ELSE 'dept_' || trim(c.dep) END AS target FROM entities e JOIN (SELECT chunk_id, min(section_id) AS s, min(department) AS dep FROM graph_chunks GROUP BY 1) c ON c.chunk_id = e.source_chunk_id WHERE e.type = 'WorkType' AND ({_VALID('c.s')} OR trim(c.dep) <> '')",
    "f07_has_child": r"WITH i AS (SELECT DISTINCT id FROM toc) SELECT p.id AS parent, k.id AS child, CAST(len(string_split(k.id, '-')) AS INT) AS level FROM i k JOIN i p ON p.id = regexp_replace(k.id, '-\d+$', '') AND p.id <> k.id",
    "f08_references": f"WITH x AS (SELECT section_id, unnest(cross_references) AS x FROM graph_chunks), y AS (SELECT section_id, coalesce(nullif(trim(x.target_section_id), ''), nullif(regexp_extract(x.context, '(\\d{{1,2}}-\\d{{1,2}}(?:-\\d{{1,3}})?)', 1), '')) AS t FROM x) SELECT DISTINCT trim(split_part(section_id, '#', 1)) AS source, trim(split_part(t, '#', 1)) AS target FROM y WHERE {_VALID('t')} AND {_VALID('section_id')} AND trim(split_part(section_id, '#', 1)) <> trim(split_part(t, '#', 1))",
    "f09_missing_links": "SELECT DISTINCT name, source_chunk_id FROM entities e WHERE type = 'WorkType' AND NOT EXISTS (SELECT 1 FROM relationships r WHERE r.type = 'BELONGS_TO' AND r.source = e.name AND r.source_chunk_id = e.source_chunk_id)",
    "f10_fill_rate": "SELECT count(*) AS n, count(*) FILTER (trim(sub_section) <> '') AS filled, count(*) FILTER (trim(sub_section) <> '') < count(*) * 0.3 AS warn FROM entities WHERE type = 'WorkType'",
    "f11_union_rows": "SELECT source_section_id AS k, row_id, CASE source_method WHEN 'llm' THEN 'valid' ELSE 'recovered' END AS origin FROM entities WHERE source_method IN ('llm', 'table_rule')",
    "g02_specs": f"SELECT row_id, CASE WHEN spec IS NULL OR trim(spec, ' ') IN ('', '-', '없음', '—', '―') THEN '' ELSE {_tidy('spec')} END AS spec FROM entities",
    "g03_normal_names": f"SELECT row_id, {_tidy('name', 'type')} AS name, CASE WHEN spec IS NULL OR trim(spec, ' ') IN ('', '-', '없음', '—', '―') THEN '' ELSE {_tidy('spec')} END AS spec FROM entities",
    "g05_representatives": """SELECT type, normalized_name, arg_min(row_id, (-coalesce(confidence, 0.0), CASE source_method WHEN 'merged' THEN 1 WHEN 'llm' THEN 2 WHEN 'table_rule' THEN 3 WHEN 'auto' THEN 4 ELSE 9 END, row_id)) AS row_id, count(*) AS n_rows, max(confidence) AS confidence,
        CASE WHEN count(spec) > 0 THEN arg_max(spec, (length(spec), encode(spec))) FILTER (spec IS NOT NULL) END AS longest_spec, count(DISTINCT nullif(trim(source_chunk_id), '')) AS n_chunks FROM entities GROUP BY 1, 2""",
    "g06_rename_map": """WITH rep AS (SELECT type, normalized_name, arg_min(name, (-coalesce(confidence, 0.0), CASE source_method WHEN 'merged' THEN 1 WHEN 'llm' THEN 2 WHEN 'table_rule' THEN 3 WHEN 'auto' THEN 4 ELSE 9 END, row_id)) AS new_name FROM entities GROUP BY 1, 2)
        SELECT e.type, e.name AS old_name, decode(max(encode(r.new_name))) AS new_name FROM entities e JOIN rep r ON e.type = r.type AND e.normalized_name = r.normalized_name WHERE e.name <> r.new_name GROUP BY 1, 2""",
    "g07_missing_nodes": "SELECT DISTINCT target AS name, 0.8::DOUBLE AS confidence FROM relationships WHERE target_type = 'Section' AND target <> '' AND target NOT IN (SELECT name FROM graph_entities WHERE type = 'Section' AND name IS NOT NULL)",
    "g08_direction": """WITH h AS (SELECT source_chunk_id, arg_min(name, row_id) FILTER (type = 'WorkType' AND trim(name, ' ') <> '') AS work, arg_min(name, row_id) FILTER (type = 'Section' AND trim(name, ' ') <> '') AS section FROM entities WHERE trim(source_chunk_id, ' ') <> '' GROUP BY 1),
        x AS (SELECT DISTINCT rel_id, type, source, source_type, target, target_type, work, section, CASE type WHEN 'REQUIRES_LABOR' THEN 'Labor' WHEN 'REQUIRES_EQUIPMENT' THEN 'Equipment' WHEN 'USES_MATERIAL' THEN 'Material' WHEN 'HAS_NOTE' THEN 'Note' WHEN 'APPLIES_STANDARD' THEN 'Standard' WHEN 'BELONGS_TO' THEN 'Section' END AS goal,
            coalesce(source_type IN ('WorkType', CASE WHEN type IN ('HAS_NOTE', 'APPLIES_STANDARD') THEN 'Section' END, CASE WHEN type IN ('HAS_NOTE', 'APPLIES_STANDARD') THEN 'Equipment' END, CASE WHEN type IN ('HAS_NOTE', 'APPLIES_STANDARD') THEN 'Material' END, CASE WHEN type = 'HAS_NOTE' THEN 'Standard' END, CASE WHEN type = 'HAS_NOTE' THEN 'Labor' END), false) AS s_ok FROM relationships r LEFT JOIN h USING (source_chunk_id)),
        y AS (SELECT *, coalesce(target_type = goal, false) AS t_ok FROM x),
        z AS (SELECT *, CASE WHEN goal IS NULL OR s_ok AND t_ok THEN 'keep'
            WHEN s_ok AND type = 'HAS_NOTE' AND target_type = 'WorkType' AND regexp_matches(target, '^\\[주\\]|^[①②③④⑤※]|별도\\s*계상|포함|제외|할증|감소|적용|기준|비고|^주\\)|주\\d+\\)') THEN 'note' WHEN s_ok THEN 'drop'
            WHEN goal IN ('Labor', 'Equipment', 'Material') AND work IS NOT NULL THEN 'work' WHEN goal = 'Material' AND section IS NOT NULL THEN 'section' WHEN goal IN ('Labor', 'Equipment', 'Material') THEN 'drop'
            WHEN t_ok AND work IS NOT NULL AND NOT coalesce(source_type = 'Note' AND target_type = 'Note', false) THEN 'work' ELSE 'drop' END AS action FROM y)
        SELECT rel_id, type, CASE action WHEN 'work' THEN work WHEN 'section' THEN section ELSE source END AS source, CASE action WHEN 'work' THEN 'WorkType' WHEN 'section' THEN 'Section' ELSE source_type END AS source_type, target, CASE action WHEN 'note' THEN 'Note' ELSE target_type END AS target_type, action FROM z""",
    "g09_outliers": "WITH r AS (SELECT type, coalesce(quantity > CASE type WHEN 'REQUIRES_LABOR' THEN 75 WHEN 'REQUIRES_EQUIPMENT' THEN 3300 WHEN 'USES_MATERIAL' THEN 225 END, false) AS o, confidence FROM relationships WHERE quantity IS NULL OR quantity <> 0) SELECT type, count(*) AS kept, count(*) FILTER (o) AS outliers, count(*) FILTER (o OR confidence = 0.3) AS low FROM r GROUP BY 1",
    "g10_chunk_dedup": "SELECT min(rel_id) AS rel_id, source_chunk_id, type, source, source_type, target, target_type, quantity, unit, per_unit FROM relationships GROUP BY ALL",
    "g11_assign_ids_all": f"""WITH n AS (SELECT coalesce(CASE lower(regexp_replace(type, '[^\\p{{L}}\\p{{N}}]', '', 'g')) WHEN 'worktype' THEN 'WorkType' WHEN 'labor' THEN 'Labor' WHEN 'equipment' THEN 'Equipment' WHEN 'material' THEN 'Material' WHEN 'section' THEN 'Section' WHEN 'note' THEN 'Note' WHEN 'standard' THEN 'Standard' END, type) AS type, coalesce(normalized_name, '') AS name, coalesce(spec, '') AS spec, min(row_id) AS row_id FROM entities GROUP BY 1, 2, coalesce(entities.spec, '')), p AS (SELECT *, CASE type WHEN 'WorkType' THEN 'W' WHEN 'Labor' THEN 'L' WHEN 'Equipment' THEN 'E' WHEN 'Material' THEN 'M' WHEN 'Section' THEN 'S' WHEN 'Note' THEN 'N' WHEN 'Standard' THEN 'ST' ELSE 'X' END AS pre FROM n),
        r AS (SELECT *, row_number() OVER (PARTITION BY pre ORDER BY encode(type), encode(name), encode(spec)) AS k FROM p) SELECT type, name, spec, row_id, pre || '-' || CASE WHEN k < 10000 THEN lpad(CAST(k AS VARCHAR), 4, '0') ELSE CAST(k AS VARCHAR) END AS id FROM r""",
    "g11_assign_ids": f"""WITH n AS (SELECT type, coalesce(normalized_name, '') AS name, coalesce(spec, '') AS spec, min(row_id) AS row_id FROM entities WHERE type IN ({', '.join(repr(x) for x in rules.TYPE_PREFIX)}) GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY encode(name), encode(spec)) AS n FROM n)
        SELECT type, name, spec, row_id, CASE type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.TYPE_PREFIX.items())} END || '-' || CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END AS id FROM r""",
    "g12_resolve_ids": """WITH n AS (SELECT type, normalized_name AS name, coalesce(spec, '') AS spec, printf('N-%08d', min(row_id)) AS id FROM entities GROUP BY type, normalized_name, entities.spec), a AS (SELECT type, name, spec, max(id) AS id FROM n GROUP BY 1, 2, 3), b AS (SELECT type, name, min(id) AS id FROM n GROUP BY 1, 2)
        SELECT row_id, coalesce(a.id, b.id, '') AS entity_id FROM entities e LEFT JOIN a ON a.type = e.type AND a.name = e.normalized_name AND a.spec = CASE WHEN row_id % 3 <> 0 THEN coalesce(e.spec, '') ELSE 'no such spec' END LEFT JOIN b ON b.type = e.type AND b.name = e.normalized_name""",
    "g13_edge_dedup": "SELECT min(id) AS id, source_id, target_id, relation FROM graph_relationships GROUP BY 2, 3, 4",
    "g14_garbage": r"WITH bad AS (SELECT id FROM graph_entities WHERE trim(coalesce(name, ''), ' ') = '' OR NOT regexp_matches(name, '[A-Za-z0-9가-힣]') OR regexp_full_match(trim(name, ' '), '[\d.,]+') OR regexp_full_match(trim(name, ' '), '[\d.,]+\s*(mm|cm|m|kg|t|kW|개|인|%)') OR regexp_matches(trim(name, ' '), '^[:：]') OR length(trim(name, ' ')) = 1 OR name LIKE '%φ%') SELECT id AS edge, source_id, target_id FROM graph_relationships r WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.id = r.source_id) AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.id = r.target_id)",
    "g16_self_loops": "SELECT relation, count(*) AS n FROM graph_relationships WHERE NOT coalesce(source_id = target_id AND source_id <> '', false) GROUP BY 1",
    "g17_renumber": f"""WITH n AS (SELECT id, min(type) AS type FROM graph_entities WHERE coalesce(is_active, true) GROUP BY 1), m AS (SELECT id, CASE type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.TYPE_PREFIX.items())} ELSE 'X' END || '-' || lpad(CAST(row_number() OVER (PARTITION BY type ORDER BY encode(id)) AS VARCHAR), 4, '0') AS new_id FROM n)
        SELECT e.id AS edge, coalesce(a.new_id, e.source_id) AS source_id, coalesce(b.new_id, e.target_id) AS target_id FROM (SELECT DISTINCT id, source_id, target_id FROM graph_relationships) e LEFT JOIN m a ON a.id = e.source_id LEFT JOIN m b ON b.id = e.target_id""",
    "g19_fk_split": "SELECT r.id AS edge, relation, CASE WHEN s.id IS NOT NULL AND t.id IS NOT NULL THEN 'ok' WHEN s.id IS NOT NULL THEN 'target' WHEN t.id IS NOT NULL THEN 'source' ELSE 'both' END AS state FROM graph_relationships r LEFT JOIN (SELECT DISTINCT id FROM graph_entities) s ON s.id = r.source_id LEFT JOIN (SELECT DISTINCT id FROM graph_entities) t ON t.id = r.target_id",
    "g21_repeated_tables": "SELECT scope, count(DISTINCT chunk_id) AS n, min(chunk_id) AS first_chunk FROM (SELECT chunk_id, trim(split_part(section_id, '#', 1)) AS scope, unnest(tables) AS t FROM graph_chunks) GROUP BY scope, t.headers, list_transform(t.rows, lambda r: list_sort(list_transform(map_entries(r), lambda e: e.key || '=' || coalesce(e.value.s, '')))) HAVING count(DISTINCT chunk_id) > 1",
    "g22_census": "SELECT type AS name, count(*) AS n, 'type' AS kind FROM graph_entities GROUP BY 1 UNION ALL SELECT relation, count(*), 'relation' FROM graph_relationships GROUP BY 1",
}
SQL["f02_merge_counts"] = f"SELECT origin, count(*) AS n FROM ({SQL['f01_merge_extractors']}) GROUP BY 1"
