"""Queries on units and references (problems 5 and 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.operators import orphans, units
from lodegraph.plans.session import load

NAME_ENDS = {"source": ["source_type", "source"], "target": ["target_type", "target"]}
ID_ENDS = {"source": ["source_id"], "target": ["target_id"]}


def _converted(spark: SparkSession, d: str) -> DataFrame:
    common = load(spark, d, "common_units")
    e = units.to_common(load(spark, d, "entities"), common, "row_id")
    r = units.to_common(load(spark, d, "relationships"), common, "rel_id", basis="per_unit")
    return e.withColumn("table_name", F.lit("entities")).unionByName(r.withColumn("table_name", F.lit("relationships")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _converted(spark, d).filter("unit_factor <> 1 or basis_factor <> 1").select("table_name", "row_id").distinct()


def p5_common(spark: SparkSession, d: str) -> DataFrame:
    """Every quantity in common units; rows delivered twice come out once."""
    return _converted(spark, d).select("table_name", "row_id", "quantity", "dimension", F.round("common_quantity", 9).alias("common_quantity"), "common_unit", "common_basis").distinct()


def _ends_and_state(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(ends, state): the ends of both tables and the records by id and by (type, name), under one kind of ref."""
    g = load(spark, d, "graph_entities").select("id", "type", "name", "is_active", "created_at")
    refs = F.array(F.concat(F.lit("#"), "id"), F.concat(F.col("type"), F.lit("\u0001"), F.col("name")))
    state = orphans.parent_state(g.select(F.explode(refs).alias("ref"), "is_active", "created_at").filter("ref is not null"), "ref")
    a = orphans.reference_ends(load(spark, d, "relationships"), "rel_id", NAME_ENDS).withColumn("table_name", F.lit("relationships"))
    b = orphans.reference_ends(load(spark, d, "graph_relationships"), "id", ID_ENDS).withColumn("table_name", F.lit("graph_relationships"))
    return a.unionByName(b.withColumn("ref", F.concat(F.lit("#"), "ref")).withColumn("row_id", F.col("row_id").cast("long"))), state


#: Edges whose source is a part of their target, and the other way round.
PARENT_RELATIONS = ["BELONGS_TO"]
CHILD_RELATIONS = ["HAS_CHILD"]


def _links(spark: SparkSession, d: str) -> DataFrame:
    """(child, parent) of both tables; graph_relationships names records by id, relationships by type and name."""
    by_name = lambda e: F.when(F.coalesce(F.col(e), F.lit("")) != "", F.concat_ws("\u0001", F.coalesce(F.col(f"{e}_type"), F.lit("\u0000")), e))
    by_id = lambda e: F.when(F.coalesce(F.col(f"{e}_id"), F.lit("")) != "", F.concat(F.lit("#"), f"{e}_id"))
    parts = []
    for table, relation, ref in (("relationships", "type", by_name), ("graph_relationships", "relation", by_id)):
        t, up = load(spark, d, table), F.col(relation).isin(PARENT_RELATIONS)
        ways = F.when(up, F.struct(ref("source").alias("child"), ref("target").alias("parent"))).when(F.col(relation).isin(CHILD_RELATIONS), F.struct(ref("target").alias("child"), ref("source").alias("parent")))
        parts.append(t.select(ways.alias("x")).filter("x is not null").select("x.*"))
    return parts[0].unionByName(parts[1])


def orphan_cascade(spark: SparkSession, d: str, inherit: bool = True) -> DataFrame:
    """(table_name, row_id, end_name, ref, at, reason) of the orphaned ends of both tables.

    The base of the cascade are the direct orphans. From the records among them that are missing or deleted it
    goes down the parent links of both tables; an end that refers to a record found there is an orphan by
    inheritance unless it is one directly. Without ``inherit`` it stops at the base.
    """
    ends, state = _ends_and_state(spark, d)
    hot = orphans.hot_refs(ends)
    base = orphans.orphaned_ends(ends, state, hot)
    if not inherit:
        return base
    gone = base.filter("reason in ('missing', 'deleted')").select("ref")
    return orphans.orphaned_ends(ends, state, hot, orphans.inherited_orphans(_links(spark, d), gone))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The base of the cascade: what is orphaned directly, which is what a case is."""
    return orphan_cascade(spark, d, inherit=False).select("table_name", "row_id", "end_name").distinct()


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphaned ends by table and month of created_at, direct ones by reason and those by inheritance."""
    return _by_month(orphan_cascade(spark, d))


def _by_month(found: DataFrame) -> DataFrame:
    got = found.select("table_name", "row_id", "end_name", "reason", F.date_format("at", "yyyy-MM").alias("month")).distinct()
    kinds = [F.count_if(F.col("reason") == r).alias(r) for r in ("missing", "deleted", "later", "inherited")]
    return got.groupBy("table_name", "month").agg(F.count_if(F.col("reason") != "inherited").alias("direct"), *kinds)


QUERIES = {f.__name__: f for f in (p5_found, p5_common, p6_found, p6_report)}

# Written out here and not taken from the operator: names of units as the test tables hold them, with the size in the
# common unit; powers, widths and look-alikes are undone before.
_UNITS = {
    "length": {"m": 1, "meter": 1, "metre": 1, "미터": 1, "mm": 1e-3, "밀리미터": 1e-3, "cm": 1e-2, "센티미터": 1e-2, "km": 1e3, "킬로미터": 1e3, "inch": 0.0254, "인치": 0.0254, "ft": 0.3048, "피트": 0.3048},
    "area": {"m2": 1, "sq.m": 1, "제곱미터": 1, "mm2": 1e-6, "cm2": 1e-4, "km2": 1e6, "ha": 1e4, "헥타르": 1e4},
    "volume": {"m3": 1, "cu.m": 1, "세제곱미터": 1, "cm3": 1e-6, "cc": 1e-6, "dm3": 1e-3, "l": 1e-3, "liter": 1e-3, "litre": 1e-3, "리터": 1e-3, "ml": 1e-6, "밀리리터": 1e-6},
    "mass": {"kg": 1, "킬로그램": 1, "g": 1e-3, "그램": 1e-3, "mg": 1e-6, "밀리그램": 1e-6, "t": 1e3, "ton": 1e3, "톤": 1e3},
    "time": {"h": 1, "hr": 1, "hour": 1, "hours": 1, "시간": 1, "min": 1 / 60, "minutes": 1 / 60, "분": 1 / 60, "s": 1 / 3600, "sec": 1 / 3600, "초": 1 / 3600},
    "power": {"kw": 1, "킬로와트": 1, "w": 1e-3, "와트": 1e-3, "mw": 1e3, "메가와트": 1e3},
    "count": {"개": 1, "ea": 1, "pcs": 1, "dozen": 12, "다스": 12, "천개": 1e3},
    "labour": {"인": 1, "명": 1, "person": 1, "persons": 1},
}


def _spelled(c: str) -> str:
    like = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοЅІЈАВЕКМНОРСТХаеорсухі", "ABEZHIKMNOPTYXvoSIJABEKMHOPCTXaeopcyxi"
    wide = "".join(chr(0xFF01 + i) for i in range(94)), "".join(chr(0x21 + i) for i in range(94)).replace("'", "''")
    t = f"translate(regexp_replace({c}, '[\\x{{AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g'), '²³{like[0]}{wide[0]}', '23{like[1]}{wide[1]}')"
    for a, b in {"㎝": "cm", "㎜": "mm", "㎞": "km", "㎏": "kg", "㎡": "m2", "㎥": "m3", "㎠": "cm2", "㎾": "kw", "㎖": "ml", "㎎": "mg", "㎢": "km2"}.items():
        t = f"replace({t}, '{a}', '{b}')"
    return f"lower(regexp_replace(nfc_normalize({t}), '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', '', 'g'))"


# a basis without its marks, null for a text that has none; the unit behind a row's own number in a text
_BARE = lambda c: f"regexp_replace(regexp_replace(regexp_replace({c}, '^기준:', ''), '^\\(|\\)$', '', 'g'), '^(/|per|매)|당$', '', 'g')"
_UNITS_SQL = f"""u(n, dim, f) AS (VALUES {', '.join(f"('{n}', '{d}', {float(f)!r}::DOUBLE)" for d, t in _UNITS.items() for n, f in t.items())}),
    e0 AS (SELECT 'entities' AS table_name, row_id, quantity, {_spelled('unit')} AS own, NULL AS basis, properties AS p FROM entities WHERE quantity IS NOT NULL UNION ALL SELECT 'relationships', rel_id, quantity, {_spelled('unit')}, {_spelled('per_unit')}, properties FROM relationships WHERE quantity IS NOT NULL),
    e1 AS (SELECT *, list_transform(map_values(p), lambda v: {_spelled('v')}) AS texts FROM e0),
    e2 AS (SELECT table_name, row_id, quantity, CASE WHEN coalesce(own, '') <> '' OR table_name = 'relationships' THEN own ELSE list_filter(list_transform(texts, lambda v: CASE WHEN TRY_CAST(replace(regexp_extract(v, '^[^0-9]*([0-9][0-9.,]*)', 1), ',', '') AS DOUBLE) = abs(quantity) THEN nullif(regexp_extract(v, '^[^0-9]*[0-9][0-9.,]*\\(?([^()]*?)\\)?(/1회)?$', 1), '') END), lambda x: x IS NOT NULL)[1] END AS own,
        CASE WHEN table_name = 'relationships' THEN {_BARE("CASE WHEN coalesce(basis, '') <> '' THEN basis ELSE list_filter(texts, lambda v: regexp_matches(regexp_replace(v, '^기준:', ''), '^\\(?(/|per|매)|당\\)?$'))[1] END")} END AS basis FROM e1),
    e3 AS (SELECT e2.*, coalesce(TRY_CAST(replace(regexp_extract(own, '^[×x]?([0-9][0-9,]*)', 1), ',', '') AS DOUBLE), 1) AS om, coalesce(TRY_CAST(replace(regexp_extract(basis, '^[×x]?([0-9][0-9,]*)', 1), ',', '') AS DOUBLE), 1) AS bm, regexp_replace(own, '^[×x]?[0-9][0-9,]*', '') AS o, regexp_replace(basis, '^[×x]?[0-9][0-9,]*', '') AS b FROM e2),
    e4 AS (SELECT table_name, row_id, quantity, x.dim, y.dim AS bdim, om * x.f AS uf, bm * y.f AS bf FROM e3 LEFT JOIN u x ON x.n = o LEFT JOIN u y ON y.n = b)"""

SQL = {
    "p5_found": f"WITH {_UNITS_SQL} SELECT DISTINCT table_name, row_id FROM e4 WHERE abs(uf - 1) > 1e-9 OR abs(bf - 1) > 1e-9",
    "p5_common": f"WITH {_UNITS_SQL} SELECT DISTINCT table_name, row_id, quantity, e4.dim AS dimension, round(quantity * uf / coalesce(bf, 1), 9) AS common_quantity, c.common_unit, d.common_unit AS common_basis FROM e4 LEFT JOIN common_units c ON c.dimension = e4.dim LEFT JOIN common_units d ON d.dimension = bdim",
    "p6_found": """
        WITH st_id AS (SELECT id AS k, min(CASE WHEN coalesce(is_active, true) THEN created_at END) AS born FROM graph_entities GROUP BY 1),
        st_name AS (SELECT type, name, min(CASE WHEN coalesce(is_active, true) THEN created_at END) AS born FROM graph_entities GROUP BY 1, 2),
        r AS (SELECT rel_id AS row_id, 'source' AS end_name, source_type AS t, source AS n, created_at FROM relationships
              UNION ALL SELECT rel_id, 'target', target_type, target, created_at FROM relationships),
        g AS (SELECT id AS row_id, 'source' AS end_name, source_id AS k, created_at FROM graph_relationships
              UNION ALL SELECT id, 'target', target_id, created_at FROM graph_relationships)
        SELECT DISTINCT 'relationships' AS table_name, row_id, end_name FROM r LEFT JOIN st_name s ON s.type = r.t AND s.name = r.n
        WHERE n <> '' AND (s.born IS NULL OR s.born > r.created_at)
        UNION ALL
        SELECT DISTINCT 'graph_relationships', CAST(row_id AS BIGINT), end_name FROM g LEFT JOIN st_id s ON s.k = g.k
        WHERE g.k <> '' AND (s.born IS NULL OR s.born > g.created_at)""",
    "p6_report": """
        WITH RECURSIVE st_id AS (SELECT id AS k, min(CASE WHEN coalesce(is_active, true) THEN created_at END) AS born FROM graph_entities GROUP BY 1),
        st_name AS (SELECT type || chr(1) || name AS k, min(CASE WHEN coalesce(is_active, true) THEN created_at END) AS born FROM graph_entities GROUP BY 1),
        st AS (SELECT 'relationships' AS t, k, born FROM st_name WHERE k IS NOT NULL UNION ALL SELECT 'graph_relationships', k, born FROM st_id WHERE k IS NOT NULL),
        rel AS (SELECT 'relationships' AS t, rel_id AS row_id, CASE WHEN source <> '' THEN coalesce(source_type, '') || chr(1) || source END AS a, CASE WHEN target <> '' THEN coalesce(target_type, '') || chr(1) || target END AS b, type AS kind, created_at AS ts FROM relationships
                UNION ALL SELECT 'graph_relationships', CAST(id AS BIGINT), nullif(source_id, ''), nullif(target_id, ''), relation, created_at FROM graph_relationships),
        ends AS (SELECT t, row_id, 'source' AS e, a AS k, ts FROM rel WHERE a IS NOT NULL UNION ALL SELECT t, row_id, 'target', b, ts FROM rel WHERE b IS NOT NULL),
        dir AS (SELECT ends.*, CASE WHEN st.k IS NULL THEN 'missing' WHEN born IS NULL THEN 'deleted' WHEN born > ts THEN 'later' END AS reason FROM ends LEFT JOIN st USING (t, k)),
        links AS (SELECT DISTINCT t, a AS child, b AS parent FROM rel WHERE kind = 'BELONGS_TO' AND a <> b UNION SELECT t, b, a FROM rel WHERE kind = 'HAS_CHILD' AND a <> b),
        gone AS (SELECT DISTINCT t, k FROM dir WHERE reason IN ('missing', 'deleted')),
        below AS (SELECT links.t, child AS k FROM links JOIN gone ON gone.t = links.t AND parent = gone.k UNION SELECT links.t, child FROM links JOIN below ON links.t = below.t AND parent = below.k),
        inh AS (SELECT ends.* FROM ends JOIN below USING (t, k) ANTI JOIN gone USING (t, k)),
        u AS (SELECT DISTINCT t, row_id, e, reason, strftime(ts, '%Y-%m') AS month FROM dir WHERE reason IS NOT NULL
              UNION SELECT t, row_id, e, 'inherited', strftime(ts, '%Y-%m') FROM inh WHERE NOT EXISTS (SELECT 1 FROM dir WHERE reason IS NOT NULL AND dir.t = inh.t AND dir.row_id = inh.row_id AND dir.e = inh.e))
        SELECT t AS table_name, month, count(*) FILTER (reason <> 'inherited') AS direct, count(*) FILTER (reason = 'missing') AS missing, count(*) FILTER (reason = 'deleted') AS deleted, count(*) FILTER (reason = 'later') AS later, count(*) FILTER (reason = 'inherited') AS inherited FROM u GROUP BY 1, 2""",
}
