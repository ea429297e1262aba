"""Queries of retrieval, expansion, state and model seams (operators I to M)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.functions import external as X
from lodegraph.operators import relations as R, retrieval as V, search
from lodegraph.operators.ordering import latest
from lodegraph.plans.session import load
from lodegraph.streaming import stateful as S


def _nodes(spark, d):
    """Active nodes, one row an id."""
    return load(spark, d, "graph_entities").filter("coalesce(is_active, true)").groupBy("id").agg(F.min("name").alias("name"), F.min("type").alias("type"), F.min("source_section").alias("source_section"))


def _edges(spark, d):
    return load(spark, d, "graph_relationships").select("source_id", "target_id", "relation").distinct()


def _questions(spark, d):
    return load(spark, d, "toc").select(F.col("key").alias("qid"), F.col("title").alias("question"))


def _asked(e: DataFrame) -> DataFrame:
    """The query set of a search: every row whose id is divisible by 100."""
    return e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))


def i01_vector_top_k(spark: SparkSession, d: str) -> DataFrame:
    """The 10 nearest of every asked vector, itself among them."""
    e = load(spark, d, "embeddings")
    return V.vector_search(_asked(e), e, 10, -2.0, "vec_id").withColumn("similarity", F.round("similarity", 4))


def i02_typed_search(spark: SparkSession, d: str) -> DataFrame:
    """The same among the rows of two types."""
    e = load(spark, d, "embeddings")
    return V.vector_search(_asked(e), e.filter("label in (1, 2)"), 10, -2.0, "vec_id").select("qid", "vec_id", "rank")


def i04_one_hop(spark: SparkSession, d: str) -> DataFrame:
    n = _nodes(spark, d)
    return V.one_hop(_edges(spark, d), n, n.filter("type = 'WorkType'"))


def i05_grouped_edges(spark: SparkSession, d: str) -> DataFrame:
    return V.grouped_edges(_edges(spark, d).filter("source_id is not null and source_id <> ''"), "BELONGS_TO")


def i06_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "toc").groupBy("id").agg(F.min("title").alias("name"))
    return V.hierarchy(R.has_child(t), t, t)


def i07_keyword_lookup(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part")
    return p.filter(F.col("p_name").ilike("%a%") & (F.col("p_type").isNull() | F.col("p_type").ilike("%e%"))).orderBy("p_name", "p_type", "p_partkey").limit(20).select("p_partkey", "p_name", "p_type")


def j02_specs(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "entities").filter("name is not null").select("row_id", V.spec_of(F.concat_ws(" ", "name", "spec")).alias("spec"))
    return e.select("row_id", "spec", V.normal_query_spec(F.col("spec")).alias("normal"))


def j07_synonyms(spark: SparkSession, d: str) -> DataFrame:
    terms = _questions(spark, d).select("qid", F.explode(V.words(F.col("question"))).alias("term"))
    syn = spark.createDataFrame([("배관", "파이프"), ("용접", "웰딩"), ("조립", "설치"), ("비계", "scaffold")], "key string, alias string")
    return V.expand_terms(terms, syn)


def j08_mixed_script(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "entities").filter("name is not null").select("row_id", V.mixed_script(F.regexp_extract("name", r"^(\S+)", 1)).alias("pattern"))
    return e.filter("pattern is not null")


def j09_size_numbers(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entities").select("row_id", F.explode(V.size_numbers(F.concat_ws(" ", "name", "spec"))).alias("number"))


SYNONYMS = {"조립": "설치", "용접": "웰딩", "비계": "scaffold", "운반": "하역"}
SHORT = {"취부": "mounting", "포설": "laying", "붙임": "tiling", "절단": "cutting", "매입": "conduit"}


def _asked_names(spark, d):
    """Titles of the contents with the vector of their section's first chunk, and every name of a mentioned work or
    section without one."""
    c = load(spark, d, "graph_chunks").filter(V.valid_vector(F.col("embedding"), 64)).groupBy(F.col("section_id").alias("key")).agg(F.min_by("embedding", F.struct("chunk_id", "created_at")).alias("vector"))
    t = load(spark, d, "toc").join(c, "key", "left").select(F.concat(F.lit("T:"), "key").alias("qid"), F.col("title").alias("question"), "vector")
    e = load(spark, d, "entities").filter("type in ('WorkType', 'Section') and name is not null").groupBy(F.col("name").alias("question")).agg(F.min("row_id").alias("r"))
    return t.unionByName(e.select(F.format_string("M:%d", F.col("r")).alias("qid"), "question", F.lit(None).cast("array<float>").alias("vector")))


def _found_nodes(spark, d):
    """Active nodes, the last row of an id."""
    g = load(spark, d, "graph_entities").filter("coalesce(is_active, true)")
    return latest(g, ["id"], [F.desc("created_at"), F.col("name"), F.col("source_section")])


def j13_cascade(spark: SparkSession, d: str) -> DataFrame:
    got = search.target_search(_asked_names(spark, d), _found_nodes(spark, d), load(spark, d, "graph_chunks"), SYNONYMS, SHORT)
    return got.withColumn("similarity", F.round("similarity", 4))


def j14_keyword_search(spark: SparkSession, d: str) -> DataFrame:
    return V.keyword_search(_questions(spark, d), _nodes(spark, d), 20)


def j12_hybrid(spark: SparkSession, d: str) -> DataFrame:
    """Titles with the first spec of their section: nearest vectors, names with all its numbers before them."""
    spec = load(spark, d, "entities").filter("trim(spec) <> ''").groupBy(F.concat(F.lit("T:"), "source_section_id").alias("qid")).agg(F.min_by("spec", "row_id").alias("spec"))
    q = _asked_names(spark, d).filter("qid like 'T:%'").join(spec, "qid", "left").withColumn("question", F.concat_ws(" ", "question", "spec"))
    return search.hybrid_search(q, _found_nodes(spark, d))


def j15_useful_terms(spark: SparkSession, d: str) -> DataFrame:
    t = load(spark, d, "entities").filter("name is not null").select("row_id", V.keep_useful(V.words(F.col("name"))).alias("t"))
    return t.select("row_id", F.array_join(F.array_sort("t"), " ").alias("terms"))


def j22_sub_sections(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entities").filter("type = 'WorkType' and trim(sub_section) <> ''").groupBy("source_section_id", "sub_section").agg(F.count(F.lit(1)).alias("works"), F.min("name").alias("first"))


def j23_options(spark: SparkSession, d: str) -> DataFrame:
    return V.section_options(_nodes(spark, d).filter("type = 'WorkType'"), "source_section")


def j24_facets(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "graph_entities").filter("name is not null").select("id", "name", F.explode(V.facets(F.col("name"))).alias("axis", "value")).select("id", "axis", "value").distinct()


def j25_axes(spark: SparkSession, d: str) -> DataFrame:
    return V.facet_axes(_nodes(spark, d).filter("source_section is not null"), "source_section", "name")


def j26_modal_base(spark: SparkSession, d: str) -> DataFrame:
    return V.modal_base(_nodes(spark, d), "type", "name", 0.0, 1).select("type", "n")


def k02_siblings(spark: SparkSession, d: str) -> DataFrame:
    return V.siblings(_nodes(spark, d), _edges(spark, d)).select("section", "work")


def k03_derived_edges(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "graph_entities").filter("coalesce(is_active, true)")
    return V.derived_edges(n, _edges(spark, d), "REQUIRES_LABOR", "confidence")


def k05_note_contents(spark: SparkSession, d: str) -> DataFrame:
    return V.note_contents(_edges(spark, d), load(spark, d, "graph_entities"))


def k06_section_chunks(spark: SparkSession, d: str) -> DataFrame:
    return V.group_chunks(load(spark, d, "graph_chunks")).select("section_id", "chunk_id")


def k12_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Works by relation: how many targets of each kind a source type has."""
    r = load(spark, d, "relationships").select("rel_id", "source_type", "type").distinct()
    return r.groupBy("source_type").pivot("type", ["REQUIRES_LABOR", "REQUIRES_EQUIPMENT", "USES_MATERIAL", "HAS_NOTE"]).agg(F.count(F.lit(1))).na.fill(0)


def k13_matrix(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "entities").filter("quantity is not null and type in ('WorkType', 'Material', 'Equipment')")
    return V.matrix(e, "source_section_id", "type", "quantity", "row_id", ["WorkType", "Material", "Equipment"])


def k14_context(spark: SparkSession, d: str) -> DataFrame:
    """Outgoing relations of each work, as text in a bounded size."""
    n = _nodes(spark, d)
    hop = V.one_hop(_edges(spark, d), n, n.filter("type = 'WorkType'"))
    lines = hop.withColumn("line", F.concat_ws(" ", "relation", "related_name"))
    return V.context_text(lines, "id", "line", ["relation", "related_id"]).select("id", F.md5("context").alias("context"), "tokens")


def k16_full_view(spark: SparkSession, d: str) -> DataFrame:
    """Works of each contents entry by the first of four ways that finds any."""
    return V.full_view(load(spark, d, "toc").select(F.col("key").alias("qid")), _nodes(spark, d), load(spark, d, "graph_chunks"))


def l01_rate_limit(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user under at most 3 in a window of a day that opens with an event."""
    e = load(spark, d, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return S.rate_limit(e, "user_id", "event_id", "at", window=86_400_000_000, most=3).groupBy("user_id").agg(F.count_if("allowed").alias("allowed"), F.count_if(~F.col("allowed")).alias("refused"))


def l02_session_state(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("value") > 50, F.col("event_type")).alias("kind"))
    return S.session_state(e, "user_id", ["ts", "event_id"], ["kind"]).select("event_id", "last_kind")


def l03_last_turns(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    return S.last_turns(e, "user_id", ["ts", "event_id"], "event_id", "event_type").select("event_id", F.array_join("turns", ",").alias("turns"))


def l04_windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return S.windowed_counts(e, "ts", ["event_type"], "1 hour").select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


def m01_entity_texts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entities").select("row_id", X.entity_text(F.col("type"), F.col("name"), F.col("spec"), F.col("unit")).alias("text"))


def m02_chunk_texts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "graph_chunks").select("chunk_id", F.md5(X.chunk_text(F.concat_ws(" > ", "department", "chapter", "section", "title"), F.col("text"))).alias("text"))


def m03_embed(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of the entities that have none, from the stand-in embedder."""
    g = load(spark, d, "graph_entities").filter("embedding is null").select("id", "name").distinct()
    return X.embed(g, "id", "name").select("id", F.size("embedding").alias("dims"), F.round(V.dot(F.col("embedding"), F.col("embedding")), 3).alias("norm"))


def m04_valid_vectors(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "graph_entities").groupBy(V.valid_vector(F.col("embedding"), 64).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {k: v for k, v in globals().items() if k[:1] in "ijklm" and k[1:3].isdigit()}

_N = "n AS (SELECT id, decode(min(encode(name))) AS name, min(type) AS type, min(source_section) AS source_section FROM graph_entities WHERE coalesce(is_active, true) GROUP BY 1)"
_ED = "e AS (SELECT DISTINCT source_id, target_id, relation FROM graph_relationships)"
_W = lambda c: f"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^0-9a-z가-힣]+'), lambda w: length(w) >= 2))"
_HITS = f"""q AS (SELECT key AS qid, title AS question, {_W('title')} AS ws FROM toc), qw AS (SELECT qid, len(ws) AS asked, unnest(ws) AS w FROM q), nw AS (SELECT DISTINCT id, unnest({_W('name')}) AS w FROM n0),
    h AS (SELECT qid, id, asked, count(*) AS hits FROM qw JOIN nw USING (w) GROUP BY 1, 2, 3)"""
_RANKED = "k AS (SELECT qid, id, CAST(hits * 2 + CASE WHEN hits = asked THEN 1 ELSE 0 END AS INT) AS score, row_number() OVER (PARTITION BY qid ORDER BY hits * 2 + CASE WHEN hits = asked THEN 1 ELSE 0 END DESC, id) AS rank FROM h)"

_WORDS = lambda c: f"list_filter(list_distinct(regexp_split_to_array(lower({c}), '[^0-9a-z가-힣]+')), lambda w: length(w) >= 2)"
_FOUND = "g AS (SELECT id, name, lower(name) AS nm, type, source_section, CAST(embedding AS DOUBLE[]) AS e FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at DESC, name, source_section NULLS FIRST) AS rn FROM graph_entities WHERE coalesce(is_active, true)) WHERE rn = 1)"
_OKV = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
_ASKED = f"""cv AS (SELECT section_id AS key, arg_min(CAST(embedding AS DOUBLE[]), (chunk_id, created_at)) AS v FROM graph_chunks WHERE {_OKV} GROUP BY 1),
    q AS (SELECT 'T:' || toc.key AS qid, title AS question, v FROM toc LEFT JOIN cv ON cv.key = toc.key UNION ALL SELECT 'M:' || min(row_id), name, NULL FROM entities WHERE type IN ('WorkType', 'Section') AND name IS NOT NULL GROUP BY name)"""
_NEAR = lambda k, types: f"""nv AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id) AS r FROM (SELECT qid, id, nm, type, source_section, list_cosine_similarity(v, e) AS s FROM rest JOIN g ON len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0 WHERE v IS NOT NULL AND list_sum(list_transform(v, lambda x: x * x)) > 0{types}) WHERE s > 0.4 QUALIFY r <= {k})"""
_PAIRS = lambda t, both: "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in [*t.items(), *([(b, a) for a, b in t.items()] if both else [])]) + ") AS al(a, b)"

SQL = {
    # every question against every name
    "j13_cascade": f"""WITH {_FOUND}, {_ASKED},
        a0 AS (SELECT *, nullif(regexp_extract(question, '([0-9A-Z]{{6}})[^0-9A-Za-z_]*$', 1), '') AS code, regexp_replace(regexp_replace(question, '([0-9A-Z]{{6}})[^0-9A-Za-z_]*$', ''), '[\\s·,/_(-]+$|(?i)\\s+no\\.\\s*$', '') AS bare FROM q),
        a AS (SELECT qid, question, v, lower(coalesce(code, nullif(regexp_extract(question, '([φΦø]\\s*\\d+)', 1), ''), nullif(regexp_extract(question, '(\\d+(?:\\.\\d+)?\\s*mm)', 1), ''), nullif(regexp_extract(question, '((?i:SCH)\\s*\\d+)', 1), ''), nullif(regexp_extract(question, '(\\d+(?:-\\d+/\\d+|/\\d+)?\\s*(?:inch|인치|"))', 1), ''), nullif(regexp_extract(question, '(\\d+\\s*[x×]\\s*\\d+)', 1), ''))) AS spec, nullif(trim(lower(bare), ' '), '') AS w FROM a0),
        t AS (SELECT *, {_WORDS('w')} AS ws FROM a), d AS (SELECT *, CASE WHEN len(list_filter(ws, lambda x: NOT regexp_full_match(x, '[A-Za-z]{{1,3}}'))) = 0 THEN ws ELSE list_filter(ws, lambda x: NOT regexp_full_match(x, '[A-Za-z]{{1,3}}')) END AS terms FROM t),
        n AS (SELECT * FROM g WHERE type IN ('WorkType', 'Section')), b AS (SELECT * FROM d WHERE w IS NOT NULL AND spec IS NOT NULL),
        mx AS (SELECT qid, '%' || array_to_string(regexp_extract_all(w, '[a-z]+|[가-힣]+|\\d+'), '%') || '%' AS p FROM d WHERE regexp_matches(w, '[a-z]') AND regexp_matches(w, '[가-힣]')),
        s1 AS (SELECT qid, id, 1 AS stage FROM b JOIN n ON contains(nm, w) AND contains(substr(nm, strpos(nm, w) + length(w)), spec)
            UNION SELECT qid, id, 2 FROM b JOIN n ON contains(nm, w) UNION SELECT qid, id, 2 FROM b JOIN mx USING (qid) JOIN n ON nm LIKE p UNION SELECT qid, id, 2 FROM b JOIN {_PAIRS(SYNONYMS, True)} ON list_contains(ws, a) JOIN n ON contains(nm, b)
            UNION SELECT qid, id, 3 FROM b JOIN {_PAIRS(SHORT, False)} ON list_contains(ws, a) JOIN g ON contains(nm, al.b) AND type IN ('WorkType', 'Section', 'Standard')),
        f1 AS (SELECT qid, id, stage, row_number() OVER (PARTITION BY qid ORDER BY id) AS rank FROM (SELECT *, min(stage) OVER (PARTITION BY qid) AS m FROM s1) WHERE stage = m QUALIFY rank <= CASE stage WHEN 2 THEN 20 ELSE 5 END),
        l AS (SELECT * FROM d WHERE w IS NOT NULL AND qid NOT IN (SELECT qid FROM f1)), lt AS (SELECT qid, unnest(terms) AS term FROM l),
        s2 AS (SELECT qid, id, 4 AS stage FROM lt JOIN n ON contains(nm, term) UNION SELECT qid, id, 4 FROM lt JOIN n ON nm LIKE '%' || array_to_string(regexp_extract_all(term, '[a-z]+|[가-힣]+|\\d+'), '%') || '%' WHERE regexp_matches(term, '[a-z]') AND regexp_matches(term, '[가-힣]')
            UNION SELECT qid, id, 4 FROM l JOIN {_PAIRS(SYNONYMS, True)} ON list_contains(ws, a) JOIN n ON contains(nm, al.b) UNION SELECT qid, id, 5 FROM l JOIN n ON contains(nm, w) WHERE len(terms) > 1),
        c2 AS (SELECT s2.*, CASE stage WHEN 4 THEN 2 * len(list_filter(ws, lambda x: contains(nm, x))) + len(list_filter(regexp_extract_all(lower(question), '[가-힣]+'), lambda x: contains(nm, x))) ELSE 0 END AS score FROM (SELECT *, min(stage) OVER (PARTITION BY qid) AS m FROM s2) s2 JOIN l USING (qid) JOIN n USING (id) WHERE stage = m),
        f2 AS (SELECT qid, id, stage, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM c2 QUALIFY rank <= 20),
        rest AS (SELECT * FROM d WHERE qid NOT IN (SELECT qid FROM f1) AND qid NOT IN (SELECT qid FROM f2)), {_NEAR(10, " AND type IN ('WorkType', 'Section')")},
        v2 AS (SELECT qid, id, type, round(s - CASE WHEN type = 'Section' AND source_section IS NOT NULL AND source_section NOT IN (SELECT section_id FROM graph_chunks WHERE section_id IS NOT NULL) THEN 0.3 ELSE 0 END, 6) AS s FROM nv), f3 AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, id) AS rank FROM v2 QUALIFY rank <= 5),
        o AS (SELECT qid, {_WORDS('question')} AS ws FROM rest WHERE qid NOT IN (SELECT qid FROM f3 WHERE type = 'WorkType' AND s >= 0.7)), bd AS (SELECT section_id AS id, {_WORDS('text')} AS cw FROM graph_chunks WHERE text IS NOT NULL AND section_id IS NOT NULL),
        bc AS (SELECT id, list_distinct(flatten(list(cw))) AS cw FROM bd GROUP BY 1), f4 AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY id) AS rank FROM o JOIN bc ON len(ws) > 0 AND list_has_all(cw, ws) QUALIFY rank <= 5)
        SELECT qid, id, stage, CASE stage WHEN 1 THEN 1.0 WHEN 2 THEN 0.98 ELSE 0.96 END::DOUBLE AS similarity, CAST(rank AS INT) AS rank FROM f1 UNION ALL SELECT qid, id, stage, CASE stage WHEN 4 THEN 0.95 ELSE 0.9 END::DOUBLE, CAST(rank AS INT) FROM f2 UNION ALL SELECT qid, id, 6, round(s, 4), CAST(rank AS INT) FROM f3 UNION ALL SELECT qid, id, 7, 0.8::DOUBLE, CAST(rank AS INT) FROM f4""",
    "j12_hybrid": f"""WITH {_FOUND}, {_ASKED}, sp AS (SELECT 'T:' || source_section_id AS qid, arg_min(spec, row_id) AS spec FROM entities WHERE trim(spec, ' ') <> '' GROUP BY 1),
        rest AS (SELECT qid, v, list_distinct(regexp_extract_all(concat_ws(' ', question, spec), '\\d{{2,}}')) AS ns FROM q LEFT JOIN sp USING (qid) WHERE qid LIKE 'T:%'), {_NEAR(5, '')},
        ex AS (SELECT DISTINCT qid FROM nv JOIN rest USING (qid) WHERE len(list_filter(ns, lambda x: NOT contains(nm, x))) = 0),
        nm AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY id) AS r FROM rest JOIN g ON name IS NOT NULL AND len(list_filter(ns, lambda x: NOT contains(nm, x))) = 0 WHERE len(ns) > 0 AND qid NOT IN (SELECT qid FROM ex) QUALIFY r <= 5),
        u AS (SELECT qid, id, min((pri, r)) AS o FROM (SELECT qid, id, 0 AS pri, r FROM nm UNION ALL SELECT qid, id, 1, r FROM nv) GROUP BY 1, 2)
        SELECT qid, id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY o, id) AS rank FROM u) WHERE rank <= 5""",
    "i01_vector_top_k": "SELECT qid, vec_id, round(s, 4) AS similarity, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS rank FROM (SELECT a.vec_id AS qid, b.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0)) WHERE rank <= 10",
    "i02_typed_search": "SELECT qid, vec_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, vec_id) AS rank FROM (SELECT a.vec_id AS qid, b.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND b.label IN (1, 2))) WHERE rank <= 10",
    "i04_one_hop": f"WITH {_N}, {_ED} SELECT s.id, 'outbound' AS direction, e.relation, t.id AS related_id, t.name AS related_name, t.type AS related_type FROM n s JOIN e ON e.source_id = s.id JOIN n t ON t.id = e.target_id WHERE s.type = 'WorkType'",
    "i05_grouped_edges": f"WITH {_ED} SELECT source_id AS id, count(*) FILTER (relation <> 'BELONGS_TO') AS n, coalesce(string_agg(DISTINCT concat_ws('>', relation, target_id), ',' ORDER BY concat_ws('>', relation, target_id)) FILTER (relation <> 'BELONGS_TO'), '') AS relations FROM e WHERE source_id <> '' GROUP BY 1",
    "i06_hierarchy": r"WITH t AS (SELECT id, decode(min(encode(title))) AS name FROM toc GROUP BY 1), l AS (SELECT p.id AS parent, k.id AS child FROM t k JOIN t p ON p.id = regexp_replace(k.id, '-\d+$', '') AND p.id <> k.id) SELECT parent AS id, 'child' AS direction, child AS related_id, name AS related_name FROM l JOIN t ON t.id = child UNION ALL SELECT child, 'parent', parent, name FROM l JOIN t ON t.id = parent",
    "i07_keyword_lookup": "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%a%' AND (p_type IS NULL OR p_type ILIKE '%e%') ORDER BY p_name, p_type, p_partkey LIMIT 20",
    "j07_synonyms": f"WITH t AS (SELECT key AS qid, unnest({_W('title')}) AS term FROM toc), s(k, a) AS (VALUES ('배관', '파이프'), ('용접', '웰딩'), ('조립', '설치'), ('비계', 'scaffold')), b AS (SELECT upper(k) AS k, a FROM s UNION ALL SELECT upper(a), k FROM s) SELECT DISTINCT qid, term FROM (SELECT qid, term FROM t UNION ALL SELECT qid, a FROM t JOIN b ON upper(term) = k)",
    "j08_mixed_script": r"SELECT row_id, '%' || array_to_string(r, '%') || '%' AS pattern FROM (SELECT row_id, regexp_extract_all(regexp_extract(name, '^([^ \t\n\r\f\v]+)', 1), '[A-Za-z]+|[가-힣]+|\d+') AS r FROM entities WHERE name IS NOT NULL) WHERE len(r) >= 2",
    "j09_size_numbers": r"SELECT row_id, unnest(regexp_extract_all(concat_ws(' ', name, spec), '(?:[φΦø]|DN|D=|W=|H=|SCH)\s*(\d+)', 1)) AS number FROM entities",
    "j14_keyword_search": f"WITH {_N}, n0 AS (SELECT * FROM n), {_HITS}, {_RANKED} SELECT qid, id, score, CAST(rank AS INT) AS rank FROM k WHERE rank <= 20",
    "j15_useful_terms": f"WITH t AS (SELECT row_id, {_W('name')} AS t FROM entities WHERE name IS NOT NULL), g AS (SELECT row_id, t, list_filter(t, lambda x: NOT regexp_full_match(x, '[A-Za-z]{{1,3}}')) AS good FROM t) SELECT row_id, array_to_string(list_sort(CASE WHEN len(good) = 0 THEN t ELSE good END), ' ') AS terms FROM g",
    "j22_sub_sections": "SELECT source_section_id, sub_section, count(*) AS works, decode(min(encode(name))) AS first FROM entities WHERE type = 'WorkType' AND trim(sub_section) <> '' GROUP BY 1, 2",
    "j23_options": rf"WITH {_N} SELECT source_section, CAST(p AS INT) AS position, id, name FROM (SELECT *, row_number() OVER (PARTITION BY source_section ORDER BY coalesce(TRY_CAST(regexp_extract(name, '(\d+)', 1) AS INT), 99), encode(name), id) AS p FROM n WHERE type = 'WorkType') WHERE p <= 15",
    "j24_facets": r"SELECT DISTINCT id, axis, value FROM (SELECT id, 'diameter' AS axis, regexp_extract(name, 'φ\s*(\d+)', 1) AS value FROM graph_entities UNION ALL SELECT id, 'code', regexp_extract(name, '([0-9A-Z]{6})[^0-9A-Za-z_]*$', 1) FROM graph_entities UNION ALL SELECT id, 'class', regexp_extract(name, '^(\S+형)\s', 1) FROM graph_entities UNION ALL SELECT id, 'number', regexp_extract(name, '(?i)no\.\s*(\w+)', 1) FROM graph_entities) WHERE value <> ''",
    "k02_siblings": f"""WITH {_N}, {_ED}, s AS (SELECT source_section, min(id) AS section FROM n WHERE type = 'Section' AND source_section IS NOT NULL GROUP BY 1), p AS (SELECT section, n.id AS work, n.name FROM n JOIN s USING (source_section) WHERE n.type = 'WorkType')
        SELECT section, work FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY encode(name), work) AS rn FROM p WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.target_id = p.section AND e.source_id = p.work)) WHERE rn <= 30""",
    "k03_derived_edges": "SELECT DISTINCT id, 'REQUIRES_LABOR' AS relation, properties['confidence'] AS value FROM graph_entities g WHERE coalesce(is_active, true) AND type = 'WorkType' AND properties['confidence'] IS NOT NULL AND NOT EXISTS (SELECT 1 FROM graph_relationships r WHERE r.relation = 'REQUIRES_LABOR' AND r.source_id = g.id)",
    "k05_note_contents": f"WITH {_ED}, c AS (SELECT id, max(properties['source_method']) AS content FROM graph_entities GROUP BY 1) SELECT source_id, target_id, content FROM e LEFT JOIN c ON c.id = target_id WHERE relation = 'HAS_NOTE'",
    "k06_section_chunks": "SELECT section_id, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY section_id ORDER BY chunk_id) AS rn FROM (SELECT DISTINCT section_id, chunk_id FROM graph_chunks)) WHERE rn <= 15",
    "k12_pivot": "SELECT source_type, " + ", ".join(f"count(*) FILTER (type = '{t}') AS {t}" for t in ("REQUIRES_LABOR", "REQUIRES_EQUIPMENT", "USES_MATERIAL", "HAS_NOTE")) + " FROM (SELECT DISTINCT rel_id, source_type, type FROM relationships) GROUP BY 1",
    "k13_matrix": "SELECT source_section_id, " + ", ".join(f"arg_max(quantity, row_id) FILTER (type = '{t}') AS {t}" for t in ("WorkType", "Material", "Equipment")) + " FROM entities WHERE quantity IS NOT NULL AND type IN ('WorkType', 'Material', 'Equipment') GROUP BY 1",
    "k14_context": f"WITH {_N}, {_ED}, x AS (SELECT s.id, substr(string_agg(concat_ws(' ', e.relation, t.name), chr(10) ORDER BY e.relation, t.id), 1, 6000) AS c FROM n s JOIN e ON e.source_id = s.id JOIN n t ON t.id = e.target_id WHERE s.type = 'WorkType' GROUP BY 1) SELECT id, md5(c) AS context, CAST(ceil(length(c) / 2.0) AS INT) AS tokens FROM x",
    "k16_full_view": rf"""WITH {_N}, wk AS (SELECT id, source_section FROM n WHERE type = 'WorkType'), own AS (SELECT key AS qid, wk.id AS node FROM toc JOIN wk ON source_section = key),
        pl AS (SELECT DISTINCT section_id, title, department, chapter FROM graph_chunks), bs AS (SELECT DISTINCT x.section_id AS qid, wk.id AS node FROM pl x JOIN pl y ON x.title = y.title AND x.department = y.department AND x.chapter = y.chapter AND x.section_id <> y.section_id JOIN wk ON wk.source_section = y.section_id WHERE x.section_id IN (SELECT key FROM toc) AND x.section_id NOT IN (SELECT qid FROM own)),
        bl AS (SELECT DISTINCT key AS qid, wk.id AS node FROM toc JOIN wk ON starts_with(split_part(source_section, '#', 1), split_part(key, '#', 1) || '-')), u AS (SELECT qid, node, 1 AS stage, 200 AS most FROM own UNION ALL SELECT qid, node, 2, 30 FROM bs UNION ALL SELECT qid, node, 3, 50 FROM bl UNION ALL SELECT key, n.id, 4, 30 FROM toc JOIN n ON n.source_section = key AND n.type = 'Section')
        SELECT qid, node, stage FROM (SELECT *, min(stage) OVER (PARTITION BY qid) AS m, row_number() OVER (PARTITION BY qid, stage ORDER BY node) AS r FROM u) WHERE stage = m AND r <= most""",
    "l01_rate_limit": """WITH RECURSIVE o AS (SELECT user_id, min(ts) AS s FROM events GROUP BY 1), w AS (SELECT user_id, s FROM o UNION ALL SELECT w.user_id, (SELECT min(e.ts) FROM events e WHERE e.user_id = w.user_id AND e.ts > w.s + INTERVAL 1 DAY) FROM w WHERE w.s IS NOT NULL),
        c AS (SELECT w.user_id, w.s, count(*) AS n FROM w JOIN events e ON e.user_id = w.user_id AND e.ts >= w.s AND e.ts <= w.s + INTERVAL 1 DAY WHERE w.s IS NOT NULL GROUP BY 1, 2) SELECT user_id, CAST(sum(least(n, 3)) AS BIGINT) AS allowed, CAST(sum(greatest(n - 3, 0)) AS BIGINT) AS refused FROM c GROUP BY 1""",
    "l02_session_state": "SELECT event_id, last_value(CASE WHEN value > 50 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_kind FROM events",
    "l03_last_turns": "SELECT event_id, array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS turns FROM events",
    "l04_windowed_counts": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "m01_entity_texts": "SELECT row_id, type || ': ' || name || CASE WHEN coalesce(trim(spec, ' '), '') <> '' THEN ' [' || trim(spec, ' ') || ']' ELSE '' END || CASE WHEN coalesce(trim(unit, ' '), '') <> '' THEN ' [' || trim(unit, ' ') || ']' ELSE '' END AS text FROM entities",
    "m02_chunk_texts": "SELECT chunk_id, md5(concat_ws(chr(10), nullif(concat_ws(' > ', department, chapter, section, title), ''), nullif(trim(text, ' '), ''))) AS text FROM graph_chunks",
    "m03_embed": "SELECT DISTINCT id, CAST(64 AS INT) AS dims, 1.0::DOUBLE AS norm FROM (SELECT DISTINCT id, name FROM graph_entities WHERE embedding IS NULL)",
    "m04_valid_vectors": "SELECT coalesce(len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0, false) AS valid, count(*) AS n FROM graph_entities GROUP BY 1",
}
