"""Retrieval over the graph: vector top-k, keyword search, cascades, expansion, pivots, context assembly.

Every operator takes a table of queries, so one plan answers all of them; text search goes through word
equi-joins, never through pairs of all queries with all rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegraph.operators.skew import few_hot, lookup_join
from lodegraph.plans.session import ship

# ---- vectors ----


def parse_vector(text: str | None, dim: int) -> list[float] | None:
    """A vector from its text; None for null, blank, malformed, of another length or not finite."""
    try:
        v = json.loads(text or "")
        v = [float(x) for x in v]
    except (ValueError, TypeError):
        return None
    return v if len(v) == dim and all(map(math.isfinite, v)) else None


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector is null, zero or of another length."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (n > 0), dot(a, b) / n)


def valid_vector(v: Column, dim: int) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) == dim) & ~bad, F.lit(False))


#: Queries that are compared with a table at once: some 16 MB of 64 numbers each.
QUERY_BLOCK = 32_768


def vector_search(queries: DataFrame, rows: DataFrame, k: int = 5, threshold: float = 0.5, key: str = "id", dim: int = 64, block: int = QUERY_BLOCK) -> DataFrame:
    """(qid, key, similarity, rank): for each query (qid, vector) the k rows (key, embedding) of highest cosine above
    the threshold, exactly; ties by key.

    Queries go in blocks of about ``block``, each sent to all tasks; a task keeps k rows a query and hands on no
    more. Vectors that are null, of another length, zero or not finite take no part on either side.
    """
    spark = rows.sparkSession
    ship(spark)
    types = dict(queries.dtypes)["qid"], dict(rows.dtypes)[key]
    q = queries.select("qid", F.col("vector").cast("array<double>").alias("vector")).filter(F.col("qid").isNotNull() & valid_vector(F.col("vector"), dim))
    blocks = max(1, -(-q.count() // block))
    data = rows.select(key, F.col("embedding").cast("array<double>").alias("v")).filter(F.col(key).isNotNull() & valid_vector(F.col("v"), dim))
    out = None
    for i in range(blocks):
        part = q.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i).toArrow()  # about ``block`` rows
        shared = spark.sparkContext.broadcast((part.column(0).to_pylist(), _units(part.column(1), dim)))
        got = data.mapInArrow(_best_of(shared, k, threshold, dim, key, types), f"qid {types[0]}, `{key}` {types[1]}, similarity double")
        out = got if out is None else out.unionByName(got)
    w = Window.partitionBy("qid").orderBy(F.desc(F.round("similarity", 9)), key)
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _units(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), "f8").reshape(-1, dim)
    with np.errstate(all="ignore"):
        return np.nan_to_num(x / np.linalg.norm(x, axis=1, keepdims=True))


def _best_of(shared, k: int, threshold: float, dim: int, key: str, types: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        sims, names = np.full((len(ids), k), -np.inf), np.full((len(ids), k), None, object)
        for b in batches:
            x, own = _units(b.column(1), dim), np.array(b.column(0).to_pylist(), object)
            for r in range(0, len(x), 2048):
                for c in range(0, len(ids), 2048):
                    s = q[c : c + 2048] @ x[r : r + 2048].T
                    at = np.nonzero((s > threshold).any(1) & (s.max(1, initial=-np.inf) >= sims[c : c + 2048, -1]))[0]
                    if len(at):
                        all_s = np.concatenate([sims[c + at], np.where(s[at] > threshold, s[at], -np.inf)], 1)
                        all_n = np.concatenate([names[c + at], np.broadcast_to(own[r : r + 2048], s[at].shape)], 1)
                        # ties by key, so that what a task keeps does not hang on its batches
                        for row, i in enumerate(at):
                            top = sorted(np.nonzero(all_s[row] > -np.inf)[0], key=lambda j: (-round(all_s[row, j], 9), all_n[row, j]))[:k]
                            sims[c + i], names[c + i] = -np.inf, None
                            sims[c + i, : len(top)], names[c + i, : len(top)] = all_s[row, top], all_n[row, top]
        a, b = np.nonzero(sims > -np.inf)
        arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in a], arrow.get(types[0])), pa.array(list(names[a, b]), arrow.get(types[1])), pa.array(sims[a, b], pa.float64())], ["qid", key, "similarity"])

    return run


def sections_top_chunks(queries: DataFrame, chunks: DataFrame, most: int = 10, per_section: int = 2) -> DataFrame:
    """(section_id, chunk_id, similarity, rank): for each query (section_id, vector) the best chunks of its section,
    ``per_section`` a section and ``most`` at most. A section has one query; sections of any size are spread."""
    d = chunks.filter(F.col("section_id").isNotNull()).select("section_id", "chunk_id", "embedding")
    hot = few_hot(d.groupBy("section_id").agg(F.count(F.lit(1)).alias("n")), "section_id", "n")
    d = lookup_join(d, queries.select("section_id", "vector"), "section_id", hot, "inner")
    d = d.withColumn("similarity", cosine(F.col("embedding"), F.col("vector"))).filter("similarity is not null")
    w = Window.partitionBy("section_id").orderBy(F.desc(F.round("similarity", 9)), "chunk_id")
    return d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= min(per_section, most)).select("section_id", "chunk_id", "similarity", "rank")


# ---- edges ----


def one_hop(edges: DataFrame, nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    """(id, direction, relation, related_id, related_name, related_type) for all seeds at once."""
    n = nodes.select(F.col("id").alias("related_id"), F.col("name").alias("related_name"), F.col("type").alias("related_type"))
    e = edges.select(F.col("source_id").alias("id"), "relation", F.col("target_id").alias("related_id"))
    e = e.join(seeds.select("id").distinct(), "id", "left_semi")
    hot = few_hot(e.groupBy("related_id").agg(F.count(F.lit(1)).alias("n")), "related_id", "n")
    return lookup_join(e, n, "related_id", hot, "inner").select("id", F.lit("outbound").alias("direction"), "relation", "related_id", "related_name", "related_type")


def hierarchy(links: DataFrame, nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    """Children and parents of the seeds: (id, direction, related_id, related_name)."""
    n = nodes.select(F.col("id").alias("related_id"), F.col("name").alias("related_name"))
    down = links.select(F.col("parent").alias("id"), F.col("child").alias("related_id"), F.lit("child").alias("direction"))
    up = links.select(F.col("child").alias("id"), F.col("parent").alias("related_id"), F.lit("parent").alias("direction"))
    return down.unionByName(up).join(seeds.select("id"), "id", "left_semi").join(n, "related_id").select("id", "direction", "related_id", "related_name")


def grouped_edges(edges: DataFrame, without: str) -> DataFrame:
    """(id, n, relations): each source's relations but one kind, as sorted text; sources without any keep []."""
    e = edges.select(F.col("source_id").alias("id"), F.when(F.col("relation") != without, F.concat_ws(">", "relation", "target_id")).alias("x"))
    return e.groupBy("id").agg(F.count("x").alias("n"), F.array_join(F.array_sort(F.collect_set("x")), ",").alias("relations"))


def siblings(nodes: DataFrame, edges: DataFrame, most: int = 30) -> DataFrame:
    """Virtual edges (section, work): works of a section that no edge links to it, ``most`` a section by name."""
    works = nodes.filter("type = 'WorkType' and source_section is not null").select("id", "name", "source_section").distinct()
    sections = nodes.filter("type = 'Section' and source_section is not null").groupBy("source_section").agg(F.min("id").alias("section"))
    pairs = works.join(sections, "source_section").select("section", F.col("id").alias("work"), "name")
    known = edges.select(F.col("target_id").alias("section"), F.col("source_id").alias("work"))
    new = pairs.join(known.distinct(), ["section", "work"], "left_anti")
    w = Window.partitionBy("section").orderBy("name", "work")
    return new.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= most).drop("rn")


def derived_edges(nodes: DataFrame, edges: DataFrame, relation: str, prop: str) -> DataFrame:
    """Synthetic edges of works that have no edge of a relation but the property that would make one."""
    have = edges.filter(F.col("relation") == relation).select(F.col("source_id").alias("id")).distinct()
    return nodes.filter(F.col("type") == "WorkType").filter(F.col("properties")[prop].isNotNull()).join(have, "id", "left_anti").select("id", F.lit(relation).alias("relation"), F.col("properties")[prop].alias("value")).distinct()


def note_contents(edges: DataFrame, nodes: DataFrame, prop: str = "source_method") -> DataFrame:
    """HAS_NOTE edges with a property of their note."""
    n = nodes.groupBy(F.col("id").alias("target_id")).agg(F.max(F.col("properties")[prop]).alias("content"))
    return edges.filter("relation = 'HAS_NOTE'").join(n, "target_id", "left").select("source_id", "target_id", "content")


# ---- words ----


def words(text: Column) -> Column:
    """Lower-case words of two characters or more."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^0-9a-z가-힣]+"), lambda w: F.length(w) >= 2))


def keyword_hits(questions: DataFrame, nodes: DataFrame, text: str = "name") -> DataFrame:
    """(qid, id, hits, asked): rows that share words with a question, and how many of the asked ones."""
    q = questions.select("qid", F.explode(words(F.col("question"))).alias("w"), F.size(words(F.col("question"))).alias("asked"))
    n = nodes.select("id", F.explode(words(F.col(text))).alias("w")).distinct()
    return q.join(n, "w").groupBy("qid", "id", "asked").agg(F.count(F.lit(1)).cast("int").alias("hits"))


def keyword_search(questions: DataFrame, nodes: DataFrame, k: int = 20) -> DataFrame:
    """(qid, id, score, rank): 2 for each asked word in a name, 1 more if all are; best k, ties by id."""
    h = keyword_hits(questions, nodes).withColumn("score", F.col("hits") * 2 + F.when(F.col("hits") == F.col("asked"), 1).otherwise(0))
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return h.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("qid", "id", "score", "rank")


def first_stage(stages: list[DataFrame], by: str = "qid") -> DataFrame:
    """Rows of the first stage that has any, for each query: (…, stage)."""
    u = None
    for i, s in enumerate(stages):
        s = s.withColumn("stage", F.lit(i + 1))
        u = s if u is None else u.unionByName(s)
    return u.withColumn("__m", F.min("stage").over(Window.partitionBy(by))).filter("stage = __m").drop("__m")


def first_of(stages: list[tuple[DataFrame, int]], by: str = "qid", node: str = "node") -> DataFrame:
    """Rows of the first stage that has any for each query, by node up to the stage's limit: (by, node, stage)."""
    u = None
    for i, (s, most) in enumerate(stages):
        w = Window.partitionBy(by).orderBy(node)
        s = s.select(by, node).distinct().withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= most).select(by, node, F.lit(i + 1).alias("stage"))
        u = s if u is None else u.unionByName(s)
    return u.withColumn("__m", F.min("stage").over(Window.partitionBy(by))).filter("stage = __m").drop("__m")


def full_view(sections: DataFrame, nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """(qid, node, stage) for each section (qid): its own works (200); works of sections whose chunks share title,
    division and chapter with its own (30); works of sections below its id (50); the section nodes themselves.

    Sections of one title are not paired: a title's first 30 works go to those of its sections that have none.
    """
    q = sections.select("qid").distinct()
    works = nodes.filter("type = 'WorkType' and source_section is not null").select(F.col("id").alias("node"), "source_section").distinct()
    own = q.join(works, q.qid == works.source_section).select("qid", "node")
    place = ["title", "department", "chapter"]
    at = chunks.select("section_id", *place).dropna().distinct()
    named = at.join(works, at.section_id == works.source_section).select(*place, "node").distinct()
    named = named.withColumn("__r", F.row_number().over(Window.partitionBy(*place).orderBy("node"))).filter("__r <= 30").drop("__r")
    bare = q.join(own.select("qid").distinct(), "qid", "left_anti").join(at, F.col("qid") == F.col("section_id"))
    beside = bare.join(named, place).select("qid", "node")
    ids = F.split(F.substring_index("source_section", "#", 1), "-")
    ups = F.transform(F.sequence(F.lit(1), F.size(ids) - 1), lambda i: F.array_join(F.slice(ids, F.lit(1), i), "-"))
    up = works.select("node", F.explode(F.when(F.size(ids) > 1, ups)).alias("up"))
    below = q.join(up, F.substring_index("qid", "#", 1) == F.col("up")).select("qid", "node")
    own_nodes = nodes.filter("type = 'Section'").select(F.col("id").alias("node"), "source_section")
    itself = q.join(own_nodes, q.qid == own_nodes.source_section).select("qid", "node")
    return first_of([(own, 200), (beside, 30), (below, 50), (itself, 30)])


def expand_terms(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(qid, term): terms and the synonyms of those that equal a key; ``synonyms`` has (key, alias)."""
    s = synonyms.select(F.upper("key").alias("__k"), "alias").unionByName(synonyms.select(F.upper("alias").alias("__k"), F.col("key").alias("alias")))
    more = terms.join(s, F.upper("term") == F.col("__k")).select("qid", F.col("alias").alias("term"))
    return terms.select("qid", "term").unionByName(more).distinct()


def mixed_script(term: Column) -> Column:
    """A pattern with a gap between the scripts of a term, null if it has one script only."""
    runs = F.regexp_extract_all(term, F.lit(r"[A-Za-z]+|[가-힣]+|\d+"), F.lit(0))
    return F.when(F.size(runs) >= 2, F.concat(F.lit("%"), F.array_join(runs, "%"), F.lit("%")))


# Nominal sizes in inches to mm.
INCH_MM = {"1/2": 15, "3/4": 20, "1": 25, "1-1/4": 32, "1-1/2": 40, "2": 50, "2-1/2": 65, "3": 80, "4": 100, "5": 125, "6": 150, "8": 200, "10": 250, "12": 300}


def spec_of(question: Column) -> Column:
    """The first size in a question, by strength of its form: diameter sign, mm, schedule, inches, W×H."""
    forms = [r"([φΦø]\s*\d+)", r"(\d+(?:\.\d+)?\s*mm)", r"((?i:SCH)\s*\d+)", r"(\d+(?:-\d+/\d+|/\d+)?\s*(?:inch|인치|\"))", r"(\d+\s*[x×]\s*\d+)"]
    return F.coalesce(*[F.nullif(F.regexp_extract(question, p, 1), F.lit("")) for p in forms])


def normal_query_spec(spec: Column) -> Column:
    """Diameter signs and inches to mm, one space in schedules."""
    inch = F.regexp_extract(spec, r"^(\d+(?:-\d+/\d+|/\d+)?)\s*(?:inch|인치|\")", 1)
    mm = F.create_map(*[F.lit(x) for k, v in INCH_MM.items() for x in (k, str(v))])[F.when(inch != "", inch)]
    t = F.regexp_replace(F.regexp_replace(spec, r"[φΦø]\s*(\d+)", "$1mm"), r"(?i)sch\s*(\d+)", "SCH $1")
    return F.when(mm.isNotNull(), F.concat(mm, F.lit("mm"))).otherwise(F.regexp_replace(t, r"(\d)\s+mm", "$1mm"))


def size_numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?:[φΦø]|DN|D=|W=|H=|SCH)\s*(\d+)"), F.lit(1))


def keep_useful(terms: Column, least: int = 4) -> Column:
    """Short English words go unless nothing else is left."""
    good = F.filter(terms, lambda t: ~t.rlike(f"^[A-Za-z]{{1,{least - 1}}}$"))
    return F.when(F.size(good) == 0, terms).otherwise(good)


def drop_contained_terms(terms: Column, name: Column) -> Column:
    return F.filter(terms, lambda t: ~(name.contains(t) | t.contains(name)))


# ---- presentation ----


def facets(name: Column) -> Column:
    """Axis to value, from a name: diameter, size, kind before the first word, code at the end."""
    axes = {"diameter": r"φ\s*(\d+)", "code": r"([0-9A-Z]{6})\W*$", "class": r"^(\S+형)\s", "number": r"(?i)no\.\s*(\w+)"}
    pairs = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), F.regexp_extract(name, p, 1).alias("value")) for k, p in axes.items()]), lambda x: x["value"] != "")
    return F.map_from_entries(pairs)


def facet_axes(df: DataFrame, by: str, name: str, least: int = 2) -> DataFrame:
    """(by, axis, n_values): axes on which a group has several values."""
    x = df.select(by, F.explode(facets(F.col(name))).alias("axis", "value"))
    return x.groupBy(by, "axis").agg(F.countDistinct("value").alias("n_values")).filter(F.col("n_values") >= least)


def modal_base(df: DataFrame, by: str, name: str, least_share: float = 0.4, least: int = 4) -> DataFrame:
    """(by, base, n): the most frequent base name (without parentheses, sizes and code) if it is frequent enough."""
    base = F.trim(F.regexp_replace(F.regexp_replace(F.col(name), r"\([^)]*\)", ""), r"[\s·,/_-]*[0-9A-Z]{6}\W*$|φ\s*\d+", ""))
    c = df.groupBy(by, base.alias("base")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(by)
    c = c.withColumn("all", F.sum("n").over(w)).withColumn("rn", F.row_number().over(w.orderBy(F.desc("n"), "base")))
    return c.filter((F.col("rn") == 1) & ((F.col("n") >= least) | (F.col("n") >= F.col("all") * least_share))).select(by, "base", "n")


def section_options(nodes: DataFrame, group: str, most: int = 15) -> DataFrame:
    """Options to choose from: the first ``most`` names of a group by number, then name."""
    number = F.coalesce(F.regexp_extract("name", r"(\d+)", 1).try_cast("int"), F.lit(99))
    w = Window.partitionBy(group).orderBy(number, "name", "id")
    return nodes.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= most).select(group, "position", "id", "name")


def matrix(df: DataFrame, row: str, col: str, value: str, order: str, columns: list[str]) -> DataFrame:
    """Pivot with the last value by order in each place."""
    return df.groupBy(row).pivot(col, columns).agg(F.max_by(value, order))


def context_text(df: DataFrame, by: str, part: str, order: list[str], most_chars: int = 6000) -> DataFrame:
    """Parts of a group in order, joined and cut to a size, with its estimated tokens.

    A part and its line end are a character at least, so no more than ``most_chars`` parts of a group can show;
    further ones go before the shuffle, and what lies behind the cut goes before anything is collected.
    """
    w = Window.partitionBy(by).orderBy(*order, part)
    d = df.select(by, *[c for c in order if c != part], F.substring(part, 1, most_chars).alias(part)).withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most_chars)
    before = F.coalesce(F.sum(F.length(part) + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = d.withColumn("__before", before).filter(F.col("__before") < most_chars)
    d = d.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("__n", F.col(part).alias("part")))).alias("x"))
    text = F.substring(F.array_join(F.transform("x", lambda e: e["part"]), "\n"), 1, most_chars)
    return d.select(by, text.alias("context")).withColumn("tokens", F.ceil(F.length("context") / 2).cast("int"))


def group_chunks(chunks: DataFrame, most: int = 15) -> DataFrame:
    """The first ``most`` chunks of a section, repeated deliveries once."""
    one = chunks.groupBy("section_id", "chunk_id").agg(F.max("text").alias("text"))
    w = Window.partitionBy("section_id").orderBy("chunk_id")
    return one.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= most).drop("rn")


def route(question: Column, entity_id: Column, section_id: Column) -> Column:
    """The path that answers a request: entity, section or search; none for a blank question without an entity."""
    given = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.when(given(entity_id), "entity").when(~given(question), "none").when(given(section_id), "section").otherwise("search")
