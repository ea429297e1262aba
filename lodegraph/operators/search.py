"""Search for the entities a question asks for: names first, in stages, vectors and bodies last.

A pattern is a list of parts that a name must contain in this order (``%a%b%``). Patterns are answered through
an index of the letters and pairs of letters in the names: each pattern meets the names that hold its rarest piece, and
those are checked in full, so all patterns of all questions go through one join and none is held against every
name. A later stage sees only the questions that the earlier ones left without an answer.

Defined results: names and questions compare in lower case; an empty pattern finds nothing; null names and
questions take no part; ties are broken by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegraph.operators.retrieval import keep_useful, keyword_hits, spec_of, vector_search, words
from lodegraph.plans.session import cut

_CODE = r"([0-9A-Z]{6})\W*$"


def pieces(text: Column) -> Column:
    """Different letters and pairs of letters of a text."""
    cut_at = lambda n: F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) > 0, F.array_distinct(F.concat(cut_at(1), cut_at(2)))).otherwise(F.array().cast("array<string>"))


def in_order(text: Column, parts: Column) -> Column:
    """Whether a text holds all parts one behind another."""
    at = lambda p, x: F.call_function("locate", x, text, p)
    return F.aggregate(parts, F.lit(1), lambda p, x: F.when((p > 0) & (at(p, x) > 0), at(p, x) + F.length(x)).otherwise(0)) > 0


def pattern_hits(patterns: DataFrame, nodes: DataFrame) -> DataFrame:
    """``patterns`` (…, parts) joined with the ``nodes`` (id, name) whose names match: (…, id, name), each once."""
    names = nodes.filter("name is not null").select("id", F.lower("name").alias("name")).distinct()
    index = names.select("id", F.explode(pieces(F.col("name"))).alias("piece"))
    asked = patterns.select("parts").distinct()
    own = asked.select("parts", F.explode(F.array_distinct(F.flatten(F.transform("parts", pieces)))).alias("piece"))
    n = index.join(own.select("piece").distinct(), "piece", "left_semi").groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    # a piece that no name holds ends the pattern
    rare = own.join(n, "piece", "left").groupBy("parts").agg(F.min_by("piece", F.coalesce("n", F.lit(0))).alias("piece"), F.min(F.coalesce("n", F.lit(0))).alias("n")).filter("n > 0").drop("n")
    found = rare.join(index, "piece").select("parts", "id").join(names, "id").filter(in_order(F.col("name"), F.col("parts")))
    return patterns.distinct().join(found, "parts").drop("parts").distinct()


def analyse(questions: DataFrame) -> DataFrame:
    """(qid, question) with work_name, spec and terms: the code at the end or the size in it is the spec, what is
    left the name; terms are its useful words."""
    code = F.nullif(F.regexp_extract("question", _CODE, 1), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace("question", _CODE, ""), r"[\s·,/_(-]+$|(?i)\s+no\.\s*$", "")
    d = questions.filter("question is not null").withColumn("spec", F.lower(F.coalesce(code, spec_of(F.col("question")))))
    d = d.withColumn("work_name", F.nullif(F.trim(F.lower(bare)), F.lit("")))
    return d.withColumn("terms", keep_useful(words(F.col("work_name"))))


def _mixed(term: Column) -> Column:
    """Parts of a term in two scripts, null for others."""
    runs = F.regexp_extract_all(term, F.lit(r"[a-z]+|[가-힣]+|\d+"), F.lit(0))
    return F.when(term.rlike("[a-z]") & term.rlike("[가-힣]"), runs)


def _aliases(d: DataFrame, term: str, table: dict[str, str], both: bool) -> DataFrame:
    """(qid, parts) of the names that stand for a word of a term."""
    pairs = [(a.lower(), b.lower()) for a, b in table.items()] + ([(b.lower(), a.lower()) for a, b in table.items()] if both else [])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs]).cast("array<struct<a:string,b:string>>")
    return d.select("qid", F.explode(F.filter(rows, lambda x: F.array_contains(words(F.col(term)), x["a"]))).alias("x")).select("qid", F.array("x.b").alias("parts"))


def _first(hits: DataFrame, limits: dict[int, int], order: list[Column]) -> DataFrame:
    """Of each question the hits of its first stage, up to the stage's limit."""
    w = Window.partitionBy("qid", "stage").orderBy(*order)
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[F.col("stage")]
    top = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max(limits.values())).filter(F.col("rank") <= limit)
    return top.withColumn("__m", F.min("stage").over(Window.partitionBy("qid"))).filter("stage = __m").drop("__m")


SIMILARITY = {1: 1.0, 2: 0.98, 3: 0.96, 4: 0.95, 5: 0.90}


def target_search(questions: DataFrame, nodes: DataFrame, chunks: DataFrame, synonyms: dict[str, str] = {}, short: dict[str, str] = {}, dim: int = 64) -> DataFrame:
    """(qid, id, stage, similarity, rank): the answers of the first stage that has any.

    ``questions`` (qid, question, and a vector if there is one), ``nodes`` (id, name, type, source_section, and an
    embedding if there is one; one row an id),
    ``chunks`` (section_id, text). Stages: 1 name then spec (5); 2 the name, its two-script parts or a synonym (20);
    3 what a short form stands for, standards too (5); 1 to 3 need a spec. 4 a term, its parts or a synonym, best 20
    by 2 for each term and 1 for each Hangul word of the question; 5 the name alone, if there are several terms (20).
    6 the 5 best of the 10 nearest vectors above 0.4, sections without a chunk 0.3 further down, behind (7) the 5
    first sections whose text has all words, unless a WorkType reaches 0.7.
    """
    none = F.lit(None).cast("array<float>")
    questions = questions if "vector" in questions.columns else questions.withColumn("vector", none)
    nodes = nodes if "source_section" in nodes.columns else nodes.withColumn("source_section", F.lit(None).cast("string"))
    nodes = nodes if "embedding" in nodes.columns else nodes.withColumn("embedding", none)
    d = cut(analyse(questions))
    works = nodes.filter("type in ('WorkType', 'Section')")
    named = d.filter("work_name is not null")
    both = named.filter("spec is not null")
    of = lambda x, stage: x.withColumn("stage", F.lit(stage))
    mixed = lambda x, c: x.select("qid", _mixed(F.col(c)).alias("parts")).filter("parts is not null")

    one = of(both.select("qid", F.array("work_name", "spec").alias("parts")), 1)
    for more in (both.select("qid", F.array("work_name").alias("parts")), mixed(both, "work_name"), _aliases(both, "work_name", synonyms, True)):
        one = one.unionByName(of(more, 2))
    hits = pattern_hits(one, works).select("qid", "stage", "id").distinct()
    abbreviated = pattern_hits(of(_aliases(both, "work_name", short, False), 3), nodes.filter("type in ('WorkType', 'Section', 'Standard')")).select("qid", "stage", "id").distinct()
    first = cut(_first(hits.unionByName(abbreviated), {1: 5, 2: 20, 3: 5}, [F.col("id")]).select("qid", "id", "stage", "rank"))

    left = cut(named.join(first.select("qid").distinct(), "qid", "left_anti"))
    terms = left.select("qid", F.explode("terms").alias("term"))
    two = of(terms.select("qid", F.array("term").alias("parts")), 4)
    for more in (mixed(terms, "term"), _aliases(left, "work_name", synonyms, True)):
        two = two.unionByName(of(more, 4))
    two = two.unionByName(of(left.filter("size(terms) > 1").select("qid", F.array("work_name").alias("parts")), 5))
    hits = pattern_hits(two, works).select("qid", "stage", "id", "name").distinct()
    asked = left.select("qid", words(F.col("work_name")).alias("all"), F.regexp_extract_all(F.lower("question"), F.lit("[가-힣]+"), F.lit(0)).alias("hangul"))
    has = lambda c: F.size(F.filter(c, lambda t: F.col("name").contains(t)))
    scored = hits.join(asked, "qid").withColumn("score", F.when(F.col("stage") == 4, has(F.col("all")) * 2 + has(F.col("hangul"))).otherwise(0))
    second = cut(_first(scored, {4: 20, 5: 20}, [F.desc("score"), F.col("id")]).select("qid", "id", "stage", "rank"))

    rest = cut(d.join(first.select("qid").unionByName(second.select("qid")).distinct(), "qid", "left_anti"))
    near = vector_search(rest.select("qid", "vector"), works.select("id", "embedding"), 10, 0.4, dim=dim)
    full = chunks.select(F.col("section_id").alias("source_section"), F.lit(True).alias("full")).distinct()
    near = near.join(works.select("id", "type", "source_section"), "id").join(full, "source_section", "left")
    empty = (F.col("type") == "Section") & F.col("source_section").isNotNull() & F.col("full").isNull()
    near = near.withColumn("similarity", F.round(F.col("similarity") - F.when(empty, 0.3).otherwise(0.0), 6))
    w = Window.partitionBy("qid").orderBy(F.desc("similarity"), "id")
    near = cut(near.withColumn("rank", F.row_number().over(w)).filter("rank <= 5").select("qid", "id", F.lit(6).alias("stage"), "similarity", "rank", "type"))
    good = near.filter("type = 'WorkType' and similarity >= 0.7").select("qid").distinct()
    open_ = rest.join(good, "qid", "left_anti")
    bodies = chunks.filter("text is not null").select(F.col("section_id").alias("id"), "text")
    body = keyword_hits(open_.select("qid", "question"), bodies, "text").filter("hits = asked").select("qid", "id").distinct()
    body = body.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("id"))).filter("rank <= 5").select("qid", "id", F.lit(7).alias("stage"), F.lit(0.8).alias("similarity"), "rank")
    sims = F.create_map(*[F.lit(x) for kv in SIMILARITY.items() for x in kv])[F.col("stage")]
    early = first.unionByName(second).select("qid", "id", "stage", sims.alias("similarity"), "rank")
    return early.unionByName(near.drop("type")).unionByName(body)


def hybrid_search(questions: DataFrame, nodes: DataFrame, k: int = 5, dim: int = 64) -> DataFrame:
    """(qid, id, rank): the k nearest vectors above 0.4; if none of their names holds all the sizes of the question,
    names that do come first. An id comes once. ``questions`` (qid, question, vector), ``nodes`` (id, name, embedding)."""
    sizes = F.array_distinct(F.regexp_extract_all("question", F.lit(r"\d{2,}"), F.lit(0)))
    q = cut(questions.select("qid", "vector", sizes.alias("sizes")))
    near = vector_search(q.select("qid", "vector"), nodes.select("id", "embedding"), k, 0.4, dim=dim).join(nodes.select("id", F.lower("name").alias("name")), "id").join(q.select("qid", "sizes"), "qid")
    near = cut(near.withColumn("exact", F.forall("sizes", lambda s: F.col("name").contains(s))))
    lacking = q.filter("size(sizes) > 0").join(near.filter("exact").select("qid").distinct(), "qid", "left_anti")
    # the longest number leads, the others are checked in the names it finds
    lead = lacking.select("qid", "sizes", F.array(F.element_at(F.array_sort("sizes", lambda a, b: F.length(b) - F.length(a)), 1)).alias("parts"))
    named = pattern_hits(lead, nodes).filter(F.forall("sizes", lambda s: F.col("name").contains(s))).select("qid", "id").distinct()
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("id"))).filter(F.col("rank") <= k)
    u = named.withColumn("pri", F.lit(0)).unionByName(near.select("qid", "id", "rank").withColumn("pri", F.lit(1)))
    one = u.groupBy("qid", "id").agg(F.min(F.struct("pri", "rank")).alias("o"))
    return one.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("o", "id"))).filter(F.col("rank") <= k).select("qid", "id", "rank")
