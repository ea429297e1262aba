"""Questions to answers: search, expansion and context in one plan; the text generator is a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lodegraph.operators import retrieval as V, search

MAX_QUESTION, MAX_ENTITIES, MAX_CONTEXT, MAX_TURNS = 500, 10, 6000, 5


def requests(df: DataFrame) -> DataFrame:
    """(qid, question, history): questions trimmed to 500 characters, blank ones out, the last 5 turns of history."""
    q = F.substring(F.trim("question"), 1, MAX_QUESTION)
    history = F.slice("history", F.greatest(F.size("history") - MAX_TURNS + 1, F.lit(1)), MAX_TURNS) if "history" in df.columns else F.array().cast("array<string>")
    return df.select("qid", q.alias("question"), F.coalesce(history, F.array().cast("array<string>")).alias("history")).filter("question <> ''")


def contexts(questions: DataFrame, nodes: DataFrame, edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """(qid, question, entities, context, tokens): the best entities of each question with what hangs on them.

    Sections that two entities share are expanded once, as edges are joined to the distinct hits.
    """
    hits = search.target_search(questions, nodes, chunks)
    hits = hits.filter("stage < 7")  # bodies name sections, not entities
    w = Window.partitionBy("qid").orderBy(F.desc("similarity"), "id")
    top = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= MAX_ENTITIES)
    hop = V.one_hop(edges, nodes, top.select("id").distinct()).select("id", F.concat_ws(" ", "relation", "related_name").alias("line"), F.lit(1).alias("kind"))
    own = nodes.select("id", F.concat_ws(": ", "type", "name").alias("line"), F.lit(0).alias("kind"))
    lines = top.join(own.unionByName(hop), "id").select("qid", "rank", "id", "kind", "line")
    ctx = V.context_text(lines, "qid", "line", ["rank", "id", "kind"], MAX_CONTEXT)
    n = top.groupBy("qid").agg(F.count(F.lit(1)).alias("entities"), F.max("stage").alias("stage"))
    return questions.select("qid", "question").join(n, "qid").join(ctx, "qid", "left").select("qid", "question", "entities", "stage", F.coalesce("context", F.lit("")).alias("context"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def answers(ctx: DataFrame, generate: Callable[[list[str], list[str]], list[str]] | None = None) -> DataFrame:
    """(qid, type, answer, entities, tokens): without a generator the answer is the context; no context: clarify."""
    kind = dict(ctx.dtypes)["qid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, c = b.column(1).to_pylist(), b.column(2).to_pylist()
            a = generate(q, c) if generate else c
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(["answer" if x else "clarify" for x in c]), pa.array(a, pa.string()), b.column(3), b.column(4)], ["qid", "type", "answer", "entities", "tokens"])

    return ctx.select("qid", "question", "context", "entities", "tokens").mapInArrow(run, f"qid {kind}, type string, answer string, entities bigint, tokens int")
