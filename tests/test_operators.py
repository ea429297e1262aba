"""Operators that SQL cannot check as a whole, on hand-made inputs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from lodegraph.functions import external
from lodegraph.operators import normalise, ordering, retrieval, segments, skew, tables, texts
from lodegraph.sources import stores
from lodegraph.streaming import stateful


def test_grid_spans_and_unclosed_cells():
    html = "<table><tr><td rowspan=2>a<td colspan='2'>b &amp; c<sup>2</sup><tr><td>d<td>e&nbsp;f<br>g</table>"
    assert tables.expand_grid(html) == [["a", "b & c^2", "b & c^2"], ["a", "d", "e f g"]]
    assert tables.expand_grid("<table></table>") == [] and tables.expand_grid("") == []
    assert tables.expand_grid("<table><tr><td rowspan=x colspan=0>a</td></tr></table>") == [["a"]]


def test_grids_and_headers(spark):
    d = spark.createDataFrame([(1, "x<table><tr><th colspan=2>A</th><th>B</th></tr><tr><td>p</td><td>q</td><td>r</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"), (2, None), (3, "")], "id long, text string")
    g = tables.grids(d, "id")
    r = g.select("id", tables.header_depth(F.col("grid")).alias("n"), tables.composite_headers(F.col("grid"), tables.header_depth(F.col("grid"))).alias("h")).collect()
    assert [(x.id, x.n, x.h) for x in r] == [(1, 2, ["A_p", "A_q", "B_r"])]


@pytest.mark.parametrize("cell, number, quantity", [("1,200", 1200.0, 1200.0), ("0.10", None, 0.1), ("3.5", 3.5, 3.5), ("-", None, None), ("", None, None), ("(4)", None, 4.0), ("1e5", None, 1e5)])
def test_numbers(spark, cell, number, quantity):
    r = spark.createDataFrame([(cell,)], "c string").select(tables.number_of(F.col("c")).alias("n"), tables.cell_quantity(F.col("c")).alias("q")).first()
    assert (r.n, r.q) == (number, quantity)


def test_split_rows_keeps_order_and_budget(spark):
    rows = ["a" * 10, "b" * 10, "c" * 100, "d" * 2, "e" * 2]
    got = spark.createDataFrame([(rows,)], "r array<string>").select(tables.split_rows(F.col("r"), budget=12).alias("p")).first().p
    assert [x for p in got for x in p] == rows and [len(p) for p in got] == [2, 1, 2]


def test_sections_and_shared_text(spark):
    m = "<!-- SECTION: {0} | {1} | 부문:토목 | 장:일반 -->"
    text = m.format("1-1", "first") + "\n" + m.format("1-2", "second") + "\nintro\n1-1 first body\n1-2 second body\n" + m.format("1-3", "third") + "\nalone"
    d = spark.createDataFrame([("f", text)], "file string, text string")
    found = segments.markers(d, "SECTION").collect()
    assert [(x.section_id, text[x.start_pos : x.end_pos][:12]) for x in found] == [("1-1", "<!-- SECTION"), ("1-2", "<!-- SECTION"), ("1-3", "<!-- SECTION")]
    groups = segments.sections_of(d)
    assert sorted((x.section_ids, x.raw_text) for x in groups.collect()) == [(["1-1", "1-2"], "intro\n1-1 first body\n1-2 second body"), (["1-3"], "alone")]
    titles = spark.createDataFrame([("1-1", "first"), ("1-2", "second"), ("1-3", "third")], "section_id string, title string")
    parts = {x.section_id: x.part for x in segments.spread_text(groups, titles).collect()}
    assert parts == {"1-1": "intro\n1-1 first body", "1-2": "1-2 second body", "1-3": "alone"}


def test_chapter_repair_and_reflow(spark):
    r = spark.createDataFrame([("1-2-3", 11), ("2-2", 11), ("3-1", 3)], "s string, n int").select(segments.repair_chapter(F.col("s"), F.col("n")).alias("x")).collect()
    assert [x.x for x in r] == ["11-2-3", "2-2", "3-1"]
    t = "첫째 줄이\n이어진다.\n- 항목\n\n\n\n끝 줄"
    got = spark.createDataFrame([(t,)], "t string").select(segments.reflow(F.col("t")).alias("x")).first().x
    assert got == "첫째 줄이 이어진다.\n- 항목\n\n끝 줄"


def test_global_row_number(spark):
    d = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v"))
    got = {r.v: r.row_no for r in ordering.global_row_number(d, ["v"]).collect()}
    assert got == {i: i + 1 for i in range(1000)}
    assert ordering.global_row_number(d.limit(0), ["v"]).count() == 0


def test_windows_over_hot_keys_follow_the_order(spark):
    """A key that fills many parts gives what a plain window gives."""
    import random

    r = random.Random(1)
    rows = [(None if i % 97 == 0 else "hot" if r.random() < 0.7 else f"k{i % 5}", i, r.choice([None, None, i])) for i in range(3000)]
    d = spark.createDataFrame(rows, "k string, t long, v long").repartition(7)
    w = Window.partitionBy("k").orderBy("t")
    want = {x.t: x.v for x in d.withColumn("v", F.last("v", ignorenulls=True).over(w)).collect()}
    assert {x.t: x.v for x in ordering.carry_forward(d, ["k"], ["t"], ["v"]).collect()} == want
    gap = (F.col("t") - F.col("prev_t")) > 2
    flags = d.withColumn("prev_t", F.lag("t").over(w)).withColumn("n", F.when(F.col("prev_t").isNull() | gap, 1).otherwise(0))
    runs = {x.t: x.i for x in flags.withColumn("i", F.sum("n").over(w)).collect()}
    assert {x.t: x.island for x in ordering.islands(d, ["k"], ["t"], gap).collect()} == runs
    left, right = d.filter("t % 3 = 0").drop("v"), d.filter("t % 3 = 1").select("k", "t", F.col("t").alias("u"))
    got = {x.t: x.asof_u for x in ordering.asof_join(left, right, ["k"], "t", ["u"]).collect()}
    last = {}
    for k, t, _ in rows:
        if t % 3 == 1:
            last[k] = t
        elif t % 3 == 0:
            assert got[t] == last.get(k)
    assert ordering.carry_forward(d.limit(0), ["k"], ["t"], ["v"]).count() == 0


def test_lookup_join_with_hot_and_null_keys(spark):
    rows = spark.createDataFrame([("h", i) for i in range(900)] + [("k%d" % i, i) for i in range(90)] + [(None, 1)], "k string, v int")
    look = spark.createDataFrame([("h", "H"), ("k1", "K")], "k string, w string")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(counts, "k", "n", 991)
    assert [r.k for r in hot.collect()] == ["h"]
    got = skew.lookup_join(rows, look, "k", hot)
    assert got.count() == 991 and got.filter("w = 'H'").count() == 900 and got.filter("w = 'K'").count() == 1
    assert skew.lookup_join(rows, look, "k", hot, "inner").count() == 901


def test_upsert_and_update(spark):
    a = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, t int")
    b = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], "id int, v string, t int")
    assert {(r.id, r.v) for r in stores.upsert(a, b, ["id"], [F.desc("t")]).collect()} == {(1, "a"), (2, "d"), (3, "e")}
    with pytest.raises(ValueError):
        stores.positional_update(a, "other", "id", "v", b)


def test_documents_toc_and_stages(spark, tmp_path):
    (tmp_path / "gn_030-059.md").write_text("zwei", "utf-8")
    (tmp_path / "x.md").write_text("eins", "utf-8")
    (tmp_path / "toc.json").write_text('{"section_map": {"1-1": {"id": "1-1", "chapter": "c", "section": "s", "title": "t", "page": 3}}}')
    got = stores.read_marked_documents(spark, str(tmp_path)).orderBy("first_page").collect()
    assert [(r.file, r.first_page, r.text) for r in got] == [("x.md", 0, "eins"), ("gn_030-059.md", 30, "zwei")]
    assert stores.read_toc(spark, str(tmp_path / "toc.json")).first().asDict() == {"key": "1-1", "id": "1-1", "chapter": "c", "section": "s", "title": "t", "page": 3}
    meta = stores.write_staged(spark.range(5), str(tmp_path / "stage"), {"rows": F.count(F.lit(1))})
    assert meta.first().rows == 5 and spark.read.parquet(str(tmp_path / "stage/rows")).count() == 5


def test_names(spark):
    r = spark.createDataFrame([("강관용접 ( φ200, ＳＣＨ 40 )",), (None,), ("",)], "n string").select(normalise.normal_name(F.col("n")).alias("x")).collect()
    assert [x.x for x in r] == ["강관용접(200, SCH 40)", "", ""]


def test_notes_and_years(spark):
    t = "본문\n[주]\n① 첫째 ② 둘째\n\n다음"
    r = spark.createDataFrame([(t,)], "t string").select(texts.notes(F.col("t")).alias("n"), texts.without_notes(F.col("t")).alias("w")).first()
    assert r.n == ["첫째", "둘째"] and r.w == "본문\n\n\n다음"
    y = spark.createDataFrame([("('24년 보완)",), ("('98, '22년 보완)",), ("",)], "t string").select(texts.revision_year(F.col("t")).alias("y")).collect()
    assert [x.y for x in y] == ["2024", "1998", ""]


@pytest.mark.parametrize("text", [None, "", "not_a_vector", "[1, 2]", "[NaN, 1, 2]", "[1, null, 3]"])
def test_bad_query_vectors_find_nothing(spark, text):
    d = spark.createDataFrame([("a", [1.0, 0.0, 0.0])], "id string, embedding array<float>")
    q = spark.createDataFrame([("x", retrieval.parse_vector(text, 3)), ("y", retrieval.parse_vector("[1, 0, 0]", 3))], "qid string, vector array<double>")
    assert [tuple(x) for x in retrieval.vector_search(q, d, dim=3).collect()] == [("y", "a", 1.0, 1)]


def test_vector_search_against_brute_force(spark):
    import numpy as np

    r = np.random.default_rng(2)
    x = r.normal(size=(300, 8))
    x[7], x[9] = x[3] * 2, x[3]
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(900, None), (901, [0.0] * 8), (902, [1.0]), (903, [float("nan")] * 8), (None, [1.0] * 8)]
    d = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)
    q = d.filter("id % 3 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("vector"))
    y = x.astype("f4").astype("f8")
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    for block in (10_000, 20):
        got = {}
        for p in retrieval.vector_search(q, d, 4, 0.1, dim=8, block=block).orderBy("qid", "rank").collect():
            got.setdefault(p.qid, []).append(p.id)
        for i in range(0, 300, 3):
            s = [(-round(float(v), 9), j) for j, v in enumerate(y @ y[i]) if v > 0.1]
            assert got[i] == [j for _, j in sorted(s)[:4]]
        assert set(got) == set(range(0, 300, 3))
    assert retrieval.vector_search(q.limit(0), d, dim=8).count() == 0 and retrieval.vector_search(q, d.limit(0), dim=8).count() == 0


def test_query_specs(spark):
    r = spark.createDataFrame([("φ100",), ("2 inch",), ("sch40",), ("50 mm",), (None,)], "s string").select(retrieval.normal_query_spec(F.col("s")).alias("x")).collect()
    assert [x.x for x in r] == ["100mm", "50mm", "SCH 40", "50mm", None]


def test_retry_and_embedding(spark):
    calls, waits = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return x

    assert external.with_retry(flaky, sleep=waits.append)(1) == 1 and waits == [1.0, 2.0]
    v = external.hash_embed(["a b", None, ""], 16)
    assert np.allclose(np.linalg.norm(v, axis=1), 1) and np.array_equal(v[1], v[2])


def test_rate_limit_batch_and_stream(spark, tmp_path):
    s, base = 1_000_000, 1_700_000_000
    times = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 59, 61 + 60, 130]
    d = spark.createDataFrame([("ip", i, (base + t) * s) for i, t in enumerate(times)] + [("other", 99, base * s)], "k string, i long, at long")
    got = {r.i: r.allowed for r in stateful.rate_limit(d, "k", "i", "at").collect()}
    assert [got[i] for i in range(len(times))] == [True] * 10 + [False, False, True, True] and got[99]
    src = tmp_path / "in"
    d.select("k", "at").coalesce(1).write.json(str(src))
    stream = spark.readStream.schema("k string, at long").json(str(src))
    q = stateful.rate_limit_stream(stream, "k", "at").writeStream.format("memory").queryName("limited").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = spark.sql("select * from limited").toPandas()
    assert isinstance(rows, pd.DataFrame) and len(rows) == len(times) + 1 and int((~rows.allowed).sum()) == 2


def test_directions_in_every_branch(spark):
    e = spark.createDataFrame([(2, "WorkType", "w2", "a"), (1, "WorkType", "w1", "a"), (3, "Section", "s", "b"), (4, "WorkType", "w", " ")], "row_id long, type string, name string, source_chunk_id string")
    rows = [
        (1, "REQUIRES_LABOR", "x", "WorkType", "l", "Labor", "a", "keep", "x", "WorkType", "Labor"), (2, "HAS_CHILD", "x", "Labor", "l", "Labor", "a", "keep", "x", "Labor", "Labor"),
        (3, "HAS_NOTE", "x", "WorkType", "※ 별도 계상", "WorkType", "a", "note", "x", "WorkType", "Note"), (4, "HAS_NOTE", "x", "WorkType", "paving", "WorkType", "a", "drop", "x", "WorkType", "WorkType"),
        (5, "REQUIRES_LABOR", "x", "Equipment", "l", "Labor", "a", "work", "w1", "WorkType", "Labor"), (6, "USES_MATERIAL", "x", "Equipment", "m", "Material", "b", "section", "s", "Section", "Material"),
        (7, "REQUIRES_LABOR", "x", "Equipment", "m", "Labor", "b", "drop", "x", "Equipment", "Labor"), (8, "HAS_NOTE", "n", "Note", "m", "Note", "a", "drop", "n", "Note", "Note"),
        (9, "BELONGS_TO", "n", "Note", "s", "Section", "a", "work", "w1", "WorkType", "Section"), (10, "APPLIES_STANDARD", "n", "Note", "s", "Note", "a", "drop", "n", "Note", "Note"),
        (11, "REQUIRES_LABOR", "x", None, "l", None, None, "drop", "x", None, None), (12, "USES_MATERIAL", "x", "Note", "m", "Material", " ", "drop", "x", "Note", "Material"),
    ]
    r = spark.createDataFrame([x[:7] for x in rows], "rel_id long, type string, source string, source_type string, target string, target_type string, source_chunk_id string")
    got = {x.rel_id: (x.action, x.source, x.source_type, x.target_type) for x in normalise.repair_directions(r, normalise.chunk_heads(e)).collect()}
    assert got == {x[0]: x[7:] for x in rows}
    assert normalise.repair_directions(r.limit(0), normalise.chunk_heads(e.limit(0))).count() == 0


class _State:
    """The state of a key, as a stream keeps it."""

    def __init__(self, watermark=0):
        self.value, self.hasTimedOut, self.until, self.watermark = None, False, None, watermark

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, v):
        self.value = v

    def remove(self):
        self.value = None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark
        self.until = ms


def test_rate_limit_takes_all_frames_of_a_key_in_order():
    s, step = 1_000_000, stateful.limit_step("k", "at", 60_000_000, 3, rows=2)
    frames = [pd.DataFrame({"at": [50 * s, 10 * s]}), pd.DataFrame({"at": [70 * s, 0]}), pd.DataFrame({"at": [20 * s]})]
    state = _State()
    got = pd.concat(list(step(("a",), iter(frames), state)))
    assert got["at"].tolist() == [0, 10 * s, 20 * s, 50 * s, 70 * s] and got.allowed.tolist() == [True, True, True, False, True]
    assert state.value == (70 * s, 1) and state.until == 130_001
    more = pd.concat(list(step(("a",), iter([pd.DataFrame({"at": [90 * s]})]), state)))
    assert more.allowed.tolist() == [True] and state.value == (70 * s, 2)
    state.hasTimedOut = True
    assert list(step(("a",), iter([]), state)) == [] and not state.exists


def test_last_turns(spark):
    rows = [(i, "a" if i % 3 else "b", i // 2, None if i == 4 else f"v{i}") for i in range(40)] + [(99, None, 1, "x")]
    d = spark.createDataFrame(rows, "id long, who string, at int, v string").repartition(5)
    got = {r.id: r.turns for r in stateful.last_turns(d, "who", ["at", "id"], "id", "v", 3).collect()}
    for i, who, at, _ in rows:
        mine = sorted((x[2], x[0], x[3]) for x in rows if x[1] == who and (x[2], x[0]) <= (at, i))[-3:]
        assert got[i] == [x[2] for x in mine if x[2] is not None]
    assert len(got) == len(rows) and stateful.last_turns(d.limit(0), "who", ["at", "id"], "id", "v").count() == 0
