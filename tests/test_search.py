"""Staged search, matrices and paged scans on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from lodegraph.operators import extract, search, tables
from lodegraph.sources import stores

V = [1.0, 0.0]


def test_every_stage_answers(spark):
    nodes = [
        ("W1", "Pump setting ABC123", "WorkType", "1-1", None), ("W2", "Pump setting", "WorkType", "1-1", None), ("W3", "PE(가스)관 접합", "WorkType", "1-2", None), ("W4", "tungsten weld", "WorkType", "1-2", None),
        ("D1", "tile mounting", "Standard", None, None), ("W5", "near", "WorkType", "1-3", [1.0, 0.5]), ("S1", "empty section", "Section", "9-9", [1.0, 0.1]), ("N1", "pump note", "Note", None, [1.0, 0.0]), ("X", None, "WorkType", None, None),
    ]
    n = spark.createDataFrame(nodes, "id string, name string, type string, source_section string, embedding array<float>")
    q = [("1", "pump setting ABC123", None), ("2", "pump setting ZZZ999", None), ("3", "취부 ZZZ999", None), ("4", "weld 준설", None), ("5", "PE관 ZZZ999", None), ("6", "쇄석", V), ("7", "다짐 모래", None), ("8", None, V), ("9", "", None), ("10", "파이프 ZZZ999", None)]
    d = spark.createDataFrame(q, "qid string, question string, vector array<float>")
    c = spark.createDataFrame([("1-3", "모래 다짐 기준"), ("1-3", "둘째"), ("1-1", None)], "section_id string, text string")
    got = {}
    for r in search.target_search(d, n, c, {"파이프": "pump"}, {"취부": "mounting"}, dim=2).orderBy("qid", "stage", "rank").collect():
        got.setdefault(r.qid, []).append((r.stage, r.id, round(r.similarity, 2)))
    assert got["1"] == [(1, "W1", 1.0)] and [x[:2] for x in got["2"]] == [(2, "W1"), (2, "W2")] and got["3"] == [(3, "D1", 0.96)] and got["4"] == [(4, "W4", 0.95)]
    assert got["5"] == [(2, "W3", 0.98)] and [x[1] for x in got["10"]] == ["W1", "W2"]
    # the section without a chunk falls behind; notes take no part
    assert got["6"] == [(6, "W5", 0.89), (6, "S1", 0.7)] and got["7"] == [(7, "1-3", 0.8)] and not {"8", "9"} & set(got)
    assert search.target_search(d.limit(0), n, c).count() == 0 and search.target_search(d, n.limit(0), c.limit(0)).count() == 0


def test_names_with_the_numbers_come_first(spark):
    n = spark.createDataFrame([("a", "weld 250", [1.0, 0.0]), ("b", "weld 200 40", [0.0, 1.0]), ("c", "weld 200", None), ("d", "pipe", [1.0, 0.1])], "id string, name string, embedding array<float>")
    q = spark.createDataFrame([("x", "weld 200 SCH 40", V), ("y", "weld", V), ("z", "weld 250", V)], "qid string, question string, vector array<float>")
    got = {}
    for r in search.hybrid_search(q, n, 2, dim=2).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.id)
    assert got == {"x": ["b", "a"], "y": ["a", "d"], "z": ["a", "d"]}


def test_patterns_against_brute_force(spark):
    import itertools

    names = ["".join(x) for k in (1, 2, 3, 4) for x in itertools.product("ab가", repeat=k)]
    n = spark.createDataFrame([(str(i), x) for i, x in enumerate(names)] + [("n", None)], "id string, name string")
    parts = [["a"], ["ab"], ["a", "b"], ["가", "a", "가"], ["b가", "a"], ["zz"], ["a", "z"], []]
    p = spark.createDataFrame([(str(i), x) for i, x in enumerate(parts)], "qid string, parts array<string>")

    def holds(name, ps):
        at = 0
        for x in ps:
            at = name.find(x, at)
            if at < 0:
                return False
            at += len(x)
        return bool(ps)

    got = {(r.qid, r.name) for r in search.pattern_hits(p, n).collect()}
    assert got == {(str(i), x) for i, ps in enumerate(parts) for x in names if holds(x, ps)}


@pytest.mark.parametrize(
    "headers, rows, want",
    [
        (["SCH", "20_용접공 (인)", "20_특별인부"], [["1", "2", "3"]], (True, "D2")), (["SCH", "20_용접공", "x"], [["1", "2", "3"]], (False, "D2")), (["SCH", "20", "30", "40"], [["직종", "용접공", "", ""]], (True, "D1")),
        (["SCH", "20", "30", "40"], [["x", "", "", ""], ["y", "1.5", "", ""], ["z", "", "2", ""]], (True, "D1")), (["SCH", "20", "30", "40"], [["x", "", "", ""], ["y", "1.5", "", ""]], (False, "D1")), (["a", "b"], [["1", "2"]], (False, "D1")), (["SCH", "20", "30", "40"], [], (False, "D1")),
    ],
)
def test_matrices(spark, headers, rows, want):
    t = (headers, [{h: (v, None) for h, v in zip(headers, r)} for r in rows])
    d = spark.createDataFrame([(t,)], "t struct<headers:array<string>,rows:array<map<string,struct<s:string,n:double>>>>")
    assert tuple(d.select(extract.is_matrix_table(F.col("t")), extract.matrix_kind(F.col("t"))).first()) == want


def test_simple_tables_and_pages(spark):
    html = "<table><tr><th>a</th><th>b <b>c</b></th></tr><tr><td colspan=2>note</td></tr><tr><td>1</td><td> 2 </td></tr></table>"
    r = spark.createDataFrame([(html,), (None,)], "h string").select(tables.simple_table(F.col("h")).alias("t")).collect()
    assert r[0].t.headers == ["a", "b c"] and r[0].t.rows == [["1", "2"]]
    p = stores.offset_pages(spark.range(25).repartition(3), ["id"], 10)
    assert sorted((r.id, r.page_no) for r in p.collect()) == [(i, i // 10) for i in range(25)] and stores.offset_pages(p.drop("page_no").limit(0), ["id"], 10).count() == 0
