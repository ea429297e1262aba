"""Marked documents all the way to a graph, and the invariants that hold at each stage."""

from pyspark.sql import functions as F

from lodegraph.operators import chunking
from lodegraph.plans import pipeline

TABLE = "<table><tr><th>구분</th><th>규격</th><th>단위</th><th>수량</th></tr><tr><td>보통인부</td><td>A</td><td>인</td><td>0.5</td></tr><tr><td>모르타르</td><td></td><td>m³</td><td>1,200</td></tr><tr><td>발전기</td><td></td><td>대</td><td>0</td></tr><tr><td colspan=4>[주] 별도 계상</td></tr></table>"
DOC = """<!-- SECTION: 1-1-1 | 앵커 천공 | 부문:토목 | 장:일반 -->
1-1-1 앵커 천공('24년 보완)
본문 하나. (m당)
""" + TABLE + """
[주]
① 첫째 주석 ② 둘째 주석

<!-- SECTION: 1-1-2 | 법면 정리 | 부문:토목 | 장:일반 -->
1-1-2 법면 정리
1-1-1 참조. 작업 높이가 높은 경우 품을 20%까지 가산한다.
"""  # fmt: skip


def test_documents_to_graph(spark):
    docs = spark.createDataFrame([("f.md", DOC), ("empty.md", ""), ("null.md", None)], "file string, text string")
    toc = spark.createDataFrame([("1-1-1#2", "1-1-1", "일반"), ("1-1-2", "1-1-2", "일반")], "key string, id string, chapter string")
    got = pipeline.documents_to_graph(docs, toc)
    s = {r.section_id: r for r in got["sections"].collect()}
    assert set(s) == {"1-1-1#2", "1-1-2"} and s["1-1-1#2"].notes == ["첫째 주석", "둘째 주석"]
    assert s["1-1-1#2"].revision_year == "2024" and s["1-1-1#2"].unit_basis == "m당" and "<table" not in s["1-1-1#2"].text
    t = s["1-1-1#2"].tables[0]
    assert t.headers == ["구분", "규격", "단위", "수량"] and t.type == "A" and t.notes_in_table == ["[주] 별도 계상"]
    assert [(r["구분"].s, r["수량"].n) for r in t.rows] == [("보통인부", 0.5), ("모르타르", 1200.0), ("발전기", 0.0)]
    assert [x.target_section_id for x in s["1-1-2"].cross_references] == ["1-1-1"] and s["1-1-2"].conditions[0].rate == "20%"
    c = got["chunks"].orderBy("chunk_id").collect()
    assert [r.chunk_id for r in c] == ["C-0001", "C-0002"]
    nodes, edges = got["nodes"].collect(), got["edges"].collect()
    ids = {r.id for r in nodes}
    assert len(ids) == len(nodes) and {"L-0001", "M-0001", "W-0001", "W-0002"} <= ids
    assert all(e.source_id in ids and e.target_id in ids and e.source_id != e.target_id for e in edges)
    assert {(e.relation, e.quantity) for e in edges} >= {("REQUIRES_LABOR", 0.5), ("USES_MATERIAL", 1200.0)} and not any(e.quantity == 0 for e in edges)


def test_parts_keep_everything(spark):
    row = {"h": ("x" * 50, None)}
    schema = "section_id string, text string, tables array<struct<table_id:string,headers:array<string>,rows:array<map<string,struct<s:string,n:double>>>,notes_in_table:array<string>>>"
    data = [("a", "\n\n".join(f"문단 {i} " + "글" * 40 for i in range(30)), [("t", ["h"], [row] * 20, []), ("u", ["h"], [row] * 2, [])]), ("b", "짧다", []), ("c", None, None), ("d", "", [("t", ["h"], [row] * 9, [])]), ("e", "긴" * 5000, None)]
    d = spark.createDataFrame(data, schema)
    parts = chunking.section_parts(d, 100).collect()
    for key, text, tables in data:
        mine = sorted((p for p in parts if p.section_id == key), key=lambda p: p.part_no)
        assert mine and [p.part_no for p in mine] == list(range(1, len(mine) + 1)) and mine[0].n_parts == len(mine)
        assert "".join((p.text or "") for p in mine).replace("\n", "") == (text or "").replace("\n", "")
        assert sum(len(t.rows) for p in mine for t in (p.tables or [])) == sum(len(t[2]) for t in (tables or []))
    named = chunking.number_chunks(chunking.section_parts(d, 100), ["section_id"]).filter(F.col("section_id") == "d").orderBy("part_no").collect()
    assert len(named) > 1 and named[0].chunk_id.endswith("-A") and named[0].chunk_id.split("-")[1] == named[1].chunk_id.split("-")[1]
