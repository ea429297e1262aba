"""Canonical forms, splitting, markup, cut detection and records, against brute force and hand-made cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodegraph.llm import canonical, markup, records, split, truncation


@pytest.mark.parametrize(
    "value, want",
    [("ｋＷ", "kW"), ("가", "가"), ("k‌g", "kg"), ("㎡", "m²"), ("㎥", "m³"), ("㎜2", "mm2"), ("Ⅱ", "II"), ("ﬁn", "fin"), ("a b", "a b"), ("지게차‑3", "지게차-3"), ("Ζ1", "Z1"), ("metrе", "metre"), ("é", "é")]
    + [(x, x) for x in ("² ³ ° × · φ α", "façade", "a\tb\nc", "①", "ㄱ", "", "abc")],
)
def test_visual(value, want):
    assert canonical.visual(value) == want


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_visual_is_idempotent(s):
    once = canonical.visual(s)
    assert canonical.visual(once) == once and canonical.key(once) == canonical.key(s)


def test_odd_values(spark):
    rows = [(1, "ａ", None), (2, "a", "b​"), (3, None, None), (4, "", "x" * 50_000 + "ｚ"), (2, "a", "b​")]
    d = spark.createDataFrame(rows, "id long, name string, unit string").withColumn("field", F.lit("clash"))
    got = sorted(tuple(r) for r in canonical.odd_values(d, "id", ["name", "unit"]).collect())
    assert got == [(1, "name"), (2, "unit"), (4, "unit")]
    assert canonical.odd_values(d.limit(0), "id", ["name"]).count() == 0
    with pytest.raises(ValueError):
        canonical.with_visual(d.withColumn("name_visual", F.lit(1)), ["name"])


def _pieces(spark, text, **kw):
    d = spark.createDataFrame([("c", "s", text)], "chunk_id string, section_id string, text string")
    return sorted(split.split_pieces(d, **kw).collect(), key=lambda r: r.piece_no)


@pytest.mark.parametrize("text", ["x" * 9001, "가나다. " * 3000, ("문단 하나.\n\n" + "a" * 500) * 30, "한 줄\n" * 4000, "é" * 4500, " \n" * 5000, "\U0001f600" * 4100])
def test_pieces(spark, text):
    got = _pieces(spark, text)
    assert len(got) > 1 and all(r.piece_size <= 2000 and r.section_id == "s" for r in got)
    whole = got[0].piece
    for a, b in zip(got, got[1:]):
        assert b.piece[:200] == a.piece[-200:]
        whole += b.piece[200:]
    assert whole == text and [r.piece_no for r in got] == list(range(1, len(got) + 1))


def test_pieces_prefer_strong_boundaries(spark):
    text = ("가" * 1500 + ". ") * 2 + "나" * 500 + "\n\n" + "다. " * 2000
    assert _pieces(spark, text)[0].piece.endswith("\n\n")


def test_pieces_of_small_texts(spark):
    assert [(r.piece, r.n_pieces) for r in _pieces(spark, "")] == [("", 1)]
    assert _pieces(spark, None) == [] and len(_pieces(spark, "a" * 4000)) == 1 and len(_pieces(spark, "a" * 4001)) == 2
    with pytest.raises(ValueError):
        split.split_pieces(spark.createDataFrame([("a", 1)], "text string, piece int"))


def test_labeller_on_held_out_documents():
    model, f, r = markup.labeller(), markup.Features(), random.Random(4242)
    docs = [markup.write_document(r) for _ in range(300)]
    y = np.concatenate([np.array(d[1]) for d in docs])
    p = np.concatenate(markup.classify(model, f, [d[0] for d in docs]))
    assert ((p > 0) == (y > 0)).mean() > 0.995 and (p == y).mean() > 0.985


def test_labeller_reads_the_document_around_a_block():
    model, f = markup.labeller(), markup.Features()
    code = ["토공 일반이다.", "```", "qty = 17 * 3", "```", "폭은 3*4 = 12 이다."]
    title = ["앞 문단이다.", "토공 일반", "==========", "뒤 문단이다."]
    a, b, c = markup.classify(model, f, [code, title, ["qty = 17 * 3", "토공 일반"]])
    assert a.tolist() == [0, markup.CODE, markup.CODE, markup.CODE, 0] and b.tolist() == [0, markup.HEADING, markup.HEADING, 0] and c.tolist() == [0, 0]
    assert markup.clean_lines(title, b) == ("앞 문단이다.\n# 토공 일반\n뒤 문단이다.", 2)


PLAIN = ["- 개스킷 19개", "· 암면 3kg", "(1) a", "① b", "[주]", "※ 표 3* 비고", "두께 t < 6mm 이고 h > 3m", "3*4 = 12", "#2 펌프와 #3 펌프", "KX_04_B", "R&D", "12 | 16 | 20", "단가는 $ 표기 없이", "5 ^ 2", "1:1.5 ~ 1:2.0", "* 별도", "<참고>", "a < b"]
MARKED = ["## 제목", "**굵게**", "`코드`", "~~삭제~~", "'''굵게'''", "== 제목 ==", "==========", "> 인용", "[[4-2|절]]", "{{각주|4}}", "[표](#a)", "![단면](x.png)", "<b>x</b>", "<span style='color:red'>삭제", "x</td>", "<!-- PAGE 3 | a -->", "a&nbsp;b", "&lt;참고&gt;", "끝.&#13;", "5\\%", "\\textbf{x}", "$\\phi 50$", "\\(Q = A v\\)", "| a | b |", "{|", "|}", "$$", "&amp;nbsp;", "끝&nbsp"]


@pytest.mark.parametrize("t", PLAIN)
def test_plain_signs_are_no_markup(t):
    assert not markup.signs(t) and markup.classify(markup.labeller(), markup.Features(), [[t], ["앞 문장이다.", t, "뒤 문장이다."]])[1].tolist() == [0, 0, 0]


@pytest.mark.parametrize("t", MARKED)
def test_markup(t):
    y = markup.classify(markup.labeller(), markup.Features(), [[t], ["앞 문장이다.", t, "뒤 문장이다."]])
    assert markup.signs(t) and y[0][0] > 0 and y[1][1] > 0


def test_rendering():
    r = markup.render_block
    assert r("<h3>토공 일반</h3>", markup.HEADING) == "### 토공 일반" and r("== 방수 ==", markup.HEADING) == "## 방수" and r("\\section{포장}", markup.HEADING) == "## 포장"
    assert r("<ul><li>a 1<li>b</ul>", markup.LIST) == "- a 1\n- b" and r("\\item 백관", markup.LIST) == "- 백관"
    assert r("<table><tr><td>a</td><td>b</td></tr></table>", markup.TABLE) == "a | b" and r("| a || 1", markup.TABLE) == "a | 1"
    assert r("<pre><code>x(1)</code></pre>", markup.CODE) == "```\nx(1)\n```"
    assert r("폭 \\(Q = A v\\) **참고** [표](#a)&nbsp;끝", markup.INLINE) == "폭 $Q = A v$ 참고 표 끝"
    assert r("(m<sup>3</sup> 기준)", markup.INLINE) == "(m³ 기준)" and r("<!-- PAGE 1 | a -->", markup.NOISE) is None and r("5\\%", markup.INLINE) == "5%"


def test_clean_chunks(spark):
    t = "array<struct<table_id:string,headers:array<string>,rows:array<map<string,struct<s:string,n:double>>>,notes_in_table:array<string>>>"
    rows = [("a", "## 제목\n본문 <b>굵게</b>\n3*4 = 12", [("t", ["<b>구분</b>", "구분"], [{"<b>구분</b>": ("x<br>", None), "구분": ("y", 1.0)}], ["**주**"])]), ("b", None, None), ("c", "", []), ("d", "그대로 #2\n- 항목", None)]
    d = spark.createDataFrame(rows, f"chunk_id string, text string, tables {t}").withColumn("clean_text", F.lit(1))
    got = {r.chunk_id: r for r in markup.clean_chunks(d).collect()}
    assert got["a"].text == "## 제목\n본문 굵게\n3*4 = 12" and got["a"].text_blocks == 2 and got["a"].table_blocks == 3
    assert got["a"].tables[0].headers == ["구분", "구분"] and sorted((e.header, e.s) for e in got["a"].tables[0].rows[0]) == [("구분", "x"), ("구분", "y")]
    assert got["b"].text is None and got["b"].tables is None and got["c"].text == "" and got["d"].text == "그대로 #2\n- 항목" and got["d"].text_blocks == 0
    assert markup.clean_chunks(d.limit(0)).count() == 0


@pytest.mark.parametrize("text, why", [("앞 문장이다. 현장에서는", None), ("a…", "mark"), ("a...", "mark"), ("x�", "multibyte"), ("<table><tr><td>a", "markup"), ("<table><tr><td>a</t", "tag"), ("끝 &nb", "escape"), ("비고 (첫째", "bracket"), ("그는 “말", "quote"), ("```\ncode", "markup"), ("끝났다.", None), ("<p>열린 문단", None), ("(닫음)", None), ("첫째 (빠짐\n\n다음 문단이다.", None)])
def test_stack_automaton(text, why):
    assert truncation.broken(text) == why


def test_cut_texts(spark):
    close = "세부 사항은 감독자와 협의함"
    rows = [(i, f"문장 {i}이다.\n- 흑관 {i}kg\n- 백관 {i}개\n\n{close}", "a") for i in range(30)]
    rows += [(100, "문장이다. 현장에서는", "a"), (101, "문장이다. 끝났다.", "b"), (102, "문장이다.\n- 흑관 3", "a"), (103, "문장이다.\n- 흑관 3kg", "b"), (104, None, "a"), (105, "  \n", "b"), (106, "", None), (107, "기준보다 26.", "b"), (108, "x" * 200_000, "b"), (100, "문장이다. 현장에서는", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("reason", F.lit("clash"))
    got = {r.doc_id: r.is_cut for r in truncation.cut_texts(d).collect()}
    assert {k for k, v in got.items() if v} == {100, 102, 107, 108} and len(got) == 39
    assert truncation.cut_texts(d.limit(0)).count() == 0


@pytest.mark.parametrize("a, b, same", [("W=10; H=20", "(h: 20 | w:10)", True), ("T=-9°C", "T=9°C", False), ("d=2.5", "d=25", False), ("W=1;H=2", "W=2;H=1", False), (None, " - ", True), ("SCH40, L=8m", "l = 8m\nsch40", True), ("W=10 H=20", "W=10;H=20", True), ("a=1,000", "a=1000", True), ("", None, True), ("K-M1", "KM1", True)])
def test_list_keys(spark, a, b, same):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(records.list_key(F.col("a")).alias("a"), records.list_key(F.col("b")).alias("b")).first()
    assert (r.a == r.b) is same


def test_copies(spark):
    rows = [(5, "Material", "흑관-7", "W=1"), (3, " material.", "흑 관 7", "(w: 1)"), (9, "MATERIAL", "<흑관７>", "W = 1 "), (1, "Material", "흑관 8", "W=1"), (7, None, None, None), (8, None, "", "-"), (5, "Material", "흑관-7", "W=1"), (2, "Material", "no. 2.5", None), (4, "Material", "no 25", None)]
    d = spark.createDataFrame(rows, "id long, type string, name string, spec string").withColumn("rec", F.lit(0)).withColumn("canon", F.lit(0))
    got = sorted(tuple(r) for r in records.copies(d, "id", ["type", "name", "spec"], ["spec"]).collect())
    assert got == [(3, 5), (3, 9), (7, 8)]
    hot = spark.range(3000).select("id", F.lit("t").alias("type"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("name"))
    assert records.copies(hot, "id", ["type", "name"]).count() == 1999
    assert records.copies(d.limit(0), "id", ["type", "name", "spec"], ["spec"]).count() == 0


@pytest.mark.parametrize("a, b", [("STRASSE", "STRAẞE"), ("ß", "ẞ"), ("Straße", "STRASSE"), ("ΟΣ", "ος"), ("ﬁn", "FIN"), ("  K W ", "ｋ\tｗ"), ("É", "é")])
def test_keys_fold_case_fully(spark, a, b):
    d = canonical.with_folded(spark.createDataFrame([(a, b, None, "")], "a string, b string, c string, d string"), ["a", "b", "c", "d"])
    r = d.select(*[canonical.key_of(F.col(f"{x}_folded")).alias(x) for x in "abcd"]).first()
    assert r.a == r.b == canonical.key(a) == canonical.key(b) and r.c is None and r.d == ""
    rows = spark.createDataFrame([(1, a), (2, b)], "id long, name string")
    assert [tuple(x) for x in records.copies(rows, "id", ["name"]).collect()] == [(1, 2)]


@pytest.mark.parametrize("t, want", [("бетон", "бетон"), ("МОР", "MOP"), ("бе​тон", "бетон"), ("metrе", "metre"), ("φО50", "φO50"), ("бетон metrе", "бетон metre")])
def test_words_in_their_own_script_stay(t, want):
    assert canonical.visual(t) == want
