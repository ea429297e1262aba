"""Unit strings, conversion and the orphan cascade, against small hand-made cases."""

import datetime as dt

import pytest

from lodegraph.operators import orphans, units


@pytest.mark.parametrize(
    "text, want",
    [
        ("m", ("length", 1.0)), ("MM", ("length", 1e-3)), ("㎜2", ("area", 1e-6)), ("sq.m", ("area", 1.0)), ("제곱미터", ("area", 1.0)), ("cu.m", ("volume", 1.0)), ("d㎥", ("volume", 1e-3)),
        ("×100 m³", ("volume", 100.0)), ("1,000kg", ("mass", 1000.0)), ("천개", ("count", 1000.0)), ("다스", ("count", 12.0)), ("min", ("time", 1 / 60)), ("인", ("labour", 1.0)), ("인치", ("length", 0.0254)),
        ("k‌g", ("mass", 1.0)), ("metrе", ("length", 1.0)), ("MW", ("power", 1000.0)), ("식", None), ("%", None), ("kg/m", None), ("", None), ("x" * 500, None),
    ],
)
def test_parse_unit(text, want):
    got = units.parse_unit(text)
    assert (got is None) == (want is None)
    if want:
        assert got[0] == want[0] and got[1] == pytest.approx(want[1])


@pytest.mark.parametrize("text, size", [("m당", 1), ("per 100 m", 100), ("/1 m", 1), ("매 10m", 10), ("(50 m당)", 50), ("기준: 1m당", 1)])
def test_parse_basis(text, size):
    assert units.parse_unit(text, "per_unit", True) == ("length", size)


def test_unit_in_text_takes_the_row_s_own_number():
    assert units.unit_in_text("수량: 7.138 metre", 7.138) == "metre"
    assert units.unit_in_text("3.092 (10인) / 1회", 3.092) == "10인"
    assert units.unit_in_text("2 kg, 5 m", 5.0) == "m"
    assert units.unit_in_text("note 3", 3.0) is None


def _rel(spark, rows):
    return spark.createDataFrame(rows, "rel_id long, quantity double, unit string, per_unit string, properties map<string,string>, x string")


def test_to_common(spark):
    common = spark.createDataFrame([("length", "m"), ("mass", "kg"), ("labour", "인"), ("area", "m²")], "dimension string, common_unit string")
    r = _rel(spark, [(1, 2.0, "인", "100 m당", None, "a"), (2, 3.0, "g", None, {"b": "(/10 m²)"}, "b"), (3, None, "km", "m", None, None), (4, 1.0, None, None, {}, None), (5, 5.0, "식", "kg", None, None), (5, 5.0, "식", "kg", None, None)])
    got = {x.row_id: x for x in units.to_common(r, common, "rel_id", basis="per_unit").collect()}
    assert got[1].common_quantity == pytest.approx(0.02) and got[1].common_basis == "m"
    assert got[2].common_quantity == pytest.approx(0.0003) and got[2].common_unit == "kg"
    assert 3 not in got and got[4].common_unit is None and got[5].common_unit is None
    assert {x.row_id for x in units.off_common(units.to_common(r, common, "rel_id", basis="per_unit")).collect()} == {1, 2}
    assert units.to_common(r.limit(0), common, "rel_id", basis="per_unit").count() == 0


def test_direct_orphans(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    g = spark.createDataFrame([("a", True, t(5)), ("a", False, t(1)), ("b", False, t(1)), ("c", None, None)], "ref string, is_active boolean, created_at timestamp_ntz")
    e = spark.createDataFrame([(1, "a", t(6)), (2, "a", t(2)), (3, "b", t(9)), (4, "z", t(9)), (5, "", t(9)), (6, None, t(9)), (7, "c", None), (1, "a", t(6))], "row_id long, source string, created_at timestamp_ntz")
    ends = orphans.reference_ends(e, "row_id", {"source": ["source"]})
    got = {(x.row_id, x.reason) for x in orphans.orphaned_ends(ends, orphans.parent_state(g, "ref"), orphans.hot_refs(ends)).collect()}
    assert got == {(2, "later"), (3, "deleted"), (4, "missing")}
    assert orphans.orphaned_ends(ends.limit(0), orphans.parent_state(g, "ref"), orphans.hot_refs(ends.limit(0))).count() == 0


def test_cascade_ends_in_cycles(spark):
    links = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("x", "y"), ("d", "c"), (None, "a"), ("e", None)], "child string, parent string")
    seed = spark.createDataFrame([("a",)], "ref string")
    assert {(r.ref, r.depth) for r in orphans.inherited_orphans(links, seed).collect()} == {("b", 1), ("c", 2), ("d", 3)}
    assert orphans.inherited_orphans(links.limit(0), seed).count() == 0
