"""Types in other spellings and unknown types: no row is left out, no id comes twice."""

import os

import pytest

import __spark_entry__ as entry
from lodegraph.operators import normalise as N
from lodegraph.plans import pipeline

DATA = os.environ.get("LODEGRAPH_TEST_DATA", "/root/testdata/sf0.001")


def test_unknown_types_share_one_sequence(spark):
    n = spark.createDataFrame([("Labor", "a"), ("Foo", "a"), ("Bar", "b"), (None, "c"), ("Labor", "b")], "type string, name string")
    assert sorted(r.id for r in N.assign_ids(n, ["name"]).collect()) == ["L-0001", "L-0002", "X-0001", "X-0002", "X-0003"]


def test_graph_keeps_other_spellings(spark):
    e = spark.createDataFrame([("work_type", "paving", 0.9), ("WorkType", "paving", 0.8), (" Labor", "mason", 0.9)], "type string, name string, confidence double")
    r = spark.createDataFrame([("WORKTYPE", "paving", "labor.", "mason", "REQUIRES_LABOR", 1.0, "m", 0.9)], "source_type string, source string, target_type string, target string, type string, quantity double, unit string, confidence double")
    nodes, edges = pipeline.build_graph(e, r)
    assert sorted((n.type, n.mentions) for n in nodes.collect()) == [("Labor", 1), ("WorkType", 2)]
    assert edges.count() == 1


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_every_row_is_counted(spark):
    e = spark.read.parquet(f"{DATA}/entities.parquet")
    got = entry.queries()["h48_methods_all"](spark, DATA).collect()
    assert sum(r.llm + r.merged + r.table_rule for r in got) == e.filter("source_method in ('llm', 'merged', 'table_rule')").count()
    ids = entry.queries()["g11_assign_ids_all"](spark, DATA).select("id", "row_id").collect()
    assert len({r.id for r in ids}) == len(ids)
