"""Physical-plan invariants of the registered queries (scale design)."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(q for q in E.queries()
                                        if not q.startswith("op") and q != "pipeline"))
def test_no_cross_products_and_no_python(spark, capsys, name):
    text = plan_text(E.queries()[name](spark, SF), capsys)
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad}"


def test_flagship_broadcasts_the_map_and_keeps_jobs_unshuffled(spark, capsys):
    text = plan_text(E.entry(spark), capsys)
    assert "BroadcastHashJoin LeftOuter BuildRight" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_scope_database_prunes_partitions(spark, capsys):
    text = plan_text(E.queries()["flt11_scope_database"](spark, SF), capsys)
    assert "PartitionFilters: [isnotnull(db" in text and "(db" in text and "= db7)" in text


def test_artifact_tree_without_content_never_reads_bodies(spark, capsys):
    from rehome.sources.readers import read_artifact_tree
    text = plan_text(read_artifact_tree(spark, SF, ext=".parquet", with_content=False), capsys)
    assert "content" not in text.split("ReadSchema:")[1].split("\n")[0]
