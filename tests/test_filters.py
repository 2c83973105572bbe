import re

import pytest

from rehome.operators import filters as FL
from rehome.schemas import USERS


def test_split_automated_matches_python_re(spark):
    names = ["job-1-run-2", "job-12-run-3x", "xjob-1-run-2", "mlflow-model-a", "a-mlflow-model-",
             "job--run-1", "my cluster", None]
    df = spark.createDataFrame([(n,) for n in names], "cluster_name string")
    kept, skipped = FL.split_automated(df)
    rx = re.compile(r"job-[0-9]+-run-[0-9]+$")
    want = {n for n in names if n is not None and (rx.match(n) or n.startswith("mlflow-model-"))}
    assert {r[0] for r in skipped.collect()} == want
    assert kept.count() + skipped.count() == len(names)


def test_drop_builtin_admin_keeps_missing_name(spark):
    rows = [("1", "admin", None, None, None, None, None, {"givenName": "Administrator", "familyName": None}, None),
            ("2", "admin", None, None, None, None, None, None, None),
            ("3", "admin", None, None, None, None, None, {"givenName": "Other", "familyName": None}, None),
            ("4", "bob", None, None, None, None, None, {"givenName": "Administrator", "familyName": None}, None)]
    df = spark.createDataFrame(rows, USERS)
    assert sorted(r.id for r in FL.drop_builtin_admin(df).collect()) == ["2", "3", "4"]


def test_filter_item_type_rejects_unknown(spark):
    df = spark.createDataFrame([("/a", 1, "NOTEBOOK")], "path string, object_id long, object_type string")
    with pytest.raises(ValueError):
        FL.filter_item_type(df, "FILE")
    assert FL.filter_item_type(df, "NOTEBOOK").count() == 1


def test_keep_known_and_drop_fields(spark):
    df = spark.createDataFrame([(1, "a", {"x": 1, "y": 2})], "a int, b string, s struct<x:int,y:int>")
    assert FL.keep_known_fields(df, ["a", "zz"]).columns == ["a"]
    out = FL.drop_fields(df, "b", "s.y", "nope")
    assert out.columns == ["a", "s"] and out.first().s.asDict() == {"x": 1}


def test_mounts_running_files_scope(spark):
    m = spark.createDataFrame([("/mnt/a", "s3a://b", "")], "mountPoint string, source string, encryptionType string")
    assert FL.project_mounts(m).columns == ["path", "source", "encryptionType"]
    c = spark.createDataFrame([("RUNNING",), ("TERMINATED",), (None,)], "state string")
    assert FL.running(c).count() == 1
    f = spark.createDataFrame([("a", False), ("b", True), ("c", None)], "path string, is_dir boolean")
    assert [r.path for r in FL.files_only(f).collect()] == ["a"]
    d = spark.createDataFrame([("db1", "t"), ("db2", "t")], "db string, t string")
    assert FL.scope_database(d, "db1").count() == 1
