import json

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from rehome.functions.payload import from_doc, to_doc
from rehome.operators.filters import keep_known_json


def test_to_doc_omits_nulls_keeps_empty_arrays_and_round_trips(spark):
    df = spark.createDataFrame([(1, None, []), (2, "x", ["a"])], "id long, s string, a array<string>")
    docs = [r[0] for r in df.select(to_doc(F.col("id"), F.col("s"), F.col("a"))).collect()]
    assert [json.loads(d) for d in docs] == [{"id": 1, "a": []}, {"id": 2, "s": "x", "a": ["a"]}]
    sch = StructType([StructField("id", LongType()), StructField("s", StringType()),
                      StructField("a", ArrayType(StringType()))])
    back = df.select(from_doc(to_doc(F.col("id"), F.col("s"), F.col("a")), sch).alias("d")).select("d.*")
    assert sorted(tuple(r) for r in back.collect()) == [(1, None, []), (2, "x", ["a"])]


def test_keep_known_json_drops_unknown_and_absent_keys(spark):
    sch = StructType([StructField("cluster_name", StringType()), StructField("num_workers", LongType()),
                      StructField("state", StringType())])
    df = spark.createDataFrame([('{"cluster_name": "a", "num_workers": 2, "state": "RUNNING", "x": 1}',),
                                ('{"cluster_name": "b"}',), ("broken",)], "doc string")
    got = [r[0] for r in df.select(keep_known_json("doc", sch, ["cluster_name", "num_workers"])).collect()]
    assert got == ['{"cluster_name":"a","num_workers":2}', '{"cluster_name":"b"}', "{}"]


def test_plan_home_scopes_to_one_user_and_prunes_trash(spark):
    from rehome.plans.workspace import plan_home
    items = spark.createDataFrame(
        [("/Users/a", 1, "DIRECTORY"), ("/Users/a/nb", 2, "NOTEBOOK"), ("/Users/a/Trash", 3, "DIRECTORY"),
         ("/Users/a/Trash/old", 4, "NOTEBOOK"), ("/Users/a/p", 5, "DIRECTORY"), ("/Users/a/p/n2", 6, "NOTEBOOK"),
         ("/Users/ab/nb", 7, "NOTEBOOK"), ("/Users/b/nb", 8, "NOTEBOOK")],
        "path string, object_id long, object_type string")
    target = spark.createDataFrame([("/Users/a", 1, "DIRECTORY")], "path string, object_id long, object_type string")
    plan, gate = plan_home(items, target, " a ")
    assert gate.first().status == "OK"
    assert {(r.path, r.action) for r in plan.collect()} == {
        ("/Users/a/nb", "upload"), ("/Users/a/p", "mkdir"), ("/Users/a/p/n2", "upload")}
