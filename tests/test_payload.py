import base64
import json

from pyspark.sql import functions as F

from rehome.functions import payload as PL
from rehome.functions.defaults import default_cluster

DDL = ("CREATE TABLE `sales`.`orders` (`id` INT, `name` STRING, `price` DECIMAL(10,2), "
       "`tags` STRUCT<`a`: INT, `b`: STRING>, `amount` DOUBLE)\nUSING CSV\nOPTIONS (\n"
       "  `header` 'true',\n  path '/mnt/data/orders'\n)")


def test_upsert_tag_null_existing_and_duplicate(spark):
    df = spark.createDataFrame([(None,), ({"a": "1"},), ({"OriginalCreator": "old", "b": "2"},)],
                               "m map<string,string>")
    got = [r[0] for r in df.select(PL.upsert_tag("m", "OriginalCreator", "me")).collect()]
    assert got == [{"OriginalCreator": "me"}, {"a": "1", "OriginalCreator": "me"},
                   {"b": "2", "OriginalCreator": "me"}]


def test_base64_roundtrip_no_wrapping(spark):
    text = "x" * 500 + "é"
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(PL.encode_b64(F.encode("t", "UTF-8")).alias("b")).first()
    assert r.b == base64.b64encode(text.encode()).decode()
    back = spark.createDataFrame([(r.b,)], "b string").select(PL.decode_b64("b")).first()[0]
    assert back == text


def test_parse_name_list(spark):
    df = spark.createDataFrame([("['a', 'b c']",), ("[]",), ("['x']",)], "s string")
    assert [r[0] for r in df.select(PL.parse_name_list("s")).collect()] == [["a", "b c"], [], ["x"]]


def test_versions(spark):
    df = spark.createDataFrame([("10.4.x-scala2.12",), ("7.3.x-scala2.12",), ("6.5.x",), ("x",)], "v string")
    rows = df.select(PL.major_version("v"), PL.major_version_at_least("v", 7)).collect()
    assert [tuple(r) for r in rows] == [(10, True), (7, True), (6, False), (None, False)]


def test_routes_and_ddl_facts(spark):
    df = spark.createDataFrame([(DDL,), ("",), (None,), ("é" * 600,), ("a" * 2049,)], "d string")
    rows = df.select(PL.route_export("d"), PL.route_import("d")).collect()
    assert [tuple(r) for r in rows] == [("inline", "inline"), ("error", "error"), ("error", "error"),
                                        ("inline", "upload"), ("file", "upload")]
    f = spark.createDataFrame([(DDL,)], "d string").select(
        PL.ddl_provider("d"), PL.ddl_location("d"), PL.ddl_n_columns("d")).first()
    assert tuple(f) == ("CSV", "/mnt/data/orders", 5)


def test_qualified_names(spark):
    df = spark.createDataFrame([("db.t",), ("db.t.x",), ("nodot",), (None,)], "t string")
    rows = df.select(*PL.split_qualified("t"), PL.qualified_ok("t")).collect()
    assert [tuple(r) for r in rows] == [("db", "t", True), ("db", "t", False), ("nodot", "", False),
                                        (None, None, False)]


def test_patch_documents(spark):
    df = spark.createDataFrame([(["r1", "r2"],)], "a array<string>")
    roles = json.loads(df.select(PL.add_roles_doc("a")).first()[0])
    assert roles == {"schemas": [PL.PATCH_OP_SCHEMA],
                     "Operations": [{"op": "add", "path": "roles",
                                     "value": [{"value": "r1"}, {"value": "r2"}]}]}
    members = json.loads(df.select(PL.add_members_doc("a")).first()[0])
    assert members["Operations"][0]["value"] == {"members": [{"value": "r1"}, {"value": "r2"}]}


def test_member_kind_refs_and_nulls(spark):
    df = spark.createDataFrame([("https://h/api/scim/v2/Users/1",), ("scim/v2/Groups/2",), (None,)], "r string")
    assert [r[0] for r in df.select(PL.member_kind("r")).collect()] == ["user", "group", None]
    df = spark.createDataFrame([(["a", None, "", "b"],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(PL.drop_null_elements("a")).collect()] == [["a", "b"], None]
    refs = spark.createDataFrame([("notebooks", 7)], "k string, i long").select(
        PL.object_ref("k", "i").alias("r")).select("r", PL.permissions_path("r"), PL.ref_kind("r"),
                                                    PL.ref_id("r")).first()
    assert tuple(refs) == ("/notebooks/7", "/permissions/notebooks/7", "notebooks", "7")


def test_default_cluster(spark):
    import pytest
    r = spark.range(1).select(F.to_json(default_cluster("aws")).alias("j")).first().j
    assert json.loads(r)["num_workers"] == 8 and json.loads(r)["enable_elastic_disk"] is False
    az = json.loads(spark.range(1).select(F.to_json(default_cluster("azure"))).first()[0])
    assert "enable_elastic_disk" not in az and az["node_type_id"] == "Standard_DS3_v2"
    with pytest.raises(ValueError):
        default_cluster("gcp")
