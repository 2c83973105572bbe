from pyspark.sql.types import LongType, StringType, StructField, StructType

from rehome.streaming import ingest_logs, latest_snapshot

SCHEMA = StructType([StructField("id", LongType()), StructField("v", StringType())])


def test_incremental_ingest_is_exactly_once(spark, tmp_path):
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "t"), str(tmp_path / "ckpt")
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "run1.log").write_text('{"id": 1, "v": "a"}\n{"id": 2, "v": "b"}\n\n')
    ingest_logs(spark, landing, SCHEMA, table, checkpoint=ckpt)
    (tmp_path / "landing" / "run2.log").write_text('{"id": 1, "v": "a2"}\n{"id": 3, "v"\n')
    ingest_logs(spark, landing, SCHEMA, table, checkpoint=ckpt)
    ingest_logs(spark, landing, SCHEMA, table, checkpoint=ckpt)  # nothing new: no duplicates
    snap = {r.id: r.v for r in latest_snapshot(spark, table, "id").collect()}
    assert snap == {1: "a2", 2: "b"}
    assert spark.read.parquet(table + "/good").count() == 3
    assert spark.read.parquet(table + "/bad").count() == 1
