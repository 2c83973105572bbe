from pyspark.sql import functions as F

from rehome.operators import mapping as MP
from rehome.schemas import JOBS


def test_last_wins_and_first_match(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w"), (None, 5, "n")],
                               "k string, ord int, v string")
    last = {r.k: r.v for r in MP.last_wins(df, "k", "ord").collect()}
    first = {r.k: r.v for r in MP.first_match(df, "k", "ord").collect()}
    assert last == {"a": "y", "b": "w", None: "n"}
    assert first == {"a": "x", "b": "w", None: "n"}
    amb = MP.ambiguous_keys(df, "k").collect()
    assert [(r.k, r.n) for r in amb] == [("a", 3)]


def test_id_map_dedupes_and_drops_null_names(spark):
    src = spark.createDataFrame([("c1", "old1", 1), ("c1", "old1b", 2), ("c2", "old2", 3), (None, "oldn", 4)],
                                "name string, id string, ord int")
    tgt = spark.createDataFrame([("c1", "new1", 1), ("c3", "new3", 2), (None, "newn", 3)],
                                "name string, id string, ord int")
    m = MP.id_map(src, tgt, "name", "id", "ord").collect()
    assert [(r.name, r.old_id, r.new_id) for r in m] == [("c1", "old1b", "new1")]


def _jobs(spark, rows):
    return spark.createDataFrame(
        [(jid, None, None, {"name": f"j{jid}", "existing_cluster_id": cid}) for jid, cid in rows], JOBS)


def test_remap_clusters_three_outcomes(spark):
    jobs = _jobs(spark, [(1, "old1"), (2, "gone"), (3, None)])
    cmap = spark.createDataFrame([("c", "old1", "new1")], "name string, old_id string, new_id string")
    out = {r.job_id: r for r in MP.remap_clusters(jobs, cmap, broadcast_rows=10).collect()}
    assert out[1].outcome == "rewired" and out[1].settings.existing_cluster_id == "new1"
    assert out[2].outcome == "reset_default" and out[2].settings.existing_cluster_id is None
    assert out[2].settings.new_cluster.num_workers == 8
    assert out[3].outcome == "new_cluster" and out[3].settings.new_cluster is None
    # the map side above the bound is not broadcast but gives the same answer
    big = {r.job_id: r.outcome for r in MP.remap_clusters(jobs, cmap, broadcast_rows=0).collect()}
    assert big == {k: v.outcome for k, v in out.items()}


def test_skip_existing_splits_all_rows(spark):
    cand = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "name string")
    tgt = spark.createDataFrame([("a",), (None,)], "name string")
    create, skipped, invalid = MP.skip_existing(cand, tgt, "name")
    assert sorted(r.name for r in create.collect()) == ["b"]
    assert sorted(r.name for r in skipped.collect()) == ["a", "a"]
    assert invalid.count() == 1
    assert create.count() + skipped.count() + invalid.count() == cand.count()


def test_null_unregistered_profile(spark):
    cl = spark.createDataFrame([("1", {"zone_id": "z", "instance_profile_arn": "arn:a"}),
                                ("2", {"zone_id": "z", "instance_profile_arn": "arn:b"}),
                                ("3", {"zone_id": "z", "instance_profile_arn": None}), ("4", None)],
                               "cluster_id string, aws_attributes struct<zone_id:string,instance_profile_arn:string>")
    prof = spark.createDataFrame([("arn:a",), ("",), (None,)], "instance_profile_arn string")
    out = {r.cluster_id: r for r in MP.null_unregistered_profile(cl, prof).collect()}
    assert out["1"].aws_attributes.instance_profile_arn == "arn:a"
    assert out["2"].aws_attributes.instance_profile_arn is None and out["2"].aws_attributes.zone_id == "z"
    assert out["2"].profile_dropped and not out["3"].profile_dropped and out["4"].aws_attributes is None
    none = MP.null_unregistered_profile(cl, prof.where("false"))
    assert none.where(F.col("aws_attributes.instance_profile_arn").isNotNull()).count() == 0


def test_remap_pools_unresolved(spark):
    cl = spark.createDataFrame([("1", "p1"), ("2", "p2"), ("3", None)], "cluster_id string, instance_pool_id string")
    pm = spark.createDataFrame([("n1", "p1", "q1")], "name string, old_id string, new_id string")
    out = {r.cluster_id: (r.new_pool_id, r.pool_status) for r in MP.remap_pools(cl, pm).collect()}
    assert out == {"1": ("q1", "mapped"), "2": (None, "unresolved"), "3": (None, "none")}
