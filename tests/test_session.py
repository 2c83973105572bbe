from rehome.session import bounded_broadcast, fits, fits_many, scratch_path, side


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_bounds_and_sides(spark, capsys):
    small, big = spark.range(10), spark.range(1000)
    assert fits(small, 10) and not fits(big, 999)
    assert fits_many({"s": small, "b": big, "e": spark.range(0)}, 100) == {"s": True, "b": False, "e": True}
    probe = spark.range(5000).withColumnRenamed("id", "k")
    j_small = probe.join(side(small.withColumnRenamed("id", "k"), True), "k")
    j_none = probe.join(side(big.withColumnRenamed("id", "k"), False), "k")
    assert "BroadcastHashJoin" in _plan(j_small, capsys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(j_none, capsys)
        checked = probe.join(bounded_broadcast(big.withColumnRenamed("id", "k"), 999), "k")
        assert "BroadcastHashJoin" not in _plan(checked, capsys)
        ok = probe.join(bounded_broadcast(big.withColumnRenamed("id", "k"), 1000), "k")
        assert "BroadcastHashJoin" in _plan(ok, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scratch_paths_are_fresh_and_below_checkpoint_root(spark):
    from rehome.session import checkpoint_root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark))


def test_keyed_write_without_aqe_does_not_repartition(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    from rehome.sources.sinks import _rebalanced
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in _plan(_rebalanced(df, ["k"]), capsys)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange" in _plan(_rebalanced(df, ["k"]), capsys)
