import random

from pyspark.sql import functions as F

from rehome.operators.batches import assign_batches, row_index
from rehome.operators.retry import failure_summary, retry_matrix


def test_row_index_matches_window_with_hot_and_null_keys(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randint(0, 40)}")
        rows.append((k, i))
    df = spark.createDataFrame(rows, "k string, o long")
    got = {(r.k, r.o): r.row_index for r in row_index(df, ["k"], ["o"], num_partitions=7).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        for pos, o in enumerate(sorted(o for kk, o in rows if kk == k)):
            want[(k, o)] = pos
    assert got == want
    b = assign_batches(df, ["k"], ["o"], size=100)
    assert b.where(F.col("k") == "hot").groupBy("batch").count().agg(F.max("count")).first()[0] == 100


def test_retry_matrix_first_success_by_role_order(spark):
    failed = spark.createDataFrame([("d.t1",), ("d.t2",), ("d.t3",), ("bad",), ("a.b.c",)], "table string")
    roles = spark.createDataFrame([("r2", 2), ("r1", 1), ("r3", 3)], "role string, ord int")
    attempts = spark.createDataFrame(
        [("d.t1", "r3", True), ("d.t1", "r2", True), ("d.t1", "r1", False), ("d.t2", "r1", None),
         ("d.t2", "r9", True), ("x.y", "r1", True)], "table string, role string, ok boolean")
    resolved, remaining, invalid = retry_matrix(failed, roles, attempts)
    # brute force: each failed table tried under each role in order, first success wins
    ok = {(t, r) for t, r, o in attempts.collect() if o}
    want = {}
    for (t,) in failed.collect():
        for role, _ in sorted(roles.collect(), key=lambda x: x[1]):
            if (t, role) in ok:
                want[t] = role
                break
    assert {r.table: r.resolved_role for r in resolved.collect()} == want
    assert sorted(r.table for r in remaining.collect()) == ["d.t2", "d.t3"]
    assert sorted(r.table for r in invalid.collect()) == ["a.b.c", "bad"]
    s = failure_summary(spark.createDataFrame([("d",), ("e",)], "db string"), failed, remaining).first()
    assert (s.attempted_databases, s.failed_before, s.failed_after) == (2, 5, 2)
    # no roles at all: every valid failed table remains
    _, rem2, _ = retry_matrix(failed, roles.where("false"), attempts)
    assert rem2.count() == 3


def test_row_index_hot_key_at_volume(spark):
    """300k rows, a third of them in one key: indexes are exactly 0..n-1 per
    key (checked with aggregates, nothing collected), and the hot key is
    spread over several tasks."""
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("k"),
        (F.col("id") * 7919 % n).alias("o"))
    out = row_index(df, ["k"], ["o"], num_partitions=8)
    per_key = out.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min("row_index").alias("lo"),
                                   F.max("row_index").alias("hi"),
                                   F.count_distinct("row_index").alias("d"))
    bad = per_key.where((F.col("lo") != 0) | (F.col("hi") != F.col("c") - 1) | (F.col("d") != F.col("c")))
    assert bad.count() == 0
    assert per_key.where("k = 'hot'").first().c == n // 3
    hot_tasks = df.repartitionByRange(8, "k", "o").where("k = 'hot'") \
        .select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot_tasks >= 2
