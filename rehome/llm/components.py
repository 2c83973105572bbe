"""Connected components of an edge table by alternating star contraction.

Each round connects every node's larger neighbours, then its smaller ones, to
the smallest node it sees.  The minima are map-side combined and joined back,
so the edges of a hub are never gathered in one task; every round is written
to the shared checkpoint folder.  Rounds grow with the logarithm of a
component's size, and the edge count never grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.session import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``edges`` (u, v): link each node's larger (or not larger) neighbours
    with the smallest of the node and these neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("_m")).select(
        "u", F.least("u", "_m").alias("_m"))
    if larger:
        out = both.where(F.col("v") > F.col("u")).join(low, "u").select(
            F.col("v").alias("a"), F.col("_m").alias("b"))
    else:  # a > b, so all of u's neighbours here are smaller
        out = both.join(low, "u").select(F.col("v").alias("a"), F.col("_m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("_m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; the component is its
    smallest node.  ``edges`` has the columns a and b in any order."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where(F.col("a") != F.col("b")).distinct()
    now = materialize(now, "components")
    before = None
    while True:
        r = now.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if not r["n"] or (r["n"], r["s"]) == before:
            break
        before = (r["n"], r["s"])
        now = materialize(_star(materialize(_star(now, True), "components"), False), "components")
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return materialize(members.unionByName(centres), "components")
