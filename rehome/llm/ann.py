"""Nearest neighbours by collision counting over single-projection arrays.

Vectors are dealt by hash to shards of about ``SHARD_ROWS``; every query visits
every shard, so a query block meets the rows in blocks and nothing is paired
by a join.  In a shard each of ``PROJECTIONS`` random projections gives one
sorted array.  A query opens a window of a half-width around its own value in
each array and counts, per vector, the windows that hold it.  Vectors over the
collision threshold are verified by their exact distance.  The first
half-width is a little under the k-th distance that a few of the shard's own
vectors have; virtual rehashing widens all windows by ``GROWTH`` until the k-th
distance found is no more than the half-width or all vectors are verified.  A
vector as far as the half-width is over the threshold with a chance of 0.87, at
0.95 of it with 0.94, and nearer ones almost surely; so what is missed is among
the last ranks.  Measured recall at 10: 1.00 at sf0.01, 0.965 at sf0.1, above 0.99
on the larger check tables.  Nothing caps the verified vectors.

Edge cases.  Vectors that are null, empty or zero or hold a null or non-finite
component take no part, nor do rows with a null id; a query searches the
vectors of its own length.  Rows of the same id and vector count once.  Rows of
one id with different vectors are one item: as a query it is searched with each
of them, as a candidate it is listed once, and the smallest distance counts.  A
query's own id is no candidate.  Ties go to the smaller id.  With fewer
candidates than k all are returned.  Other columns are not read, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rehome.session import materialize

PROJECTIONS = 64
THRESHOLD = 0.62
GROWTH = 1.12
FIRST_SHARE = 0.82
SAMPLE = 32
SHARD_ROWS = 16384
QUERY_ROWS = 4096
SEED = 7


def projections(dim: int, n: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(SEED + dim).standard_normal((n, dim))


class Shard:
    """Sorted arrays of one shard's projections."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.a = projections(x.shape[1])
        p = x @ self.a.T
        self.order = np.argsort(p, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.sort(p, axis=0).T
        self.first: dict[int, float] = {}
        self.need = int(np.ceil(THRESHOLD * len(self.a)))
        self.repeated = len(np.unique(ids)) < len(ids)

    def first_width(self, k: int) -> float:
        """Half-width to begin with; it only steers how much work is done."""
        if k not in self.first:
            some = self.x[np.linspace(0, len(self.x) - 1, SAMPLE).astype(int)]
            square = (self.x * self.x).sum(axis=1)
            d = (some * some).sum(axis=1)[:, None] + square - 2.0 * some @ self.x.T
            kth = np.sqrt(np.maximum(np.partition(d, min(k, d.shape[1] - 1), axis=1)
                                     [:, min(k, d.shape[1] - 1)], 0.0))
            self.first[k] = FIRST_SHARE * float(np.median(kth)) or 1e-3 * float(
                np.sqrt(square.mean()))
        return self.first[k]

    def search(self, query_id: int, q: np.ndarray, k: int):
        """The k nearest found: (distance, id), nearest first."""
        n, m = len(self.ids), len(self.a)
        at = self.a @ q
        low = np.array([np.searchsorted(v, c) for v, c in zip(self.values, at, strict=True)])
        high = low.copy()
        counts = np.zeros(n, np.int32)
        done = self.ids == query_id
        best_d, best_i = np.empty(0), np.empty(0, np.int64)
        width = self.first_width(k)
        while True:
            new_low = [np.searchsorted(v, c - width) for v, c in zip(self.values, at, strict=True)]
            new_high = [np.searchsorted(v, c + width, "right")
                        for v, c in zip(self.values, at, strict=True)]
            parts = [o[a:b] for o, a, b in zip(self.order, new_low, low, strict=True)]
            parts += [o[a:b] for o, a, b in zip(self.order, high, new_high, strict=True)]
            counts += np.bincount(np.concatenate(parts), minlength=n).astype(np.int32)
            low, high = new_low, new_high
            hit = np.flatnonzero((counts >= self.need) & ~done)
            if len(hit):
                done[hit] = True
                d = self.x[hit] - q
                best_d = np.concatenate((best_d, np.sqrt((d * d).sum(axis=1))))
                best_i = np.concatenate((best_i, self.ids[hit]))
                top = np.lexsort((best_i, best_d))
                if self.repeated:  # each id at its nearest vector
                    top = top[np.sort(np.unique(best_i[top], return_index=True)[1])]
                best_d, best_i = best_d[top[:k]], best_i[top[:k]]
            if done.all() or (len(best_d) == k and best_d[-1] <= width):
                return best_d, best_i
            width *= GROWTH


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance)."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    real = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), v.alias("_v"),
                          F.coalesce(is_query, F.lit(False)).alias("_q"))
    real = real.where(F.col("_id").isNotNull() & F.col("_v").isNotNull()
                      & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x)
                                 & (F.abs(x) < float("inf")))
                      & F.exists("_v", lambda x: x != 0))
    real = materialize(real.distinct().withColumn("_dim", F.size("_v")), "ann-vectors")
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = {r["_dim"]: (r["n"], r["q"] or 0) for r in real.groupBy("_dim").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_q").cast("bigint")).alias("q")).collect()}
    rows = spark.createDataFrame(
        [(d, 1 + a // SHARD_ROWS, 1 + q // QUERY_ROWS) for d, (a, q) in sizes.items()],
        "_dim int, _shards bigint, _blocks bigint")
    real = real.join(F.broadcast(rows), "_dim")  # one row per vector length
    deal = F.xxhash64("_id", "_v")
    data = real.select("_dim", F.pmod(deal, "_shards").alias("_s"), F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)).alias("_b"),
        F.lit(0).alias("_side"), "_id", "_v")
    queries = real.where("_q").select("_dim", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("_shards") - 1)).alias("_s"),
        F.pmod(deal, "_blocks").alias("_b"), F.lit(1).alias("_side"), "_id", "_v")
    met = (data.unionByName(queries).repartition(n, "_dim", "_s", "_b")
           .sortWithinPartitions("_dim", "_s", "_b", "_side", "_id"))

    def run(batches):
        key, ids, parts, shard = None, [], [], None
        for batch in batches:
            dims, ss, bs, sides = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            id_all = batch.column(4).to_numpy(zero_copy_only=False)
            vec = batch.column(5)
            change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(ss) != 0) | (np.diff(bs) != 0)
                                    | (np.diff(sides) != 0)) + 1
            out = [[], [], []]
            for lo, hi in zip(np.concatenate(([0], change)),
                              np.concatenate((change, [batch.num_rows])), strict=True):
                if lo == hi:
                    continue
                now = (dims[lo], ss[lo], bs[lo])
                x = vec.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False) \
                    .reshape(hi - lo, dims[lo])
                if now != key:
                    key, ids, parts, shard = now, [], [], None
                if sides[lo] == 0:
                    ids.append(id_all[lo:hi])
                    parts.append(x.copy())
                    continue
                if not ids:
                    continue
                if shard is None:
                    shard = Shard(np.concatenate(ids), np.concatenate(parts))
                for i in range(hi - lo):
                    q = int(id_all[lo + i])
                    d, got = shard.search(q, x[i], k)
                    out[0] += [q] * len(d)
                    out[1] += got.tolist()
                    out[2] += d.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id bigint, vec_id bigint, score double") \
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
