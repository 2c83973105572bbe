"""Mixing sources to target weights along a time-varying curriculum.

DataFrame functions only.  Each source has a schedule, a piecewise linear
weight over training time 0..1.  The integral of the schedule is the source's
weight; the token budget is shared by weight, no source above ``max_passes``
times its size (the excess is reshared by weight until none is above).  Within
a source the documents follow a hash order; a document's demand is the span of
the source's cumulative tokens that it covers, and inverting the source's
integrated schedule at the start of that span gives its training position.
The result is range-sorted by position.

The cumulative sums never gather a source in one task: hash buckets of about
``BUCKET_ROWS`` documents are summed, their sums are accumulated in two
levels, and running sums are taken inside a bucket.  Rows of a source that
share id and size are alike in all but their place: they are summed as one row
with a count, and dealt out again by chunks of ``CHUNK`` afterwards, so a null
or repeated id that a large share of the rows have does not meet in one task.

Edge cases.  Null text has size 0; null is a source of its own, last in order.
Documents of size 0 take nothing.  Repeated rows are documents of their own.
If all sizes are 0, so are all targets.  Only ``id``, ``text`` and ``source``
are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rehome.operators.batches import row_index
from rehome.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 500
SUPER = 1024
CHUNK = 1024

# (time, weight) knots; the integrals are the weights 5, 2 and 1.
SCHEDULES = (((0.0, 7.5), (1.0, 2.5)),
             ((0.0, 2.0), (1.0, 2.0)),
             ((0.0, 0.5), (1.0, 1.5)))


def integral(knots) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2.0 for a, b in zip(knots, knots[1:], strict=False))


def invert(share: Column, knots) -> Column:
    """Time at which the integrated schedule reaches ``share`` of its total."""
    area = share * F.lit(integral(knots))
    out, low = None, 0.0
    parts = list(zip(knots, knots[1:], strict=False))
    for i, ((t0, w0), (t1, w1)) in enumerate(parts):
        piece = (t1 - t0) * (w0 + w1) / 2.0
        slope = (w1 - w0) / (t1 - t0)
        rest = area - F.lit(low)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
        time = F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + root)
        if i == len(parts) - 1:
            out = time if out is None else out.otherwise(time)
        else:
            hit = area < F.lit(low + piece)
            out = F.when(hit, time) if out is None else out.when(hit, time)
        low += piece
    return out


def water_level(sources: DataFrame, budget: float) -> float:
    """The level l at which the targets ``min(cap, l * weight)`` sum up to the
    budget.  Every round is one aggregate with two sums; a round can only add
    capped sources, so it ends after as many rounds as caps are met."""
    level, capped = 0.0, None
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        r = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)).alias("c"),
                        F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("w"),
                        F.sum(F.when(full, 1).otherwise(0)).alias("n")).first()
        if not r["w"] or r["n"] == capped:
            return level
        capped, level = r["n"], (budget - r["c"]) / r["w"]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", schedules=SCHEDULES, budget_share: float = 1.5,
                max_passes: int = 2) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken,
    position and repeat_position (training time of its first and second take,
    null where there is none), range-sorted by position."""
    spark = docs.sparkSession
    source = F.col(f"`{source_col}`").cast("string")
    name = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    sizes = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), source.isNull().alias("_none"),
        F.coalesce(source, F.lit("")).alias("_source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0))
        .cast("bigint").alias("size"), name.alias("_h")), "mix-sizes")
    sources = sizes.groupBy("_none", "_source").agg(F.sum("size").alias("source_size"),
                                                    F.count(F.lit(1)).alias("n"))
    ranked = materialize(row_index(sources, [], ["_none", "_source"], "_rank"), "mix-sources")
    kinds = len(schedules)
    weight = F.element_at(F.array(*[F.lit(integral(k)) for k in schedules]),
                          (F.col("_rank") % kinds + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * max_passes)
    got = ranked.agg(F.sum("source_size").alias("words"), F.sum("n").alias("docs")).first()
    level = water_level(ranked, budget_share * (got["words"] or 0))
    full = F.col("cap") <= F.lit(level) * F.col("weight")
    targets = ranked.select(
        "_none", "_source", "source_size", F.pmod("_rank", F.lit(kinds)).alias("_kind"),
        F.when(full, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight"))
        .alias("target"))

    buckets = -(-(got["docs"] or 1) // BUCKET_ROWS)
    first = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    sized = sizes.withColumn("_b", F.floor(first * F.lit(buckets) / F.lit(float(1 << 32))).cast("bigint"))
    key = ["_none", "_source"]
    sums = (sized.groupBy(*key, "_b").agg(F.sum("size").alias("_sum"))
            .withColumn("_super", F.floor(F.col("_b") / SUPER)))
    over = sums.groupBy(*key, "_super").agg(F.sum("_sum").alias("_sum"))
    over = over.select(*key, "_super", (F.sum("_sum").over(
        Window.partitionBy(*key).orderBy("_super")) - F.col("_sum")).alias("_before"))
    sums = sums.withColumn("_inner", F.sum("_sum").over(
        Window.partitionBy(*key, "_super").orderBy("_b")) - F.col("_sum"))
    offsets = (sums.join(over, key + ["_super"]).join(targets, key)
               .select(*key, "_b", (F.col("_before") + F.col("_inner")).alias("_off"),
                       "source_size", "target", "_kind"))
    inside = Window.partitionBy(*key, "_b").orderBy("_h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    alike = sized.groupBy(*key, "_b", "_h", "doc_id", "size").agg(F.count(F.lit(1)).alias("_n"))
    all_of = F.col("size") * F.col("_n")
    spans = alike.withColumn("_cum", F.sum(all_of).over(inside) - all_of).join(offsets, key + ["_b"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = F.col("_chunk") * CHUNK
    spans = (spans.withColumn("_chunk", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / CHUNK))))
        .repartition(n, *key, "_h", "doc_id", "size", "_chunk")
        .withColumn("_at", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("_n")) - 1))))
    start = F.col("_off") + F.col("_cum") + F.col("_at") * F.col("size")
    words = F.floor(F.col("target") + 0.5).cast("bigint")

    def took(e):
        return F.least(F.col("size"), F.greatest(
            F.lit(0).cast("bigint"), words - F.lit(e) * F.col("source_size") - start))

    def time(e):
        share = (F.lit(e) * F.col("source_size") + start) / F.col("target")
        at = None
        for k, knots in enumerate(schedules):
            hit = F.col("_kind") == k
            at = F.when(hit, invert(share, knots)) if at is None \
                else at.when(hit, invert(share, knots))
        return F.when(took(e) > 0, at)

    taken = took(0)
    for e in range(1, max_passes):
        taken = taken + took(e)
    out = spans.select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                       time(0).alias("position"),
                       (time(1) if max_passes > 1 else F.lit(None).cast("double"))
                       .alias("repeat_position"))
    return out.repartitionByRange(n, "position", "doc_id").sortWithinPartitions("position", "doc_id")
