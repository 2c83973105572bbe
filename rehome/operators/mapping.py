"""Id maps and lookups: AG4, AG5, JN1-JN5.

The reference builds Python dicts (name -> id, old id -> new id) and probes
them row by row.  Here a map is a two-column DataFrame; duplicates are
resolved with a partial (map-side) aggregate, and the map side is broadcast
only after a bounded row check, otherwise the join shuffles and AQE splits
skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.functions.defaults import default_cluster
from rehome.session import DEFAULT_BROADCAST_ROWS, left_lookup, materialize, side


# -- AG4 / AG5 ---------------------------------------------------------------
def last_wins(df: DataFrame, key: str, ord_col: str, cols: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the one with the largest ``ord_col`` (a later
    duplicate overwrites an earlier one, as a dict build does)."""
    cols = cols or [c for c in df.columns if c != key]
    return (df.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.col(ord_col)).alias("_v"))
            .select(key, "_v.*"))


def unique_rows(df: DataFrame, key: str, ord_col: str) -> DataFrame:
    """``last_wins`` that keeps every row without a key and drops the order."""
    keep = [c for c in df.columns if c != ord_col]
    return last_wins(df.where(F.col(key).isNotNull()), key, ord_col,
                     [c for c in keep if c != key]).select(*keep).unionByName(
        df.where(F.col(key).isNull()).select(*keep))


def unique_rows_ord(df: DataFrame, key: str, ord_col: str = "_ord") -> DataFrame:
    """``unique_rows`` that keeps the order column for later maps.

    No two rows have one position in a listing, so the last row of a key is the
    one at the key's last position.  Only keys listed twice are looked up:
    whole documents are neither shuffled nor sorted.
    """
    last = materialize(
        df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
        .agg(F.max(ord_col).alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1).drop("_n"), "listed-twice")
    j = left_lookup(df, last, F.col(key), "_key", DEFAULT_BROADCAST_ROWS)
    return j.where(F.col("_last").isNull() | F.col(ord_col).eqNullSafe(F.col("_last"))).select(*df.columns)


def first_match(df: DataFrame, key: str, ord_col: str, cols: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the first listed one (smallest ``ord_col``)."""
    cols = cols or [c for c in df.columns if c != key]
    return (df.groupBy(key)
            .agg(F.min_by(F.struct(*cols), F.col(ord_col)).alias("_v"))
            .select(key, "_v.*"))


def ambiguous_keys(df: DataFrame, key: str) -> DataFrame:
    """Natural keys that occur more than once (key, n)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def split_duplicates(df: DataFrame, key: str, id_col: str, ord_col: str
                     ) -> tuple[DataFrame, DataFrame]:
    """(rows that count, duplicates).  Of several rows of one natural key the
    last by ``ord_col`` counts (then the largest id), as in ``last_wins``; the
    others come back as (key, id, ``winner``: the id that counts).  Rows
    without a key count each.  Every row is on exactly one side.

    Only keys that occur twice are joined back, so a hot key costs one
    partial aggregate, written once for both sides, and a lookup.
    """
    at = F.struct(F.col(ord_col).alias("o"), F.col(id_col).alias("i"))
    top = (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_dup_key"))
           .agg(F.max(at).alias("_dup_top"), F.count(F.lit(1)).alias("_dup_n"))
           .where(F.col("_dup_n") > 1).drop("_dup_n"))
    top = materialize(top, "duplicates")
    j = left_lookup(df, top, F.col(key), "_dup_key", DEFAULT_BROADCAST_ROWS)
    lost = F.col("_dup_top").isNotNull() & ~at.eqNullSafe(F.col("_dup_top"))
    return (j.where(~lost).select(*df.columns),
            j.where(lost).select(key, id_col, F.col("_dup_top.i").alias("winner")))


# -- JN1 ---------------------------------------------------------------------
def id_map(source: DataFrame, target: DataFrame, key: str, id_col: str,
           ord_col: str | None = None,
           broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``(name, old_id, new_id)`` for natural keys present on both sides.

    With ``ord_col`` duplicates are resolved last-wins on each side;
    without it the snapshots must already be unique on ``key``.
    """
    def one(df: DataFrame, alias: str) -> DataFrame:
        df = df.select(key, id_col, *([ord_col] if ord_col else []))
        if ord_col:
            df = last_wins(df, key, ord_col, [id_col])
        return df.where(F.col(key).isNotNull()).select(
            F.col(key).alias("name"), F.col(id_col).alias(alias))

    src = one(source, "old_id")
    tgt = side(one(target, "new_id"), broadcast_rows)
    return src.join(tgt, "name", "inner")


# -- JN2 ---------------------------------------------------------------------
def remap_pools(clusters: DataFrame, pool_map: DataFrame,
                pool_col: str = "instance_pool_id",
                broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Old pool id -> new pool id via the pool name map (``id_map`` output).

    Adds ``new_pool_id`` and ``pool_status``: ``none`` (no pool), ``mapped``,
    or ``unresolved`` (the reference raises KeyError; here the row survives
    and goes to the dead letter).
    """
    m = pool_map.select(F.col("old_id").alias("_old_pool"), F.col("new_id").alias("new_pool_id"))
    out = left_lookup(clusters, m, F.col(pool_col), "_old_pool", broadcast_rows).drop("_old_pool")
    status = (F.when(F.col(pool_col).isNull(), F.lit("none"))
              .when(F.col("new_pool_id").isNull(), F.lit("unresolved"))
              .otherwise(F.lit("mapped")))
    return out.withColumn("pool_status", status)


# -- JN3 ---------------------------------------------------------------------
def remap_clusters(jobs: DataFrame, cluster_map: DataFrame, cloud: str = "aws",
                   broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rewire ``settings.existing_cluster_id`` from old to new cluster ids.

    ``outcome``: ``new_cluster`` (the job had no existing cluster, untouched),
    ``rewired`` (id replaced), ``reset_default`` (the cluster is gone: the id
    is cleared and the default spec set).  Adds ``old_cluster_id``.
    """
    m = cluster_map.select(F.col("old_id").alias("_old_cid"), F.col("new_id").alias("_new_cid"))
    old = F.col("settings.existing_cluster_id")
    j = left_lookup(jobs, m, old, "_old_cid", broadcast_rows)
    outcome = (F.when(old.isNull(), F.lit("new_cluster"))
               .when(F.col("_new_cid").isNull(), F.lit("reset_default"))
               .otherwise(F.lit("rewired")))
    settings = (F.when(outcome == "rewired",
                       F.col("settings").withField(
                           "existing_cluster_id", F.col("_new_cid").cast("string")))
                .when(outcome == "reset_default",
                      F.col("settings")
                      .withField("existing_cluster_id", F.lit(None).cast("string"))
                      .withField("new_cluster", default_cluster(cloud)))
                .otherwise(F.col("settings")))
    return (j.withColumn("outcome", outcome)
            .withColumn("old_cluster_id", old)
            .withColumn("settings", settings)
            .drop("_old_cid", "_new_cid"))


# -- JN4 ---------------------------------------------------------------------
def decide_existing(candidates: DataFrame, target: DataFrame, key: str,
                    target_key: str | None = None, col: str = "decision",
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Candidates with ``decision`` create, skip_existing or invalid_key (null
    keys can neither match nor be created safely), in one pass."""
    names = (target.select(F.col(target_key or key).alias("_name"))
             .where(F.col("_name").isNotNull()).distinct().withColumn("_there", F.lit(True)))
    out = left_lookup(candidates, names, F.col(key), "_name", broadcast_rows)
    return out.withColumn(col, F.when(F.col(key).isNull(), F.lit("invalid_key"))
                          .when(F.col("_there"), F.lit("skip_existing"))
                          .otherwise(F.lit("create"))).drop("_name", "_there")


def skip_existing(candidates: DataFrame, target: DataFrame, key: str,
                  target_key: str | None = None,
                  broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split candidates into (to_create, skipped, invalid) by
    ``decide_existing``."""
    d = decide_existing(candidates, target, key, target_key, "_decision", broadcast_rows)
    return tuple(d.where(F.col("_decision") == x).drop("_decision")
                 for x in ("create", "skip_existing", "invalid_key"))


# -- JN5 ---------------------------------------------------------------------
def null_unregistered_profile(clusters: DataFrame, profiles: DataFrame,
                              broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Clear ``aws_attributes.instance_profile_arn`` unless the arn is a
    registered profile; the other attributes are kept.  No registered
    profiles at all means every arn is cleared."""
    reg = (profiles.select(F.col("instance_profile_arn").alias("_reg"))
           .where(F.col("_reg").isNotNull() & (F.col("_reg") != "")).distinct())
    arn = F.col("aws_attributes.instance_profile_arn")
    j = left_lookup(clusters, reg, arn, "_reg", broadcast_rows)
    attrs = F.when(arn.isNotNull() & F.col("_reg").isNull(),
                   F.col("aws_attributes").withField("instance_profile_arn",
                                                     F.lit(None).cast("string"))
                   ).otherwise(F.col("aws_attributes"))
    return (j.withColumn("profile_dropped", arn.isNotNull() & F.col("_reg").isNull())
            .withColumn("aws_attributes", attrs).drop("_reg"))
