"""Session, scratch-space and join-side helpers shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds for a join side that may be broadcast: rows, and estimated
# bytes of its columns.  Id maps, pools, profiles and role lists are far below
# them in any workspace; anything larger falls back to a shuffle join that AQE
# can split when skewed.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20
# Rough bytes of a value next to its content (headers, offsets).
VALUE_BYTES = 16

_LOCAL_ROOT: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "rehome", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the operators are tuned for.

    On a cluster ``master`` stays None.  Settings that the submitter gave
    (``spark-submit --conf``, defaults file, or a running session) win; the
    defaults below only fill in what is unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    running = SparkSession.getActiveSession()
    if running is None:
        SparkContext._ensure_initialized()  # so that SparkConf holds the submitter's settings
    given = running.sparkContext.getConf() if running else SparkConf()
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    defaults = {k: v for k, v in defaults.items() if not given.contains(k)}
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update(extra_conf or {})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    It is the folder named by ``spark.checkpoint.dir``, else the checkpoint
    folder the application has set itself.  A private folder is created only
    where neither is given and the master is ``local`` or ``local[...]``; on
    any other master executors could not share it, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    conf = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None
            else spark.conf.get("spark.checkpoint.dir", None))
    if conf:
        return conf.rstrip("/")
    if sc is not None:
        own = sc._jsc.sc().getCheckpointDir()
        if own.isDefined():
            return own.get().rstrip("/")
    if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = sc.applicationId
    if key not in _LOCAL_ROOT:
        _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="rehome-scratch-")
    return _LOCAL_ROOT[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root for written tables; it is
    remembered until ``release_scratch``."""
    root = checkpoint_root(spark)
    path = f"{root}/rehome-{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(root, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete every folder ``scratch_path`` has given out below this session's
    root and return their number.  Results that still read them must have been
    written or collected before."""
    paths = _WRITTEN.pop(checkpoint_root(spark), [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a parquet table below the shared root and read it
    back: the lineage is cut, the rows are computed exactly once, and a lost
    executor cannot change what later stages read.  ``release_scratch`` deletes
    the folder.  ``compression`` is a parquet codec, else the session's."""
    path = scratch_path(df.sparkSession, name)
    options = {"compression": compression} if compression else {}
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(df: DataFrame):
    """Estimated bytes of one row: text and binary by length, complex values
    as JSON text, anything else as one value."""
    parts = [F.lit(VALUE_BYTES)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + VALUE_BYTES)
        elif kind in ("array", "map", "struct"):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + VALUE_BYTES)
        else:
            parts.append(F.lit(VALUE_BYTES))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
         max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows and about
    ``max_bytes`` bytes in its columns.

    One job with map-side partial sums.  Plans check each small *input* once,
    reduced to the columns its join sides use: projections, filters, distincts
    and per-key aggregates of that input can never have more, so every side
    derived from it inherits the bound without another job.
    """
    return fits_many({"": df}, max_rows, max_bytes)[""]


def fits_many(frames: dict[str, DataFrame], max_rows: int = DEFAULT_BROADCAST_ROWS,
              max_bytes: int = DEFAULT_BROADCAST_BYTES) -> dict[str, bool]:
    """``fits`` for several inputs in one job: a union of tagged,
    column-pruned branches with one grouped sum (a row per input)."""
    tagged = None
    for name, df in frames.items():
        t = df.select(F.lit(name).alias("_input"), _row_bytes(df).cast("bigint").alias("_bytes"))
        tagged = t if tagged is None else tagged.unionByName(t)
    got = {r["_input"]: r for r in tagged.groupBy("_input").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b")).collect()}
    return {name: name not in got or (got[name]["n"] <= max_rows and got[name]["b"] <= max_bytes)
            for name in frames}


def is_small(df: DataFrame, bound) -> bool:
    """A bound given as ``True`` (already proven by the caller),
    ``False``/``None``/0 (too big or unknown), or a row count to check here."""
    if bound is True or bound is None or bound is False or bound == 0:
        return bound is True
    return fits(df, int(bound))


def side(df: DataFrame, bound) -> DataFrame:
    """Join side: broadcast only within its proven bound (see ``is_small``);
    beyond it the side is unhinted, so the planner uses a shuffle join."""
    return F.broadcast(df) if is_small(df, bound) else df


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it is proven small."""
    return side(df, max_rows)


def left_lookup(left: DataFrame, right: DataFrame, left_key, right_key: str, bound) -> DataFrame:
    """Left join on one key whose null side never takes part in a shuffle.

    With a broadcast side nothing is shuffled.  Otherwise rows with a null key
    would all hash to one partition, so only rows with a key are joined and
    the others are united with null results.
    """
    if is_small(right, bound):
        r = F.broadcast(right)
        return left.join(r, left_key == r[right_key], "left")
    known = left.where(left_key.isNotNull()).join(right, left_key == right[right_key], "left")
    rest = left.where(left_key.isNull()).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in right.schema.fields})
    return known.unionByName(rest)
