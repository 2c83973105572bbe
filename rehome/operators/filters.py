"""Projections and filters: PRJ1-PRJ4, FLT1-FLT11.

All predicates are null-safe (a null never silently drops a row that the
reference would keep) and are plain Catalyst expressions, so simple ones
(equality, prefix) are pushed into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rehome.functions import paths as P
from rehome.schemas import WS_ITEM_TYPES

# Automated cluster names (job runs, model serving endpoints).
JOB_RUN_PATTERN = r"^job-[0-9]+-run-[0-9]+$"
MODEL_PREFIX = "mlflow-model-"
BUILTIN_ADMIN = ("admin", "Administrator")


# -- PRJ1 ----------------------------------------------------------------------
def keep_known_fields(df: DataFrame, allow: list[str] | tuple[str, ...]) -> DataFrame:
    """Keep only allow-listed top-level columns; absent ones stay absent."""
    return df.select(*[c for c in df.columns if c in set(allow)])


def keep_known_json(doc_col: str, schema: StructType, allow) -> "F.Column":
    """JSON text -> JSON text with only allow-listed keys (nulls omitted)."""
    sub = StructType([f for f in schema.fields if f.name in set(allow)])
    return F.to_json(F.from_json(F.col(doc_col), sub))


# -- PRJ2 / PRJ3 / PRJ4 ------------------------------------------------------------
def project_items(df: DataFrame) -> DataFrame:
    return df.select("path", "object_id")


def drop_fields(df: DataFrame, *names: str) -> DataFrame:
    """Drop top-level columns or nested fields given as ``a.b``."""
    out = df
    for n in names:
        if "." in n:
            top, rest = n.split(".", 1)
            if top in out.columns:
                out = out.withColumn(top, F.col(top).dropFields(rest))
        else:
            out = out.drop(n)
    return out


def project_mounts(df: DataFrame) -> DataFrame:
    return df.select(F.col("mountPoint").alias("path"), "source", "encryptionType")


# -- FLT1 ----------------------------------------------------------------------
def running(df: DataFrame, state_col: str = "state") -> DataFrame:
    return df.where(F.col(state_col) == F.lit("RUNNING"))


# -- FLT2 ----------------------------------------------------------------------
def is_automated(name_col: str = "cluster_name") -> "F.Column":
    n = F.col(name_col)
    return F.coalesce(n.rlike(JOB_RUN_PATTERN) | n.startswith(MODEL_PREFIX), F.lit(False))


def split_automated(df: DataFrame, name_col: str = "cluster_name") -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): job-run and model-endpoint clusters are skipped."""
    auto = is_automated(name_col)
    return df.where(~auto), df.where(auto)


# -- FLT3 ----------------------------------------------------------------------
def drop_builtin_admin(df: DataFrame) -> DataFrame:
    """Drop the built-in admin; a user without ``name`` is always kept."""
    user, given = BUILTIN_ADMIN
    hit = (F.col("userName").eqNullSafe(user) & F.col("name").isNotNull()
           & F.col("name.givenName").eqNullSafe(given))
    return df.where(~hit)


# -- FLT4 ----------------------------------------------------------------------
def filter_item_type(df: DataFrame, item_type: str) -> DataFrame:
    if item_type not in WS_ITEM_TYPES:
        raise ValueError(f"no item type {item_type!r}; one of {', '.join(WS_ITEM_TYPES)} is needed")
    return df.where(F.col("object_type") == item_type)


# -- FLT5 / FLT10 / HR1 ----------------------------------------------------------
def prune_trash(df: DataFrame, root: str = "/") -> DataFrame:
    return df.where(P.keep_after_trash_prune("path", "object_type", root))


def scope_subtree(df: DataFrame, root: str) -> DataFrame:
    """Items strictly below ``root`` (the root itself is not listed)."""
    return df.where(P.in_subtree("path", root))


# -- FLT6 ----------------------------------------------------------------------
def classify_path(df: DataFrame, path_col: str = "path") -> DataFrame:
    return (df.withColumn("is_user_item", P.is_user_item(path_col))
            .withColumn("is_user_root", P.is_user_root(path_col))
            .withColumn("user", P.path_user(path_col)))


# -- FLT8 / FLT9 -------------------------------------------------------------------
def files_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_dir") == F.lit(False))


# -- FLT11 ---------------------------------------------------------------------
def scope_database(df: DataFrame, db: str, db_col: str = "db") -> DataFrame:
    """One database; on a table partitioned by ``db`` this prunes partitions."""
    return df.where(F.col(db_col) == F.lit(db))
