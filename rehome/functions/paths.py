"""Workspace path expressions.

Paths are absolute, ``/``-separated and may contain empty parts (``//``).
Every function is a built-in Spark expression, so it stays inside
whole-stage codegen and is evaluated where the data is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "path_parts", "path_depth", "is_user_item", "is_user_root", "path_user",
    "is_trash_dir", "in_trash_subtree", "keep_after_trash_prune", "in_subtree",
    "archive_path", "dir_name", "base_name", "strip_ext", "artifact_name",
    "clean_user_name", "clean_db_name",
]

# Fixed values of the workspace layout.
USERS_DIR = "Users"
ARCHIVE_DIR = "Archive"
TRASH_DIR = "Trash"
ARTIFACT_EXT = ".dbc"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The predicates below are regular expressions over the non-empty parts of a
# path (``[^/]+`` runs); they stay inside generated code, unlike lambdas.
_SECOND_PART = r"^/*[^/]+/+([^/]+)"


def path_parts(p) -> Column:
    """Non-empty ``/`` parts of a path."""
    return F.regexp_extract_all(_c(p), F.lit(r"[^/]+"), 0)


def path_depth(p) -> Column:
    return F.size(path_parts(p))


def is_user_item(p) -> Column:
    """At least two parts and the first one is ``Users``."""
    return _c(p).rlike(r"^/*Users/+[^/]")


def is_user_root(p) -> Column:
    """``/Users``, ``/Users/`` or a home folder ``/Users/<user>``."""
    p = _c(p)
    return p.isin("/Users/", "/Users") | p.rlike(r"^/*Users/+[^/]+/*$")


def path_user(p) -> Column:
    """Second non-empty part; null when the path has fewer than two parts."""
    p = _c(p)
    return F.when(p.rlike(_SECOND_PART), F.regexp_extract(p, _SECOND_PART, 1))


def is_trash_dir(p) -> Column:
    """Exactly four ``/``-split pieces: ``<x>/Users/<user>/Trash``."""
    return _c(p).rlike(r"^[^/]*/Users/[^/]*/Trash$")


def in_trash_subtree(p) -> Column:
    return _c(p).rlike(r"^[^/]*/Users/[^/]*/Trash/")


def keep_after_trash_prune(p, object_type, root: str = "/") -> Column:
    """True unless a depth-first walk from ``root`` would skip the item.

    A walk never tests the root itself, so when the root is a trash folder
    or lies inside one (depth >= 3) nothing below it is pruned.  Otherwise a
    DIRECTORY that is a trash folder is skipped together with everything
    below it; a notebook that happens to be called ``Trash`` stays.
    """
    root_depth = len([x for x in root.split("/") if x])
    if root_depth >= 3:
        return F.lit(True)
    is_dir = _c(object_type) == F.lit("DIRECTORY")
    skipped = in_trash_subtree(p) | (is_dir & is_trash_dir(p))
    return ~F.coalesce(skipped, F.lit(False))


def in_subtree(p, root: str) -> Column:
    """Strictly below ``root`` (the root itself is never listed)."""
    p = _c(p)
    if root.strip("/") == "":
        return p != F.lit("/")
    return p.startswith(root.rstrip("/") + "/")


def archive_path(p) -> Column:
    """First ``Users`` part becomes ``Archive`` (leading slashes kept)."""
    return F.regexp_replace(_c(p), r"^(/*)Users", r"$1" + ARCHIVE_DIR)


def dir_name(p) -> Column:
    """POSIX dirname: head up to the last slash, trailing slashes trimmed
    unless the head is only slashes."""
    head = F.regexp_extract(_c(p), r"^(.*/)", 1)
    return F.when(head.rlike(r"^/+$"), head).otherwise(F.regexp_replace(head, r"/+$", ""))


def base_name(p) -> Column:
    return F.regexp_extract(_c(p), r"([^/]*)$", 1)


def strip_ext(p) -> Column:
    """Drop the last four characters (the artifact extension)."""
    return _strip_last(_c(p), 4)


def _strip_last(p: Column, n: int) -> Column:
    return F.when(F.length(p) > n, p.substr(F.lit(1), F.length(p) - n)).otherwise(
        F.when(p.isNotNull(), F.lit("")))


def artifact_name(p) -> Column:
    """Relative artifact file for a workspace path: mirrored path + extension."""
    return F.concat(_c(p), F.lit(ARTIFACT_EXT))


def clean_user_name(s) -> Column:
    return F.trim(_c(s))


def clean_db_name(s) -> Column:
    return F.replace(_c(s), F.lit("\n"), F.lit(""))
