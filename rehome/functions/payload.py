"""Payload, key and document expressions (SC4-SC17 column transforms)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "split_qualified", "qualified_ok", "encode_b64", "decode_b64", "to_doc", "from_doc",
    "parse_name_list", "upsert_tag", "major_version", "major_version_at_least",
    "route_export", "route_import", "wrap_values", "object_ref", "permissions_path",
    "ref_kind", "ref_id", "ddl_provider", "ddl_location", "ddl_n_columns",
    "add_roles_doc", "add_members_doc", "member_kind", "drop_null_elements",
    "PATCH_OP_SCHEMA", "EXPORT_INLINE_CHARS", "IMPORT_INLINE_BYTES",
]

# SCIM patch schema, size limits for inline DDL transport.
PATCH_OP_SCHEMA = "urn:ietf:params:scim:api:messages:2.0:PatchOp"
EXPORT_INLINE_CHARS = 2048
IMPORT_INLINE_BYTES = 1024
USER_REF_MARKER = "scim/v2/Users"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- SC4 --------------------------------------------------------------------
def split_qualified(t) -> tuple[Column, Column]:
    """``db.table`` -> (db, table) from the first two dot parts."""
    t = _c(t)
    return F.split_part(t, F.lit("."), F.lit(1)), F.split_part(t, F.lit("."), F.lit(2))


def qualified_ok(t) -> Column:
    """Exactly two non-empty dot parts; anything else is a dead letter."""
    return F.coalesce(_c(t).rlike(r"^[^.]+\.[^.]+$"), F.lit(False))


# -- SC5 / SC6 ----------------------------------------------------------------
def encode_b64(b) -> Column:
    """Base64 without the 76-column line wrapping Spark adds."""
    return F.regexp_replace(F.base64(_c(b)), r"[\r\n]", "")


def decode_b64(s, as_text: bool = True) -> Column:
    raw = F.unbase64(_c(s))
    return F.decode(raw, "UTF-8") if as_text else raw


def to_doc(*cols) -> Column:
    """Object -> JSON text (null fields are omitted, empty arrays kept)."""
    return F.to_json(F.struct(*cols)) if len(cols) != 1 else F.to_json(_c(cols[0]))


def from_doc(s, schema) -> Column:
    return F.from_json(_c(s), schema)


# -- SC7 -------------------------------------------------------------------
def parse_name_list(s) -> Column:
    """Printed Python list of names (``['a', 'b']``) -> array<string>."""
    return F.from_json(_c(s), "array<string>", {"allowSingleQuotes": "true"})


# -- SC8 -------------------------------------------------------------------
def upsert_tag(m, key: str, value) -> Column:
    """Set one key of a string map, creating the map when it is absent."""
    value = F.lit(value) if isinstance(value, str) else _c(value)
    empty = F.create_map().cast("map<string,string>")
    kept = F.map_filter(F.coalesce(_c(m), empty), lambda k, _v: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), value.cast("string")))


# -- SC9 -------------------------------------------------------------------
def major_version(v) -> Column:
    return _major(_c(v))


def _major(v: Column) -> Column:
    return F.split_part(v, F.lit("."), F.lit(1)).try_cast("int")


def major_version_at_least(v, n: int = 7) -> Column:
    """Numeric major version test (``10.4`` is newer than ``7.3``)."""
    return F.coalesce(_major(_c(v)) >= F.lit(n), F.lit(False))


# -- SC10 ------------------------------------------------------------------
def route_export(ddl) -> Column:
    """error (no text), file (over 2048 characters) or inline."""
    n = F.length(_c(ddl))
    return (F.when(n.isNull() | (n <= 0), F.lit("error"))
            .when(n > EXPORT_INLINE_CHARS, F.lit("file"))
            .otherwise(F.lit("inline")))


def route_import(ddl) -> Column:
    """upload (over 1024 UTF-8 bytes) or inline."""
    n = F.octet_length(_c(ddl))
    return (F.when(n.isNull() | (n <= 0), F.lit("error"))
            .when(n > IMPORT_INLINE_BYTES, F.lit("upload"))
            .otherwise(F.lit("inline")))


# -- SC12 / SC14 -------------------------------------------------------------
def wrap_values(arr) -> Column:
    """``[x, ...]`` -> ``[{"value": x}, ...]``."""
    return F.transform(_c(arr), lambda x: F.struct(x.alias("value")))


def add_roles_doc(role_values) -> Column:
    """SCIM patch document that adds roles (``role_values``: array<string>)."""
    op = F.struct(F.lit("add").alias("op"), F.lit("roles").alias("path"),
                  wrap_values(role_values).alias("value"))
    return F.to_json(F.struct(F.array(F.lit(PATCH_OP_SCHEMA)).alias("schemas"),
                              F.array(op).alias("Operations")))


def add_members_doc(member_ids) -> Column:
    """SCIM patch document that adds members (``member_ids``: array<string>)."""
    op = F.struct(F.lit("add").alias("op"),
                  F.struct(wrap_values(member_ids).alias("members")).alias("value"))
    return F.to_json(F.struct(F.array(F.lit(PATCH_OP_SCHEMA)).alias("schemas"),
                              F.array(op).alias("Operations")))


def member_kind(ref) -> Column:
    """user / group from a member ``$ref``; null ``$ref`` gives null (error row)."""
    ref = _c(ref)
    return F.when(ref.isNull(), F.lit(None).cast("string")).when(
        ref.contains(USER_REF_MARKER), F.lit("user")).otherwise(F.lit("group"))


# -- SC15 ------------------------------------------------------------------
def object_ref(kind, object_id) -> Column:
    """``/<kind>/<id>``, the key ACL documents carry."""
    return F.concat(F.lit("/"), _c(kind), F.lit("/"), _c(object_id).cast("string"))


def permissions_path(ref) -> Column:
    return F.concat(F.lit("/permissions"), _c(ref))


def ref_kind(ref) -> Column:
    return F.split_part(_c(ref), F.lit("/"), F.lit(2))


def ref_id(ref) -> Column:
    return F.split_part(_c(ref), F.lit("/"), F.lit(3))


# -- SC16 ------------------------------------------------------------------
# Quoted text and quoted names may hold any of the signs a definition is made
# of; each counts as one piece.  Nested parentheses and type arguments are
# matched down to ``DDL_DEPTH`` levels.  All loops over them are possessive, so
# a definition is taken apart in linear time.
DDL_DEPTH = 16
_STRING = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
_QUOTED = _STRING + r"|`[^`]*+`"


def _nested(left: str, right: str, depth: int = DDL_DEPTH) -> str:
    """A balanced pair of signs with everything between them."""
    deeper = "|" + _nested(left, right, depth - 1) if depth > 1 else ""
    return rf"""{left}(?:[^'"`{left}{right}]++|{_QUOTED}{deeper})*+{right}"""


_PARENS = _nested(r"\(", r"\)")
_GENERIC = rf"(?:ARRAY|MAP|STRUCT)\s*+{_nested('<', '>')}"
_LIST = (r"(?is)^\s*+CREATE\b(?:[^(),<>'\"`]|" + _QUOTED + r")*?\b(?:TABLE|VIEW)\s+(?:IF\s+NOT\s+EXISTS\s+)?"
         r"(?:[^\s(),<>'\"`]|" + _QUOTED + r")++\s*+\(((?:[^'\"`()]++|" + _QUOTED + "|" + _PARENS + r")*+)")
_ITEM = rf"(?is)(?:\b{_GENERIC}|{_QUOTED}|{_PARENS}|[^,])++"
_NAME = r"(?:`[^`]*+`|[^\s`]++)++"
_COLUMN = rf"(?is)^\s*+(?!(?:CONSTRAINT|PRIMARY|FOREIGN|CHECK|UNIQUE)\b)({_NAME})\s++(?=\S)"
_TYPE = rf"(?is)^((?:{_GENERIC}|[^\s'\"`(),<>]++(?:\s*+{_PARENS})?+))"


def _blanked(ddl: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(ddl, "(?s)" + _STRING, "s"), r"`[^`]*`", "q")


def ddl_provider(ddl) -> Column:
    return F.upper(F.regexp_extract(_blanked(_c(ddl)), r"(?i)\bUSING\s+([A-Za-z0-9_.]+)", 1))


def ddl_location(ddl) -> Column:
    """``path`` option or ``LOCATION`` clause, empty when neither is present."""
    d = _c(ddl)
    opt = F.regexp_extract(d, r"(?i)\bpath\s+'([^']*)'", 1)
    loc = F.regexp_extract(d, r"(?i)\bLOCATION\s+'([^']*)'", 1)
    return F.when(opt != "", opt).otherwise(loc)


def ddl_columns(ddl) -> Column:
    """array<struct<name, type>> of the column list right after the table's
    name; empty without such a list, null for null.

    The list is cut out by one pattern and split at its own commas by another;
    quoted text, parentheses and type arguments are stepped over whole.  A
    column is an item that starts with a (quoted or plain) name and more text,
    and is no table constraint.  The type is written as in the definition,
    arguments included.
    """
    items = F.filter(F.regexp_extract_all(F.regexp_extract(_c(ddl), _LIST, 1), F.lit(_ITEM), F.lit(0)),
                     lambda x: x.rlike(_COLUMN))
    return F.transform(items, lambda x: F.struct(
        F.regexp_replace(F.regexp_extract(x, _COLUMN, 1), "^`(.*)`$", "$1").alias("name"),
        F.regexp_extract(F.regexp_replace(x, _COLUMN, ""), _TYPE, 1).alias("type")))


def ddl_n_columns(ddl) -> Column:
    """Number of ``ddl_columns``."""
    items = F.regexp_extract_all(F.regexp_extract(_c(ddl), _LIST, 1), F.lit(_ITEM), F.lit(0))
    return F.size(F.filter(items, lambda x: x.rlike(_COLUMN)))


# -- FLT8 ------------------------------------------------------------------
def drop_null_elements(arr) -> Column:
    """Drop null and empty-string elements of an array of strings."""
    return F.filter(_c(arr), lambda x: x.isNotNull() & (x != ""))
