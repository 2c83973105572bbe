"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

# Rows handed to a Python function at once; Spark bounds the Arrow batch
# itself by bytes (spark.sql.execution.arrow.maxBytesPerBatch).
SLICE_ROWS = 512

_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
    "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64()),
}

# Both word rules as byte tables: A-Z is lower-cased and every separator
# becomes a space, so ``bytes.split`` yields exactly the words.
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
BLANK_TABLE = bytes(_LOWER.get(c, c) for c in range(256))
ALNUM_TABLE = bytes(
    _LOWER.get(c, c) if c >= 0x80 or 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A
    else 0x20 for c in range(256))


def blank_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, A-Z lower-cased."""
    return text.translate(BLANK_TABLE).split()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z lower-cased."""
    return text.translate(ALNUM_TABLE).split()


def decode(text: bytes | None) -> str:
    return "" if text is None else text.decode("utf-8", "replace")


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct column ``row``: whatever their names are,
    they cannot clash with the columns an operator adds."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def kept_names(keep: Sequence[str], added: Sequence[str], row: bool = False) -> dict[str, str]:
    """Name in the result of each kept column: its own, or with ``_kept`` behind
    it where an operator adds a column of that name."""
    taken = set(added) | {"__text"} | ({"row"} if row else set())
    out = {}
    for c in keep:
        name = c
        while name in taken | (set(keep) - {c}):
            name += "_kept"
        out[c] = name
    return out


def map_texts(df: DataFrame, text_col: str, make: Callable[[], Callable], fields: Sequence[tuple],
              keep: Sequence[str] = (), row: bool = False) -> DataFrame:
    """Add columns computed in Python from one text column.

    ``make()`` runs once per task and returns ``fn(list of bytes or None) ->
    list of columns`` in the order of ``fields`` (name, type).  ``keep``
    columns, or with ``row=True`` the whole row as struct ``row``, go along.  A
    kept column with the name of an added one comes back as ``<name>_kept``.
    Texts stream through in slices, so a task never holds its partition.
    """
    head = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if row else []
    kept = kept_names(keep, [n for n, _ in fields], row)
    src = df.select(*head, *[F.col(f"`{c}`").alias(n) for c, n in kept.items()],
                    F.col(f"`{text_col}`").cast("binary").alias("__text"))
    passed = src.schema.fields[:-1]
    schema = StructType(passed + [StructField(n, _parse_datatype_string(t), True)
                                  for n, t in fields])
    types = [_ARROW[t] for _, t in fields]
    names = schema.names

    def run(batches):
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                k = part.num_columns - 1
                cols = fn(part.column(k).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(k)]
                    + [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return src.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
