"""Passages that repeat across documents, by a sparse suffix array.

1. In every document the minimiser (the smallest hash among ``SPREAD``
   consecutive ``GRAM``-word grams) selects positions by content; any passage
   of ``MIN_WORDS`` words has one, and equal passages have the same one.
   Only the suffixes at these positions are retained, as hashes of their
   first ``GRAM`` and ``LONG`` words.
2. The suffixes are range-sorted by these hashes and each is compared with
   its two neighbours in the order, which share its longest prefix.  The order
   ends with document and position, so a very frequent passage spans tasks.
   A task's first and last suffix count as matched; step 3 decides.
3. Where a suffix matches, its match is extended to the left and the right:
   every window of ``MIN_WORDS`` words around it that the shared prefix can
   cover is hashed whole, and windows that occur in two documents are joined
   to spans.  So the result is exact: a word is repeated if and only if some
   window with it stands in another document too.

Documents of the same words form a class that goes through the steps once;
with two or more members all its words are repeated.

Edge cases.  Null, empty and short texts (under ``MIN_WORDS`` words) have no
passage.  Rows with a null id take no part; rows of one id are one document.
Repetition inside a single document does not count.  Other columns are not read,
whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import blank_words, map_texts
from rehome.llm.minhash import WordHashes, _mix
from rehome.session import materialize

MIN_WORDS = 50
GRAM = 10
LONG = 30
SPREAD = MIN_WORDS - GRAM + 1

_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = max(4096, 2 * n)
        for name, base in (("p", _P), ("i", _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["p"][:n], _POWERS["i"][:n]


class Hashed:
    """Word hashes of a text with the hash of any run of its words."""

    def __init__(self, words: list[bytes], hashes: WordHashes):
        self.n = len(words)
        w = np.fromiter(map(hashes.__getitem__, words), np.uint64, self.n)
        p, self.inverse = _powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(w * p[:self.n], out=self.sums[1:])

    def runs(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` words."""
        k = self.n - size + 1
        if k <= 0:
            return np.empty(0, np.uint64)
        return _mix((self.sums[size:] - self.sums[:-size]) * self.inverse[:k])


def minimisers(grams: np.ndarray, spread: int = SPREAD) -> np.ndarray:
    """Positions that are the (first) smallest of some ``spread`` grams."""
    if len(grams) < spread:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, spread)
    out = []
    for at in range(0, len(views), 8192):
        part = views[at:at + 8192]
        out.append(part.argmin(axis=1) + np.arange(at, at + len(part)))
    return np.unique(np.concatenate(out))


def _suffixes(docs: DataFrame) -> DataFrame:
    fields = [("n_words", "bigint"), ("digest", "binary"), ("pos", "array<int>"),
              ("r0", "array<bigint>"), ("r1", "array<bigint>")]

    def make():
        hashes = WordHashes()

        def one(text):
            words = blank_words(text or b"")
            if len(words) < MIN_WORDS:
                return len(words), None, None, None, None
            h = Hashed(words, hashes)
            grams = h.runs(GRAM)
            at = minimisers(grams)
            longer = np.zeros(len(grams), np.uint64)
            got = h.runs(LONG)
            longer[:len(got)] = got | np.uint64(1)
            return (len(words), hashlib.blake2b(b" ".join(words), digest_size=16).digest(),
                    at.astype(np.int32), grams[at].view(np.int64), longer[at].view(np.int64))
        return lambda texts: [list(c) for c in zip(*[one(t) for t in texts], strict=True)]

    return map_texts(docs, "_text", make, fields, ["_id"])


def _neighbours(rows: DataFrame) -> DataFrame:
    """(_id, pos, level) of the suffixes that share a prefix with a neighbour
    in the sorted order: level 1 for ``GRAM`` words, 2 for ``LONG``."""
    def run(batches):
        held = None  # the last suffix so far and its level towards the left
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            r0, r1, ids, pos = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if held is not None:
                r0, r1, ids, pos = (np.concatenate(([h], c)) for h, c in
                                    zip(held, (r0, r1, ids, pos), strict=False))
            same = r0[1:] == r0[:-1]
            link = np.where(same, np.where((r1[1:] == r1[:-1]) & (r1[1:] != 0), 2, 1), 0)
            left = np.concatenate(([2 if first else held[4] if held is not None else 0], link))
            first = False
            right = np.concatenate((link, [0]))
            level = np.maximum(left, right)[:-1]
            held = (r0[-1], r1[-1], ids[-1], pos[-1], left[-1])
            at = np.flatnonzero(level)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[:-1][at], pa.int64()), pa.array(pos[:-1][at], pa.int32()),
                 pa.array(level[at], pa.int32())], names=["_id", "pos", "level"])
        if held is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[2]], pa.int64()), pa.array([held[3]], pa.int32()),
                 pa.array([2], pa.int32())], names=["_id", "pos", "level"])

    return rows.mapInArrow(run, "_id bigint, pos int, level int")


def _windows(matched: DataFrame) -> DataFrame:
    """Extend every match: (s, h) arrays of the windows it may lie in."""
    schema = "_id bigint, s array<int>, h array<bigint>"

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = [[], [], []]
                for i in range(part.num_rows):
                    words = blank_words(part.column(1)[i].as_py() or b"")
                    n = len(words) - MIN_WORDS + 1
                    if n <= 0:
                        continue
                    pos = np.asarray(part.column(2)[i].values, np.int64)
                    level = np.asarray(part.column(3)[i].values, np.int64)
                    low = np.clip(pos - (SPREAD - 1), 0, n)
                    high = np.where(level == 2, pos, pos - (MIN_WORDS - LONG + 1)) + 1
                    high = np.maximum(np.clip(high, 0, n), low)
                    marks = np.zeros(n + 1, np.int64)
                    np.add.at(marks, low, 1)
                    np.add.at(marks, high, -1)
                    starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                    out[0].append(part.column(0)[i].as_py())
                    out[1].append(starts.astype(np.int32))
                    out[2].append(Hashed(words, hashes).runs(MIN_WORDS)[starts].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int32())),
                     pa.array(out[2], pa.list_(pa.int64()))], names=["_id", "s", "h"])

    return matched.select("_id", "_text", "pos", "level").mapInArrow(run, schema)


def _spans(found: DataFrame) -> DataFrame:
    """Starts of repeated windows joined to (start, end) word spans."""
    def run(batches):
        for batch in batches:
            ids, spans, counts = batch.column(0), [], []
            for i in range(batch.num_rows):
                s = np.unique(np.asarray(batch.column(1)[i].values, np.int64))
                cut = np.flatnonzero(np.diff(s) > MIN_WORDS)
                begin = s[np.concatenate(([0], cut + 1))]
                end = s[np.concatenate((cut, [len(s) - 1]))] + MIN_WORDS
                spans.append(np.stack((begin, end), axis=1).ravel())
                counts.append(int((end - begin).sum()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64()))],
                names=["_id", "n_repeated", "spans"])

    return found.mapInArrow(run, "_id bigint, n_repeated bigint, spans array<bigint>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with a passage that repeats in another document:
    id, n_words, n_repeated (words in such passages), spans (flat start and
    end words, ends exclusive)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"),
                        F.col(f"`{text_col}`").cast("binary").alias("_text")) \
        .where(F.col("_id").isNotNull())
    every = materialize(_suffixes(named).where(F.col("digest").isNotNull()), "suffix-docs")
    classes = materialize(every.groupBy("digest").agg(
        F.min("_id").alias("_one"), F.max("_id").alias("_two")), "suffix-classes")
    one = classes.select("digest", F.col("_one").alias("_id"))
    rows = every.join(one, ["digest", "_id"], "left_semi").select("_id", F.explode(
        F.arrays_zip("pos", "r0", "r1")).alias("x")).select("x.r0", "x.r1", "_id", "x.pos")
    ordered = rows.repartitionByRange(n, "r0", "r1", "_id", "pos") \
        .sortWithinPartitions("r0", "r1", "_id", "pos")
    matched = _neighbours(ordered).groupBy("_id").agg(
        F.collect_list("pos").alias("pos"), F.collect_list("level").alias("level"))
    windows = materialize(_windows(matched.join(named, "_id")), "suffix-windows")
    flat = windows.select("_id", F.explode(F.arrays_zip("s", "h")).alias("x")).select(
        "_id", "x.s", "x.h")
    shared = materialize(flat.groupBy("h").agg(F.min("_id").alias("_a"), F.max("_id").alias("_b"))
                         .where(F.col("_a") < F.col("_b")).select("h"), "suffix-shared")
    found = flat.join(shared, "h", "left_semi").groupBy("_id").agg(
        F.collect_list("s").alias("s"))
    spans = _spans(found)
    # Back to the members of each class.
    of_class = classes.join(spans.withColumnRenamed("_id", "_one"), "_one", "left").select(
        "digest", (F.col("_one") < F.col("_two")).alias("_copied"), "n_repeated", "spans")
    out = every.select("_id", "n_words", "digest").join(of_class, "digest")
    whole = F.col("_copied")
    return out.where(whole | F.col("spans").isNotNull()).select(
        F.col("_id").alias(id_col), "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.col("n_repeated")).alias("n_repeated"),
        F.when(whole, F.array(F.lit(0).cast("bigint"), "n_words")).otherwise(F.col("spans"))
        .alias("spans"))
