"""Runs of periodic words by recursive frequency splitting.

A run is a maximal stretch of consecutive words with smallest period ``q``
and at least ``max(MIN_WORDS, 2 q)`` words.  Each of its words stands in it
twice or more.  So, per document:

1. words are numbered, and a word that occurs only once in a segment splits
   it: no run can hold it.  The parts are segments of their own, in which more
   words have become too rare; parts under ``MIN_WORDS`` go.  This recurs until
   every word of every segment is repeated in it.  A split counts the smaller
   parts anew and subtracts them from the largest, so the whole recursion takes
   n log n steps however deep it goes.
2. surviving segments are scanned lag by lag.  A run of period ``q`` covers two
   neighbouring multiples of ``q``, so lag ``q`` compares the words at those
   multiples only (n / q of them).  Where they and some of the words beside
   them are equal, the equal stretch is measured to both sides by ranks of the
   segment's 1, 2, 4, ... word pieces, which compare pieces exactly.
   A stretch found with several lags has the smallest as its period.

Edge cases.  Null and empty texts have no words and no run.  Documents are
judged one by one, so repeated rows give repeated results; the length of a
text is not limited (memory is some 100 bytes a word and level of ranks).
Other columns are not part of the judgement, whatever their names, and an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import map_texts

MIN_WORDS = 12
# Pairs of words compared at a time.
SCAN = 1 << 20


def _parts(lo: int, hi: int, cuts) -> list[tuple[int, int]]:
    """The parts of [lo, hi) between the sorted positions ``cuts``."""
    out, at = [], lo
    for c in cuts:
        if c > at:
            out.append((at, c))
        at = c + 1
    if hi > at:
        out.append((at, hi))
    return out


def _count(ids: list, lo: int, hi: int) -> dict:
    counts: dict = {}
    for w in ids[lo:hi]:
        counts[w] = counts.get(w, 0) + 1
    return counts


def segments(ids: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Maximal segments [lo, hi) of ``min_words`` or more words each of which
    occurs twice or more in its segment, in text order."""
    counts = np.bincount(ids)
    cuts = np.flatnonzero(counts[ids] < 2)
    todo = [(lo, hi) for lo, hi in _parts(0, len(ids), cuts.tolist()) if hi - lo >= min_words]
    if not len(cuts) or not todo:
        return todo
    words = ids.tolist()
    places: dict = {}
    for lo, hi in todo:
        for i in range(lo, hi):
            places.setdefault(words[i], []).append(i)
    done = []
    todo = [(lo, hi, _count(words, lo, hi), None) for lo, hi in todo]
    while todo:
        lo, hi, counts, suspects = todo.pop()
        rare = [w for w in (counts if suspects is None else suspects) if counts.get(w) == 1]
        if not rare:
            done.append((lo, hi))
            continue
        cuts = sorted(places[w][bisect_left(places[w], lo)] for w in rare)
        parts = _parts(lo, hi, cuts)
        if not parts:
            continue
        big = max(parts, key=lambda p: p[1] - p[0])
        changed = set(rare)
        for w in rare:
            del counts[w]
        for part in parts:
            if part == big:
                continue
            own = _count(words, *part)
            for w, n in own.items():
                counts[w] -= n
                if not counts[w]:
                    del counts[w]
            changed.update(own)
            if part[1] - part[0] >= min_words:
                todo.append((*part, own, None))
        if big[1] - big[0] >= min_words:
            todo.append((*big, counts, changed))
    return sorted(done)


class Pieces:
    """Exact lengths of equal stretches of one segment, by ranks of its pieces
    of 1, 2, 4, ... words."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.ranks = [ids]
        size = 1
        while 2 * size <= longest and len(self.ranks[-1]) > size:
            last = self.ranks[-1].astype(np.int64)
            both = last[:-size] * (int(last.max()) + 1) + last[size:]
            self.ranks.append(np.unique(both, return_inverse=True)[1].astype(np.int32))
            size *= 2
        self.n = len(ids)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j > i on."""
        got = np.zeros(len(i), np.int64)
        last = len(self.ranks) - 1
        for level in [last] * (1 + self.n // (1 << last)) + list(range(last - 1, -1, -1)):
            rank, size = self.ranks[level], 1 << level
            fits = np.flatnonzero(j + got + size <= self.n)
            same = rank[i[fits] + got[fits]] == rank[j[fits] + got[fits]]
            if not same.any() and level == last:
                continue
            got[fits[same]] += size
        return got

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words that end just before i and j > i."""
        got = np.zeros(len(i), np.int64)
        last = len(self.ranks) - 1
        for level in [last] * (1 + self.n // (1 << last)) + list(range(last - 1, -1, -1)):
            rank, size = self.ranks[level], 1 << level
            fits = np.flatnonzero(i - got >= size)
            same = rank[i[fits] - got[fits] - size] == rank[j[fits] - got[fits] - size]
            got[fits[same]] += size
        return got


def _equal_multiples(ids: np.ndarray, min_words: int):
    """(q, i): lags and multiples i of the lag with equal words at i and i + q
    and, so far as cheap to tell, in enough of the words beside them."""
    n = len(ids)
    lag = 1
    while 2 * lag <= n:
        # As many lags as make about SCAN comparisons.
        stop, pairs = lag, 0
        while 2 * stop <= n and (stop == lag or pairs + n // stop <= SCAN):
            pairs += n // stop
            stop += 1
        lags = np.arange(lag, stop)
        per = (n - 1) // lags  # multiples 0, q, ... with i + q < n
        q = np.repeat(lags, per)
        i = (np.arange(len(q)) - np.repeat(np.cumsum(per) - per, per)) * q
        keep = ids[i] == ids[i + q]
        q, i = q[keep], i[keep]
        # The equal stretch must have max(q, min_words - q) words, so at least
        # half of min_words: look at the words on both sides one by one.
        before, after = np.zeros(len(q), np.int64), np.ones(len(q), np.int64)
        need = np.maximum(q, min_words - q)
        half = (min_words + 1) // 2
        open_b = open_a = np.ones(len(q), bool)
        for step in range(1, half):
            at = i - step
            open_b = open_b & (at >= 0)
            open_b = open_b & (ids[np.where(open_b, at, 0)] == ids[np.where(open_b, at + q, 0)])
            before += open_b
            at = i + step
            open_a = open_a & (at + q < n)
            open_a = open_a & (ids[np.where(open_a, at, 0)]
                               == ids[np.where(open_a, at + q, 0)])
            after += open_a
            alive = open_a | open_b | (before + after >= need)
            if not alive.all():
                q, i, need, before, after, open_b, open_a = (
                    x[alive] for x in (q, i, need, before, after, open_b, open_a))
        if len(q):
            yield q, i
        lag = stop


def segment_runs(ids: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of a segment's runs, by start and period."""
    found: dict[tuple[int, int], int] = {}
    pieces = None
    for q, i in _equal_multiples(ids, min_words):
        if pieces is None:
            pieces = Pieces(np.unique(ids, return_inverse=True)[1].astype(np.int32),
                            len(ids) // 2)
        ahead, behind = pieces.ahead(i, i + q), pieces.behind(i, i + q)
        long = ahead + behind >= np.maximum(q, min_words - q)
        if not long.any():
            continue
        start = i[long] - behind[long]
        length = ahead[long] + behind[long] + q[long]
        # Lags ascend, so the first of a stretch's lags is its smallest.
        _, first = np.unique(start * (len(ids) + 1) + length, return_index=True)
        for k in first.tolist():
            found.setdefault((int(start[k]), int(length[k])), int(q[long][k]))
    return sorted((s, size, period) for (s, size), period in found.items())


def number_words(words: list) -> np.ndarray:
    numbers: dict = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def find_runs(words: list, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < min_words:
        return []
    ids = number_words(words)
    out = []
    for lo, hi in segments(ids, min_words):
        out += [(lo + s, size, q) for s, size, q in segment_runs(ids[lo:hi], min_words)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def periodic_runs(docs: DataFrame, text_col: str = "text", keep=("doc_id",),
                  min_words: int = MIN_WORDS) -> DataFrame:
    """``keep`` columns, ``runs`` (array of start, length, period, by start and
    period) and ``collapsed`` (the text's other words, joined by a blank)."""
    def make():
        def one(text):
            words = (text or b"").split()
            runs = find_runs(words, min_words)
            starts, lengths, periods = (list(c) for c in zip(*runs)) if runs else ([], [], [])
            return (starts, lengths, periods,
                    b" ".join(collapse(words, runs)).decode("utf-8", "replace"))
        return lambda texts: [list(c) for c in zip(*[one(t) for t in texts], strict=True)]

    fields = [("_start", "array<bigint>"), ("_length", "array<bigint>"),
              ("_period", "array<bigint>"), ("_collapsed", "string")]
    # The row travels as one struct, so that its column names cannot clash.
    out = map_texts(docs, text_col, make, fields, row=True)
    runs = F.arrays_zip(F.col("_start").alias("start"), F.col("_length").alias("length"),
                        F.col("_period").alias("period"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], runs.alias("runs"),
                      F.col("_collapsed").alias("collapsed"))
