"""Operator 13 against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from rehome.llm import periodic
from rehome.llm.queries import QUERIES


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1)
                if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute_runs(w, min_words=12):
    """Every maximal stretch by definition."""
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_words, 2 * q) and j > i and smallest_period(w[i:j + q]) == q:
                out.add((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(w, runs):
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    return [x for i, x in enumerate(w) if i not in drop]


def texts(seed):
    rng = random.Random(seed)
    out = [[], ["a"] * 11, ["a"] * 12, ["a"] * 40, list("ab" * 6), list("abc" * 4), list("abc" * 3)]
    for _ in range(60):
        n, k = rng.randint(1, 120), rng.choice([1, 2, 3, 5, 30])
        out.append([rng.choice("abcdefghijklmnopqrstuvwxyz0123456789"[:k]) for _ in range(n)])
    for _ in range(60):  # planted runs in noise, nested and side by side
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [f"n{rng.randrange(50)}" for _ in range(rng.randint(0, 15))]
            block = [f"b{rng.randrange(rng.choice([2, 9]))}" for _ in range(rng.randint(1, 14))]
            w += (block * 6)[:rng.randint(2, 6) * len(block) + rng.randint(0, 3)]
        out.append(w)
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    while len(thue) < 256:
        thue += thue.translate(str.maketrans("ab", "ba"))
    return out + [list(fib[-1]), list(thue), list(thue + thue)]


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(seed):
    for w in texts(seed):
        want = brute_runs(w)
        assert periodic.find_runs(w) == want, w
        assert periodic.collapse(w, want) == brute_collapse(w, want)


def test_other_minimum_and_small_scans(monkeypatch):
    monkeypatch.setattr(periodic, "SCAN", 7)
    for w in texts(9)[:60]:
        for least in (2, 5, 12):
            assert periodic.find_runs(w, least) == brute_runs(w, least), (w, least)


def test_segments_are_stable_and_hold_every_run():
    for w in texts(4):
        if not w:
            continue
        ids = periodic.number_words(w)
        got = periodic.segments(ids)
        for lo, hi in got:
            assert hi - lo >= 12 and np.bincount(ids[lo:hi])[ids[lo:hi]].min() >= 2
        for s, size, _ in brute_runs(w):
            assert any(lo <= s and s + size <= hi for lo, hi in got)


def test_deep_recursion_and_long_texts_stay_fast():
    t0 = time.perf_counter()
    n = 60_000
    chain = [x for i in range(n) for x in (i, i + 2)]  # splits cascade one by one
    assert periodic.find_runs(chain) == []
    assert periodic.find_runs(["a"] * 200_000) == [(0, 200_000, 1)]
    block = [f"w{i}" for i in range(50_000)]
    assert periodic.find_runs(["x"] + block * 3 + ["y"]) == [(1, 150_000, 50_000)]
    rng = random.Random(1)
    assert periodic.find_runs([rng.randrange(300) for _ in range(300_000)]) == []
    assert time.perf_counter() - t0 < 60


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(brute_collapse(w, runs)).encode()).hexdigest())


def test_query_equals_brute_force_on_every_kind_of_row(spark, tmp_path):
    rng = random.Random(5)
    docs = [(i, " ".join(w)) for i, w in enumerate(texts(7))]
    docs += [(1000 + i, rng.choice(["\t", " \n ", "  "]).join(
        rng.choice(["Ä", "a", "A", "ß", " x", "\x1cq"]) for _ in range(rng.randint(1, 40))))
        for i in range(80)]
    docs += [(2000, None), (2001, ""), (2002, " \t\n"), (3, "repeated id " * 9), (3, "x")]
    df = spark.createDataFrame([(*d, "r", "c", 1) for d in docs],
                               "doc_id long, text string, runs string, row string, n long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        (brute_row(*d) for d in docs), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs)


def test_null_id_and_empty_table_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, runs string, collapsed string, _start string, row string"
    rows = [(None, "a " * 30, "r", "c", "s", "row")]
    out = periodic.periodic_runs(spark.createDataFrame(rows, schema), keep=("doc_id", "row")).first()
    assert out["doc_id"] is None and out["row"] == "row" and out["collapsed"] == "a"
    assert [tuple(r) for r in out["runs"]] == [(0, 30, 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert QUERIES["op13_periodic"](spark, f"{tmp_path}/a").first()["n_runs"] == 1
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert QUERIES["op13_periodic"](spark, f"{tmp_path}/b").collect() == []
