"""Operator 12 against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from rehome.llm import simhash
from rehome.llm.queries import QUERIES
from tests.llm.test_corpus_operators import components


def brute_fingerprint(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x)
         for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """Rows of one id are one document; ids of null stand alone."""
    nodes = sorted({i for i, _ in rows if i is not None})
    fps = [(i, brute_fingerprint(t)) for i, t in rows if i is not None]
    links = [(a, b) for a, x in fps for b, y in fps if a < b and (x ^ y).bit_count() <= 3]
    return components(nodes, links)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Ä", "Übung", "A", "a"]
    docs = ["", None, " \n\t", "one", "ONE", "one two", "one  two", "one two three"]
    for _ in range(30):
        docs.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))))
    for _ in range(5):
        base = [rng.choice(words) for _ in range(rng.randint(80, 300))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    return list(enumerate(docs, 50))


@pytest.mark.parametrize("seed", range(2))
def test_groups_equal_brute_force(spark, seed):
    docs = corpus(seed)
    out = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    groups = brute_groups(docs)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out) == sorted(
        (i, f"{brute_fingerprint(t):016x}", groups[i]) for i, t in docs)
    assert len(set(groups.values())) < len(docs) - 20


def test_fingerprint_of_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(3000))
    whole = simhash.fingerprint(text.encode().split())
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert simhash.fingerprint(text.encode().split()) == whole == brute_fingerprint(text)


def near_fingerprints(rng, n):
    """Random ones and, around each, others one to five bits away, in both halves."""
    out = [0, (1 << 64) - 1, 7, 11, 1 << 63]
    for _ in range(n):
        x = rng.getrandbits(64)
        out.append(x)
        for _ in range(6):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 5)):
                y ^= 1 << b
            out.append(y)
    return sorted(set(out))


def brute_pairs(fps):
    return [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 3]


@pytest.mark.parametrize("bits", [0, 3, 7])
def test_buckets_together_lose_no_link(monkeypatch, bits):
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", 5000)
    fps = near_fingerprints(random.Random(bits), 40)
    found = set()
    for bucket in range(1 << bits):
        found |= {tuple(map(int, p))
                  for p in simhash.colliding_pairs(np.array(fps, np.uint64), bucket, bits)}
    want = brute_pairs(fps)
    assert found <= set(want)
    assert components(fps, sorted(found)) == components(fps, want)


def test_every_difference_of_three_bits_or_less_collides():
    """Each pair alone, so that no third fingerprint can join it."""
    rng = random.Random(3)
    for size in (1, 2, 3):
        for _ in range(60):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(range(64), size):
                y ^= 1 << b
            got = simhash.colliding_pairs(np.array([x, y], np.uint64), 0, 0)
            assert got.tolist() == [sorted((x, y))]
    x = rng.getrandbits(64)
    assert len(simhash.colliding_pairs(np.array([x, x ^ 15], np.uint64), 0, 0)) == 0


def test_dense_groups_emit_stars(spark, monkeypatch):
    """4,000 fingerprints within a few bits: linear in them, not all pairs."""
    monkeypatch.setattr(simhash, "BUCKET_FINGERPRINTS", 500)
    rng = random.Random(8)
    fps = set()
    while len(fps) < 4000:
        x = 0x5555AAAA5555AAAA
        for b in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << b
        fps.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "_fp long")
    rows = [tuple(r) for r in simhash.links(df).collect()]
    assert all(((x ^ y) & (1 << 64) - 1).bit_count() <= 3 for x, y in rows)
    assert len(set(components(sorted(fps), rows).values())) == 1
    assert len(rows) < 200 * len(fps)


def test_bucket_number_follows_the_fingerprints():
    assert simhash.bucket_bits(0, 1) == 0 and simhash.bucket_bits(10, 200) == 8
    limit = simhash.BUCKET_FINGERPRINTS
    for n in (10 ** 6, 10 ** 8, 10 ** 10):
        assert n * min(1, 561 / 2 ** simhash.bucket_bits(n, 8)) <= limit


def test_rows_of_one_id_null_ids_and_extra_columns(spark):
    rng = random.Random(2)
    a, b, c = (" ".join(f"{x}{rng.randrange(999)}" for _ in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b), (7, b), (9, c), (None, a), (None, None), (11, "")]
    schema = "doc_id long, text string, _id string, _fp string, component_id string, row string"
    df = spark.createDataFrame([(*r, "i", "f", "c", "r") for r in rows], schema)
    out = simhash.near_duplicates(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(((r["doc_id"], r["component_id"]) for r in out.collect()), key=str) == sorted(
        [(3, 3), (5, 3), (5, 3), (7, 3), (7, 3), (9, 9), (None, None), (None, None), (11, 11)],
        key=str)


def test_empty_table_and_query(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    docs = corpus(4)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_simhash"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_groups(docs)
