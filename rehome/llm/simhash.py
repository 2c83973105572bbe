"""Near-duplicate groups by SimHash and meet-in-the-middle ball hashing.

A document's fingerprint has a bit set where more than half of its shingles'
hashes (XXH64, seed 42, over three lower-cased words joined by a blank,
repeats included) have it set.  Fingerprints link at ``RADIUS`` = 3 or fewer
differing bits.  Equal fingerprints form a class; only distinct ones go on.

Two fingerprints that differ in at most three bits meet in the middle: some
variant is one flip or none away from one of them and at most two flips from
the other.  Two remarks keep the ball of variants small without losing a pair:
fingerprints three bits apart have unequal parity, so only even ones need to
emit two flips; and of three positions two are in the same 32-bit half, so
only pairs of flips within a half are needed.  An even fingerprint emits
1 + 64 + 2 * C(32, 2) = 1,057 variants, an odd one 65.

Variants are dealt to buckets by a linear hash, that is, the bucket of
``x ^ flips`` is ``bucket(x) ^ bucket(flips)``.  So a fingerprint is sent once
to each bucket that any of its variants falls into, in blocks of eight bytes a
fingerprint, and the receiving task makes just the variants of its bucket.  The
number of buckets follows the number of distinct fingerprints, so that a
bucket holds about ``BUCKET_FINGERPRINTS``; within it variants are made and
sorted a slice at a time, about ``SLICE_VARIANTS`` at once.

Equal variants collide.  Whoever is at most one flip away is linked with all
that collide there; the smallest such fingerprint is paired with every other
member of the collision, so a dense group emits stars and never all pairs.
Pairs are made distinct, verified by their bit count and joined to components
by star contraction.

Edge cases.  Null and empty texts have fingerprint zero and link like any
other.  With fewer than three words the whole sequence is the one shingle.
Rows with a null id are linked with nothing (their component is null); rows of
one id are one document for linking, whatever their texts.  Other columns are not read,
whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import blank_words, map_texts
from rehome.llm.components import connected
from rehome.session import DEFAULT_BROADCAST_ROWS, materialize, side

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
HALF = BITS // 2
BUCKET_FINGERPRINTS = 1 << 22
SLICE_VARIANTS = 1 << 20
HASH_BITS = 40
BLOCK = 8192
HASHES_AT_ONCE = 1 << 14

_ONE = np.uint64(1)
_LABELS = np.random.default_rng(20240612).integers(0, 1 << HASH_BITS, BITS, dtype=np.uint64)


def fingerprint(words: list[bytes], size: int = SHINGLE) -> int:
    """64-bit SimHash of the words' shingles, unsigned."""
    if not words:
        return 0
    text = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    last = min(size, len(words)) - 1
    total = np.zeros(BITS, np.int64)
    digest, start, pos = xxhash.xxh64_intdigest, 0, 0
    while pos < n:
        hashes = []
        for i in range(pos, min(n, pos + HASHES_AT_ONCE)):
            hashes.append(digest(text[start:ends[i + last]], SEED))
            start = ends[i] + 1
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
        pos += len(hashes)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def flips() -> tuple[np.ndarray, np.ndarray]:
    """(masks of up to one flip, masks of two flips within a half)."""
    single = _ONE << np.arange(BITS, dtype=np.uint64)
    pairs = [single[a] | single[b] for low in (0, HALF)
             for a in range(low, low + HALF) for b in range(a + 1, low + HALF)]
    return np.concatenate((np.zeros(1, np.uint64), single)), np.array(pairs, np.uint64)


def linear_hash(x: np.ndarray) -> np.ndarray:
    """XOR of the labels of the set bits: ``HASH_BITS`` bits."""
    out = np.zeros(x.shape, np.uint64)
    for bit in range(BITS):
        out ^= np.where((x >> np.uint64(bit)) & _ONE, _LABELS[bit], np.uint64(0))
    return out


def top_bits(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(HASH_BITS - bits)).astype(np.int64)


def is_odd(x: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(x) & 1).astype(bool)


def bucket_bits(fingerprints: int, least: int) -> int:
    """Bits of the bucket number: ``least`` buckets or more, and so many that
    a bucket is sent about ``BUCKET_FINGERPRINTS`` at most."""
    few, many = len(flips()[0]), sum(map(len, flips()))
    bits = max(0, int(least - 1).bit_length())
    while bits < HASH_BITS and fingerprints * min(1.0, (few + many) / 2 / (1 << bits)) \
            > BUCKET_FINGERPRINTS:
        bits += 1
    return bits


def _runs(sorted_values: np.ndarray, wanted: np.ndarray):
    """Positions of all elements equal to each wanted value: (index into
    ``wanted``, position)."""
    lo = np.searchsorted(sorted_values, wanted, "left")
    n = np.searchsorted(sorted_values, wanted, "right") - lo
    which = np.repeat(np.arange(len(wanted)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def colliding_pairs(fps: np.ndarray, bucket: int, bits: int) -> np.ndarray:
    """Verified pairs (rows of two, the smaller first) of the distinct
    fingerprints ``fps`` whose variants collide in the bucket."""
    near, far = flips()
    odd = is_odd(fps)
    estimate = len(fps) * (len(near) + len(far)) / (1 << bits) + 1
    fine = min(HASH_BITS, bits + max(0, int(estimate / SLICE_VARIANTS).bit_length()))
    groups = []
    for members, masks, two in ((fps, near, 0), (fps[~odd], far, 1)):
        code = top_bits(linear_hash(members), fine)
        order = np.argsort(code, kind="stable")
        groups.append((members[order], code[order], masks, top_bits(linear_hash(masks), fine), two))
    pairs = [np.empty((0, 2), np.uint64)]
    for part in range(1 << (fine - bits)):
        here = (bucket << (fine - bits)) | part
        variants, owners, twos = [], [], []
        for members, code, masks, offsets, two in groups:
            which, pos = _runs(code, offsets ^ here)
            owners.append(members[pos])
            variants.append(members[pos] ^ masks[which])
            twos.append(np.full(len(pos), two, np.int8))
        variant, owner, two = map(np.concatenate, (variants, owners, twos))
        order = np.argsort(variant)
        variant = variant[order]
        same = variant[1:] == variant[:-1]
        hit = np.concatenate((same, [False])) | np.concatenate(([False], same))
        if not hit.any():
            continue
        variant, owner, two = variant[hit], owner[order][hit], two[order][hit]
        order = np.lexsort((owner, two, variant))
        variant, owner, two = variant[order], owner[order], two[order]
        first = np.concatenate(([True], variant[1:] != variant[:-1]))
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        linked = ~first & (two[head] == 0)
        a, b = owner[head][linked], owner[linked]
        ok = np.bitwise_count(a ^ b) <= RADIUS
        found = np.stack((np.minimum(a, b)[ok], np.maximum(a, b)[ok]), axis=1)
        pairs.append(np.unique(found, axis=0))
    return np.unique(np.concatenate(pairs), axis=0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _fp as signed long), a row per row of ``docs``."""
    def make():
        def one(text):
            x = fingerprint(blank_words(text or b""))
            return x - (1 << BITS) if x >> (BITS - 1) else x
        return lambda texts: [[one(t) for t in texts]]

    named = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"),
                        F.col(f"`{text_col}`").alias("_text"))
    return map_texts(named, "_text", make, [("_fp", "bigint")], ["_id"])


def links(distinct: DataFrame) -> DataFrame:
    """Verified pairs (x, y) of the distinct fingerprints in column ``_fp``; every two
    fingerprints in ``RADIUS`` are joined by a path of such pairs."""
    n_parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = bucket_bits(distinct.count(), n_parts)
    near, far = flips()

    def deal(batches):
        few = np.unique(top_bits(linear_hash(near), bits))
        many = np.unique(np.concatenate((few, top_bits(linear_hash(far), bits))))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = batch.column(0).slice(at, BLOCK).to_numpy().view(np.uint64)
                code, odd = top_bits(linear_hash(x), bits), is_odd(x)
                to = np.concatenate(((code[odd][:, None] ^ few).ravel(),
                                     (code[~odd][:, None] ^ many).ravel()))
                what = np.concatenate((np.repeat(x[odd], len(few)), np.repeat(x[~odd], len(many))))
                order = np.argsort(to, kind="stable")
                to, what = to[order], what[order]
                starts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(starts, len(to)).astype(np.int32)),
                    pa.array(what.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(to[starts]), lists],
                                                 names=["bucket", "fps"])

    dealt = distinct.select("_fp").mapInArrow(deal, "bucket bigint, fps array<bigint>")
    blocks = dealt.repartition(n_parts, "bucket").sortWithinPartitions("bucket")

    def meet(batches):
        def flush(bucket, parts):
            found = colliding_pairs(np.concatenate(parts), bucket, bits).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])],
                                              names=["x", "y"])
        at, parts = None, []
        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket != at and parts:
                    yield flush(at, parts)
                    parts = []
                at = bucket
                parts.append(np.array(batch.column(1)[i].values).view(np.uint64))
        if parts:
            yield flush(at, parts)

    return blocks.mapInArrow(meet, "x bigint, y bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hexadecimal digits) and component_id (the smallest
    id that is reachable over links) per row."""
    rows = materialize(fingerprints(docs, id_col, text_col), "simhash-rows")
    known = rows.where(F.col("_id").isNotNull())
    classes = materialize(known.groupBy("_fp").agg(
        F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_n")), "simhash-classes")
    pairs = materialize(links(classes), "simhash-links")
    low = classes.select("_fp", "_low")
    edges = (pairs.join(low.select(F.col("_fp").alias("x"), F.col("_low").alias("a")), "x")
             .join(low.select(F.col("_fp").alias("y"), F.col("_low").alias("b")), "y")
             .select("a", "b"))
    # An id with several fingerprints belongs to all their classes.
    several = known.groupBy("_id").agg(F.min("_fp").alias("_f"), F.max("_fp").alias("_g")) \
        .where(F.col("_f") != F.col("_g")).select("_id")
    own = known.join(several, "_id", "left_semi").distinct().join(low, "_fp").select(
        F.col("_id").alias("a"), F.col("_low").alias("b"))
    labels = connected(edges.unionByName(own))
    # Only classes with copies or links need a lookup.
    component = low.join(labels.withColumnRenamed("node", "_low"), "_low", "left")
    shared = component.join(classes.select("_fp", "_n"), "_fp").where(
        (F.col("_n") > 1) | F.col("component").isNotNull()).select(
        "_fp", F.coalesce("component", "_low").alias("_component"))
    shared = side(materialize(shared, "simhash-components"), DEFAULT_BROADCAST_ROWS)
    out = known.join(shared, "_fp", "left").select(
        "_id", "_fp", F.coalesce("_component", "_id").alias("component_id"))
    out = out.unionByName(rows.where(F.col("_id").isNull()).select(
        "_id", "_fp", F.lit(None).cast("bigint").alias("component_id")))
    return out.select(F.col("_id").alias(id_col),
                      F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")
