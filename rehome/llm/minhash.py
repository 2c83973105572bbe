"""Near-duplicate groups by b-bit MinHash.

A document is the set of its distinct five-word shingles (lower-cased A-Z,
blank-separated words; all words as one shingle if there are fewer).  Steps:

1. One scan computes per document the set's size, a digest of its words, band
   keys from the ``BANDS * ROWS`` minima, and the packed signature: the low
   ``BITS`` bits of every minimum.  Documents of the same words form a class;
   its smallest id stands for it, and only classes go on.
2. Classes that share a band key are candidates.  Every class is paired with
   the smallest of each of its buckets; pairs whose collision-corrected
   similarity (equal lanes counted by bit operations on the packed words) is
   far below the threshold drop out, the rest is confirmed on the full sets.
3. Connected components of the confirmed links.
4. The exact rest: in buckets that still hold several components, all pairs
   across components are compared block by block, on the packed signatures and
   then on the sets themselves; only pairs that are similar leave a block.
   They are confirmed on the full sets, and components are joined.  So no link
   is lost to the star pairs of step 2, whatever a bucket's size.  Buckets of
   the same members are compared once, and a pair only in its first bucket.

Links missed by chance: a pair at the threshold shares no band with
probability (1 - 0.85^4)^32 = 6e-11 (5e-8 at 0.8), and the estimate is off by the allowed
slack with probability below 1e-6.

Edge cases.  Documents without words have the empty set and are linked with
nothing, as are rows with a null id (their component is null, kept true).
Rows of one id are one document for linking, whatever their texts (two texts
of one id link whatever is near either of them), and returned row by row.
Other columns of the table are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import blank_words, map_texts
from rehome.llm.components import connected
from rehome.session import fits, materialize

SHINGLE = 5
PERCENT = 85
BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
LANES = HASHES * BITS // 64
SLACK = 0.16
BLOCK = 2048
BLOCK_VALUES = 1 << 21
CHUNK = 256

_rng = np.random.default_rng(20240131)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_POLY = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word, remembered for the frequent ones."""

    def __missing__(self, word):
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 1 << 19:
            self[word] = h
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def shingle_set(words: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - size + 1)
    h = np.full(n, len(words) if len(w) < size else size, np.uint64)
    for i in range(min(size, len(w))):
        h = _mix(h * _POLY + w[i:i + n])
    return np.unique(h)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash over the set."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 2048):
        part = (h[at:at + 2048][None, :] ^ _XOR[:, None]) * _MUL[:, None]
        np.minimum(out, part.min(axis=1), out)
    return out


def signature(mins: np.ndarray) -> tuple[list[int], list[int]]:
    """(band keys, packed low bits) as signed longs."""
    m = mins.astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = _mix(keys * _POLY + m[i::ROWS])
    low = _mix(m * _POLY) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    shifts = (np.arange(per, dtype=np.uint64) * np.uint64(BITS))
    packed = np.bitwise_or.reduce(low.reshape(LANES, per) << shifts, axis=1)
    return keys.view(np.int64).tolist(), packed.view(np.int64).tolist()


def estimate(equal_lanes, hashes: int = HASHES, bits: int = BITS):
    """Similarity from equal lanes, corrected for lanes equal by chance."""
    chance = 2.0 ** -bits
    return (equal_lanes / hashes - chance) / (1.0 - chance)


def min_equal(percent: int, hashes: int = HASHES, bits: int = BITS) -> int:
    """Equal lanes that a pair at the threshold has but for about one in 10^6."""
    chance = 2.0 ** -bits
    return int(np.ceil(((percent / 100 - SLACK) * (1 - chance) + chance) * hashes))


_LOW_BITS = 0x1111111111111111


def equal_lanes(a: Column, b: Column) -> Column:
    """Number of equal lanes of two packed signatures, by bit counts."""
    total = None
    for i in range(LANES):
        x = a.getItem(i).bitwiseXOR(b.getItem(i))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = F.bit_count(x.bitwiseAND(F.lit(_LOW_BITS)))
        total = differ if total is None else total + differ
    return F.lit(HASHES) - total


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    fields = [("n_shingles", "bigint"), ("digest", "binary"), ("bands", "array<bigint>"),
              ("sig", "array<bigint>")]

    def make():
        hashes = WordHashes()

        def one(text):
            words = blank_words(text or b"")
            if not words:
                return 0, None, None, None
            s = shingle_set(words, hashes)
            keys, packed = signature(minima(s))
            return len(s), hashlib.blake2b(b" ".join(words), digest_size=16).digest(), keys, packed
        return lambda texts: [list(c) for c in zip(*[one(t) for t in texts], strict=True)]

    named = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"),
                        F.col(f"`{text_col}`").alias("_text"))
    return map_texts(named, "_text", make, fields, ["_id"])


def texts_of(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text as bytes) of the documents, where the ids are proven few
    enough to broadcast only of those ids: other texts are not shuffled then."""
    named = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"),
                        F.col(f"`{text_col}`").cast("binary").alias("_text"))
    return named.join(F.broadcast(ids), "_id", "left_semi") if fits(ids) else named


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str,
            percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Pairs are dealt by ``b`` in chunks of members; a task streams its rows in
    order and holds one ``b`` set at a time.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n"))
    dealt = pairs.join(sizes, "b").withColumn(
        "_chunk", F.pmod(F.xxhash64("a"), F.floor(F.col("_n") / CHUNK) + 1)).drop("_n")
    dealt = materialize(dealt.select("a", "b", "_chunk"), "minhash-pairs")
    need = (dealt.select(F.col("a").alias("_id"), "b", "_chunk", F.lit(1).alias("_member"))
            .unionByName(dealt.select(F.col("b").alias("_id"), "b", "_chunk",
                                      F.lit(0).alias("_member")).distinct()))
    texts = texts_of(need.select("_id").distinct(), docs, id_col, text_col)
    rows = (need.join(texts, "_id").repartition(n, "b", "_chunk")
            .sortWithinPartitions("b", "_chunk", "_member")
            .select("_id", "b", "_chunk", "_member", "_text"))

    def run(batches):
        hashes, at, base = WordHashes(), None, None
        for batch in batches:
            ids, bs, chunks, members = (batch.column(i).to_pylist() for i in range(4))
            a_out, b_out = [], []
            for i in range(batch.num_rows):
                s = shingle_set(blank_words(batch.column(4)[i].as_py() or b""), hashes)
                if not members[i]:
                    at, base = (bs[i], chunks[i]), s
                    continue
                if at != (bs[i], chunks[i]) or not len(s) or not len(base):
                    continue
                small, large = (s, base) if len(s) < len(base) else (base, s)
                if 100 * len(small) < percent * len(large):
                    continue
                pos = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[pos] == small).sum())
                if 100 * both >= percent * (len(s) + len(base) - both):
                    a_out.append(ids[i])
                    b_out.append(bs[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def short_sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, set): 32-bit shingle hashes of the documents with these ids."""
    def make():
        hashes = WordHashes()

        def one(text):
            s = shingle_set(blank_words(text or b""), hashes)
            return np.unique((s >> np.uint64(32)).astype(np.uint32)).view(np.int32)
        return lambda texts: [[one(t) for t in texts]]

    texts = texts_of(ids, docs, id_col, text_col).join(ids, "_id", "left_semi")
    return map_texts(texts, "_text", make, [("set", "array<int>")], ["_id"])


def cross_pairs(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Similar pairs across components within buckets.

    ``rows``: bucket key and band, id, component, signature, all band keys
    (32 bits each), set, and whether the row is outside its bucket's leading
    component (``_odd``).  Odd rows meet every block of their bucket; neither
    side of a meeting exceeds about ``BLOCK`` rows, or ``BLOCK_VALUES`` set
    values (a row larger than that counts as one).
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    enough = min_equal(percent)
    size = F.size("set").cast("bigint")
    counts = materialize(rows.groupBy("_k").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("_odd").cast("bigint")).alias("_m"),
        F.sum(size).alias("_nv"), F.sum(F.when(F.col("_odd"), size).otherwise(0)).alias("_mv")),
        "minhash-counts")
    rows = rows.join(counts, "_k")
    blocks = F.greatest(F.floor(F.col("_n") / BLOCK), F.floor(F.col("_nv") / BLOCK_VALUES)) + 1
    chunks = F.greatest(F.floor(F.col("_m") / BLOCK), F.floor(F.col("_mv") / BLOCK_VALUES)) + 1
    own = F.xxhash64("_id")
    cols = ["_k", "_band", "_id", "_c", "sig", "keys", "set"]
    base = rows.select(*cols, F.lit(0).alias("_side"), F.pmod(own, blocks).alias("_x"),
                       F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("_y"))
    odd = rows.where("_odd").select(
        *cols, F.lit(1).alias("_side"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("_x"),
        F.pmod(own, chunks).alias("_y"))
    met = (base.unionByName(odd).repartition(n, "_k", "_x", "_y")
           .sortWithinPartitions("_k", "_x", "_y")
           .select("_k", "_x", "_y", "_band", "_side", "_id", "_c", "sig", "keys", "set"))

    def compare(group):
        band = group[0][0]
        side = np.array([r[1] for r in group])
        ids = np.array([r[2] for r in group], np.int64)
        comp = np.array([r[3] for r in group], np.int64)
        sig = np.stack([r[4] for r in group]).view(np.uint64)
        keys = np.stack([r[5] for r in group])[:, :band]
        sets = [r[6].view(np.uint32) for r in group]
        left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        one = np.uint64(_LOW_BITS)
        for i in left:
            x = sig[right] ^ sig[i]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            same = HASHES - np.bitwise_count(x & one).sum(axis=1)
            near = right[(same >= enough) & (comp[right] != comp[i])]
            if band:  # pairs that met in an earlier band are done there
                near = near[~(keys[near] == keys[i]).any(axis=1)]
            for j in near:
                small, large = (i, j) if len(sets[i]) < len(sets[j]) else (j, i)
                a, b = sets[small], sets[large]
                if 100 * (len(a) + 1) < percent * len(b):
                    continue
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum()) + 1  # 32-bit hashes may merge shingles
                if 100 * both >= percent * (len(a) + len(b) - both):
                    yield int(max(ids[i], ids[j])), int(min(ids[i], ids[j]))

    def run(batches):
        key, group = None, []

        def flush():
            found = sorted(set(compare(group))) if len(group) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in found], pa.int64()),
                 pa.array([p[1] for p in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            plain = [batch.column(i).to_pylist() for i in range(7)]
            lists = [batch.column(i) for i in range(7, 10)]
            for i in range(batch.num_rows):
                now = tuple(c[i] for c in plain[:3])
                if now != key:
                    if group:
                        yield flush()
                    key, group = now, []
                group.append((*(c[i] for c in plain[3:]),
                              *(np.array(c[i].values) for c in lists)))
        if group:
            yield flush()

    return met.mapInArrow(run, "a bigint, b bigint").distinct()


def unsettled(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (_k, _band, _id, _c, _odd) of the buckets of three or more that hold
    several components; of buckets of the same members the first band's.  The
    leading component of a bucket is its most frequent one."""
    full = placed.where(F.col("_n") > 2).join(
        labels.withColumnRenamed("node", "_id"), "_id", "left")
    full = materialize(full.select("_k", "_band", "_id",
                                   F.coalesce("component", "_id").alias("_c")), "minhash-full")
    lead = full.groupBy("_k", "_c").agg(F.count(F.lit(1)).alias("_n")).groupBy("_k").agg(
        F.max_by("_c", F.struct("_n", -F.col("_c"))).alias("_lead"),
        F.count(F.lit(1)).alias("_comps"))
    wide = "decimal(38,0)"
    members = full.groupBy("_k").agg(
        F.min("_band").alias("_band"), F.count(F.lit(1)).alias("_n"),
        F.sum(F.xxhash64("_id").cast(wide)).alias("_h1"),
        F.sum(F.xxhash64(F.lit(1), "_id").cast(wide)).alias("_h2"))
    once = (members.join(lead.where(F.col("_comps") > 1), "_k")
            .groupBy("_n", "_h1", "_h2").agg(F.min(F.struct("_band", "_k", "_lead")).alias("_one")))
    once = materialize(once.select("_one._k", "_one._lead"), "minhash-mixed")
    return full.join(once, "_k").select("_k", "_band", "_id", "_c",
                                        (F.col("_c") != F.col("_lead")).alias("_odd"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id that
    is reachable over links), kept (whether the row is that document).

    Documents are linked if ``100 * intersection >= percent * union``; the
    bands are made for ``percent`` of 80 or more.
    """
    if percent < 80:
        raise ValueError("the bands are made for a similarity of 80 percent or more")
    sigs = materialize(signatures(docs, id_col, text_col), "minhash-signatures")
    known = sigs.where(F.col("_id").isNotNull() & F.col("digest").isNotNull())
    classes = known.groupBy("digest").agg(
        F.min(F.struct("_id", "sig", "bands")).alias("_one"))
    classes = materialize(classes.select("digest", F.col("_one._id").alias("_id"),
                                         F.col("_one.sig").alias("sig"),
                                         F.col("_one.bands").alias("bands")), "minhash-classes")

    banded = classes.select("_id", "sig", F.posexplode("bands").alias("_band", "_key"))
    banded = banded.select("_id", F.xxhash64("_band", "_key").alias("_k"), "_band")
    buckets = banded.groupBy("_k").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # Written, so that the join below can split the rows of a hot bucket.
    buckets = materialize(buckets.where(F.col("_n") > 1), "minhash-keys")
    placed = materialize(banded.join(buckets, "_k"), "minhash-buckets")
    slim = classes.select("_id", "sig")
    star = placed.where(F.col("_id") != F.col("_first")).select(
        F.col("_id").alias("a"), F.col("_first").alias("b")).distinct()
    star = star.join(slim.select(F.col("_id").alias("a"), F.col("sig").alias("_sa")), "a") \
        .join(slim.select(F.col("_id").alias("b"), F.col("sig").alias("_sb")), "b")
    star = materialize(star.where(equal_lanes(F.col("_sa"), F.col("_sb")) >= min_equal(percent))
                       .select("a", "b"), "minhash-star")
    links = confirm(star, docs, id_col, text_col, percent)
    # An id with several texts belongs to all their classes.
    several = known.groupBy("_id").agg(F.min("digest").alias("_d"), F.max("digest").alias("_e")) \
        .where(F.col("_d") != F.col("_e")).select("_id")
    own = known.select("_id", "digest").join(several, "_id", "left_semi").distinct().join(
        classes.select("digest", F.col("_id").alias("b")), "digest").select(
        F.col("_id").alias("a"), "b")
    links = materialize(links.unionByName(own), "minhash-links")
    labels = connected(links)  # (node, component) of linked nodes

    rows = materialize(unsettled(placed, labels), "minhash-unsettled")
    if not rows.isEmpty():
        ids = rows.select("_id").distinct()
        sets = materialize(short_sets(ids, docs, id_col, text_col), "minhash-sets")
        facts = classes.select("_id", "sig", F.transform(
            "bands", lambda x: F.shiftright(x, 32).cast("int")).alias("keys"))
        rest = materialize(cross_pairs(rows.join(facts, "_id").join(sets, "_id"), percent)
                           .join(star, ["a", "b"], "left_anti"), "minhash-rest")
        if not rest.isEmpty():
            more = materialize(confirm(rest, docs, id_col, text_col, percent), "minhash-more")
            labels = connected(links.unionByName(more))

    of_class = classes.select("digest", "_id").join(
        labels.withColumnRenamed("node", "_id"), "_id", "left").select(
        "digest", F.coalesce("component", "_id").alias("_component"))
    linked = known.select("_id", "n_shingles", "digest").join(of_class, "digest").select(
        "_id", "n_shingles", F.col("_component").alias("component_id"))
    alone = sigs.where(F.col("_id").isNull() | F.col("digest").isNull()).select(
        "_id", "n_shingles", F.col("_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("_id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))
