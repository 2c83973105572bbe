"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the benchmark's word windows.  For all patterns of one length
``n`` a table gives, for a block of two words, how far the search may jump
ahead; only where the jump is 0 the block's bucket of patterns is compared
word by word.  A word that no pattern contains lets the search jump ``n``.

The benchmark may have any size.  Its distinct items are dealt by hash to
blocks of about ``BLOCK_BYTES`` of text; only one block's tables exist at a
time, in the driver and as a broadcast.  Up to one block, a benchmark is
searched in one scan.  A larger one takes a scan of the documents per block:
rows get a number that is written with them, each scan writes the rows that it
hits, and the hit ranges of all scans are merged per row.  An item larger than
a block is a block of its own.

Edge cases.  Null or empty texts have no words.  Items without words have no
windows.  A null item id marks words as hit but is not named among the items.
Repeated documents and items are judged alike, row by row.  An empty
table gives an empty result.  Extra columns go along by ``keep`` or ``row``, whatever their names
(see ``common.map_texts``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import alnum_words, kept_names, map_texts
from rehome.session import materialize

WINDOW = 10
# Benchmark text per broadcast block; a block holds at most about this much
# (tables take some 30 bytes of memory per byte of text).
BLOCK_BYTES = 4 << 20

FIELDS = [("n_words", "bigint"), ("n_hit", "bigint"), ("items", "array<string>"),
          ("hits", "array<int>")]


def windows(words: list[bytes], size: int = WINDOW) -> list[tuple]:
    """The windows of one item: ``size`` consecutive words, or all of fewer."""
    if not words:
        return []
    if len(words) <= size:
        return [tuple(words)]
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


def build_tables(items: list[tuple], size: int = WINDOW) -> list[dict]:
    """Search tables per pattern length from (item_id, text bytes) pairs."""
    by_len: dict[int, dict[tuple, set]] = {}
    for item_id, text in items:
        for w in windows(alnum_words(text or b""), size):
            by_len.setdefault(len(w), {}).setdefault(w, set()).add(item_id)
    out = []
    for n, patterns in sorted(by_len.items()):
        # shift[last word][word before it] -> distance the window may move
        shift: dict[bytes, dict] = {}
        bucket: dict[tuple, list] = {}
        for p, ids in patterns.items():
            if n > 1:
                for j in range(1, n):
                    d = shift.setdefault(p[j], {})
                    d[p[j - 1]] = min(d.get(p[j - 1], n), n - 1 - j)
                # A pattern's first word may end a block whose other word
                # lies before the pattern.
                shift.setdefault(p[0], {})
            bucket.setdefault(p[-2:], {}).setdefault(p[0], []).append((list(p), sorted(
                str(i) for i in ids if i is not None)))
        out.append({"n": n, "shift": shift, "bucket": bucket})
    return out


def search(words: list[bytes], tables: list[dict]):
    """(start, length, item ids) of every pattern occurrence in ``words``."""
    total = len(words)
    for t in tables:
        n, shift, bucket = t["n"], t["shift"], t["bucket"]
        i = n - 1
        if n == 1:
            for i, w in enumerate(words):
                hit = bucket.get((w,))
                if hit:
                    yield i, 1, hit[w][0][1]
            continue
        while i < total:
            before = shift.get(words[i])
            if before is None:
                i += n
                continue
            move = before.get(words[i - 1], n - 1)
            if move:
                i += move
                continue
            start = i - n + 1
            for pattern, ids in bucket[(words[i - 1], words[i])].get(words[start], ()):
                if words[start:i + 1] == pattern:
                    yield start, n, ids
            i += 1


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  keep: tuple = (), row: bool = False, size: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, sorted ``items``, ``hits`` (start
    and end word of each merged hit range, flat), besides the kept columns."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("i"),
                             F.col(f"`{item_text_col}`").cast("binary").alias("t"))
    items = items.where(F.col("t").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    if blocks == 1:
        return map_texts(docs, text_col, _searcher(docs, items, size)[0], FIELDS, list(keep), row)
    return _search_in_blocks(docs, items, blocks, text_col, keep, row, size)


def _searcher(docs: DataFrame, items: DataFrame, size: int):
    """(function for ``map_texts``, broadcast) that searches for ``items``, at
    most a block of them."""
    held = docs.sparkSession.sparkContext.broadcast(
        build_tables([(r["i"], bytes(r["t"])) for r in items.collect()], size))

    def make():
        def one(text):
            words = alnum_words(text or b"")
            ids, hit = set(), bytearray(len(words))
            for start, n, names in search(words, held.value):
                ids.update(names)
                hit[start:start + n] = b"\x01" * n
            ranges, at = [], hit.find(1)
            while at >= 0:
                end = hit.find(0, at)
                end = len(hit) if end < 0 else end
                ranges += (at, end)
                at = hit.find(1, end)
            return len(words), hit.count(1), sorted(ids), ranges

        def fn(texts):
            rows = [one(t) for t in texts]
            return [list(c) for c in zip(*rows, strict=True)]
        return fn
    return make, held


def _search_in_blocks(docs, items, blocks, text_col, keep, row, size) -> DataFrame:
    spark = docs.sparkSession
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = materialize(docs.select(whole.alias("row"), F.monotonically_increasing_id().alias("_rid")),
                       "decontam-rows")
    texts = rows.select("_rid", F.col("row").getField(text_col).alias("_text"))
    parts = None
    for b in range(blocks):
        make, held = _searcher(docs, items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b), size)
        found = map_texts(texts, "_text", make, FIELDS, ["_rid"])
        # The first scan also counts the words of every row.
        part = materialize(found if b == 0 else found.where(F.col("n_hit") > 0), "decontam-hits")
        held.unpersist()
        parts = part if parts is None else parts.unionByName(part)
    spans = F.transform(F.sequence(F.lit(0), F.floor(F.size("_r") / 2).cast("int") - 1), lambda i: F.struct(
        F.get("_r", 2 * i).alias("s"), F.get("_r", 2 * i + 1).alias("e")))
    merged = parts.groupBy("_rid").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"),
        F.flatten(F.collect_list("hits")).alias("_r"))
    merged = merged.withColumn("_r", F.when(F.size("_r") > 0, F.array_sort(spans)).otherwise(
        F.array().cast("array<struct<s:int,e:int>>")))

    def add(out, x):
        last = F.try_element_at(out, F.lit(-1))
        joined = F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))),
                          F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(out) > 0) & (x["s"] <= last["e"]), joined).otherwise(
            F.concat(out, F.array(x)))
    merged = merged.withColumn("_r", F.aggregate("_r", F.array().cast("array<struct<s:int,e:int>>"), add))
    merged = merged.select(
        "_rid", "n_words",
        F.aggregate("_r", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"]).alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        F.flatten(F.transform("_r", lambda x: F.array(x["s"], x["e"]))).alias("hits"))
    out = rows.join(merged, "_rid")
    names = [f for f, _ in FIELDS]
    kept = kept_names(keep, names, row)
    return out.select(*(["row"] if row else []),
                      *[F.col("row").getField(c).alias(n) for c, n in kept.items()], *names)


def digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()
