"""License scan by an exact set-similarity join with license templates.

DataFrame functions only.  A document's words are cut into overlapping blocks
of ``2 * span`` words every ``span`` words, where ``span`` is the length of the
longest template (``SPAN`` at least), so a template's passage lies whole in a block.  A block fits a template if it contains at least ``THRESHOLD`` of the
template's distinct words.  Tokens are ordered by their document frequency in
the corpus, rare ones first.  A pair can only fit if the prefixes of both (all
but the last ``need - 1`` tokens) share a token, the block has ``need`` tokens
of the vocabulary, and enough tokens follow the shared ones on both sides;
pairs that pass are verified on the full sets.  These filters lose no pair.

The templates are a bounded parameter, so their index is broadcast.

Edge cases.  Null text is empty.  Documents of the same words are verified
once and share the result; repeated rows are returned row by row.  Other columns are not read,
whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rehome.session import materialize

THRESHOLD = 0.9
# Least words between block starts; longer templates widen it.
SPAN = 40

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"),
           ("general public license", "gpl"))

# License statements and their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files to deal in the software without "
            "restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without "
                    "prior written permission"),
)

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Words joined by single blanks.  Only two characters beyond A-Z become
    ASCII letters when lower-cased; they are replaced first, so only A-Z are
    lower-cased as far as any ASCII word can tell."""
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("µ")),
                      F.lit("İ"), F.lit("µ"))
    return F.trim(F.regexp_replace(F.lower(plain), _GAP, " "))


def _spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: tuple = ("doc_id",),
                  phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word,
    base_labels, labels and score (best containment; 1 where a phrase stands)."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    vocab = sorted({w for _, s in sets for w in s})
    span = max([SPAN] + [len(text.split()) for _, text in templates])
    needs = [math.ceil(threshold * len(s) - 1e-9) for _, s in sets]

    def words_of(tokens):
        return F.array(*[F.lit(t) for t in tokens])

    kept = [F.col(f"`{c}`") for c in keep]
    base = docs.select(*kept, normal_words(F.col(f"`{text_col}`")).alias("_norm"))
    base = base.withColumn("n_words", F.when(F.col("_norm") == "", 0).otherwise(
        _spaces(F.col("_norm")) + 1).cast("bigint"))
    padded = F.concat(F.lit(" "), F.col("_norm"), F.lit(" "))
    count, first, last, found = F.lit(0), [], [], []
    for p, label in phrases:
        stands = F.instr(padded, f" {p} ") > 0
        count = count + F.when(stands, F.regexp_count(padded, F.lit(f"(?<= ){p}(?= )"))).otherwise(0)
        first.append(F.when(stands, _spaces(F.substring_index(padded, f" {p} ", 1))))
        tail = F.substring_index(padded, f" {p} ", -1)
        last.append(F.when(stands, F.col("n_words") - _spaces(tail) - len(p.split())))
        found.append(F.when(stands, F.lit(label)))
    tokens = F.array_intersect(F.split("_norm", " "), words_of(vocab))
    # A block is part of its document, so a document short of tokens of every
    # template has no block that fits.
    maybe = F.lit(False)
    for (_, s), need in zip(sets, needs, strict=True):
        maybe = maybe | (F.size(F.array_intersect(F.col("_tokens"), words_of(s))) >= need)
    base = base.select(
        *kept, "n_words", count.cast("bigint").alias("n_base"),
        (F.least(*first) if len(first) > 1 else first[0]).cast("bigint").alias("first_word"),
        (F.greatest(*last) if len(last) > 1 else last[0]).cast("bigint").alias("last_word"),
        F.array_compact(F.array(*found)).alias("_found"), tokens.alias("_tokens"), "_norm")
    base = materialize(
        base.withColumn("_norm", F.when(maybe, F.col("_norm"))).withColumn("_key", F.md5("_norm")),
        "license-docs")

    # Global order: document frequency over the whole corpus, rare first.
    freq = {r["t"]: r["count"] for r in base.select(F.explode("_tokens").alias("t"))
            .groupBy("t").count().collect()}  # at most the templates' vocabulary
    rank = {w: i for i, w in enumerate(sorted(vocab, key=lambda w: (freq.get(w, 0), w)))}
    index = []
    for (label, s), need in zip(sets, needs, strict=True):
        ranks = sorted(rank[w] for w in s)
        index += [(r, label, i, need, ranks) for i, r in enumerate(ranks[:len(ranks) - need + 1])]
    index = spark.createDataFrame(index, "_r int, _label string, _i int, _need int, _set array<int>")

    texts = base.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.first("_norm").alias("_norm"))
    words = F.split("_norm", " ")
    blocks = texts.select("_key", words.alias("_w")).select("_key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("_w"), F.lit(span)),
        lambda i: F.array_intersect(F.slice(F.col("_w"), i, 2 * span), words_of(vocab)))).alias("_b"))
    ranks = F.create_map(*[x for w, r in rank.items() for x in (F.lit(w), F.lit(r))])
    least = min(needs)
    blocks = blocks.where(F.size("_b") >= least).withColumn(
        "_b", F.array_sort(F.transform("_b", lambda w: ranks[w])))
    probes = blocks.select("_key", "_b", F.posexplode(
        F.slice("_b", F.lit(1), F.size("_b") - least + 1)).alias("_j", "_r"))
    size = F.size("_b")
    fits = probes.join(F.broadcast(index), "_r").where(
        (size >= F.col("_need")) & (F.col("_j") <= size - F.col("_need"))
        & (F.least(F.size("_set") - F.col("_i"), size - F.col("_j")) >= F.col("_need")))
    share = F.size(F.array_intersect("_b", "_set")) / F.size("_set")
    hits = (fits.select("_key", "_label", (F.size(F.array_intersect("_b", "_set"))
                                           >= F.col("_need")).alias("_ok"), share.alias("_share"))
            .where("_ok").groupBy("_key")
            .agg(F.collect_set("_label").alias("_labels"), F.max("_share").alias("_score")))
    none = F.array().cast("array<string>")
    flagged = base.where(F.col("_key").isNotNull()).join(hits, "_key", "left")
    rest = base.where(F.col("_key").isNull()).withColumns(
        {"_labels": F.lit(None).cast("array<string>"), "_score": F.lit(None).cast("double")})
    out = flagged.unionByName(rest)
    return out.select(
        *kept, "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("_found")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_found", F.coalesce("_labels", none))), ",")
        .alias("labels"),
        F.when(F.size("_found") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0)))
        .alias("score"))
