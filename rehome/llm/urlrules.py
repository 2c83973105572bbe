"""URL rules by a sort-merge range join.

A host is keyed by its labels in reverse, each followed by a dot
(``m.example.net`` -> ``net.example.m.``), so "this host and all subdomains"
is the interval of keys that start with the rule's key.  Urls and rules are
range-partitioned on that key and swept in order; a stack holds the rules
whose intervals are open.  Intervals that reach into a partition from an
earlier one are found by an equi-join on the label prefixes of the
partition's first key, and enter as carried rules.  Ties on the key are dealt
by a hash, so a host with a third of all urls spans many partitions.

Of the rules that fit the longest (host plus path) wins; among rules of one
length the longer host; for equal rules with different verdicts ``block``.

Edge cases.  A null url or one without ``://`` has empty host and path.
Rules with a null host, path or verdict are ignored.  No rules, or none that
fits: rule null, verdict ``default``.  Repeated rows are judged row by row.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rehome.session import materialize

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UP, _LOW), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def key_prefixes(key: Column) -> Column:
    """The keys of all hosts that contain this one, itself and "" included."""
    labels = F.split(F.regexp_replace(key, r"\.$", ""), r"\.")
    return F.when(key == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(labels)),
        lambda i: F.when(i == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))))


class Sweep:
    """The stack of open rules while keys come in order."""

    def __init__(self):
        self.pid, self.stack = None, []

    def close_before(self, pid, key):
        if pid != self.pid:
            self.pid, self.stack = pid, []
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key, host, path, verdict):
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}))
        rules = self.stack[-1][1]
        old = rules.get(path)
        rules[path] = (host, "block" if old and old[1] == "block" else verdict)

    def judge(self, path):
        best = None
        for _, rules in reversed(self.stack):
            if len(rules) <= len(path):
                found = [(p, *r) for p, r in rules.items() if path.startswith(p)]
            else:
                found = [(path[:n], *rules[path[:n]]) for n in range(len(path) + 1)
                         if path[:n] in rules]
            for p, host, verdict in found:
                rank = (len(host) + len(p), len(host))
                if best is None or rank > best[0]:
                    best = (rank, host + p, verdict)
        return (None, None) if best is None else best[1:]


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: tuple = ("page_id",),
               default: str = "allow", row: bool = False) -> DataFrame:
    """The kept columns with host, path, rule and verdict of every url.

    ``rules`` has the columns host, path and verdict (allow or block).
    """
    spark = pages.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.col(f"`{url_col}`")
    kept = [F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")] if row else []
    kept += [F.col(f"`{c}`") for c in keep]
    urls = pages.select(F.struct(*kept).alias("_kept") if kept
                        else F.struct(F.lit(None).cast("string").alias("_")).alias("_kept"),
                        url_host(url).alias("_host"), url_path(url).alias("_path"),
                        F.xxhash64(url, *[F.col(f"`{c}`") for c in keep]).alias("_salt"))
    rule_rows = rules.select(F.col("host").cast("string").alias("_host"),
                             F.col("path").cast("string").alias("_path"),
                             F.col("verdict").cast("string").alias("_verdict")).dropna().distinct()
    rule_rows = rule_rows.withColumn("_key", host_key(F.col("_host")))
    both = (urls.withColumn("_key", host_key(F.col("_host"))).withColumn("_kind", F.lit(1))
            .withColumn("_verdict", F.lit(None).cast("string"))
            .unionByName(rule_rows.withColumn("_kind", F.lit(0)), allowMissingColumns=True))
    placed = materialize(both.repartitionByRange(n, "_key", "_kind", "_salt")
                         .withColumn("_pid", F.spark_partition_id()), "url-sweep")
    firsts = placed.groupBy("_pid").agg(F.min("_key").alias("_key"))
    carried = (firsts.select("_pid", F.explode(key_prefixes(F.col("_key"))).alias("_key"))
               .join(rule_rows, "_key").withColumn("_kind", F.lit(0)))
    ordered = (placed.unionByName(carried, allowMissingColumns=True)
               .select("_pid", "_key", "_kind", "_host", "_path", "_verdict", "_kept")
               .repartition(n, "_pid").sortWithinPartitions("_pid", "_key", "_kind"))
    text = StringType()
    schema = StructType([ordered.schema["_kept"]] + [
        StructField(c, text, True) for c in ("host", "path", "rule", "verdict")])

    def sweep(batches):
        state = Sweep()
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            at, out = [], []
            for i, (pid, key, kind, host, path, verdict) in enumerate(zip(*cols, strict=True)):
                state.close_before(pid, key)
                if kind == 0:
                    state.open(key, host, path, verdict)
                else:
                    rule, got = state.judge(path)
                    at.append(i)
                    out.append((host, path, rule, got or default))
            took = batch.column(6).take(pa.array(at, pa.int64()))
            cols = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [took] + [pa.array(list(c), pa.string()) for c in cols], names=schema.names)

    return ordered.mapInArrow(sweep, schema).select(
        *([F.col("_kept.row")] if row else []), *[F.col("_kept").getField(c).alias(c) for c in keep],
        "host", "path", "rule", "verdict")
