"""The registered thin queries: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rehome.llm import (ann, decontam, langid, licenses, minhash, mixing, periodic, pii, secrets,
                        simhash, suffix, urlrules, whitening)
from rehome.llm.common import read_table

QUERIES = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("op1_minhash")
def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


# Host, path and verdict of each rule.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op2_url_rules")
def op2_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(read_table(spark, sf_dir, "pages"), rules)


@query("op3_ann")
def op3_ann(spark, sf_dir):
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_mixing")
def op4_mixing(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


@query("op5_repeats")
def op5_repeats(spark, sf_dir):
    out = suffix.repeated_passages(read_table(spark, sf_dir, "documents"))
    return out.withColumn("spans", F.array_join(F.transform("spans", lambda x: x.cast("string")), ","))


@query("op6_secrets")
def op6_secrets(spark, sf_dir):
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"), keep=("doc_id",))


@query("op7_decontam")
def op7_decontam(spark, sf_dir):
    out = decontam.contamination(read_table(spark, sf_dir, "documents"),
                                 read_table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_licenses")
def op8_licenses(spark, sf_dir):
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


@query("op9_pii")
def op9_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return pii.find_pii(docs, keep=("doc_id",), field=pii.fit_field(docs))


def held_out(id_col="doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


@query("op10_langid")
def op10_langid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out_of_sample = F.coalesce(held_out(), F.lit(False))
    model = langid.train(docs, where=~out_of_sample)
    out = langid.predict(docs, model, keep=("doc_id",))
    return out.select("doc_id", out_of_sample.alias("held_out"), "lang_pred", "score")


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    out = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    # A deviation too large for a long is null.
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query("op12_simhash")
def op12_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def with_planted_runs(docs):
    """The query's rule: in one document of ten, as the id's checksum says, the
    words from some position on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = docs.select("doc_id", "text", F.floor(h / 10).alias("g"),
                      F.when(h % 10 == 0, words).alias("w"))
    out = out.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("bigint"))
    out = out.withColumn("a", F.expr("g % nullif(n, 0)"))
    out = out.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - F.col("a") - 1),
                       lambda i: F.get("w", (F.col("a") + i % F.col("p")).cast("int")))
    text = F.concat_ws(" ", F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail))
    return out.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@query("op13_periodic")
def op13_periodic(spark, sf_dir):
    docs = with_planted_runs(read_table(spark, sf_dir, "documents"))
    out = periodic.periodic_runs(docs)
    top = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    out = out.withColumn("top", top)
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                    r["period"].cast("string")), F.lit("\n")))
    return out.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("top.s").alias("start"),
        (-F.col("top.l")).alias("length"), F.col("top.p").alias("period"),
        F.expr("1000 * -top.l div top.p").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
