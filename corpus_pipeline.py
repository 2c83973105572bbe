"""Training-corpus pipeline over ``documents``.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``documents``, so
a stage's result can be written and read again as the next one's input.

1. language ID: documents without any letter (or text) go, and a missing
   ``lang`` is filled with the predicted one (a given one is kept: labels of
   the table are the training truth, so no document goes for contradicting it);
2. near-duplicate removal: the smallest id of each group stays;
3. benchmark decontamination: documents that hold a benchmark window go;
4. personal data: every span is replaced by its kind, ``n_chars`` follows;
5. mixing: sources get their target words and documents training positions.

Null ids, repeated rows and empty tables are handled as the operators say; in
particular rows with a null id are never duplicates of anything.  Extra columns
go through every stage but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rehome.llm import decontam, langid, minhash, mixing, pii
from rehome.llm.common import read_table
from rehome.llm.queries import held_out
from rehome.session import materialize

# Percent of shared five-word shingles from which documents are near duplicates.
SIMILARITY = 80

# SQL cannot express the language and personal-data models.
ORACLE_SQL = None


def _columns(docs: DataFrame, **changed) -> list:
    """The columns of ``docs`` out of the struct ``row``, some of them changed.
    Operators add theirs beside the struct, so no name can clash."""
    return [changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, where=~F.coalesce(held_out(), F.lit(False)))
    out = langid.predict(docs, model, row=True).where(F.col("lang_pred") != langid.UNKNOWN)
    return out.select(*_columns(docs, lang=F.coalesce(F.col("row.lang"), F.col("lang_pred"))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = minhash.near_duplicates(docs, percent=SIMILARITY)
    return docs.join(groups.where(~F.col("kept")).select("doc_id"), "doc_id", "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = decontam.contamination(docs, read_table(spark, sf_dir, "benchmark"), row=True)
    return out.where(F.col("n_hit") == 0).select(*_columns(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.mask_pii(docs, row=True, field=pii.fit_field(docs))
    n_chars = F.when(F.col("n_spans") > 0, F.length("masked")).otherwise(F.col("row.n_chars"))
    return out.select(*_columns(docs, text=F.col("masked"),
                                n_chars=n_chars.cast(docs.schema["n_chars"].dataType)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("mask_personal_data", mask_personal_data),
          ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written once."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
