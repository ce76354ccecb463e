"""The training-data pipeline: stages that each apply one operator to what the one before kept.

Toxic documents go, one document of each group of near-duplicates stays, secrets are masked,
sources are mixed to their target weights, and what is left is encoded. All stages but the last
return the columns of the documents. A stage's own columns never meet those of the documents,
whatever their names, as it works on numbered ones.

Defined results are those of the operators: null and empty texts are clean, share one fingerprint
(so that one of them stays), hold no secrets, and are never taken by the mix; an empty table passes
all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm import bpe, mixing, secrets, simhash, toxicity
from stratalake.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with numbered columns, and the number of each name."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold."""
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    rows, names = _numbered(docs)
    scored = toxicity.with_toxicity(rows, model, text_column=names["text"])
    clean = scored.filter(F.col("toxicity") < toxicity.THRESHOLD)
    return clean.select(*names.values()).toDF(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return simhash.one_per_group(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and ``n_chars`` to match."""
    rows, names = _numbered(docs)
    text, chars = names["text"], names.get("n_chars")
    found = secrets.with_secrets(rows, id_column=names["doc_id"], text_column=text)
    masked = found.withColumn(text, secrets.redacted(F.col(text), F.col("secrets")))
    if chars:
        length = F.length(F.col(text)).cast(rows.schema[chars].dataType)
        masked = masked.withColumn(chars, F.when(F.size("secrets") > 0, length).otherwise(F.col(chars)))
    return masked.select(*names.values()).toDF(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each as often as the mix uses it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    slim = docs.select("doc_id", "lang", "source", "text")
    both = bpe.with_round_trip(slim, VOCABULARY)
    return both.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Scores, fingerprints and tokens are not expressible in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
