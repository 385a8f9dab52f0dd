"""Stages that turn raw documents into training documents; each calls one operator of ``docsynth.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsynth.llm import bpe, jaccard, langid, mixing, secretscan
from docsynth.llm.arrays import fresh, reachable
from docsynth.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin; the model learns from the labelled ones."""
    names = (fresh(docs, "lang_pred"), fresh(docs, "lang_score"), fresh(docs, "lang_rejected"))
    found = langid.classify(docs, langid.fit(docs), names=names)
    return found.where(~F.col(names[2])).select([f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity; those without words stay."""
    return jaccard.representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced, nested ones included."""
    return secretscan.redact(docs, chars="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mixing.curriculum(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each training document, with digests of the ids and of the text they decode to."""
    coded = bpe.encode_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json"), keep=False)
    return coded.select("doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mix),
    ("bpe", encode),
]

#: Compression, decoding worklists and byte-pair merges are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next stage."""
    docs = reachable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
