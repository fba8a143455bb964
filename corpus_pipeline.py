"""Corpus pipeline over ``documents``: five stages, each written as Parquet and
read again as the next one's input.

Each stage takes ``(spark, docs, sf_dir)``, works on every row the one before
it kept, and returns the columns of ``docs``; the last returns the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweave.llm import bpe, decontam, langid, pii, simhash
from mailweave.llm.common import Scratch, unused
from mailweave.llm.queries import WORD_BPE


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay unless the operator tells no language: those whose text
    is null or without a letter go.  Where no document has a ``lang`` nothing is
    learned, and every text with a letter stays."""
    model = langid.fit(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = unused("lang_pred", docs.columns), unused("score", docs.columns)
    return langid.identify(docs, model, (lang, score)).where(F.col(lang) != langid.UNKNOWN).drop(lang, score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one with
    the smallest doc_id; a null or empty text is a group of its fingerprint like
    any other, rows without a doc_id stay, an empty table stays empty."""
    return simhash.one_per_group(docs, Scratch(spark, "stage-simhash"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item stay, null and empty texts among
    them; repeated rows go or stay together; an empty table stays empty."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with the personal data of their texts replaced and
    ``n_chars`` counted anew."""
    clean = pii.redacted(docs)
    if "n_chars" not in clean.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: ``(doc_id, ids)``, a row per row; a null or
    empty text has none, an empty table gives an empty result."""
    return bpe.encode_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [("language_id", language), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate),
          ("pii_redaction", redact), ("bpe_encoding", encode)]

#: SQL cannot express the stages; they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; the result of the last one."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
