"""A training corpus from ``documents``: five stages, each stored before the next.

1. language: documents whose language cannot be told (no letters, or an
   ambiguous decoding) go;
2. near duplicates: one document of each group stays (five-word shingles,
   similarity of 0.8 or more);
3. decontamination: benchmark passages are cut out, documents that mostly
   consist of them go;
4. secrets: every span is replaced by a placeholder;
5. packing: the texts' tokens in sequences of 4,096.

All stages but the last return the columns of ``documents``; a document
that a stage finds nothing in passes unchanged.  An empty table passes
through all stages; null texts go in the first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm import bin_packing, decontaminate, lang_id, minhash, secrets
from vecspark.llm.common import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = lang_id.train(docs.where(~lang_id.held_out(F.col("doc_id"))))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = lang_id.identify(docs.select(row.alias("row"), "text"), model)
    return found.where((F.col("lang_pred") != lang_id.UNDETERMINED) & ~F.col("lang_ambiguous")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bin_packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Learned languages, token ids and packing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
