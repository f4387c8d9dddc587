"""A corpus pipeline of five stages over documents, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.

1. quality_rules: documents that a rule rejects go.
2. quality_classifier: fitted on labelled documents, whether the rules kept them or not; of what is left, documents not
   likely to be of the best grade go.
3. near_duplicates: documents on five-word shingles link from a Jaccard similarity of 0.8; of each group the one with
   the smallest doc_id stays.
4. mixing: each document is there as many times as the mix of sources takes it, or not at all.
5. bpe: token count and digests of the tokens and of the decoded text of every row.

No stage is to be had in SQL as a whole (the classifier is trained), so ORACLE_SQL is None; tests hold near duplicates and
tokens against brute force and the tokenizers library, the classifier's choice against its features added up one by one, the
mix against targets filled by hand, and the rules against plain counts of what every rule set has to reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, jaccard_join, mixing, quality_model, quality_rules
from tessera.llm.common import stage, table, unstage

SHINGLE, PERCENT = 5, 80


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.select_documents(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, SHINGLE, PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest_by_file(docs)


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("near_duplicates", near_duplicates), ("mixing", mixture), ("bpe", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, function) in enumerate(STAGES):
        out = function(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            out = stage(out, name)
            unstage(docs)  # the stage before has been read for the last time
        docs = out
    return docs
