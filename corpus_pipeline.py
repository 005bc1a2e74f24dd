"""From raw documents to tokens: quality, exact copies, near copies, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's input. All
but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caselight.llm import bpe, exact, jaccard, mixing, quality
from caselight.llm.common import stored, table
from caselight.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_similar(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, vocabulary(), decoded=False, digests=True)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("ngram_jaccard", ngram_jaccard),
          ("source_mixing", source_mixing), ("bpe_tokens", bpe_tokens)]

#: SQL cannot express merges by rank; the tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
