"""Pipeline over documents: from raw rows to tokens of a balanced, clean corpus.

1. language_id: rows whose language can't be told (no letters, or a calibrated
   score under the rejection limit) go.
2. ngram_join: of documents linked by 5-word shingles at a similarity of 0.8 or
   more, the one with the smallest doc_id stays.
3. secret_scan: every secret in a text is replaced by a mask; no row goes.
4. mixing: rows of small sources are repeated towards temperature weights; every
   row stays at least once.
5. byte_bpe: each row becomes token ids, with the hash of their exact round trip.

Every stage takes all that its predecessor kept, as written to Parquet.  Null
and empty texts have no letters and go in stage 1; further columns of documents
come through stages 1 to 4; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import bpe, jaccard, langid, mixing, queries, secretscan
from termloom.llm.common import discard, materialise, table


#: Rows of documents that go to a Python worker at once: whole texts, so memory goes with them.
ARROW_ROWS = "2000"


def _whole_texts(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _whole_texts(spark)
    return langid.accepted(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _whole_texts(spark)
    return jaccard.one_of_each(docs, k=5, num=80, den=100)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _whole_texts(spark)
    return secretscan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, repeats=2.0)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _whole_texts(spark)
    return bpe.encode_documents(docs, queries.vocabulary_path(), keep_offsets=False)


STAGES = [("language_id", language_id), ("ngram_join", ngram_join), ("secret_scan", secret_scan), ("mixing", mix), ("byte_bpe", byte_bpe)]

#: A trained model and byte-pair merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spent = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(*spent)  # what this stage has read
        spent = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
