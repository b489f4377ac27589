"""The corpus pipeline: stages of the operators in stockflow/llm over the documents table.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns the rows
that go on. Stages are written as Parquet in the shared folder and read again, so a lost
executor costs one stage at most.

1. language: documents in none of the learned languages go.
2. near_duplicates: of each component of near duplicates (Jaccard similarity of 0.8 on five
   words) the document with the smallest id stays (equal rows: one of them; a null id counts
   as the largest).
3. decontamination: documents with a passage of the benchmark go.
4. personal_data: personal data in the texts is replaced by pseudonyms; no document goes.
5. mixture: the documents the mix takes, with the words taken from each, in mixing order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import decontamination, language, mixing, ngram_join, pii
from stockflow.llm.queries import table
from stockflow.llm.shipping import ship_package
from stockflow.session import written

# the stage's own rule; op10 has another one
NEAR = ngram_join.Rule(width=5, percent=80)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned on the training fold of the stage's own documents."""
    ship_package(spark)
    filters = language.learn(docs.filter(language.fold("doc_id", 4) != 2))
    return language.accepted(docs, filters)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngram_join.one_of_each(docs, NEAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pii.pseudonymised(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


STAGES = [
    ("language", by_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", pseudonymised),
    ("mixture", mixture),
]

# the learned language stage is not SQL: tests hold run() against brute-force stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
