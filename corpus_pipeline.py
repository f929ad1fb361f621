"""The corpus pipeline: five stages over ``documents``, each an operator of ``ortholake.llm``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns the columns of documents (the last one: the encoded documents). Between stages the
rows are written as Parquet to the shared folder and read again, so a lost executor repeats at
most its share of one stage.

1. quality classifier: documents that the co-trained views score below one half go
2. quality rules: documents that fail the base rules, or a soft rule on a distrusted host, go
3. near duplicates (five-word shingles, similarity 0.8): one document of each group stays
4. mixture: rows selected to the target weights, once for each epoch that takes them
5. byte-level BPE: token counts and checksums of ids and decoded bytes
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ortholake.llm import bpe, cotrain, mixing, odd_sketch, quality_rules
from ortholake.llm.common import fresh, materialise, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotrain.keep_documents(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return odd_sketch.keep_documents(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    epoch = fresh("epoch", docs.columns)
    return mixing.select_mixture(docs, mixing.tree(), epoch_col=epoch).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest(docs, *bpe.vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("near_duplicates", drop_near_duplicates),
    ("mixture", mix),
    ("byte_bpe", encode),
]

#: Not expressible in SQL: the classifier and the encoder. Tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
