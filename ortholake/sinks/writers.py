"""Sinks (K1-K7). Writes are distributed (one file per task); publication of a table set is
atomic by writing a new versioned directory and then replacing a small pointer file."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.catalog import Catalog
from ortholake.sinks.files import replace_text


# K1 -------------------------------------------------------------------------
def write_table_set(cat: Catalog, root: str, version: str, mode: str = "errorifexists") -> str:
    """Write every table under ``root/<version>`` and point ``root/CURRENT`` at it."""
    target = os.path.join(root, version)
    cat.save(target, mode=mode)
    replace_text(cat.spark, os.path.join(root, "CURRENT"), version + "\n")
    return target


def read_current(spark: SparkSession, root: str) -> Catalog:
    version = spark.read.text(os.path.join(root, "CURRENT")).first()[0]
    return Catalog.open(spark, os.path.join(root, version))


# K2 / K3 ----------------------------------------------------------------------
def fasta_records(df: DataFrame, id_col: str = "seqhash_id", seq_col: str = "sequence") -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), F.col(seq_col)).alias("value"))


def export_representatives(cat: Catalog) -> DataFrame:
    """Sequences that are their own representative (``repseq_id = seqhash_id``), FASTA lines.
    Includes never-clustered sequences, whose repseq_id was initialised to themselves."""
    s = cat.sequences.filter(F.col("repseq_id") == F.col("seqhash_id"))
    return fasta_records(s)


def export_representatives_flag(cat: Catalog) -> DataFrame:
    """Sequences flagged ``is_representative`` (a different predicate from the above)."""
    return fasta_records(cat.sequences.filter(F.col("is_representative")))


def write_fasta(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    records.write.mode(mode).text(path)


# K4 -------------------------------------------------------------------------
def write_quant(quant: DataFrame, path: str, sample_id: str | None = None, fmt: str = "tsv", mode: str = "overwrite") -> None:
    df = quant if sample_id is None else quant.withColumn("sample", F.lit(sample_id))
    if fmt == "tsv":
        df.write.mode(mode).option("sep", "\t").option("header", True).csv(path)
    else:
        df.write.mode(mode).json(path)


# K5 -------------------------------------------------------------------------
def qc_stats_json(report: DataFrame) -> DataFrame:
    """One JSON document per sample: (sample_id, json)."""
    cols = [c for c in report.columns if c != "sample_id"]
    return report.select("sample_id", F.to_json(F.struct(*cols)).alias("json"))


def write_qc_stats(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per sample and line, which names its sample; a folder per sample would be as
    many folders to make, commit and list as there are samples."""
    report.select("sample_id", *[c for c in report.columns if c != "sample_id"]).write.mode(mode).json(path)


# K6 -------------------------------------------------------------------------
def write_cog_counts(counts: DataFrame, path: str, mode: str = "overwrite") -> None:
    counts.write.mode(mode).option("header", True).csv(path)


# K7 -------------------------------------------------------------------------
def export_id_list(ids: DataFrame, path: str, mode: str = "overwrite") -> None:
    ids.select(F.col(ids.columns[0]).cast("string").alias("value")).write.mode(mode).text(path)
