"""Catalogue: the table registry and the ``Catalog`` object.

A catalogue is a set of named tables. ``Catalog`` maps a table name to a lazy DataFrame,
so the same plans run over a Parquet table set, over the fixture mapping of the
driver's tables, or over frames handed in by a streaming micro-batch.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, B, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Table schemas of catalogue version 2 (version 1 lacks sequences.is_representative).
SCHEMA_V2: dict[str, T.StructType] = {
    "sra_metadata": _schema(
        ("sample_id", S), ("organism", S), ("study_title", S), ("study_abstract", S), ("bioproject", S),
        ("biosample", S), ("library_strategy", S), ("library_source", S), ("library_selection", S),
        ("library_layout", S), ("instrument", S), ("run_spots", I), ("run_bases", L), ("run_published", TS),
    ),
    "sequences": _schema(
        ("seqhash_id", S), ("sequence", S), ("sample_id", S), ("assembly_date", TS),
        ("is_representative", B), ("repseq_id", S), ("length", I),
    ),
    "gene_protein_map": _schema(("gene_seqhash_id", S), ("protein_seqhash_id", S)),
    "expression": _schema(("gene_seqhash_id", S), ("sample_id", S), ("tpm", D), ("num_reads", D), ("effective_length", D)),
    "annotations": _schema(
        ("seqhash_id", S), ("seed_ortholog", S), ("evalue", D), ("score", D), ("eggnog_ogs", S), ("max_annot_lvl", S),
        ("cog_category", S), ("description", S), ("preferred_name", S), ("sample_id", S),
    ),
    "go_terms": _schema(("seqhash_id", S), ("go_term", S)),
    "ec_numbers": _schema(("seqhash_id", S), ("ec_number", S)),
    "kegg_info": _schema(
        ("seqhash_id", S), ("kegg_ko", S), ("kegg_pathway", S), ("kegg_module", S), ("kegg_reaction", S),
        ("kegg_rclass", S), ("brite", S), ("kegg_tc", S), ("cazy", S), ("bigg_reaction", S), ("pfams", S), ("sample_id", S),
    ),
    "clusters": _schema(("cluster_id", S), ("representative_seqhash_id", S), ("size", I)),
    "cluster_members": _schema(("seqhash_id", S), ("cluster_id", S)),
    "schema_version": _schema(("version", I), ("migration_name", S), ("applied_at", TS)),
}

SCHEMA_V1: dict[str, T.StructType] = dict(SCHEMA_V2)
SCHEMA_V1["sequences"] = T.StructType([f for f in SCHEMA_V2["sequences"].fields if f.name != "is_representative"])

SCHEMAS: dict[int, dict[str, T.StructType]] = {1: SCHEMA_V1, 2: SCHEMA_V2}
LATEST_VERSION = 2

# Primary keys (the store enforced them; we emulate with deterministic dedup + anti-joins).
PRIMARY_KEYS: dict[str, list[str]] = {
    "sra_metadata": ["sample_id"],
    "sequences": ["seqhash_id"],
    "gene_protein_map": ["gene_seqhash_id", "protein_seqhash_id"],
    "expression": ["gene_seqhash_id", "sample_id"],
    "annotations": ["seqhash_id"],
    "go_terms": ["seqhash_id", "go_term"],
    "ec_numbers": ["seqhash_id", "ec_number"],
    "kegg_info": ["seqhash_id"],
    "clusters": ["cluster_id"],
    "cluster_members": ["seqhash_id", "cluster_id"],
    "schema_version": ["version"],
}

# Dependency order (parents first) for writing and merging.
TABLE_ORDER = [
    "schema_version", "sra_metadata", "sequences", "gene_protein_map", "expression", "annotations",
    "go_terms", "ec_numbers", "kegg_info", "clusters", "cluster_members",
]

# Large tables are laid out by this column on disk (partition pruning by sample).
PARTITION_COLUMNS: dict[str, str] = {"sequences": "sample_id", "expression": "sample_id"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add missing ones as typed NULLs."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


class Catalog:
    """Named set of lazy DataFrames."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]):
        self.spark = spark
        self._tables: dict[str, DataFrame] = dict(tables)

    # -- access -------------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self._tables[name]
        except KeyError:
            raise KeyError(f"catalogue has no table {name!r}; has {sorted(self._tables)}") from None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self._tables[name]
        except KeyError:
            raise AttributeError(name) from None

    def has(self, name: str) -> bool:
        return name in self._tables

    def has_column(self, table: str, column: str) -> bool:
        return self.has(table) and column in self._tables[table].columns

    @property
    def names(self) -> list[str]:
        return [n for n in TABLE_ORDER if n in self._tables] + sorted(set(self._tables) - set(TABLE_ORDER))

    def with_tables(self, **tables: DataFrame) -> "Catalog":
        new = dict(self._tables)
        new.update(tables)
        return Catalog(self.spark, new)

    def without(self, *names: str) -> "Catalog":
        return Catalog(self.spark, {k: v for k, v in self._tables.items() if k not in names})

    def register_views(self, prefix: str = "") -> None:
        for name, df in self._tables.items():
            df.createOrReplaceTempView(prefix + name)

    # -- persistence ---------------------------------------------------------
    @classmethod
    def open(cls, spark: SparkSession, path: str, tables: Iterable[str] | None = None) -> "Catalog":
        """Open a Parquet table set written by :meth:`save` (one directory per table)."""
        wanted = list(tables) if tables is not None else TABLE_ORDER
        found = {}
        for name in wanted:
            p = os.path.join(path, name)
            if _exists(spark, p):
                found[name] = spark.read.parquet(p)
        return cls(spark, found)

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """Persist every table (K1), all in one layout: tables with samples are range-partitioned
        by (sample_id, primary key) and sorted inside each file, so a sample that holds a third
        of all rows is still spread over many tasks, and row-group min/max statistics skip by
        sample and by key. No column becomes a directory name, so types and order stay."""
        for name in self.names:
            df = self._tables[name]
            key = [k for k in PRIMARY_KEYS.get(name, []) if k in df.columns]
            part = PARTITION_COLUMNS.get(name)
            target = os.path.join(path, name)
            if part and part in df.columns:
                df = df.repartitionByRange(F.col(part), *[F.col(k) for k in key]).sortWithinPartitions(part, *key)
            elif key:
                df = df.sortWithinPartitions(*key)
            df.write.mode(mode).parquet(target)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
