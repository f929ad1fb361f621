"""Search results joined to the catalogue (N1-N4): a homology hit frame (query, target, ...)
left-joined to annotations and to cluster membership among the hits, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ortholake.catalog import Catalog

RESULT_HEADERS = [
    "query", "organism", "sample_id", "preferred_name", "target", "description", "tseq", "cluster_members",
    "cog_category", "pident", "alnlen", "mismatch", "gapopen", "qstart", "qend", "tstart", "tend", "evalue", "bits",
    "cluster_size",
]
# Fills applied when a hit has no catalogue data.
HIT_DEFAULTS = {"organism": "Unknown", "sample_id": "Unknown", "description": "No annotation", "cluster_members": ""}
DEFAULT_CLUSTER_SIZE = 1


def _targets(hits: DataFrame) -> DataFrame:
    return hits.select(F.col("target").alias("seqhash_id")).distinct()


# N1 -------------------------------------------------------------------------
def hit_annotations(cat: Catalog, hits: DataFrame) -> DataFrame:
    s = cat.sequences.select("seqhash_id", "sample_id").join(_targets(hits), "seqhash_id", "left_semi")
    return (
        s.join(cat.sra_metadata.select("sample_id", "organism"), "sample_id")
        .join(cat.annotations.select("seqhash_id", "description", "cog_category", "preferred_name"), "seqhash_id", "left")
        .select(F.col("seqhash_id").alias("target"), "sample_id", "organism", "description", "cog_category", "preferred_name")
    )


# N2 -------------------------------------------------------------------------
def hit_clusters(cat: Catalog, hits: DataFrame) -> DataFrame:
    """Per cluster of the hit ids: one id (the smallest), the hit members and their count."""
    cm = cat.cluster_members.join(_targets(hits), "seqhash_id", "left_semi")
    return cm.groupBy("cluster_id").agg(
        F.min("seqhash_id").alias("target"),
        F.array_join(F.array_sort(F.collect_list("seqhash_id")), ";").alias("cluster_members"),
        F.count(F.lit(1)).alias("cluster_size"),
    ).select("target", "cluster_id", "cluster_members", "cluster_size")


# N3 -------------------------------------------------------------------------
def search_results(cat: Catalog, hits: DataFrame) -> DataFrame:
    """Hits with annotations and cluster data; rows with any missing value are dropped (so one
    hit per cluster survives, as in the studied app)."""
    j = hits.join(hit_annotations(cat, hits), "target", "left").join(hit_clusters(cat, hits), "target", "left").na.drop()
    return j.select(*[c for c in RESULT_HEADERS if c in j.columns])


# N4 -------------------------------------------------------------------------
def merge_hits_with_defaults(cat: Catalog, hits: DataFrame) -> DataFrame:
    j = hits.join(hit_annotations(cat, hits), "target", "left").join(hit_clusters(cat, hits), "target", "left")
    j = j.na.fill(HIT_DEFAULTS).withColumn(
        "cluster_size", F.coalesce(F.col("cluster_size"), F.lit(DEFAULT_CLUSTER_SIZE).cast("bigint"))
    )
    return j.drop("cluster_id")
