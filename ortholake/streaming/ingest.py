"""Incremental catalogue maintenance on Structured Streaming.

T1 ``stream_ingest``: protein FASTA files dropped into a folder (``<sample>.pep``, one per sample) are
the stream; a sample's annotations (``<sample>.emapper.annotations``), quantification
(``<sample>.json``) and run record (``<sample>.xml``) lie beside it and must be there first. Every
micro-batch runs the whole ingest (I1-I9) against the catalogue and commits the rows of all tables
and the report in one step. With ``cluster_root``, the accepted sequences then join a kept clustering (R7).
T2 ``stream_cluster_update``: edge lists dropped into a folder are applied to clusters, members and
the sequences' representatives.

The catalogue is a set of versioned tables (``sinks.manifest``): a reader, or a replayed batch, sees a
batch whole or not at all, wherever the writer was lost. Batches are tagged by stream and number, so a
replay adds nothing. An update rewrites the files that hold a touched sequence; all others keep
their names. Stream progress lives in ``checkpoint`` (a folder on shared storage).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ortholake.catalog import PRIMARY_KEYS, SCHEMA_V2, Catalog
from ortholake.operators import ingest as ig
from ortholake.operators import maintain as mt
from ortholake.operators.cluster_index import ClusterIndex
from ortholake.session import materialise
from ortholake.sinks.files import list_files
from ortholake.sinks.manifest import Change, VersionedTables, key_ranges
from ortholake.sources import files as src

LEDGER = "_ingest_ledger"
LEDGER_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("sample_id", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("sequences_loaded", T.LongType()), T.StructField("annotations_loaded", T.LongType()),
    T.StructField("duplicates", T.LongType()), T.StructField("error", T.StringType()),
])
TABLES = [t for t in SCHEMA_V2 if t != "schema_version"]
#: Files beside a sample's proteins, by their ending.
ANNOTATIONS, QUANT, METADATA = ".emapper.annotations", ".json", ".xml"


def read_catalog(spark: SparkSession, root: str) -> Catalog:
    """The catalogue as of its last commit."""
    tables = VersionedTables(spark, root)
    return Catalog(spark, {t: tables.read(t, SCHEMA_V2[t]) for t in TABLES})


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return VersionedTables(spark, root).read(LEDGER, LEDGER_SCHEMA)


def _start(stream: DataFrame, apply, checkpoint: str, available_now: bool):
    def tagged(batch: DataFrame, batch_id: int) -> None:
        # The stream's own id, kept in its checkpoint: a new checkpoint is another stream.
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        apply(batch, batch_id, f"{own}:{batch_id}")

    writer = stream.writeStream.foreachBatch(tagged).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def _beside(drop_dir: str, names: set[str], samples: list[str], ending: str) -> list[str]:
    return [f"{drop_dir.rstrip('/')}/{s}{ending}" for s in samples if s + ending in names]


# T1 -------------------------------------------------------------------------
def batch_bundle(spark: SparkSession, drop_dir: str, proteins: DataFrame) -> ig.SampleBundle:
    """The samples of a micro-batch (in the order of their ids) with the files beside them."""
    ids = sorted(r["sample_id"] for r in proteins.select("sample_id").distinct().toLocalIterator())      # one per dropped file
    names = set(list_files(spark, drop_dir))
    found = {e: _beside(drop_dir, names, ids, e) for e in (ANNOTATIONS, QUANT, METADATA)}
    scans = ((ANNOTATIONS, src.scan_annotations), (QUANT, src.scan_expression), (METADATA, src.scan_sample_metadata))
    ann, quant, meta = (scan(spark, found[e]) if found[e] else None for e, scan in scans)
    return ig.SampleBundle(ig.sample_order(spark, ids), proteins, ann, quant, meta)


def stream_ingest(spark: SparkSession, drop_dir: str, catalog_root: str, checkpoint: str, as_of: _dt.datetime | None = None,
                  available_now: bool = True, cluster_root: str | None = None, **clustering):
    """Start the ingest stream; returns the ``StreamingQuery``. ``cluster_root`` and ``clustering``
    (n, percent, unit): the kept clustering that new sequences join."""

    def apply(batch: DataFrame, batch_id: int, tag: str) -> None:
        tables = VersionedTables(spark, catalog_root)
        if tag not in tables.manifest()["tags"]:
            proteins = materialise(src.fasta_records(src.numbered_records(batch)), "proteins")
            new, report = ig.bundle_rows(batch_bundle(spark, drop_dir, proteins), read_catalog(spark, catalog_root), as_of, stage=materialise)
            rows = {t: key_ranges(df, PRIMARY_KEYS[t]) for t, df in new.items()}
            rows[LEDGER] = report.select(F.lit(batch_id).cast("long").alias("batch_id"), *LEDGER_SCHEMA.names[1:])
            tables.commit(rows, tag)
        if cluster_root is not None:
            ids = src.fasta_records(batch).select(F.col("id").alias("seqhash_id")).distinct()
            cluster_batch(spark, catalog_root, cluster_root, ids, tag, **clustering)

    raw = spark.readStream.format("text").option("lineSep", src.FASTA_SEPARATOR).option("pathGlobFilter", "*.pep").load(drop_dir)
    return _start(raw.select("value", *src.fasta_meta()), apply, checkpoint, available_now)


def cluster_batch(spark: SparkSession, catalog_root: str, cluster_root: str, ids: DataFrame, tag: str, n: int = 3, percent: int = 80,
                  unit: str = "char") -> None:
    """Let the sequences of a batch (by id) join the clustering at ``cluster_root``, then set their
    clusters and representatives in the catalogue. Either step is skipped if it was committed."""
    index = ClusterIndex(spark, cluster_root, n, percent, unit, SCHEMA_V2["sequences"]["seqhash_id"].dataType)
    texts = read_catalog(spark, catalog_root).sequences.join(ids, "seqhash_id", "left_semi")
    index.add(texts.select(F.col("seqhash_id").alias("id"), F.col("sequence").alias("text")), tag)
    edges = index.members().join(ids.withColumnRenamed("seqhash_id", "id"), "id", "left_semi")
    apply_edges(spark, catalog_root, edges.select("representative", F.col("id").alias("member")), f"clusters {tag}", grow=True)


# T2 -------------------------------------------------------------------------
def apply_edges(spark: SparkSession, catalog_root: str, edges: DataFrame, tag: str, grow: bool = False) -> bool:
    """C2/C3 on the files that ``edges`` (representative, member) touch, in one commit: members get the
    smallest representative of their edges, clusters and member pairs not yet there are added. An
    existing cluster keeps its size, unless ``grow`` adds its new members. False if committed before."""
    tables = VersionedTables(spark, catalog_root)
    if tag in tables.manifest()["tags"]:
        return False
    cat = read_catalog(spark, catalog_root)
    valid = materialise(mt.valid_edges(edges.distinct() if grow else edges, cat.sequences), "edges")
    assign = valid.groupBy(F.col("member").alias("seqhash_id")).agg(F.min("representative").alias("rep"))
    hit = tables.touched("sequences", SCHEMA_V2["sequences"], "seqhash_id", assign)
    changes: dict[str, Change | DataFrame] = {}
    if hit:
        rows = spark.read.schema(SCHEMA_V2["sequences"]).parquet(*[f"{tables.root}/{n}" for n in hit])
        new = mt.assign_representatives(rows, assign)
        changes["sequences"] = Change(key_ranges(new, ["seqhash_id"]), hit)
    pairs = valid.select(F.col("member").alias("seqhash_id"), F.col("representative").alias("cluster_id"))
    members = materialise(pairs.distinct().join(cat.cluster_members, ["seqhash_id", "cluster_id"], "left_anti"), "members")
    changes["cluster_members"] = key_ranges(members, ["seqhash_id", "cluster_id"])
    sizes = (members if grow else pairs).groupBy("cluster_id").agg(F.count(F.lit(1)).cast("int").alias("more"))
    fresh = sizes.join(cat.clusters.select("cluster_id"), "cluster_id", "left_anti").select(
        "cluster_id", F.col("cluster_id").alias("representative_seqhash_id"), F.col("more").alias("size"))
    grown = tables.touched("clusters", SCHEMA_V2["clusters"], "cluster_id", sizes.select("cluster_id")) if grow else []
    if grown:
        rows = spark.read.schema(SCHEMA_V2["clusters"]).parquet(*[f"{tables.root}/{n}" for n in grown]).join(sizes, "cluster_id", "left")
        rows = rows.select("cluster_id", "representative_seqhash_id", (F.col("size") + F.coalesce("more", F.lit(0))).cast("int").alias("size"))
        fresh = rows.unionByName(fresh)
    changes["clusters"] = Change(key_ranges(fresh, ["cluster_id"]), grown)
    return tables.commit(changes, tag)


def stream_cluster_update(spark: SparkSession, drop_dir: str, catalog_root: str, checkpoint: str, available_now: bool = True):
    """Apply dropped (representative, member) TSV files: clusters and pairs with ``ignore``
    semantics, representatives of the sequences as in C3."""

    def apply(batch: DataFrame, batch_id: int, tag: str) -> None:
        apply_edges(spark, catalog_root, batch, f"edges {tag}")

    stream = spark.readStream.schema(src.EDGE_SCHEMA).option("sep", "\t").csv(drop_dir)
    return _start(stream, apply, checkpoint, available_now)
