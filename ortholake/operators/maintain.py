"""Catalogue maintenance: merge (M1-M6), cluster maintenance (C1-C10), schema versions (V1-V4).

Updates of the relational store (``UPDATE ... FROM``, ``INSERT OR IGNORE``) become whole-
table rewrites expressed as joins: the caller writes the returned frames as a new table-set
version (see ``sinks.write_table_set``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ortholake.session import materialise
from ortholake.catalog import LATEST_VERSION, PRIMARY_KEYS, SCHEMA_V2, SCHEMAS, TABLE_ORDER, Catalog, conform


# ---------------------------------------------------------------------------
# Merge
# ---------------------------------------------------------------------------
def _first_wins(df: DataFrame, key: list[str], rank_col: str = "_src") -> DataFrame:
    """One row per key: the row of the lowest source rank (ties: smallest row by value).
    ``min_by`` aggregates map-side, so a key present in many sources is combined early."""
    rest = [c for c in df.columns if c not in key and c != rank_col]
    if not rest:
        return df.select(*key).distinct()
    return df.groupBy(*key).agg(
        F.min_by(F.struct(*rest), F.struct(F.col(rank_col), *[F.col(c) for c in rest])).alias("_r")
    ).select(*key, "_r.*")


def merge_catalogs(sources: list[Catalog], target_version: int = LATEST_VERSION) -> Catalog:
    """M1/M2/M3: union every table over the sources in order; per primary key the first source
    wins; columns a source lacks are NULL (``is_representative`` defaults to FALSE); tables
    missing from a source are skipped."""
    if not sources:
        raise ValueError("no sources")
    spark = sources[0].spark
    schemas = SCHEMAS[target_version]
    out: dict[str, DataFrame] = {}
    for name in TABLE_ORDER:
        if name == "schema_version" or name not in schemas:
            continue
        parts = []
        for rank, src in enumerate(sources):
            if not src.has(name):
                continue
            df = conform(src[name], schemas[name])
            if name == "sequences" and "is_representative" in schemas[name].fieldNames():
                had = "is_representative" in src[name].columns
                df = df.withColumn("is_representative", F.coalesce(F.col("is_representative"), F.lit(False)) if had
                                   else F.lit(False))
            parts.append(df.withColumn("_src", F.lit(rank)))
        if not parts:
            continue
        u = reduce(DataFrame.unionByName, parts)
        out[name] = _first_wins(u, PRIMARY_KEYS[name]).select(*schemas[name].fieldNames())
    return Catalog(spark, out)


def merge_expression_repair(cat: Catalog) -> Catalog:
    """M4: genes in expression without a gene-map row get a synthetic ``<gene before '.'>.p1``
    protein row when that protein exists; then expression keeps only mapped genes."""
    gpm = cat.gene_protein_map
    unmapped = cat.expression.select("gene_seqhash_id").distinct().join(gpm.select("gene_seqhash_id"), "gene_seqhash_id", "left_anti")
    synthetic = unmapped.select(
        "gene_seqhash_id",
        F.concat(F.split_part(F.col("gene_seqhash_id"), F.lit("."), F.lit(1)), F.lit(".p1")).alias("protein_seqhash_id"),
    ).join(cat.sequences.select(F.col("seqhash_id").alias("protein_seqhash_id")), "protein_seqhash_id", "left_semi")
    new_gpm = gpm.unionByName(synthetic.select("gene_seqhash_id", "protein_seqhash_id"))
    expr = cat.expression.join(new_gpm.select("gene_seqhash_id").distinct(), "gene_seqhash_id", "left_semi")
    return cat.with_tables(gene_protein_map=new_gpm, expression=expr)


class SampleConflict(RuntimeError):
    pass


def conflicting_samples(master: Catalog, incoming: Catalog) -> DataFrame:
    """Samples of ``incoming`` that the master already holds: what makes :func:`merge_strict` refuse."""
    return incoming.sra_metadata.select("sample_id").join(master.sra_metadata.select("sample_id"), "sample_id", "left_semi").distinct()


def merge_strict(master: Catalog, incoming: Catalog, check: bool = True) -> Catalog:
    """M5: refuse when any incoming sample is already in the master; else append the tables,
    gene-map rows only for genes not yet mapped and expression pairs not yet present."""
    if check:
        if not conflicting_samples(master, incoming).isEmpty():
            raise SampleConflict("incoming samples already present in the master catalogue")
    out = {}
    for name in ("sra_metadata", "sequences", "annotations", "go_terms", "ec_numbers", "kegg_info"):
        if master.has(name) and incoming.has(name):
            out[name] = master[name].unionByName(conform(incoming[name], master[name].schema))
    if master.has("gene_protein_map") and incoming.has("gene_protein_map"):
        new = incoming.gene_protein_map.join(master.gene_protein_map.select("gene_seqhash_id").distinct(), "gene_seqhash_id", "left_anti")
        out["gene_protein_map"] = master.gene_protein_map.unionByName(new)
    if master.has("expression") and incoming.has("expression"):
        new = incoming.expression.join(master.expression.select("gene_seqhash_id", "sample_id"), ["gene_seqhash_id", "sample_id"], "left_anti")
        out["expression"] = master.expression.unionByName(new)
    return master.with_tables(**out)


def merge_summary(cat: Catalog) -> DataFrame:
    """M6: rows per table."""
    parts = [cat[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in cat.names]
    return reduce(DataFrame.unionAll, parts)


# ---------------------------------------------------------------------------
# Clusters
# ---------------------------------------------------------------------------
def sequential_ids(df: DataFrame, order_col: str, out_col: str = "seq_no", partitions: int | None = None) -> DataFrame:
    """Dense 1-based numbering of ``df`` by ``order_col`` (unique values) without a global
    window: range-partition, count rows per partition (one small row each), turn the counts
    into offsets over that small frame, and number rows inside each partition.

    The range-partitioned rows are written once with their partition number, and both the
    counts and the numbers come from that copy: range bounds are sampled, so a second
    evaluation could cut the rows differently."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(n, F.col(order_col)).withColumn("_pid", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the window below runs over at most `n` rows.
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("_pid", "_off")
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(order_col))
    return ranged.join(F.broadcast(offsets), "_pid").withColumn(out_col, F.col("_off") + local).drop("_pid", "_off")


def valid_edges(edges: DataFrame, sequences: DataFrame) -> DataFrame:
    """Edges whose representative and member are both catalogue sequences."""
    ids = sequences.select("seqhash_id")
    return (
        edges.join(ids.select(F.col("seqhash_id").alias("representative")), "representative", "left_semi")
        .join(ids.select(F.col("seqhash_id").alias("member")), "member", "left_semi")
    )


def load_clusters(edges: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clusters numbered ``CLUSTER_<n>`` in representative order, size = valid edge rows."""
    v = valid_edges(edges, sequences)
    agg = v.groupBy("representative").agg(F.count(F.lit(1)).cast("int").alias("size"))
    numbered = sequential_ids(agg, "representative")
    clusters = numbered.select(
        F.concat(F.lit("CLUSTER_"), F.col("seq_no").cast("string")).alias("cluster_id"),
        F.col("representative").alias("representative_seqhash_id"), "size",
    )
    clusters = materialise(clusters, "clusters")        # members take their ids from this copy
    members = v.join(clusters.select(F.col("representative_seqhash_id").alias("representative"), "cluster_id"), "representative").select(
        F.col("member").alias("seqhash_id"), "cluster_id"
    ).distinct()
    return clusters, members


def flag_representatives(sequences: DataFrame, clusters: DataFrame) -> DataFrame:
    """TRUE for every cluster representative; existing TRUE flags are never reset."""
    reps = clusters.select(F.col("representative_seqhash_id").alias("seqhash_id")).distinct().withColumn("_rep", F.lit(True))
    cols = sequences.columns
    return sequences.join(reps, "seqhash_id", "left").withColumn(
        "is_representative", F.coalesce(F.col("is_representative"), F.lit(False)) | F.coalesce(F.col("_rep"), F.lit(False))
    ).select(*cols)


@dataclass
class ClusterUpdate:
    sequences: DataFrame
    clusters: DataFrame
    cluster_members: DataFrame
    report: DataFrame


class DuplicateClusters(RuntimeError):
    pass


def assign_representatives(sequences: DataFrame, assign: DataFrame) -> DataFrame:
    """``sequences`` with the representatives of ``assign`` (seqhash_id, rep) and the flag that
    follows from them; other rows stay."""
    upd = sequences.join(assign, "seqhash_id", "left").withColumn("repseq_id", F.coalesce(F.col("rep"), F.col("repseq_id")))
    if "is_representative" in sequences.columns:
        upd = upd.withColumn("is_representative", F.when(F.col("rep").isNotNull(), F.col("seqhash_id") == F.col("rep")).otherwise(F.col("is_representative")))
    return upd.select(*sequences.columns)


def duplicate_clusters(cat: Catalog, edges: DataFrame) -> DataFrame:
    """Clusters of the edge list that the catalogue already holds: what makes mode ``error`` refuse."""
    new = valid_edges(edges, cat.sequences).select(F.col("representative").alias("cluster_id"))
    return cat.clusters.select("cluster_id").join(new, "cluster_id", "left_semi").distinct()


def update_clusters(cat: Catalog, edges: DataFrame, mode: str = "replace") -> ClusterUpdate:
    """Apply a (representative, member) edge list.

    Members get ``repseq_id`` = their representative and ``is_representative`` = (id = rep);
    a member with several edges takes the smallest representative id. cluster_id = the
    representative id; size = valid edge rows. Modes: ``replace`` rebuilds the cluster
    tables; ``ignore`` keeps existing clusters (with their old size) and appends only new
    clusters and new member pairs; ``error`` fails when an edge cluster already exists."""
    if mode not in ("replace", "ignore", "error"):
        raise ValueError(mode)
    v = valid_edges(edges, cat.sequences)
    assign = v.groupBy("member").agg(F.min("representative").alias("rep"))
    new_seqs = assign_representatives(cat.sequences, assign.withColumnRenamed("member", "seqhash_id"))
    new_clusters = v.groupBy(F.col("representative").alias("cluster_id")).agg(F.count(F.lit(1)).cast("int").alias("size")).select(
        "cluster_id", F.col("cluster_id").alias("representative_seqhash_id"), "size"
    )
    new_members = v.select(F.col("member").alias("seqhash_id"), F.col("representative").alias("cluster_id")).distinct()
    if mode == "replace" or not cat.has("clusters"):
        clusters, members = new_clusters, new_members
    else:
        old_c = cat.clusters
        if mode == "error" and not duplicate_clusters(cat, edges).isEmpty():
            raise DuplicateClusters("edge list contains clusters already present")
        clusters = old_c.unionByName(new_clusters.join(old_c.select("cluster_id"), "cluster_id", "left_anti"))
        old_m = cat.cluster_members
        members = old_m.unionByName(new_members.join(old_m, ["seqhash_id", "cluster_id"], "left_anti"))
    report = cluster_update_report(edges, v, new_clusters)
    return ClusterUpdate(new_seqs, clusters, members, report)


def cluster_update_report(edges: DataFrame, valid: DataFrame, clusters: DataFrame) -> DataFrame:
    """Total edges, retained edges, members, clusters, average and maximum size."""
    e = edges.agg(F.count(F.lit(1)).alias("total_edges"))
    v = valid.agg(F.count(F.lit(1)).alias("retained_edges"), F.count_distinct("member").alias("members"))
    c = clusters.agg(F.count(F.lit(1)).alias("clusters"), F.avg("size").alias("avg_size"), F.max("size").alias("max_size"))
    k = F.lit(1).alias("_k")
    return e.select("*", k).join(v.select("*", k), "_k").join(c.select("*", k), "_k").drop("_k")


def missing_sequences(edges: DataFrame, sequences: DataFrame) -> DataFrame:
    """Distinct member ids of the edge list absent from the catalogue."""
    return edges.select(F.col("member").alias("seqhash_id")).distinct().join(sequences.select("seqhash_id"), "seqhash_id", "left_anti")


def missing_representatives(edges: DataFrame, sequences: DataFrame) -> DataFrame:
    return edges.select(F.col("representative").alias("seqhash_id")).distinct().join(sequences.select("seqhash_id"), "seqhash_id", "left_anti")


def update_cluster_tables(cat: Catalog, clusters: DataFrame, members: DataFrame) -> Catalog:
    """Append cluster rows and member pairs not yet present (flags untouched)."""
    c = clusters.dropDuplicates(["cluster_id"]).join(cat.clusters.select("cluster_id"), "cluster_id", "left_anti")
    m = members.dropDuplicates(["seqhash_id", "cluster_id"]).join(cat.cluster_members, ["seqhash_id", "cluster_id"], "left_anti")
    return cat.with_tables(clusters=cat.clusters.unionByName(c.select(*cat.clusters.columns)),
                           cluster_members=cat.cluster_members.unionByName(m.select(*cat.cluster_members.columns)))


def representative_diff(old_reps: DataFrame, new_reps: DataFrame) -> DataFrame:
    """(seqhash_id, change) with change 'added' or 'removed' between two representative sets."""
    o = old_reps.select(F.col(old_reps.columns[0]).alias("seqhash_id")).distinct()
    n = new_reps.select(F.col(new_reps.columns[0]).alias("seqhash_id")).distinct()
    return n.join(o, "seqhash_id", "left_anti").withColumn("change", F.lit("added")).unionByName(
        o.join(n, "seqhash_id", "left_anti").withColumn("change", F.lit("removed"))
    )


def representative_counts(old_reps: DataFrame, new_reps: DataFrame) -> DataFrame:
    o = old_reps.select(F.col(old_reps.columns[0]).alias("r")).distinct().select(F.lit("before").alias("snapshot"), "r")
    n = new_reps.select(F.col(new_reps.columns[0]).alias("r")).distinct().select(F.lit("after").alias("snapshot"), "r")
    return o.unionByName(n).groupBy("snapshot").agg(F.count(F.lit(1)).alias("representatives"))


def cluster_conflicts(edges: DataFrame) -> DataFrame:
    """Ids that are the representative of one cluster and a (non-self) member of another."""
    c1 = edges.filter(F.col("representative") != F.col("member")).select(
        F.col("representative").alias("member_of"), F.col("member").alias("seqhash_id"))
    c2 = edges.select(F.col("representative").alias("seqhash_id")).distinct()
    return c1.join(c2, "seqhash_id").select("seqhash_id", "member_of")


def id_membership_audit(cat: Catalog, ids: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """For each id, where it occurs (long form rows summarised as flags)."""
    i = ids.select(F.col(ids.columns[0]).alias("seqhash_id")).distinct()

    def tag(df: DataFrame, col: str, place: str) -> DataFrame:
        return df.select(F.col(col).alias("seqhash_id")).join(i, "seqhash_id", "left_semi").select("seqhash_id", F.lit(place).alias("place"))

    parts = [
        tag(cat.sequences, "seqhash_id", "sequences"),
        tag(cat.sequences, "repseq_id", "sequences_as_repseq"),
        tag(cat.clusters, "representative_seqhash_id", "clusters_as_representative"),
        tag(cat.cluster_members, "seqhash_id", "cluster_members"),
    ]
    if edges is not None:
        parts += [tag(edges, "representative", "edges_as_representative"), tag(edges, "member", "edges_as_member")]
    u = reduce(DataFrame.unionAll, parts)
    places = ["sequences", "sequences_as_repseq", "clusters_as_representative", "cluster_members"] + (
        ["edges_as_representative", "edges_as_member"] if edges is not None else [])
    agg = u.groupBy("seqhash_id").agg(*[F.count(F.when(F.col("place") == p, 1)).alias(p) for p in places])
    return i.join(agg, "seqhash_id", "left").select("seqhash_id", *[F.coalesce(F.col(p), F.lit(0)).cast("bigint").alias(p) for p in places])


# ---------------------------------------------------------------------------
# Schema versions
# ---------------------------------------------------------------------------
VERSION_SCHEMA = SCHEMA_V2["schema_version"]
MIGRATION_NAMES = {1: "initial_schema", 2: "add_is_representative"}


def detect_schema_version(cat: Catalog) -> int:
    """V1: MAX(version) of the version table, else sniff the columns of ``sequences``."""
    if cat.has("schema_version"):
        v = cat.schema_version.agg(F.max("version")).first()[0]
        if v is not None:
            return int(v)
    if cat.has("sequences"):
        return 2 if "is_representative" in cat.sequences.columns else 1
    return 0


def upgrade_schema(cat: Catalog, target: int | None = None, as_of: _dt.datetime | None = None) -> tuple[Catalog, int]:
    """V2: bring the catalogue up to ``target`` (default latest); a newer recorded version is
    never downgraded. Returns the new catalogue and its version."""
    spark = cat.spark
    current = detect_schema_version(cat)
    target = LATEST_VERSION if target is None else target
    if current >= target:
        return cat, current
    as_of = as_of or _dt.datetime(2000, 1, 1)
    out = cat
    if current < 2 <= target and cat.has("sequences") and "is_representative" not in cat.sequences.columns:
        s = cat.sequences.withColumn("is_representative", F.lit(False))
        out = out.with_tables(sequences=s.select(*SCHEMA_V2["sequences"].fieldNames()))
    rows = [(v, MIGRATION_NAMES.get(v, f"v{v}"), as_of) for v in range(max(current, 0) + 1, target + 1)]
    new_rows = spark.createDataFrame(rows, VERSION_SCHEMA)
    versions = cat.schema_version.unionByName(new_rows) if cat.has("schema_version") else new_rows
    return out.with_tables(schema_version=versions), target


def ensure_compatibility(cat: Catalog, required: int | None = None) -> tuple[int, bool]:
    required = LATEST_VERSION if required is None else required
    v = detect_schema_version(cat)
    return v, v >= required


def apply_migration_gene_map(gpm: DataFrame) -> DataFrame:
    """V3: a single-key gene map becomes a pair-keyed table (duplicates of a pair dropped)."""
    return gpm.dropDuplicates(["gene_seqhash_id", "protein_seqhash_id"])


def conform_to_schema(cat: Catalog, version: int = LATEST_VERSION) -> Catalog:
    """V4: project every known table onto the registry schema of ``version``."""
    schemas = SCHEMAS[version]
    return Catalog(cat.spark, {n: (conform(cat[n], schemas[n]) if n in schemas else cat[n]) for n in cat.names})

