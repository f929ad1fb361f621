"""Cluster maintenance, merge and schema versions on the literal fixtures of the studied tests."""

import pytest
from pyspark.sql import functions as F

from ortholake.catalog import SCHEMA_V2, Catalog, conform
from ortholake.operators import maintain as mt


def _cat(spark, seqs):
    s = spark.createDataFrame(
        [(i, "MK", smp, None, False, i, 2) for i, smp in seqs],
        "seqhash_id string, sequence string, sample_id string, assembly_date timestamp_ntz, is_representative boolean, "
        "repseq_id string, length int",
    )
    empty = {n: spark.createDataFrame([], SCHEMA_V2[n]) for n in ("clusters", "cluster_members")}
    return Catalog(spark, {"sequences": s, **empty})


def test_edges_with_missing_ids(spark):
    cat = _cat(spark, [(f"seq{i}", "s") for i in range(1, 6)])
    edges = spark.createDataFrame(
        [("seq1", "seq1"), ("seq1", "seq2"), ("seq3", "seq3"), ("seq3", "seq4"), ("seq1", "seq_missing1"),
         ("seq_missing2", "seq_missing2")], "representative string, member string")
    up = mt.update_clusters(cat, edges)
    s = {r["seqhash_id"]: r for r in up.sequences.collect()}
    assert s["seq2"]["repseq_id"] == "seq1" and s["seq4"]["repseq_id"] == "seq3"
    assert s["seq5"]["repseq_id"] == "seq5" and s["seq5"]["is_representative"] is False
    assert s["seq1"]["is_representative"] and not s["seq2"]["is_representative"]
    assert sorted(r["cluster_id"] for r in up.clusters.collect()) == ["seq1", "seq3"]
    assert "seq5" not in {r["seqhash_id"] for r in up.cluster_members.collect()}
    assert sorted(r[0] for r in mt.missing_sequences(edges, cat.sequences).collect()) == ["seq_missing1", "seq_missing2"]


def test_one_cluster_of_three(spark):
    cat = _cat(spark, [("seq1", "sample1"), ("seq2", "sample1"), ("seq3", "sample2")])
    edges = spark.createDataFrame([("seq1", m) for m in ("seq1", "seq2", "seq3")], "representative string, member string")
    up = mt.update_clusters(cat, edges)
    assert [(r["cluster_id"], r["size"]) for r in up.clusters.collect()] == [("seq1", 3)]
    assert {r["repseq_id"] for r in up.sequences.collect()} == {"seq1"}
    clusters, members = mt.load_clusters(edges, cat.sequences)
    assert [(r["cluster_id"], r["size"]) for r in clusters.collect()] == [("CLUSTER_1", 3)]


def test_update_modes(spark):
    cat = _cat(spark, [("seq1", "s"), ("seq2", "s"), ("seq3", "s")])
    e1 = spark.createDataFrame([("seq1", "seq1"), ("seq1", "seq2")], "representative string, member string")
    up = mt.update_clusters(cat, e1)
    cat2 = cat.with_tables(sequences=up.sequences, clusters=up.clusters, cluster_members=up.cluster_members)
    e2 = spark.createDataFrame([("seq1", "seq3"), ("seq3", "seq3")], "representative string, member string")
    ign = mt.update_clusters(cat2, e2, mode="ignore")
    sizes = {r["cluster_id"]: r["size"] for r in ign.clusters.collect()}
    assert sizes == {"seq1": 2, "seq3": 1}          # existing cluster keeps its stale size
    with pytest.raises(mt.DuplicateClusters):
        mt.update_clusters(cat2, e2, mode="error")


def test_sequential_ids_equal_row_number(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("k"))
    got = {r["k"]: r["seq_no"] for r in mt.sequential_ids(df, "k", partitions=7).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(got))}


def test_merge_two_sources_first_wins_and_defaults(spark):
    def one(tag, with_flag):
        seqs = spark.createDataFrame([(f"seq_{tag}", "MK", f"S{tag}", 2)], "seqhash_id string, sequence string, sample_id string, length int")
        if with_flag:
            seqs = seqs.withColumn("is_representative", F.lit(True))
        meta = spark.createDataFrame([("SX", f"org {tag}")], "sample_id string, organism string")
        return Catalog(spark, {"sequences": seqs, "sra_metadata": meta})

    merged = mt.merge_catalogs([one("a", True), one("b", False)])
    rows = {r["seqhash_id"]: r["is_representative"] for r in merged.sequences.collect()}
    assert rows == {"seq_a": True, "seq_b": False}
    assert [r["organism"] for r in merged.sra_metadata.collect()] == ["org a"]
    again = mt.merge_catalogs([merged, merged])
    assert again.sequences.count() == 2


def test_schema_versions(spark):
    s = spark.createDataFrame([("a", "MK", "S", None, "a", 2)],
                              "seqhash_id string, sequence string, sample_id string, assembly_date timestamp_ntz, repseq_id string, length int")
    cat = Catalog(spark, {"sequences": s})
    assert mt.detect_schema_version(cat) == 1
    up, v = mt.upgrade_schema(cat)
    assert v == 2 and up.sequences.collect()[0]["is_representative"] is False
    assert mt.detect_schema_version(up) == 2
    v3 = up.with_tables(schema_version=spark.createDataFrame([(3, "future", None)], SCHEMA_V2["schema_version"]))
    same, v = mt.upgrade_schema(v3, target=2)
    assert v == 3 and same is v3
    assert mt.ensure_compatibility(up) == (2, True)
    assert conform(s, SCHEMA_V2["sequences"]).columns == SCHEMA_V2["sequences"].fieldNames()
