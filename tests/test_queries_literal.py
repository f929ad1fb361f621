"""Named queries on the studied test-suite's expression catalogue (one sample, three genes)."""

import pytest
from pyspark.sql import functions as F

from ortholake.catalog import Catalog
from ortholake.plans import named as q

G = ["v1_DLS_g1", "v1_DLS_g2", "v1_DLS_g3"]


@pytest.fixture(scope="module")
def cat(spark):
    seqs = spark.createDataFrame(
        [(g + ".p1", "M" * n, "SRR12068547", None, rep, g + ".p1", n) for g, n, rep in zip(G, (5415, 2485, 2114), (False, False, True))],
        "seqhash_id string, sequence string, sample_id string, assembly_date timestamp_ntz, is_representative boolean, repseq_id string, length int")
    gpm = spark.createDataFrame([(g, g + ".p1") for g in G], "gene_seqhash_id string, protein_seqhash_id string")
    expr = spark.createDataFrame(
        [(G[0], "SRR12068547", 3.762602, 1670.012, 5125.11), (G[1], "SRR12068547", 614.765489, 116867.548, 2195.11),
         (G[2], "SRR12068547", 654.468328, 103387.45, 1824.11)],
        "gene_seqhash_id string, sample_id string, tpm double, num_reads double, effective_length double")
    ann = spark.createDataFrame(
        [(G[0] + ".p1", "Phosphoglycerate dehydrogenase", "serA", "E", "SRR12068547"),
         (G[1] + ".p1", "Preflagellin peptidase", "PilD", "NOU", "SRR12068547")],
        "seqhash_id string, description string, preferred_name string, cog_category string, sample_id string")
    meta = spark.createDataFrame([("SRR12068547", "Mesoplasma florum", "Study", "PRJ1")],
                                 "sample_id string, organism string, study_title string, bioproject string")
    return Catalog(spark, {"sequences": seqs, "gene_protein_map": gpm, "expression": expr, "annotations": ann,
                           "sra_metadata": meta})


def test_expression_summary(cat):
    r = q.expression_summary(cat).collect()[0]
    assert r["expression_records"] == 3 and r["sample_id"] == "all"
    assert r["max_tpm"] == 654.47 and r["min_tpm"] == 3.76
    assert q.expression_summary(cat, "SRR12068547").collect()[0]["sample_id"] == "SRR12068547"


def test_expression_distribution(cat):
    rows = [(r["expression_level"], r["count"]) for r in q.expression_distribution(cat).collect()]
    assert rows == [("Medium (1-10 TPM)", 1), ("Very High (>100 TPM)", 2)]


def test_top_expressed_order(cat):
    rows = q.top_expressed_sequences(cat, limit=10).collect()
    assert [r["tpm"] for r in rows] == sorted([r["tpm"] for r in rows], reverse=True)
    assert rows[0]["gene_seqhash_id"] == G[2] and rows[0]["is_representative"] is True


@pytest.mark.parametrize("ident", [G[1], G[1] + ".p1"])
def test_sequence_expression_by_gene_or_protein(cat, ident):
    rows = q.sequence_expression(cat, ident).collect()
    assert len(rows) == 1 and rows[0]["tpm"] == pytest.approx(614.765489)
    assert rows[0]["organism"] == "Mesoplasma florum"


def test_annotation_with_expression(cat):
    rows = q.annotation_with_expression(cat).collect()
    assert [r["preferred_name"] for r in rows] == ["PilD", "serA"]


def test_search_sequences_positive_and_negative(cat, spark):
    full = cat.with_tables(**{
        t: spark.createDataFrame([], s) for t, s in (
            ("go_terms", "seqhash_id string, go_term string"),
            ("cluster_members", "seqhash_id string, cluster_id string"),
            ("clusters", "cluster_id string, representative_seqhash_id string, size int"))})
    full = full.with_tables(annotations=full.annotations.select("*", F.lit(None).cast("double").alias("evalue"),
                                                                F.lit(None).cast("string").alias("seed_ortholog"),
                                                                F.lit(None).cast("string").alias("max_annot_lvl"),
                                                                F.lit(None).cast("string").alias("eggnog_ogs")),
                            sra_metadata=full.sra_metadata.withColumn("biosample", F.lit("SAMN1")))
    hit = q.search_sequences(full, description="peptidase", min_length=2000)
    assert [r["seqhash_id"] for r in hit.collect()] == [G[1] + ".p1"]
    assert q.search_sequences(full, description="no such thing").count() == 0
    assert q.search_sequences(full, cog_categories=["E", "O"]).count() == 2
