"""Sinks and the remaining ingest / QC helpers."""

import json
import os

from pyspark.sql import functions as F

from ortholake import fixture, sinks, sources
from ortholake.catalog import Catalog
from ortholake.operators import ingest as ig
from ortholake.operators import qc
from ortholake.plans import named as q

SF = "/root/testdata/sf0.001"


def test_table_set_publish_and_read_back(spark, scratch):
    cat = fixture.build(spark, SF)
    sinks.write_table_set(cat, scratch, "v1")
    back = sinks.read_current(spark, scratch)
    assert back.sequences.count() == cat.sequences.count()
    a = q.database_summary(cat).collect()[0].asDict()
    b = q.database_summary(back).collect()[0].asDict()
    assert a == b
    sinks.write_table_set(cat, scratch, "v2")
    assert spark.read.text(os.path.join(scratch, "CURRENT")).first()[0] == "v2"


def test_fasta_export_round_trip(spark, scratch):
    cat = fixture.build(spark, SF)
    sinks.write_fasta(sinks.export_representatives(cat).coalesce(1), os.path.join(scratch, "reps"))
    back = sources.scan_fasta(spark, os.path.join(scratch, "reps", "*.txt"))
    want = cat.sequences.filter(F.col("repseq_id") == F.col("seqhash_id"))
    assert back.count() == want.count()
    got = {r["id"]: r["sequence"] for r in back.collect()}
    # FASTA drops whitespace inside sequences, as the scan does
    assert all(got[r["seqhash_id"]] == r["sequence"].replace(" ", "") for r in want.collect())


def test_cds_coordinates_and_transcript_model(spark):
    prot = spark.createDataFrame([("t1.p1", "MK"), ("t2.p1", "MA")], "seqhash_id string, sequence string")
    bed = spark.createDataFrame([("c1", 5, 50, "t1.p1", "0", "+")], sources.BED_SCHEMA)
    rows = {r["seqhash_id"]: (r["cds_start"], r["cds_end"]) for r in ig.attach_cds_coordinates(prot, bed).collect()}
    assert rows == {"t1.p1": (5, 50), "t2.p1": (None, None)}
    ann = spark.createDataFrame(
        [("t1.abc.p1", "S1", " K|L ", "desc", "nm", "GO:1,GO:2", "-", "1e-5", "10", "1|root")],
        "query string, sample_id string, COG_category string, Description string, Preferred_name string, GOs string, "
        "KEGG_Pathway string, evalue string, score string, max_annot_lvl string")
    r = ig.load_transcript_model(ann).collect()[0]
    assert (r["transcript_seqhash"], r["cog_category"], r["go_terms"], r["kegg_pathways"]) == ("t1", "KL", ["GO:1", "GO:2"], None)


def test_backfill_expression_without_ownership(spark):
    cat = fixture.build(spark, SF)
    quant = cat.expression.select("gene_seqhash_id", "sample_id", "tpm", "num_reads", "effective_length")
    empty = cat.with_tables(expression=cat.expression.limit(0))
    filled = ig.backfill_expression(quant, empty)
    stray = quant.limit(1).withColumn("gene_seqhash_id", F.lit("unmapped"))
    assert filled.count() == quant.count()
    assert ig.backfill_expression(stray, empty).count() == 1      # a gene without a map row is kept
    assert ig.backfill_expression(quant, cat).count() == 0


def test_qc_report_with_qc_files(spark, scratch):
    cat = fixture.build(spark, SF)
    sample = cat.sequences.select("sample_id").first()[0]
    os.makedirs(f"{scratch}/{sample}/aux_info", exist_ok=True)
    with open(f"{scratch}/{sample}/aux_info/meta_info.json", "w") as f:
        json.dump({"percent_mapped": 96.804, "num_mapped": 6771889}, f)
    with open(f"{scratch}/{sample}.json", "w") as f:
        json.dump({"summary": {"sequencing": "paired end", "before_filtering": {"total_reads": 10},
                               "after_filtering": {"total_reads": 9}}}, f)
    mapping = sources.scan_mapping_qc(spark, f"{scratch}/*/aux_info/meta_info.json")
    reads = sources.scan_read_qc(spark, f"{scratch}/{sample}.json")
    rep = {r["sample_id"]: r for r in qc.qc_report(cat, mapping, reads).collect()}
    r = rep[sample]
    assert (r["percent_mapped"], r["reads_mapped"], r["reads_before"], r["reads_after"]) == (96.8, 6771889.0, 10, 9)
    assert r["n50"] is not None and r["n_transcripts"] > 0
    js = sinks.qc_stats_json(qc.qc_report(cat)).filter(F.col("sample_id") == sample).first()["json"]
    assert json.loads(js)["n_transcripts"] == r["n_transcripts"]


def test_catalog_conform_open_missing_tables(spark, scratch):
    cat = Catalog(spark, {"sequences": fixture.build(spark, SF).sequences})
    cat.save(os.path.join(scratch, "c"))
    back = Catalog.open(spark, os.path.join(scratch, "c"))
    assert back.names == ["sequences"]
    r = q.database_summary(back, dynamic=True).collect()[0]
    assert r["status"] == "error"


def test_staged_build_equals_lazy_build(spark, scratch):
    lazy = fixture.build(spark, SF)
    staged = fixture.build(spark, SF, stage_dir=os.path.join(scratch, "stage"))
    for t in ("sequences", "annotations", "go_terms", "ec_numbers", "expression", "clusters"):
        assert sorted(map(tuple, lazy[t].collect())) == sorted(map(tuple, staged[t].collect())), t


def test_guarded_sql_refuses_writes_and_caps_rows(spark):
    import pytest

    from ortholake.plans import adhoc

    cat = fixture.build(spark, SF)
    with pytest.raises(adhoc.RefusedQuery):
        adhoc.guarded_sql(cat, "DROP TABLE sequences")
    rows, truncated = adhoc.guarded_sql_result(cat, "SELECT seqhash_id FROM sequences", max_rows=5)
    assert len(rows) == 5 and truncated
    rows, truncated = adhoc.guarded_sql_result(cat, "SELECT count(*) AS n FROM sequences WHERE length > ?")
    assert len(rows) == 1 and not truncated


def test_quant_cog_and_id_writers(spark, scratch):
    from ortholake.plans import analytics as an

    cat = fixture.build(spark, SF)
    quant = cat.expression.select(F.col("gene_seqhash_id").alias("Name"), F.col("tpm").alias("TPM"))
    sinks.write_quant(quant, os.path.join(scratch, "q_tsv"), sample_id="SRR1")
    back = spark.read.csv(os.path.join(scratch, "q_tsv"), sep="\t", header=True)
    assert back.count() == quant.count() and set(back.columns) == {"Name", "TPM", "sample"}
    sinks.write_quant(quant, os.path.join(scratch, "q_json"), fmt="json")
    assert spark.read.json(os.path.join(scratch, "q_json")).count() == quant.count()
    counts = an.cog_expand_counts(cat)
    sinks.write_cog_counts(counts, os.path.join(scratch, "cog"))
    assert spark.read.csv(os.path.join(scratch, "cog"), header=True).count() == counts.count()
    ids = cat.sequences.select("seqhash_id")
    sinks.export_id_list(ids, os.path.join(scratch, "ids"))
    assert sources.scan_id_list(spark, os.path.join(scratch, "ids")).withColumnRenamed("sample_id", "x").count() == ids.count()
