"""Ingest from files: the one-sample bundle and the malformed FASTA of the studied test-suite."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ortholake import sources
from ortholake.operators import ingest as ig

P1 = "v1_DLS_" + "a" * 64 + ".p1"
P2 = "v1_DLS_" + "b" * 64 + ".p1"
SEQ1 = "M" + "ACDEFGHIKLMNPQRSTVWY" * 3          # 61 residues
SEQ2 = "ACDEFGHIKLMNPQRSTVWY" * 3            # 60 residues


def _ann_row(q, gos, ec, cog="C"):
    cols = [q, "1234.XP_1", "1e-50", "200.5", "COG1@1|root", "1|root", cog, "Alcohol dehydrogenase", "adhA",
            gos, ec, "ko:K00001", "map00010", "-", "-", "-", "-", "-", "-", "-", "PF00107"]
    return "\t".join(cols)


def write_bundle(root, sample="TEST123"):
    os.makedirs(f"{root}/transdecoder", exist_ok=True)
    os.makedirs(f"{root}/eggnog", exist_ok=True)
    os.makedirs(f"{root}/quants", exist_ok=True)
    with open(f"{root}/transdecoder/{sample}.pep", "w") as f:
        f.write(f">{P1} first protein\n{SEQ1[:30]}\n{SEQ1[30:]}\n>{P2}\n{SEQ2}\n")
    with open(f"{root}/eggnog/{sample}.emapper.annotations", "w") as f:
        f.write("## emapper version\n#query\tseed_ortholog\n")
        f.write(_ann_row(P1, "GO:0008150,GO:0003674,GO:0005575", "ec:1.1.1.1") + "\n")
        f.write(_ann_row(P2, "GO:0016491", "ec:2.2.2.2") + "\n")
        f.write("## 2 queries scanned\n")
    recs = [
        {"Name": P1.split(".p")[0], "Length": 183, "EffectiveLength": 150.0, "TPM": 10.5, "NumReads": 100.0, "sample": sample},
        {"Name": P2.split(".p")[0], "Length": 180, "EffectiveLength": 147.0, "TPM": 5.2, "NumReads": 50.0, "sample": sample},
    ]
    with open(f"{root}/quants/{sample}.quant.json", "w") as f:
        json.dump(recs, f)


def test_bundle_ingest_counts(spark, scratch):
    write_bundle(scratch)
    prot = sources.scan_fasta(spark, f"{scratch}/transdecoder/*.pep")
    assert sorted(r["length"] for r in prot.collect()) == [60, 61]
    ann = sources.scan_annotations(spark, f"{scratch}/eggnog/*.emapper.annotations")
    quant = sources.scan_expression(spark, f"{scratch}/quants/*.quant.json")
    bundle = ig.SampleBundle(samples=ig.sample_order(spark, ["TEST123"]), proteins=prot, annotations=ann, quant=quant)
    cat, report = ig.build_catalog(spark, bundle, as_of=dt.datetime(2024, 1, 1))
    counts = {t: cat[t].count() for t in ("sequences", "annotations", "go_terms", "ec_numbers", "expression", "gene_protein_map")}
    assert counts == {"sequences": 2, "annotations": 2, "go_terms": 4, "ec_numbers": 2, "expression": 2, "gene_protein_map": 2}
    r = report.collect()[0]
    assert (r["status"], r["sequences_loaded"], r["annotations_loaded"], r["duplicates"]) == ("success", 2, 2, 0)
    s = {x["seqhash_id"]: x for x in cat.sequences.collect()}
    assert s[P1]["repseq_id"] == P1 and s[P1]["is_representative"] is False and s[P1]["length"] == 61
    assert cat.annotations.filter(F.col("evalue") == 1e-50).count() == 2


def test_ingest_twice_adds_nothing_and_rejects_present_sample(spark, scratch):
    write_bundle(scratch)
    prot = sources.scan_fasta(spark, f"{scratch}/transdecoder/*.pep")
    ann = sources.scan_annotations(spark, f"{scratch}/eggnog/*.emapper.annotations")
    bundle = ig.SampleBundle(samples=ig.sample_order(spark, ["TEST123"]), proteins=prot, annotations=ann)
    cat, _ = ig.build_catalog(spark, bundle)
    cat2, report = ig.update_catalog(spark, bundle, cat)
    assert cat2.sequences.count() == 2 and cat2.go_terms.count() == 4
    r = report.collect()[0]
    assert r["status"] == "error" and r["sequences_loaded"] == 0


def test_duplicates_across_samples_first_writer_wins(spark, scratch):
    for s in ("S1", "S2"):
        os.makedirs(f"{scratch}/p", exist_ok=True)
        with open(f"{scratch}/p/{s}.pep", "w") as f:
            f.write(f">shared.p1\n{'A' * 10 if s == 'S1' else 'C' * 12}\n>own_{s}.p1\nMK\n")
    prot = sources.scan_fasta(spark, f"{scratch}/p/*.pep")
    bundle = ig.SampleBundle(samples=ig.sample_order(spark, ["S2", "S1"]), proteins=prot)
    cat, report = ig.build_catalog(spark, bundle)
    owner = cat.sequences.filter("seqhash_id = 'shared.p1'").collect()[0]
    assert owner["sample_id"] == "S2" and owner["length"] == 12
    rep = {r["sample_id"]: (r["sequences_loaded"], r["duplicates"]) for r in report.collect()}
    assert rep == {"S2": (2, 0), "S1": (1, 1)}


def test_malformed_fasta_double_marker(spark, scratch):
    with open(f"{scratch}/SRR1.pep", "w") as f:
        f.write(">a desc one\nMKV\n>>b\nMKVL\n>c\nM\nK\n")
    rows = {r["id"]: r for r in sources.scan_fasta(spark, f"{scratch}/SRR1.pep").collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"]["description"] == "desc one" and rows["c"]["sequence"] == "MK" and rows["b"]["sample_id"] == "SRR1"


def test_kegg_row_needs_an_informative_field(spark, scratch):
    write_bundle(scratch)
    prot = sources.scan_fasta(spark, f"{scratch}/transdecoder/*.pep")
    ann = sources.scan_annotations(spark, f"{scratch}/eggnog/*.emapper.annotations").withColumn(
        "KEGG_ko", F.when(F.col("query") == P2, F.lit("-")).otherwise(F.col("KEGG_ko"))).withColumn(
        "KEGG_Pathway", F.when(F.col("query") == P2, F.lit("-")).otherwise(F.col("KEGG_Pathway"))).withColumn(
        "PFAMs", F.when(F.col("query") == P2, F.lit(None)).otherwise(F.col("PFAMs")))
    bundle = ig.SampleBundle(samples=ig.sample_order(spark, ["TEST123"]), proteins=prot, annotations=ann)
    cat, _ = ig.build_catalog(spark, bundle)
    assert [r["seqhash_id"] for r in cat.kegg_info.collect()] == [P1]
