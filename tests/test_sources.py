"""File scans: quant tables, BED, GFF, OBO, run lists, QC JSON and run metadata XML."""

import json
import os

from ortholake import sources


def test_quant_sf_and_indexed_tsv(spark, scratch):
    with open(f"{scratch}/SRR9.quant.sf", "w") as f:
        f.write("Name\tLength\tEffectiveLength\tTPM\tNumReads\ng1\t100\t80.5\t12.5\t40\n")
    r = sources.scan_quant_sf(spark, f"{scratch}/SRR9.quant.sf").collect()[0]
    assert (r["Name"], r["TPM"], r["sample"]) == ("g1", 12.5, "SRR9")
    with open(f"{scratch}/q.tsv", "w") as f:
        f.write("\tName\tLength\tEffectiveLength\tTPM\tNumReads\tsample\n0\tg1\t100\t80.5\t12.5\t40\tSRR9\n")
    r = sources.scan_quant_sf(spark, f"{scratch}/q.tsv", indexed=True).collect()[0]
    assert (r["Name"], r["sample"]) == ("g1", "SRR9")


def test_bed_gff_obo(spark, scratch):
    with open(f"{scratch}/a.bed", "w") as f:
        f.write("track name=x\nc1\t10\t100\tp1\t0\t+\n")
    assert [r["name"] for r in sources.scan_bed(spark, f"{scratch}/a.bed").collect()] == ["p1"]
    with open(f"{scratch}/a.gff3", "w") as f:
        f.write("##gff-version 3\nc1\tT\tgene\t1\t90\t.\t+\t.\tID=GENE.c1~~c1.p1;Name=x\n"
                "c1\tT\tgene\t1\t90\t.\t+\t.\tID=GENE.c1~~c1.p2\nc1\tT\tmRNA\t1\t90\t.\t+\t.\tID=m1\n")
    g = sources.scan_gff_genes(spark, f"{scratch}/a.gff3").collect()
    assert [(r["gene_id"], r["n_features"]) for r in g] == [("GENE.c1", 2)]
    with open(f"{scratch}/go.obo", "w") as f:
        f.write('format-version: 1.2\n\n[Term]\nid: GO:0000001\nname: mitochondrion inheritance\n'
                'def: "The distribution of mitochondria." [GOC:mcc]\n\n[Term]\nid: GO:0000002\nname: other\n')
    o = {r["go_term"]: r for r in sources.scan_ontology(spark, f"{scratch}/go.obo").collect()}
    assert o["GO:0000001"]["go_def"] == "The distribution of mitochondria." and o["GO:0000002"]["go_name"] == "other"


def test_run_list_and_qc_json(spark, scratch):
    with open(f"{scratch}/runs.csv", "w") as f:
        f.write("Run,Assay Type\nSRR1,RNA-Seq\nSRR2,WGS\n")
    assert [r[0] for r in sources.scan_run_list(spark, f"{scratch}/runs.csv").collect()] == ["SRR1"]
    os.makedirs(f"{scratch}/qc", exist_ok=True)
    with open(f"{scratch}/qc/SRR1.fastp.json", "w") as f:
        json.dump({"summary": {"sequencing": "paired end (50 cycles + 50 cycles)",
                               "before_filtering": {"total_reads": 16089680}, "after_filtering": {"total_reads": 14926556}}}, f)
    r = sources.scan_read_qc(spark, f"{scratch}/qc/*.json").collect()[0]
    assert (r["sample_id"], r["reads_before"], r["reads_after"]) == ("SRR1", 16089680, 14926556)
    with open(f"{scratch}/SRR1.stats.txt", "w") as f:
        f.write("#Total\t858881/14926556\n")
    r = sources.scan_contaminant_stats(spark, f"{scratch}/SRR1.stats.txt").collect()[0]
    assert (r["matched"], r["total"]) == (858881, 14926556)


def test_run_metadata_xml(spark, scratch):
    xml = """<EXPERIMENT_PACKAGE_SET><EXPERIMENT_PACKAGE>
<EXPERIMENT><DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_STRATEGY>RNA-Seq</LIBRARY_STRATEGY><LIBRARY_SOURCE>TRANSCRIPTOMIC</LIBRARY_SOURCE>
<LIBRARY_SELECTION>cDNA</LIBRARY_SELECTION><LIBRARY_LAYOUT><PAIRED/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN>
<PLATFORM><ILLUMINA><INSTRUMENT_MODEL>NextSeq 500</INSTRUMENT_MODEL></ILLUMINA></PLATFORM></EXPERIMENT>
<STUDY><IDENTIFIERS><EXTERNAL_ID namespace="BioProject">PRJNA1</EXTERNAL_ID></IDENTIFIERS>
<DESCRIPTOR><STUDY_TITLE>Lichen</STUDY_TITLE><STUDY_ABSTRACT>Abs</STUDY_ABSTRACT></DESCRIPTOR></STUDY>
<SAMPLE><IDENTIFIERS><EXTERNAL_ID namespace="BioSample">SAMN1</EXTERNAL_ID></IDENTIFIERS>
<SAMPLE_NAME><SCIENTIFIC_NAME>Cladonia macilenta</SCIENTIFIC_NAME></SAMPLE_NAME></SAMPLE>
<RUN_SET><RUN accession="SRR14292007" total_spots="1000" total_bases="150000" published="2021-04-20 10:00:00"/></RUN_SET>
</EXPERIMENT_PACKAGE></EXPERIMENT_PACKAGE_SET>"""
    with open(f"{scratch}/SRR14292007.xml", "w") as f:
        f.write(xml)
    r = sources.scan_sample_metadata(spark, f"{scratch}/SRR14292007.xml").collect()[0]
    assert r["sample_id"] == "SRR14292007" and r["organism"] == "Cladonia macilenta"
    assert (r["bioproject"], r["biosample"], r["library_layout"], r["instrument"]) == ("PRJNA1", "SAMN1", "PAIRED", "ILLUMINA")
    assert (r["run_spots"], r["run_bases"]) == (1000, 150000)


def test_run_metadata_is_read_in_one_pass(spark, scratch):
    def record(i, more=""):
        return f"""<EXPERIMENT_PACKAGE kind="x"><EXPERIMENT><DESIGN><LIBRARY_DESCRIPTOR><LIBRARY_STRATEGY>RNA-Seq</LIBRARY_STRATEGY><LIBRARY_LAYOUT>
 <!-- two ends --> <PAIRED NOMINAL_LENGTH="0"/></LIBRARY_LAYOUT></LIBRARY_DESCRIPTOR></DESIGN><PLATFORM><OXFORD_NANOPORE/></PLATFORM></EXPERIMENT>{more}
<STUDY><IDENTIFIERS><EXTERNAL_ID namespace="Other">no</EXTERNAL_ID><EXTERNAL_ID namespace="BioProject">PRJ{i}</EXTERNAL_ID></IDENTIFIERS></STUDY>
<RUN_SET><RUN accession="SRR{i}" total_spots="{i}"/><RUN accession="SRX{i}"/></RUN_SET></EXPERIMENT_PACKAGE>"""

    with open(f"{scratch}/all.xml", "w") as f:
        f.write("<SET>" + "\n".join(record(i) for i in range(300)) + "</SET>")
    with open(f"{scratch}/bare.xml", "w") as f:
        f.write("<SET><EXPERIMENT_PACKAGE><STUDY/></EXPERIMENT_PACKAGE></SET>")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = sources.scan_sample_metadata(spark, f"{scratch}/*.xml")
        assert df.rdd.getNumPartitions() > 3
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    got = {r["sample_id"]: r for r in rows}
    assert len(rows) == 301 and set(got) == {None} | {f"SRR{i}" for i in range(300)}
    r = got["SRR7"]
    assert (r["bioproject"], r["biosample"], r["library_layout"], r["instrument"], r["run_spots"], r["organism"]) == ("PRJ7", None, "PAIRED", "OXFORD_NANOPORE", 7, None)
    assert all(v is None for v in got[None])


def test_json_arrays_are_read_in_several_tasks(spark, scratch):
    import json

    names = ['g"q"', "g{1}", "}", "a\\\\", 'x\\"}{', "plain", "tab\t", "é漢"]
    os.makedirs(f"{scratch}/q")
    for k, (label, use) in enumerate((("S1", ["plain", "é"]), ("S2", names), ("S3", []), ("S4", ["one"]))):
        rows = [{"Name": f"{use[i % len(use)]}{i}", "Length": i, "EffectiveLength": i / 2, "TPM": 1.5, "NumReads": None} | ({"sample": "own"} if k == 3 else {}) for i in range(600 if use else 0)]
        with open(f"{scratch}/q/{label}.quant.json", "w") as f:
            json.dump(rows, f, indent=k if k % 2 else None, ensure_ascii=bool(k % 2))
    whole = spark.read.json(f"{scratch}/q/*.json", schema=sources.QUANT_JSON_SCHEMA, multiLine=True)
    want = sorted((r["Name"], r["Length"], r["EffectiveLength"], r["TPM"], r["NumReads"]) for r in whole.collect())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = sources.scan_expression(spark, f"{scratch}/q/*.json")
        assert df.rdd.getNumPartitions() > 8
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted((r["gene_seqhash_id"], r["length"], r["effective_length"], r["tpm"], r["num_reads"]) for r in rows) == want and len(want) == 1800
    assert {r["sample_id"] for r in rows} == {"S1", "S2", "own"}
