"""Queries that go through files and written tables: scans, sinks, whole ingests, schema versions.

Each writes what its operator reads, derived from the given tables, to a new folder under
``spark.checkpoint.dir``, and reads it back through the library's own scan or sink.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ortholake import fixture
from ortholake.catalog import SCHEMA_V1, SCHEMA_V2, Catalog
from ortholake.operators import ingest as ig
from ortholake.operators import maintain as mt
from ortholake.operators import qc
from ortholake.operators import seqsets as ss
from ortholake.plans import analytics as an
from ortholake.session import materialise, scratch_path
from ortholake.sinks import bucketed
from ortholake.sinks import writers as wr
from ortholake.sinks.manifest import Change, VersionedTables, key_ranges
from ortholake.sources import files as src

AS_OF = _dt.datetime(2000, 1, 1)
SAMPLES_A_FILE = 256          # of the quantification that is written


def _cat(spark, d) -> Catalog:
    return fixture.build(spark, d)


def _written(df: DataFrame, name: str, kind: str = "text", **options) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.format(kind).options(**options).save(path)
    return path


# Scans --------------------------------------------------------------------------------
def scan_fasta(spark, d) -> DataFrame:
    path = scratch_path(spark, "fasta")
    wr.write_fasta(wr.fasta_records(_cat(spark, d).sequences), path)
    return src.scan_fasta(spark, path).select("id", "description", "sequence", "length")


def scan_annotations(spark, d) -> DataFrame:
    rows = fixture.incoming(spark, d)["annotations"].select(*src.ANNOTATION_COLUMNS)
    return src.scan_annotations(spark, _written(rows, "annotations", "csv", sep="\t")).drop("sample_id")


def scan_expression(spark, d) -> DataFrame:
    e = _cat(spark, d).expression
    record = F.to_json(F.struct(F.col("gene_seqhash_id").alias("Name"), F.lit(9).alias("Length"), F.col("effective_length").alias("EffectiveLength"),
                                F.col("tpm").alias("TPM"), F.col("num_reads").alias("NumReads"), F.col("sample_id").alias("sample")))
    # One array per sample, as the quantifier writes them; a file holds those of several samples, so that
    # the number of files does not grow with the number of samples.
    arrays = e.select("sample_id", record.alias("r")).groupBy("sample_id").agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ",\n"), F.lit("]")).alias("value"))
    path = scratch_path(spark, "quant")
    arrays.select("value").write.option("maxRecordsPerFile", SAMPLES_A_FILE).text(path)
    return src.scan_expression(spark, path)


def scan_cluster_tsv(spark, d) -> DataFrame:
    return src.scan_cluster_tsv(spark, _written(fixture.cluster_edges(_cat(spark, d)), "edges", "csv", sep="\t"))


def scan_quant_sf(spark, d) -> DataFrame:
    """Quantification written as TSV and scanned."""
    e = _cat(spark, d).expression
    path = scratch_path(spark, "quant")
    wr.write_quant(e.select(F.col("gene_seqhash_id").alias("Name"), F.lit(9).cast("long").alias("Length"), F.col("effective_length").alias("EffectiveLength"),
                            F.col("tpm").alias("TPM"), F.col("num_reads").alias("NumReads")), path)
    return src.scan_quant_sf(spark, path).drop("sample")


def write_quant_formatted(spark, d) -> DataFrame:
    """K4 with the sample as a column, read back as JSON lines."""
    e = _cat(spark, d).expression
    path = scratch_path(spark, "quant")
    wr.write_quant(e.select(F.col("gene_seqhash_id").alias("Name"), F.col("tpm").alias("TPM")), path, sample_id="SRR1", fmt="json")
    return spark.read.schema("Name string, TPM double, sample string").json(path)


def _bed(spark, d) -> DataFrame:
    s = _cat(spark, d).sequences.filter("not is_representative")
    rows = s.select(F.split_part("seqhash_id", F.lit(".p"), F.lit(1)).alias("chrom"), F.lit(3).alias("start"), (F.col("length") * 3).alias("end"),
                    F.col("seqhash_id").alias("name"), F.lit("0").alias("score"), F.lit("+").alias("strand"))
    head = spark.createDataFrame([("track name=cds", None, None, None, None, None)], "chrom string, start int, end int, name string, score string, strand string")
    return src.scan_bed(spark, _written(head.unionByName(rows), "bed", "csv", sep="\t"))


def attach_cds_coordinates(spark, d) -> DataFrame:
    return ig.attach_cds_coordinates(_cat(spark, d).sequences.select("seqhash_id", "length"), _bed(spark, d))


def scan_gff_genes(spark, d) -> DataFrame:
    s = _cat(spark, d).sequences
    gene = F.split_part("seqhash_id", F.lit(".p"), F.lit(1))
    kinds = F.explode(F.array(F.lit("gene"), F.lit("mRNA")))
    rows = s.select(gene.alias("a"), F.lit("own").alias("b"), kinds.alias("c"), F.lit(1).alias("d"), F.col("length").alias("e"), F.lit(".").alias("f"),
                    F.lit("+").alias("g"), F.lit(".").alias("h"), F.concat(F.lit("ID="), gene, F.lit("~~"), F.col("seqhash_id"), F.lit(";Name=x")).alias("i"))
    return src.scan_gff_genes(spark, _written(rows, "gff", "csv", sep="\t"))


def scan_ontology(spark, d) -> DataFrame:
    o = an.derived_ontology(_cat(spark, d))
    stanza = F.concat(F.lit("[Term]\nid: "), "go_term", F.lit("\nname: "), "go_name", F.lit('\ndef: "'), "go_def", F.lit('" [own:1]\n'))
    return src.scan_ontology(spark, _written(o.select(stanza.alias("value")), "ontology"))


def scan_run_list(spark, d) -> DataFrame:
    m = _cat(spark, d).sra_metadata
    runs = m.select(F.col("sample_id").alias("Run"), F.when(F.col("library_layout") == "PAIRED", "RNA-Seq").otherwise("WGS").alias("Assay Type"), "organism")
    return src.scan_run_list(spark, _written(runs, "runs", "csv", header=True))


def export_id_list(spark, d) -> DataFrame:
    path = scratch_path(spark, "ids")
    wr.export_id_list(_cat(spark, d).sra_metadata.select("sample_id"), path)
    return src.scan_id_list(spark, path)


def scan_contaminant_stats(spark, d) -> DataFrame:
    """The statistics of a screen, written one sample a folder and scanned."""
    docs, bench = (fixture.read_table(spark, d, t) for t in ("documents", "benchmark"))
    r = ss.screen_report(docs, bench)
    lines = r.select("source", F.concat(F.lit("#Total\n#Matched\t"), "reads_removed", F.lit("/"), "reads_in", F.lit("\nlast 9/9")).alias("value"))
    path = scratch_path(spark, "screen")
    lines.repartition("source").write.partitionBy("source").text(path)
    got = src.scan_contaminant_stats(spark, f"{path}/*")
    return got.agg(F.count(F.lit(1)).alias("samples"), F.sum("matched").alias("matched"), F.sum("total").alias("total"))


# Sinks --------------------------------------------------------------------------------
def write_table_set(spark, d) -> DataFrame:
    root = scratch_path(spark, "set")
    cat = fixture.staged(spark, d)
    wr.write_table_set(cat.with_tables(sequences=cat.sequences.limit(0)), root, "v1")
    wr.write_table_set(cat, root, "v2")
    return wr.read_current(spark, root).sequences


def versioned_tables(spark, d) -> DataFrame:
    """Three commits, one of which rewrites the files that hold representatives, and a replay."""
    cat = _cat(spark, d)
    schema = SCHEMA_V2["sequences"]
    tables = VersionedTables(spark, scratch_path(spark, "versioned"))
    even = fixture._parity("sample_id") == 0
    for tag, rows in (("even", cat.sequences.filter(even)), ("odd", cat.sequences.filter(~even)), ("even", cat.sequences.filter(even))):
        tables.commit({"sequences": key_ranges(rows, ["seqhash_id"])}, tag)
    reps = cat.sequences.filter("is_representative").select("seqhash_id")
    hit = tables.touched("sequences", schema, "seqhash_id", reps)
    old = spark.read.schema(schema).parquet(*[f"{tables.root}/{n}" for n in hit])
    tables.commit({"sequences": Change(old.withColumn("assembly_date", F.lit(AS_OF).cast("timestamp_ntz")), hit)}, "dates")
    now = tables.read("sequences", schema)
    return now.groupBy("is_representative").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"),
                                                F.count(F.when(F.col("is_representative") & (F.year("assembly_date") != 2000), 1)).alias("not_dated"))


def bucketed_tables(spark, d) -> DataFrame:
    """K1 by buckets: sequences with annotation, cluster and pathways over a bucketed table set."""
    root = scratch_path(spark, "bucketed")
    bucketed.write_bucketed(fixture.staged(spark, d), root, 8)
    c = bucketed.open_bucketed(spark, root)
    a = c.annotations.select("seqhash_id", "preferred_name")
    k = c.kegg_info.select("seqhash_id", "kegg_pathway")
    s = c.sequences.select("seqhash_id", "length")
    return s.join(a, "seqhash_id", "left").join(c.cluster_members, "seqhash_id", "left").join(k, "seqhash_id", "left")


def write_qc_stats(spark, d) -> DataFrame:
    path = scratch_path(spark, "qc")
    wr.write_qc_stats(qc.assembly_totals(qc.transcripts(_cat(spark, d))), path)
    return spark.read.schema("sample_id string, n_transcripts long, total_length long").json(path)


def write_cog_counts(spark, d) -> DataFrame:
    path = scratch_path(spark, "cog")
    wr.write_cog_counts(an.cog_counts_representatives(_cat(spark, d)), path)
    return spark.read.schema("cog_category string, category_count long").option("header", True).csv(path)


# Whole ingests ------------------------------------------------------------------------
def _bundle(inc: dict[str, DataFrame], keep=None) -> ig.SampleBundle:
    if keep is not None:
        inc = {k: v.filter(keep) for k, v in inc.items()}
    return ig.SampleBundle(inc["samples"], inc["proteins"].withColumnRenamed("seqhash_id", "id").drop("sample_rank"),
                           inc["annotations"].drop("sample_rank"), inc["quant"].drop("sample_rank"))


def _rows_per_table(cat: Catalog) -> DataFrame:
    return mt.merge_summary(cat)


def build_catalog(spark, d) -> DataFrame:
    return _rows_per_table(ig.build_catalog(spark, _bundle(fixture.incoming(spark, d, stage=True)), as_of=AS_OF, stage=materialise)[0])


def _updated(spark, d):
    inc = fixture.incoming(spark, d, stage=True)
    first, _ = ig.build_catalog(spark, _bundle(inc, F.col("sample_rank") % 3 != 0), as_of=AS_OF, stage=materialise)
    path = scratch_path(spark, "first")
    first.save(path)
    return ig.update_catalog(spark, _bundle(inc, F.col("sample_rank") % 2 == 0), Catalog.open(spark, path), as_of=AS_OF, stage=materialise)


def update_catalog(spark, d) -> DataFrame:
    return _updated(spark, d)[0].sequences


def update_report(spark, d) -> DataFrame:
    """I9 where some samples are there already: their status is an error."""
    return _updated(spark, d)[1].select("sample_id", "status", "sequences_loaded", "duplicates", "error")


def upsert_sample_metadata(spark, d) -> DataFrame:
    m = _cat(spark, d).sra_metadata
    new = m.filter(F.col("library_layout") == "PAIRED").withColumn("study_title", F.concat(F.lit("new "), "study_title"))
    return ig.upsert_sample_metadata(m, new)


def _partly_known(spark, d) -> tuple[Catalog, dict]:
    """A catalogue that lacks the gene map and the expression, and the metadata of every fourth sample."""
    cat, inc = _cat(spark, d), fixture.incoming(spark, d)
    meta = cat.sra_metadata.filter(F.substring("sample_id", 4, 9).cast("int") % 4 != 0)
    return cat.with_tables(sra_metadata=meta, gene_protein_map=cat.gene_protein_map.limit(0), expression=cat.expression.limit(0)), inc


def backfill_expression(spark, d) -> DataFrame:
    cat, inc = _partly_known(spark, d)
    return ig.backfill_expression(inc["quant"], cat)


def backfill_gene_map(spark, d) -> DataFrame:
    cat, inc = _partly_known(spark, d)
    return ig.backfill_gene_map(inc["proteins"], cat)


def expression_gene_map(spark, d) -> DataFrame:
    cat, inc = _partly_known(spark, d)
    return ig.expression_gene_map(inc["quant"].filter("tpm > 500"), cat)


def load_transcript_model(spark, d) -> DataFrame:
    t = ig.load_transcript_model(fixture.incoming(spark, d)["annotations"])
    return t.groupBy("transcript_seqhash").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("go_terms")).alias("go_terms"), F.max(F.size("kegg_pathways")).alias("pathways"),
                                               F.min("cog_category").alias("cog_category"), F.min("stats").alias("stats"))


# Schema versions ----------------------------------------------------------------------
def detect_schema_version(spark, d) -> DataFrame:
    cat = _cat(spark, d)
    old = cat.with_tables(sequences=cat.sequences.drop("is_representative"))
    new, version = mt.upgrade_schema(old, as_of=AS_OF)
    rows = [("old", mt.detect_schema_version(old), *mt.ensure_compatibility(old)), ("new", version, *mt.ensure_compatibility(new))]
    found = spark.createDataFrame(rows, "catalogue string, version int, checked int, compatible boolean")
    return found.join(new.sequences.agg(F.count(F.lit(1)).alias("sequences")))         # one row


def apply_migration_gene_map(spark, d) -> DataFrame:
    g = _cat(spark, d).gene_protein_map
    return mt.apply_migration_gene_map(g.unionByName(g.filter(F.col("protein_seqhash_id").endswith(".p1"))))


def conform_to_schema(spark, d) -> DataFrame:
    cat = _cat(spark, d)
    mixed = cat.with_tables(sequences=cat.sequences.drop("repseq_id").withColumn("length", F.col("length").cast("string")).withColumn("more", F.lit(1)))
    return mt.conform_to_schema(mixed, 1).sequences.select(*SCHEMA_V1["sequences"].fieldNames())


# QC with reads and mapping ---------------------------------------------------------------
def _mapping(spark, d) -> DataFrame:
    """Read mapping of two samples in three: reads of genes with a TPM above 300 count as mapped."""
    e = _cat(spark, d).expression.filter(F.substring("sample_id", 4, 9).cast("int") % 3 != 0)
    mapped = F.sum(F.when(F.col("tpm") > 300, F.col("num_reads")).otherwise(0.0))
    return e.groupBy("sample_id").agg((mapped * 100 / F.sum("num_reads")).alias("percent_mapped"), mapped.alias("num_mapped"))


def _reads(spark, d) -> DataFrame:
    m = _cat(spark, d).sra_metadata.filter("library_layout = 'PAIRED'")
    return m.select("sample_id", F.col("run_spots").cast("long").alias("reads_before"), (F.col("run_spots") - 7).cast("long").alias("reads_after"),
                    F.lit("paired end (2x75)").alias("sequencing_type"))


def mapping_stats(spark, d) -> DataFrame:
    return qc.mapping_stats(_mapping(spark, d))


def read_totals(spark, d) -> DataFrame:
    return qc.read_totals(_reads(spark, d))


def qc_report_full(spark, d) -> DataFrame:
    return qc.with_not_available(qc.qc_report(fixture.staged(spark, d), _mapping(spark, d), _reads(spark, d)))


# SQL ------------------------------------------------------------------------------------
_ANN = ", ".join(src.ANNOTATION_COLUMNS)
_MAPPING_SQL = """SELECT sample_id, CAST(floor(sum(CASE WHEN tpm > 300 THEN num_reads ELSE 0 END) * 100 / sum(num_reads) * 100 + 0.5) / 100 AS DOUBLE) AS percent_mapped,
  CAST(sum(CASE WHEN tpm > 300 THEN num_reads ELSE 0 END) AS DOUBLE) AS reads_mapped
FROM expression WHERE CAST(substr(sample_id, 4) AS INT) % 3 <> 0 GROUP BY sample_id"""
_READS_SQL = """SELECT sample_id, CAST(run_spots AS BIGINT) AS reads_before, CAST(run_spots - 7 AS BIGINT) AS reads_after, 'paired end (2x75)' AS sequencing_type
FROM sra_metadata WHERE library_layout = 'PAIRED'"""
_FIRST = "SELECT * FROM in_proteins WHERE sample_rank % 3 <> 0"
_LATER = "SELECT * FROM in_proteins WHERE sample_rank % 2 = 0 AND sample_rank % 3 = 0"
_UPDATED = f"""
SELECT seqhash_id, sequence, sample_id, TIMESTAMP '{fixture.AS_OF}' AS assembly_date, FALSE AS is_representative, seqhash_id AS repseq_id,
       CAST(length(sequence) AS INT) AS length
FROM (SELECT *, row_number() OVER (PARTITION BY seqhash_id ORDER BY batch, sample_rank, record_no, sequence) AS rn
      FROM (SELECT 1 AS batch, * FROM ({_FIRST}) UNION ALL SELECT 2, * FROM ({_LATER})) u) t WHERE rn = 1"""
_KNOWN = "CAST(substr(sample_id, 4) AS INT) % 4 <> 0"

SQL = {
    "scan_fasta": fixture.oracle("SELECT seqhash_id AS id, '' AS description, replace(sequence, ' ', '') AS sequence, CAST(length(replace(sequence, ' ', '')) AS INT) AS length FROM sequences"),
    "scan_annotations": fixture.oracle_incoming(f"SELECT {_ANN} FROM in_annotations"),
    "scan_expression": fixture.oracle("SELECT gene_seqhash_id, CAST(9 AS BIGINT) AS length, effective_length, tpm, num_reads, sample_id FROM expression"),
    "scan_cluster_tsv": fixture.oracle_maintain("SELECT representative, member FROM edges"),
    "scan_quant_sf": fixture.oracle("""SELECT gene_seqhash_id AS "Name", CAST(9 AS BIGINT) AS "Length", effective_length AS "EffectiveLength", tpm AS "TPM", num_reads AS "NumReads" FROM expression"""),
    "write_quant": fixture.oracle("""SELECT gene_seqhash_id AS "Name", tpm AS "TPM", 'SRR1' AS sample FROM expression"""),
    "scan_bed": fixture.oracle("""SELECT split_part(seqhash_id, '.p', 1) AS chrom, CAST(3 AS BIGINT) AS start, CAST(length * 3 AS BIGINT) AS "end", seqhash_id AS name, '0' AS score, '+' AS strand
FROM sequences WHERE NOT is_representative"""),
    "attach_cds_coordinates": fixture.oracle("""SELECT seqhash_id, length, CASE WHEN NOT is_representative THEN CAST(3 AS BIGINT) END AS cds_start,
  CASE WHEN NOT is_representative THEN CAST(length * 3 AS BIGINT) END AS cds_end FROM sequences"""),
    "scan_gff_genes": fixture.oracle("""SELECT gene AS gene_id, count(*) AS n_features, list(gene || '~~' || seqhash_id ORDER BY gene || '~~' || seqhash_id) AS feature_ids
FROM (SELECT seqhash_id, split_part(seqhash_id, '.p', 1) AS gene FROM sequences) t GROUP BY gene"""),
    "scan_ontology": fixture.oracle("""SELECT DISTINCT go_term, split_part(go_term, ':', 2) AS go_name, 'Any process involving ' || split_part(go_term, ':', 2) AS go_def FROM go_terms"""),
    "scan_run_list": fixture.oracle("SELECT sample_id FROM sra_metadata WHERE library_layout = 'PAIRED'"),
    "export_id_list": fixture.oracle("SELECT sample_id FROM sra_metadata"),
    "write_table_set": fixture.oracle("SELECT * FROM sequences"),
    "versioned_tables": fixture.oracle("SELECT is_representative, count(*) AS n, CAST(sum(length) AS BIGINT) AS length, CAST(0 AS BIGINT) AS not_dated FROM sequences GROUP BY 1"),
    "bucketed_tables": fixture.oracle("""SELECT seqhash_id, length, preferred_name, cluster_id, kegg_pathway FROM sequences LEFT JOIN annotations USING (seqhash_id)
LEFT JOIN cluster_members USING (seqhash_id) LEFT JOIN kegg_info USING (seqhash_id)"""),
    "write_qc_stats": fixture.oracle("SELECT sample_id, count(*) AS n_transcripts, CAST(sum(length) AS BIGINT) AS total_length FROM sequences GROUP BY sample_id"),
    "write_cog_counts": fixture.oracle("""SELECT cog_category, count(*) AS category_count FROM annotations
WHERE EXISTS (SELECT 1 FROM sequences s WHERE s.seqhash_id = annotations.seqhash_id AND s.is_representative) GROUP BY cog_category"""),
    "build_catalog": fixture.oracle_incoming("""
SELECT 'sra_metadata' AS table_name, count(*) AS row_count FROM in_samples
UNION ALL SELECT 'sequences', count(*) FROM in_seq
UNION ALL SELECT 'gene_protein_map', count(*) FROM in_seq
UNION ALL SELECT 'expression', count(*) FROM in_quant q WHERE EXISTS (SELECT 1 FROM in_seq s WHERE s.sample_id = q.sample_id AND split_part(s.seqhash_id, '.p', 1) = q.gene_seqhash_id)
UNION ALL SELECT 'annotations', count(*) FROM in_ann_first
UNION ALL SELECT 'go_terms', count(*) FROM (SELECT DISTINCT query, unnest(string_split(GOs, ',')) FROM in_annotations WHERE GOs <> '-') t
UNION ALL SELECT 'ec_numbers', count(*) FROM (SELECT DISTINCT query, EC FROM in_annotations WHERE EC <> '-') t
UNION ALL SELECT 'kegg_info', count(DISTINCT query) FROM in_annotations WHERE KEGG_ko <> '-' OR KEGG_Pathway <> '-' OR PFAMs <> '-'
UNION ALL SELECT 'clusters', 0 UNION ALL SELECT 'cluster_members', 0"""),
    "update_catalog": fixture.oracle_incoming(_UPDATED),
    "update_report": fixture.oracle_incoming(f"""
SELECT s.sample_id, CASE WHEN sample_rank % 3 <> 0 THEN 'error' ELSE 'success' END AS status,
       CAST(coalesce(loaded, 0) AS BIGINT) AS sequences_loaded, CAST(coalesce(dups, 0) AS BIGINT) AS duplicates,
       CASE WHEN sample_rank % 3 <> 0 THEN 'sample already in catalogue' END AS error
FROM in_samples s LEFT JOIN (
  SELECT p.sample_id, count(*) FILTER (o.sample_id = p.sample_id) AS loaded, count(*) FILTER (o.sample_id <> p.sample_id) AS dups
  FROM ({_LATER}) p JOIN ({_UPDATED}) o USING (seqhash_id) GROUP BY p.sample_id) r ON r.sample_id = s.sample_id
WHERE sample_rank % 2 = 0"""),
    "upsert_sample_metadata": fixture.oracle("SELECT * REPLACE (CASE WHEN library_layout = 'PAIRED' THEN 'new ' || study_title ELSE study_title END AS study_title) FROM sra_metadata"),
    "backfill_expression": fixture.oracle_incoming(f"SELECT gene_seqhash_id, sample_id, tpm, num_reads, effective_length FROM in_quant WHERE {_KNOWN}"),
    "backfill_gene_map": fixture.oracle_incoming(f"SELECT DISTINCT split_part(seqhash_id, '.p', 1) AS gene_seqhash_id, seqhash_id AS protein_seqhash_id FROM in_proteins WHERE {_KNOWN}"),
    "expression_gene_map": fixture.oracle("""SELECT split_part(seqhash_id, '.p', 1) AS gene_seqhash_id, seqhash_id AS protein_seqhash_id FROM sequences
WHERE sample_id IN (SELECT s.sample_id FROM sequences s JOIN expression e ON e.sample_id = s.sample_id AND e.gene_seqhash_id = split_part(s.seqhash_id, '.p', 1) WHERE tpm > 500)"""),
    "load_transcript_model": fixture.oracle_incoming("""
SELECT split_part(query, '.', 1) AS transcript_seqhash, count(*) AS n, CAST(max(CASE WHEN GOs <> '-' THEN len(string_split(GOs, ',')) END) AS INT) AS go_terms,
       CAST(max(CASE WHEN KEGG_Pathway <> '-' THEN len(string_split(KEGG_Pathway, ',')) END) AS INT) AS pathways, min(regexp_replace(COG_category, '[ |]', '', 'g')) AS cog_category,
       min('{"evalue":"' || evalue || '","score":"' || score || '","max_annot_lvl":"' || max_annot_lvl || '"}') AS stats
FROM in_annotations GROUP BY 1"""),
    "detect_schema_version": fixture.oracle("""SELECT v.*, (SELECT count(*) FROM sequences) AS sequences
FROM (VALUES ('old', 1, 1, false), ('new', 2, 2, true)) v(catalogue, version, checked, compatible)"""),
    "apply_migration_gene_map": fixture.oracle("SELECT gene_seqhash_id, protein_seqhash_id FROM gene_protein_map"),
    "conform_to_schema": fixture.oracle("SELECT seqhash_id, sequence, sample_id, assembly_date, CAST(NULL AS VARCHAR) AS repseq_id, length FROM sequences"),
    "mapping_stats": fixture.oracle(_MAPPING_SQL),
    "read_totals": fixture.oracle(_READS_SQL),
}
QUERIES = {
    "scan_fasta": scan_fasta, "scan_annotations": scan_annotations, "scan_expression": scan_expression, "scan_cluster_tsv": scan_cluster_tsv,
    "scan_quant_sf": scan_quant_sf, "write_quant": write_quant_formatted, "scan_bed": _bed, "attach_cds_coordinates": attach_cds_coordinates,
    "scan_gff_genes": scan_gff_genes, "scan_ontology": scan_ontology, "scan_run_list": scan_run_list, "export_id_list": export_id_list,
    "write_table_set": write_table_set, "versioned_tables": versioned_tables, "bucketed_tables": bucketed_tables, "write_qc_stats": write_qc_stats, "write_cog_counts": write_cog_counts,
    "build_catalog": build_catalog, "update_catalog": update_catalog, "update_report": update_report, "upsert_sample_metadata": upsert_sample_metadata,
    "backfill_expression": backfill_expression, "backfill_gene_map": backfill_gene_map, "expression_gene_map": expression_gene_map,
    "load_transcript_model": load_transcript_model, "detect_schema_version": detect_schema_version, "apply_migration_gene_map": apply_migration_gene_map,
    "conform_to_schema": conform_to_schema, "mapping_stats": mapping_stats, "read_totals": read_totals,
}
