"""File scans (S1-S13). Every scan takes a path or glob, reads *all* matching files in one
job with an explicit schema, and recovers the sample id from the file name, so a thousand
samples are one distributed read rather than a thousand driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ortholake.session import materialise

# Column layout of the functional-annotation TSV (21 tab-separated columns,
# '#' comment lines, no header) and of the quantification records.
ANNOTATION_COLUMNS = [
    "query", "seed_ortholog", "evalue", "score", "eggNOG_OGs", "max_annot_lvl", "COG_category", "Description",
    "Preferred_name", "GOs", "EC", "KEGG_ko", "KEGG_Pathway", "KEGG_Module", "KEGG_Reaction", "KEGG_rclass",
    "BRITE", "KEGG_TC", "CAZy", "BiGG_Reaction", "PFAMs",
]
ANNOTATION_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in ANNOTATION_COLUMNS])

QUANT_JSON_SCHEMA = T.StructType([
    T.StructField("Name", T.StringType()), T.StructField("Length", T.LongType()),
    T.StructField("EffectiveLength", T.DoubleType()), T.StructField("TPM", T.DoubleType()),
    T.StructField("NumReads", T.DoubleType()), T.StructField("sample", T.StringType()),
])
QUANT_SF_SCHEMA = T.StructType([
    T.StructField("Name", T.StringType()), T.StructField("Length", T.LongType()),
    T.StructField("EffectiveLength", T.DoubleType()), T.StructField("TPM", T.DoubleType()),
    T.StructField("NumReads", T.DoubleType()),
])
EDGE_SCHEMA = T.StructType([
    T.StructField("representative", T.StringType()), T.StructField("member", T.StringType()),
])
BED_SCHEMA = T.StructType([
    T.StructField("chrom", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("name", T.StringType()), T.StructField("score", T.StringType()), T.StructField("strand", T.StringType()),
])
GFF_SCHEMA = T.StructType([
    T.StructField("seqid", T.StringType()), T.StructField("source", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("strand", T.StringType()), T.StructField("phase", T.StringType()),
    T.StructField("attributes", T.StringType()),
])


ANY_SUFFIX = r"\..*$"


def sample_from_path(suffix_regex: str = ANY_SUFFIX, path: str = "_metadata.file_path") -> Column:
    """Sample id = file base name without its extension(s) (``SRR123.emapper.annotations`` -> ``SRR123``)."""
    base = F.substring_index(F.col(path), "/", -1)
    return F.substring_index(base, ".", 1) if suffix_regex == ANY_SUFFIX else F.regexp_replace(base, suffix_regex, "")


# S1 -------------------------------------------------------------------------
def scan_fasta(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """FASTA records: (sample_id, file_path, id, description, sequence, length).

    Records start with '>' at the start of a line (a '>' inside a header belongs to it), so
    multi-line sequences stay whole. Further '>' in front of a header are dropped, and records
    with an empty header are left out. With ``numbered``, ``record_no`` orders the records of a file."""
    raw = spark.read.option("lineSep", FASTA_SEPARATOR).text(path).select("value", *fasta_meta())
    return fasta_records(numbered_records(raw) if numbered else raw)


#: What stands between two records; the first one of a file keeps its '>'.
FASTA_SEPARATOR = "\n>"


def fasta_meta() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start")]


def numbered_records(raw: DataFrame) -> DataFrame:
    """Add ``record_no``, ascending in the order of a file's records, also where it is read in several
    splits: the start of the split plus the row's place in its partition. A record takes
    two bytes at least, so the numbers of a split stay below the start of the next one; a split that is not
    its file's last is a full one and opens a partition of its own."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return raw.withColumn("record_no", F.col("block_start") + place)


def fasta_records(raw: DataFrame) -> DataFrame:
    """Parse (value, file_path) chunks between record starts; shared by batch and stream."""
    own = F.regexp_replace("value", r"^>+", "")
    number = [c for c in ("record_no",) if c in raw.columns]
    rec = raw.select(
        "file_path", *number,
        F.regexp_extract(own, r"^([^\n]*)", 1).alias("header"),
        F.regexp_replace(F.regexp_extract(own, r"^[^\n]*\n([\s\S]*)$", 1), r"[\s]", "").alias("sequence"),
    )
    hdr = F.trim(F.regexp_replace("header", r"\r", ""))
    return rec.filter(F.length(hdr) > 0).select(
        F.regexp_replace(F.regexp_extract("file_path", r"([^/]+)$", 1), r"\..*$", "").alias("sample_id"),
        "file_path",
        F.split_part(hdr, F.lit(" "), F.lit(1)).alias("id"),
        F.trim(F.regexp_replace(hdr, r"^\S+\s*", "")).alias("description"),
        F.col("sequence"),
        F.length("sequence").cast("int").alias("length"), *number,
    )


# S2 -------------------------------------------------------------------------
def scan_annotations(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t", comment="#", header=False, schema=ANNOTATION_SCHEMA)
    return df.withColumn("sample_id", sample_from_path())


# S3 -------------------------------------------------------------------------
def json_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, sample): the text of every object of JSON arrays of flat objects, cut behind each '}', so
    that a large file is read by several tasks.

    A piece with an odd number of quotes has a brace inside a text. Files that have such pieces are put
    together again in their order: a piece that begins inside a text belongs to the one before."""
    raw = spark.read.option("lineSep", "}").text(path).select("value", *fasta_meta())
    # Few texts hold a backslash; the others need no pattern.
    bare = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"\\.", "")).otherwise(F.col("value"))
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    pieces = numbered_records(raw).withColumn("odd", (quotes % 2).cast("int"))
    torn = materialise(pieces.filter("odd = 1").select("file_path").distinct(), "torn")
    whole = pieces.join(torn, "file_path", "left_anti").select("value", "file_path")
    order = Window.partitionBy("file_path").orderBy("record_no")
    inside = F.coalesce(F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    parts = pieces.join(torn, "file_path", "left_semi").withColumn("inside", inside)
    parts = parts.withColumn("no", F.sum((1 - F.col("inside")).cast("long")).over(order))
    joined = parts.groupBy("file_path", "no").agg(F.array_sort(F.collect_list(F.struct("record_no", "value"))).alias("v"))
    again = joined.select(F.array_join(F.transform("v", lambda x: x["value"]), "}").alias("value"), "file_path")
    own = F.substring("value", F.locate("{", F.col("value")), F.length("value"))
    return whole.unionByName(again).filter(F.col("value").contains("{")).select(F.concat(own, F.lit("}")).alias("value"), sample_from_path(path="file_path").alias("sample"))


def scan_expression(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Quantification JSON arrays -> (gene_seqhash_id, length, effective_length, tpm, num_reads, sample_id)."""
    df = json_objects(spark, path).select(F.from_json("value", QUANT_JSON_SCHEMA).alias("r"), F.col("sample").alias("own")).select("r.*", "own")
    return df.select(
        F.col("Name").alias("gene_seqhash_id"),
        F.col("Length").alias("length"),
        F.col("EffectiveLength").alias("effective_length"),
        F.col("TPM").alias("tpm"),
        F.col("NumReads").alias("num_reads"),
        F.coalesce(F.col("sample"), F.col("own")).alias("sample_id"),
    )


# S4 -------------------------------------------------------------------------
def scan_cluster_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=False, schema=EDGE_SCHEMA)


# S5 -------------------------------------------------------------------------
def scan_quant_sf(spark: SparkSession, path: str, indexed: bool = False) -> DataFrame:
    """quant.sf (header row) or the formatted quant.tsv (leading unnamed index, trailing sample)."""
    if indexed:
        df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
        cols = df.columns
        df = df.drop(cols[0]) if cols[0] in ("", "_c0") else df
        return df.select(
            F.col("Name"), F.col("Length").cast("long").alias("Length"),
            F.col("EffectiveLength").cast("double").alias("EffectiveLength"), F.col("TPM").cast("double").alias("TPM"),
            F.col("NumReads").cast("double").alias("NumReads"),
            (F.col("sample") if "sample" in df.columns else sample_from_path()).alias("sample"),
        )
    return spark.read.csv(path, sep="\t", header=True, schema=QUANT_SF_SCHEMA).withColumn("sample", sample_from_path())


# S6 -------------------------------------------------------------------------
def scan_bed(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", header=False, schema=BED_SCHEMA)
    return raw.filter(~F.col("chrom").startswith("track") & ~F.col("chrom").startswith("browser"))


# S7 -------------------------------------------------------------------------
def scan_gff_genes(spark: SparkSession, path: str) -> DataFrame:
    """Gene features grouped by the id before '~~': (gene_id, n_features, feature_ids)."""
    g = spark.read.csv(path, sep="\t", comment="#", header=False, schema=GFF_SCHEMA).filter(F.col("type") == "gene")
    fid = F.regexp_extract("attributes", r"ID=([^;]+)", 1)
    return (
        g.select(F.split_part(fid, F.lit("~~"), F.lit(1)).alias("gene_id"), fid.alias("feature_id"), "seqid", "start", "end", "strand")
        .groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_features"), F.array_sort(F.collect_list("feature_id")).alias("feature_ids"))
    )


# S8 -------------------------------------------------------------------------
def scan_mapping_qc(spark: SparkSession, path: str) -> DataFrame:
    """Read-mapping QC JSON (one object per file): percent and number mapped per sample."""
    schema = T.StructType([T.StructField("percent_mapped", T.DoubleType()), T.StructField("num_mapped", T.DoubleType())])
    df = spark.read.json(path, schema=schema, multiLine=True)
    return df.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+/[^/]+$", 1).alias("dir_sample"),
        sample_from_path().alias("file_sample"), "percent_mapped", "num_mapped",
    )


def scan_read_qc(spark: SparkSession, path: str) -> DataFrame:
    """Read-filtering QC JSON: total reads before/after filtering and the sequencing type."""
    counts = T.StructType([T.StructField("total_reads", T.LongType())])
    schema = T.StructType([T.StructField("summary", T.StructType([
        T.StructField("sequencing", T.StringType()),
        T.StructField("before_filtering", counts),
        T.StructField("after_filtering", counts),
    ]))])
    df = spark.read.json(path, schema=schema, multiLine=True)
    return df.select(
        sample_from_path().alias("sample_id"),
        F.col("summary.before_filtering.total_reads").alias("reads_before"),
        F.col("summary.after_filtering.total_reads").alias("reads_after"),
        F.col("summary.sequencing").alias("sequencing_type"),
    )


# S9 -------------------------------------------------------------------------
def scan_contaminant_stats(spark: SparkSession, path: str) -> DataFrame:
    """Screening stats text: the first '<matched>/<total>' token of each file -> (sample_id, matched,
    total). The sample is named by the file, or by the last folder that is named after a column
    (``<column>=<sample>``)."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"=([^/=]+)/[^/]*$", 1)
    lines = numbered_records(spark.read.text(path).select(
        "value", F.coalesce(F.nullif(folder, F.lit("")), sample_from_path()).alias("sample_id"), F.col("_metadata.file_block_start").alias("block_start")))
    tok = F.regexp_extract("value", r"(\d+)/(\d+)", 0)
    return lines.filter(F.length(tok) > 0).groupBy("sample_id").agg(F.min_by(tok, "record_no").alias("tok")).select(
        "sample_id",
        F.split(F.col("tok"), "/")[0].cast("long").alias("matched"),
        F.split(F.col("tok"), "/")[1].cast("long").alias("total"),
    )


# S10 ------------------------------------------------------------------------
def scan_ontology(spark: SparkSession, path: str) -> DataFrame:
    """OBO terms -> (go_term, go_name, go_def); stanzas are separated by blank lines."""
    st = spark.read.option("lineSep", "\n\n").text(path)
    terms = st.filter(F.col("value").contains("[Term]"))
    return terms.select(
        F.regexp_extract("value", r"(?m)^id:\s*(\S+)", 1).alias("go_term"),
        F.regexp_extract("value", r"(?m)^name:\s*(.*)$", 1).alias("go_name"),
        F.regexp_extract("value", r'(?m)^def:\s*"((?:[^"\\]|\\.)*)"', 1).alias("go_def"),
    ).filter(F.length("go_term") > 0)


# S11 ------------------------------------------------------------------------
def scan_catalog_snapshot(spark: SparkSession, path: str):
    from ortholake.catalog import Catalog

    return Catalog.open(spark, path)


# S12 ------------------------------------------------------------------------
def scan_run_list(spark: SparkSession, path: str, assay: str = "RNA-Seq") -> DataFrame:
    df = spark.read.csv(path, header=True)
    return df.filter(F.col("`Assay Type`") == F.lit(assay)).select(F.col("Run").alias("sample_id"))


def scan_id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("sample_id")).filter(F.length("sample_id") > 0)


# S13 ------------------------------------------------------------------------
_ID = T.ArrayType(T.StructType([T.StructField("_namespace", T.StringType()), T.StructField("_VALUE", T.StringType())]))
_IDS = T.StructType([T.StructField("EXTERNAL_ID", _ID)])
_TEXTS = lambda *names: T.StructType([T.StructField(n, T.StringType()) for n in names])
#: What is read of a run record; other elements are passed over.
RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("EXPERIMENT", T.StructType([T.StructField("DESIGN", T.StructType([
        T.StructField("LIBRARY_DESCRIPTOR", _TEXTS("LIBRARY_STRATEGY", "LIBRARY_SOURCE", "LIBRARY_SELECTION"))]))])),
    T.StructField("STUDY", T.StructType([T.StructField("IDENTIFIERS", _IDS), T.StructField("DESCRIPTOR", _TEXTS("STUDY_TITLE", "STUDY_ABSTRACT"))])),
    T.StructField("SAMPLE", T.StructType([T.StructField("IDENTIFIERS", _IDS), T.StructField("SAMPLE_NAME", _TEXTS("SCIENTIFIC_NAME"))])),
    T.StructField("RUN_SET", T.StructType([T.StructField("RUN", T.ArrayType(_TEXTS("_accession", "_total_spots", "_total_bases", "_published")))])),
])


def scan_sample_metadata(spark: SparkSession, path: str | list[str], row_tag: str = "EXPERIMENT_PACKAGE") -> DataFrame:
    """Run metadata records (already downloaded XML) -> sra_metadata rows, in one pass: files are cut
    behind each record's end tag, so a large file is read by several tasks, and a record is parsed
    with a schema of its own (``RUN_RECORD_SCHEMA``), so nothing is inferred.

    Library layout and instrument are the tag names of the first child of their element, whichever
    they are; of several runs of a record, the first is taken."""
    end = f"</{row_tag}>"
    raw = spark.read.option("lineSep", end).text(path)
    record = F.concat(F.regexp_extract("value", rf"(<{row_tag}(?:\s[^>]*)?>[\s\S]*)$", 1), F.lit(end))
    rows = raw.filter(F.col("value").rlike(rf"<{row_tag}[\s>]")).select(record.alias("x"))
    rows = rows.select("x", F.from_xml("x", RUN_RECORD_SCHEMA).alias("r"))
    lib, run = "r.EXPERIMENT.DESIGN.LIBRARY_DESCRIPTOR.", F.get("r.RUN_SET.RUN", F.lit(0))

    def ext_id(struct: str, ns: str) -> Column:
        own = F.filter(f"r.{struct}.IDENTIFIERS.EXTERNAL_ID", lambda x: x["_namespace"] == ns)
        return F.trim(F.get(own, F.lit(0))["_VALUE"])

    def first_child(element: str) -> Column:
        return F.nullif(F.regexp_extract("x", rf"<{element}(?:\s[^>]*)?>(?:\s|<!--[\s\S]*?-->)*<([A-Za-z_][\w.-]*)", 1), F.lit(""))

    return rows.select(
        run["_accession"].alias("sample_id"),
        F.col("r.SAMPLE.SAMPLE_NAME.SCIENTIFIC_NAME").alias("organism"),
        F.col("r.STUDY.DESCRIPTOR.STUDY_TITLE").alias("study_title"),
        F.col("r.STUDY.DESCRIPTOR.STUDY_ABSTRACT").alias("study_abstract"),
        ext_id("STUDY", "BioProject").alias("bioproject"), ext_id("SAMPLE", "BioSample").alias("biosample"),
        F.col(lib + "LIBRARY_STRATEGY").alias("library_strategy"), F.col(lib + "LIBRARY_SOURCE").alias("library_source"),
        F.col(lib + "LIBRARY_SELECTION").alias("library_selection"),
        first_child("LIBRARY_LAYOUT").alias("library_layout"), first_child("PLATFORM").alias("instrument"),
        run["_total_spots"].cast("int").alias("run_spots"), run["_total_bases"].cast("bigint").alias("run_bases"),
        F.try_to_timestamp(run["_published"]).cast("timestamp_ntz").alias("run_published"),
    )
