"""Assembly and expression QC metrics (X1-X9), one row per sample, all samples in one job.

Running sums over a sample's transcripts are never taken over the raw rows of a sample
(one sample may hold a large share of all rows):
* N50 first collapses lengths to a (length, count) histogram per sample;
* ExN50 first sums expression x length in log-spaced buckets per sample, finds the bucket
  where the running sum crosses the threshold, and orders only that bucket's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ortholake.catalog import Catalog
from ortholake.functions.columns import gene_id, round_half_up

# Sub-buckets per doubling of expression x length in the ExN50 search.
EXN50_BUCKETS_PER_OCTAVE = 64


def transcripts(cat: Catalog) -> DataFrame:
    """(sample_id, transcript_id, length): the assembly of each sample."""
    return cat.sequences.select("sample_id", F.col("seqhash_id").alias("transcript_id"), "length")


# X1 -------------------------------------------------------------------------
def n50(tx: DataFrame) -> DataFrame:
    """Largest L such that transcripts of length >= L hold at least half the assembly."""
    hist = tx.groupBy("sample_id", "length").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("sample_id").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumn("cum", F.sum(F.col("length") * F.col("c")).over(w)).withColumn(
        "tot", F.sum(F.col("length") * F.col("c")).over(Window.partitionBy("sample_id"))
    )
    return h.filter(2 * F.col("cum") >= F.col("tot")).groupBy("sample_id").agg(F.max("length").alias("n50"))


# X2 -------------------------------------------------------------------------
def exn50(tx_expr: DataFrame) -> DataFrame:
    """ExN50 as the studied script computes it: order transcripts by expression x length
    (descending, ties by id), and return the length of the first one at which the running sum
    of expression x length reaches half the *plain* expression total.

    ``tx_expr``: (sample_id, transcript_id, length, tpm)."""
    t = tx_expr.select("sample_id", "transcript_id", "length", "tpm",
                       (F.col("tpm") * F.col("length")).alias("x"))
    b = F.when(F.col("x") > 0, F.floor(F.log2(F.col("x")) * EXN50_BUCKETS_PER_OCTAVE)).otherwise(F.lit(-(2 ** 40)))
    t = t.withColumn("b", b.cast("bigint"))
    totals = t.groupBy("sample_id").agg(F.sum("tpm").alias("S"))
    buckets = t.groupBy("sample_id", "b").agg(F.sum("x").alias("bx"))
    wb = Window.partitionBy("sample_id").orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    buckets = buckets.withColumn("cum", F.sum("bx").over(wb)).join(totals, "sample_id")
    target = (
        buckets.filter(2 * F.col("cum") >= F.col("S"))
        .groupBy("sample_id").agg(F.max_by(F.struct("b", (F.col("cum") - F.col("bx")).alias("offset")), F.col("b")).alias("t"))
        .select("sample_id", F.col("t.b").alias("b"), F.col("t.offset").alias("offset"))
    )
    rows = t.join(target, ["sample_id", "b"]).join(totals, "sample_id")
    wr = Window.partitionBy("sample_id").orderBy(F.col("x").desc(), F.col("transcript_id")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("cum", F.col("offset") + F.sum("x").over(wr))
    first = rows.filter(2 * F.col("cum") >= F.col("S")).groupBy("sample_id").agg(
        F.min_by("length", F.struct(-F.col("x"), F.col("transcript_id"))).alias("exn50")
    )
    return first


def transcript_expression(cat: Catalog) -> DataFrame:
    """Transcripts of each sample with the TPM of the same sample's quantification of their gene."""
    tx = cat.sequences.select("sample_id", F.col("seqhash_id").alias("transcript_id"), "length",
                              gene_id("seqhash_id").alias("gene_seqhash_id"))
    return tx.join(cat.expression.select("gene_seqhash_id", "sample_id", "tpm"), ["gene_seqhash_id", "sample_id"]).drop("gene_seqhash_id")


# X3 -------------------------------------------------------------------------
def assembly_totals(tx: DataFrame) -> DataFrame:
    return tx.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_transcripts"), F.sum("length").cast("bigint").alias("total_length")
    )


# X4 -------------------------------------------------------------------------
def average_expression(cat: Catalog) -> DataFrame:
    """Mean TPM over quantification rows whose name is one of the sample's transcripts (genes)."""
    genes = cat.sequences.select("sample_id", gene_id("seqhash_id").alias("gene_seqhash_id")).distinct()
    e = cat.expression.join(genes, ["sample_id", "gene_seqhash_id"], "left_semi")
    return e.groupBy("sample_id").agg(round_half_up(F.avg("tpm"), 2).alias("average_tpm"))


# X5 -------------------------------------------------------------------------
def ortholog_counts(annotations: DataFrame) -> DataFrame:
    return annotations.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_orthologs"),
        F.count(F.when(F.col("cog_category") == "Q", 1)).alias("n_secondary_metabolite"),
    )


# X6 / X7 ----------------------------------------------------------------------
def mapping_stats(mapping_qc: DataFrame) -> DataFrame:
    """From ``scan_mapping_qc``: percent mapped (2 decimals) and number mapped."""
    sid = F.coalesce(F.nullif(F.col("dir_sample"), F.lit("")), F.col("file_sample")) if "dir_sample" in mapping_qc.columns else F.col("sample_id")
    return mapping_qc.select(sid.alias("sample_id"), round_half_up("percent_mapped", 2).alias("percent_mapped"),
                             F.col("num_mapped").cast("double").alias("reads_mapped"))


def read_totals(read_qc: DataFrame) -> DataFrame:
    return read_qc.select("sample_id", "reads_before", "reads_after", "sequencing_type")


# X8 -------------------------------------------------------------------------
def qc_report(cat: Catalog, mapping: DataFrame | None = None, reads: DataFrame | None = None) -> DataFrame:
    """All QC metrics per sample with its organism ('N/A' when unknown)."""
    tx = transcripts(cat)
    out = (
        cat.sra_metadata.select("sample_id", F.coalesce(F.col("organism"), F.lit("N/A")).alias("organism"))
        .join(assembly_totals(tx), "sample_id", "left")
        .join(n50(tx), "sample_id", "left")
        .join(exn50(transcript_expression(cat)), "sample_id", "left")
        .join(average_expression(cat), "sample_id", "left")
        .join(ortholog_counts(cat.annotations), "sample_id", "left")
    )
    if mapping is not None:
        out = out.join(mapping_stats(mapping), "sample_id", "left")
    if reads is not None:
        out = out.join(read_totals(reads), "sample_id", "left")
    return out.select(
        "sample_id", "organism",
        F.coalesce(F.col("n_orthologs"), F.lit(0)).cast("bigint").alias("n_orthologs"),
        F.coalesce(F.col("n_secondary_metabolite"), F.lit(0)).cast("bigint").alias("n_secondary_metabolite"),
        F.coalesce(F.col("n_transcripts"), F.lit(0)).cast("bigint").alias("n_transcripts"),
        "total_length", "n50", "exn50", "average_tpm",
        *[c for c in ("percent_mapped", "reads_mapped", "reads_before", "reads_after", "sequencing_type") if c in out.columns],
    )


def with_not_available(report: DataFrame) -> DataFrame:
    """The report as it is shown: numbers as text, and ``N/A`` where a sample has no value (no
    quantified transcript, no mapping or read statistics)."""
    keep = ("sample_id", "organism")
    return report.select(*keep, *[F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) for c in report.columns if c not in keep])


# X9 -------------------------------------------------------------------------
def transcript_quant_balance(cat: Catalog) -> DataFrame:
    """Per sample: transcripts (distinct genes) vs quantification rows; balanced when equal."""
    genes = cat.sequences.select("sample_id", gene_id("seqhash_id").alias("g")).distinct().groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_transcripts"))
    q = cat.expression.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_quant"))
    j = genes.join(q, "sample_id", "full")
    return j.select(
        "sample_id",
        F.coalesce(F.col("n_transcripts"), F.lit(0)).cast("bigint").alias("n_transcripts"),
        F.coalesce(F.col("n_quant"), F.lit(0)).cast("bigint").alias("n_quant"),
        (F.coalesce(F.col("n_transcripts"), F.lit(0)) == F.coalesce(F.col("n_quant"), F.lit(0))).alias("balanced"),
    )


def exn50_std(tx_expr: DataFrame, percent: float = 90.0) -> DataFrame:
    """Standard ExN50 (survey X2, shipped next to the studied variant): the N50 of the most
    highly expressed transcripts that together hold ``percent`` % of a sample's expression
    (transcripts by TPM descending, ties by id; the transcript that crosses the threshold is
    included).

    Selection needs a running TPM sum per sample; as in ``exn50`` the running sum is taken
    over log-spaced TPM buckets first and only the crossing bucket's rows are ordered."""
    t = tx_expr.select("sample_id", "transcript_id", "length", "tpm")
    b = F.when(F.col("tpm") > 0, F.floor(F.log2(F.col("tpm")) * EXN50_BUCKETS_PER_OCTAVE)).otherwise(F.lit(-(2 ** 40)))
    t = t.withColumn("b", b.cast("bigint"))
    target = t.groupBy("sample_id").agg((F.sum("tpm") * F.lit(percent / 100.0)).alias("target"))
    buckets = t.groupBy("sample_id", "b").agg(F.sum("tpm").alias("bt"))
    wb = Window.partitionBy("sample_id").orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    buckets = buckets.withColumn("b_incl", F.sum("bt").over(wb)).withColumn("b_excl", F.col("b_incl") - F.col("bt"))
    buckets = buckets.join(target, "sample_id")
    rows = t.join(buckets.select("sample_id", "b", "b_incl", "b_excl", "target"), ["sample_id", "b"])
    whole = rows.filter(F.col("b_incl") < F.col("target")).select("sample_id", "length")
    crossing = rows.filter((F.col("b_excl") < F.col("target")) & (F.col("b_incl") >= F.col("target")))
    wr = Window.partitionBy("sample_id", "b").orderBy(F.col("tpm").desc(), F.col("transcript_id")).rowsBetween(
        Window.unboundedPreceding, -1)
    crossing = crossing.withColumn("excl", F.col("b_excl") + F.coalesce(F.sum("tpm").over(wr), F.lit(0.0)))
    part = crossing.filter(F.col("excl") < F.col("target")).select("sample_id", "length")
    return n50(whole.unionByName(part)).withColumnRenamed("n50", "exn50_std")
