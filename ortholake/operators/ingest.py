"""Ingest dataflow (I1-I15): per-sample files -> catalogue tables, all samples in one job.

Inputs are frames (from ``ortholake.sources``) carrying ``sample_id`` and a load-order
``sample_rank``; the existing catalogue is a ``Catalog``. Each operator returns new rows
only (the caller appends them), so an ingest is an anti-join append and running it twice
adds nothing.

Primary keys of the relational store are emulated:
* first writer wins = the row of the smallest ``sample_rank`` per key, found with a
  ``min_by`` aggregate (map-side partial aggregation, so one very common key is combined
  in every task before the shuffle rather than sorted in one task as a window would);
* "already present" = left-anti join against the catalogue table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.catalog import SCHEMA_V2, Catalog, conform
from ortholake.functions.columns import MISSING, any_informative, gene_id, nullif_dash

RECORD_BITS = 40          # of a record's number within its sample

KEGG_COLUMNS = [
    ("KEGG_ko", "kegg_ko"), ("KEGG_Pathway", "kegg_pathway"), ("KEGG_Module", "kegg_module"),
    ("KEGG_Reaction", "kegg_reaction"), ("KEGG_rclass", "kegg_rclass"), ("BRITE", "brite"), ("KEGG_TC", "kegg_tc"),
    ("CAZy", "cazy"), ("BiGG_Reaction", "bigg_reaction"), ("PFAMs", "pfams"),
]


def sample_order(spark: SparkSession, sample_ids: list[str]) -> DataFrame:
    """(sample_id, sample_rank) for the caller's ordered sample list (bounded by the list)."""
    return spark.createDataFrame([(s, i) for i, s in enumerate(sample_ids)], "sample_id string, sample_rank int")


def _ids(cat: Catalog | None, table: str, cols: list[str]) -> DataFrame | None:
    if cat is None or not cat.has(table):
        return None
    return cat[table].select(*cols)


# I1 / I2 ----------------------------------------------------------------------
@dataclass
class SequenceIngest:
    accepted: DataFrame      # new `sequences` rows
    records: DataFrame       # every incoming record with its duplicate flag
    duplicates: DataFrame    # (seqhash_id, sample_id, length) skipped


def ingest_sequences(incoming: DataFrame, existing: Catalog | None = None,
                     as_of: _dt.datetime | None = None) -> SequenceIngest:
    """``incoming``: (seqhash_id, sequence, sample_id, sample_rank[, record_no]).

    A record is a duplicate when its id is already in the catalogue or was loaded by an
    earlier sample. Within one sample the first copy is kept (INSERT OR IGNORE) and the
    copies still count as loaded, as in the studied builder. The first one is that of the smallest
    ``record_no`` (see ``sources.numbered_records``); where records carry no number, that of the
    smallest text."""
    as_of = as_of or _dt.datetime(2000, 1, 1)
    rec = incoming.select("seqhash_id", "sequence", "sample_id", "sample_rank", *[c for c in ("record_no",) if c in incoming.columns])
    if "record_no" in rec.columns:
        # Rank and number in one long: a plain minimum finds the winner, and no text is sorted for it.
        rec = rec.withColumn("_place", F.shiftleft(F.col("sample_rank").cast("long"), RECORD_BITS) + F.col("record_no"))
        first = rec.groupBy("seqhash_id").agg(F.min("_place").alias("_first"))
        # By id alone, as the minimum is grouped already: its rows are not dealt out again.
        own = rec.select("seqhash_id", "_place", F.struct("sequence", "sample_id").alias("w"))
        won = own.join(first, "seqhash_id").filter(F.col("_place") == F.col("_first"))
        # One row an id, unless a number was given twice: then its smallest text.
        won = won.groupBy("seqhash_id", "_place").agg(F.array_min(F.collect_set("w")).alias("w"))
        first = won.withColumn("first_rank", F.shiftright("_place", RECORD_BITS).cast("int")).drop("_place")
        rec = rec.drop("_place", "record_no")
    else:
        first = rec.groupBy("seqhash_id").agg(
            F.min("sample_rank").alias("first_rank"),
            F.min_by(F.struct("sample_id", "sequence"), F.struct("sample_rank", "sequence")).alias("w"),
        )
    prior = _ids(existing, "sequences", ["seqhash_id"])
    if prior is not None:
        first = first.join(prior.withColumn("_exists", F.lit(True)), "seqhash_id", "left")
    else:
        first = first.withColumn("_exists", F.lit(None).cast("boolean"))
    first = first.withColumn("_exists", F.coalesce(F.col("_exists"), F.lit(False)))
    accepted = first.filter(~F.col("_exists")).select(
        "seqhash_id",
        F.col("w.sequence").alias("sequence"),
        F.col("w.sample_id").alias("sample_id"),
        F.lit(as_of).cast("timestamp_ntz").alias("assembly_date"),
        F.lit(False).alias("is_representative"),
        F.col("seqhash_id").alias("repseq_id"),
        F.length(F.col("w.sequence")).cast("int").alias("length"),
    )
    flagged = rec.join(first.select("seqhash_id", "first_rank", "_exists"), "seqhash_id").withColumn(
        "is_duplicate", F.col("_exists") | (F.col("sample_rank") > F.col("first_rank"))
    )
    dups = flagged.filter("is_duplicate").select("seqhash_id", "sample_id", F.length("sequence").cast("int").alias("length"))
    return SequenceIngest(conform(accepted, SCHEMA_V2["sequences"]), flagged, dups)


# I3 -------------------------------------------------------------------------
def ingest_gene_protein_map(protein_ids: DataFrame, existing: Catalog | None = None) -> DataFrame:
    """Pairs (gene, protein) derived from protein ids, minus pairs already mapped."""
    pairs = protein_ids.select(gene_id("seqhash_id").alias("gene_seqhash_id"), F.col("seqhash_id").alias("protein_seqhash_id")).distinct()
    prior = _ids(existing, "gene_protein_map", ["gene_seqhash_id", "protein_seqhash_id"])
    return pairs if prior is None else pairs.join(prior, ["gene_seqhash_id", "protein_seqhash_id"], "left_anti")


# I4 -------------------------------------------------------------------------
def _first_per_query(ann: DataFrame) -> DataFrame:
    """One annotation record per query id: the one from the earliest sample."""
    cols = [c for c in ann.columns if c not in ("query", "sample_rank")]
    return ann.groupBy("query").agg(
        F.min_by(F.struct(*cols), F.struct("sample_rank", *[F.col(c) for c in cols])).alias("r")
    ).select("query", "r.*")


def ingest_annotations(ann: DataFrame, catalog: Catalog) -> DataFrame:
    """Rows whose query is a catalogue sequence and not yet annotated; evalue/score TRY_CAST."""
    seqs = catalog.sequences.select(F.col("seqhash_id").alias("query"))
    a = _first_per_query(ann.join(seqs, "query", "left_semi"))
    prior = _ids(catalog, "annotations", [F.col("seqhash_id").alias("query")])
    if prior is not None:
        a = a.join(prior, "query", "left_anti")
    out = a.select(
        F.col("query").alias("seqhash_id"), F.col("seed_ortholog"),
        F.expr("try_cast(evalue AS double)").alias("evalue"), F.expr("try_cast(score AS double)").alias("score"),
        F.col("eggNOG_OGs").alias("eggnog_ogs"), F.col("max_annot_lvl"), F.col("COG_category").alias("cog_category"),
        F.col("Description").alias("description"), F.col("Preferred_name").alias("preferred_name"), F.col("sample_id"),
    )
    return conform(out, SCHEMA_V2["annotations"])


# I5 / I6 ----------------------------------------------------------------------
def _ingest_list(ann: DataFrame, catalog: Catalog, src: str, table: str, col: str) -> DataFrame:
    seqs = catalog.sequences.select(F.col("seqhash_id").alias("query"))
    a = ann.join(seqs, "query", "left_semi").select("query", "sample_rank", nullif_dash(src).alias("v")).filter(F.col("v").isNotNull())
    # Samples load one after another, and a sequence that has a term by then keeps it: so only
    # the fields of the earliest sample with any count. Empty items and '-' are no terms.
    items = a.select(F.col("query").alias("seqhash_id"), "sample_rank", F.explode(F.split("v", ",")).alias(col)).filter(
        (F.length(F.col(col)) > 0) & (F.col(col) != MISSING)
    )
    first = items.groupBy("seqhash_id").agg(F.min("sample_rank").alias("_first"))
    items = items.join(first, "seqhash_id").filter(F.col("sample_rank") == F.col("_first")).select("seqhash_id", col).distinct()
    prior = _ids(catalog, table, ["seqhash_id"])
    # A sequence that already has any term keeps its terms untouched.
    return items if prior is None else items.join(prior.distinct(), "seqhash_id", "left_anti")


def ingest_go_terms(ann: DataFrame, catalog: Catalog) -> DataFrame:
    return _ingest_list(ann, catalog, "GOs", "go_terms", "go_term")


def ingest_ec_numbers(ann: DataFrame, catalog: Catalog) -> DataFrame:
    return _ingest_list(ann, catalog, "EC", "ec_numbers", "ec_number")


# I7 -------------------------------------------------------------------------
def ingest_kegg(ann: DataFrame, catalog: Catalog) -> DataFrame:
    """Rows with at least one informative KEGG-family field (three-valued OR: all NULL/'-' is dropped)."""
    seqs = catalog.sequences.select(F.col("seqhash_id").alias("query"))
    a = ann.join(seqs, "query", "left_semi").filter(any_informative([s for s, _ in KEGG_COLUMNS]))
    a = _first_per_query(a.select("query", "sample_id", "sample_rank", *[s for s, _ in KEGG_COLUMNS]))
    prior = _ids(catalog, "kegg_info", [F.col("seqhash_id").alias("query")])
    if prior is not None:
        a = a.join(prior, "query", "left_anti")
    out = a.select(F.col("query").alias("seqhash_id"), *[F.col(s).alias(d) for s, d in KEGG_COLUMNS], "sample_id")
    return conform(out, SCHEMA_V2["kegg_info"])


# I8 / I13 ---------------------------------------------------------------------
def ingest_expression(quant: DataFrame, catalog: Catalog, ownership: bool = True) -> DataFrame:
    """``quant``: (gene_seqhash_id, sample_id, tpm, num_reads, effective_length[, sample_rank]).

    ``ownership=True`` keeps a gene only when the same sample owns one of its proteins (the
    studied builder's filter, which drops genes first seen in another sample)."""
    q = quant.select("gene_seqhash_id", "sample_id", "tpm", "num_reads", "effective_length",
                     *(["sample_rank"] if "sample_rank" in quant.columns else []))
    if ownership:
        owned = catalog.sequences.select("sample_id", gene_id("seqhash_id").alias("gene_seqhash_id")).distinct()
        q = q.join(owned, ["sample_id", "gene_seqhash_id"], "left_semi")
    # (gene, sample) is the key: keep the first record of each pair.
    q = q.groupBy("gene_seqhash_id", "sample_id").agg(
        F.min_by(F.struct("tpm", "num_reads", "effective_length"), F.struct("tpm", "num_reads", "effective_length")).alias("r")
    ).select("gene_seqhash_id", "sample_id", "r.*")
    prior = _ids(catalog, "expression", ["gene_seqhash_id", "sample_id"])
    if prior is not None:
        q = q.join(prior, ["gene_seqhash_id", "sample_id"], "left_anti")
    return conform(q, SCHEMA_V2["expression"])


def expression_gene_map(quant: DataFrame, catalog: Catalog) -> DataFrame:
    """Gene-map rows that loading ``quant`` adds: for each sample of which a quantified gene has a
    protein, the pairs of all its proteins that are not mapped yet."""
    own = catalog.sequences.select("sample_id", gene_id("seqhash_id").alias("gene_seqhash_id"), F.col("seqhash_id").alias("protein_seqhash_id"))
    q = quant.select("sample_id", "gene_seqhash_id").distinct()
    matched = own.join(q, ["sample_id", "gene_seqhash_id"], "left_semi").select("sample_id").distinct()
    pairs = own.join(matched, "sample_id", "left_semi").select("gene_seqhash_id", "protein_seqhash_id").distinct()
    prior = _ids(catalog, "gene_protein_map", ["gene_seqhash_id", "protein_seqhash_id"])
    return pairs if prior is None else pairs.join(prior, ["gene_seqhash_id", "protein_seqhash_id"], "left_anti")


def backfill_expression(quant: DataFrame, catalog: Catalog) -> DataFrame:
    """Expression for samples already in the catalogue, insert-or-ignore, no ownership filter:
    genes without a gene-map row are kept too."""
    q = quant.join(catalog.sra_metadata.select("sample_id"), "sample_id", "left_semi")
    return ingest_expression(q, catalog, ownership=False)


def backfill_gene_map(proteins: DataFrame, catalog: Catalog) -> DataFrame:
    """Gene-map rows of the protein files (sample_id, seqhash_id) of samples already in the
    catalogue, insert-or-ignore; the proteins need not be catalogue sequences."""
    p = proteins.join(catalog.sra_metadata.select("sample_id"), "sample_id", "left_semi")
    return ingest_gene_protein_map(p.select("seqhash_id"), catalog)


# I9 -------------------------------------------------------------------------
def ingest_report(samples: DataFrame, seq: SequenceIngest, annotations_loaded: DataFrame | None = None,
                  existing_samples: DataFrame | None = None) -> DataFrame:
    """Per sample: status, sequences_loaded, annotations_loaded, duplicates, error.

    ``samples``: (sample_id, sample_rank). A sample already in the catalogue gets status
    'error' and loads nothing."""
    r = seq.records.groupBy("sample_id").agg(
        F.sum((~F.col("is_duplicate")).cast("int")).cast("bigint").alias("sequences_loaded"),
        F.sum(F.col("is_duplicate").cast("int")).cast("bigint").alias("duplicates"),
    )
    out = samples.select("sample_id", "sample_rank").join(r, "sample_id", "left")
    if annotations_loaded is not None:
        a = annotations_loaded.groupBy("sample_id").agg(F.count(F.lit(1)).alias("annotations_loaded"))
        out = out.join(a, "sample_id", "left")
    else:
        out = out.withColumn("annotations_loaded", F.lit(None).cast("bigint"))
    if existing_samples is not None:
        out = out.join(existing_samples.select("sample_id").distinct().withColumn("_present", F.lit(True)), "sample_id", "left")
    else:
        out = out.withColumn("_present", F.lit(None).cast("boolean"))
    present = F.coalesce(F.col("_present"), F.lit(False))
    return out.select(
        "sample_id",
        F.when(present, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.when(present, F.lit(0)).otherwise(F.coalesce(F.col("sequences_loaded"), F.lit(0))).cast("bigint").alias("sequences_loaded"),
        F.when(present, F.lit(0)).otherwise(F.coalesce(F.col("annotations_loaded"), F.lit(0))).cast("bigint").alias("annotations_loaded"),
        F.when(present, F.lit(0)).otherwise(F.coalesce(F.col("duplicates"), F.lit(0))).cast("bigint").alias("duplicates"),
        F.when(present, F.lit("sample already in catalogue")).otherwise(F.lit(None)).cast("string").alias("error"),
    )


# I10 / I11 / I12 -------------------------------------------------------------
@dataclass
class SampleBundle:
    """Scanned files of a set of samples (any of them may be None)."""
    samples: DataFrame                 # (sample_id, sample_rank)
    proteins: DataFrame                # scan_fasta output (sample_id, id, sequence, ...)
    annotations: DataFrame | None = None   # scan_annotations output
    quant: DataFrame | None = None         # scan_expression output
    metadata: DataFrame | None = None      # sra_metadata rows


class CatalogNotEmpty(RuntimeError):
    pass


def _empty_catalog(spark: SparkSession) -> Catalog:
    return Catalog(spark, {n: spark.createDataFrame([], SCHEMA_V2[n]) for n in SCHEMA_V2 if n != "schema_version"})


def bundle_rows(bundle: SampleBundle, base: Catalog, as_of: _dt.datetime | None = None, ownership: bool = True,
                stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[dict[str, DataFrame], DataFrame]:
    """I1-I9 for a bundle of samples: the rows that each table gains (``sra_metadata``: the rows of
    the new samples), and the per-sample report. Samples already present are rejected. ``stage``
    (such as ``materialise``) is applied to the accepted sequences, from which all other tables follow."""
    existing_samples = base.sra_metadata.select("sample_id")
    samples = bundle.samples.join(existing_samples, "sample_id", "left_anti")
    prot = bundle.proteins.join(samples, "sample_id").select(
        F.col("id").alias("seqhash_id"), "sequence", "sample_id", "sample_rank", *[c for c in ("record_no",) if c in bundle.proteins.columns])
    seq = ingest_sequences(prot, base, as_of)
    seq = SequenceIngest(stage(seq.accepted), seq.records, seq.duplicates)
    cat = base.with_tables(sequences=base.sequences.unionByName(seq.accepted))
    new = {"sequences": seq.accepted, "gene_protein_map": ingest_gene_protein_map(prot.select("seqhash_id").distinct(), base)}
    if bundle.annotations is not None:
        ann = bundle.annotations.join(samples, "sample_id")
        new |= {"annotations": ingest_annotations(ann, cat), "go_terms": ingest_go_terms(ann, cat), "ec_numbers": ingest_ec_numbers(ann, cat),
                "kegg_info": ingest_kegg(ann, cat)}
    if bundle.quant is not None:
        quant = bundle.quant.join(samples, "sample_id")
        new["expression"] = ingest_expression(quant, cat, ownership)
        mapped = base.with_tables(sequences=cat.sequences, gene_protein_map=base.gene_protein_map.unionByName(new["gene_protein_map"]))
        new["gene_protein_map"] = new["gene_protein_map"].unionByName(expression_gene_map(quant, mapped))
    meta = samples.select("sample_id")
    if bundle.metadata is not None:                         # a sample without a record is entered by its id
        meta = meta.join(bundle.metadata, "sample_id", "left")
    new["sra_metadata"] = conform(meta, SCHEMA_V2["sra_metadata"])
    return new, ingest_report(bundle.samples, seq, new.get("annotations"), existing_samples)


def ingest_bundle(spark: SparkSession, bundle: SampleBundle, catalog: Catalog | None = None,
                  as_of: _dt.datetime | None = None, ownership: bool = True,
                  stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[Catalog, DataFrame]:
    """Run I1-I9 for a bundle of samples against ``catalog`` (or an empty one).

    Returns the catalogue with the new rows appended (lazily) and the per-sample report.
    Samples already present in ``sra_metadata`` are rejected (I11)."""
    base = catalog or _empty_catalog(spark)
    new, report = bundle_rows(bundle, base, as_of, ownership, stage)
    meta = upsert_sample_metadata(base.sra_metadata, new.pop("sra_metadata"))
    return base.with_tables(sra_metadata=meta, **{t: base[t].unionByName(rows) for t, rows in new.items()}), report


def build_catalog(spark: SparkSession, bundle: SampleBundle, catalog: Catalog | None = None, **kw) -> tuple[Catalog, DataFrame]:
    """Refuse a non-empty catalogue, then ingest all samples in order."""
    if catalog is not None and catalog.has("sequences") and catalog.sequences.limit(1).count() > 0:
        raise CatalogNotEmpty("catalogue already holds sequences; use update_catalog")
    return ingest_bundle(spark, bundle, catalog, **kw)


def update_catalog(spark: SparkSession, bundle: SampleBundle, catalog: Catalog, **kw) -> tuple[Catalog, DataFrame]:
    """Add samples to an existing catalogue; samples already present are reported as errors."""
    return ingest_bundle(spark, bundle, catalog, **kw)


def upsert_sample_metadata(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Delete-then-insert by sample id."""
    return existing.join(rows.select("sample_id"), "sample_id", "left_anti").unionByName(rows.select(*existing.columns))


# I14 ------------------------------------------------------------------------
def attach_cds_coordinates(proteins: DataFrame, bed: DataFrame, id_col: str = "seqhash_id") -> DataFrame:
    """Set cds_start / cds_end from BED rows whose name is the protein id (left join + coalesce)."""
    b = bed.groupBy(F.col("name").alias(id_col)).agg(F.min("start").alias("_s"), F.max("end").alias("_e"))
    p = proteins
    for c in ("cds_start", "cds_end"):
        if c not in p.columns:
            p = p.withColumn(c, F.lit(None).cast("long"))
    return p.join(b, id_col, "left").withColumn("cds_start", F.coalesce("_s", "cds_start")).withColumn(
        "cds_end", F.coalesce("_e", "cds_end")
    ).drop("_s", "_e")


# I15 ------------------------------------------------------------------------
def load_transcript_model(ann: DataFrame) -> DataFrame:
    """Transcript-level annotation rows: GO and KEGG pathways as arrays, COG stripped of
    whitespace and '|', transcript id = text before the first '.'."""
    def arr(c):
        return F.when(F.col(c).isNull() | (F.col(c) == MISSING), F.lit(None).cast("array<string>")).otherwise(F.split(F.col(c), ","))

    return ann.select(
        F.split_part(F.col("query"), F.lit("."), F.lit(1)).alias("transcript_seqhash"),
        F.col("query").alias("protein_seqhash"),
        F.col("sample_id"),
        F.regexp_replace(F.col("COG_category"), r"[\s|]", "").alias("cog_category"),
        F.col("Description").alias("description"),
        F.col("Preferred_name").alias("preferred_name"),
        arr("GOs").alias("go_terms"),
        arr("KEGG_Pathway").alias("kegg_pathways"),
        F.to_json(F.struct(F.col("evalue"), F.col("score"), F.col("max_annot_lvl"))).alias("stats"),
    )


def sample_stats_json(cat: Catalog) -> DataFrame:
    """Per sample JSON stats column of the notebook model (to_json of a struct)."""
    s = cat.sequences.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("length").alias("total_length"))
    return s.select("sample_id", F.to_json(F.struct("n_sequences", "total_length")).alias("stats"))


__all__ = [
    "SequenceIngest", "SampleBundle", "CatalogNotEmpty", "sample_order", "ingest_sequences", "ingest_gene_protein_map",
    "ingest_annotations", "ingest_go_terms", "ingest_ec_numbers", "ingest_kegg", "ingest_expression", "expression_gene_map",
    "backfill_expression", "backfill_gene_map", "ingest_report", "bundle_rows", "ingest_bundle", "build_catalog", "update_catalog", "upsert_sample_metadata", "attach_cds_coordinates",
    "load_transcript_model", "sample_stats_json",
]
