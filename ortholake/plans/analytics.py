"""Catalogue analytics (N5-N45): the notebook and explorer questions as lazy plans.

Sample / GO / id lists are accepted as Python lists (literal IN, pushed to the scan) or
as DataFrames (semi-join). Dimensions of fixed size (COG letters) are broadcast; every
other join is left to the planner and AQE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ortholake.catalog import Catalog
from ortholake.functions.columns import (
    NO_COG_LABEL,
    cog_dimension,
    round_half_up,
    tpm_badge,
    tpm_bucket,
)
from ortholake.plans.common import exact_median, id_filter
from ortholake.plans.named import median


def _seq_meta(cat: Catalog, cols=("seqhash_id", "sample_id", "is_representative")) -> DataFrame:
    return cat.sequences.select(*cols).join(cat.sra_metadata.select("sample_id", "organism"), "sample_id")


# N5 ------------------------------------------------------------------------
def expression_badge(cat: Catalog) -> DataFrame:
    return cat.expression.select("gene_seqhash_id", "sample_id", "tpm", tpm_badge("tpm").alias("badge"))


# N6 ------------------------------------------------------------------------
def explore_filter(cat: Catalog, sample_id: str | None = None, go_terms=None, ec_numbers=None,
                   cog_category: str | None = None) -> DataFrame:
    """Explorer rows: sequences with annotation, GO and EC (one row per GO x EC pair)."""
    s = cat.sequences.select("seqhash_id", "sequence", "sample_id", "assembly_date")
    if sample_id is not None:
        s = s.filter(F.col("sample_id") == F.lit(sample_id))
    g = cat.go_terms.select("seqhash_id", "go_term")
    if go_terms:
        g = id_filter(g, "go_term", go_terms)
    e = cat.ec_numbers.select("seqhash_id", "ec_number")
    if ec_numbers:
        e = id_filter(e, "ec_number", ec_numbers)
    a = cat.annotations.select("seqhash_id", "preferred_name", "cog_category")
    j = s.join(a, "seqhash_id", "left")
    if cog_category is not None:
        j = j.filter(F.col("cog_category") == F.lit(cog_category))
    j = j.join(g, "seqhash_id", "inner" if go_terms else "left").join(e, "seqhash_id", "inner" if ec_numbers else "left")
    return j.select("seqhash_id", "sequence", "sample_id", "assembly_date", "preferred_name", "cog_category", "go_term",
                    "ec_number")


def explore_filter_page(cat: Catalog, page: int = 1, page_size: int = 500, **filters) -> DataFrame:
    """One page of the explorer, with a stable order (the studied UI pages without one)."""
    rows = explore_filter(cat, **filters)
    order = [F.col("seqhash_id"), F.col("go_term").asc_nulls_first(), F.col("ec_number").asc_nulls_first()]
    return rows.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


def explore_total_count(cat: Catalog, **filters) -> DataFrame:
    return explore_filter(cat, **filters).agg(F.count(F.lit(1)).alias("total_count"))


# N7 ------------------------------------------------------------------------
def distinct_facets(cat: Catalog) -> DataFrame:
    parts = [
        cat.sequences.select(F.lit("sample_id").alias("facet"), F.col("sample_id").alias("value")),
        cat.go_terms.select(F.lit("go_term").alias("facet"), F.col("go_term").alias("value")),
        cat.ec_numbers.select(F.lit("ec_number").alias("facet"), F.col("ec_number").alias("value")),
        cat.annotations.select(F.lit("cog_category").alias("facet"), F.col("cog_category").alias("value")),
    ]
    return reduce(DataFrame.unionAll, parts).na.drop(subset=["value"]).distinct()


# N8 ------------------------------------------------------------------------
def table_profile(cat: Catalog) -> DataFrame:
    parts = [
        cat[n].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count", F.lit(len(cat[n].columns)).alias("column_count")
        )
        for n in cat.names
    ]
    return reduce(DataFrame.unionAll, parts)


# N9 ------------------------------------------------------------------------
def duplicate_samples(cat: Catalog) -> DataFrame:
    return cat.sra_metadata.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


# N10 -----------------------------------------------------------------------
def unannotated_representatives(cat: Catalog) -> DataFrame:
    """Representatives without an annotation row. ``NOT IN`` is written as an anti-join; they
    agree because annotation ids are a primary key (never NULL)."""
    reps = cat.sequences.filter(F.col("is_representative")).select("seqhash_id")
    missing = reps.join(cat.annotations.select("seqhash_id"), "seqhash_id", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("missing_annotation_count"))


# N11 -----------------------------------------------------------------------
def representatives_per_organism(cat: Catalog) -> DataFrame:
    return (
        _seq_meta(cat).filter(F.col("is_representative")).groupBy("organism")
        .agg(F.count(F.lit(1)).alias("rep_count")).orderBy(F.col("rep_count").desc(), F.col("organism"))
    )


# N12 -----------------------------------------------------------------------
def rep_vs_nonrep_counts(cat: Catalog) -> DataFrame:
    return (
        _seq_meta(cat).groupBy("organism", "sample_id").agg(
            F.count(F.when(F.col("is_representative"), 1)).alias("representative_count"),
            F.count(F.when(~F.col("is_representative"), 1)).alias("non_representative_count"),
        ).orderBy(F.col("representative_count").desc(), "organism", "sample_id")
    )


def total_vs_rep_long(cat: Catalog) -> DataFrame:
    wide = _seq_meta(cat).groupBy("organism").agg(
        F.count(F.lit(1)).alias("total_count"), F.count(F.when(F.col("is_representative"), 1)).alias("rep_count")
    )
    return wide.unpivot("organism", ["rep_count", "total_count"], "category", "count")


# N13 -----------------------------------------------------------------------
def annotated_per_organism(cat: Catalog) -> DataFrame:
    return (
        _seq_meta(cat).join(cat.annotations.select("seqhash_id"), "seqhash_id")
        .groupBy("organism").agg(F.count(F.lit(1)).alias("annotated_count"))
        .orderBy(F.col("annotated_count").desc(), "organism")
    )


# N14 -----------------------------------------------------------------------
def cog_counts_representatives(cat: Catalog) -> DataFrame:
    return (
        cat.sequences.filter(F.col("is_representative")).select("seqhash_id")
        .join(cat.annotations.select("seqhash_id", "cog_category"), "seqhash_id")
        .groupBy("cog_category").agg(F.count(F.lit(1)).alias("category_count"))
        .orderBy(F.col("category_count").desc(), F.col("cog_category"))
    )


# N15 -----------------------------------------------------------------------
def _letters(col: str) -> DataFrame:
    return F.explode(F.filter(F.split(F.col(col), ""), lambda x: F.length(x) > 0))


def cog_letters_by_organism(cat: Catalog, organisms=None) -> DataFrame:
    j = _seq_meta(cat, ("seqhash_id", "sample_id")).join(cat.annotations.select("seqhash_id", "cog_category"), "seqhash_id")
    if organisms is not None:
        j = id_filter(j, "organism", organisms)
    letters = j.select("organism", _letters("cog_category").alias("cog_letter"))
    counts = letters.groupBy("organism", "cog_letter").agg(F.count(F.lit(1)).alias("count"))
    return (
        counts.join(F.broadcast(cog_dimension(cat.spark)), "cog_letter", "left")
        .select("organism", F.col("cog_letter").alias("cog_category"), "count", F.col("cog_name").alias("cog_description"))
        .orderBy("organism", F.col("count").desc(), "cog_category")
    )


# N16 -----------------------------------------------------------------------
def cog_expand_counts(cat: Catalog) -> DataFrame:
    """Letters -> names; NULL category -> one 'No COG assigned'; unknown letters kept as is."""
    a = cat.annotations.select("cog_category")
    letters = a.filter(F.col("cog_category").isNotNull()).select(_letters("cog_category").alias("cog_letter"))
    named = letters.join(F.broadcast(cog_dimension(cat.spark)), "cog_letter", "left").select(
        F.coalesce(F.col("cog_name"), F.col("cog_letter")).alias("cog_name")
    )
    nulls = a.filter(F.col("cog_category").isNull()).select(F.lit(NO_COG_LABEL).alias("cog_name"))
    return (
        named.unionAll(nulls).groupBy("cog_name").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "cog_name")
    )


# N17 -----------------------------------------------------------------------
def secondary_metabolite_rank(cat: Catalog) -> DataFrame:
    return (
        cog_letters_by_organism(cat).filter(F.col("cog_category") == "Q")
        .groupBy("organism").agg(F.sum("count").alias("count"))
        .orderBy(F.col("count").desc(), "organism")
    )


# N18 -----------------------------------------------------------------------
def cog_organism_proportions(cat: Catalog, wide: list[str] | None = None) -> DataFrame:
    """Share of each organism in a category. With ``wide``, the organisms as columns (0 where an
    organism has none); the list is the caller's, so planning starts no job."""
    c = cog_letters_by_organism(cat).select(
        F.coalesce(F.col("cog_description"), F.lit("UNKNOWN CATEGORY")).alias("cog_description"), "organism", "count"
    )
    g = c.groupBy("cog_description", "organism").agg(F.sum("count").alias("count"))
    g = g.withColumn("total_count", F.sum("count").over(Window.partitionBy("cog_description")))
    g = g.withColumn("proportion", F.col("count") / F.col("total_count"))
    if wide is not None:
        return g.groupBy("cog_description").pivot("organism", wide).agg(F.max("proportion")).na.fill(0.0, subset=wide)
    return g.orderBy(F.col("total_count").desc(), "cog_description", "organism")


# N19 -----------------------------------------------------------------------
def length_histogram(cat: Catalog) -> DataFrame:
    return cat.sequences.groupBy("length").agg(F.count(F.lit(1)).alias("count")).orderBy("length")


def length_histogram_bins(cat: Catalog, bins: int = 100) -> DataFrame:
    """Equal-width histogram over [min, max] (the last bin is closed)."""
    s = cat.sequences.select("length").filter(F.col("length").isNotNull())
    rng = s.agg(F.min("length").alias("lo"), F.max("length").alias("hi")).withColumn("_k", F.lit(1))
    span = F.greatest(F.col("hi") - F.col("lo"), F.lit(1))
    b = F.least(F.floor((F.col("length") - F.col("lo")) * bins / span).cast("int") + 1, F.lit(bins))
    return (
        s.withColumn("_k", F.lit(1)).join(F.broadcast(rng), "_k")  # one-row frame: bounded
        .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"), F.min("length").alias("min_length"),
                                     F.max("length").alias("max_length"))
        .orderBy("bin")
    )


# N20 -----------------------------------------------------------------------
def length_stats(cat: Catalog) -> DataFrame:
    stats = cat.sequences.agg(
        F.count(F.lit(1)).alias("n"), F.min("length").alias("min_length"), F.max("length").alias("max_length"),
        F.avg("length").alias("avg_length"),
    )
    med = exact_median(cat.sequences, "length", "median_length")
    return stats.withColumn("_k", F.lit(1)).join(med.withColumn("_k", F.lit(1)), "_k").drop("_k")


# N21 -----------------------------------------------------------------------
def long_sequences(cat: Catalog, min_length: int = 150) -> DataFrame:
    s = cat.sequences.filter(F.col("length") > F.lit(min_length)).select("seqhash_id", "sample_id", "length")
    return (
        s.join(cat.sra_metadata.select("sample_id", "organism"), "sample_id", "left")
        .join(cat.annotations.select("seqhash_id", "description", "preferred_name"), "seqhash_id", "left")
        .select("seqhash_id", "sample_id", "organism", "length", "description", "preferred_name")
        .orderBy(F.col("length").desc(), "seqhash_id")
    )


# N22 -----------------------------------------------------------------------
def longest_sequences(cat: Catalog) -> DataFrame:
    mx = cat.sequences.agg(F.max("length").alias("length"))  # one row: bounded broadcast
    s = cat.sequences.join(F.broadcast(mx), "length").select("seqhash_id", "sample_id", "length")
    return s.join(cat.annotations.select("seqhash_id", "description", "preferred_name", "cog_category"), "seqhash_id", "left")


# N23 -----------------------------------------------------------------------
def go_counts_for_samples(cat: Catalog, sample_ids) -> DataFrame:
    s = id_filter(cat.sequences.select("seqhash_id", "sample_id"), "sample_id", sample_ids)
    return (
        cat.go_terms.join(s, "seqhash_id").groupBy("go_term").agg(F.count(F.lit(1)).alias("term_count"))
        .orderBy(F.col("term_count").desc(), "go_term")
    )


def paired_samples(cat: Catalog) -> DataFrame:
    """Data-derived sample list: every paired-end run."""
    return cat.sra_metadata.filter(F.col("library_layout") == "PAIRED").select("sample_id")


# N24 -----------------------------------------------------------------------
def go_counts_by_organism(cat: Catalog, sample_ids=None, go_terms=None) -> DataFrame:
    s = cat.sequences.select("seqhash_id", "sample_id", "is_representative", "repseq_id")
    s = id_filter(s, "sample_id", sample_ids)
    g = cat.go_terms.select("seqhash_id", "go_term")
    if go_terms is not None:
        g = id_filter(g, "go_term", go_terms)
    j = g.join(s, "seqhash_id").join(cat.sra_metadata.select("sample_id", "organism"), "sample_id")
    # One row per sequence first (its representative is the same in all its rows, so it may be a key,
    # and the aggregate needs no sort): a single distinct count is left, which needs no Expand.
    j = j.withColumn("rep", F.when(F.col("is_representative"), F.col("repseq_id")))
    per_seq = j.groupBy("go_term", "organism", "seqhash_id", "rep").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_seq.groupBy("go_term", "organism").agg(
            F.sum("n").alias("term_count"),
            F.count("seqhash_id").alias("seqhash_count"),
            F.count_distinct("rep").alias("repseq_count"),
        ).orderBy(F.col("term_count").desc(), "go_term", "organism")
    )


# N25 -----------------------------------------------------------------------
def go_with_definitions(cat: Catalog, ontology: DataFrame, contains: str, sample_ids=None) -> DataFrame:
    counts = go_counts_by_organism(cat, sample_ids=sample_ids)
    return (
        counts.join(ontology.select("go_term", "go_name", "go_def"), "go_term", "left")
        .filter(F.col("go_def").isNotNull() & F.col("go_def").contains(F.lit(contains)))
    )


def derived_ontology(cat: Catalog) -> DataFrame:
    """An ontology dimension derived from the catalogue's own GO ids (name = id text)."""
    return cat.go_terms.select("go_term").distinct().select(
        "go_term",
        F.split_part(F.col("go_term"), F.lit(":"), F.lit(2)).alias("go_name"),
        F.concat(F.lit("Any process involving "), F.split_part(F.col("go_term"), F.lit(":"), F.lit(2))).alias("go_def"),
    )


# N26 -----------------------------------------------------------------------
def go_sequences(cat: Catalog, go_terms, sample_ids=None) -> DataFrame:
    s = id_filter(cat.sequences.select("seqhash_id", "sample_id", "sequence", "repseq_id", "is_representative"),
                  "sample_id", sample_ids)
    g = id_filter(cat.go_terms.select("seqhash_id", "go_term"), "go_term", go_terms)
    return (
        g.join(s, "seqhash_id").join(cat.sra_metadata.select("sample_id", "organism"), "sample_id")
        .join(cat.annotations.select("seqhash_id", F.col("description").alias("eggnog_description")), "seqhash_id", "left")
        .select("organism", "eggnog_description", "sequence", "go_term", "seqhash_id", "repseq_id", "is_representative")
        .orderBy("organism", "go_term", "seqhash_id")
    )


# N27 -----------------------------------------------------------------------
def sequences_per_sample(cat: Catalog, sample_ids=None) -> DataFrame:
    s = id_filter(cat.sequences.select("sample_id"), "sample_id", sample_ids)
    return s.groupBy("sample_id").agg(F.count(F.lit(1)).alias("sequence_count")).orderBy(F.col("sequence_count").desc(), "sample_id")


# N28 -----------------------------------------------------------------------
def taxon_ortholog_counts(cat: Catalog, taxa: list[str]) -> DataFrame:
    """Per (sample, organism, taxon keyword): distinct ortholog ids (text before '@') among the
    comma-separated OG entries that contain the keyword. Long form."""
    a = cat.annotations.select("seqhash_id", "eggnog_ogs").join(
        cat.sequences.select("seqhash_id", "sample_id"), "seqhash_id"
    ).join(cat.sra_metadata.select("sample_id", "organism"), "sample_id")
    entries = a.select("sample_id", "organism", F.explode(F.split(F.col("eggnog_ogs"), ",")).alias("entry"))
    named = F.array(*[F.when(F.col("entry").contains(F.lit(t)), F.lit(t)) for t in taxa]).cast("array<string>")
    hits = entries.select("sample_id", "organism", "entry", F.explode(F.filter(named, lambda t: t.isNotNull())).alias("taxon"))
    counts = hits.groupBy("sample_id", "organism", "taxon").agg(
        F.count_distinct(F.split_part(F.col("entry"), F.lit("@"), F.lit(1))).alias("ortholog_count")
    )
    return counts.orderBy("sample_id", "organism", "taxon")


# N29 -----------------------------------------------------------------------
def annotation_level_counts(cat: Catalog, contains: str) -> DataFrame:
    return (
        cat.annotations.filter(F.col("eggnog_ogs").contains(F.lit(contains)))
        .groupBy("max_annot_lvl").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "max_annot_lvl")
    )


# The transcript-level questions, over (gene map x expression) -------
def _protein_expression(cat: Catalog) -> DataFrame:
    return cat.expression.select("gene_seqhash_id", "sample_id", "tpm").join(
        cat.gene_protein_map.select("gene_seqhash_id", F.col("protein_seqhash_id").alias("seqhash_id")),
        "gene_seqhash_id",
    )


def unannotated_high_expression(cat: Catalog, limit: int = 10) -> DataFrame:
    e = _protein_expression(cat).join(cat.sequences.select("seqhash_id", "length"), "seqhash_id")
    j = e.join(cat.annotations.select("seqhash_id", "cog_category"), "seqhash_id", "left").filter(F.col("cog_category").isNull())
    return (
        j.orderBy(F.col("tpm").desc(), "seqhash_id", "sample_id").limit(limit)
        .select("seqhash_id", "sample_id", "tpm", "length")
    )


def expressed_with_pathways(cat: Catalog, min_tpm: float = 100.0) -> DataFrame:
    e = _protein_expression(cat).filter(F.col("tpm") > F.lit(min_tpm))
    a = cat.annotations.select("seqhash_id", "cog_category")
    k = cat.kegg_info.filter(F.col("kegg_pathway").isNotNull() & (F.col("kegg_pathway") != "-")).select("seqhash_id", "kegg_pathway")
    return (
        e.join(a, "seqhash_id").join(k, "seqhash_id")
        .select("seqhash_id", "sample_id", "tpm", "cog_category", "kegg_pathway")
        .orderBy(F.col("tpm").desc(), "seqhash_id", "sample_id")
    )


def tpm_by_annotation_status(cat: Catalog) -> DataFrame:
    j = _protein_expression(cat).join(cat.annotations.select("seqhash_id", "cog_category"), "seqhash_id", "left")
    return j.groupBy(
        F.when(F.col("cog_category").isNull(), "Unannotated").otherwise("Annotated").alias("status")
    ).agg(F.avg("tpm").alias("avg_tpm"), F.count(F.lit(1)).alias("count"))


def top_expressed_transcripts(cat: Catalog) -> DataFrame:
    # A gene's expression meets all its proteins, so these are described before that join, not after it.
    p = cat.gene_protein_map.select("gene_seqhash_id", F.col("protein_seqhash_id").alias("seqhash_id"))
    p = p.join(cat.sequences.select("seqhash_id", "length"), "seqhash_id")
    p = p.join(cat.annotations.select("seqhash_id", "cog_category", "description"), "seqhash_id", "left")
    j = cat.expression.select("gene_seqhash_id", "sample_id", "tpm").join(p, "gene_seqhash_id")
    return j.select("seqhash_id", "sample_id", "length", "tpm", "cog_category", "description").orderBy(
        F.col("tpm").desc(), "seqhash_id", "sample_id"
    )


# N34 -----------------------------------------------------------------------
def expression_level_stats(cat: Catalog) -> DataFrame:
    return (
        cat.expression.groupBy(tpm_bucket("tpm").alias("expression_level"))
        .agg(F.count(F.lit(1)).alias("n"), round_half_up(F.avg("tpm"), 2).alias("avg_tpm"))
        .orderBy(F.col("n").desc(), "expression_level")
    )


# N35 -----------------------------------------------------------------------
def length_tpm_correlation(cat: Catalog) -> DataFrame:
    j = _protein_expression(cat).join(cat.sequences.select("seqhash_id", "length"), "seqhash_id")
    j = j.select(F.col("length").cast("double").alias("x"), F.col("tpm").alias("y"))
    # ANSI corr raises on zero variance; guard it (the oracle engine yields NaN there).
    return j.agg(
        F.when((F.stddev_samp("x") > 0) & (F.stddev_samp("y") > 0), F.corr("x", "y")).alias("corr_length_tpm"),
        F.count(F.lit(1)).alias("n"),
    ).select(round_half_up(F.col("corr_length_tpm"), 6).alias("corr_length_tpm"), "n")


# N36 -----------------------------------------------------------------------
def referential_audit(cat: Catalog) -> DataFrame:
    gpm_orphans = cat.gene_protein_map.join(
        cat.sequences.select(F.col("seqhash_id").alias("protein_seqhash_id")), "protein_seqhash_id", "left_anti"
    ).agg(F.count(F.lit(1)).alias("n")).select(F.lit("gene_map_without_sequence").alias("check"), "n")
    expr_orphans = cat.expression.join(cat.sra_metadata.select("sample_id"), "sample_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit("expression_without_sample").alias("check"), "n")
    expr_no_gene = cat.expression.join(cat.gene_protein_map.select("gene_seqhash_id"), "gene_seqhash_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit("expression_without_gene_map").alias("check"), "n")
    return gpm_orphans.unionAll(expr_orphans).unionAll(expr_no_gene)


# N37 -----------------------------------------------------------------------
def catalog_validation(cat: Catalog) -> DataFrame:
    """Linkage counts of the catalogue, long form (check, n)."""
    gpm = cat.gene_protein_map
    seq_ids = cat.sequences.select("seqhash_id")

    def cnt(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")

    genes_multi = gpm.groupBy("gene_seqhash_id").agg(F.count_distinct("protein_seqhash_id").alias("k")).filter(F.col("k") > 1)
    checks = [
        cnt(gpm.select("gene_seqhash_id").distinct(), "genes"),
        cnt(gpm.select("protein_seqhash_id").distinct(), "proteins"),
        cnt(gpm, "gene_protein_relations"),
        cnt(genes_multi, "genes_with_multiple_proteins"),
        cnt(cat.expression, "expression_rows"),
        cnt(cat.expression.join(gpm.select("gene_seqhash_id").distinct(), "gene_seqhash_id", "left_semi"), "expression_rows_linked_to_genes"),
        cnt(cat.annotations, "annotation_rows"),
        cnt(cat.annotations.join(seq_ids, "seqhash_id", "left_semi"), "annotations_linked_to_sequences"),
        cnt(cat.cluster_members, "cluster_member_rows"),
        cnt(cat.cluster_members.join(seq_ids, "seqhash_id", "left_semi"), "cluster_members_linked_to_sequences"),
        cnt(cat.clusters, "clusters"),
    ]
    return reduce(DataFrame.unionAll, checks)


def genes_with_most_proteins(cat: Catalog, k: int = 5) -> DataFrame:
    return (
        cat.gene_protein_map.groupBy("gene_seqhash_id").agg(F.count(F.lit(1)).alias("protein_count"))
        .filter(F.col("protein_count") > 1)
        .orderBy(F.col("protein_count").desc(), "gene_seqhash_id").limit(k)
    )


# N38 -----------------------------------------------------------------------
def cluster_members_of_representative(cat: Catalog, representative) -> DataFrame:
    return id_filter(cat.sequences, "repseq_id", representative).select(
        "seqhash_id", "sample_id", "length", "is_representative", "repseq_id"
    )


# N39 -----------------------------------------------------------------------
def cluster_sizes(cat: Catalog, exclude_self: bool = False) -> DataFrame:
    s = cat.sequences.select("seqhash_id", "repseq_id")
    if exclude_self:
        s = s.filter(F.col("seqhash_id") != F.col("repseq_id"))
    return s.groupBy("repseq_id").agg(F.count(F.lit(1)).alias("member_count")).orderBy(
        F.col("member_count").desc(), "repseq_id"
    )


# N40 -----------------------------------------------------------------------
def sample_cluster_listing(cat: Catalog, sample_id) -> DataFrame:
    mine = id_filter(cat.sequences.select("seqhash_id", "sample_id"), "sample_id", sample_id)
    clus = cat.cluster_members.join(mine.select("seqhash_id"), "seqhash_id", "left_semi").select("cluster_id").distinct()
    members = cat.cluster_members.join(clus, "cluster_id", "left_semi")
    return (
        members.join(cat.clusters.select("cluster_id", "representative_seqhash_id", "size"), "cluster_id")
        .join(cat.sequences.select("seqhash_id", F.col("sample_id").alias("member_sample"), "length"), "seqhash_id")
        .select("cluster_id", "representative_seqhash_id", "size", "seqhash_id", "member_sample", "length")
        .orderBy(F.col("size").desc(), "cluster_id", "seqhash_id")
    )


def busiest_sample(cat: Catalog) -> DataFrame:
    """Data-derived sample: the one with most sequences (ties: smallest id)."""
    return (
        cat.sequences.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "sample_id").limit(1).select("sample_id")
    )


# N41 -----------------------------------------------------------------------
def representative_growth(snapshots: DataFrame) -> DataFrame:
    """``snapshots``: (update, representative_count). Sorted, with the change from the previous
    update. The window has no partition key, but it runs over one row per update."""
    w = Window.orderBy("update")
    return snapshots.select("update", "representative_count").withColumn(
        "change", F.col("representative_count") - F.lag("representative_count").over(w)
    ).orderBy("update")


def representative_snapshots_by_year(cat: Catalog) -> DataFrame:
    """Cumulative representative count per assembly year (one snapshot per year)."""
    per_year = (
        cat.sequences.filter(F.col("is_representative"))
        .groupBy(F.year("assembly_date").alias("update")).agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.orderBy("update").rowsBetween(Window.unboundedPreceding, 0)
    return per_year.select("update", F.sum("n").over(w).alias("representative_count"))


# N42 -----------------------------------------------------------------------
def run_size_total(cat: Catalog, sample_ids=None) -> DataFrame:
    m = id_filter(cat.sra_metadata, "sample_id", sample_ids)
    return m.agg(
        F.sum(F.col("run_bases").cast("bigint")).alias("total_bases"),
        F.sum(F.col("run_spots").cast("bigint")).alias("total_spots"),
        F.count(F.lit(1)).alias("runs"),
    )


# N43 -----------------------------------------------------------------------
def representative_annotation_export(cat: Catalog) -> DataFrame:
    reps = cat.sequences.filter(F.col("is_representative")).select("seqhash_id", "sample_id")
    a = cat.annotations.select(
        "seqhash_id", "seed_ortholog", "evalue", "description", "preferred_name", "cog_category", "max_annot_lvl",
        "eggnog_ogs",
    )
    return reps.join(cat.sra_metadata.select("sample_id", "organism"), "sample_id", "left").join(a, "seqhash_id")


# N44 -----------------------------------------------------------------------
def catalog_totals(cat: Catalog) -> DataFrame:
    parts = [
        cat.sequences.select(F.lit(1).alias("s"), F.lit(None).cast("int").alias("c"), F.lit(None).cast("int").alias("m"),
                             F.lit(None).cast("int").alias("d")),
        cat.clusters.select(F.lit(None).cast("int").alias("s"), F.lit(1).alias("c"), F.lit(None).cast("int").alias("m"),
                            F.lit(None).cast("int").alias("d")),
        cat.cluster_members.select(F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("c"), F.lit(1).alias("m"),
                                   F.lit(None).cast("int").alias("d")),
        cat.sequences.select("sample_id").filter(F.col("sample_id").isNotNull()).distinct().select(
            F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("c"), F.lit(None).cast("int").alias("m"),
            F.lit(1).alias("d")),
    ]
    u = reduce(DataFrame.unionAll, parts)
    return u.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in
                   (("s", "total_sequences"), ("c", "total_clusters"), ("m", "total_members"), ("d", "total_samples"))])


def table_preview(cat: Catalog, n: int = 3) -> DataFrame:
    """First ``n`` rows of every table by primary key, as (table_name, row_key, row_json): a top-k per
    table (TakeOrderedAndProject), never a full sort."""
    from ortholake.catalog import PRIMARY_KEYS

    parts = []
    for name in cat.names:
        df = cat[name]
        key = [k for k in PRIMARY_KEYS.get(name, []) if k in df.columns] or df.columns[:1]
        top = df.orderBy(*key).limit(n)
        parts.append(top.select(F.lit(name).alias("table_name"), F.to_json(F.struct(*key)).alias("row_key"), F.to_json(F.struct(*df.columns)).alias("row_json")))
    return reduce(DataFrame.unionAll, parts)
