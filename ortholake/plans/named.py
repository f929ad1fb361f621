"""The named query library (Q1-Q19): ``f(catalog, **params) -> DataFrame``, all lazy.

Parameters are Python values turned into literals or id frames, never spliced into SQL.
Every top-k carries a tie-break so results are deterministic, and every string
aggregate is sorted.

Fan-out queries (database summary, organism and sample statistics) keep the studied
system's semantics - averages weighted by the rows of the multi-way left join - but are
computed from one pre-aggregated row per sequence, so the join never materialises the
GO x EC x expression x member product (see ``_per_sequence``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ortholake.catalog import Catalog
from ortholake.functions.columns import (
    round_half_up,
    sorted_string_agg,
    tpm_bucket,
    tpm_bucket_order,
)
from ortholake.plans.common import exact_median, id_filter

# Relative accuracy of the mergeable quantile sketch used for medians; exact below this
# many values per group, bounded memory above.
QUANTILE_ACCURACY = 1_000_000


def median(col: str):
    """Lower median (an element of the input) from a bounded, mergeable quantile sketch."""
    return F.percentile_approx(F.col(col), F.lit(0.5), F.lit(QUANTILE_ACCURACY))


# ---------------------------------------------------------------------------
# Per-sequence facet counts: one shuffle for all facets instead of one join each
# ---------------------------------------------------------------------------
_FACETS = {"a": "annotations", "g": "go_terms", "e": "ec_numbers", "c": "cluster_members"}


def _facet_counts(cat: Catalog, facets: str = "agec") -> DataFrame | None:
    """(seqhash_id, n_a, n_g, n_e, n_c): rows per sequence in each facet table present."""
    parts = [
        cat[_FACETS[f]].select("seqhash_id", F.lit(f).alias("facet"))
        for f in facets
        if cat.has(_FACETS[f])
    ]
    if not parts:
        return None
    tagged = reduce(DataFrame.unionAll, parts)
    return tagged.groupBy("seqhash_id").agg(
        *[F.count(F.when(F.col("facet") == f, 1)).alias(f"n_{f}") for f in facets]
    )


def _expression_per_protein(cat: Catalog) -> DataFrame | None:
    """Per protein id of the gene map: rows of (map LEFT JOIN expression), TPM sum/count/min/max."""
    if not (cat.has("gene_protein_map") and cat.has("expression")):
        return None
    per_gene = cat.expression.groupBy("gene_seqhash_id").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("tpm").alias("tsum"),
        F.count("tpm").alias("tcnt"),
        F.min("tpm").alias("tmin"),
        F.max("tpm").alias("tmax"),
    )
    gpm = cat.gene_protein_map.select("gene_seqhash_id", "protein_seqhash_id")
    joined = gpm.join(per_gene, "gene_seqhash_id", "left")
    return joined.groupBy(F.col("protein_seqhash_id").alias("seqhash_id")).agg(
        F.sum(F.greatest(F.coalesce(F.col("k"), F.lit(0)), F.lit(1))).alias("x"),
        F.sum(F.coalesce(F.col("k"), F.lit(0))).alias("n_expr"),
        F.sum("tsum").alias("tsum"),
        F.sum("tcnt").alias("tcnt"),
        F.min("tmin").alias("tmin"),
        F.max("tmax").alias("tmax"),
    )


def _per_sequence(cat: Catalog, sequences: DataFrame, facets: str = "agec", expression: bool = False) -> DataFrame:
    """One row per sequence with facet row counts and the fan-out weight of the naive join."""
    s = sequences
    fc = _facet_counts(cat, facets)
    if fc is not None:
        s = s.join(fc, "seqhash_id", "left")
    for f in facets:
        col = f"n_{f}"
        if col not in s.columns:
            s = s.withColumn(col, F.lit(0).cast("bigint"))
        s = s.withColumn(col, F.coalesce(F.col(col), F.lit(0)))
        s = s.withColumn(f"w_{f}", F.greatest(F.col(col), F.lit(1)))
    if expression:
        ex = _expression_per_protein(cat)
        if ex is not None:
            s = s.join(ex, "seqhash_id", "left")
            s = s.withColumn("w_x", F.coalesce(F.col("x"), F.lit(1)))
        else:
            s = (
                s.withColumn("w_x", F.lit(1).cast("bigint"))
                .withColumn("tsum", F.lit(None).cast("double"))
                .withColumn("tcnt", F.lit(None).cast("bigint"))
                .withColumn("tmin", F.lit(None).cast("double"))
                .withColumn("tmax", F.lit(None).cast("double"))
                .withColumn("n_expr", F.lit(0).cast("bigint"))
            )
    w = reduce(lambda a, b: a * b, [F.col(f"w_{f}") for f in facets] + ([F.col("w_x")] if expression else []))
    return s.withColumn("w", w)


# ---------------------------------------------------------------------------
# Q1 annotation_with_expression
# ---------------------------------------------------------------------------
def annotation_with_expression(cat: Catalog, sample_id: str | None = None, limit: int = 50) -> DataFrame:
    a = cat.annotations
    if sample_id is not None:
        a = a.filter(F.col("sample_id") == F.lit(sample_id))
    a = a.select(
        F.col("seqhash_id").alias("protein_id"), "preferred_name", "description", F.col("sample_id")
    )
    gpm = cat.gene_protein_map.select(F.col("protein_seqhash_id").alias("protein_id"), F.col("gene_seqhash_id").alias("gene_id"))
    e = cat.expression.select(F.col("gene_seqhash_id").alias("gene_id"), F.col("sample_id").alias("e_sample"), "tpm", "num_reads")
    s = cat.sequences.select(F.col("seqhash_id").alias("protein_id"), F.col("length").alias("protein_length"))
    sm = cat.sra_metadata.select("sample_id", "organism")
    # The top rows are found by keys; text columns join the few that remain.
    order = [F.col("tpm").desc(), F.col("protein_id"), F.col("e_sample")]
    ids = a.select("protein_id", "sample_id").join(sm, "sample_id", "left_semi").join(s, "protein_id", "left_semi")
    top = e.join(gpm, "gene_id").join(ids, "protein_id", "left_semi").orderBy(*order).limit(limit)
    return (
        top.join(a, "protein_id").join(s, "protein_id").join(sm, "sample_id")
        .orderBy(*order)
        .limit(limit)
        .select("protein_id", "gene_id", "preferred_name", "description", "tpm", "num_reads", "protein_length",
                "sample_id", "organism")
    )


# ---------------------------------------------------------------------------
# Q2 cluster_info
# ---------------------------------------------------------------------------
def _go_ec_strings(cat: Catalog, ids: DataFrame, sep: str = "; ") -> DataFrame:
    """(seqhash_id, go_terms, ec_numbers) for the given ids, each facet aggregated on its own."""
    out = ids
    for table, col, name in (("go_terms", "go_term", "go_terms"), ("ec_numbers", "ec_number", "ec_numbers")):
        if cat.has(table):
            agg = (
                cat[table].join(ids, "seqhash_id", "left_semi")
                .groupBy("seqhash_id").agg(sorted_string_agg(col, sep).alias(name))
            )
            out = out.join(agg, "seqhash_id", "left")
        else:
            out = out.withColumn(name, F.lit(None).cast("string"))
    return out


def cluster_info(cat: Catalog, cluster_id) -> DataFrame:
    members = id_filter(cat.cluster_members, "cluster_id", cluster_id).select("seqhash_id").distinct()
    s = cat.sequences.join(members, "seqhash_id", "left_semi").select(
        "seqhash_id", "sample_id", "length", "is_representative"
    )
    a = cat.annotations.select("seqhash_id", "description", "preferred_name", "cog_category")
    strings = _go_ec_strings(cat, s.select("seqhash_id"))
    return s.join(a, "seqhash_id", "left").join(strings, "seqhash_id", "left").select(
        "seqhash_id", "sample_id", "length", "is_representative", "description", "preferred_name", "cog_category",
        "go_terms", "ec_numbers",
    )


def largest_cluster(cat: Catalog) -> DataFrame:
    """The cluster with the most members (ties: smallest id), as a one-row id frame."""
    return cat.clusters.orderBy(F.col("size").desc(), F.col("cluster_id")).limit(1).select("cluster_id")


# ---------------------------------------------------------------------------
# Q3 cluster_stats
# ---------------------------------------------------------------------------
def cluster_stats(cat: Catalog) -> DataFrame:
    return cat.clusters.agg(
        F.count_distinct("cluster_id").alias("total_clusters"),
        F.avg("size").alias("avg_cluster_size"),
        F.min("size").alias("min_cluster_size"),
        F.max("size").alias("max_cluster_size"),
        median("size").alias("median_cluster_size"),
    )


# ---------------------------------------------------------------------------
# Q4 database_summary / Q5 database_summary_dynamic
# ---------------------------------------------------------------------------
def database_summary(cat: Catalog, dynamic: bool = False) -> DataFrame:
    """Catalogue summary. ``dynamic=True`` is the variant that only reports on tables present
    and returns an error row when the core tables are missing."""
    if dynamic and not (cat.has("sequences") and cat.has("sra_metadata")):
        return cat.spark.createDataFrame(
            [("error", "Database schema not fully initialized")], "status string, message string"
        )
    has_expr = cat.has("gene_protein_map") and cat.has("expression")
    facets = "".join(f for f in "agec" if cat.has(_FACETS[f])) if dynamic else "agec"
    seqs = cat.sequences.select("seqhash_id", "sample_id", "length", "is_representative")
    ps = _per_sequence(cat, seqs, facets=facets, expression=(has_expr if dynamic else True))

    # Multi-key distinct counts are taken over small keyed frames and combined in one
    # global aggregate (tagged union), so there is no cross join and no Expand.
    per_seq = ps.select(
        F.lit(1).alias("n_seq"),
        F.col("is_representative").cast("int").alias("n_rep"),
        *[(F.col(f"n_{f}") > 0).cast("int").alias(f"has_{f}") for f in facets],
        *(
            [(F.col("n_expr") > 0).cast("int").alias("has_x"),
             (F.col("length") * F.col("w")).alias("lw"), F.col("w"),
             (F.col("tsum") * (F.col("w") / F.col("w_x"))).alias("tw"),
             (F.col("tcnt") * (F.col("w") / F.col("w_x"))).alias("cw"),
             F.col("tmin"), F.col("tmax")]
            if "n_expr" in ps.columns
            else [(F.col("length") * F.col("w")).alias("lw"), F.col("w")]
        ),
        F.col("length"),
    )
    samples = seqs.select("sample_id").filter(F.col("sample_id").isNotNull()).distinct().select(F.lit(1).alias("n_sample"))
    pieces = [per_seq, samples]
    if cat.has("gene_protein_map") and not dynamic:
        genes = (
            cat.gene_protein_map.join(seqs.select(F.col("seqhash_id").alias("protein_seqhash_id")), "protein_seqhash_id", "left_semi")
            .select("gene_seqhash_id").filter(F.col("gene_seqhash_id").isNotNull()).distinct()
            .select(F.lit(1).alias("n_gene"))
        )
        pieces.append(genes)
    if cat.has("cluster_members") and cat.has("clusters"):
        cl = (
            cat.cluster_members.join(seqs.select("seqhash_id"), "seqhash_id", "left_semi")
            .select("cluster_id").distinct()
            .join(cat.clusters.select("cluster_id"), "cluster_id", "left_semi")
            .select(F.lit(1).alias("n_cluster"))
        )
        pieces.append(cl)
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    for c in ("n_gene", "n_cluster"):
        if c not in u.columns:
            u = u.withColumn(c, F.lit(None).cast("int"))

    def cnt(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    cols = [
        cnt("n_seq").alias("total_sequences"),
        cnt("n_sample").alias("total_samples"),
        cnt("n_rep").alias("representative_sequences"),
    ]
    names = {"a": "annotated_sequences", "g": "sequences_with_go", "e": "sequences_with_ec"}
    for f in "age":
        if f in facets:
            cols.append(cnt(f"has_{f}").alias(names[f]))
    if not dynamic:
        cols.append(cnt("n_gene").alias("total_genes"))
    if "has_x" in per_seq.columns:
        cols.append(cnt("has_x").alias("sequences_with_expression"))
    if cat.has("cluster_members") and cat.has("clusters"):
        cols.append(cnt("n_cluster").alias("total_clusters"))
    elif not dynamic:
        cols.append(F.lit(0).cast("bigint").alias("total_clusters"))
    cols += [
        round_half_up(F.sum("lw") / F.sum("w"), 2).alias("avg_sequence_length"),
        F.min("length").alias("min_sequence_length"),
        F.max("length").alias("max_sequence_length"),
    ]
    if not dynamic:
        has_tpm = F.sum("cw") > 0
        cols += [
            F.when(has_tpm, round_half_up(F.sum("tw") / F.sum("cw"), 2)).alias("avg_tpm"),
            F.when(has_tpm, round_half_up(F.max("tmax"), 2)).alias("max_tpm"),
            F.when(has_tpm, round_half_up(F.min("tmin"), 2)).alias("min_tpm"),
        ]
    return u.agg(*cols)


# ---------------------------------------------------------------------------
# Q6 ec_number_summary
# ---------------------------------------------------------------------------
def ec_number_summary(cat: Catalog) -> DataFrame:
    ec = cat.ec_numbers.join(cat.sequences.select("seqhash_id"), "seqhash_id", "left_semi")
    return (
        ec.groupBy("ec_number").agg(F.count_distinct("seqhash_id").alias("sequence_count"))
        .filter(F.col("sequence_count") >= 1)
        .orderBy(F.col("sequence_count").desc(), F.col("ec_number"))
    )


# ---------------------------------------------------------------------------
# Q7 expression_distribution
# ---------------------------------------------------------------------------
def expression_distribution(cat: Catalog, sample_id: str | None = None) -> DataFrame:
    e = cat.expression
    if sample_id is not None:
        e = e.filter(F.col("sample_id") == F.lit(sample_id))
    counts = e.groupBy(tpm_bucket("tpm").alias("expression_level")).agg(F.count(F.lit(1)).alias("count"))
    # At most four rows: the window over () runs on a bounded input.
    total = F.sum("count").over(Window.partitionBy())
    return (
        counts.withColumn("percentage", round_half_up(F.col("count").cast("double") * 100.0 / total, 2))
        .orderBy(tpm_bucket_order("expression_level"))
    )


# ---------------------------------------------------------------------------
# Q8 expression_summary
# ---------------------------------------------------------------------------
def expression_summary(cat: Catalog, sample_id: str | None = None) -> DataFrame:
    """Expression statistics; the median is exact and interpolated (see ``exact_median``)."""
    e = cat.expression
    if sample_id is not None:
        e = e.filter(F.col("sample_id") == F.lit(sample_id))
    e = e.filter(F.col("sample_id").isNotNull())
    stats = e.agg(
        F.lit(sample_id if sample_id is not None else "all").alias("sample_id"),
        F.count(F.lit(1)).alias("expression_records"),
        round_half_up(F.min("tpm"), 2).alias("min_tpm"),
        round_half_up(F.max("tpm"), 2).alias("max_tpm"),
        round_half_up(F.avg("tpm"), 2).alias("mean_tpm"),
        round_half_up(F.stddev_samp("tpm"), 2).alias("std_tpm"),
        round_half_up(F.avg("num_reads"), 2).alias("mean_reads"),
        round_half_up(F.sum("num_reads"), 0).alias("total_reads"),
    )
    med = exact_median(e, "tpm", "m").select(round_half_up(F.col("m"), 2).alias("median_tpm"))
    # two one-row frames joined on a constant key
    return stats.withColumn("_k", F.lit(1)).join(med.withColumn("_k", F.lit(1)), "_k").select(
        "sample_id", "expression_records", "min_tpm", "max_tpm", "mean_tpm", "median_tpm", "std_tpm", "mean_reads",
        "total_reads",
    )


# ---------------------------------------------------------------------------
# Q9 go_term_summary
# ---------------------------------------------------------------------------
def go_term_summary(cat: Catalog, sample_id: str | None = None) -> DataFrame:
    s = cat.sequences.select("seqhash_id", "sample_id")
    if sample_id is not None:
        s = s.filter(F.col("sample_id") == F.lit(sample_id))
    j = cat.go_terms.select("seqhash_id", "go_term").join(s, "seqhash_id")
    return (
        j.groupBy("go_term").agg(
            F.count_distinct("seqhash_id").alias("sequence_count"),
            sorted_string_agg("sample_id", ", ").alias("sample_ids"),
        )
        .filter(F.col("sequence_count") >= 1)
        .orderBy(F.col("sequence_count").desc(), F.col("go_term"))
    )


# ---------------------------------------------------------------------------
# Q10 organism_summary
# ---------------------------------------------------------------------------
def organism_summary(cat: Catalog) -> DataFrame:
    seqs = cat.sequences.select("seqhash_id", "sample_id", "length")
    ps = _per_sequence(cat, seqs, facets="ac")
    per_sample = ps.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_seq"),
        F.sum(F.col("length") * F.col("w")).alias("lw"),
        F.sum("w").alias("w"),
        F.sum((F.col("n_a") > 0).cast("int")).alias("n_annot"),
        F.sum((F.col("n_c") > 0).cast("int")).alias("n_clust"),
    )
    m = cat.sra_metadata.filter(F.col("organism").isNotNull()).select("sample_id", "organism", "bioproject")
    m_rows = m.groupBy("organism", "sample_id").agg(F.count(F.lit(1)).alias("m_cnt"))
    j = per_sample.join(m_rows, "sample_id")
    agg = j.groupBy("organism").agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.sum("n_seq").alias("total_sequences"),
        round_half_up(F.sum(F.col("lw") * F.col("m_cnt")) / F.sum(F.col("w") * F.col("m_cnt")), 2).alias("avg_sequence_length"),
        F.sum("n_annot").alias("annotated_sequences"),
        F.sum("n_clust").alias("sequences_in_clusters"),
    )
    projects = (
        m.join(per_sample.select("sample_id"), "sample_id", "left_semi")
        .groupBy("organism").agg(sorted_string_agg("bioproject", "; ").alias("bioprojects"))
    )
    return (
        agg.join(projects, "organism", "left")
        .select(
            "organism", "sample_count", "total_sequences", "avg_sequence_length", "annotated_sequences",
            round_half_up(F.col("annotated_sequences").cast("double") * 100.0 / F.col("total_sequences"), 2).alias("percent_annotated"),
            "sequences_in_clusters", "bioprojects",
        )
        .orderBy(F.col("total_sequences").desc(), F.col("organism"))
    )


# ---------------------------------------------------------------------------
# Q11 sample_metadata (sample_id=None: every sample)
# ---------------------------------------------------------------------------
SAMPLE_META_COLUMNS = [
    "sample_id", "organism", "study_title", "study_abstract", "bioproject", "biosample", "library_strategy",
    "library_source", "library_selection", "library_layout", "instrument", "run_spots", "run_bases", "run_published",
]


def _sample_flags(cat: Catalog, seqs: DataFrame, facets: str) -> DataFrame:
    ps = _per_sequence(cat, seqs, facets=facets)
    return ps.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("total_sequences"),
        *[F.sum((F.col(f"n_{f}") > 0).cast("int")).cast("bigint").alias(f"has_{f}") for f in facets],
    )


def sample_metadata(cat: Catalog, sample_id: str | None = None) -> DataFrame:
    m = cat.sra_metadata
    seqs = cat.sequences.select("seqhash_id", "sample_id")
    if sample_id is not None:
        m = m.filter(F.col("sample_id") == F.lit(sample_id))
        seqs = seqs.filter(F.col("sample_id") == F.lit(sample_id))
    per_sample = _sample_flags(cat, seqs, "agec")
    mcols = [c for c in SAMPLE_META_COLUMNS if c in m.columns]
    mg = m.groupBy(*mcols).agg(F.count(F.lit(1)).alias("_k"))
    return mg.join(per_sample, "sample_id").select(
        *mcols,
        "total_sequences",
        F.col("has_a").alias("annotated_sequences"),
        F.col("has_g").alias("sequences_with_go"),
        F.col("has_e").alias("sequences_with_ec"),
        F.col("has_c").alias("sequences_in_clusters"),
    )


# ---------------------------------------------------------------------------
# Q12 sample_stats
# ---------------------------------------------------------------------------
def sample_stats(cat: Catalog, sample_id: str | None = None) -> DataFrame:
    seqs = cat.sequences.select("seqhash_id", "sample_id", "length", "is_representative")
    if sample_id is not None:
        seqs = seqs.filter(F.col("sample_id") == F.lit(sample_id))
    ps = _per_sequence(cat, seqs, facets="agec")
    per_sample = ps.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("total_sequences"),
        (F.sum(F.col("length") * F.col("w")) / F.sum("w")).alias("avg_length"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        F.sum((F.col("n_a") > 0).cast("int")).cast("bigint").alias("annotated_sequences"),
        F.sum((F.col("n_g") > 0).cast("int")).cast("bigint").alias("sequences_with_go"),
        F.sum((F.col("n_e") > 0).cast("int")).cast("bigint").alias("sequences_with_ec"),
        F.sum(F.col("is_representative").cast("int")).cast("bigint").alias("representative_sequences"),
    )
    clusters = (
        cat.cluster_members.join(seqs.select("seqhash_id", "sample_id"), "seqhash_id")
        .select("sample_id", "cluster_id").distinct()
        .groupBy("sample_id").agg(F.count(F.lit(1)).alias("clusters"))
    )
    return per_sample.join(clusters, "sample_id", "left").select(
        "sample_id", "total_sequences", "avg_length", "min_length", "max_length", "annotated_sequences",
        "sequences_with_go", "sequences_with_ec", "representative_sequences",
        F.coalesce(F.col("clusters"), F.lit(0)).cast("bigint").alias("clusters"),
    )


# ---------------------------------------------------------------------------
# Q13 search_samples_by_id (ids=None: every sample)
# ---------------------------------------------------------------------------
SAMPLE_SEARCH_COLUMNS = [
    "sample_id", "organism", "study_title", "bioproject", "biosample", "library_strategy", "library_source",
    "library_selection", "library_layout", "instrument",
]


def search_samples_by_id(cat: Catalog, sample_ids=None) -> DataFrame:
    m = id_filter(cat.sra_metadata, "sample_id", sample_ids)
    mcols = [c for c in SAMPLE_SEARCH_COLUMNS if c in m.columns]
    seqs = cat.sequences.select("seqhash_id", "sample_id", "is_representative").join(
        m.select("sample_id").distinct(), "sample_id", "left_semi"
    )
    ps = _per_sequence(cat, seqs, facets="a")
    per_sample = ps.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("sequence_count"),
        F.sum(F.col("is_representative").cast("int")).cast("bigint").alias("representative_count"),
        F.sum((F.col("n_a") > 0).cast("int")).cast("bigint").alias("annotated_count"),
    )
    mg = m.groupBy(*mcols).agg(F.count(F.lit(1)).alias("_k"))
    return (
        mg.join(per_sample, "sample_id", "left")
        .select(
            *mcols,
            *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
              for c in ("sequence_count", "representative_count", "annotated_count")],
        )
        .orderBy("sample_id")
    )


# ---------------------------------------------------------------------------
# Q14 search_sequence_by_seqhash
# ---------------------------------------------------------------------------
def search_sequence_by_seqhash(cat: Catalog, seqhash_ids) -> DataFrame:
    """Full profile of the given sequences. Every facet is pre-aggregated per id before the
    joins (one row per id; cluster_size = members of the cluster)."""
    s = id_filter(cat.sequences, "seqhash_id", seqhash_ids).select(
        "seqhash_id", "sample_id", "is_representative", "length", "sequence"
    )
    ids = s.select("seqhash_id")
    a = cat.annotations.join(ids, "seqhash_id", "left_semi").select(
        "seqhash_id", "description", "preferred_name", "cog_category", "seed_ortholog"
    )
    sm = cat.sra_metadata.select("sample_id", "organism")
    mine = cat.cluster_members.join(ids, "seqhash_id", "left_semi").select("seqhash_id", "cluster_id")
    members = (
        cat.cluster_members.join(mine.select("cluster_id").distinct(), "cluster_id", "left_semi")
        .groupBy("cluster_id")
        .agg(F.count(F.lit(1)).alias("cluster_size"), F.array_sort(F.collect_list("seqhash_id")).alias("cluster_members"))
    )
    clus = mine.join(members, "cluster_id")
    go = cat.go_terms.join(ids, "seqhash_id", "left_semi").groupBy("seqhash_id").agg(
        F.array_sort(F.collect_list("go_term")).alias("go_terms")
    )
    ec = cat.ec_numbers.join(ids, "seqhash_id", "left_semi").groupBy("seqhash_id").agg(
        F.array_sort(F.collect_list("ec_number")).alias("ec_numbers")
    )
    gpm = cat.gene_protein_map.join(ids.select(F.col("seqhash_id").alias("protein_seqhash_id")), "protein_seqhash_id", "left_semi")
    expr = (
        gpm.join(cat.expression, "gene_seqhash_id")
        .groupBy(F.col("protein_seqhash_id").alias("seqhash_id"))
        .agg(F.avg("tpm").alias("avg_tpm"), F.max("tpm").alias("max_tpm"), F.sum("num_reads").alias("total_reads"))
    )
    return (
        s.join(a, "seqhash_id", "left").join(sm, "sample_id", "left")
        .join(clus, "seqhash_id", "left").join(go, "seqhash_id", "left").join(ec, "seqhash_id", "left")
        .join(expr, "seqhash_id", "left")
        .select(
            "seqhash_id", "sample_id", "organism", "is_representative", "length", "sequence", "description",
            "preferred_name", "cog_category", "seed_ortholog", "cluster_id", "cluster_size", "cluster_members",
            "go_terms", "ec_numbers", "avg_tpm", "max_tpm", "total_reads",
        )
        .orderBy("seqhash_id", "cluster_id")
    )


def search_sequence_members(cat: Catalog, seqhash_ids) -> DataFrame:
    """Long form of the member list of ``search_sequence_by_seqhash``: one row per (queried
    id, member of its cluster). Use it when clusters are too large for one array per row."""
    ids = id_filter(cat.sequences, "seqhash_id", seqhash_ids).select("seqhash_id")
    mine = cat.cluster_members.join(ids, "seqhash_id", "left_semi").select(F.col("seqhash_id").alias("query_id"), "cluster_id")
    return mine.join(cat.cluster_members.select("cluster_id", F.col("seqhash_id").alias("member_id")), "cluster_id")


# ---------------------------------------------------------------------------
# Q15 search_sequences
# ---------------------------------------------------------------------------
def search_sequences(
    cat: Catalog,
    sample_ids=None,
    min_length: int | None = None,
    max_length: int | None = None,
    description: str | None = None,
    organism: str | None = None,
    cog_categories: list[str] | None = None,
    go_terms: list[str] | None = None,
) -> DataFrame:
    """DISTINCT sequence rows matching every given filter. As in the studied API, 0/empty
    values count as "not given", matches are substring matches, and there is no row cap."""
    s = cat.sequences.select("seqhash_id", "sample_id", "length", "is_representative")
    if sample_ids:
        s = id_filter(s, "sample_id", sample_ids)
    if min_length:
        s = s.filter(F.col("length") >= F.lit(min_length))
    if max_length:
        s = s.filter(F.col("length") <= F.lit(max_length))
    if go_terms:
        # g.go_term IN (...) on a left join keeps only sequences with a matching term.
        s = s.join(cat.go_terms.filter(F.col("go_term").isin(list(go_terms))).select("seqhash_id"), "seqhash_id", "left_semi")
    a = cat.annotations.select(
        "seqhash_id", "description", "preferred_name", "cog_category", "evalue", "seed_ortholog", "max_annot_lvl",
        "eggnog_ogs",
    )
    cm = cat.cluster_members.select("seqhash_id", "cluster_id")
    c = cat.clusters.select("cluster_id", F.col("size").alias("cluster_size"))
    m = cat.sra_metadata.select("sample_id", "organism", "study_title", "bioproject", "biosample")
    j = s.join(a, "seqhash_id", "left").join(cm, "seqhash_id", "left").join(c, "cluster_id", "left").join(m, "sample_id", "left")
    if description:
        j = j.filter(F.col("description").contains(F.lit(description)))
    if organism:
        j = j.filter(F.col("organism").contains(F.lit(organism)))
    if cog_categories:
        j = j.filter(reduce(lambda x, y: x | y, [F.col("cog_category").contains(F.lit(k)) for k in cog_categories]))
    return j.select(
        "seqhash_id", "sample_id", "length", "is_representative", "description", "preferred_name", "cog_category",
        "evalue", "seed_ortholog", "max_annot_lvl", "eggnog_ogs", "cluster_id", "cluster_size", "organism",
        "study_title", "bioproject", "biosample",
    ).distinct()


# ---------------------------------------------------------------------------
# Q16 sequence_annotations (ids=None: every sequence)
# ---------------------------------------------------------------------------
def sequence_annotations(cat: Catalog, seqhash_ids=None) -> DataFrame:
    s = id_filter(cat.sequences, "seqhash_id", seqhash_ids).select("seqhash_id", "sample_id")
    m = cat.sra_metadata.select("sample_id", "organism")
    a = cat.annotations.select("seqhash_id", "description", "preferred_name", "cog_category")
    k = cat.kegg_info.select("seqhash_id", "kegg_ko", "kegg_pathway")
    strings = _go_ec_strings(cat, s.select("seqhash_id"))
    return (
        s.join(m, "sample_id", "left").join(a, "seqhash_id", "left").join(k, "seqhash_id", "left")
        .join(strings, "seqhash_id", "left")
        .select("seqhash_id", "sample_id", "organism", "description", "preferred_name", "cog_category", "go_terms",
                "ec_numbers", "kegg_ko", "kegg_pathway")
    )


# ---------------------------------------------------------------------------
# Q17 sequence_by_id (ids=None: every sequence)
# ---------------------------------------------------------------------------
def sequence_by_id(cat: Catalog, seqhash_id=None) -> DataFrame:
    s = id_filter(cat.sequences, "seqhash_id", seqhash_id)
    scols = s.columns
    a = cat.annotations.select(
        "seqhash_id", "seed_ortholog", "evalue", "score", "eggnog_ogs", "description", "preferred_name", "cog_category"
    )
    k = cat.kegg_info.select("seqhash_id", "kegg_ko", "kegg_pathway", "kegg_module")
    cm = cat.cluster_members.select("seqhash_id", "cluster_id")
    c = cat.clusters.select("cluster_id", F.col("size").alias("cluster_size"))
    strings = _go_ec_strings(cat, s.select("seqhash_id"))
    return (
        s.join(a, "seqhash_id", "left").join(strings, "seqhash_id", "left").join(k, "seqhash_id", "left")
        .join(cm, "seqhash_id", "left").join(c, "cluster_id", "left")
        .select(*scols, "seed_ortholog", "evalue", "score", "eggnog_ogs", "description", "preferred_name",
                "cog_category", "go_terms", "ec_numbers", "kegg_ko", "kegg_pathway", "kegg_module", "cluster_id",
                "cluster_size")
    )


# ---------------------------------------------------------------------------
# Q18 sequence_expression
# ---------------------------------------------------------------------------
def resolve_genes(cat: Catalog, seq_id) -> DataFrame:
    """Gene ids for a gene or protein id: an id containing ``.p`` is looked up in the gene map.

    Literal ids become literal filters (pushed to the Parquet scans); an id frame is joined."""
    if isinstance(seq_id, DataFrame):
        ids = seq_id.select(F.col(seq_id.columns[0]).alias("id"))
        is_protein = F.col("id").contains(".p")
        genes = ids.filter(~is_protein).select(F.col("id").alias("gene_seqhash_id"))
        prot = ids.filter(is_protein).select(F.col("id").alias("protein_seqhash_id"))
        mapped = cat.gene_protein_map.join(prot, "protein_seqhash_id", "left_semi").select("gene_seqhash_id")
        return genes.unionByName(mapped).distinct()
    vals = [seq_id] if isinstance(seq_id, str) else list(seq_id)
    gene_vals = [v for v in vals if ".p" not in v]
    prot_vals = [v for v in vals if ".p" in v]
    mapped = cat.gene_protein_map.filter(F.col("protein_seqhash_id").isin(prot_vals)).select("gene_seqhash_id")
    if gene_vals:
        lit_genes = cat.spark.createDataFrame([(g,) for g in gene_vals], "gene_seqhash_id string")
        mapped = mapped.unionByName(lit_genes)
    return mapped.distinct()


def sequence_expression(cat: Catalog, seq_id) -> DataFrame:
    e = cat.expression
    if isinstance(seq_id, str) and ".p" not in seq_id:
        e = e.filter(F.col("gene_seqhash_id") == F.lit(seq_id))          # pushed to the scan
    else:
        e = e.join(resolve_genes(cat, seq_id), "gene_seqhash_id", "left_semi")
    sm = cat.sra_metadata.select("sample_id", "organism", "study_title")
    return (
        e.join(sm, "sample_id")
        .select("sample_id", "tpm", "num_reads", "effective_length", "organism", "study_title")
        .orderBy(F.col("tpm").desc(), F.col("sample_id"))
    )


# ---------------------------------------------------------------------------
# Q19 top_expressed_sequences
# ---------------------------------------------------------------------------
def top_expressed_sequences(cat: Catalog, limit: int = 10, sample_id: str | None = None) -> DataFrame:
    e = cat.expression.select("gene_seqhash_id", "sample_id", "tpm", "num_reads", "effective_length")
    if sample_id is not None:
        e = e.filter(F.col("sample_id") == F.lit(sample_id))
    gpm = cat.gene_protein_map.select("gene_seqhash_id", F.col("protein_seqhash_id").alias("seqhash_id"))
    s = cat.sequences.select(
        "seqhash_id", F.col("sample_id").alias("original_sample"), F.col("length").alias("sequence_length"),
        "is_representative",
    )
    a = cat.annotations.select("seqhash_id", "description", "preferred_name")
    order = [F.col("tpm").desc(), F.col("gene_seqhash_id"), F.col("sample_id"), F.col("seqhash_id")]
    top = e.join(gpm, "gene_seqhash_id").join(s, "seqhash_id").orderBy(*order).limit(limit)
    return (
        top.join(a, "seqhash_id", "left")       # a left join cannot change which rows win
        .orderBy(*order)
        .limit(limit)
        .select("gene_seqhash_id", "sample_id", "original_sample", "tpm", "num_reads", "effective_length",
                "sequence_length", "is_representative", "description", "preferred_name")
    )


__all__ = [
    "annotation_with_expression", "cluster_info", "cluster_stats", "database_summary", "ec_number_summary",
    "expression_distribution", "expression_summary", "go_term_summary", "organism_summary", "sample_metadata",
    "sample_stats", "search_samples_by_id", "search_sequence_by_seqhash", "search_sequences",
    "sequence_annotations", "sequence_by_id", "sequence_expression", "top_expressed_sequences", "largest_cluster",
    "resolve_genes", "search_sequence_members", "median",
]
