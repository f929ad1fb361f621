"""Sequence-set operators (R1-R8): content ids, contaminant screening, depth normalisation,
read filtering, homology search and clustering, as distributed table jobs.

The studied system shells out to external tools for these; here each has a deterministic
definition of its own (documented per function) so results are testable:

* texts are compared through n-gram shingles of the whole text, of words or (``unit="char"``) of characters; a shingle index is a plain (id, shingle) table, and matching is an equi-join on the
  shingle after a semi-join has removed every shingle that cannot match;
* ranking is exact: the per-query top-k is taken in two stages over salted groups, so a
  query with a huge candidate list is never sorted in one task, and no candidate is capped;
* clustering links two texts whose shingle sets reach an identity, confirmed on the whole sets;
  candidates come from a rare-first prefix index (``operators.similarity``), and clusters are the connected
  components of the links. A kept index (``operators.cluster_index``) takes further batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ortholake.functions.columns import content_id
from ortholake.operators.kmer_depth import depths
from ortholake.operators.kmers import kmers_in, reference_kmers
from ortholake.operators.similarity import measured, only, similar_components, with_shingles
from ortholake.operators.strands import shared_kmers
from ortholake.session import materialise, scratch_path

# Fixed parameters of the operators (defaults).
SCREEN_NGRAM = 5          # word n-gram of the contaminant screen
SEARCH_NGRAM = 3          # word n-gram of the homology index
TOP_K = 5                 # hits kept per query
HOT_TARGETS = 10_000      # targets of an n-gram that is not matched by itself
TOPK_SALT = 16            # salted groups of the two-stage top-k
CLUSTER_PERCENT = 80      # identity of two linked sequences
HASH_SPACE = 1000         # resolution of the deterministic sampling draw


# R1 -------------------------------------------------------------------------
def content_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(id_col, content_id(text_col).alias("content_id"))


# Shingle tables -------------------------------------------------------------
units = with_shingles


def shingles(df: DataFrame, id_col: str, text_col: str, n: int, extra: list[str] | None = None, unit: str = "word") -> DataFrame:
    """Distinct (id, shingle) rows over the whole text (the text is cut once)."""
    w = units(df.select(id_col, *(extra or []), text_col), text_col, n, unit)
    return w.select(id_col, *(extra or []), F.explode(F.array_distinct("_ngrams")).alias("shingle"))


# R2 -------------------------------------------------------------------------
def contaminant_pairs(reads: DataFrame, refs: DataFrame, n: int = SCREEN_NGRAM,
                      read_id: str = "doc_id", ref_id: str = "item_id", text_col: str = "text", unit: str = "word") -> DataFrame:
    """(read_id, ref_id, shared): read / reference pairs sharing at least one n-gram; with
    ``unit="dna"`` a k-mer of ``n`` letters on either strand (``operators.strands``)."""
    if unit == "dna":
        return shared_kmers(reads, refs, n, read_id, ref_id, text_col)
    if unit == "char":
        fs = materialise(reference_kmers(refs, ref_id, text_col, n), "reference-kmers")
        hit = kmers_in(reads, read_id, text_col, n, fs).select(read_id, "shingle")
        return hit.join(fs, "shingle").groupBy(read_id, ref_id).agg(F.count(F.lit(1)).alias("shared"))
    rs = shingles(reads, read_id, text_col, n, unit=unit)
    fs = shingles(refs.select(F.col(ref_id), F.col(text_col)), ref_id, text_col, n, unit=unit)
    keys = fs.select("shingle").distinct()
    hit = rs.join(keys, "shingle", "left_semi")
    return hit.join(fs, "shingle").groupBy(read_id, ref_id).agg(F.count(F.lit(1)).alias("shared"))


def contaminant_screen(reads: DataFrame, refs: DataFrame, n: int = SCREEN_NGRAM, read_id: str = "doc_id",
                       ref_id: str = "item_id", text_col: str = "text", unit: str = "word") -> DataFrame:
    """Reads that share no word n-gram with the reference set (the clean output)."""
    pairs = contaminant_pairs(reads, refs, n, read_id, ref_id, text_col, unit)
    return reads.join(pairs.select(read_id).distinct(), read_id, "left_anti")


def contaminant_stats(reads: DataFrame, refs: DataFrame, n: int = SCREEN_NGRAM, read_id: str = "doc_id",
                      ref_id: str = "item_id", text_col: str = "text", unit: str = "word") -> DataFrame:
    """Per reference: reads matched and shared n-grams (summed over its reads)."""
    pairs = contaminant_pairs(reads, refs, n, read_id, ref_id, text_col, unit)
    return pairs.groupBy(ref_id).agg(F.count(F.lit(1)).alias("reads_matched"), F.sum("shared").alias("shared_total"))


def screen_report(reads: DataFrame, refs: DataFrame, sample_col: str = "source", n: int = SCREEN_NGRAM,
                  read_id: str = "doc_id", ref_id: str = "item_id", text_col: str = "text", unit: str = "word") -> DataFrame:
    """Per sample: reads in, reads removed, reads kept (the matched/total header of the tool)."""
    bad = contaminant_pairs(reads, refs, n, read_id, ref_id, text_col, unit).select(read_id).distinct().withColumn("_bad", F.lit(1))
    r = reads.select(read_id, sample_col).join(bad, read_id, "left")
    return r.groupBy(sample_col).agg(
        F.count(F.lit(1)).alias("reads_in"), F.count("_bad").alias("reads_removed"),
    ).withColumn("reads_kept", F.col("reads_in") - F.col("reads_removed"))


# R3 -------------------------------------------------------------------------
def _draw(id_col: str) -> Column:
    """Deterministic uniform draw in [0, HASH_SPACE) from the id (first 32 bits of its MD5)."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(HASH_SPACE))


def depth_normalize(reads: DataFrame, target: float, min_depth: float, n: int = 3, read_id: str = "doc_id",
                    text_col: str = "text", unit: str = "word") -> DataFrame:
    """Normalise coverage: a read's depth is the (lower) median, over its n-gram occurrences, of
    how often each n-gram occurs in the whole read set (``operators.kmer_depth``; on either strand with
    ``unit="dna"``). Read ids are unique. Reads below ``min_depth`` are dropped;
    reads above ``target`` are kept with probability target/depth using a deterministic draw."""
    depth = depths(reads, read_id, text_col, n, unit).withColumnRenamed("read", read_id).hint("shuffle_hash")     # reads need no sort
    r = reads.join(depth, read_id, "left").withColumn("depth", F.coalesce(F.col("depth"), F.lit(0)))
    keep = (F.col("depth") >= F.lit(min_depth)) & (
        (F.col("depth") <= F.lit(target)) | (_draw(read_id) * F.col("depth") < F.lit(target * HASH_SPACE))
    )
    return r.filter(keep)


# R4 -------------------------------------------------------------------------
def read_filter_flags(reads: DataFrame, min_chars: int = 50, min_letter_fraction: float = 0.6,
                      text_col: str = "text") -> DataFrame:
    letters = F.length(F.regexp_replace(F.col(text_col), r"[^\p{L}]", ""))
    frac = letters / F.greatest(F.length(F.col(text_col)), F.lit(1))
    return reads.withColumn("passed", (F.length(F.col(text_col)) >= min_chars) & (frac >= min_letter_fraction))


def read_filter_report(reads: DataFrame, sample_col: str = "source", text_col: str = "text", **rules) -> DataFrame:
    f = read_filter_flags(reads, text_col=text_col, **rules)
    return f.groupBy(sample_col).agg(
        F.count(F.lit(1)).alias("reads_before"),
        F.count(F.when(F.col("passed"), 1)).alias("reads_after"),
        F.sum(F.length(text_col)).cast("bigint").alias("chars_before"),
        F.coalesce(F.sum(F.when(F.col("passed"), F.length(text_col))), F.lit(0)).cast("bigint").alias("chars_after"),
    )


# Top-k ----------------------------------------------------------------------
def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int, salt_col: str,
                    salts: int = TOPK_SALT) -> DataFrame:
    """Exact top-k rows per ``group``: first within (group, salt) sub-groups, then over the at
    most ``k * salts`` survivors per group. Equal to ``row_number() <= k`` over the group."""
    s = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts)))
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    s = s.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    w2 = Window.partitionBy(group).orderBy(*order)
    return s.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k).drop("_salt", "_r1")


# R5 -------------------------------------------------------------------------
def homology_search(queries: DataFrame, targets: DataFrame, n: int = SEARCH_NGRAM, k: int = TOP_K,
                    query_id: str = "query", target_id: str = "target", text_col: str = "text",
                    target_text: bool = True, unit: str = "word", hot: int = HOT_TARGETS) -> DataFrame:
    """Ranked hits of each query against the targets by shared word n-grams.

    pident = 100 x shared / query n-grams (containment of the query), jaccard = shared / union.
    Ranking: shared desc, then target id; top ``k`` per query, exact.

    Rarest first: an n-gram in more than ``hot`` targets is counted only where it can matter. A target that
    shares none of a query's other n-grams shares at most as many as the query has hot ones; so once a query's
    k-th best without them is above that number, hot n-grams are looked up for its candidates only,
    by target and n-gram. For the queries left they are matched in ``TOPK_SALT`` parts of the targets each."""
    q = queries.select(F.col(query_id).alias("query"), F.col(text_col).alias("text"))
    t = targets.select(F.col(target_id).alias("target"), F.col(text_col).alias("text"))
    own = reference_kmers(q, "query", "text", n) if unit == "char" else shingles(q, "query", "text", n, unit=unit)
    qs = materialise(own, "query-grams")
    if unit == "char":
        ts = kmers_in(t, "target", "text", n, qs)
    else:
        sets = units(t, "text", n, unit).select("target", F.array_distinct("_ngrams").alias("set"))
        ts = sets.select("target", F.size("set").alias("t_n"), F.explode("set").alias("shingle"))
    hits = materialise(ts.join(qs.select("shingle").distinct(), "shingle", "left_semi"), "target-grams")
    common = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > hot).select("shingle")
    common = materialise(common, "hot-grams")
    rare = qs.join(hits.join(common, "shingle", "left_anti"), "shingle").groupBy("query", "target").agg(
        F.count(F.lit(1)).alias("r"), F.max("t_n").alias("t_n"))
    rare = materialise(rare, "pairs")

    q_hot = materialise(qs.join(common, "shingle", "left_semi"), "query-hot-grams")
    t_hot = materialise(hits.join(common, "shingle", "left_semi"), "target-hot-grams")
    most = q_hot.groupBy("query").agg(F.count(F.lit(1)).alias("h"))
    best = top_k_per_group(rare, "query", [F.col("r").desc(), F.col("target")], k, salt_col="target").filter(F.col("rank") == k)
    bound = most.join(best.select("query", F.col("r").alias("kth")), "query", "left")
    bound = materialise(bound.withColumn("closed", F.coalesce(F.col("kth") > F.col("h"), F.lit(False))), "bounds")

    # Candidates that may still be among the best k, by (target, n-gram): no n-gram is a key by itself.
    able = rare.join(bound.filter("closed"), "query").filter(F.col("r") + F.col("h") >= F.col("kth")).select("query", "target")
    looked = able.join(q_hot, "query").join(t_hot.select("target", "shingle"), ["target", "shingle"]).select("query", "target", F.lit(None).cast("int").alias("t_n"))
    salt = F.pmod(F.xxhash64("target"), F.lit(TOPK_SALT))
    open_ = q_hot.join(bound.filter("not closed"), "query", "left_semi").withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(TOPK_SALT - 1).cast("long"))))
    matched = open_.join(t_hot.withColumn("_s", salt), ["shingle", "_s"]).select("query", "target", "t_n")
    extra = looked.unionByName(matched).groupBy("query", "target").agg(F.count(F.lit(1)).alias("r"), F.max("t_n").alias("t_n"))
    pairs = rare.unionByName(extra).groupBy("query", "target").agg(F.sum("r").alias("shared_kmers"), F.max("t_n").alias("t_n"))

    qn = qs.groupBy("query").agg(F.count(F.lit(1)).alias("q_n"))
    scored = pairs.join(qn, "query").select(
        "query", "target", "shared_kmers",
        (F.lit(100.0) * F.col("shared_kmers") / F.col("q_n")).alias("pident"),
        (F.col("shared_kmers") / (F.col("q_n") + F.col("t_n") - F.col("shared_kmers"))).alias("jaccard"),
    )
    top = top_k_per_group(scored, "query", [F.col("shared_kmers").desc(), F.col("target")], k, salt_col="target")
    if target_text:
        top = top.join(t.select("target", F.col("text").alias("tseq")), "target")
    return top


# R6 -------------------------------------------------------------------------
def cluster_sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
                      n: int = SEARCH_NGRAM, percent: int = CLUSTER_PERCENT, unit: str = "word") -> DataFrame:
    """(id, representative): texts are linked where 100 * shared >= ``percent`` * union of their n-gram
    sets; clusters are the connected components, and the representative is the longest member, ties by
    smallest id. Texts without an n-gram stay by themselves. Equal sets are compared once."""
    length = F.col(length_col) if length_col else F.length(text_col)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed, order = measured(texts, n, unit)
    classes = materialise(keyed.groupBy("n", "h", "h2").agg(F.min("id").alias("rep")), "classes")
    named = materialise(keyed.join(classes, ["n", "h", "h2"]).select("id", "rep"), "named")
    reps = only(texts, classes.select("rep"))                # a copy that passes as well is only compared once more
    comp = similar_components(reps, order, percent, n, unit).select(F.col("id").alias("rep"), "component")
    comp = named.join(comp, "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    m = df.select(F.col(id_col).alias("id"), length.alias("_len")).join(materialise(comp, "components"), "id", "left")
    m = materialise(m.select("id", "_len", F.coalesce("component", "id").alias("component")), "members")
    longest = m.groupBy("component").agg(F.max("_len").alias("_most"))
    reps = m.join(longest, "component").filter(F.col("_len").eqNullSafe(F.col("_most"))).groupBy("component").agg(F.min("id").alias("representative"))
    return m.join(materialise(reps, "longest"), "component").select(F.col("id").alias(id_col), "representative")


# R7 -------------------------------------------------------------------------
def cluster_incremental(existing: DataFrame, new: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        rep_col: str = "representative", n: int = SEARCH_NGRAM, percent: int = CLUSTER_PERCENT, unit: str = "word") -> DataFrame:
    """Add a batch to an existing clustering with stable representatives.

    ``existing``: (id, text, representative). A new text linked to an existing representative
    joins that cluster (smallest such representative); the rest are clustered among
    themselves (R6). Existing assignments never change. One batch through a new index; to keep the index
    for further batches, use ``ClusterIndex`` itself."""
    from ortholake.operators.cluster_index import ClusterIndex

    index = ClusterIndex(existing.sparkSession, scratch_path(existing.sparkSession, "cluster-index"), n, percent, unit)
    index.start(existing.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(rep_col).alias("representative")))
    index.add(new.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "batch")
    return index.members().select(F.col("id").alias(id_col), F.col("representative").alias(rep_col))


# R8 -------------------------------------------------------------------------
def concat_batches(batches: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


__all__ = [
    "content_ids", "shingles", "contaminant_pairs", "contaminant_screen", "contaminant_stats", "screen_report",
    "depth_normalize", "read_filter_flags", "read_filter_report", "top_k_per_group", "homology_search",
    "cluster_sequences", "cluster_incremental",
    "concat_batches",
]
