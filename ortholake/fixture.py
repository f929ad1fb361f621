"""Mapping of the driver's TPC-H-like parquet tables onto the catalogue schema.

The same mapping exists twice: as Spark DataFrame code (``build``), which is what every
registered query runs on, and as DuckDB SQL CTE text (``ORACLE_CTES``), which the
correctness oracle puts in front of its own SQL. Both must give equal rows.

Spark-side plan choices (equal results, better shape at scale):
* the cluster representative per ``pk % 500`` is an aggregate of at most 500 rows joined
  back by broadcast, instead of a window over 500 huge partitions;
* the EC derivation first reduces ``part`` to its distinct (brand, name, ec) triples, so
  the join cannot fan out over parts that share a brand and name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.catalog import SCHEMA_V2, Catalog, conform
from ortholake.session import materialise, scratch_path

# Fixed parameters of the mapping.
N_CLUSTER_GROUPS = 500          # parts equal modulo this share a cluster
ANNOTATED_EVERY = 3             # parts with pk % 3 == 0 carry no annotation
TAXA = ["Ascomycota", "Basidiomycota", "Bacteria", "Viridiplantae"]
TAXON_IDS = ["4890", "5204", "2", "33090"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string")


STAGES = ("seq_part", "expression")


def staged(spark: SparkSession, sf_dir: str, stages: tuple[str, ...] = STAGES) -> Catalog:
    """The mapped catalogue for a job that reads an aggregate of lineitem several times: each of
    ``stages`` is written once to a new folder under ``spark.checkpoint.dir``."""
    return build(spark, sf_dir, scratch_path(spark, "stage"), stages)


def build(spark: SparkSession, sf_dir: str, stage_dir: str | None = None, stages: tuple[str, ...] = STAGES) -> Catalog:
    """The mapped catalogue, lazily. With ``stage_dir`` (a folder on shared storage), those of
    the two lineitem aggregates every table derives from that ``stages`` names are written there once
    and read back, so writing all tables does not re-aggregate lineitem per table."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")

    base = (
        li.groupBy(F.col("l_partkey").alias("pk"), F.col("l_linenumber").alias("ln"))
        .agg(
            F.min("l_suppkey").alias("sk"),
            F.sum("l_quantity").cast("int").alias("length"),
            F.min("l_shipdate").alias("assembly_date"),
        )
        .withColumn("num", F.col("pk") * 10 + F.col("ln"))
    )
    # <= N_CLUSTER_GROUPS rows by construction: a proven bound, so broadcast is safe.
    reps = base.groupBy((F.col("pk") % N_CLUSTER_GROUPS).alias("grp")).agg(F.min("num").alias("rep"))
    seq_rep = base.join(F.broadcast(reps), (F.col("pk") % N_CLUSTER_GROUPS) == F.col("grp")).drop("grp")

    p = part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    seq_part = seq_rep.join(p, F.col("pk") == F.col("p_partkey"))
    if stage_dir is not None and "seq_part" in stages:
        seq_part.write.mode("overwrite").parquet(f"{stage_dir}/seq_part")
        seq_part = spark.read.parquet(f"{stage_dir}/seq_part")

    protein = F.concat(F.lit("v1_DLS_"), _s("pk"), F.lit(".p"), _s("ln"))
    sequences = seq_part.select(
        protein.alias("seqhash_id"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("sequence"),
        F.concat(F.lit("SRR"), _s("sk")).alias("sample_id"),
        F.col("assembly_date"),
        (F.col("num") == F.col("rep")).alias("is_representative"),
        F.concat(
            F.lit("v1_DLS_"), F.floor(F.col("rep") / 10).cast("bigint").cast("string"), F.lit(".p"),
            (F.col("rep") % 10).cast("string"),
        ).alias("repseq_id"),
        F.col("length"),
    )

    gene_protein_map = sequences.select(
        F.split_part(F.col("seqhash_id"), F.lit(".p"), F.lit(1)).alias("gene_seqhash_id"),
        F.col("seqhash_id").alias("protein_seqhash_id"),
    )

    expression = li.groupBy("l_partkey", "l_suppkey").agg(
        (F.max("l_extendedprice") * F.min("l_discount") / 50).alias("tpm"),
        F.sum("l_quantity").alias("num_reads"),
        (F.min("l_quantity") + 0.5).alias("effective_length"),
    ).select(
        F.concat(F.lit("v1_DLS_"), _s("l_partkey")).alias("gene_seqhash_id"),
        F.concat(F.lit("SRR"), _s("l_suppkey")).alias("sample_id"),
        "tpm", "num_reads", "effective_length",
    )
    if stage_dir is not None and "expression" in stages:
        expression.write.mode("overwrite").parquet(f"{stage_dir}/expression")
        expression = spark.read.parquet(f"{stage_dir}/expression")

    q = F.col("pk") % 4
    taxon = lambda vals: F.when(q == 0, F.lit(vals[0])).when(q == 1, F.lit(vals[1])).when(q == 2, F.lit(vals[2])).otherwise(F.lit(vals[3]))
    ann_src = seq_part.filter(F.col("pk") % ANNOTATED_EVERY != 0)
    annotations = ann_src.select(
        protein.alias("seqhash_id"),
        F.concat(F.lit("2711.XP_"), _s("pk")).alias("seed_ortholog"),
        (F.lit(1.0) / F.col("num")).cast("double").alias("evalue"),
        F.col("length").cast("double").alias("score"),
        F.concat(
            F.lit("COG"), (F.col("pk") % 89).cast("string"), F.lit("@1|root,KOG"), (F.col("pk") % 53).cast("string"),
            F.lit("@2759|Eukaryota,"), (F.col("pk") % 31).cast("string"), F.lit("X@"), taxon(TAXON_IDS), F.lit("|"),
            taxon(TAXA),
        ).alias("eggnog_ogs"),
        F.concat(taxon(TAXON_IDS), F.lit("|"), taxon(TAXA)).alias("max_annot_lvl"),
        F.when(F.col("p_type") == "ECONOMY", "Q").when(F.col("p_type") == "SMALL", "QE")
        .when(F.col("p_type") == "STANDARD", "KL").otherwise("S").alias("cog_category"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("preferred_name"),
        F.concat(F.lit("SRR"), _s("sk")).alias("sample_id"),
    )

    go_terms = (
        annotations.select("seqhash_id", F.split_part("description", F.lit(" "), F.lit(1)).alias("w"))
        .unionAll(annotations.select("seqhash_id", F.split_part("description", F.lit(" "), F.lit(2)).alias("w")))
        .select("seqhash_id", F.concat(F.lit("GO:"), F.col("w")).alias("go_term"))
        .distinct()
    )

    ec_parts = (
        part.filter(F.col("p_size") < 10)
        .select("p_brand", "p_name", F.concat(F.lit("EC:1."), (F.col("p_size") % 7).cast("string")).alias("ec_number"))
        .distinct()
    )
    ec_numbers = (
        annotations.select("seqhash_id", "preferred_name", "description")
        .join(ec_parts, (F.col("p_brand") == F.col("preferred_name")) & (F.col("p_name") == F.col("description")))
        .select("seqhash_id", "ec_number")
        .distinct()
    )

    clusters = sequences.groupBy("repseq_id").agg(F.count(F.lit(1)).cast("int").alias("size")).select(
        F.col("repseq_id").alias("cluster_id"), F.col("repseq_id").alias("representative_seqhash_id"), "size"
    )
    cluster_members = sequences.select("seqhash_id", F.col("repseq_id").alias("cluster_id"))

    sc = F.col("score").cast("int")
    kegg_info = annotations.filter(sc % 2 == 0).select(
        "seqhash_id",
        F.concat(F.lit("ko:K"), (sc % 50).cast("string")).alias("kegg_ko"),
        F.when(sc % 4 == 0, F.lit("-")).otherwise(F.concat(F.lit("map"), (sc % 9).cast("string"))).alias("kegg_pathway"),
        F.lit("-").alias("kegg_module"),
        F.lit("-").alias("kegg_reaction"),
        F.lit("-").alias("kegg_rclass"),
        F.lit("ko00000").alias("brite"),
        F.lit("-").alias("kegg_tc"),
        F.when(sc % 5 == 0, F.lit("GH5")).otherwise(F.lit("-")).alias("cazy"),
        F.lit("-").alias("bigg_reaction"),
        F.concat(F.lit("PF"), (sc % 97).cast("string")).alias("pfams"),
        "sample_id",
    )

    sra_metadata = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("SRR"), _s("s_suppkey")).alias("sample_id"),
        F.col("n_name").alias("organism"),
        F.concat(F.lit("Study "), (F.col("s_suppkey") % 10).cast("string")).alias("study_title"),
        F.concat(F.lit("Transcriptome of "), F.col("n_name")).alias("study_abstract"),
        F.concat(F.lit("PRJ"), _s("n_regionkey")).alias("bioproject"),
        F.concat(F.lit("SAMN"), _s("s_suppkey")).alias("biosample"),
        F.lit("RNA-Seq").alias("library_strategy"),
        F.lit("TRANSCRIPTOMIC").alias("library_source"),
        F.lit("cDNA").alias("library_selection"),
        F.when(F.col("s_suppkey") % 2 == 0, "PAIRED").otherwise("SINGLE").alias("library_layout"),
        F.when(F.col("s_suppkey") % 3 == 0, "Illumina HiSeq 2500").otherwise("Illumina NovaSeq 6000").alias("instrument"),
        (F.col("s_suppkey") * 1000).cast("int").alias("run_spots"),
        (F.col("s_suppkey") * 150000).cast("bigint").alias("run_bases"),
        F.lit(None).cast("timestamp_ntz").alias("run_published"),
    )

    tables = {
        "sra_metadata": sra_metadata,
        "sequences": sequences,
        "gene_protein_map": gene_protein_map,
        "expression": expression,
        "annotations": annotations,
        "go_terms": go_terms,
        "ec_numbers": ec_numbers,
        "kegg_info": kegg_info,
        "clusters": clusters,
        "cluster_members": cluster_members,
    }
    return Catalog(spark, {k: conform(v, SCHEMA_V2[k]) for k, v in tables.items()})


# ---------------------------------------------------------------------------
# The oracle twin (DuckDB SQL). Column order and types follow SCHEMA_V2.
# ---------------------------------------------------------------------------
def _taxon_case(vals: list[str]) -> str:
    return (
        "CASE pk % 4 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(vals[:3])) + f" ELSE '{vals[3]}' END"
    )


ORACLE_CTES: list[tuple[str, str]] = [
    ("seq_base", """
SELECT l_partkey AS pk, l_linenumber AS ln, l_partkey*10+l_linenumber AS num, min(l_suppkey) AS sk,
       CAST(sum(l_quantity) AS INT) AS length, min(l_shipdate) AS assembly_date
FROM lineitem GROUP BY l_partkey, l_linenumber"""),
    ("seq_rep", f"SELECT b.*, min(num) OVER (PARTITION BY pk % {N_CLUSTER_GROUPS}) AS rep FROM seq_base b"),
    ("sra_metadata", """
SELECT 'SRR'||CAST(s_suppkey AS VARCHAR) AS sample_id, n_name AS organism,
       'Study '||CAST(s_suppkey % 10 AS VARCHAR) AS study_title, 'Transcriptome of '||n_name AS study_abstract,
       'PRJ'||CAST(n_regionkey AS VARCHAR) AS bioproject, 'SAMN'||CAST(s_suppkey AS VARCHAR) AS biosample,
       'RNA-Seq' AS library_strategy, 'TRANSCRIPTOMIC' AS library_source, 'cDNA' AS library_selection,
       CASE WHEN s_suppkey % 2 = 0 THEN 'PAIRED' ELSE 'SINGLE' END AS library_layout,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Illumina HiSeq 2500' ELSE 'Illumina NovaSeq 6000' END AS instrument,
       CAST(s_suppkey*1000 AS INT) AS run_spots, CAST(s_suppkey*150000 AS BIGINT) AS run_bases,
       CAST(NULL AS TIMESTAMP) AS run_published
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    ("sequences", """
SELECT 'v1_DLS_'||CAST(pk AS VARCHAR)||'.p'||CAST(ln AS VARCHAR) AS seqhash_id, p_name||' '||p_type AS sequence,
       'SRR'||CAST(sk AS VARCHAR) AS sample_id, assembly_date, (num = rep) AS is_representative,
       'v1_DLS_'||CAST(CAST(floor(rep/10) AS BIGINT) AS VARCHAR)||'.p'||CAST(rep % 10 AS VARCHAR) AS repseq_id, length
FROM seq_rep JOIN part ON pk = p_partkey"""),
    ("gene_protein_map", """
SELECT split_part(seqhash_id,'.p',1) AS gene_seqhash_id, seqhash_id AS protein_seqhash_id FROM sequences"""),
    ("expression", """
SELECT 'v1_DLS_'||CAST(l_partkey AS VARCHAR) AS gene_seqhash_id, 'SRR'||CAST(l_suppkey AS VARCHAR) AS sample_id,
       max(l_extendedprice)*min(l_discount)/50 AS tpm, sum(l_quantity) AS num_reads, min(l_quantity)+0.5 AS effective_length
FROM lineitem GROUP BY l_partkey, l_suppkey"""),
    ("annotations", f"""
SELECT 'v1_DLS_'||CAST(pk AS VARCHAR)||'.p'||CAST(ln AS VARCHAR) AS seqhash_id,
       '2711.XP_'||CAST(pk AS VARCHAR) AS seed_ortholog,
       CAST(1.0/num AS DOUBLE) AS evalue, CAST(length AS DOUBLE) AS score,
       'COG'||CAST(pk % 89 AS VARCHAR)||'@1|root,KOG'||CAST(pk % 53 AS VARCHAR)||'@2759|Eukaryota,'
         ||CAST(pk % 31 AS VARCHAR)||'X@'||{_taxon_case(TAXON_IDS)}||'|'||{_taxon_case(TAXA)} AS eggnog_ogs,
       {_taxon_case(TAXON_IDS)}||'|'||{_taxon_case(TAXA)} AS max_annot_lvl,
       CASE p_type WHEN 'ECONOMY' THEN 'Q' WHEN 'SMALL' THEN 'QE' WHEN 'STANDARD' THEN 'KL' ELSE 'S' END AS cog_category,
       p_name AS description, p_brand AS preferred_name, 'SRR'||CAST(sk AS VARCHAR) AS sample_id
FROM seq_base JOIN part ON pk = p_partkey WHERE pk % {ANNOTATED_EVERY} <> 0"""),
    ("go_terms", """
SELECT DISTINCT seqhash_id, 'GO:'||w AS go_term FROM (
  SELECT seqhash_id, split_part(description,' ',1) AS w FROM annotations
  UNION ALL SELECT seqhash_id, split_part(description,' ',2) AS w FROM annotations) t"""),
    ("ec_numbers", """
SELECT DISTINCT seqhash_id, 'EC:1.'||CAST(p_size % 7 AS VARCHAR) AS ec_number
FROM annotations JOIN part ON p_brand = preferred_name AND p_name = description WHERE p_size < 10"""),
    ("clusters", """
SELECT repseq_id AS cluster_id, repseq_id AS representative_seqhash_id, CAST(count(*) AS INT) AS size
FROM sequences GROUP BY repseq_id"""),
    ("cluster_members", "SELECT seqhash_id, repseq_id AS cluster_id FROM sequences"),
    ("kegg_info", """
SELECT seqhash_id, 'ko:K'||CAST(CAST(score AS INT) % 50 AS VARCHAR) AS kegg_ko,
       CASE WHEN CAST(score AS INT) % 4 = 0 THEN '-' ELSE 'map'||CAST(CAST(score AS INT) % 9 AS VARCHAR) END AS kegg_pathway,
       '-' AS kegg_module, '-' AS kegg_reaction, '-' AS kegg_rclass, 'ko00000' AS brite, '-' AS kegg_tc,
       CASE WHEN CAST(score AS INT) % 5 = 0 THEN 'GH5' ELSE '-' END AS cazy, '-' AS bigg_reaction,
       'PF'||CAST(CAST(score AS INT) % 97 AS VARCHAR) AS pfams, sample_id
FROM annotations WHERE CAST(score AS INT) % 2 = 0"""),
]


def oracle(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` (a SELECT) with the catalogue mapping as CTEs, plus optional extra CTEs."""
    ctes = ORACLE_CTES + list(extra_ctes or [])
    return "WITH " + ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ctes) + "\n" + body.strip()


# ---------------------------------------------------------------------------
# Incoming sample batches for the ingest operators.
# Each lineitem row is one record of sample SRR<suppkey> (load order = suppkey), so an id
# (part, line number) arrives from several samples and the first writer must win.
# ---------------------------------------------------------------------------
AS_OF = "2000-01-01 00:00:00"

ANN_FIELDS = [
    "seed_ortholog", "evalue", "score", "eggNOG_OGs", "max_annot_lvl", "COG_category", "Description", "Preferred_name",
    "GOs", "EC", "KEGG_ko", "KEGG_Pathway", "KEGG_Module", "KEGG_Reaction", "KEGG_rclass", "BRITE", "KEGG_TC", "CAZy",
    "BiGG_Reaction", "PFAMs", "sample_id",
]


def incoming(spark: SparkSession, sf_dir: str, stage: bool = False) -> dict[str, DataFrame]:
    """The batches; with ``stage`` the joined records that they derive from, and the quantification, are written once."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    own = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    j = own.join(part, F.col("l_partkey") == F.col("p_partkey"))
    j = materialise(j, "records") if stage else j
    sample = F.concat(F.lit("SRR"), _s("l_suppkey"))
    rank = F.col("l_suppkey").cast("int")
    protein = F.concat(F.lit("v1_DLS_"), _s("l_partkey"), F.lit(".p"), _s("l_linenumber"))
    proteins = j.select(
        protein.alias("seqhash_id"), F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("sequence"),
        sample.alias("sample_id"), rank.alias("sample_rank"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("record_no"),
    )
    qty = F.col("l_quantity").cast("int")
    dash = F.lit("-")
    ann = j.filter(F.col("l_partkey") % ANNOTATED_EVERY != 0).select(
        protein.alias("query"),
        F.concat(F.lit("2711.XP_"), _s("l_partkey")).alias("seed_ortholog"),
        F.when(F.col("l_partkey") % 7 == 0, dash).otherwise(
            F.concat(_s("l_partkey"), F.lit("e-"), _s("l_linenumber"))).alias("evalue"),
        qty.cast("string").alias("score"),
        F.concat(F.lit("COG"), (F.col("l_partkey") % 89).cast("string"), F.lit("@1|root")).alias("eggNOG_OGs"),
        F.lit("1|root").alias("max_annot_lvl"),
        F.when(F.col("p_type") == "ECONOMY", "Q").when(F.col("p_type") == "SMALL", "QE")
        .when(F.col("p_type") == "STANDARD", "KL").otherwise("S").alias("COG_category"),
        F.col("p_name").alias("Description"),
        F.col("p_brand").alias("Preferred_name"),
        F.when(F.col("l_partkey") % 5 == 0, dash).otherwise(F.concat(
            F.lit("GO:"), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit(",GO:"),
            F.split_part("p_name", F.lit(" "), F.lit(2)))).alias("GOs"),
        F.when(F.col("p_size") < 10, F.concat(F.lit("EC:1."), (F.col("p_size") % 7).cast("string"))).otherwise(dash).alias("EC"),
        F.when(qty % 2 == 0, F.concat(F.lit("ko:K"), (qty % 50).cast("string"))).otherwise(dash).alias("KEGG_ko"),
        F.when(qty % 3 == 0, F.concat(F.lit("map"), (qty % 9).cast("string"))).otherwise(dash).alias("KEGG_Pathway"),
        *[dash.alias(c) for c in ("KEGG_Module", "KEGG_Reaction", "KEGG_rclass", "BRITE", "KEGG_TC", "CAZy", "BiGG_Reaction")],
        F.when(qty % 5 == 0, F.concat(F.lit("PF"), (qty % 97).cast("string"))).otherwise(dash).alias("PFAMs"),
        sample.alias("sample_id"), rank.alias("sample_rank"),
    )
    quant = li.groupBy("l_partkey", "l_suppkey").agg(
        (F.max("l_extendedprice") * F.min("l_discount") / 50).alias("tpm"),
        F.sum("l_quantity").alias("num_reads"),
        (F.min("l_quantity") + 0.5).alias("effective_length"),
    ).select(
        F.concat(F.lit("v1_DLS_"), _s("l_partkey")).alias("gene_seqhash_id"), sample.alias("sample_id"),
        "tpm", "num_reads", "effective_length", rank.alias("sample_rank"),
    )
    quant = materialise(quant, "quant") if stage else quant
    samples = read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("SRR"), _s("s_suppkey")).alias("sample_id"), F.col("s_suppkey").cast("int").alias("sample_rank")
    )
    return {"proteins": proteins, "annotations": ann, "quant": quant, "samples": samples}


INCOMING_CTES: list[tuple[str, str]] = [
    ("in_proteins", """
SELECT 'v1_DLS_'||CAST(l_partkey AS VARCHAR)||'.p'||CAST(l_linenumber AS VARCHAR) AS seqhash_id,
       p_name||' '||p_type AS sequence, 'SRR'||CAST(l_suppkey AS VARCHAR) AS sample_id, CAST(l_suppkey AS INT) AS sample_rank,
       l_orderkey * 8 + l_linenumber AS record_no
FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    ("in_annotations", f"""
SELECT 'v1_DLS_'||CAST(l_partkey AS VARCHAR)||'.p'||CAST(l_linenumber AS VARCHAR) AS query,
       '2711.XP_'||CAST(l_partkey AS VARCHAR) AS seed_ortholog,
       CASE WHEN l_partkey % 7 = 0 THEN '-' ELSE CAST(l_partkey AS VARCHAR)||'e-'||CAST(l_linenumber AS VARCHAR) END AS evalue,
       CAST(CAST(l_quantity AS INT) AS VARCHAR) AS score,
       'COG'||CAST(l_partkey % 89 AS VARCHAR)||'@1|root' AS eggNOG_OGs, '1|root' AS max_annot_lvl,
       CASE p_type WHEN 'ECONOMY' THEN 'Q' WHEN 'SMALL' THEN 'QE' WHEN 'STANDARD' THEN 'KL' ELSE 'S' END AS COG_category,
       p_name AS Description, p_brand AS Preferred_name,
       CASE WHEN l_partkey % 5 = 0 THEN '-' ELSE 'GO:'||split_part(p_name,' ',1)||',GO:'||split_part(p_name,' ',2) END AS GOs,
       CASE WHEN p_size < 10 THEN 'EC:1.'||CAST(p_size % 7 AS VARCHAR) ELSE '-' END AS EC,
       CASE WHEN CAST(l_quantity AS INT) % 2 = 0 THEN 'ko:K'||CAST(CAST(l_quantity AS INT) % 50 AS VARCHAR) ELSE '-' END AS KEGG_ko,
       CASE WHEN CAST(l_quantity AS INT) % 3 = 0 THEN 'map'||CAST(CAST(l_quantity AS INT) % 9 AS VARCHAR) ELSE '-' END AS KEGG_Pathway,
       '-' AS KEGG_Module, '-' AS KEGG_Reaction, '-' AS KEGG_rclass, '-' AS BRITE, '-' AS KEGG_TC, '-' AS CAZy,
       '-' AS BiGG_Reaction,
       CASE WHEN CAST(l_quantity AS INT) % 5 = 0 THEN 'PF'||CAST(CAST(l_quantity AS INT) % 97 AS VARCHAR) ELSE '-' END AS PFAMs,
       'SRR'||CAST(l_suppkey AS VARCHAR) AS sample_id, CAST(l_suppkey AS INT) AS sample_rank
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_partkey % {ANNOTATED_EVERY} <> 0"""),
    ("in_quant", """
SELECT 'v1_DLS_'||CAST(l_partkey AS VARCHAR) AS gene_seqhash_id, 'SRR'||CAST(l_suppkey AS VARCHAR) AS sample_id,
       max(l_extendedprice)*min(l_discount)/50 AS tpm, sum(l_quantity) AS num_reads, min(l_quantity)+0.5 AS effective_length,
       CAST(l_suppkey AS INT) AS sample_rank
FROM lineitem GROUP BY l_partkey, l_suppkey"""),
    ("in_samples", "SELECT 'SRR'||CAST(s_suppkey AS VARCHAR) AS sample_id, CAST(s_suppkey AS INT) AS sample_rank FROM supplier"),
    ("in_first", "SELECT seqhash_id, min(sample_rank) AS first_rank FROM in_proteins GROUP BY seqhash_id"),
    ("in_seq", f"""
SELECT seqhash_id, sequence, sample_id, TIMESTAMP '{AS_OF}' AS assembly_date, FALSE AS is_representative,
       seqhash_id AS repseq_id, CAST(length(sequence) AS INT) AS length
FROM (SELECT *, row_number() OVER (PARTITION BY seqhash_id ORDER BY sample_rank, record_no, sequence) AS rn FROM in_proteins) t
WHERE rn = 1"""),
    ("in_ann_first", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sample_rank, {", ".join(ANN_FIELDS)}) AS rn
               FROM in_annotations WHERE query IN (SELECT seqhash_id FROM in_seq)) t WHERE rn = 1"""),
]


def oracle_incoming(body: str) -> str:
    ctes = list(INCOMING_CTES)
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes) + "\n" + body.strip()


# ---------------------------------------------------------------------------
# Inputs for merge and cluster maintenance, derived from the mapped catalogue.
# ---------------------------------------------------------------------------
def _parity(col: str):
    return F.substring(F.col(col), 4, 64).cast("bigint") % 2


def split_catalog(cat: Catalog) -> tuple[Catalog, Catalog]:
    """Two source catalogues: A holds even-numbered samples, B odd ones. Both carry every
    metadata row (A with 'A:'-prefixed titles, so first-wins is visible) and every cluster;
    B uses the version-1 schema (no is_representative)."""
    even = {}
    odd = {}
    for part, keep in ((even, 0), (odd, 1)):
        seqs = cat.sequences.filter(_parity("sample_id") == keep)
        ids = seqs.select("seqhash_id")
        part["sequences"] = seqs
        for t in ("annotations", "kegg_info"):
            part[t] = cat[t].filter(_parity("sample_id") == keep)
        part["expression"] = cat.expression.filter(_parity("sample_id") == keep)
        for t in ("go_terms", "ec_numbers", "cluster_members"):
            part[t] = cat[t].join(ids, "seqhash_id", "left_semi")
        part["gene_protein_map"] = cat.gene_protein_map.join(
            ids.select(F.col("seqhash_id").alias("protein_seqhash_id")), "protein_seqhash_id", "left_semi")
        part["clusters"] = cat.clusters
    even["sra_metadata"] = cat.sra_metadata.withColumn("study_title", F.concat(F.lit("A:"), F.col("study_title")))
    odd["sra_metadata"] = cat.sra_metadata
    odd["sequences"] = odd["sequences"].drop("is_representative")
    return Catalog(cat.spark, even), Catalog(cat.spark, odd)


def cluster_edges(cat: Catalog) -> DataFrame:
    """Edge list of the current clustering plus edges naming ids absent from the catalogue."""
    s = cat.sequences
    edges = s.select(F.col("repseq_id").alias("representative"), F.col("seqhash_id").alias("member"))
    ghost_members = s.filter(F.col("seqhash_id").endswith(".p1")).select(
        F.col("seqhash_id").alias("representative"), F.concat(F.split_part("seqhash_id", F.lit(".p"), F.lit(1)), F.lit(".p9")).alias("member"))
    ghost_reps = s.filter(F.col("seqhash_id").endswith(".p2")).select(
        F.concat(F.lit("v1_MISSING_"), F.col("seqhash_id")).alias("representative"), F.col("seqhash_id").alias("member"))
    return edges.unionByName(ghost_members).unionByName(ghost_reps)


def recluster_edges(cat: Catalog, groups: int = 97) -> DataFrame:
    """A different clustering: sequences grouped by length modulo ``groups``, representative =
    smallest id of the group (aggregate of at most ``groups`` rows, broadcast)."""
    s = cat.sequences.select("seqhash_id", (F.col("length") % groups).alias("g"))
    reps = s.groupBy("g").agg(F.min("seqhash_id").alias("representative"))
    return s.join(F.broadcast(reps), "g").select("representative", F.col("seqhash_id").alias("member"))


MAINTAIN_CTES: list[tuple[str, str]] = [
    ("edges", """
SELECT repseq_id AS representative, seqhash_id AS member FROM sequences
UNION ALL SELECT seqhash_id, split_part(seqhash_id, '.p', 1)||'.p9' FROM sequences WHERE ends_with(seqhash_id, '.p1')
UNION ALL SELECT 'v1_MISSING_'||seqhash_id, seqhash_id FROM sequences WHERE ends_with(seqhash_id, '.p2')"""),
    ("edges2", """
SELECT min(seqhash_id) OVER (PARTITION BY length % 97) AS representative, seqhash_id AS member FROM sequences"""),
    ("valid_edges", """
SELECT * FROM edges WHERE representative IN (SELECT seqhash_id FROM sequences)
                      AND member IN (SELECT seqhash_id FROM sequences)"""),
]


def oracle_maintain(body: str) -> str:
    return oracle(body, MAINTAIN_CTES)


# ---------------------------------------------------------------------------
# The document corpus as a second catalogue (sequence = text, sample = source), used by
# the sequence-set operators and the search-result joins.
# ---------------------------------------------------------------------------
def document_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    sid = F.concat(F.lit("doc_"), _s("doc_id"))
    d = docs.select(sid.alias("seqhash_id"), F.col("text").alias("sequence"), F.col("source").alias("sample_id"),
                    F.col("lang"), F.sha2(F.col("text"), 256).alias("h"))
    reps = d.groupBy("h").agg(F.min("seqhash_id").alias("repseq_id"))
    seqs = d.join(reps, "h").select(
        "seqhash_id", "sequence", "sample_id", F.lit(None).cast("timestamp_ntz").alias("assembly_date"),
        (F.col("seqhash_id") == F.col("repseq_id")).alias("is_representative"), "repseq_id",
        F.length("sequence").cast("int").alias("length"),
    )
    meta = docs.groupBy(F.col("source").alias("sample_id")).agg(F.min("lang").alias("organism"))
    ann = labels.join(docs.select("doc_id", "source"), "doc_id").select(
        F.concat(F.lit("doc_"), _s("doc_id")).alias("seqhash_id"),
        F.when(F.col("quality") == 1, "high quality").otherwise("low quality").alias("description"),
        F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("preferred_name"),
        F.when(F.col("toxic") == 1, "V").otherwise("S").alias("cog_category"),
        F.col("source").alias("sample_id"),
    )
    members = seqs.select("seqhash_id", F.col("repseq_id").alias("cluster_id"))
    clusters = seqs.groupBy("repseq_id").agg(F.count(F.lit(1)).cast("int").alias("size")).select(
        F.col("repseq_id").alias("cluster_id"), F.col("repseq_id").alias("representative_seqhash_id"), "size")
    tables = {"sequences": seqs, "sra_metadata": meta, "annotations": ann, "cluster_members": members, "clusters": clusters}
    return Catalog(spark, {k: conform(v, SCHEMA_V2[k]) for k, v in tables.items()})


_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASES = ("ACGT" * 7)[:26] * 2


def nucleotides(df: DataFrame, id_col: str, both_strands: bool = False) -> DataFrame:
    """(id, text): a nucleotide sequence per text, a base for every ASCII letter. With
    ``both_strands``, odd ids are given as read from the other strand."""
    bases, paired = bytes.maketrans(_LETTERS.encode(), _BASES.encode()), bytes.maketrans(b"ACGT", b"TGCA")
    others, kind = bytes(set(range(128)) - set(_LETTERS.encode())), df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, other in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                seq = t.encode("ascii", "ignore").translate(bases, others)
                out.append((seq.translate(paired)[::-1] if other else seq).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[id_col, "text"])

    other = F.coalesce(F.col(id_col) % 2 == 1, F.lit(False)) if both_strands else F.lit(False)
    return df.select(id_col, F.coalesce("text", F.lit("")).alias("text"), other.alias("other")).mapInArrow(run, f"`{id_col}` {kind}, text string")


def nucleotides_sql(table: str, id_col: str, both_strands: bool = False) -> str:
    seq = f"regexp_replace(translate(coalesce(text, ''), '{_LETTERS}', '{_BASES}'), '[^ACGT]', '', 'g')"
    if both_strands:
        seq = f"CASE WHEN {id_col} % 2 = 1 THEN reverse(translate({seq}, 'ACGT', 'TGCA')) ELSE {seq} END"
    return f"SELECT {id_col} AS id, {seq} AS text FROM {table}"


DOC_CTES: list[tuple[str, str]] = [
    ("d_base", "SELECT 'doc_'||CAST(doc_id AS VARCHAR) AS seqhash_id, text AS sequence, source AS sample_id, lang, sha256(text) AS h FROM documents"),
    ("d_seq", """
SELECT seqhash_id, sequence, sample_id, CAST(NULL AS TIMESTAMP) AS assembly_date,
       seqhash_id = min(seqhash_id) OVER (PARTITION BY h) AS is_representative,
       min(seqhash_id) OVER (PARTITION BY h) AS repseq_id, CAST(length(sequence) AS INT) AS length FROM d_base"""),
    ("d_meta", "SELECT source AS sample_id, min(lang) AS organism FROM documents GROUP BY source"),
    ("d_ann", """
SELECT 'doc_'||CAST(l.doc_id AS VARCHAR) AS seqhash_id,
       CASE WHEN quality = 1 THEN 'high quality' ELSE 'low quality' END AS description,
       CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS preferred_name,
       CASE WHEN toxic = 1 THEN 'V' ELSE 'S' END AS cog_category, d.source AS sample_id
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""),
    ("d_members", "SELECT seqhash_id, repseq_id AS cluster_id FROM d_seq"),
]


def oracle_docs(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = DOC_CTES + list(extra or [])
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes) + "\n" + body.strip()
