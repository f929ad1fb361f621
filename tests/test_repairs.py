"""Faults found on larger or odder inputs than the fixture's."""

import os
import statistics

import pytest
from pyspark.sql import functions as F

from ortholake import fixture
from ortholake.catalog import Catalog
from ortholake.operators import ingest as ig
from ortholake.operators import maintain as mt
from ortholake.operators import seqsets as ss
from ortholake.operators.components import connected_components, star_forest
from ortholake.plans import adhoc
from ortholake.sources import files as sources

SF = "/root/testdata/sf0.001"


def test_components_of_a_long_path_and_of_random_graphs(spark):
    path = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    rows = star_forest(path).collect()
    assert len(rows) == 301 and {r["component"] for r in rows} == {0}
    e = spark.createDataFrame([(5, 3), (3, 5), (7, 7), (None, 1), (9, 8), (8, 3)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in range(10)], "id long")
    got = {r["id"]: r["component"] for r in connected_components(nodes, e).collect()}
    assert got == {**{i: i for i in range(10)}, 5: 3, 8: 3, 9: 3}
    assert connected_components(nodes, e.limit(0)).filter("id != component").count() == 0


def test_cluster_numbers_are_unique_and_members_agree(spark):
    n = 400_000
    ids = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("seqhash_id"))
    edges = ids.select(F.col("seqhash_id").alias("representative"), F.col("seqhash_id").alias("member"))
    clusters, members = mt.load_clusters(edges, ids)
    assert clusters.select("cluster_id").distinct().count() == n
    wrong = members.join(clusters.withColumnRenamed("cluster_id", "c"), F.col("seqhash_id") == F.col("representative_seqhash_id"))
    assert wrong.filter("cluster_id != c").count() == 0 and wrong.count() == n


def test_catalogue_keeps_sample_names_and_column_order(spark, scratch):
    cat = fixture.build(spark, SF)
    seqs = cat.sequences.withColumn("sample_id", F.lit("007")).select(*cat.sequences.columns)
    Catalog(spark, {"sequences": seqs}).save(os.path.join(scratch, "c"))
    back = Catalog.open(spark, os.path.join(scratch, "c")).sequences
    assert back.dtypes == seqs.dtypes and back.first()["sample_id"] == "007"


def test_fasta_records_start_at_line_starts(spark, scratch):
    with open(os.path.join(scratch, "s1.fasta"), "wb") as f:
        f.write(b">g1.p1 3'->5' exonuclease\r\nMK\r\nVL\r\n>>g2.p1 x\nAA\n>g3.p1\n")
    rows = {r["id"]: (r["description"], r["sequence"]) for r in sources.scan_fasta(spark, os.path.join(scratch, "s1.fasta")).collect()}
    assert rows == {"g1.p1": ("3'->5' exonuclease", "MKVL"), "g2.p1": ("x", "AA"), "g3.p1": ("", "")}


def test_terms_of_the_earliest_sample_stay(spark):
    cat = fixture.build(spark, SF)
    seq = cat.sequences.limit(1)
    q = seq.first()["seqhash_id"]
    ann = spark.createDataFrame([(q, 0, "-", "1.1.1.1"), (q, 1, "GO:1", "2.2.2.2"), (q, 2, "GO:1,GO:2", "-")],
                                "query string, sample_rank int, GOs string, EC string")
    one = Catalog(spark, {"sequences": seq})
    assert [r["go_term"] for r in ig.ingest_go_terms(ann, one).collect()] == ["GO:1"]
    assert [r["ec_number"] for r in ig.ingest_ec_numbers(ann, one).collect()] == ["1.1.1.1"]


def test_kmers_find_reads_and_proteins(spark):
    ref = "ACGTTGCAACGGTTACGATCGATCGGATCTTAGCATCGGATCGGCTAAGCTA"
    reads = spark.createDataFrame([(1, ref[5:45]), (2, "T" * 40), (3, ref[5:45].lower())], "doc_id long, text string")
    refs = spark.createDataFrame([(9, ref)], "item_id long, text string")
    got = {(r["doc_id"], r["shared"]) for r in ss.contaminant_pairs(reads, refs, n=31, unit="char").collect()}
    assert got == {(1, 10), (3, 10)}
    q = spark.createDataFrame([("q", "MKVLAAGIVGLCAKTWWPR")], "query string, text string")
    t = spark.createDataFrame([("a", "MKVLAAGIVGLCAKTWWPR"), ("b", "GGGGGGGGGGGG")], "target string, text string")
    hits = ss.homology_search(q, t, n=5, unit="char").collect()
    assert [(h["target"], h["pident"]) for h in hits] == [("a", 100.0)]
    assert ss.depth_normalize(reads, 100, 1, n=21, unit="char").count() == 3
    with pytest.raises(ValueError):
        ss.contaminant_pairs(reads, refs, unit="line")


def test_adhoc_statements_are_refused_without_effect(spark, scratch):
    cat = fixture.build(spark, SF)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with open(os.path.join(scratch, "secret.txt"), "w") as f:
        f.write("x\n")
    for sql in ("SET spark.sql.shuffle.partitions=3", "ADD JAR '/tmp/none.jar'", f"SELECT * FROM text.`{scratch}/secret.txt`",
                "SELECT reflect('java.lang.System', 'getenv', 'HOME') FROM sequences", "VACUUM sequences", "SHOW TABLES",
                f"SELECT * FROM sequences WHERE sample_id IN (SELECT value FROM text.`{scratch}`)"):
        with pytest.raises(adhoc.RefusedQuery):
            adhoc.guarded_sql(cat, sql)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ok = adhoc.guarded_sql(cat, "WITH s AS (SELECT replace(sample_id, 'a', 'b') AS x FROM sequences) SELECT x FROM s", max_rows=5).collect()
    assert len(ok) == 5 and all(r["truncated"] for r in ok)
    assert not adhoc.guarded_sql(cat, "SELECT count(*) AS n FROM sequences").first()["truncated"]


def test_adhoc_statements_see_the_catalogue_only(spark, scratch):
    """What counts is the plan: comments, quoting and names of common table expressions hide nothing."""
    cat = fixture.build(spark, SF)
    spark.range(3).createOrReplaceTempView("secret")
    spark.range(4).createOrReplaceGlobalTempView("shared_secret")
    spark.range(5).write.parquet(f"{scratch}/p")
    for sql in ("select * from secret /* secret as ( */", "select 'secret as (' as x, id from secret", "with t as (select 1 as secret) select * from secret, t",
                "select * from `secret`", "select * from global_temp.shared_secret", f"select * from parquet.`{scratch}/p`",
                f"with sequences as (select * from parquet.`{scratch}/p`) select * from sequences",
                f"select (select max(id) from parquet.`{scratch}/p`) as x from sequences", "select try_reflect('java.lang.Math', 'abs', -1) as x",
                "select * from sequences where exists (select 1 from secret)", "select * from nowhere", "describe sequences", "explain select 1"):
        with pytest.raises(adhoc.RefusedQuery):
            adhoc.guarded_sql(cat, sql)
    n = cat.sequences.count()
    for sql, rows in (("select count(*) as n from `Sequences`", [n]), ("with secret as (select count(*) as n from sequences) select n from secret", [n]),
                      ("select /* from secret */ id from range(3) order by id desc", [2, 1, 0]), ("select col1 from values (7), (8) order by 1", [7, 8]),
                      ("select count(*) as n from sequences s where exists (select 1 from sequences t where t.seqhash_id = s.seqhash_id)", [n]),
                      ("with recursive r as (select 1 as i union all select i + 1 from r where i < 3) select i from r order by i", [1, 2, 3])):
        assert [r[0] for r in adhoc.guarded_sql(cat, sql).collect()] == rows
    assert spark.table("secret").count() == 3
    rows = adhoc.guarded_sql(cat, "select uuid() as x, id from range(20) order by id", max_rows=6).collect()
    assert [r["id"] for r in rows] == list(range(6)) and all(r["truncated"] for r in rows)


def test_median_with_an_outlier(spark):
    """One huge value does not put all others into one bucket, and the median stays exact."""
    from ortholake.plans.common import exact_median

    values = [float(i % 1000) / 7 for i in range(20_001)] + [1e15]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert exact_median(df, "x").first()[0] == pytest.approx(statistics.median(values), abs=0)
    assert exact_median(df.filter("x is null"), "x").first()[0] is None
    assert exact_median(spark.createDataFrame([(2.0,), (5.0,)], "x double"), "x").first()[0] == 3.5
