"""What a query reads and writes as its input grows: aggregates taken once, files that do not follow the number
of samples, k-mers found where the texts lie."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ortholake import fixture, registry_io as rio
from ortholake.functions.columns import flat_text
from ortholake.operators import kmers
from ortholake.operators import seqsets as ss
from ortholake.plans import analytics as an
from ortholake.registry import QUERIES

SAMPLES = 40


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small set of the tables that the catalogue is mapped from."""
    d, draw = str(tmp_path_factory.mktemp("tables")), random.Random(5)
    spark.createDataFrame([(i, f"N{i}", i % 2) for i in range(4)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{d}/nation.parquet")
    spark.createDataFrame([(i, i % 4) for i in range(SAMPLES)], "s_suppkey long, s_nationkey long").write.parquet(f"{d}/supplier.parquet")
    parts = [(i, f"{draw.choice(['red', 'hot'])} {draw.choice(['ring', 'bolt'])}", f"B{i % 3}", draw.choice(["ECONOMY", "SMALL", "LARGE"]), i % 14) for i in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    rows = [(i, draw.randrange(60), draw.randrange(SAMPLES), draw.randrange(1, 4), float(draw.randrange(1, 50)), draw.random() * 1000, draw.randrange(11) / 100) for i in range(1500)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double")
    li.withColumn("l_shipdate", F.lit("2001-01-01").cast("timestamp_ntz")).write.parquet(f"{d}/lineitem.parquet")
    return d


def _from_tables(df):
    return sorted(f for f in df.inputFiles() if "/lineitem.parquet/" in f)


@pytest.mark.parametrize("name", ["merge_summary", "merge_strict_summary", "build_catalog", "update_catalog", "update_report"])
def test_aggregates_are_taken_once(spark, tables, name):
    assert _from_tables(QUERIES[name](spark, tables)) == []


@pytest.mark.parametrize("name", ["qc_report", "qc_report_full"])
def test_reports_read_the_aggregates(spark, tables, name):
    got = QUERIES[name](spark, tables)
    assert any("seq_part" in f for f in got.inputFiles()) and got.count() == SAMPLES


@pytest.mark.parametrize("name,sink", [("write_table_set", (rio.wr, "write_table_set")), ("bucketed_tables", (rio.bucketed, "write_bucketed"))])
def test_sinks_are_given_staged_tables(spark, tables, monkeypatch, name, sink):
    given, write = [], getattr(*sink)
    monkeypatch.setattr(*sink, lambda cat, *a: (given.append(cat), write(cat, *a))[1])
    assert QUERIES[name](spark, tables).count() > 0
    assert given and all(_from_tables(df) == [] for c in given for df in (c.annotations, c.expression))


@pytest.mark.parametrize("name,folder", [("scan_expression", "quant"), ("write_qc_stats", "qc")])
def test_files_do_not_follow_the_samples(spark, tables, monkeypatch, tmp_path, name, folder):
    monkeypatch.setattr(rio, "scratch_path", lambda s, n: str(tmp_path / n))
    got = QUERIES[name](spark, tables)
    samples = got.select("sample_id").distinct().count()
    files = [f for _, _, fs in os.walk(tmp_path / folder) for f in fs if f.startswith("part-")]
    assert 0 < len(files) < samples


def test_expression_is_joined_last(spark, tables):
    cat = fixture.staged(spark, tables, ("seq_part",))
    cat = cat.with_tables(gene_protein_map=cat.gene_protein_map.unionByName(cat.gene_protein_map.limit(3)))
    got = an.top_expressed_transcripts(cat)
    x, g, s, a = cat.expression, cat.gene_protein_map, cat.sequences, cat.annotations
    want = x.join(g, "gene_seqhash_id").withColumnRenamed("protein_seqhash_id", "seqhash_id").join(s.select("seqhash_id", "length"), "seqhash_id").join(
        a.select("seqhash_id", "cog_category", "description"), "seqhash_id", "left").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan()
    top = next(l for l in plan.toString().splitlines() if "Join" in l)
    assert "gene_seqhash_id" in top


def test_kmers_of_whole_characters(spark):
    """Code points count, also those beyond the first plane; nulls, short texts and white space have their say."""
    wide = "".join(chr(0x1D400 + i) for i in range(5))
    texts = [(1, f"xx{wide}yy abc"), (2, wide.upper()), (3, None), (4, "ab"), (5, "ABCDE" * 4), (6, "a b c d e")]
    refs = [(10, wide), (11, "abcde"), (12, None), (13, "abc")]
    reads, items = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(refs, "item_id long, text string")

    def own(t):
        t = "".join((t or "").split()).upper()
        return {t[i:i + 4] for i in range(len(t) - 3)}

    want = sorted((i, j, len(own(t) & own(r))) for i, t in texts for j, r in refs if own(t) & own(r))
    got = ss.contaminant_pairs(reads, items, n=4, unit="char")
    assert sorted(map(tuple, got.collect())) == want
    found = ss.homology_search(items.withColumnRenamed("item_id", "query"), reads.withColumnRenamed("doc_id", "target"), n=4, unit="char").collect()
    assert sorted((r["target"], r["query"], r["shared_kmers"]) for r in found) == want
    for r in found:
        q, t = own(dict(refs)[r["query"]]), own(dict(texts)[r["target"]])
        assert r["jaccard"] == pytest.approx(len(q & t) / len(q | t)) and r["pident"] == pytest.approx(100 * len(q & t) / len(q))


def test_only_kmers_of_the_references_leave_the_texts(spark):
    draw = random.Random(3)
    reads = spark.createDataFrame([(i, "".join(draw.choices("ACGT", k=400))) for i in range(30)], "doc_id long, text string")
    refs = kmers.reference_kmers(reads.filter("doc_id = 7").selectExpr("doc_id as item_id", "substr(text, 11, 40) as text"), "item_id", "text", 31)
    rows = kmers.kmers_in(reads, "doc_id", "text", 31, refs)
    assert rows.count() < 40 and rows.filter("doc_id = 7").count() >= 10
    assert reads.select(flat_text("text")).count() == 30


@pytest.mark.parametrize("k", [1, 2, 7, 31])
def test_hashes_tell_kmers_apart(k):
    draw = random.Random(k)
    text = "".join(draw.choices("ACGT", k=2000))
    own = kmers.hashes(kmers.code_points(text), k)
    assert len(own) == len(text) - k + 1
    assert len(np.unique(own)) == len({text[i:i + k] for i in range(len(own))})
    assert len(kmers.hashes(kmers.code_points("A" * (k - 1)), k)) == 0
