"""Physical-plan shape of key queries over a written catalogue: filters reach the Parquet
scan, unused columns are pruned, top-k reports never sort the whole input, and only the
fixed-size COG dimension is broadcast by hint."""

import os

import pytest

from ortholake import fixture
from ortholake.catalog import Catalog
from ortholake.plans import analytics as an
from ortholake.plans import named as q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cat(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # full PushedFilters / ReadSchema text
    root = str(tmp_path_factory.mktemp("plans"))
    fixture.build(spark, SF).save(os.path.join(root, "c"))
    return Catalog.open(spark, os.path.join(root, "c"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sample_filter_is_pushed_to_scan(cat):
    p = plan(q.search_sequences(cat, sample_ids=["SRR1"], min_length=10))
    seq_scan = [line for line in p.split("\n") if "FileScan parquet" in line and "/sequences" in line][0]
    pushed = seq_scan.split("PushedFilters:")[1]
    assert "EqualTo(sample_id,SRR1)" in pushed and "GreaterThanOrEqual(length,10)" in pushed


def test_summary_prunes_sequence_text(cat):
    p = plan(q.database_summary(cat))
    scans = [line for line in p.split("\n") if "FileScan parquet" in line and "/sequences" in line]
    assert scans and all("sequence:" not in s.split("ReadSchema:")[1] for s in scans)


def test_top_k_is_take_ordered(cat):
    for df in (q.top_expressed_sequences(cat), q.annotation_with_expression(cat)):
        assert "TakeOrderedAndProject" in plan(df)


def test_cog_dimension_broadcast(cat):
    assert "BroadcastHashJoin" in plan(an.cog_letters_by_organism(cat))


def test_point_lookup_pushes_gene_filter(cat):
    p = plan(q.sequence_expression(cat, "v1_DLS_1"))
    assert "EqualTo(gene_seqhash_id,v1_DLS_1)" in p
