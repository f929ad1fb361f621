"""Bucketed table sets: joins without exchanges, the same rows, skewed tables left to exchanges."""

import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ortholake import fixture
from ortholake.catalog import Catalog
from ortholake.plans import named as q
from ortholake.sinks import bucketed as bk

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sets(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucketed"))
    fixture.build(spark, SF).save(f"{root}/plain")
    plain = Catalog.open(spark, f"{root}/plain")
    bk.write_bucketed(plain, f"{root}/set", 8)
    yield plain, bk.open_bucketed(spark, f"{root}/set", "own"), f"{root}/set"


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for tables of any size
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|RoundRobin)", plan(df)))


def rows(df):
    return sorted(map(str, df.collect()))


def test_sequence_joins_need_no_exchange(sets, no_broadcast):
    plain, own, _ = sets

    def joined(c):
        out = c.sequences
        for t in ("annotations", "cluster_members", "kegg_info", "go_terms", "ec_numbers"):
            out = out.join(c[t].drop("sample_id"), "seqhash_id", "left")
        return out

    assert shuffles(joined(plain)) == 6 and shuffles(joined(own)) == 0
    assert rows(joined(plain)) == rows(joined(own))


def test_gene_join_and_aggregate_need_no_exchange(sets, no_broadcast):
    plain, own, _ = sets
    per_gene = lambda c: c.gene_protein_map.join(c.expression, "gene_seqhash_id").groupBy("gene_seqhash_id").agg(F.max("tpm"))
    assert shuffles(per_gene(plain)) == 2 and shuffles(per_gene(own)) == 0
    assert rows(per_gene(plain)) == rows(per_gene(own))


@pytest.mark.parametrize("name", ["database_summary", "organism_summary", "sample_stats", "annotation_with_expression",
                                  "top_expressed_sequences", "go_term_summary", "ec_number_summary", "search_sequences"])
def test_named_queries_shuffle_less(sets, no_broadcast, name):
    plain, own, _ = sets
    run = getattr(q, name)
    assert shuffles(run(own)) < shuffles(run(plain))
    assert rows(run(own)) == rows(run(plain))


def test_profiles_shuffle_less(sets, no_broadcast):
    plain, own, _ = sets
    run = lambda c: q.sequence_annotations(c, c.sequences.select("seqhash_id"))
    assert shuffles(run(own)) * 3 < shuffles(run(plain))
    assert rows(run(own)) == rows(run(plain))


def test_one_file_per_bucket_sorted_by_sample(sets):
    _, own, root = sets
    files = [f for f in os.listdir(f"{root}/sequences") if f.endswith(".parquet")]
    assert len(files) == 8
    for f in files:
        samples = pq.read_table(f"{root}/sequences/{f}", columns=["sample_id"]).column(0).to_pylist()
        assert samples == sorted(samples)
    filtered = plan(own.sequences.filter(F.col("sample_id") == "SRR1"))
    assert "EqualTo(sample_id,SRR1)" in filtered.split("PushedFilters:")[1]


def test_types_and_order_stay(sets):
    plain, own, _ = sets
    assert own.names == plain.names
    for t in plain.names:
        assert [(f.name, f.dataType) for f in own[t].schema] == [(f.name, f.dataType) for f in plain[t].schema]


def test_hot_key_is_left_to_exchanges(spark, scratch):
    hot = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("gene_seqhash_id"),
                                   F.col("id").cast("string").alias("sample_id"), F.lit(1.0).alias("tpm"))
    cat = Catalog(spark, {"expression": hot})
    kept = bk.write_bucketed(cat, f"{scratch}/a", 8, slack=100)
    assert kept["tables"]["expression"]["key"] is None
    back = bk.open_bucketed(spark, f"{scratch}/a")
    assert rows(back.expression) == rows(hot) and "Bucketed: true" not in plan(back.expression.groupBy("gene_seqhash_id").count())
    even = Catalog(spark, {"expression": hot.filter("gene_seqhash_id <> 'hot'")})
    assert bk.write_bucketed(even, f"{scratch}/b", 8, slack=100)["tables"]["expression"]["key"] == "gene_seqhash_id"


def test_null_keys_empty_tables_and_odd_names(spark, scratch):
    maps = spark.createDataFrame([(None, "p"), ("g", None), ("g", None)], "gene_seqhash_id string, protein_seqhash_id string")
    none = spark.createDataFrame([], "seqhash_id string, go_term string")
    path = f"{scratch}/o'dd set"
    bk.write_bucketed(Catalog(spark, {"gene_protein_map": maps, "go_terms": none}), path, 4)
    back = bk.open_bucketed(spark, path, "odd")
    assert rows(back.gene_protein_map) == rows(maps)
    assert back.go_terms.count() == 0 and back.go_terms.columns == none.columns
    bk.close_bucketed(back, "odd")
    assert not spark.catalog.tableExists("odd_gene_protein_map")
    assert bk.open_bucketed(spark, path, "odd").gene_protein_map.count() == 3       # files stay, declared again


def test_sets_are_written_once_and_whole(spark, sets, scratch):
    plain, _, root = sets
    with pytest.raises(FileExistsError):
        bk.write_bucketed(plain, root, 8)
    with pytest.raises(ValueError):
        bk.write_bucketed(plain, f"{scratch}/none", 0)
    plain.save(f"{scratch}/unfinished")
    with pytest.raises(Exception, match="LAYOUT.json"):
        bk.open_bucketed(spark, f"{scratch}/unfinished")
