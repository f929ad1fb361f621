"""Properties from the survey's test plan, on random inputs: cluster sizes add up to the valid
edge rows, members take the smallest representative, updates and merges are idempotent."""

import random

from ortholake.catalog import SCHEMA_V2, Catalog
from ortholake.operators import maintain as mt


def _catalog(spark, ids):
    seqs = spark.createDataFrame(
        [(i, "MK", "S1", None, False, i, 2) for i in ids],
        "seqhash_id string, sequence string, sample_id string, assembly_date timestamp_ntz, is_representative boolean, "
        "repseq_id string, length int")
    return Catalog(spark, {"sequences": seqs, "clusters": spark.createDataFrame([], SCHEMA_V2["clusters"]),
                           "cluster_members": spark.createDataFrame([], SCHEMA_V2["cluster_members"])})


def test_cluster_update_properties(spark):
    for seed in (1, 2, 3):
        rnd = random.Random(seed)
        ids = [f"s{i:03d}" for i in range(120)]
        universe = ids + [f"ghost{i}" for i in range(15)]
        edges = [(rnd.choice(universe), rnd.choice(universe)) for _ in range(300)]
        cat = _catalog(spark, ids)
        e = spark.createDataFrame(edges, "representative string, member string")
        up = mt.update_clusters(cat, e)
        valid = [(r, m) for r, m in edges if r in ids and m in ids]
        assert sum(r["size"] for r in up.clusters.collect()) == len(valid)
        reps = {}
        for r, m in valid:
            reps[m] = min(reps.get(m, r), r)
        got = {r["seqhash_id"]: r for r in up.sequences.collect()}
        for m, r in reps.items():
            assert got[m]["repseq_id"] == r and got[m]["is_representative"] == (m == r)
        assert {r["seqhash_id"] for r in up.cluster_members.collect()} == set(reps)
        # applying the same edges again changes nothing
        cat2 = cat.with_tables(sequences=up.sequences, clusters=up.clusters, cluster_members=up.cluster_members)
        again = mt.update_clusters(cat2, e, mode="ignore")
        assert again.clusters.count() == up.clusters.count()
        assert again.cluster_members.count() == up.cluster_members.count()
        assert sorted(map(tuple, again.sequences.collect())) == sorted(map(tuple, up.sequences.collect()))


def test_merge_is_idempotent_and_order_decides(spark):
    a = _catalog(spark, ["x", "y"])
    b = Catalog(spark, {"sequences": a.sequences.withColumn("sample_id", a.sequences["sample_id"].substr(1, 1))})
    ab = mt.merge_catalogs([a, b])
    assert sorted(map(tuple, mt.merge_catalogs([ab, ab]).sequences.collect())) == sorted(map(tuple, ab.sequences.collect()))
    assert {r["sample_id"] for r in ab.sequences.collect()} == {"S1"}
    assert {r["sample_id"] for r in mt.merge_catalogs([b, a]).sequences.collect()} == {"S"}
