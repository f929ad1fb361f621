"""Incremental ingest on Structured Streaming: whole batches or none, equal to batch ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ortholake.operators import ingest as ig
from ortholake.sinks.manifest import VersionedTables
from ortholake.sources import files as src
from ortholake.streaming import read_catalog, read_ledger, stream_cluster_update, stream_ingest

FIELDS = src.ANNOTATION_COLUMNS


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """A handful of rows per table: one task a stage."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def drop(folder, sample, proteins, annotations=(), quant=()):
    """The files of a sample; the proteins last, as they start the ingest."""
    os.makedirs(folder, exist_ok=True)
    if annotations:
        with open(f"{folder}/{sample}.emapper.annotations", "w") as f:
            f.write("## comment\n" + "".join("\t".join(a.get(c, "-") for c in FIELDS) + "\n" for a in annotations))
    if quant:
        with open(f"{folder}/{sample}.json", "w") as f:
            json.dump([{"Name": g, "Length": 9, "EffectiveLength": 5.5, "TPM": t, "NumReads": 3.0, "sample": sample} for g, t in quant], f)
    with open(f"{folder}/.{sample}.pep", "w") as f:
        f.write("".join(f">{i} d\n{s}\n" for i, s in proteins))
    os.rename(f"{folder}/.{sample}.pep", f"{folder}/{sample}.pep")


SAMPLES = {
    "S1": ([("g1.p1", "MKV"), ("g1.p2", "MKVL"), ("g1.p1", "A first?")],
           [{"query": "g1.p1", "evalue": "1e-5", "score": "7", "GOs": "GO:1,GO:2", "EC": "1.1", "KEGG_ko": "ko:K1", "COG_category": "Q"}], [("g1", 5.0), ("gx", 1.0)]),
    "S2": ([("g1.p1", "MKV"), ("g2.p1", "MA"), ("g3.p1", "MAA")],
           [{"query": "g2.p1", "GOs": "-", "EC": "2.2,2.3"}, {"query": "g1.p1", "GOs": "GO:9", "KEGG_ko": "ko:K2"}, {"query": "none.p1", "EC": "9"}], [("g2", 2.0), ("g1", 9.0)]),
    "S3": ([("g4.p1", "MQ")], [], [("g9", 1.0)]),
}


def tables(spark, root):
    cat = read_catalog(spark, root)
    return {t: sorted(map(repr, cat[t].collect())) for t in cat.names}


def batchwise(spark, folder):
    """The same samples through the batch ingest, one after another."""
    cat = ig._empty_catalog(spark)
    for s, (_, ann, quant) in SAMPLES.items():
        prot = src.scan_fasta(spark, f"{folder}/{s}.pep", numbered=True)
        bundle = ig.SampleBundle(ig.sample_order(spark, [s]), prot, src.scan_annotations(spark, f"{folder}/{s}.emapper.annotations") if ann else None,
                                 src.scan_expression(spark, f"{folder}/{s}.json") if quant else None)
        cat, _ = ig.ingest_bundle(spark, bundle, cat)
    return {t: sorted(map(repr, cat[t].collect())) for t in cat.names}


def run(spark, scratch, root="catalog", **kw):
    stream_ingest(spark, f"{scratch}/drop", f"{scratch}/{root}", f"{scratch}/ck-{root}", **kw).awaitTermination()


def test_stream_equals_batch_ingest(spark, scratch):
    for s, files in SAMPLES.items():
        drop(f"{scratch}/drop", s, *files)
        run(spark, scratch)
    got = tables(spark, f"{scratch}/catalog")
    assert got == batchwise(spark, f"{scratch}/drop")
    assert all(got[t] for t in ("sequences", "gene_protein_map", "expression", "annotations", "go_terms", "ec_numbers", "kegg_info", "sra_metadata"))
    assert any("sequence='MKV'" in r for r in got["sequences"])                # the first of two records of one id
    ledger = {r["sample_id"]: tuple(r)[2:] for r in read_ledger(spark, f"{scratch}/catalog").collect()}
    assert ledger == {"S1": ("success", 3, 1, 0, None), "S2": ("success", 2, 1, 1, None), "S3": ("success", 1, 0, 0, None)}
    drop(f"{scratch}/drop/late", "S1", [("g8.p1", "MM")])
    stream_ingest(spark, f"{scratch}/drop/late", f"{scratch}/catalog", f"{scratch}/ck-late").awaitTermination()
    assert tables(spark, f"{scratch}/catalog") == got                          # a sample that is there already
    assert read_ledger(spark, f"{scratch}/catalog").filter("status = 'error'").count() == 1


def test_lost_writer_leaves_no_half_batch(spark, scratch, monkeypatch):
    drop(f"{scratch}/drop", "S1", *SAMPLES["S1"])
    run(spark, scratch)
    before = tables(spark, f"{scratch}/catalog")
    drop(f"{scratch}/drop", "S2", *SAMPLES["S2"])
    calls, write = [], VersionedTables.write_files

    def failing(self, table, rows):
        calls.append(table)
        if len(calls) == 5:
            raise RuntimeError("lost between two writes")
        return write(self, table, rows)

    with monkeypatch.context() as m:
        m.setattr(VersionedTables, "write_files", failing)
        with pytest.raises(Exception, match="lost between two writes"):
            run(spark, scratch)
    assert tables(spark, f"{scratch}/catalog") == before
    run(spark, scratch)
    after = tables(spark, f"{scratch}/catalog")
    assert len(after["sequences"]) == len(before["sequences"]) + 2 and len(after["ec_numbers"]) == len(before["ec_numbers"]) + 2
    assert read_ledger(spark, f"{scratch}/catalog").count() == 2


def test_edges_rewrite_only_touched_files(spark, scratch, monkeypatch):
    for s in ("S1", "S2"):
        drop(f"{scratch}/drop", s, *SAMPLES[s])
        run(spark, scratch)
    root = f"{scratch}/catalog"
    store = VersionedTables(spark, root)
    before = set(store.files("sequences"))
    os.makedirs(f"{scratch}/edges")
    with open(f"{scratch}/edges/e1.tsv", "w") as f:
        f.write("g1.p1\tg1.p1\ng1.p1\tg1.p2\ng1.p1\tmissing\n")
    stream_cluster_update(spark, f"{scratch}/edges", root, f"{scratch}/eck").awaitTermination()
    cat = read_catalog(spark, root)
    assert {r["seqhash_id"]: (r["repseq_id"], r["is_representative"]) for r in cat.sequences.collect()} == {
        "g1.p1": ("g1.p1", True), "g1.p2": ("g1.p1", False), "g2.p1": ("g2.p1", False), "g3.p1": ("g3.p1", False)}
    kept = before & set(store.files("sequences"))
    assert kept and {r["seqhash_id"] for r in spark.read.parquet(*[f"{root}/{n}" for n in kept]).collect()} == {"g2.p1", "g3.p1"}
    with open(f"{scratch}/edges/e2.tsv", "w") as f:
        f.write("g1.p1\tg2.p1\ng2.p1\tg2.p1\n")
    with monkeypatch.context() as m:
        m.setattr(VersionedTables, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            stream_cluster_update(spark, f"{scratch}/edges", root, f"{scratch}/eck").awaitTermination()
    assert read_catalog(spark, root).cluster_members.count() == 2
    stream_cluster_update(spark, f"{scratch}/edges", root, f"{scratch}/eck").awaitTermination()
    cat = read_catalog(spark, root)
    assert {r["cluster_id"]: r["size"] for r in cat.clusters.collect()} == {"g1.p1": 2, "g2.p1": 1}
    assert cat.cluster_members.count() == 4
    assert cat.sequences.filter("seqhash_id = 'g2.p1'").first()["repseq_id"] == "g1.p1"


def test_new_sequences_join_the_kept_clustering(spark, scratch):
    a, b = "MKVLAAGIVGSTHEWRLPQNDFYC" * 3, "GHTTPLMNVQWERYDSACFIKLMNPQ" * 3
    drop(f"{scratch}/drop", "S1", [("g1.p1", a), ("g2.p1", b + "W"), ("g3.p1", a + "K")])
    kw = dict(cluster_root=f"{scratch}/clusters", n=4, percent=80)
    run(spark, scratch, **kw)
    cat = read_catalog(spark, f"{scratch}/catalog")
    first = {r["seqhash_id"]: r["repseq_id"] for r in cat.sequences.collect()}
    assert first == {"g1.p1": "g3.p1", "g2.p1": "g2.p1", "g3.p1": "g3.p1"}
    drop(f"{scratch}/drop", "S2", [("g4.p1", b), ("g5.p1", "PLKMNJIUHBVGYTFCXDRESZAQW" * 2)])
    run(spark, scratch, **kw)
    cat = read_catalog(spark, f"{scratch}/catalog")
    assert {r["seqhash_id"]: r["repseq_id"] for r in cat.sequences.collect()} == first | {"g4.p1": "g2.p1", "g5.p1": "g5.p1"}
    assert {r["cluster_id"]: r["size"] for r in cat.clusters.collect()} == {"g3.p1": 2, "g2.p1": 2, "g5.p1": 1}
    assert cat.sequences.filter(F.col("is_representative")).count() == 3


def test_records_keep_their_order_over_splits(spark, scratch):
    """One file read in many splits: the first of two records of an id is the one in front."""
    os.makedirs(f"{scratch}/p")
    rows = [(f"g{i % 700}.p1", "MK" + "A" * (i % 13) + "QWERTY"[i % 6] * (i // 700 + 1)) for i in range(2100)]
    with open(f"{scratch}/p/S1.pep", "w") as f:
        f.write("".join(f">{i}\n{s}\n" for i, s in rows))
    first = {}
    for i, s in rows:
        first.setdefault(i, s)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        recs = src.scan_fasta(spark, f"{scratch}/p/S1.pep", numbered=True)
        assert recs.rdd.getNumPartitions() > 5
        assert [r["id"] for r in recs.orderBy("record_no").collect()] == [i for i, _ in rows]
        got = ig.ingest_sequences(recs.select(F.col("id").alias("seqhash_id"), "sequence", "sample_id", F.lit(0).alias("sample_rank"), "record_no")).accepted
        assert {r["seqhash_id"]: r["sequence"] for r in got.collect()} == first
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
