"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The catalogue is first built from the driver's tables (the fixture mapping) and written as
a Parquet table set, as the studied system builds its database once and then queries it.
Build time is reported separately; the metric is the sum of the warm query times over the
written catalogue. Each query runs twice and the faster run counts; results are consumed
with the no-op sink so every row is computed but nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ortholake import fixture  # noqa: E402
from ortholake.catalog import Catalog  # noqa: E402
from ortholake.operators import ingest as ig  # noqa: E402
from ortholake.operators import qc as qcm  # noqa: E402
from ortholake.operators import seqsets as ss  # noqa: E402
from ortholake.plans import analytics as an  # noqa: E402
from ortholake.plans import named as q  # noqa: E402
from ortholake.session import local_session  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        consume(fn())
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="ortholake-bench")
    # Write the catalogue under the shared checkpoint folder the session names, if any.
    ck = spark.conf.get("spark.checkpoint.dir", None)
    scratch = os.path.join(ck, f"ortholake-bench-{uuid.uuid4().hex}") if ck else tempfile.mkdtemp(prefix="ortholake-bench-")

    t0 = time.perf_counter()
    fixture.build(spark, sf_dir, stage_dir=os.path.join(scratch, "stage")).save(os.path.join(scratch, "catalog"), mode="overwrite")
    build_s = round(time.perf_counter() - t0, 3)
    cat = Catalog.open(spark, os.path.join(scratch, "catalog"))
    raw = fixture.build(spark, sf_dir)
    docs = fixture.read_table(spark, sf_dir, "documents")
    bench = fixture.read_table(spark, sf_dir, "benchmark")

    headline = {
        "database_summary": lambda: q.database_summary(cat),
        "organism_summary": lambda: q.organism_summary(cat),
        "sample_stats": lambda: q.sample_stats(cat),
        "annotation_with_expression": lambda: q.annotation_with_expression(cat),
        "top_expressed_sequences": lambda: q.top_expressed_sequences(cat),
        "go_term_summary": lambda: q.go_term_summary(cat),
        "expression_distribution": lambda: q.expression_distribution(cat),
        "expression_summary": lambda: q.expression_summary(cat),
        "sequence_annotations": lambda: q.sequence_annotations(cat),
        "search_sequences": lambda: q.search_sequences(cat, min_length=20, max_length=180, cog_categories=["Q", "K"]),
        "cog_letters_by_organism": lambda: an.cog_letters_by_organism(cat),
        "go_counts_by_organism": lambda: an.go_counts_by_organism(cat),
        "qc_report": lambda: qcm.qc_report(cat),
        "database_summary_from_tables": lambda: q.database_summary(raw),
        "ingest_sequences": lambda: ig.ingest_sequences(fixture.incoming(spark, sf_dir)["proteins"]).accepted,
        "contaminant_pairs": lambda: ss.contaminant_pairs(docs, bench),
        "homology_search": lambda: ss.homology_search(bench.withColumnRenamed("item_id", "query"),
                                                      docs.withColumnRenamed("doc_id", "target")),
    }
    times = {name: timed(fn) for name, fn in headline.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_query_seconds_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "catalog_build_sec": build_s,
        "sf": sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
