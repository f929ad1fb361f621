"""Table sets bucketed by their join keys (K1), so that the catalogue's joins need no exchange.

Every table with a sequence or gene key is written as external Parquet data with ``buckets`` files,
one for each hash class of its key. Tables with the same key and number of buckets meet file by file.
Inside a file rows are sorted by sample first, so row-group statistics still skip by sample.

All rows of one key lie in one bucket, and a join of buckets cannot be split at run time. So the
rows of every bucket are counted first: a table whose fullest bucket holds more than ``MAX_FILL``
times its even share (and more than ``SLACK`` rows beyond it) is written without buckets, in the layout of ``Catalog.save``;
its joins go through an exchange, where adaptive execution splits a hot key.

Buckets live in the session's catalogue, not in the files. ``LAYOUT.json`` keeps key, bucket count
and schema, and :func:`open_bucketed` declares the tables anew in any session. A set without that file
was not finished and is not opened. An empty table is bucketed like any other; a null key falls into one bucket.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ortholake.catalog import Catalog
from ortholake.sinks.files import exists, read_text, replace_text

LAYOUT = "LAYOUT.json"
BUCKET_KEYS = {
    "sequences": "seqhash_id", "annotations": "seqhash_id", "go_terms": "seqhash_id", "ec_numbers": "seqhash_id",
    "kegg_info": "seqhash_id", "cluster_members": "seqhash_id", "expression": "gene_seqhash_id",
    "gene_protein_map": "gene_seqhash_id",
}
MAX_FILL = 4.0
SLACK = 100_000


def fullest_bucket(df: DataFrame, key: str, buckets: int) -> tuple[int, int]:
    """(rows of the fullest bucket, all rows): the key column is read, one row per bucket is kept."""
    counts = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).count()
    most, total = counts.agg(F.max("count"), F.sum("count")).first()
    return most or 0, total or 0


def write_bucketed(cat: Catalog, root: str, buckets: int, max_fill: float = MAX_FILL, slack: int = SLACK) -> dict:
    """Write every table under ``root`` (a new folder); the layout that was written."""
    if buckets < 1:
        raise ValueError("a table set needs at least one bucket")
    root = root.rstrip("/")
    if exists(cat.spark, f"{root}/{LAYOUT}"):
        raise FileExistsError(f"{root} holds a table set")
    layout: dict = {"buckets": buckets, "tables": {}}
    plain = {}
    for name in cat.names:
        df, key = cat[name], BUCKET_KEYS.get(name)
        if key in df.columns:
            most, total = fullest_bucket(df, key, buckets)
            if most > max(max_fill * total / buckets, total / buckets + slack):
                key = None
        else:
            key = None
        if key is None:
            plain[name] = df
        else:
            _write(df, f"{root}/{name}", key, buckets)
        layout["tables"][name] = {"key": key, "schema": json.loads(df.schema.json())}
    Catalog(cat.spark, plain).save(root)
    replace_text(cat.spark, f"{root}/{LAYOUT}", json.dumps(layout))
    return layout


def _write(df: DataFrame, path: str, key: str, buckets: int) -> None:
    name = f"writing_{uuid.uuid4().hex}"
    order = [c for c in ("sample_id", key) if c in df.columns]
    (df.repartition(buckets, key).write.format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(*order).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")       # external: the files stay


def open_bucketed(spark: SparkSession, root: str, prefix: str | None = None) -> Catalog:
    """The table set under ``root``. Its bucketed tables are declared in the session's current
    database under ``prefix`` (a name of its own by default)."""
    root = root.rstrip("/")
    layout = json.loads(read_text(spark, f"{root}/{LAYOUT}"))
    prefix = prefix or f"t{uuid.uuid4().hex}"
    tables = {}
    for name, t in layout["tables"].items():
        schema = T.StructType.fromJson(t["schema"])
        if t["key"] is None:
            tables[name] = spark.read.schema(schema).parquet(f"{root}/{name}")
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE `{prefix}_{name}` ({columns}) USING parquet CLUSTERED BY (`{t['key']}`) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION {_quoted(f'{root}/{name}')}")
        tables[name] = spark.table(f"`{prefix}_{name}`")
    return Catalog(spark, tables)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def close_bucketed(cat: Catalog, prefix: str) -> None:
    """Forget the declarations of :func:`open_bucketed`; the files stay."""
    for name in cat.names:
        cat.spark.sql(f"DROP TABLE IF EXISTS `{prefix}_{name}`")
