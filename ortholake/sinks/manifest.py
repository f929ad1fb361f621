"""Table sets whose versions change in one step, file by file.

``root/MANIFEST.json`` names, for each table, the data files that make up its current state, and the
tags of the commits so far. A commit first writes new files under ``root/data`` with names
of their own and then replaces the manifest by one rename. So a reader sees all of a commit or
nothing of it; what a failed commit left behind is named by no manifest and never read. A tag is
committed once: replaying it changes nothing. Files that a commit does not touch stay as they are.

One writer at a time is assumed (a streaming query is one); the manifest holds one name per file.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ortholake.sinks.files import exists, list_files, read_text, replace_text

NAME = "MANIFEST.json"


@dataclass
class Change:
    """What a commit does to a table: files that go, rows that come."""

    rows: DataFrame
    replaced: list[str] | None = field(default_factory=list)     # file names; None: all of the table's


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- reading ------------------------------------------------------------
    def manifest(self) -> dict:
        path = f"{self.root}/{NAME}"
        return json.loads(read_text(self.spark, path)) if exists(self.spark, path) else {"version": 0, "tables": {}, "tags": []}

    def files(self, table: str) -> list[str]:
        return self.manifest()["tables"].get(table, [])

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The current rows of a table; none if it was never written."""
        names = self.files(table)
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{n}" for n in names])

    def touched(self, table: str, schema: T.StructType, key: str, keys: DataFrame) -> list[str]:
        """Names of the files that hold one of ``keys`` (one column): reads only the key column.
        At most as many names as the manifest has."""
        if not self.files(table):
            return []
        rows = self.read(table, schema).select(F.col(key).alias("k"), F.col("_metadata.file_path").alias("file"))
        some = rows.join(keys.select(F.col(keys.columns[0]).alias("k")), "k", "left_semi").select("file").distinct()
        last = {os.path.basename(n): n for n in self.files(table)}
        return sorted(last[os.path.basename(r["file"])] for r in some.toLocalIterator())

    # -- writing ------------------------------------------------------------
    def write_files(self, table: str, rows: DataFrame) -> list[str]:
        """Write rows as new files, named by no manifest yet; their names under the root."""
        folder = f"data/{table}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        return [f"{folder}/{n}" for n in list_files(self.spark, f"{self.root}/{folder}") if n.endswith(".parquet")]

    def commit(self, changes: Mapping[str, Change | DataFrame], tag: str | None = None) -> bool:
        """Write the rows of every change, then publish all at once. A plain frame is appended.
        False if the tag was committed before."""
        now = self.manifest()
        if tag is not None and tag in now["tags"]:
            return False
        tables = {k: list(v) for k, v in now["tables"].items()}
        for table, change in changes.items():
            change = change if isinstance(change, Change) else Change(change)
            gone = set(tables.get(table, []) if change.replaced is None else change.replaced)
            missing = gone - set(tables.get(table, []))
            if missing:
                raise ValueError(f"{table}: files not of this version: {sorted(missing)}")
            tables[table] = [n for n in tables.get(table, []) if n not in gone] + self.write_files(table, change.rows)
        self.publish({"version": now["version"] + 1, "tables": tables, "tags": [*now["tags"], *([tag] if tag is not None else [])]})
        return True

    def publish(self, manifest: dict) -> None:
        replace_text(self.spark, f"{self.root}/{NAME}", json.dumps(manifest))


def key_ranges(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows laid out so that each file holds a range of keys, sorted."""
    cols = [F.col(k) for k in keys]
    return rows.repartitionByRange(*cols).sortWithinPartitions(*cols)
