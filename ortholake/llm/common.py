"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.session import materialise, scratch_path

__all__ = ["materialise", "scratch_path", "table", "fresh", "by_batch", "text_or_empty", "slices"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column is called so (case ignored)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def text_or_empty(col: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def by_batch(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
             room: int | None = None) -> DataFrame:
    """``mapInArrow`` with per-task set-up: ``make`` runs once in each task and returns the
    function that turns a batch into a batch. Rows stay in their partition. ``room``: see ``slices``.
    Workers wait for further tasks, so a task's memory goes back to the system at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = b = None
        for b in batches:
            if b.num_rows:
                work = work or make()
                yield from _parts(b, work, room)
        work = b = None
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, work, room: int | None = None) -> Iterator[pa.RecordBatch]:
    for lo, n in slices(batch, room=room):
        yield work(batch.slice(lo, n))


def slices(batch: pa.RecordBatch, rows: int = 1024, room: int | None = None) -> Iterator[tuple[int, int]]:
    """(start, rows) pieces of a batch, so that working memory stays small: of at most ``room``
    bytes too, where it is given and a piece has several rows."""
    for lo in range(0, batch.num_rows, rows):
        yield from _halves(batch, lo, min(rows, batch.num_rows - lo), room)


def _halves(batch: pa.RecordBatch, lo: int, n: int, room: int | None) -> Iterator[tuple[int, int]]:
    if room is None or n == 1 or batch.slice(lo, n).nbytes <= room:
        yield lo, n
    else:
        yield from _halves(batch, lo, n // 2, room)
        yield from _halves(batch, lo + n // 2, n - n // 2, room)
