"""Operator 13: exact duplicates by counting quotient filters.

1. Every text is normalised (each run of white space becomes one space) and hashed to a 64-bit
   fingerprint. Each task builds counting quotient filters of its rows: the upper bits of a
   fingerprint are its quotient, the rest its remainder; a filter holds the occupied quotients, where
   the run of each ends, the sorted remainders of the runs, and a counter wherever a
   fingerprint came more than once. A text with very many copies is one counter per filter.
2. Filters of one geometry merge without loss: runs of equal quotient are merged by their sorted
   remainders, and counters of equal remainders add up. Filters travel in blocks of quotients;
   the number of blocks follows the number of rows, so a merge stays small at any size.
3. Fingerprints with a count above one are routed to the byte check: the texts that bear one are
   grouped by their bytes, copies combined within each task first. So a fingerprint that two
   texts share costs a comparison and never a text.

A row's group is its normalised text; of a group, the row with the smallest id stays.

Defined results: a null text counts as empty, and empty texts are equal to each other; a text of white
space only is one space, which differs from the empty text. Every row gives one row. Rows that
repeat both id and text are one document: each counts in ``group_size``, and they are kept or
dropped alike (``distinct_documents`` keeps one of them). A row without an id stays only where no
row of its group has one. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import fresh, materialise, table, text_or_empty

BLOCK_ROWS = 1 << 16      # rows of the table for each block of quotients
FILTER_ROWS = 1 << 20     # fingerprints of a task's filter; beyond it a task begins another one
MIN_BITS = 8              # of a quotient


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


@dataclass
class QuotientFilter:
    """A counting quotient filter with quotients of ``bits`` bits. Remainders are the other
    64 - ``bits`` bits, ascending within the run of a quotient."""

    bits: int
    quotient: np.ndarray      # occupied quotients, ascending
    end: np.ndarray           # where the run of each ends
    remainder: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, bits: int, values: np.ndarray, counts: np.ndarray | None = None) -> QuotientFilter:
        """Filter of 64-bit fingerprints, in any order, repeated or not."""
        order = np.argsort(values, kind="stable")       # merges ascending stretches
        v = values[order]
        c = np.ones(len(v), np.uint64) if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.intp)
        v, c = v[first], np.add.reduceat(c, first) if len(v) else c
        rest = np.uint64(64 - bits)
        q = v >> rest
        run = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.intp)
        end = np.append(run[1:], len(q)) if len(q) else run
        return cls(bits, q[run], end.astype(np.uint32), v & ((np.uint64(1) << rest) - np.uint64(1)), c)

    def fingerprints(self) -> np.ndarray:
        runs = np.diff(self.end.astype(np.int64), prepend=0)
        return (np.repeat(self.quotient, runs) << np.uint64(64 - self.bits)) | self.remainder

    def merged(self, *others: QuotientFilter) -> QuotientFilter:
        """One filter for all: same geometry, remainders of equal runs merged, counts added."""
        every = [self, *others]
        if any(f.bits != self.bits for f in every):
            raise ValueError("filters of one geometry only")
        return QuotientFilter.of(self.bits, np.concatenate([f.fingerprints() for f in every]), np.concatenate([f.count for f in every]))

    def above(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints, counts) of a count above ``n``."""
        some = self.count > n
        return self.fingerprints()[some], self.count[some]

    def blocks(self, block_bits: int) -> Iterator[tuple[int, QuotientFilter]]:
        """The filter cut at the upper ``block_bits`` of the quotients."""
        of = self.quotient >> np.uint64(self.bits - block_bits)
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
        for a, b in zip(cut, [*cut[1:], len(of)], strict=True):
            lo, hi = int(self.end[a - 1]) if a else 0, int(self.end[b - 1])
            yield int(of[a]), QuotientFilter(self.bits, self.quotient[a:b], self.end[a:b] - np.uint32(lo), self.remainder[lo:hi], self.count[lo:hi])

    def to_bytes(self) -> bytes:
        """Sizes, quotients, run ends, remainders in as few bytes each as they need, counters above one."""
        wide = (64 - self.bits + 7) // 8
        more = np.flatnonzero(self.count > 1).astype(np.uint32)
        low = np.ascontiguousarray(self.remainder.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :wide]
        head = np.array([self.bits, len(self.quotient), len(self.remainder), len(more)], "<u4")
        return b"".join([head.tobytes(), self.quotient.astype("<u8").tobytes(), self.end.astype("<u4").tobytes(), low.tobytes(),
                         more.astype("<u4").tobytes(), self.count[more].astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        bits, runs, slots, more = (int(x) for x in np.frombuffer(raw, "<u4", 4))
        wide, at = (64 - bits + 7) // 8, 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        quotient, end, low = take("<u8", runs), take("<u4", runs), take("u1", slots * wide)
        full = np.zeros((slots, 8), np.uint8)
        full[:, :wide] = low.reshape(slots, wide)
        count = np.ones(slots, np.uint64)
        where = take("<u4", more)
        count[where] = take("<u8", more)
        return cls(bits, quotient.astype(np.uint64), end, full.view("<u8").ravel().astype(np.uint64), count)


# Spark ----------------------------------------------------------------------------------
def geometry(rows: int) -> tuple[int, int]:
    """(quotient bits, block bits) for a table of so many rows: about one row in two quotients,
    and ``BLOCK_ROWS`` rows a block."""
    return max(MIN_BITS, max(rows, 1).bit_length() + 1), (max(rows - 1, 0) // BLOCK_ROWS).bit_length()


def task_filters(prints: DataFrame, bits: int, block_bits: int) -> DataFrame:
    """(block, filter): the filters that the tasks over ``prints`` (one long column) build."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, n = None, [], 0

        def folded():
            new = QuotientFilter.of(bits, np.concatenate(waiting))
            return held.merged(new) if held is not None else new

        def out(f: QuotientFilter) -> pa.RecordBatch:
            cut = [(b, x.to_bytes()) for b, x in f.blocks(block_bits)]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in cut], pa.int64()), pa.array([x for _, x in cut], pa.binary())], names=["block", "filter"])

        for b in batches:
            waiting.append(np.asarray(b.column(0)).view(np.uint64))
            n += b.num_rows
            if n >= FILTER_ROWS // 4:
                held, waiting, n = folded(), [], 0
                if len(held.remainder) >= FILTER_ROWS:
                    yield out(held)
                    held = None
        if waiting or held is not None:
            yield out(folded() if waiting else held)

    return prints.mapInArrow(run, "block long, filter binary")


def repeated_fingerprints(filters: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints whose count over all filters is above one. Filters of a block
    are merged as they come, ordered by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, waiting, size = None, None, [], 0

        def folded():
            return held.merged(*waiting) if held is not None else waiting[0].merged(*waiting[1:])

        def out(f: QuotientFilter) -> pa.RecordBatch:
            fp, n = f.above(1)
            return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n.astype(np.int64))], names=["fp", "n"])

        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if key != block and block is not None:
                    yield out(folded() if waiting else held)
                    held, waiting, size = None, [], 0
                block = key
                waiting.append(QuotientFilter.from_bytes(raw.as_py()))
                size += len(waiting[-1].remainder)
                if size >= FILTER_ROWS:
                    held, waiting, size = folded(), [], 0
        if block is not None:
            yield out(folded() if waiting else held)

    return filters.repartition("block").sortWithinPartitions("block").mapInArrow(run, "fp long, n long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    text = normalised(text_col)
    rows = materialise(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("fp"), F.unhex(F.sha2(text, 256)).alias("sha")), "prints")
    bits, block_bits = geometry(rows.count())
    twice = materialise(repeated_fingerprints(task_filters(rows.select("fp"), bits, block_bits)).select("fp"), "repeated")
    # The byte check. Repeated fingerprints grow with the table: never broadcast, however few they are here.
    routed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("fp", F.xxhash64("text"))
    routed = materialise(routed.join(twice.hint("merge"), "fp", "left_semi"), "routed")
    groups = routed.groupBy("fp", "text").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups.select(F.col("fp").alias("gfp"), F.unhex(F.sha2("text", 256)).alias("gsha"), "keep", "n"), "groups")
    j = rows.join(groups.hint("merge"), (F.col("fp") == F.col("gfp")) & (F.col("sha") == F.col("gsha")), "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return j.select(F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with their columns; of rows that repeat
    id and text, one."""
    own = docs.columns
    key = fresh("_key", own)
    keyed = materialise(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    flags = exact_duplicates(keyed.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(key).alias("key")).alias("row"), F.col(text_col).alias("text")),
                             "row", "text")
    gone = materialise(flags.filter(~F.col("kept")).select(F.col("row.key").alias(key)), "copies")
    return keyed.join(gone.hint("merge"), key, "left_anti").select(*own)


def op13_quotient_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents),
g AS (SELECT x, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(x) AS text_sha256 FROM t JOIN g USING (x)"""
