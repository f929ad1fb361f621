"""Character k-mers of texts that occur in a reference set, found where the texts lie.

Of a text's k-mers few are in the references. Each is hashed with numpy and looked up in a Bloom filter of
the references' k-mers (``strands.KmerFilter``, bounded in size); only those that pass are cut out as text, so the
outcome of a join with the references' own k-mers is exact. Letter case of ASCII and white space are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ortholake.functions.columns import flat_text
from ortholake.operators.strands import KmerFilter

ROWS = 64           # texts of a batch at a time


def hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every ``k`` neighbouring code points."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # By doubling: of 1, 2, 4 ... neighbours, put together by the bits of k.
    x, width, out, have = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1, None, 0
    while width <= k:
        if k & width:
            out = x[:n] if out is None else out * _power(width) + x[have:have + n]
            have += width
        if 2 * width <= k:
            x = x[:-width] * _power(width) + x[width:]
        width *= 2
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _power(width: int) -> np.uint64:
    return np.uint64(pow(0x2545F4914F6CDD1D, width, 1 << 64))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def distinct_kmers(text: Column, k: int) -> Column:
    """The distinct substrings of ``k`` characters of a flat text, as an array."""
    starts = F.sequence(F.lit(1), F.length(text) - (k - 1))
    own = F.transform(starts, lambda i: F.substring(text, i, F.lit(k)))
    return F.when(F.length(text) >= k, F.array_distinct(own)).otherwise(F.array().cast("array<string>"))


def reference_kmers(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, shingle) of the distinct k-mers of each text."""
    flat = df.select(id_col, flat_text(text_col).alias("_t"))
    return flat.select(id_col, F.explode(distinct_kmers(F.col("_t"), k)).alias("shingle"))


def kmer_filter(refs: DataFrame, k: int) -> KmerFilter:
    """A filter of the k-mers (shingle) of a reference set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [hashes(code_points(t), k) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(own) if own else np.zeros(0, np.uint64)).view(np.int64))], names=["kmer"])

    return KmerFilter(refs.select("shingle").distinct().mapInArrow(run, "kmer long"))


def kmers_in(df: DataFrame, id_col: str, text_col: str, k: int, refs: DataFrame) -> DataFrame:
    """(id, t_n, shingle): the distinct k-mers of each text that the filter of ``refs`` (shingle) lets
    through, and how many distinct k-mers the text has."""
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(kmer_filter(refs, k))       # bounded, see KmerFilter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                who, size, out = [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    own, first = np.unique(hashes(code_points(t), k), return_index=True)
                    some = first[passes(own.view(np.int64))].tolist()
                    who += [i] * len(some)
                    size += [len(own)] * len(some)
                    out += [t[a:a + k] for a in some]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(who, pa.int32())), pa.array(size, pa.int32()), pa.array(out, pa.string())],
                                                 names=[id_col, "t_n", "shingle"])

    return df.select(id_col, flat_text(text_col).alias("_t")).mapInArrow(run, f"`{id_col}` {kind}, t_n int, shingle string")
