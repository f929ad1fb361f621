"""Strand-neutral k-mers of nucleotide reads, and a filter of them (R2).

A k-mer of up to 31 letters is packed at two bits a letter into one long; of a k-mer and its
reverse complement the smaller number stands for both, so a read is found whichever strand it was read from.
Windows with another letter than A, C, G or T (either case) have no k-mer.

The k-mers of a reference set are folded into a Bloom filter, by an OR that is combined within each
task. It has ``BITS_EACH`` bits a k-mer and ``MOST_BITS`` at most, which bounds what is sent to
the tasks; with more k-mers it only lets more pass. Reads are matched against it where they lie, and only
k-mers that pass are shuffled to meet the references' own, so the outcome is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ortholake.session import materialise

MOST_K = 31
BITS_EACH, MOST_BITS, HASHES = 12, 1 << 27, 4
_CODE = np.full(256, 255, np.uint8)
for _i, _c in enumerate("ACGT"):
    _CODE[[ord(_c), ord(_c.lower())]] = _i


def canonical_kmers(seq: str, k: int) -> np.ndarray:
    """Distinct packed k-mers of a sequence, ascending, as int64; white space is left out."""
    raw = np.frombuffer("".join(seq.split()).encode("ascii", "replace"), np.uint8)
    n = len(raw) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code = _CODE[raw]
    bad = np.concatenate([[0], np.cumsum(code == 255)])
    code = np.where(code == 255, 0, code).astype(np.int64)
    ahead, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(k):
        ahead = (ahead << 2) | code[j:j + n]
        back |= (3 - code[j:j + n]) << (2 * j)
    return np.unique(np.minimum(ahead, back)[bad[k:] == bad[:-k]])


def _positions(kmers: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    x = kmers.astype(np.uint64)
    for i in range(HASHES):
        h = (x ^ np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        yield (h * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - bits.bit_length() + 1)


def _kmer_rows(df: DataFrame, id_col: str, text_col: str, k: int, passes=None) -> DataFrame:
    """(id, kmer) of the distinct k-mers of each text that ``passes`` lets through."""
    if not 1 <= k <= MOST_K:
        raise ValueError(f"k must be 1 to {MOST_K}")
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                own = [canonical_kmers(t, k) for t in part.column(1).to_pylist()]
                who = np.repeat(np.arange(len(own)), [len(x) for x in own])
                kmers = np.concatenate(own)
                if passes is not None:
                    some = passes(kmers)
                    who, kmers = who[some], kmers[some]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(who)), pa.array(kmers)], names=["id", "kmer"])

    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, kmer long")


def filter_words(kmers: DataFrame, bits: int) -> DataFrame:
    """(word, mask): the filter of a frame of k-mers (kmer) as 64-bit words, those that are not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.concatenate(list(_positions(np.asarray(b.column(0)), bits)))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], names=["word", "mask"])

    return kmers.select("kmer").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))


class KmerFilter:
    """The filter as an array of words; calling it tells which k-mers may be in the set."""

    def __init__(self, kmers: DataFrame):
        n = kmers.count()
        self.bits = min(max(1 << (BITS_EACH * max(n, 1) - 1).bit_length(), 1 << 10), MOST_BITS)
        got = filter_words(kmers, self.bits).toArrow()              # at most MOST_BITS / 64 rows
        self.words = np.zeros(self.bits // 64, np.uint64)
        self.words[np.asarray(got.column("word"))] = np.asarray(got.column("mask")).view(np.uint64)

    def __call__(self, kmers: np.ndarray) -> np.ndarray:
        out = np.ones(len(kmers), bool)
        for at in _positions(kmers, self.bits):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def shared_kmers(reads: DataFrame, refs: DataFrame, k: int, read_id: str, ref_id: str, text_col: str) -> DataFrame:
    """(read id, ref id, shared): the pairs that share a k-mer on either strand, and how many."""
    own = materialise(_kmer_rows(refs, ref_id, text_col, k), "reference-kmers")
    shared = refs.sparkSession.sparkContext.broadcast(KmerFilter(own))          # MOST_BITS at most
    hits = materialise(_kmer_rows(reads, read_id, text_col, k, lambda x: shared.value(x)), "hits")
    pairs = hits.select(F.col("id").alias("_read"), "kmer").join(own.select(F.col("id").alias("_ref"), "kmer"), "kmer")
    pairs = pairs.groupBy("_read", "_ref").agg(F.count(F.lit(1)).alias("shared"))
    return pairs.select(F.col("_read").alias(read_id), F.col("_ref").alias(ref_id), "shared")
