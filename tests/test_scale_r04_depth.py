"""Depths of reads: n-grams are sent packed, once, and nothing else is kept on disk."""

import glob
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ortholake.operators import kmer_depth as kd
from ortholake.session import ensure_checkpoint_dir

PAIR = str.maketrans("ACGT", "TGCA")
CUTS = {"word": lambda t, n: [tuple(w[i:i + n]) for w in [t.lower().split()] for i in range(len(w) - n + 1)],
        "char": lambda t, n: [t.upper()[i:i + n] for i in range(len(t) - n + 1)],
        "dna": lambda t, n: [min(g, g.translate(PAIR)[::-1]) for i in range(len(t) - n + 1) for g in [t[i:i + n]]]}


def plain_depths(rows, n, cut):
    """Of rows (id, text); rows with one id are one read, none of them a null."""
    count, own = Counter(g for _, t in rows for g in cut(t or "", n)), {}
    for i, t in rows:
        own.setdefault(i, []).extend(cut(t or "", n))
    return {i: sorted(count[g] for g in x)[(len(x) - 1) // 2] for i, x in own.items() if x and i is not None}


def some_reads(unit, many, long):
    r = random.Random(many)
    if unit == "word":
        return [" ".join(f"w{min(r.randrange(4000), r.randrange(4000))}" for _ in range(long)) for _ in range(many)]
    genome = "".join(r.choices("ACGT", k=long + many * long // 3))
    return [genome[a:a + long] if r.random() < 0.5 else genome[a:a + long].translate(PAIR)[::-1] for a in (r.randrange(len(genome) - long) for _ in range(many))]


@pytest.mark.parametrize(("unit", "n", "most"), [("word", 3, 9.0), ("dna", 25, 2.2)])
def test_ngrams_are_sent_packed_and_nothing_is_written(spark, unit, n, most):
    """Before, each run of n-grams was a row that was written and then shuffled; those of a common minimizer
    (as "the" of every read here) were a row each, which was shuffled and written twice more."""
    texts = some_reads(unit, 600, 400 if unit == "word" else 3000)
    rows = list(enumerate(t.replace("w7", "the") if unit == "word" else t for t in texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).cache()
    there = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(there)) if os.path.isdir(there) else set()
    got = {x["read"]: x["depth"] for x in kd.depths(df, "doc_id", "text", n, unit).collect()}
    assert got == plain_depths(rows, n, CUTS[unit])
    after = set(os.listdir(there)) if os.path.isdir(there) else set()
    assert sorted(after - before) == [] and not glob.glob(f"{there}/stretches-*")
    sent = kd.sent_chunks(df, "doc_id", "text", n, unit, 64).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("grams").alias("grams"), F.sum(F.length("head") + F.length("body")).alias("bytes")).first()
    assert sent["grams"] == sum(len(CUTS[unit](t, n)) for _, t in rows)
    assert sent["rows"] <= 2 * (64 + 1) and sent["bytes"] < most * sent["grams"]


@pytest.mark.parametrize(("unit", "n"), [("word", 2), ("char", 12), ("dna", 13)])
def test_ids_that_repeat_or_are_null(spark, unit, n):
    """Rows with one id are one read, wherever they lie; n-grams of a read without an id count for the others."""
    texts = some_reads(unit, 60, 40)
    rows = [(i % 50 if i % 9 else None, t) for i, t in enumerate(texts)] + [(1, texts[1]), (2, None), (777, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x["read"]: x["depth"] for x in kd.depths(df, "doc_id", "text", n, unit).collect() if x["read"] is not None}
    assert got == plain_depths(rows, n, CUTS[unit])


def test_several_chunks_of_a_task(spark):
    """More reads than a chunk has numbers for, in one task; ids of another type."""
    many = 2 * kd.CHUNK_READS + 5000
    df = spark.range(many, numPartitions=1).select(F.concat(F.lit("r"), "id").alias("k"), F.concat_ws(" ", F.lit("a b"), F.col("id") % 1000, F.col("id")).alias("text"))
    got = kd.depths(df, "k", "text", 3).groupBy("depth").agg(F.count(F.lit(1)), F.min(F.length("read")), F.countDistinct("read")).collect()
    assert [tuple(x) for x in got] == [(1, many, 2, many)]                 # of two n-grams the one with the id: the lower median
    got = kd.depths(df.withColumn("text", F.concat_ws(" ", F.lit("a b"), F.expr("cast(substring(k, 2) as long) % 1000"))), "k", "text", 3)
    assert {tuple(x) for x in got.groupBy("depth").count().collect()} == {(many // 1000 + 1, (many // 1000 + 1) * (many % 1000)), (many // 1000, (many // 1000) * (1000 - many % 1000))}


@pytest.mark.parametrize("unit", ["word", "char", "dna"])
def test_a_long_text_is_cut_in_pieces(monkeypatch, unit):
    monkeypatch.setattr(kd, "CUT_BYTES", 64)
    monkeypatch.setattr(kd, "TaskContext", type("T", (), {"get": lambda: type("C", (), {"partitionId": lambda _: 3})()}))
    text = " ".join(some_reads(unit, 3, 300)) if unit == "word" else "".join(some_reads(unit, 3, 300)) + "é𝒜AC" * 20
    n, out = 5, []
    for texts in ([text], ["", text[:40]]):
        chunk = kd.Chunk(n, unit, 16)
        chunk.add(pa.array(range(len(texts))), pa.array(texts))
        part = pa.Table.from_batches(list(chunk.sent()))
        named = part.filter(pa.compute.is_valid(part.column("ids")))
        assert named.column("ids").to_pylist() == [list(range(len(texts)))]
        row, read, own = kd._grams_of(part.filter(pa.compute.is_null(part.column("ids"))).sort_by("bucket"), n, unit)
        assert len(own) == named.column("parts")[0].as_py() == sum(len(CUTS[unit](t, n)) for t in texts)
        out.append(Counter(kd.totals(own).tolist()))
        want = Counter(g for t in texts for g in CUTS[unit](t, n))
        assert out[-1] == Counter(c for c in want.values() for _ in range(c))


def test_hashes_of_word_grams_tell_them_apart():
    r = random.Random(5)
    texts = ["", "a", "é", "a a", *(" ".join(r.choices(["a", "aa", "b", "é", "dd", "ab"], k=r.randrange(1, 30))) for _ in range(60))]
    want = [(i, tuple(w[k:k + 3])) for i, t in enumerate(texts) for w in [t.split()] for k in range(len(w) - 2)]
    for lo, hi in ((0, len(texts)), (3, 40)):                              # a slice, too
        row, own, other = kd.word_grams(pa.array(texts, pa.string()).slice(lo, hi - lo), 3)
        here = [(i - lo, g) for i, g in want if lo <= i < hi]
        assert row.tolist() == [i for i, _ in here]
        for x in (own & np.uint64((1 << 56) - 1), other):
            pairs = set(zip(x.tolist(), (g for _, g in here), strict=True))
            assert len(pairs) == len({h for h, _ in pairs}) == len({g for _, g in pairs})


def test_packed_numbers_come_back():
    r = np.random.default_rng(1)
    for many in (0, 1, 5000):
        a, b = np.sort(r.integers(0, 1 << 16, many)).astype(np.uint16), r.integers(0, 1 << 40, many)
        steps, back = kd.unpack(kd.pack(kd._steps(a), b), many, np.uint16, np.int64)
        assert (np.cumsum(steps, dtype=np.uint16) == a).all() and (back == b).all()
