"""N-grams are cut and counted many at a time, with the same outcome as one by one."""

import random

import pyarrow as pa
import pytest

from ortholake import fixture
from ortholake.operators import kmer_depth as kd

PAIR = str.maketrans("ACGT", "TGCA")


@pytest.mark.parametrize("unit", ["word", "char", "dna"])
def test_hashes_tell_grams_apart(monkeypatch, unit):
    r = random.Random(2)
    monkeypatch.setattr(kd, "BLOCK", 7)                                # n-grams lie across blocks
    if unit == "word":
        texts = ["", "a", *(" ".join(r.choices(["a", "b", "é", "dd"], k=r.randrange(1, 30))) for _ in range(40))]
    else:
        texts = ["", "A", "ACGTN" * 6, *("".join(r.choices("ACGT" if unit == "dna" else "ACGé𝒜", k=r.randrange(1, 40))) for _ in range(40))]
    cut = (lambda t: t.split()) if unit == "word" else list
    want = [(i, tuple(w[k:k + 4])) for i, t in enumerate(texts) for w in [cut(t)] for k in range(len(w) - 3)]
    if unit == "dna":
        want = [(i, min(g, tuple("".join(g).translate(PAIR)[::-1]))) for i, g in want]
    row, own = kd.gram_hashes(pa.array(texts, pa.string()), 4, unit)
    assert row.tolist() == [i for i, _ in want]
    pairs = set(zip(own.tolist(), (g for _, g in want), strict=True))
    assert len(pairs) == len({h for h, _ in pairs}) == len({g for _, g in pairs})


@pytest.mark.parametrize("unit", ["word", "char", "dna"])
def test_runs_of_many_texts_are_those_of_each(unit):
    r = random.Random(6)
    texts = ["", "AC", *("".join(r.choices("ACGTN" if unit != "word" else "ab é", k=r.randrange(1, 90))) for _ in range(30))]
    texts = [" ".join(t.split()) for t in texts] if unit == "word" else texts
    n, sep = (2, " ") if unit == "word" else (13, "")
    row, low, size, own = kd.all_runs(texts, n, unit)
    for i, t in enumerate(texts):
        tokens = t.split() if unit == "word" else t
        mine = [(int(a), int(b), s) for k, a, b, s in zip(row, low, size, own, strict=True) if k == i]
        minima = kd.minimizers(tokens, n, unit == "dna").view("int64").tolist() if len(tokens) >= n else []
        assert [a for a, b, _ in mine for _ in range(b)] == minima
        assert [sep.join(tokens[k:k + n]) for k in range(len(tokens) - n + 1)] == [
            sep.join(w[k:k + n]) for _, b, s in mine for w in [s.split() if unit == "word" else s] for k in range(b)]


def test_bases_of_odd_texts(spark):
    rows = [(1, "Abc é zZ1\n"), (2, "Abc é zZ1\n"), (3, None), (None, "tuv"), (-1, "xyzä𝒜"), (4, "")]
    got = fixture.nucleotides(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", both_strands=True)
    table = str.maketrans(fixture._LETTERS, fixture._BASES)
    plain = {(i, "".join(c for c in (t or "").translate(table) if c in "ACGT")) for i, t in rows}
    assert {tuple(x) for x in got.collect()} == {(i, t.translate(PAIR)[::-1] if i is not None and i % 2 == 1 and i > 0 else t) for i, t in plain}
