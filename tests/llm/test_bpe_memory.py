"""The encoder's working memory: bounded by its settings, not by the texts or the words in them."""

import random
import struct

import pyarrow as pa
import pytest

from ortholake.llm import bpe, common


@pytest.fixture(scope="module")
def vocabulary():
    tokens, pattern = bpe.vocabulary()
    return bpe.sentencepiece_model(tokens), tokens, pattern


def odd_texts() -> list[str]:
    r = random.Random(1)
    parts = ["a", "the ", "it's", " ", "  ", "\n", " \n", "\t", "　", "12", "é", "日本", "!?", "'ll", " x", "\r\n"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(300)] + ["", " ", "x" * 3000]


def test_remembered_units_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 100)
    enc = bpe.Encoder(*vocabulary, space_led=True)
    for k in range(5):                                  # 800 new words a call, one text cut by the pattern
        enc.pack([" ".join(f"w{k}q{i}" for i in range(800)), f"two  gaps {k}"])
        assert len(enc.plain) <= 100 and len(enc.spaced) <= 100


def test_a_long_text_is_merged_in_pieces(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_CHARS", 1000, raising=False)
    enc = bpe.Encoder(*vocabulary, space_led=True)
    at_once, merge = [], enc._merge
    monkeypatch.setattr(enc, "_merge", lambda words: at_once.append(sum(map(len, words))) or merge(words))
    text = " ".join(f"word{i}" for i in range(5000))
    got, = enc.pack([text])
    assert max(at_once) < 3000
    assert got == bpe.Encoder(*vocabulary).pack([text])[0]


@pytest.mark.parametrize("size", [1, 2, 7, 50])
def test_pieces_give_the_ids_of_the_whole(vocabulary, monkeypatch, size):
    tiktoken = pytest.importorskip("tiktoken")
    model, tokens, pattern = vocabulary
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = odd_texts()
    monkeypatch.setattr(bpe, "GROUP_CHARS", size, raising=False)
    monkeypatch.setattr(bpe, "CACHE_UNITS", 20)
    want = [plain.encode_ordinary(t) for t in texts]
    assert bpe.Encoder(model, tokens, pattern, True).pack(texts) == [struct.pack(f"<{len(x)}I", *x) for x in want]


def test_slices_hold_to_rows_and_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * (5000 if i == 3 else 10) for i in range(3000)]})
    got = list(common.slices(batch, room=2000))
    assert [i for lo, n in got for i in range(lo, lo + n)] == list(range(3000))
    assert all(n == 1 or batch.slice(lo, n).nbytes <= 2000 for lo, n in got) and all(n <= 1024 for _, n in got)
    assert [n for _, n in common.slices(batch)] == [1024, 1024, 952]
