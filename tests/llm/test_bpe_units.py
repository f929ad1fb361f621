"""The encoder's units: what was met is not worked out again, and cutting texts changes no id."""

import random

import pyarrow as pa
import pytest

from ortholake.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    tokens, pattern = bpe.vocabulary()
    return bpe.sentencepiece_model(tokens), tokens, pattern


@pytest.fixture(scope="module")
def plain(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    _, tokens, pattern = vocabulary
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def counted(enc, monkeypatch) -> list[int]:
    at_once, merge = [], enc._merge
    monkeypatch.setattr(enc, "_merge", lambda words: at_once.append(len(words)) or merge(words))
    return at_once


def test_what_was_met_is_not_merged_again(vocabulary, monkeypatch):
    enc = bpe.Encoder(*vocabulary, space_led=True)
    text = " ".join(f"{chr(97 + i % 26)}{i:x}qz" for i in range(120_000))
    first = enc.pack([text])
    merged = counted(enc, monkeypatch)
    assert enc.pack([text]) == first
    assert sum(merged) == 0
    for memory in (enc.spaced, enc.plain):                     # as small as dicts of 50,000 objects
        assert memory.units.nbytes + memory.ids.nbytes <= 64 * len(memory)


def test_what_is_still_met_stays_when_there_is_no_room(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 50)
    enc = bpe.Encoder(*vocabulary, space_led=True)
    often = " ".join(f"oftenq{c}" for c in "abcdefgh")
    for k in range(20):
        enc.pack([often + " " + " ".join(f"rareq{k}z{i}" for i in range(30))])
    merged = counted(enc, monkeypatch)
    enc.pack([" " + often])
    assert sum(merged) <= 1 and len(enc.spaced) <= 50          # the first word, which no space led


def test_marks_after_a_word_do_not_make_a_new_one(vocabulary, monkeypatch):
    enc = bpe.Encoder(*vocabulary, space_led=True)
    merged = counted(enc, monkeypatch)
    enc.pack(["".join(f" xqzvword{m}" for m in "!#$%&()*+,-./:;<=>?@[]^_`{|}~") + " xqzvword's\n xqzvword"])
    assert sum(merged) == 1


@pytest.mark.parametrize("size", [3, 64, 1 << 22])
def test_ids_equal_those_of_whole_texts(vocabulary, plain, monkeypatch, size):
    r = random.Random(size)
    parts = ["a", "The ", "it's", "'s", "'", "'ll", " ", "  ", "\n", " \n", "\n\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", "　", "​", "ͅ", "12", "٣", "é", "É ", "日本", "語。", "!?", "_", "x_y", "()", " (", "-", "»", " «", "😀", "\r\n", "ß.", "é", "<|endoftext|>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(100 if size < 64 else 3000)]
    texts += ["", " ", "  ", "a ", "b", "a  ", "b", "\n", "x", "y" * 300, " " * 300, "7" * 300]
    monkeypatch.setattr(bpe, "GROUP_CHARS", size)
    got = bpe.Encoder(*vocabulary, space_led=True).encode(pa.array(texts))
    assert got.to_pylist() == [plain.encode_ordinary(t) for t in texts]


def test_slices_and_nulls(vocabulary, plain):
    texts = pa.array(["skip  ", "one two", None, "", " three, ", "skip"]).slice(1, 4)
    got = bpe.Encoder(*vocabulary, space_led=True).encode(texts)
    assert got.to_pylist() == [plain.encode_ordinary(t or "") for t in texts.to_pylist()]
    for none in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        assert bpe.Encoder(*vocabulary, space_led=True).encode(none).to_pylist() == [[] for _ in none]


def test_decoding_slices_nulls_and_unknown_ids(spark, vocabulary):
    _, tokens, _ = vocabulary
    lists = [None, [], [5, 6], [300, 40_000, 7], []]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>").coalesce(1)
    for x in bpe.decode_ids(df, tokens).collect():
        ids = lists[x["doc_id"]] or []
        assert x["n_tokens"] == len(ids) and bytes(x["decoded"]) == b"".join(tokens[i] for i in ids)
        assert bytes(x["packed"]) == b"".join(i.to_bytes(4, "little") for i in ids)
    for bad in (-1, len(tokens)):
        with pytest.raises(Exception, match="out of bounds"):
            bpe.decode_ids(spark.createDataFrame([(1, [bad])], "doc_id long, ids array<int>"), tokens).collect()
