"""Operator 7: byte-level BPE encoding and decoding through a sentencepiece model.

The model file is written here directly from a rank vocabulary (lines of base64 token and
rank): every byte stands for one character, every token becomes one piece scored by its
negative rank, and normalisation is the identity, so no text is changed before the merges.
Sentencepiece then merges the best-scored neighbouring pair first, leftmost on ties, which
is the rank rule. Texts are cut into pre-tokens by a pattern, each pre-token is encoded on
its own, and piece ids equal ranks. Decoding is the inverse mapping of ids to bytes.

Defined results: a null text is encoded as the empty text (no ids); rows are never dropped,
so repeated rows give repeated results; an id outside the vocabulary raises on decoding.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, slices, table, text_or_empty

#: Character of byte 0; byte b is chr(FIRST_CHAR + b). All 256 are letters outside ASCII that
#: sentencepiece treats as ordinary characters.
FIRST_CHAR = 0x100
#: Units remembered per task (in either memory), and the longest one remembered (in bytes).
#: An executor runs an encoder for each of its cores.
CACHE_UNITS, CACHE_CHARS = 200_000, 48
#: Bytes of text encoded at once, and bytes of a piece of a batch.
GROUP_CHARS, ROOM = 1 << 21, 1 << 21
IDS = pa.list_(pa.int32())
#: Bytes of visible ASCII characters, and first bytes of others that are not white space.
SURE, SPACE, ALNUM, MARK = np.zeros((4, 256), bool)
SURE[[*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True
#: ASCII white space, letters and digits, other visible characters.
SPACE[list(b" \t\n\v\f\r")] = True
ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
MARK[0x21:0x7F] = ~ALNUM[0x21:0x7F]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if any(not t for t in tokens):
        raise ValueError(f"{path}: ranks must be dense")
    return tokens


def to_char_list(raws: list[bytes]) -> list[str]:
    """Each byte string as its characters (all converted in one go)."""
    flat = (np.frombuffer(b"".join(raws), dtype=np.uint8).astype("<u2") + FIRST_CHAR).tobytes().decode("utf-16-le")
    ends = list(accumulate(map(len, raws)))
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


# Protocol-buffer wire format, as far as a sentencepiece model needs it --------------------
def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _float_field(number: int, value: float) -> bytes:
    return _varint(number << 3 | 5) + struct.pack("<f", value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose piece id is the token's rank; the unknown piece, which
    byte-mapped texts never need, comes last."""
    normal, unknown, bpe = 1, 2, 2
    pieces = [_bytes_field(1, chars.encode()) + _float_field(2, -float(rank)) + _int_field(3, normal)
              for rank, chars in enumerate(to_char_list(tokens))]
    pieces.append(_bytes_field(1, b"<unk>") + _float_field(2, 0.0) + _int_field(3, unknown))
    trainer = (_int_field(3, bpe) + _int_field(4, len(pieces)) + _int_field(40, len(tokens))
               + _int_field(41, -1) + _int_field(42, -1) + _int_field(43, -1))
    identity = _bytes_field(1, b"identity") + _int_field(3, 0) + _int_field(4, 0) + _int_field(5, 0)
    return b"".join(_bytes_field(1, p) for p in pieces) + _bytes_field(2, trainer) + _bytes_field(3, identity)


# Encoding and decoding -----------------------------------------------------------------
def lengths(lists: list) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def at_once(units: pa.BinaryArray) -> Iterator[pa.BinaryArray]:
    """Parts of which Python objects are made."""
    batch = pa.record_batch([units], names=["units"])
    return (units.slice(lo, n) for lo, n in slices(batch, 1 << 14, 1 << 18))


def spans(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Lists over ``values``; ``ends`` is 0 and the end of each."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def binary(ends: np.ndarray, data) -> pa.BinaryArray:
    """Byte strings that lie one after another in ``data``."""
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data or b"")])
    return rows.cast(pa.binary())


def joined(lists: pa.ListArray, bounds: np.ndarray) -> pa.ListArray:
    """The lists from each bound to the next one as one list; all lists are covered."""
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)])
    return spans(ends[bounds], lists.flatten())


class Memory:
    """Units met before and their ids, in Arrow arrays: a unit takes about 40 bytes."""

    def __init__(self):
        self.units, self.ids = pa.array([], pa.binary()), pa.array([], IDS)

    def __len__(self) -> int:
        return len(self.units)

    def look_up(self, units: pa.BinaryArray, work: Callable[[pa.BinaryArray], pa.ListArray]) -> pa.ListArray:
        """The ids of each unit; ``work`` gets what is new, once each."""
        coded = units.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.units)
        new = coded.dictionary.filter(at.is_null())
        ids = work(new)
        unknown = at.is_null().to_numpy(zero_copy_only=False)
        place = np.where(unknown, len(self) - 1 + np.cumsum(unknown), at.fill_null(0).to_numpy())
        out = pa.concat_arrays([self.ids, ids]).take(pa.array(place[coded.indices.to_numpy()]))
        self._learn(at.drop_null(), new, ids)
        return out

    def _learn(self, met: pa.Array, units: pa.BinaryArray, ids: pa.ListArray) -> None:
        """Of what was known, only what was met this time stays once there is no more room."""
        short = pc.less_equal(pc.binary_length(units), CACHE_CHARS)
        units, ids = units.filter(short)[:CACHE_UNITS], ids.filter(short)[:CACHE_UNITS]
        if len(self) + len(units) > CACHE_UNITS:
            met = met[:CACHE_UNITS - len(units)]
            self.units, self.ids = self.units.take(met), self.ids.take(met)
        self.units, self.ids = pa.concat_arrays([self.units, units]), pa.concat_arrays([self.ids, ids])


class Encoder:
    """Texts to ids. Remembers short units and short pre-tokens.

    The public pre-token pattern always starts a new pre-token at a space that is followed by
    a character other than white space, where white space begins, and at a mark after a letter
    or digit; no pre-token depends on what stands before it or after such a place. So texts
    are first cut into units at such places (those that the bytes beside them show), and only
    units not met before are worked out: one of letters alone is a pre-token, any other is cut
    by the pattern. Both ways give the same pre-tokens. ``space_led`` says whether the pattern
    has these properties; without them every text is cut by the pattern alone.

    Units, codes and ids are Arrow arrays; Python objects are made of new units only, some
    thousands at a time. Working memory does not grow with a text's length, as about
    ``GROUP_CHARS`` bytes of units are taken at a time, wherever texts begin or end."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str, space_led: bool = False):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.words = regex.compile(pattern).findall
        self.space_led = space_led
        self.spaced, self.plain = Memory(), Memory()

    def _merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens by the merges."""
        return self.model.encode(to_char_list(words), out_type=int, num_threads=1) if words else []

    def _ids(self, words: pa.BinaryArray) -> pa.ListArray:
        """Ids of pre-tokens: a token of the vocabulary is its own id, as merging all its bytes
        would give; anything else goes through the merges."""
        out = [pa.array([], IDS)]
        for part in at_once(words):
            raw = part.to_pylist()
            whole = list(map(self.whole.get, raw))
            merged = iter(self._merge([w for w, x in zip(raw, whole, strict=True) if x is None]))
            ids = [next(merged) if x is None else (x,) for x in whole]
            ends = np.concatenate([[0], np.cumsum(lengths(ids))])
            out.append(spans(ends, pa.array(np.fromiter(chain.from_iterable(ids), np.int32, ends[-1]))))
        return pa.concat_arrays(out)

    def _cut(self, units: pa.BinaryArray) -> pa.ListArray:
        """Ids of texts or units by the pattern."""
        out = [pa.array([], IDS)]
        for part in at_once(units):
            words = [self.words(t) for t in part.cast(pa.string()).to_pylist()]
            each = pa.array(list(chain.from_iterable(words)), pa.string()).cast(pa.binary())
            out.append(joined(self.plain.look_up(each, self._ids), np.concatenate([[0], np.cumsum(lengths(words))])))
        return pa.concat_arrays(out)

    def _new(self, units: pa.BinaryArray) -> pa.ListArray:
        """Ids of units not met before: one of letters alone is a pre-token."""
        one = pc.match_substring_regex(units.cast(pa.string()), r"\A ?\pL+\z")
        other = pc.invert(one)
        ids = pa.concat_arrays([self._ids(units.filter(one)), self._cut(units.filter(other))])
        one = one.to_numpy(zero_copy_only=False)
        return ids.take(pa.array(np.where(one, np.cumsum(one) - 1, one.sum() + np.cumsum(~one) - 1)))

    def _starts(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Where units start in data[lo:hi]: with every text, and at the places named above."""
        texts = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi, "right")]
        start = np.zeros(hi - lo + 1, bool)
        if self.space_led:
            here, nothing = data[lo:hi], np.zeros(1, np.uint8)
            before = data[lo - 1:hi - 1] if lo else np.concatenate([nothing, here[:-1]])
            after = data[lo + 1:hi + 1] if hi < len(data) else np.concatenate([here[1:], nothing])
            led = (here == 32) & SURE[after]
            led[texts[texts > lo] - lo - 1] = False                # what follows belongs to the next text
            start[:-1] = led | SPACE[here] & SURE[before] | MARK[here] & ALNUM[before]
        start[texts - lo] = True
        return np.flatnonzero(start[:-1])

    def _windows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        lo, end = int(offsets[0]), int(offsets[-1])
        while lo < end:
            hi = lo + GROUP_CHARS
            while hi < end and not len(first := self._starts(data, offsets, hi, min(end, hi + GROUP_CHARS))):
                hi += GROUP_CHARS
            hi = hi + int(first[0]) if hi < end else end
            yield lo, hi
            lo = hi

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text (null: none)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        _, places, raw = texts.buffers()
        offsets = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(raw or b"", np.uint8)
        flat, ends, total = [pa.array([], pa.int32())], np.zeros(len(offsets), np.int64), 0
        for lo, hi in self._windows(data, offsets):
            starts = self._starts(data, offsets, lo, hi)
            starts = starts if len(starts) and not starts[0] else np.concatenate([[0], starts])
            cuts = np.append(starts, hi - lo)
            units = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts.astype(np.int32)), raw.slice(lo, hi - lo)])
            found = self.spaced.look_up(units, self._new) if self.space_led else self._cut(units)
            here = slice(np.searchsorted(offsets, lo, "right"), np.searchsorted(offsets, hi, "right"))
            known = joined(found, np.searchsorted(cuts, np.concatenate([[0], offsets[here] - lo, [hi - lo]])))
            ends[here] = total + known.offsets.to_numpy()[1:-1]
            flat.append(known.flatten())
            total += len(flat[-1])
        return spans(ends, pa.concat_arrays(flat))

    def pack(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        ids = self.encode(pa.array(texts, pa.large_string()))
        flat, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        return [flat[a:b].tobytes() for a, b in pairwise(ends)]


def encode_texts(df: DataFrame, tokens: list[bytes], pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", space_led: bool = False) -> DataFrame:
    """(id, ids array<int>) for each row of ``df``; ``space_led``: see ``Encoder``."""
    spark = df.sparkSession
    # The vocabulary is one file of fixed size (about 50,000 tokens).
    shared = spark.sparkContext.broadcast((sentencepiece_model(tokens), tokens))
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        enc = Encoder(*shared.value, pattern, space_led)

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([b.column(0), enc.encode(b.column(1))], names=["id", "ids"])

        return work

    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return by_batch(rows, f"id {kind}, ids array<int>", make, ROOM).withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, tokens: list[bytes], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, n_tokens, packed binary, decoded binary): the ids as little-endian unsigned 32-bit
    integers and the bytes that they stand for. Null ids count as none."""
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        pieces = pa.array(shared.value, pa.large_binary())

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            n = pc.list_value_length(b.column(1)).fill_null(0).to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(n)])
            flat = np.asarray(b.column(1).flatten(), dtype="<u4")
            taken = pieces.take(pa.array(flat))
            _, places, raw = taken.buffers()
            places = np.frombuffer(places, np.int64) if len(flat) else np.zeros(1, np.int64)
            out = [b.column(0), pa.array(n), binary(4 * ends, flat.tobytes()), binary(places[ends], raw)]
            return pa.RecordBatch.from_arrays(out, names=["id", "n_tokens", "packed", "decoded"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return by_batch(rows, f"id {kind}, n_tokens long, packed binary, decoded binary", make, ROOM).withColumnRenamed("id", id_col)


def digest(df: DataFrame, tokens: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode by the public pattern, decode, and the checksums of both."""
    back = decode_ids(encode_texts(df, tokens, pattern, id_col, text_col, space_led=True), tokens, id_col)
    return back.select(id_col, "n_tokens", F.sha2("packed", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def vocabulary(path: str | None = None) -> tuple[list[bytes], str]:
    """(tokens, pre-token pattern) of the public vocabulary file ``path``."""
    import public_tokenizers

    return read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), *vocabulary())
