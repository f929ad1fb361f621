"""How often every n-gram occurrence of a read set occurs in all of it.

Where the reads lie, a task cuts them into *chunks* and sends what has to be counted to *buckets* in packed
form: one row for a chunk and a bucket, not one for each n-gram. All occurrences of an n-gram meet in one bucket.
There they are counted, and each chunk is told, per read, how many of its occurrences have which count.

* A word n-gram is sent as its hash; the bucket comes from another hash, so that 56 bits of the first will do.
* Character n-grams go by minimizers. A minimizer is the least hash among an n-gram's substrings of ``PIECE``
  letters, which neighbouring n-grams mostly share; so a read is cut into runs of n-grams with one minimizer, and each
  run is sent once, as one stretch of text. With ``unit="dna"`` an n-gram and its reverse complement are one, and so
  are their minimizers.

No key is a row by itself, so a common n-gram or minimizer makes its bucket's rows longer by little more than a
packed read number for each occurrence. A bucket of more than ``HOT`` n-grams is counted in several passes over its
packed rows, each for a part of the hashes, so memory does not grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ortholake.functions.columns import ASCII_LOWER, ASCII_UPPER
from ortholake.operators.kmers import hashes

HOT = 1 << 20       # n-grams counted at a time
BLOCK = 1 << 14     # n-grams hashed at a time
PIECE = 11          # letters of a piece of a character n-gram
CUT_ROWS, CUT_BYTES = 1 << 12, 1 << 18              # reads cut at a time, at most, and bytes of them
CHUNK_PARTS, CHUNK_BYTES = 1 << 21, 1 << 24         # n-grams or runs, and bytes of runs, that end a chunk
CHUNK_READS = (1 << 16) - CUT_ROWS                  # a read's number in its chunk takes two bytes
BUCKETS = 16        # a shuffle partition
KEPT = 7            # bytes of a word n-gram's hash that are sent
SENT = 256          # packed rows given to Spark at a time
#: Between the words of a stretch; no word holds it.
GAP = " "


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of every ``w`` neighbours, by doubling the width."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out, have = np.minimum(out[:-step], out[step:]), have + step
    return out


def complement(seq: str) -> str:
    return seq.translate(_PAIRED)[::-1]


_PAIRED = str.maketrans("ACGT", "TGCA")
#: ASCII letters in upper case, without white space (as ``functions.columns.flat_text``).
_FLAT = str.maketrans(ASCII_LOWER, ASCII_UPPER, " \t\n\x0b\f\r")
_PAIRED_CODES = np.array([ord(chr(i).translate(_PAIRED)) for i in range(128)], np.uint64)


def minimizers(tokens: list[str] | str, n: int, strands: bool = False) -> np.ndarray:
    """Minimizer of every n-gram; none for fewer than n tokens. Words count by their bytes,
    characters in pieces of ``PIECE`` or of n, if that is less; with ``strands`` a piece counts as the
    lesser of itself and its reverse complement."""
    if len(tokens) < n:
        return np.zeros(0, np.uint64)
    if isinstance(tokens, str):
        return _minima(_codes(tokens), n, strands)
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(t, len(known)) for t in tokens])
    return window_minima(_word_hashes(list(known))[ids], n)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _other_strand(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < 128, _PAIRED_CODES[np.minimum(codes, 127).astype(np.int64)], codes)[::-1]


def _minima(codes: np.ndarray, n: int, strands: bool) -> np.ndarray:
    m = min(PIECE, n)

    piece = hashes(codes, m)
    if strands:
        piece = np.minimum(piece, hashes(_other_strand(codes), m)[::-1])
    return window_minima(piece, n - m + 1)


def _word_hashes(known: list[str]) -> np.ndarray:
    return _mix(np.array([crc32(t.encode()) for t in known], np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def windows(sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every n-gram of rows of tokens that stand one after the other."""
    each = np.maximum(sizes - n + 1, 0)
    row = np.repeat(np.arange(len(sizes)), each)
    return row, np.arange(len(row)) + np.repeat(np.cumsum(sizes) - sizes - np.cumsum(each) + each, each)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(number of words of each text, their words one after the other); an empty text has none."""
    some = pc.split_pattern(texts.filter(pc.not_equal(texts, "")), GAP)
    sizes = np.zeros(len(texts), np.int64)
    sizes[np.asarray(pc.not_equal(texts, "").cast(pa.int8())) == 1] = np.asarray(pc.list_value_length(some))
    return sizes, some.flatten().dictionary_encode()


def _cut(row: np.ndarray, place: np.ndarray, low: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(row, minimizer, n-grams, first token, last token) of each run of n-grams with one minimizer."""
    low = low[place]
    cut = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (row[1:] != row[:-1])]))
    size = np.diff(np.concatenate([cut, [len(row)]]))
    return row[cut], low[cut], size, place[cut], place[cut] + size + n - 2


def all_runs(texts: list[str], n: int, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(row, minimizer, n-grams, stretch) of each run of n-grams with one minimizer, of all texts."""
    if unit == "word":
        sizes, own = split_words(pa.array(texts, pa.string()))
        hashed = _word_hashes(own.dictionary.to_pylist())[np.asarray(own.indices)] if len(own) else np.zeros(0, np.uint64)
        low = window_minima(hashed, n) if len(hashed) >= n else hashed[:0]
        length = np.asarray(pc.utf8_length(own.dictionary))[np.asarray(own.indices)].astype(np.int64) if len(own) else np.zeros(0, np.int64)
        flat = GAP.join(t for t in texts if t)
        start = np.cumsum(length + len(GAP)) - length - len(GAP)
    else:
        sizes, flat = np.array([len(t) for t in texts], np.int64), "".join(texts)
        low = _minima(_codes(flat), n, unit == "dna") if len(flat) >= n else np.zeros(0, np.uint64)
        start, length = np.arange(len(flat)), np.ones(len(flat), np.int64)
    row, place = windows(sizes, n)
    if not len(row):
        return row, low[:0].view(np.int64), row, []
    row, low, size, first, last = _cut(row, place, low, n)
    ends = zip(start[first].tolist(), (start[last] + length[last]).tolist(), strict=True)
    return row, low.view(np.int64), size, [flat[a:b] for a, b in ends]


def runs(text: str, n: int, strands: bool = False) -> Iterator[tuple[int, int, str]]:
    """(minimizer, n-grams, stretch) of each run of a text's n-grams with one minimizer."""
    _, low, size, own = all_runs([text], n, "dna" if strands else "char")
    yield from zip(low.tolist(), size.tolist(), own, strict=True)


def gram_hashes(texts: pa.Array, n: int, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every n-gram of stretches; with ``unit="dna"`` the same for both strands."""
    if unit == "word":
        sizes, own = split_words(texts)
        codes = np.asarray(own.indices).astype(np.uint64)
    else:
        sizes, (data, _) = np.asarray(pc.utf8_length(texts)).astype(np.int64), _bytes(texts)
        codes = data if len(data) == sizes.sum() else _codes(data.tobytes().decode("utf-8", "surrogatepass"))
    row, place = windows(sizes, n)
    found = np.zeros(max(len(codes) - n + 1, 0), np.uint64)
    for lo in range(0, len(found), BLOCK):
        some = codes[lo:lo + BLOCK + n - 1]
        own = hashes(some, n)
        found[lo:lo + BLOCK] = np.minimum(own, hashes(_other_strand(some), n)[::-1]) if unit == "dna" else own
    return row, found[place]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends)."""
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    own = texts.buffers()[2] if len(texts) else None
    return np.frombuffer(own, np.uint8)[at[0]:at[-1]] if own is not None and own.size else np.zeros(0, np.uint8), at - at[0]


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: For two hashes of substrings: a number for each byte, and a base with its inverse. The hash of a substring is
#: the sum of its bytes' numbers times powers of the base, from sums up to its ends.
_BYTES = _spread(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, 256)
_BASE = (0x2545F4914F6CDD1D, 0xD1342543DE82EF95)
_known: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, ``most`` at least."""
    if not _known or len(_known[0][0]) < most:
        def up(base: int) -> np.ndarray:
            x = np.full(max(most, CUT_BYTES) + 1, base, np.uint64)
            x[0] = 1
            return np.multiply.accumulate(x)
        _known[:] = [(up(b), up(pow(b, -1, 1 << 64))) for b in _BASE]
    return _known


def word_grams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, other hash) of every n-gram of texts whose words have one space between them."""
    data, at = _bytes(texts)
    gap, some = np.flatnonzero(data == ord(GAP)), at[1:] > at[:-1]
    start, end = np.sort(np.concatenate([at[:-1][some], gap + 1])), np.sort(np.concatenate([gap, at[1:][some]]))
    row, place = windows(np.diff(np.searchsorted(start, at)), n)
    first, last, out = start[place], end[place + n - 1], []
    for number, (power, back) in zip(_BYTES, _powers(len(data)), strict=True):
        upto = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(number[data] * power[:len(data)], out=upto[1:])
        out.append(_spread((upto[last] - upto[first]) * back[first]))
    return row, out[0], out[1]


def char_runs(texts: list[str], n: int, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(row, minimizer, n-grams, first byte, end, all bytes) of each run of n-grams with one minimizer."""
    flat = "".join(texts)
    row, place = windows(np.array([len(t) for t in texts], np.int64), n)
    if not len(row):
        return row, np.zeros(0, np.uint64), row, row, row, b""
    data, codes = flat.encode("utf-8", "surrogatepass"), _codes(flat)
    row, low, grams, first, last = _cut(row, place, _minima(codes, n, unit == "dna"), n)
    if len(data) == len(codes):
        return row, low, grams, first, last + 1, data
    at = np.cumsum(np.concatenate([[0], 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)]))
    return row, low, grams, at[first], at[last + 1], data


def pack(*numbers: np.ndarray) -> bytes:
    """Arrays of numbers, compressed: of each the lowest bytes first, then the next ones and so on, so that
    high bytes that are 0 take next to no room."""
    plain = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in numbers)
    return pa.Codec("zstd", 3).compress(plain, asbytes=True)


def unpack(packed: bytes, many: int, *kinds: type) -> list[np.ndarray]:
    wide = [np.dtype(k).itemsize for k in kinds]
    plain, out, lo = np.frombuffer(pa.Codec("zstd").decompress(packed, many * sum(wide)), np.uint8), [], 0
    for kind, w in zip(kinds, wide, strict=True):
        out.append(np.ascontiguousarray(plain[lo:lo + many * w].reshape(w, many).T).reshape(-1).view(kind))
        lo += many * w
    return out


def _steps(reads: np.ndarray) -> np.ndarray:
    """Ascending numbers of reads, each less the one before."""
    return np.diff(reads, prepend=reads.dtype.type(0)).astype(np.uint16)


class Chunk:
    """What a task has cut of some reads, until it is sent."""

    def __init__(self, n: int, unit: str, buckets: int):
        self.n, self.unit, self.buckets, self.count = n, unit, buckets, 0
        self.clear()

    def clear(self) -> None:
        self.ids, self.cut, self.data, self.reads, self.grams, self.parts, self.bytes = [], [], [], 0, 0, 0, 0

    def full(self) -> bool:
        return self.reads > CHUNK_READS or self.parts >= CHUNK_PARTS or self.bytes >= CHUNK_BYTES

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        """Some reads, at most ``CUT_ROWS``; one much longer than ``CUT_BYTES`` by itself, which is cut piece by piece."""
        if len(texts) == 1 and texts.nbytes > 4 * CUT_BYTES:
            text = texts[0].as_py()
            own, sep, step = (text.split(GAP), GAP, CUT_BYTES // 8) if self.unit == "word" else (text.translate(_FLAT), "", CUT_BYTES)
            for lo in range(0, max(len(own) - self.n + 1, 1), step):
                self.cut_of(pa.array([sep.join(own[lo:lo + step + self.n - 1])]))
        else:
            self.cut_of(texts)
        self.ids.append(ids)
        self.reads += len(ids)

    def cut_of(self, texts: pa.Array) -> None:
        """The n-grams or runs of texts: (bucket, read, ...) of each."""
        if self.unit == "word":
            row, own, key = word_grams(texts, self.n)
            self.grams, rest = self.grams + len(row), [own]
        else:
            row, low, grams, first, end, data = char_runs([t.translate(_FLAT) for t in texts.to_pylist()], self.n, self.unit)
            key, rest = _spread(low), [grams.astype(np.uint32), (first + self.bytes).astype(np.uint32), (end - first).astype(np.uint32)]
            self.grams, self.bytes = self.grams + int(grams.sum()), self.bytes + len(data)
            self.data.append(data)
        bucket = ((key >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.uint16)
        self.cut.append([bucket, (row + self.reads).astype(np.uint16), *rest])
        self.parts += len(row)

    def sent(self) -> Iterator[pa.RecordBatch]:
        """The rows of the chunk, which is empty then."""
        if not self.reads:
            return
        # By its place and not at random: a task that runs once more sends the same.
        place = TaskContext.get().partitionId()
        number = (place << 32) + self.count
        own, self.cut = [list(x) for x in zip(*self.cut, strict=True)], []
        order = np.argsort(np.concatenate(own[0]), kind="stable")        # reads ascend within a bucket
        for i, x in enumerate(own):                          # one by one, as all would take much memory
            own[i] = np.concatenate(x)[order]
            x.clear()
        bucket, read, *rest = own
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else order
        ids = pa.concat_arrays(self.ids)
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        yield _rows([number], [(place + 31 * self.count) % self.buckets], [0], [self.grams], [None], [None], lists)
        text = np.frombuffer(b"".join(self.data), np.uint8)
        ends = [*cut[1:].tolist(), len(bucket)]
        for lo in range(0, len(cut), SENT):
            own = []
            for a, b in zip(cut[lo:lo + SENT].tolist(), ends[lo:lo + SENT], strict=True):
                if self.unit == "word":
                    head, body, grams = pack(_steps(read[a:b])), rest[0][a:b].view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes(), b - a
                else:
                    size, first, long = (x[a:b] for x in rest)
                    upto = np.cumsum(long, dtype=np.int64)
                    at = np.repeat(first.astype(np.int64) - upto + long, long) + np.arange(upto[-1])
                    head, body, grams = pack(_steps(read[a:b]), long), pack(text[at]), int(size.sum())
                own.append((number, int(bucket[a]), grams, b - a, head, body))
            yield _rows(*zip(*own, strict=True), pa.nulls(len(own), lists.type))
        self.clear()
        self.count += 1


def _rows(number, bucket, grams, parts, head, body, ids: pa.Array) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    own = [pa.array(x, k) for x, k in zip((number, bucket, grams, parts, head, body), kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*own, ids], names=["chunk", "bucket", "grams", "parts", "head", "body", "ids"])


def sent_chunks(reads: DataFrame, read_id: str, text_col: str, n: int, unit: str, buckets: int) -> DataFrame:
    """(chunk, bucket, grams, parts, head, body, ids): what each chunk sends to each bucket, packed; and a row
    with the ids of its reads and the number of all its n-grams (parts)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if unit == "word":
        text = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", GAP))
    elif unit not in ("char", "dna"):
        raise ValueError(f"unit must be word, char or dna, not {unit!r}")
    kind = reads.schema[read_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(n, unit, buckets)
        for b in batches:
            at, lo = _bytes(b.column(1))[1], 0
            while lo < b.num_rows:
                hi = min(max(int(np.searchsorted(at, at[lo] + CUT_BYTES, "right")) - 1, lo + 1), lo + CUT_ROWS, b.num_rows)
                chunk.add(b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo))
                lo = hi
                if chunk.full():
                    yield from chunk.sent()
        yield from chunk.sent()

    return reads.select(F.col(read_id).alias("read"), text.alias("text")).mapInArrow(
        run, f"chunk long, bucket int, grams long, parts long, head binary, body binary, ids array<{kind}>")


def _grams_of(part: pa.Table, n: int, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, read, hash) of every n-gram of what was sent."""
    parts, body = part.column("parts").to_pylist(), part.column("body").to_pylist()
    heads = [unpack(h, m, *([np.uint16] if unit == "word" else [np.uint16, np.uint32])) for h, m in zip(part.column("head").to_pylist(), parts, strict=True)]
    row, read = np.repeat(np.arange(len(parts)), parts), np.concatenate([np.cumsum(h[0], dtype=np.uint16) for h in heads])
    if unit == "word":
        own = np.zeros((len(row), 8), np.uint8)
        own[:, :KEPT] = np.frombuffer(b"".join(body), np.uint8).reshape(-1, KEPT)
        bucket = np.asarray(part.column("bucket"))
        own[:, KEPT] = np.cumsum(np.diff(bucket, prepend=bucket[0]) != 0).astype(np.uint8)[row]     # several are counted at a time
        return row, read, own.reshape(-1).view(np.uint64)
    text = b"".join(unpack(t, int(h[1].sum()), np.uint8)[0].tobytes() for t, h in zip(body, heads, strict=True))
    ends = np.cumsum(np.concatenate([[0], *(h[1] for h in heads)]), dtype=np.int64)
    which, own = gram_hashes(pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(ends), pa.py_buffer(text)), n, unit)
    return row[which], read[which], own


def totals(own: np.ndarray) -> np.ndarray:
    """How often each of some hashes occurs among them; they are sorted in parts that a core's cache can hold."""
    some = (own & np.uint64(0x7F)).astype(np.uint8)
    order, out = np.argsort(some, kind="stable"), np.zeros(len(own), np.int64)
    own, ends = own[order], np.cumsum(np.bincount(some, minlength=128)).tolist()
    for lo, hi in zip([0, *ends], ends):
        if lo < hi:
            at = np.argsort(own[lo:hi])
            x = own[lo:hi][at]
            size = np.diff(np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1], [True]])))
            out[order[lo:hi][at]] = np.repeat(size, size)
    return out


def _told(part: pa.Table, n: int, unit: str, most: int) -> Iterator[list]:
    """What whole buckets tell the chunks: (chunk, parts, told), ``told`` being (read, count, times) numbers."""
    chunks = part.column("chunk").combine_chunks().dictionary_encode()
    number, which = chunks.dictionary.to_pylist(), np.asarray(chunks.indices).astype(np.int64)
    upto = np.cumsum(np.asarray(part.column("grams")))
    several = int(upto[-1]) // (most + 1) + 1                # passes, each over slices of the rows
    slices = [0, *(np.flatnonzero(np.diff(upto // (most + 1))) + 1).tolist(), len(upto)]
    for k in range(several):
        found = []
        for lo, hi in zip(slices[:-1], slices[1:], strict=True):
            row, read, own = _grams_of(part.slice(lo, hi - lo), n, unit)
            if several > 1:
                some = _spread(own) % np.uint64(several) == k
                row, read, own = row[some], read[some], own[some]
            found.append((which[lo:hi][row] << 16 | read, own))
        who, own = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(own):
            continue
        total = totals(own)
        wide = int(total.max()) + 1
        key, times = np.unique(who * wide + total, return_counts=True)
        who, c = np.divmod(key, wide)
        cut = np.flatnonzero(np.concatenate([[True], (who[1:] >> 16) != (who[:-1] >> 16)]))
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(who)], strict=True):
            told = pack(_steps(who[lo:hi] & 0xFFFF), c[lo:hi], times[lo:hi].astype(np.int64))
            yield [number[who[lo] >> 16], hi - lo, told]


def counted_chunks(sent: DataFrame, n: int, unit: str, most: int) -> DataFrame:
    """(chunk, parts, told, ids): for a chunk, how many occurrences of each of its reads have which count, as
    numbers of some buckets, not yet added up; and the row with its ids."""
    ids = sent.schema["ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(part: pa.Table) -> Iterator[pa.RecordBatch]:
            named = part.filter(pc.is_valid(part.column("ids")))
            if named.num_rows:
                own = named.combine_chunks().select(["chunk", "parts", "ids"])
                yield from pa.table([own["chunk"], own["parts"], pa.nulls(own.num_rows, pa.binary()), own["ids"]], names=["chunk", "parts", "told", "ids"]).to_batches()
            packed, own = part.filter(pc.is_null(part.column("ids"))), []
            for x in _told(packed, n, unit, most) if packed.num_rows else ():
                own.append(x)
                if len(own) == SENT:
                    yield told(own, part)
                    own = []
            if own:
                yield told(own, part)

        def told(own: list, part: pa.Table) -> pa.RecordBatch:
            columns = [pa.array(x, k) for x, k in zip(zip(*own, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(own), part.schema.field("ids").type)], names=["chunk", "parts", "told", "ids"])

        held, have = [], 0
        for b in batches:
            held.append(b)
            have += int(pc.sum(b.column("grams")).as_py() or 0)
            if have > most:
                part = pa.Table.from_batches(held)
                bucket = np.asarray(part.column("bucket"))
                full = int(np.searchsorted(bucket, bucket[-1]))      # the last bucket may go on
                if full:
                    yield from groups(part.slice(0, full), rows)
                    held = part.slice(full).combine_chunks().to_batches()
                    have = int(pc.sum(part.column("grams").slice(full)).as_py())
        if held:
            yield from groups(pa.Table.from_batches(held), rows)

    def groups(part: pa.Table, rows) -> Iterator[pa.RecordBatch]:
        """Whole buckets, as many at a time as have ``most`` n-grams, or one."""
        bucket = np.asarray(part.column("bucket"))
        cut = [*np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist(), len(bucket)]
        upto, lo = np.concatenate([[0], np.cumsum(np.asarray(part.column("grams")))]), 0
        for at, end in zip(cut[1:], [*cut[2:], None], strict=True):
            if end is None or upto[end] - upto[lo] > most:
                yield from rows(part.slice(lo, at - lo))
                lo = at

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, f"chunk long, parts long, told binary, ids {ids}")


def counts_of_reads(told: DataFrame) -> DataFrame:
    """(read, c, times): how many occurrences of a read have the count ``c``; a read that is in several chunks
    has rows of each."""
    kind = told.schema["ids"].dataType.elementType.simpleString()

    def added(part: pa.Table) -> pa.RecordBatch:
        named = part.filter(pc.is_valid(part.column("ids")))
        packed = part.filter(pc.is_null(part.column("ids")))
        own = [unpack(t, m, np.uint16, np.int64, np.int64) for t, m in zip(packed.column("told").to_pylist(), packed.column("parts").to_pylist(), strict=True)]
        read = np.concatenate([np.zeros(0, np.uint16), *(np.cumsum(x[0], dtype=np.uint16) for x in own)])
        c, times = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in own)]) for i in (1, 2))
        if named.num_rows != 1 or named.column("parts")[0].as_py() != times.sum():
            raise RuntimeError("a chunk of reads came back other than it was sent")
        order = np.lexsort((c, read))
        read, c, times = read[order], c[order], times[order]
        cut = np.flatnonzero(np.concatenate([[True], (read[1:] != read[:-1]) | (c[1:] != c[:-1])])) if len(read) else order
        ids = named.column("ids").combine_chunks().flatten()
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array(read[cut])), pa.array(c[cut]), pa.array(np.add.reduceat(times, cut) if len(cut) else times)], names=["read", "c", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            held.append(b)
            part = pa.Table.from_batches(held)
            number = np.asarray(part.column("chunk"))
            cut = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist()]     # the last chunk may go on
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                yield added(part.slice(lo, hi - lo))
            held = part.slice(cut[-1]).to_batches()
        if held:
            yield added(pa.Table.from_batches(held))

    dealt = told.repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(run, f"read {kind}, c long, times long")


def depths(reads: DataFrame, read_id: str, text_col: str, n: int, unit: str = "word") -> DataFrame:
    """(read, depth): the (lower) median, over the n-gram occurrences of a read, of how often each
    n-gram occurs in all reads; reads without an n-gram are left out. ``read_id`` is unique. Should a task of
    ``reads`` run once more, it has to give the same rows in the same order, as a scan does."""
    buckets = min(BUCKETS * int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 16)
    sent = sent_chunks(reads, read_id, text_col, n, unit, buckets)
    table = counts_of_reads(counted_chunks(sent, n, unit, HOT))
    # Middle of each read's counts: at most as many rows as a read has different counts.
    upto = F.sum("times").over(Window.partitionBy("read").orderBy("c"))
    every = F.sum("times").over(Window.partitionBy("read"))
    return table.withColumn("upto", upto).withColumn("every", every).filter(2 * F.col("upto") >= F.col("every")).groupBy("read").agg(F.min("c").alias("depth"))
