"""Exact similarity links between texts, through a rare-first prefix index.

A text is its set of shingles (64-bit hashes). Two sets are linked where
100 * shared >= percent * union. With all shingles in one global order, linked sets share one of the
first n - ceil(percent * n / 100) + 1 shingles of either (n: size of the set), so only these
prefixes are indexed. Any fixed order is right; a good one has rare shingles first, so that a common shingle is in a
prefix only where a set has little else. It is taken from bounded tables of counts (``Order``): how often words occur,
hashed into ``WORDS`` cells, and which of ``SHINGLES`` cells hold far more shingles than others. So a text is cut,
ordered and reduced to its prefix where it lies; only prefixes are shuffled, once.

A candidate pair is first held against odd sketches of about a bit a shingle: their XOR has at most as many
bits as the sets differ in shingles, so no link is lost. Whole sets are made for the pairs left.

Candidates of a bucket (a shingle) are not formed as all pairs. Every member is compared with one
of the bucket; the links give components; in buckets that still hold several components the
others are compared with another member of the largest one, as long as that connects a good
part of them; at last those still outside are compared with the members of other components.
So any two members of a bucket were compared or are connected already. Sizes rule a pair out first,
and every link is confirmed on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ortholake.functions.columns import flat_text, with_kmers, with_ngrams, with_words, words
from ortholake.operators.components import star_forest
from ortholake.operators.kmers import hashes
from ortholake.operators.strands import KmerFilter
from ortholake.session import materialise

WORDS, SHINGLES = 1 << 20, 1 << 22      # cells in which words and shingles are counted
ORDER = "kind int, cell long, c long"
ROWS = 256                              # texts of a batch at a time


def with_shingles(df: DataFrame, text_col: str, n: int, unit: str = "word") -> DataFrame:
    """Add ``_ngrams``: the n-grams of words (texts), or of characters with ``unit="char"``
    (k-mers of nucleotide reads and proteins, letter case ignored)."""
    if unit == "char":
        return with_kmers(df, text_col, n)
    if unit != "word":
        raise ValueError(f"unit must be word or char, not {unit!r}")
    return with_ngrams(with_words(df, text_col), "_words", n)


def tokens(texts: DataFrame, unit: str = "word") -> DataFrame:
    """(id, w array<long>): a hash of every word, or character, of each text (id, text)."""
    if unit not in ("word", "char"):
        raise ValueError(f"unit must be word or char, not {unit!r}")
    own = F.filter(F.split(flat_text("text"), ""), lambda c: c != "") if unit == "char" else words(F.coalesce("text", F.lit("")))
    return texts.select("id", F.transform(own, lambda w: F.xxhash64(w)).alias("w"))


def _cell(values: np.ndarray, cells: int) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(65 - cells.bit_length())).astype(np.int64)


class Order:
    """The order of shingles, by rows of counts (kind, cell, c): the common cells of shingles (kind 1) come last,
    the others by the sum of their words' counts (kind 0) in logarithmic steps, then by hash."""

    def __init__(self, rows: DataFrame):
        got = rows.toArrow()                                        # at most WORDS + SHINGLES rows
        kind, cell, c = (np.asarray(got.column(x)) for x in ("kind", "cell", "c"))
        self.words, self.shingles = np.zeros(WORDS, np.uint8), np.zeros(SHINGLES, np.uint8)
        step = np.minimum(8 * np.log2(1 + c), 255).astype(np.uint8)
        self.words[cell[kind == 0]], self.shingles[cell[kind == 1]] = step[kind == 0], step[kind == 1]


def _sets(part: pa.RecordBatch, n: int, order: Order | None = None) -> list[np.ndarray]:
    """The distinct shingles of each row of a batch (id, w), in the order, if there is one."""
    w = part.column(1)
    at, codes = np.asarray(w.offsets).astype(np.int64), np.asarray(w.values).view(np.uint64)
    codes, at = codes[at[0]:at[-1]], at - at[0]
    all_ = hashes(codes, n).view(np.int64)
    if order is not None and len(all_):
        upto = np.concatenate([[0], np.cumsum(order.words[_cell(codes, WORDS)], dtype=np.int64)])
        weight = upto[n:] - upto[:-n]
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own, first = np.unique(all_[lo:max(hi - n + 1, lo)], return_index=True)
        if order is not None and len(own):
            own = own[np.lexsort((weight[lo:hi - n + 1][first], order.shingles[_cell(own, SHINGLES)]))]
        out.append(own)
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)


def _counted(total: np.ndarray) -> tuple[pa.Array, pa.Array]:
    some = np.flatnonzero(total)
    return pa.array(some, pa.int64()), pa.array(total[some], pa.int64())


def word_counts(texts: DataFrame, unit: str = "word") -> DataFrame:
    """(kind 0, cell, c): how many words, or characters, of all texts fall into a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WORDS, np.int64)
        for part in _parts(batches):
            np.add.at(total, _cell(np.asarray(part.column(1).flatten()), WORDS), 1)
        yield pa.RecordBatch.from_arrays(list(_counted(total)), names=["cell", "c"])

    cells = tokens(texts, unit).mapInArrow(run, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c"))
    return cells.select(F.lit(0).alias("kind"), "cell", "c")


def measured(texts: DataFrame, n: int, unit: str = "word") -> tuple[DataFrame, DataFrame]:
    """(id, n, h, h2) of each text with a shingle: the size of its set and two hashes that equal sets share; and
    the rows of an order (kind, cell, c) fitted on all texts (id, text)."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, ids = np.zeros(SHINGLES, np.int64), None
        for part in _parts(batches):
            sets = _sets(part, n)
            flat = np.concatenate(sets)
            np.add.at(total, _cell(flat, SHINGLES), 1)
            some = np.array([i for i, x in enumerate(sets) if len(x)], np.int64)
            size = np.array([len(sets[i]) for i in some], np.int64)
            own = flat.view(np.uint64)
            marks = [np.add.reduceat((own ^ (own >> np.uint64(k))) * np.uint64(m), np.cumsum(size) - size) if len(own) else own
                     for k, m in ((29, 0xBF58476D1CE4E5B9), (31, 0x94D049BB133111EB))]
            ids = part.column(0).type
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(some)), pa.array(size), *(pa.array(x.view(np.int64)) for x in marks),
                                              *(pa.nulls(len(some), pa.int64()) for _ in range(2))], names=["id", "n", "h", "h2", "cell", "c"])
        if ids is not None:
            total[total <= 1 + 2 * total.mean()] = 0                    # common nowhere here: adds little to a common cell
            cell, c = _counted(total)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(cell), ids), *(pa.nulls(len(cell), pa.int64()) for _ in range(3)), cell, c],
                                             names=["id", "n", "h", "h2", "cell", "c"])

    rows = materialise(tokens(texts, unit).mapInArrow(run, f"id {kind}, n long, h long, h2 long, cell long, c long"), "measured")
    cells = rows.filter("c is not null").groupBy("cell").agg(F.sum("c").alias("c"))
    mean = rows.agg((F.coalesce(F.sum("n"), F.lit(0)) / F.lit(SHINGLES)).alias("mean"))        # one row
    hot = cells.join(F.broadcast(mean), F.col("c") > 4 * F.col("mean") + 8).select(F.lit(1).alias("kind"), "cell", "c")
    return rows.filter("c is null").select("id", "n", "h", "h2"), materialise(word_counts(texts, unit).unionByName(hot), "order")


def only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be one of ``ids`` (its first column): all that are, and few others."""
    shared = rows.sparkSession.sparkContext.broadcast(KmerFilter(ids.select(F.xxhash64(ids.columns[0]).alias("kmer")).distinct()))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = shared.value
        for b in batches:
            yield b.filter(pa.array(passes(np.asarray(b.column(b.num_columns - 1))))).select(names)

    return rows.withColumn("_k", F.xxhash64("id")).mapInArrow(run, rows.schema)


def shingle_sets(texts: DataFrame, n: int, unit: str = "word") -> DataFrame:
    """(id, n, set array<long>): the distinct shingles of each text (id, text); texts without any are left out."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sets = _sets(part, n)
            size = np.array([len(x) for x in sets], np.int64)
            at = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), pa.ListArray.from_arrays(at, pa.array(np.concatenate(sets)))], names=["id", "n", "set"])

    return tokens(texts, unit).mapInArrow(run, f"id {kind}, n long, set array<long>").filter("n > 0")


def prefixes(texts: DataFrame, order: DataFrame, percent: int, n: int, unit: str = "word") -> DataFrame:
    """(s, id, n): the prefix of the set of each text (id, text) under an order (kind, cell, c)."""
    kind = texts.schema["id"].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(Order(order))            # bounded, see Order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sets = _sets(part, n, shared.value)
            size = np.array([len(x) for x in sets], np.int64)
            first = np.where(size > 0, size - -(-size * percent // 100) + 1, 0)
            s = np.concatenate([x[:k] for x, k in zip(sets, first.tolist(), strict=True)])
            who = np.repeat(np.arange(len(sets)), first)
            yield pa.RecordBatch.from_arrays([pa.array(s), part.column(0).take(pa.array(who)), pa.array(size[who])], names=["s", "id", "n"])

    return tokens(texts, unit).mapInArrow(run, f"s long, id {kind}, n long").filter("id is not null")


def sizes_allow(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def sketches(texts: DataFrame, n: int, unit: str = "word") -> DataFrame:
    """(id, n, bits array<long>): the odd sketch of the set of each text (id, text) that has a shingle: which of a power
    of two of cells, as many as shingles at least, hold an odd number of them."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            sets = _sets(part, n)
            bits = []
            for x in sets:
                cells = max(64, 1 << (len(x) - 1).bit_length()) if len(x) else 64
                odd = np.bincount(x & np.int64(cells - 1), minlength=cells) & 1
                bits.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
            at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in bits])]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(at, pa.array(np.concatenate(bits)))],
                                             names=["id", "n", "bits"])

    return tokens(texts, unit).mapInArrow(run, f"id {kind}, n long, bits array<long>").filter("n > 0")


def _halved(bits: Column, other: Column) -> Column:
    """A sketch folded to the length of another, where that is half of its own."""
    half = F.size(other)
    return F.when(F.size(bits) > half, F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(bits)


def near(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches (id, n, bits) do not rule out; sizes are within ``sizes_allow``, of half at least."""
    x = left.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    y = right.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    both = pairs.join(x, "a").join(y, "b")
    both = both.select("a", "b", "na", "nb", _halved(F.col("ba"), F.col("bb")).alias("ba"), _halved(F.col("bb"), F.col("ba")).alias("bb"))
    apart = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    kept = (F.size("ba") != F.size("bb")) | ((100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb")))
    return both.filter(kept).select("a", "b").distinct()


def linked(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int, n: int, unit: str = "word") -> DataFrame:
    """The pairs (a, b), written, of texts (id, text), a's in ``left`` and b's in ``right``, that are linked."""
    def of(pairs: DataFrame, made, name: str) -> tuple[DataFrame, DataFrame]:
        if left is right:
            own = materialise(made(only(left, pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))), n, unit), name)
            return own, own
        return made(only(left, pairs.select("a")), n, unit), made(only(right, pairs.select("b")), n, unit)

    some = materialise(near(pairs, *of(pairs, sketches, "sketches"), percent), "near")
    return confirmed(some, *of(some, shingle_sets, "sets"), percent)


def confirmed(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets, a's in ``left`` and b's in ``right``, are linked."""
    x = left.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("set").alias("sa"))
    y = right.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("set").alias("sb"))
    both = pairs.join(x, "a").join(y, "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    return both.filter(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def similar_components(texts: DataFrame, order: DataFrame, percent: int, n: int, unit: str = "word") -> DataFrame:
    """(id, component = smallest id reachable over links) of the texts (id, text) that have a link."""
    own = Window.partitionBy("s")                            # the members of a bucket: counted, not compared
    index = prefixes(texts, order, percent, n, unit).withColumn("m", F.count(F.lit(1)).over(own)).withColumn("_c", F.min(F.struct("id", "n")).over(own))
    buckets = index.filter("m > 1").select("s", "id", "n", "m", F.col("_c.id").alias("center"), F.col("_c.n").alias("nc"))
    buckets = materialise(buckets, "buckets")

    def compared(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        return materialise(linked(materialise(ordered, "pairs"), texts, texts, percent, n, unit), "links")

    found = compared(buckets.filter("id != center").filter(sizes_allow("n", "nc", percent)).select(F.col("id").alias("u"), F.col("center").alias("v")))
    turn = 0
    while True:
        label = star_forest(found, "a", "b")
        now = buckets.filter("m > 2").join(label, "id", "left").select("s", "id", "n", "center", F.coalesce("component", "id").alias("label"))
        now = materialise(now, "labelled")
        pick = F.max_by(F.struct("id", "n"), F.xxhash64("id", "s", F.lit(turn)))
        counts = now.groupBy("s", "label").agg(F.count(F.lit(1)).alias("c"), pick.alias("pick"))
        top = counts.groupBy("s").agg(F.count(F.lit(1)).alias("labels"), F.max_by(F.struct("label", "pick"), F.struct("c", "label")).alias("top"))
        top = top.filter("labels > 1").select("s", F.col("top.label").alias("main"), F.col("top.pick.id").alias("pick"), F.col("top.pick.n").alias("np"))
        rest = materialise(now.join(materialise(top, "open"), "s"), "open-buckets")
        outside = rest.filter("label != main")
        left = outside.select("id").distinct().count()
        if not left:
            return label
        new = compared(outside.filter("pick != center").filter(sizes_allow("n", "np", percent)).select(F.col("id").alias("u"), F.col("pick").alias("v")))
        found, gained, turn = materialise(found.unionByName(new).distinct(), "links"), new.count(), turn + 1
        if gained * 10 < left:
            break
    x, y = outside.alias("x"), rest.alias("y")
    other = (F.col("x.s") == F.col("y.s")) & (F.col("x.label") != F.col("y.label")) & (
        (F.col("y.label") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))) & sizes_allow("x.n", "y.n", percent)
    late = compared(x.join(y, other).select(F.col("x.id").alias("u"), F.col("y.id").alias("v")))
    return star_forest(found.unionByName(late), "a", "b")
