"""Operator 2: near-duplicate documents by MinHash, odd sketches and banded verification.

1. Every text becomes its set of word shingles (64-bit hashes). Documents with equal sets form a
   class, named by its smallest id; the rest of the work is on classes, so copies cost
   nothing more.
2. A class has a MinHash signature. Its samples are folded into an odd sketch: a parity bitmap
   in which every (position, sample) flips one bit. The population count d of two sketches' XOR
   estimates the similarity as 1 + bits / (4 k) * ln(1 - 2 d / bits), most precisely
   when it is high.
3. Bands of the signature are bucket keys. In each bucket all members are compared with
   its smallest one (linear); the links found give components. In buckets that still hold
   several components, the members outside the largest one are compared with one member of
   it, another one in every round and bucket, as long as that connects a good part of them. At
   last those still outside are compared with all members of other components. So
   every pair of a bucket is compared or already connected.
4. A pair whose sketches speak against it (estimate below the threshold by ``MARGIN`` or more) or whose set
   sizes rule it out is dropped. So is one that a second odd sketch, over all shingles of the
   set, excludes: the population count of its XOR never exceeds the number of shingles that
   only one side has, which a link bounds. Every other pair is confirmed on the full sets.

``plan_bands`` picks the bands so that a pair at the threshold shares none with a probability of at
most ``MISS``. Links are exact: none is below the threshold.

Defined results: a null or empty text, or one of white space only, has no shingles and links
with nothing; fewer words than ``words`` form one shingle; a row without id links with nothing and
is kept; every row of the input gives one row, repeated rows alike; where an id is given
to several texts, the classes named by it count as one (``keep_documents`` tells them apart). An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, fresh, materialise, table, text_or_empty
from ortholake.operators.components import star_forest

SKETCH_BITS = 512
SET_BITS = 1024           # of the parity bitmap of the whole set
SAMPLES = 256             # at most
MISS = 1e-5
MARGIN = 0.12
SKETCH_WORDS, SET_WORDS = SKETCH_BITS // 64, SET_BITS // 64
CHUNK_BYTES = 1 << 18     # texts hashed together


def plan_bands(threshold: float, samples: int = SAMPLES, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most rows for which so many bands fit into ``samples``."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-threshold ** rows))
        if bands * rows <= samples:
            return bands, rows
    raise ValueError("threshold too low for so few samples")


def most_bits(threshold: float, samples: int) -> int:
    """Largest XOR population count of a pair that is still verified."""
    low = max(threshold - MARGIN, 0.0)
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * samples * (1 - low) / SKETCH_BITS)))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle sets of texts, hashed in blocks of bytes. A word's hash is a polynomial in a random
    odd base over random values of its bytes (A-Z count as a-z), from running sums."""

    def __init__(self, words: int):
        rng = np.random.default_rng(20)
        self.words = words
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.value[65:91] = self.value[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.base = int(rng.integers(1 << 60, 1 << 63)) | 1
        self.factor = rng.integers(1, 1 << 63, words, dtype=np.uint64) | np.uint64(1)
        self.short = rng.integers(1, 1 << 63, words, dtype=np.uint64) | np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << max(n - 1, 1).bit_length()
            inverse = pow(self.base, -1, 1 << 64)
            for name, b in (("up", self.base), ("down", inverse)):
                p = np.ones(1, np.uint64)
                while len(p) < size:                     # doubling
                    p = np.concatenate([p, p * np.uint64(pow(b, len(p), 1 << 64))])
                setattr(self, name, p)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHUNK_BYTES):
                size += len(texts[stop]) + 1
                stop += 1
            out += self._block(texts[at:stop])
            at = stop
        return out

    def _block(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self._powers(len(raw))
        gap = self.space[raw]
        change = np.flatnonzero(np.diff(np.concatenate([[True], gap])))
        starts, ends = change[0::2], change[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[raw] * self.up[:len(raw)], dtype=np.uint64)])
        word = _mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        k = self.words
        n = len(word) - k + 1
        shingle = np.zeros(max(n, 0), np.uint64)
        for j in range(k):
            shingle += word[j:j + max(n, 0)] * self.factor[j]
        shingle = _mix(shingle)
        limits = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
        sets = []
        for a, b in zip(limits[:-1], limits[1:], strict=True):
            if b - a >= k:
                sets.append(np.unique(shingle[a:b - k + 1]))
            elif b > a:
                sets.append(_mix((word[a:b] * self.short[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
            else:
                sets.append(np.zeros(0, np.uint64))
        return sets


class Sketcher:
    """Signatures, band keys and odd sketches of shingle sets."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(21)
        self.bands, self.rows, k = bands, rows, bands * rows
        self.flip = rng.integers(0, 1 << 32, k, dtype=np.uint32)
        self.times = rng.integers(0, 1 << 32, k, dtype=np.uint32) | np.uint32(1)
        self.row_factor = rng.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)
        self.place = (np.arange(k, dtype=np.uint64) + np.uint64(1)) << np.uint64(32)

    def signature(self, s: np.ndarray) -> np.ndarray:
        x = (s >> np.uint64(32)).astype(np.uint32)[:, None]
        low = np.full(len(self.flip), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 512):
            h = x[i:i + 512] ^ self.flip
            h *= self.times
            np.minimum(low, h.min(axis=0), out=low)
        return low

    def bands_and_bits(self, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, bands) int64 keys and (n, bits / 64) int64 sketch words."""
        s = sigs.astype(np.uint64)
        key = (s.reshape(len(s), self.bands, self.rows) * self.row_factor).sum(axis=2, dtype=np.uint64)
        key = _mix(key + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        bit = _mix(s | self.place) % np.uint64(SKETCH_BITS)
        flat = (bit + np.arange(len(s), dtype=np.uint64)[:, None] * np.uint64(SKETCH_BITS)).astype(np.int64).ravel()
        odd = (np.bincount(flat, minlength=len(s) * SKETCH_BITS) & 1).astype(np.uint8)
        return key.view(np.int64), np.packbits(odd.reshape(len(s), SKETCH_BITS), axis=1).view(np.int64).reshape(len(s), SKETCH_WORDS)


def parity(s: np.ndarray) -> np.ndarray:
    """Odd sketch of a whole set, as int64 words."""
    odd = (np.bincount((s & np.uint64(SET_BITS - 1)).astype(np.int64), minlength=SET_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def estimate(xor_bits: float, samples: int) -> float:
    """Similarity that an odd sketch pair shows."""
    return 1 + SKETCH_BITS / (4 * samples) * math.log(max(1 - 2 * xor_bits / SKETCH_BITS, 1e-9))


# Spark ----------------------------------------------------------------------------------
def features(docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, hi, lo, sketch array<long>, bands array<long>); hi and lo: digest of the set,
    null (as sketch and bands) without shingles."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        cut, sketch = Shingler(words), Sketcher(bands, rows)

        def lists(values: np.ndarray, full: np.ndarray) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum(full * values.shape[1])]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()), mask=pa.array(~full))

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = cut.sets([x.as_py() for x in b.column(1)])
            full = np.array([len(s) > 0 for s in sets])
            some = [s for s in sets if len(s)]
            sigs = np.stack([sketch.signature(s) for s in some]) if some else np.zeros((0, bands * rows), np.uint32)
            key, bits = sketch.bands_and_bits(sigs)
            bits = np.concatenate([bits, np.stack([parity(s) for s in some]) if some else np.zeros((0, SET_BITS // 64), np.int64)], axis=1)
            digest = np.zeros((len(sets), 2), np.int64)
            if some:
                digest[full] = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in some), np.int64).reshape(-1, 2)
            size = pa.array([len(s) for s in sets], pa.int64())
            out = [b.column(0), size, pa.array(digest[:, 0], mask=~full), pa.array(digest[:, 1], mask=~full), lists(bits, full), lists(key, full)]
            return pa.RecordBatch.from_arrays(out, names=["id", "n", "hi", "lo", "sketch", "bands"])

        return work

    rows_ = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    return by_batch(rows_, f"id {kind}, n long, hi long, lo long, sketch array<long>, bands array<long>", make)


def _plausible(a: str, b: str, percent: int, bits: int) -> Column:
    """Sizes and sketches of two sides allow a link. A link has 100 * shared >= percent * all, so
    at most (100 - percent) / (100 + percent) of both sizes together is on one side only."""
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")
    xor = [F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(SKETCH_WORDS + SET_WORDS)]
    total = lambda cols: reduce(lambda x, y: x + y, cols)
    one_sided = (100 + percent) * total(xor[SKETCH_WORDS:]) <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))
    return sizes & one_sided & (total(xor[:SKETCH_WORDS]) <= bits)


def confirm(pairs: DataFrame, docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    # The ids grow with the corpus: never broadcast them, however few they are here.
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text")).join(ids.hint("merge"), "id", "left_semi")
    texts = materialise(texts, "texts")
    j = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")
    kind = pairs.schema["a"].dataType.simpleString()

    def make():
        cut = Shingler(words)

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            ids, (ta, tb) = b.column(0).to_pylist(), (b.column(i).to_pylist() for i in (2, 3))
            keep, last, of = [], None, None
            for i, sb in enumerate(cut.sets(tb)):
                if last != ids[i] or ta[i] != ta[i - 1]:          # rows of one smaller side stand together
                    last, of = ids[i], cut.sets([ta[i]])[0]
                both = np.sort(np.concatenate([of, sb]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared) and len(both) > 0)
            return b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        return work

    return by_batch(j, f"a {kind}, b {kind}", make).distinct()


def link_classes(docs: DataFrame, reps: DataFrame, words: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, component) of the classes that have a link. ``reps``: (id, n, sketch, bands)."""
    bits = most_bits(percent / 100, bands * rows)
    words64 = [F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(SKETCH_WORDS + SET_WORDS)]
    sketches = materialise(reps.select("id", "n", *words64), "sketches")
    banded = materialise(reps.select("id", F.explode("bands").alias("key")), "bands")
    keys = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("center")).filter("m > 1 and center is not null")
    keys = materialise(keys, "keys")
    buckets = materialise(banded.join(keys, "key"), "buckets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among candidate pairs (a, b): first by sketches, then on full sets."""
        x, y = (sketches.select([F.col(c).alias(n if c == "id" else c) for c in sketches.columns]) for n in "ab")
        ok = pairs.join(y.alias("y"), "b").join(x.alias("x"), "a").filter(_plausible("x", "y", percent, bits)).select("a", "b")
        return materialise(confirm(materialise(ok.distinct(), "pairs"), docs, words, percent, id_col, text_col), "links")

    ordered = lambda u, v: [F.least(u, v).alias("a"), F.greatest(u, v).alias("b")]
    found = verified(buckets.filter("id != center").select(*ordered("center", "id")).distinct())
    buckets = materialise(buckets.filter("m > 2"), "larger-buckets")
    turn = 0
    while True:
        # Members of one bucket that are still in different components; main: the largest one.
        comp = materialise(star_forest(found, "a", "b"), "components")
        labelled = buckets.join(comp, "id", "left").select("key", "id", "center", F.coalesce("component", "id").alias("label"))
        labelled = materialise(labelled, "labelled")
        counts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.max_by("id", F.xxhash64("id", "key", F.lit(turn))).alias("pick"))
        main = F.max_by(F.struct("label", "pick"), F.struct("c", "label"))
        open_ = counts.groupBy("key").agg(F.count(F.lit(1)).alias("labels"), main.alias("top")).filter("labels > 1")
        open_ = materialise(open_.select("key", F.col("top.label").alias("main"), F.col("top.pick").alias("pick")), "open")
        rest = materialise(labelled.join(open_, "key"), "open-buckets")
        outside = rest.filter("label != main")
        left = outside.select("id").distinct().count()
        # Another star from a member of the main component, another one in every bucket, as long
        # as that connects a good part of the members outside.
        new = verified(outside.filter("pick != center").select(*ordered("pick", "id")).distinct())
        linked = new.count()
        found = materialise(found.unionByName(new).distinct(), "links")
        if linked * 10 < left or not left:
            break
        turn += 1

    # The last star connected little, so its links need no new labels: a pair that it connected is
    # only compared once more.
    rest = materialise(rest.join(sketches, "id"), "open-buckets")
    x, y = rest.filter("label != main").alias("x"), rest.filter("id != center").alias("y")
    other = (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & (F.col("x.id") != F.col("x.center")) & (
        (F.col("y.label") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))) & _plausible("x", "y", percent, bits)
    more = materialise(x.join(y, other).select(*ordered("x.id", "y.id")).distinct(), "more-pairs")
    late = materialise(confirm(more, docs, words, percent, id_col, text_col), "more-links")
    return materialise(star_forest(found.unionByName(late), "a", "b"), "components")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``; documents are linked
    where their sets of ``words``-word shingles have 100 * intersection >= percent * union."""
    bands, rows = plan_bands(percent / 100)
    feats = materialise(features(docs, words, bands, rows, id_col, text_col), "features")
    named = feats.filter("n > 0 and id is not null")
    classes = materialise(named.groupBy("hi", "lo").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    joined = named.join(classes, ["hi", "lo"])
    reps = materialise(joined.filter("id = rep").dropDuplicates(["id", "hi", "lo"]).select("id", "n", "sketch", "bands"), "reps")
    comp = link_classes(docs, reps, words, percent, bands, rows, id_col, text_col)
    member = materialise(joined.filter("copies > 1").select("id", "n", "rep").unionByName(
        joined.filter("copies = 1").select("id", "n", "rep")), "members")
    out = member.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "id", "n", F.coalesce("component", "rep").alias("component_id"))
    alone = feats.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    out = out.unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id. Rows are told apart by
    a key of their own, so several texts under one id are judged each by itself, and a row
    goes only if a row of its own group stays. Rows without id stay."""
    own = docs.columns
    key = fresh("_key", own)
    keyed = materialise(docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "keyed")
    flags = materialise(near_duplicates(keyed.select(key, "text"), words, percent, id_col=key).select(F.col(key).alias("k"), "component_id", "kept"), "flags")
    groups = materialise(flags.filter(~F.col("kept")).select("component_id").distinct(), "groups")
    rows = flags.join(groups, "component_id").join(keyed.select(F.col(key).alias("k"), F.col("doc_id").alias("id")), "k")
    rows = materialise(rows.select("k", "id", "component_id"), "grouped")
    low = materialise(rows.groupBy("component_id").agg(F.min("id").alias("low")), "low")
    stay = rows.join(low, "component_id").filter("id = low").groupBy("component_id").agg(F.min("k").alias("stay"))
    gone = rows.join(materialise(stay, "stay"), "component_id").filter("k != stay").select(F.col("k").alias(key))
    return keyed.join(materialise(gone, "dropped"), key, "left_anti").select(*own)


def op2_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
g AS MATERIALIZED (SELECT doc_id, hash(x) AS x FROM (SELECT doc_id, unnest(sh) AS x FROM s)),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, root AS component_id, doc_id = root AS kept FROM n JOIN c ON c.id = doc_id"""
