"""Operator 1: quality classifier by co-training on two views of a document.

Views: the text (shares of byte-class pairs, distinct words, and a few surface rates of the
whole text) and the page metadata (language, source, length). One logistic regression per
view is fitted on labelled rows. In each of ``ROUNDS`` rounds each view scores all unlabelled
documents, and those it is sure of (``CONFIDENT``) become pseudo-labelled rows of the other view,
which is then refitted; all pseudo-labels of a class weigh at most as much as the labelled rows
of that class. In the end each view is calibrated (Platt scaling on labelled rows that neither view
was fitted on), and a document's score adds the two views' calibrated log-odds, less the
prior's counted twice. Every document of the table is scored on its whole text.

The unlabelled side is not sampled: feature moments, gradients and curvatures are sums over all
unlabelled rows, taken in Spark. Only the labelled rows are a bounded sample: at most
``MAX_LABELLED`` of those in the table, with the smallest seeded hash of their id. Their
features (under 200 numbers each) are the only rows that reach the driver. Labels, prior and
scores beyond that cover all rows. Unlabelled rows without an id take no part in fitting, and
repeated ones count each.

Defined results: a null text counts as empty, null language, source or length as a value of
their own; a document without features differs from none and gets the prior; labels that are null or
contradict one another for an id are not used; an id with several texts counts once as a labelled row
(smallest features); with fewer than two classes among the labels
nothing can be learnt, every score is the share of good labels (1 without labels) and all
documents are kept. Rows are scored one by one, so repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, materialise, slices, table, text_or_empty

MAX_LABELLED = 12_000
ROUNDS = 3
STEPS = 2                # steps of a view's refit in a round, each one pass over the unlabelled rows
PARTS = 16               # partial sums of such a pass that reach the driver
CONFIDENT = 0.95         # least probability of a pseudo-label
RIDGE = 1.0
KEEP_FROM = 0.5
SEED = 11

#: Byte classes of the text view, in order of their number.
CLASSES = ["other control", "space", "newline", "lower", "upper", "digit", ".", ",", "!?", "other sentence marks", "quotes", "brackets",
           "#*$%&", "|<>", "other ASCII marks", "outside ASCII"]
SOURCE_DIMS, LENGTH_DIMS = 24, 16


def _classes() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[32], t[10] = 1, 2
    t[97:123], t[65:91], t[48:58] = 3, 4, 5
    t[128:] = 15
    for number, chars in ((6, "."), (7, ","), (8, "!?"), (9, ";:-"), (10, "\"'`"), (11, "()[]{}"), (12, "#*$%&"), (13, "|<>"), (14, "+/=@\\^_~")):
        t[[ord(c) for c in chars]] = number
    return t


CLASS_OF = _classes()
N_CLASSES = len(CLASSES)


def text_features(text: str) -> np.ndarray:
    """Features of one text: square roots of the shares of neighbouring byte-class pairs (in
    upper triangle order, either order of a pair counts as one), then surface rates."""
    raw = np.frombuffer(text.encode(), np.uint8)
    k = CLASS_OF[raw]
    pairs = np.bincount(k[:-1].astype(np.intp) * N_CLASSES + k[1:], minlength=N_CLASSES * N_CLASSES).astype(float) if len(k) > 1 else np.zeros(N_CLASSES**2)
    both = pairs.reshape(N_CLASSES, N_CLASSES)
    both = (both + both.T)[np.triu_indices(N_CLASSES)]
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    mean = sum(map(len, words)) / n
    rates = [len(set(words)) / n * min(1.0, n / 50), len(set(words)) / n, same / n, len(set(lines)) / max(len(lines), 1), min(mean, 30) / 10,
             np.log1p(len(words)) / 10, float(not words)]
    return np.concatenate([np.sqrt(both / max(both.sum(), 1.0)), rates]).astype(np.float32)


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed language and source, and the length as log and as one of ``LENGTH_DIMS`` steps."""
    from zlib import crc32

    out = np.zeros(8 + SOURCE_DIMS + LENGTH_DIMS + 1, np.float32)
    out[crc32(b"lang:" + str(lang).encode()) % 8] = 1
    out[8 + crc32(b"source:" + str(source).encode()) % SOURCE_DIMS] = 1
    size = np.log2(1 + max(n_chars or 0, 0))
    out[8 + SOURCE_DIMS + min(int(size), LENGTH_DIMS - 1)] = 1
    out[-1] = size / 20
    return out


N_TEXT = len(text_features(""))
N_META = len(meta_features(None, None, None))


# Models ---------------------------------------------------------------------------------
def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class View:
    """Logistic regression on standardised features, fitted by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray = field(default=None)
    platt: tuple[float, float] = (1.0, 0.0)

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(z), 1))], 1)

    def penalty(self) -> np.ndarray:
        return np.append(np.full(len(self.mean), RIDGE), 1e-3)

    def fit(self, x: np.ndarray, y: np.ndarray) -> View:
        d = self._design(x)
        penalty = self.penalty()
        w = np.zeros(d.shape[1])
        for _ in range(12):
            p = _sigmoid(d @ w)
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + np.diag(penalty), d.T @ (p - y) + penalty * w)
            w -= step
            if np.abs(step).max() < 1e-5:
                break
        self.weights = w
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._design(x) @ self.weights

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> View:
        """Platt scaling: a slope (not negative) and an offset, with smoothed targets."""
        z, target = self.raw(x), np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))

        def loss(a: float, b: float) -> float:
            t = np.clip(a * z + b, -500, 500)
            return float((np.logaddexp(0, t) - target * t).sum() + 0.5e-2 * (a - 1) ** 2)

        a, b = 1.0, 0.0
        for _ in range(60):
            p = _sigmoid(a * z + b)
            s = p * (1 - p) + 1e-9
            g = np.array([((p - target) * z).sum() + 1e-2 * (a - 1), (p - target).sum()])
            h = np.array([[(s * z * z).sum() + 1e-2, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
            da, db = np.linalg.solve(h, g)
            size = 1.0
            while size > 1e-6 and loss(a - size * da, b - size * db) > loss(a, b):
                size /= 2                                  # a Newton step may overshoot on separable rows
            if size <= 1e-6:
                break
            a, b = a - size * da, b - size * db
        self.platt = (max(float(a), 0.0), float(b))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.platt[0] * self.raw(x) + self.platt[1]


@dataclass
class CoTrained:
    """The calibrated views and the prior log-odds; ``constant`` where nothing was learnt."""

    text: View | None = None
    meta: View | None = None
    prior: float = 0.0
    constant: float | None = None
    pseudo: tuple[int, int] = (0, 0)

    def scores(self, xt: np.ndarray, xm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.constant is not None:
            c = np.full(len(xt), self.constant)
            return c, c, c
        a, b = self.text.log_odds(xt), self.meta.log_odds(xm)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior)


def _slope(d: np.ndarray, y: float | np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows, gradient and curvature (upper triangle) of the logistic loss, as one vector. The
    curvature is that of Jaakkola's quadratic upper bound, so that no step overshoots."""
    z = d @ w
    p = _sigmoid(z)
    flat = np.abs(z) < 1e-4
    curve = np.where(flat, 0.25, (p - 0.5) / np.where(flat, 1.0, z))
    return np.concatenate([[len(d)], d.T @ (p - y), ((d * curve[:, None]).T @ d)[np.triu_indices(len(w))]])


def _split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, :N_TEXT], x[:, N_TEXT:]


def moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def handed(views: list[View], sure: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """For either view and class: ``_slope`` over the rows that the other view, with its weights
    ``sure``, hands over as of that class."""
    d = [view._design(part) for view, part in zip(views, _split(x), strict=True)]
    out = []
    for v in (0, 1):
        p = _sigmoid(d[1 - v] @ sure[1 - v])
        for label, known in ((0.0, 1 - p), (1.0, p)):
            out.append(_slope(d[v][known >= CONFIDENT], label, views[v].weights))
    return np.concatenate(out)


def co_train(x: np.ndarray, y: np.ndarray, over_pool, share: float, rounds: int = ROUNDS, steps: int = STEPS) -> CoTrained:
    """Fit both views on labelled rows (y 0 or 1) and the unlabelled ones. ``over_pool(f)``: the sum
    of f over blocks of unlabelled rows, None without any. ``share``: good labels among all. Every
    fifth labelled row is held out for calibration."""
    held = np.arange(len(y)) % 5 == 4
    if min(np.bincount(y[~held].astype(int), minlength=2)) == 0:
        return CoTrained(constant=share)
    if min(np.bincount(y[held].astype(int), minlength=2)) == 0:
        held = np.zeros(len(y), bool)                   # too few rows to hold any out
    yl, xl = y[~held].astype(float), _split(x[~held])
    pool = over_pool(moments)
    total = moments(x) + (pool if pool is not None else 0)
    mean, square = np.split(total[1:] / total[0], 2)
    scale = np.maximum(np.sqrt(np.maximum(square - mean * mean, 0)), 1e-3)
    views = [View(*v).fit(a, yl) for v, a in zip(((mean[:N_TEXT], scale[:N_TEXT]), (mean[N_TEXT:], scale[N_TEXT:])), xl, strict=True)]
    pseudo = [0, 0]
    for _ in range(rounds if pool is not None else 0):
        sure = [v.weights for v in views]
        for _ in range(steps):
            got = over_pool(partial(handed, views, sure))
            for v, view in enumerate(views):
                n = len(view.weights)
                one, got = np.split(got, [2 * (1 + n + n * (n + 1) // 2)])
                whole = _slope(view._design(xl[v]), yl, view.weights)
                pseudo[v] = 0
                for label, part in enumerate(np.split(one, 2)):
                    pseudo[v] += int(part[0])
                    whole = whole + part * min(1.0, (yl == label).sum() / max(part[0], 1.0))
                h = np.zeros((n, n))
                h[np.triu_indices(n)] = whole[1 + n:]
                h = h + np.triu(h, 1).T
                view.weights = view.weights - np.linalg.solve(h + np.diag(view.penalty()), whole[1:1 + n] + view.penalty() * view.weights)
    check = held if held.any() else np.ones(len(y), bool)
    for view, a in zip(views, _split(x[check]), strict=True):
        view.calibrate(a, y[check].astype(float))
    return CoTrained(*views, prior=float(np.log(share / (1 - share))), pseudo=(pseudo[0], pseudo[1]))


# Spark ----------------------------------------------------------------------------------
INPUT = ["text", "lang", "source", "n_chars"]


def _inputs(docs: DataFrame) -> list:
    return [text_or_empty("text").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
            F.col("n_chars").cast("long").alias("n_chars")]


def _features(b: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source, size = (b.column(first + i).to_pylist() for i in range(4))
    return np.stack([text_features(t) for t in text]), np.stack([meta_features(*x) for x in zip(lang, source, size, strict=True)])


def clean_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label 0 or 1) of the ids whose labels agree."""
    lab = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min(label_col).alias("lo"), F.max(label_col).alias("hi")).filter("lo = hi").select(id_col, (F.col("lo") > 0).cast("int").alias("label"))
    return materialise(lab, "labels")


def packed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The first columns ``keep`` of ``rows`` and x, the features of the inputs that follow them."""
    kinds = dict(rows.dtypes)
    k = len(keep)

    def make():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            x = [np.concatenate(v).tobytes() for v in zip(*_features(b, k), strict=True)]
            return pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(x, pa.binary())], names=[*keep, "x"])

        return work

    return by_batch(rows, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", x binary", make)


def _numbers(x: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_pylist()), kind).reshape(len(x), -1).astype(float)


def sum_over(pool: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum of f over blocks of the rows of ``pool`` (x): within each task, then in ``PARTS`` tasks
    over those sums, of which the driver adds the rest."""

    def adder(part: Callable[[pa.RecordBatch], np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for lo, n in slices(b):
                    v = part(b.column(0).slice(lo, n))
                    total = v if total is None else total + v
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["x"])

        return run

    each = pool.mapInArrow(adder(lambda x: f(_numbers(x, np.float32))), "x binary")
    few = each.repartition(PARTS).mapInArrow(adder(lambda x: _numbers(x, np.float64).sum(0)), "x binary")
    got = few.toArrow().column("x").combine_chunks()
    return _numbers(got, np.float64).sum(0) if len(got) else None


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> CoTrained:
    lab = clean_labels(labels, id_col, label_col)
    share = lab.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        return CoTrained(constant=1.0 if share is None else share)
    there = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("key"), *_inputs(docs))
    lab = lab.withColumnRenamed(id_col, "key")
    draw = F.xxhash64(F.lit(SEED), F.col("key").cast("string"))
    known = materialise(lab.join(there.select("key"), "key", "left_semi").orderBy(draw, "key").limit(MAX_LABELLED), "sample")
    # At most MAX_LABELLED ids: a proven bound. Repeated ids count once, by smallest features.
    picked = packed(there.join(F.broadcast(known), "key").select("key", "label", *INPUT), ["key", "label"])
    got = picked.groupBy("key").agg(F.min("label").alias("label"), F.min("x").alias("x")).toArrow().sort_by("key")
    label = np.array(got.column("label").to_pylist(), int)
    if len(np.unique(label)) < 2:
        return CoTrained(constant=share)
    x = _numbers(got.column("x").combine_chunks(), np.float32)
    order = np.random.default_rng(SEED).permutation(len(label))
    pool = materialise(packed(there, ["key"]).join(lab.select("key"), "key", "left_anti").select("x"), "pool")
    return co_train(x[order], label[order], partial(sum_over, pool), share)


def score(docs: DataFrame, model: CoTrained, id_col: str = "doc_id") -> DataFrame:
    """(id, p_text, p_meta, score, kept) for each row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            p = [np.round(v, 6) for v in model.scores(*_features(b, 1))]
            return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, p), pa.array(p[2] >= KEEP_FROM)], names=["id", "p_text", "p_meta", "score", "kept"])

        return work

    rows = docs.select(F.col(id_col).alias("id"), *_inputs(docs))
    return by_batch(rows, f"id {kind}, p_text double, p_meta double, score double, kept boolean", make).withColumnRenamed("id", id_col)


def keep_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns. Only the four inputs
    of a row are sent to Python, once; its columns stay where they are."""
    model = train(docs, labels, id_col)
    if model.constant is not None:
        return docs

    @F.arrow_udf("boolean")
    def keep(text: pa.Array, lang: pa.Array, source: pa.Array, size: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([text, lang, source, size], names=INPUT)
        parts = [model.scores(*_features(whole.slice(lo, n), 0))[2].round(6) >= KEEP_FROM for lo, n in slices(whole)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return docs.filter(keep(*_inputs(docs)))


def op1_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
