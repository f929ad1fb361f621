"""Operator 3: embedding near-duplicates by E8 lattice hashing.

A vector is projected at random to ``TABLES`` x ``BLOCKS`` blocks of 8 numbers. Each block is
decoded to its nearest point of the E8 lattice, and the points of a table's blocks form the
vector's cell there. A vector also probes, in every table, the cells that result when one
block moves to one of its ``PROBES`` next-nearest lattice points. Two vectors are
candidates where one probes or shares the home cell of the other, and candidates are verified
by cosine in double precision.

Crowded places are handled by balls, without loss: vectors of one home cell (of the first
table) that lie within half the link angle of the cell's mean direction are linked to one
another for certain, by the triangle inequality. So candidates are pairs of balls (most
hold one vector). For two balls, centre angle and radii decide whether all pairs
are linked, none, or neither is sure; only in the last case are members compared with the
other centre, and only what is still unsure, member with member. Link counts are sums over these
decisions, so a group of near copies is counted in full without listing its pairs.

Vectors are compared only when their labels are equal and not null and their lengths agree.
Recall of the probing is measured against brute force in the tests (and in the README).

Defined results: a vector that is null, zero, or holds a null or non-finite number, or whose label
is null, links with nothing. Where rows repeat a vec_id, the smallest (label, vector)
counts, and one row is returned; rows without an id are each their own and are kept.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, materialise, table
from ortholake.operators.components import star_forest

COSINE = 0.93
TABLES, BLOCKS, PROBES = 7, 3, 6
SCALE = 2.2          # projected unit vectors are divided by it: the lattice's cell size
ROUNDING = 1e-6      # angles this near a limit are decided by members


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of the lattice, from the two rules that define them: two
    coordinates of 1 or -1, or all of 1/2 or -1/2 with an even number of minus signs."""
    rows = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            rows.append(v)
    rows += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if np.prod(s) > 0]
    return np.array(rows)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest point with whole coordinates and an even sum, row by row."""
    f = np.rint(y)
    off = y - f
    worst = np.abs(off).argmax(axis=1)
    odd = np.flatnonzero(f.sum(axis=1).astype(np.int64) & 1)
    f[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1.0, -1.0)
    return f


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest lattice point: of D8, or of D8 shifted by 1/2."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    nearer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


class Lattice:
    """Cells of unit vectors of one length."""

    def __init__(self, dim: int):
        rng = np.random.default_rng([8, dim])
        self.project = rng.normal(size=(dim, TABLES * BLOCKS * 8)) / SCALE
        self.roots = e8_roots()
        self.mix = rng.integers(1, 1 << 63, (TABLES, BLOCKS, 8), dtype=np.uint64) | np.uint64(1)

    def cells(self, x: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home keys (n, TABLES) and probe keys (n, TABLES * BLOCKS * PROBES); ``salt`` keeps the
        cells of different labels apart."""
        n = len(x)
        y = (x @ self.project).reshape(n, TABLES, BLOCKS, 8)
        flat = y.reshape(-1, 8)
        home = nearest_e8(flat)
        score = (flat - home) @ self.roots.T                       # larger: the neighbour is nearer
        top = np.argpartition(-score, PROBES, axis=1)[:, :PROBES]

        def digest(points: np.ndarray, mix: np.ndarray) -> np.ndarray:
            return ((2 * points).astype(np.int64).astype(np.uint64) * mix).sum(axis=-1, dtype=np.uint64)

        block = digest(home.reshape(n, TABLES, BLOCKS, 8), self.mix)
        moved = home.reshape(n, TABLES, BLOCKS, 1, 8) + self.roots[top].reshape(n, TABLES, BLOCKS, PROBES, 8)
        step = digest(moved, self.mix[:, :, None, :]) - block[..., None]
        total = block.sum(axis=2, dtype=np.uint64)
        tag = salt[:, None] + np.arange(TABLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        homes = _finish(total + tag)
        probes = _finish((total[:, :, None, None] + step) + tag[:, :, None, None])
        return homes.view(np.int64), probes.reshape(n, -1).view(np.int64)


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1 in double precision, or None if it cannot be compared."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.asarray(values, float)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


# Spark ----------------------------------------------------------------------------------
def hashed(vectors: DataFrame) -> DataFrame:
    """(id, label, x array<double>, homes array<long>, probes array<long>) of the comparable
    vectors. ``vectors``: (id, label long, v)."""
    names = ["id", "label", "x", "homes", "probes"]
    kind = vectors.schema["id"].dataType.simpleString()

    def make():
        lattices: dict[int, Lattice] = {}

        def rows_of(a: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            units = [unit(v) for v in b.column(2).to_pylist()]
            dims = np.array([0 if u is None else len(u) for u in units])
            parts = []
            for d in np.unique(dims[dims > 0]):
                at = np.flatnonzero(dims == d)
                label = np.array(b.column(1).take(pa.array(at)).to_pylist(), np.int64)
                salt = _finish(label.astype(np.uint64) * np.uint64(2 * int(d) + 1) + np.uint64(int(d)))
                x = np.stack([units[i] for i in at])
                homes, probes = lattices.setdefault(int(d), Lattice(int(d))).cells(x, salt)
                parts.append(pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), rows_of(x), rows_of(homes), rows_of(probes)], names=names))
            if not parts:
                schema = pa.schema([("id", b.schema.field(0).type), ("label", pa.int64()), ("x", pa.list_(pa.float64())), ("homes", pa.list_(pa.int64())), ("probes", pa.list_(pa.int64()))])
                return pa.RecordBatch.from_pylist([], schema=schema)
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        return work

    return by_batch(vectors, f"id {kind}, label long, x array<double>, homes array<long>, probes array<long>", make)


def _matrix(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0] + [len(v) for v in column])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def with_dot(df: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """``df`` without the two vector columns, with their dot product (null if lengths differ)."""
    rest = [c for c in df.columns if c not in (left, right)]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest) + f", {out} double"

    def make():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            xs, ys = _matrix(b.column(len(rest))), _matrix(b.column(len(rest) + 1))
            dots = [float(x @ y) if len(x) == len(y) else None for x, y in zip(xs, ys, strict=True)]
            return pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(dots, pa.float64())], names=[*rest, out])

        return work

    return by_batch(df.select(*rest, left, right), schema, make)


def form_balls(h: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Members (id, ball, x) and balls (ball, label, size, radius, c): a ball is named by its
    smallest member and holds vectors within half the link angle of its centre."""
    half = float(np.arccos(cosine)) / 2 - ROUNDING
    cell = h.select("id", "label", "x", F.get("homes", F.lit(0)).alias("cell"))
    counts = cell.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialise(cell.join(materialise(counts, "cells").select("cell"), "cell"), "shared")
    mean = shared.select("cell", F.posexplode("x").alias("i", "v")).groupBy("cell", "i").agg(F.sum("v").alias("v"))
    mean = mean.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("m"))       # as many rows as a vector has numbers
    norm = F.sqrt(F.aggregate("m", F.lit(0.0), lambda a, t: a + t["v"] * t["v"]))
    centre = mean.withColumn("_n", norm).filter("_n > 0").select("cell", F.transform("m", lambda t: t["v"] / F.col("_n")).alias("c"))
    centre = materialise(centre, "centres")
    near = with_dot(shared.join(centre, "cell").select("id", "cell", "x", "c"), "x", "c", "dot")
    inside = near.withColumn("angle", F.acos(F.least(F.col("dot"), F.lit(1.0)))).filter(F.col("angle") <= half)
    inside = materialise(inside.select("id", "cell", "angle"), "inside")
    ball = inside.groupBy("cell").agg(F.min("id").alias("ball"), F.count(F.lit(1)).alias("size"), F.max("angle").alias("radius")).filter("size > 1")
    ball = materialise(ball, "balls")
    of = inside.join(ball.select("cell", "ball"), "cell").select("id", "ball")
    members = materialise(h.join(of, "id", "left").select("id", "label", F.coalesce("ball", "id").alias("ball"), "x", "homes", "probes", F.col("ball").isNull().alias("alone")), "members")
    big = ball.join(centre, "cell").join(members.select(F.col("id").alias("ball"), "label"), "ball").select("ball", "label", "size", "radius", "c")
    single = members.filter("alone").select("ball", "label", F.lit(1).cast("long").alias("size"), F.lit(0.0).alias("radius"), F.col("x").alias("c"))
    return members, materialise(big.unionByName(single), "all-balls")


def candidate_balls(members: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of balls of which one probes or shares a home cell of the other."""
    homes = materialise(members.select("ball", F.explode("homes").alias("key")).distinct(), "homes")
    probes = materialise(members.select("ball", F.explode("probes").alias("key")).distinct(), "probes")
    h = homes.select(F.col("ball").alias("o"), "key")
    same = homes.join(h, "key").filter("ball < o").select(F.col("ball").alias("a"), F.col("o").alias("b"))
    cross = probes.join(h, "key").filter("ball != o").select(F.least("ball", "o").alias("a"), F.greatest("ball", "o").alias("b"))
    return materialise(same.unionByName(cross).distinct(), "candidates")


def links(vectors: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, edges between balls, link counts (id or ball, n)): see the module's text."""
    limit = float(np.arccos(cosine))
    h = materialise(hashed(vectors), "hashed")
    members, balls = form_balls(h, cosine)
    side = lambda n: balls.select(F.col("ball").alias(n), F.col("label").alias(f"label_{n}"), F.col("size").alias(f"size_{n}"), F.col("radius").alias(f"r_{n}"), F.col("c").alias(f"c_{n}"))
    p = candidate_balls(members).join(side("a"), "a").join(side("b"), "b").filter("label_a = label_b").drop("label_a", "label_b")
    p = with_dot(p, "c_a", "c_b", "dot").filter("dot is not null")
    angle = lambda c: F.acos(F.greatest(F.least(F.col(c), F.lit(1.0)), F.lit(-1.0)))
    reach = F.col("r_a") + F.col("r_b")
    both_single = (F.col("size_a") == 1) & (F.col("size_b") == 1)
    verdict = (F.when(both_single, F.when(F.col("dot") >= cosine, "all").otherwise("none"))
               .when(angle("dot") + reach <= limit - ROUNDING, "all").when(angle("dot") - reach > limit + ROUNDING, "none").otherwise("unsure"))
    p = materialise(p.withColumn("verdict", verdict).filter("verdict != 'none'").drop("dot"), "pairs")
    sure = p.filter("verdict = 'all'")

    # Members of the ball with the smaller name against the centre of the other.
    unsure = p.filter("verdict = 'unsure'").select("a", "b", "size_b", "r_b")
    m = members.select(F.col("ball").alias("a"), F.col("id").alias("v"), "x")
    one = unsure.join(m, "a").join(balls.select(F.col("ball").alias("b"), "c"), "b").select("a", "b", "size_b", "r_b", "v", "x", "c")
    one = with_dot(one, "x", "c", "dot")
    verdict = (F.when(F.col("size_b") == 1, F.when(F.col("dot") >= cosine, "all").otherwise("none"))
               .when(angle("dot") + F.col("r_b") <= limit - ROUNDING, "all").when(angle("dot") - F.col("r_b") > limit + ROUNDING, "none").otherwise("unsure"))
    one = materialise(one.withColumn("verdict", verdict).filter("verdict != 'none'").drop("dot"), "members-to-balls")
    near = one.filter("verdict = 'all'")

    # What is still unsure: member with member.
    last = one.filter("verdict = 'unsure'").select("a", "b", "v").join(members.select(F.col("id").alias("v"), "x"), "v")
    last = last.join(members.select(F.col("ball").alias("b"), F.col("id").alias("w"), F.col("x").alias("y")), "b").select("a", "b", "v", "w", "x", "y")
    last = materialise(with_dot(last, "x", "y", "dot").filter(F.col("dot") >= cosine), "members-to-members")

    by_ball = [sure.select(F.col("a").alias("ball"), F.col("size_b").alias("n")), sure.select(F.col("b").alias("ball"), F.col("size_a").alias("n")),
               near.groupBy("b").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("b", "ball"), balls.select("ball", (F.col("size") - 1).alias("n"))]
    by_vector = [near.select("v", F.col("size_b").alias("n")), last.select("v", F.lit(1).cast("long").alias("n")), last.select(F.col("w").alias("v"), F.lit(1).cast("long").alias("n"))]
    add = lambda frames, key: materialise(_union(frames).groupBy(key).agg(F.sum("n").alias("n")), "counts")
    balls_n, vectors_n = add(by_ball, "ball"), add(by_vector, "v")
    counted = members.select("id", "ball").join(balls_n, "ball").join(vectors_n.select(F.col("v").alias("id"), F.col("n").alias("n2")), "id", "left")
    counted = counted.select("id", "ball", (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n_links"))
    edges = _union([x.select("a", "b") for x in (sure, near, last)]).distinct()
    return members, edges, counted


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def near_duplicates(table_: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id, kept), one row per vector."""
    rows = table_.select(F.col(id_col).alias("id"), F.struct(F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("v")).alias("s"))
    one = materialise(rows.filter("id is not null").groupBy("id").agg(F.min("s").alias("s")).select("id", "s.label", "s.v"), "vectors")
    _, edges, counted = links(one.filter("label is not null and v is not null"), cosine)
    comp = star_forest(edges, "a", "b")
    joined = one.select("id").join(counted, "id", "left").join(comp.select(F.col("id").alias("ball"), "component"), "ball", "left")
    out = joined.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "ball", "id").alias("component_id"))
    nameless = rows.filter("id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(nameless)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id),
n AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, root AS component_id, vec_id = root AS kept
FROM v JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id"""
