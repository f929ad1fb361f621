"""Small building blocks shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

IdsArg = "str | Iterable[str] | DataFrame | None"


def id_filter(df: DataFrame, col: str, ids, id_col: str | None = None) -> DataFrame:
    """Restrict ``df`` to rows whose ``col`` is among ``ids``.

    * ``None``          -> no restriction (whole table);
    * a string / list   -> literal ``IN`` filter, pushed down to the Parquet scan;
    * a DataFrame       -> left-semi join on its (first or ``id_col``) column; the planner
                           broadcasts it only when its runtime size is under the threshold.
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        c = id_col or ids.columns[0]
        keys = ids.select(F.col(c).alias("__id")).distinct()
        return df.join(keys, df[col] == keys["__id"], "left_semi")
    if isinstance(ids, str):
        return df.filter(F.col(col) == F.lit(ids))
    vals = list(ids)
    return df.filter(F.col(col).isin(vals))


def probe_ids(sequences: DataFrame, k: int = 3) -> DataFrame:
    """The k longest sequences (ties by id): a data-derived id set for lookup queries.

    Runs as a top-k (TakeOrderedAndProject), so it never sorts the table."""
    return sequences.orderBy(F.col("length").desc(), F.col("seqhash_id")).limit(k).select("seqhash_id")


PROBE_IDS_SQL = "(SELECT seqhash_id FROM sequences ORDER BY length DESC, seqhash_id LIMIT 3)"


def count_rows(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def flag(c: Column) -> Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def empty_ids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField("seqhash_id", T.StringType())]))


MEDIAN_BUCKETS = 1 << 16
MEDIAN_BRACKET = [0.499, 0.501]       # ranks around the middle, and the sketch's accuracy
MEDIAN_ACCURACY = 10_000


def exact_median(df: DataFrame, col: str, out: str = "median") -> DataFrame:
    """Exact (interpolated) median of ``col`` as a one-row frame, without sending all values
    to one task.

    1. one-row stats: n, and a bracket of the middle from a quantile sketch, so that outliers
    do not widen the buckets; 2. an equal-width histogram of the bracket, with a bucket for all
    values below and one for all above it (exact even where the sketch is off), whose running
    count finds the one or two buckets holding the middle ranks; 3. only those buckets' rows
    are ranked, after collapsing equal values, so a hot value cannot inflate the ranking step.
    NULLs are ignored; an empty input gives NULL."""
    x = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    middle = F.percentile_approx("x", MEDIAN_BRACKET, MEDIAN_ACCURACY)
    stats = x.agg(F.count(F.lit(1)).alias("n"), middle.alias("m"))
    stats = stats.select("n", F.get("m", F.lit(0)).alias("lo"), F.get("m", F.lit(1)).alias("hi"), F.lit(1).alias("_k"))
    span = F.col("hi") - F.col("lo")
    bucket = F.when(F.col("x") < F.col("lo"), F.lit(-1)).when(F.col("x") > F.col("hi"), F.lit(MEDIAN_BUCKETS))
    bucket = bucket.when(span > 0, F.least(F.floor((F.col("x") - F.col("lo")) / span * MEDIAN_BUCKETS),
                                      F.lit(MEDIAN_BUCKETS - 1))).otherwise(F.lit(0)).cast("long")
    # one-row stats frame: a proven size bound for the broadcast
    xb = x.withColumn("_k", F.lit(1)).join(F.broadcast(stats), "_k").withColumn("b", bucket)
    k1 = F.floor((F.col("n") - 1) / 2)          # 0-based middle ranks
    k2 = F.floor(F.col("n") / 2)
    hist = xb.groupBy("b").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    # at most MEDIAN_BUCKETS + 2 rows: the running count below runs over a bounded frame
    hist = hist.withColumn("cum", F.sum("c").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
    hist = hist.withColumn("start", F.col("cum") - F.col("c"))
    covers = lambda k: (F.col("start") <= k) & (k < F.col("cum"))
    targets = hist.filter(covers(k1) | covers(k2)).select("b", "start")       # at most two rows
    vals = xb.join(F.broadcast(targets), "b").groupBy("b", "start", "n", "x").agg(F.count(F.lit(1)).alias("cx"))
    wv = Window.partitionBy("b").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    vals = vals.withColumn("vcum", F.col("start") + F.sum("cx").over(wv)).withColumn("vstart", F.col("vcum") - F.col("cx"))
    hit = lambda k: (F.col("vstart") <= k) & (k < F.col("vcum"))
    picked = vals.agg(F.max(F.when(hit(k1), F.col("x"))).alias("v1"), F.max(F.when(hit(k2), F.col("x"))).alias("v2"))
    return picked.select(((F.col("v1") + F.col("v2")) / 2).alias(out))
