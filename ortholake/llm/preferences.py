"""Operator 5: preference formatting of chat conversations, in DataFrame functions only.

``format_pairs`` takes pairs of conversations (chosen, rejected). For each pair it finds the
longest common prefix of turns, renders it once as the prompt, and renders what is left of
either conversation as its completion, with the character spans that are trained on (the
texts of assistant turns and their end mark; other turns of a completion are masked out).

A table of turns names no pairs, so ``with_rejected`` gives every conversation that has an
assistant turn a rejected side: the same turns with the last assistant answer replaced by
that of the next conversation on a ring, which holds all such conversations in the order of the MD5 of
their ids. The ring is laid out in ranges of that order; the last conversation of a range finds the next
range's first one through a table of one row per range. A conversation without an assistant turn, or alone on the
ring, has no rejected side: its prompt is all before its last turn, and rejected is null.

``pair_conversations`` pairs conversations that are alternatives to each other as they stand:
those that open with the same turn, in the order of their ids, first within ``SALTS``
groups by hash, then the one left over of each group; so no opening, however common, is
ranked in one task. Of a pair, the conversation with more assistant text is the chosen one,
ties by the smaller id.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.

Defined results: a null text or role is the empty string; rows without a conversation id are
left out (they belong to none); turns sort by number (null first), then role and text, and
repeated turns stay; a conversation whose turns are a prefix of the other's has an empty
completion, as have equal conversations (a borrowed answer that equals the own one). One conversation is one output string and is held
in one row, as its turns must be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ortholake.llm.common import materialise, table

START, END = "<|im_start|>", "<|im_end|>"
SALTS = 64
TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv, turns array<struct<turn, role, text>>, opening, weight) per conversation.

    opening: hash-free key of the first turn (role and text); weight: characters of assistant
    text."""
    t = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").alias("conv"),
        F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    c = t.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # array_sort puts null turn numbers last; they are to come first
    nulls_first = F.concat(F.filter("ts", lambda x: x["turn"].isNull()), F.filter("ts", lambda x: x["turn"].isNotNull()))
    c = c.select("conv", F.transform(nulls_first, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    own = F.filter("turns", lambda x: x["role"] == TRAINED_ROLE)
    weight = F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + F.length(x["text"]))
    return c.withColumn("opening", F.get("turns", F.lit(0))).withColumn("weight", weight)


def pair_conversations(convs: DataFrame, salts: int = SALTS) -> DataFrame:
    """(chosen, rejected) conversation ids, rejected null for one without a partner."""
    c = convs.select("conv", "weight", F.sha2(F.concat_ws("\n", "opening.role", "opening.text"), 256).alias("key"),
                     F.pmod(F.xxhash64("conv"), F.lit(salts)).alias("salt"))

    def paired(df: DataFrame, by: list[str]) -> DataFrame:
        """Rows of odd rank get the next row, if any, as ``other``."""
        w = Window.partitionBy(*by).orderBy("conv")
        nxt = F.lead(F.struct("conv", "weight")).over(w)
        return df.withColumn("other", nxt).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") % 2 == 1).drop("rank")

    first = paired(c, ["key", "salt"])
    second = paired(first.filter(F.col("other").isNull()).drop("other"), ["key"])   # at most ``salts`` rows of a key
    both = first.filter(F.col("other").isNotNull()).select("conv", "weight", "other").unionByName(second.select("conv", "weight", "other"))
    swap = F.col("other.weight") > F.col("weight")
    return both.select(F.when(swap, F.col("other.conv")).otherwise(F.col("conv")).alias("chosen"),
                       F.when(swap, F.col("conv")).otherwise(F.col("other.conv")).alias("rejected"))


def ring(rows: DataFrame) -> DataFrame:
    """(conv, next_conv, next_answer) for rows (conv, answer): the next row in the order of the MD5
    of the ids, the first one after the last."""
    key = F.md5(F.col("conv").cast("string").cast("binary"))
    laid = rows.withColumn("key", key).repartitionByRange("key", "conv").withColumn("part", F.spark_partition_id())
    laid = materialise(laid, "ring")
    own = Window.partitionBy("part").orderBy("key", "conv")
    inside = laid.withColumn("next", F.lead(F.struct("conv", "answer")).over(own))
    # One row per range.
    first = laid.groupBy("part").agg(F.min(F.struct("key", "conv", "answer")).alias("f")).select("part", F.struct("f.conv", "f.answer").alias("f"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.select("part", F.coalesce(F.lead("f").over(Window.orderBy("part")), F.first("f").over(every)).alias("after"))
    out = inside.join(materialise(first, "ranges"), "part").withColumn("next", F.coalesce("next", "after"))
    return out.select("conv", F.col("next.conv").alias("next_conv"), F.col("next.answer").alias("next_answer"))


def last_answer(turns: Column) -> Column:
    """Place (from 1) of the last assistant turn; null without one."""
    at = F.filter(F.transform(turns, lambda t, i: F.when(t["role"] == TRAINED_ROLE, i + 1)), lambda i: i.isNotNull())
    return F.array_max(at)


def with_rejected(convs: DataFrame) -> DataFrame:
    """(chosen, rejected, ta, tb): ids and turns of every conversation and of its rejected side."""
    c = convs.select("conv", "turns", last_answer(F.col("turns")).alias("k"))
    some = c.filter(F.col("k").isNotNull()).select("conv", F.element_at("turns", F.col("k"))["text"].alias("answer"))
    follow = materialise(ring(some).filter(F.col("conv") != F.col("next_conv")), "followers").withColumnRenamed("conv", "own")
    j = c.join(follow, F.col("conv") == F.col("own"), "left")
    swapped = F.array(F.struct(F.lit(TRAINED_ROLE).alias("role"), F.coalesce("next_answer", F.lit("")).alias("text")))
    tb = F.concat(F.slice("turns", F.lit(1), F.col("k") - 1), swapped, F.slice("turns", F.col("k") + 1, F.size("turns")))
    return j.select(F.col("conv").alias("chosen"), F.col("next_conv").alias("rejected"), F.col("turns").alias("ta"), F.when(F.col("next_conv").isNotNull(), tb).alias("tb"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading elements that two arrays share."""
    shorter = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), shorter), lambda i: (i == shorter) | (F.get(a, i) != F.get(b, i)))
    return F.array_min(differ)


def render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))
    return F.array_join(F.transform(turns, one), "")


def trained_spans(turns: Column) -> Column:
    """Spans "start:end" (characters of the rendered turns), comma-joined, of assistant texts
    with their end mark."""
    head = lambda t: F.length(t["role"]) + F.lit(len(START) + 1)
    step = lambda acc, t: F.struct(
        (acc["at"] + head(t) + F.length(t["text"]) + F.lit(len(END) + 1)).alias("at"),
        F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(F.concat_ws(
            ":", (acc["at"] + head(t)).cast("string"), (acc["at"] + head(t) + F.length(t["text"]) + F.lit(len(END))).cast("string")))))
        .otherwise(acc["spans"]).alias("spans"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, zero, step)["spans"], ",")


def format_pairs(pairs: DataFrame, convs: DataFrame) -> DataFrame:
    """``format_sides`` for each pair (chosen, rejected) of conversation ids."""
    a = convs.select(F.col("conv").alias("chosen"), F.col("turns").alias("ta"))
    b = convs.select(F.col("conv").alias("rejected"), F.col("turns").alias("tb"))
    # Conversations without a partner take no part in the second join, where their null would
    # be one key for all of them.
    j = pairs.join(a, "chosen")
    single = j.filter(F.col("rejected").isNull()).withColumn("tb", F.lit(None).cast(convs.schema["turns"].dataType))
    j = j.filter(F.col("rejected").isNotNull()).join(b, "rejected", "left").select("chosen", "rejected", "ta", "tb").unionByName(
        single.select("chosen", "rejected", "ta", "tb"))
    return format_sides(j)


def format_sides(sides: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, n_shared, prompt, chosen, rejected, chosen_spans,
    rejected_spans) for each row (chosen, rejected, ta, tb): ids and turns of either side."""
    alone = F.greatest(F.size("ta") - 1, F.lit(0))
    j = sides.withColumn("n", F.when(F.col("tb").isNull(), alone).otherwise(common_prefix(F.col("ta"), F.col("tb"))))
    rest = lambda c: F.when(F.col(c).isNotNull(), F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0))))
    j = j.select("chosen", "rejected", "n", F.slice("ta", F.lit(1), F.col("n")).alias("shared"), rest("ta").alias("ra"), rest("tb").alias("rb"))
    return j.select(F.col("chosen").alias("chosen_id"), F.col("rejected").alias("rejected_id"), F.col("n").cast("long").alias("n_shared"),
                    render(F.col("shared")).alias("prompt"), render(F.col("ra")).alias("chosen"), render(F.col("rb")).alias("rejected"),
                    trained_spans(F.col("ra")).alias("chosen_spans"), trained_spans(F.col("rb")).alias("rejected_spans"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = materialise(conversations(table(spark, sf_dir, "conversations")), "conversations")
    return format_sides(with_rejected(convs))


ORACLE_SQL = """
WITH t AS (SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS ts FROM t GROUP BY conv),
k AS (SELECT conv, ts, list_max(list_filter(range(1, len(ts) + 1), lambda i: ts[i].role = 'assistant')) AS k FROM c),
r AS (SELECT conv, coalesce(lead(conv) OVER w, first_value(conv) OVER w) AS nc, coalesce(lead(ts[k].text) OVER w, first_value(ts[k].text) OVER w) AS answer
      FROM k WHERE k IS NOT NULL WINDOW w AS (ORDER BY md5(CAST(conv AS VARCHAR)), conv)),
j AS (SELECT k.conv AS chosen_id, r.nc AS rejected_id, ts AS ta,
      CASE WHEN r.nc IS NOT NULL THEN list_concat(list_concat(ts[1:k - 1], [{'role': 'assistant', 'text': answer}]), ts[k + 1:]) END AS tb
      FROM k LEFT JOIN r ON r.conv = k.conv AND r.nc <> r.conv),
n AS (SELECT *, CASE WHEN tb IS NULL THEN len(ta) - 1
        ELSE list_min(list_filter(range(0, least(len(ta), len(tb)) + 1), lambda i: i = least(len(ta), len(tb)) OR ta[i + 1] IS DISTINCT FROM tb[i + 1])) END AS n FROM j),
s AS (SELECT chosen_id, rejected_id, n, ta[1:n] AS shared, ta[n + 1:] AS ra, tb[n + 1:] AS rb FROM n),
x AS (SELECT *, list_transform(ra, lambda t, i: {'a': coalesce(list_sum(list_transform(ra[1:i - 1], lambda u: length(u.role) + length(u.text) + 24)), 0) + length(t.role) + 13, 'n': length(t.text) + 10, 'r': t.role}) AS xa,
             list_transform(rb, lambda t, i: {'a': coalesce(list_sum(list_transform(rb[1:i - 1], lambda u: length(u.role) + length(u.text) + 24)), 0) + length(t.role) + 13, 'n': length(t.text) + 10, 'r': t.role}) AS xb FROM s)
SELECT chosen_id, rejected_id, CAST(n AS BIGINT) AS n_shared,
  array_to_string(list_transform(shared, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS prompt,
  array_to_string(list_transform(ra, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS chosen,
  array_to_string(list_transform(rb, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS rejected,
  array_to_string(list_transform(list_filter(xa, lambda t: t.r = 'assistant'), lambda t: CAST(CAST(t.a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(t.a + t.n AS BIGINT) AS VARCHAR)), ',') AS chosen_spans,
  array_to_string(list_transform(list_filter(xb, lambda t: t.r = 'assistant'), lambda t: CAST(CAST(t.a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(t.a + t.n AS BIGINT) AS VARCHAR)), ',') AS rejected_spans
FROM x"""
