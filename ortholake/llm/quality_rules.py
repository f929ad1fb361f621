"""Operator 6: quality rules with host-level verdicts, in DataFrame functions only.

Per document: word_chars (code points in words), n_symbols (characters of ``[#*$%&|<>]``),
n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words inside
8-word windows found twice or more in the text). ``base_failed``: fewer than 20 words, or
more than 30 % of the words repeated. Soft rules flag lesser faults (``SOFT_RULES``); a
document that fails a severe one of them (``SEVERE``) is not kept on any host.

Per host: the failures of its documents (base or soft rule) are counted, and the rate is
shrunk towards the corpus by a beta prior whose mean and strength are fitted to the host
rates by moments. The limit comes from that prior: a host is distrusted if its shrunk rate
exceeds the corpus mean both by a prior standard deviation and by half of the mean, or exceeds
``host_limit`` in any case. Documents of a distrusted host are held to the soft rules too:
kept = not base_failed and no severe rule failed and not (host distrusted and a soft rule
failed). A clean document is thus never lost to its neighbours. Where hosts differ no more
than samples of their size do, the prior is narrow, all shrunk rates are near the mean, and no
host is distrusted.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: a null text counts as the empty text (no
words, base_failed); documents without a host form a host of their own; repeated rows count
each; an empty table gives an empty table. Two different 8-word windows of one text would
have to share a 64-bit hash to be taken for a repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import fresh, materialise, table, text_or_empty

# Fixed parameters (defaults).
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
HOST_LIMIT = 0.5         # a shrunk rate above it is distrusted whatever the prior
HOST_EXCESS = 1.5        # least ratio of a distrusted host's shrunk rate to the corpus mean
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Lesser faults, by name: over one symbol in five characters of words, over one line in
#: three repeated, over one word in ten repeated, words of 2 to 15 characters on average.
SOFT_RULES = {
    "symbols": "n_symbols * 5 > word_chars",
    "lines": "n_dup_lines * 3 > n_lines",
    "repeats": "n_repeat_words * 10 > n_words",
    "lengths": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
#: Soft rules that count by themselves, whatever the host.
SEVERE = ["symbols"]


def window_hashes(words: Column, n: int = WINDOW) -> Column:
    """Hash of every n-word window, in order; null for fewer words."""
    at = F.sequence(F.lit(1), F.size(words) - (n - 1))
    return F.when(F.size(words) >= n, F.transform(at, lambda i: F.xxhash64(F.slice(words, i, n))))


def tagged_windows(hashes: Column) -> Column:
    """(hash, place) sorted by hash where some hash occurs twice, else null."""
    tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), tagged)


def repeated_starts(tagged: Column) -> Column:
    """Places, in order, of the windows whose hash occurs more than once."""
    def twice(x: Column, k: Column) -> Column:
        return ((k > 0) & (F.get(tagged, k - 1)["h"] == x["h"])) | ((k + 1 < F.size(tagged)) & (F.get(tagged, k + 1)["h"] == x["h"]))

    return F.array_sort(F.transform(F.filter(tagged, twice), lambda x: x["i"]))


def covered(starts: Column, n: int = WINDOW) -> Column:
    """Words covered by n-word windows at the given places."""
    zero = F.struct(F.lit(0).alias("sum"), F.lit(-n).alias("last"))
    step = lambda acc, s: F.struct((acc["sum"] + F.least(F.lit(n), s - acc["last"])).alias("sum"), s.alias("last"))
    return F.coalesce(F.aggregate(starts, zero, step)["sum"], F.lit(0))


def measure(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with the measures, ``n_lines`` and ``base_failed``."""
    t = F.col("_text")
    d = docs.select(*[F.col(c) for c in keep or []], text_or_empty(text_col).alias("_text"))
    d = d.withColumn("_flat", F.btrim(F.translate(t, SPACES, " " * len(SPACES))))
    d = d.withColumn("_words", F.when(F.col("_flat") == "", F.array().cast("array<string>")).otherwise(F.split("_flat", " +")))
    d = d.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    d = d.withColumn("_windows", window_hashes(F.col("_words")))
    d = d.withColumn("_tagged", tagged_windows(F.col("_windows")))
    d = d.withColumn("_starts", repeated_starts(F.col("_tagged")))
    values = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered(F.col("_starts")).cast("long").alias("n_repeat_words"),
    )
    # As a generator, so that a later filter on a measure is not pushed below the steps above,
    # which would write them into one another and evaluate them for every element.
    d = d.select(*[F.col(c) for c in keep or []], F.inline(F.array(values)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def soft_failed(names: list[str] | None = None) -> Column:
    out = F.lit(False)
    for name in names if names is not None else SOFT_RULES:
        out = out | F.expr(SOFT_RULES[name])
    return out


def host_verdicts(measured: DataFrame, host: str, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, n_failed, rate, distrusted): failure rates shrunk by a beta prior with
    mean ``mu`` and strength ``s`` (prior documents), by the moments of the host rates.

    The limit is max(``HOST_EXCESS`` * mu, mu + the prior's standard deviation), at most
    ``host_limit``."""
    fails = F.col("base_failed") | F.col("soft_failed")
    hosts = measured.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(fails.cast("long")).alias("n_failed"))
    hosts = materialise(hosts, "hosts")
    n, k, mu = F.col("n_docs"), F.col("n_failed"), F.col("_mu")
    total = hosts.agg((F.sum("n_failed") / F.sum("n_docs")).alias("_mu"), F.sum("n_docs").alias("_all"), F.count(F.lit(1)).alias("_hosts"))
    # Weighted variance of the rates, less what counts of that size scatter by themselves.
    spread = hosts.join(F.broadcast(total)).agg(   # one row
        F.first("_mu").alias("_mu"),
        (F.sum(n * (k / n - mu) * (k / n - mu)) / F.first("_all")).alias("_var"),
        (F.first("_mu") * (1 - F.first("_mu")) * F.first("_hosts") / F.first("_all")).alias("_noise"))
    between = F.greatest(F.col("_var") - F.col("_noise"), F.lit(1e-6))
    prior = spread.select("_mu", F.greatest(mu * (1 - mu) / between - 1, F.lit(1.0)).alias("_s"))
    rate = (k + mu * F.col("_s")) / (n + F.col("_s"))
    above = F.greatest(HOST_EXCESS * mu, mu + F.sqrt(mu * (1 - mu) / (F.col("_s") + 1)))
    limit = F.least(F.lit(host_limit), above)
    return hosts.join(F.broadcast(prior)).select(F.col(host), "n_docs", "n_failed", rate.alias("rate"), (rate > limit).alias("distrusted"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
          host_limit: float = HOST_LIMIT) -> DataFrame:
    """(id, measures, base_failed, host, host_rate, kept), one row per row of ``docs``."""
    d = docs.withColumn("_host", F.coalesce((host if host is not None else F.col("source")).cast("string"), F.lit("")))
    m = materialise(measure(d, text_col, [id_col, "_host"]).withColumn("soft_failed", soft_failed()), "measures")
    verdicts = materialise(host_verdicts(m, "_host", host_limit), "verdicts").select(F.col("_host").alias("_h"), "rate", "distrusted")
    j = m.join(verdicts, F.col("_host") == F.col("_h"), "left")
    kept = ~F.col("base_failed") & ~soft_failed(SEVERE) & ~(F.col("distrusted") & F.col("soft_failed"))
    return j.select(id_col, *MEASURES, "base_failed", kept.alias("kept"), F.col("_host").alias("host"), F.col("rate").alias("host_rate"))


def keep_documents(docs: DataFrame, host: Column | None = None, host_limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The verdicts of the hosts are
    joined back to the rows, whose own measures are taken anew."""
    own = list(docs.columns)
    h, f = fresh("_hostkey", own), fresh("_distrusted", own)
    d = docs.withColumn(h, F.coalesce((host if host is not None else F.col("source")).cast("string"), F.lit("")))
    m = measure(d, "text", [h]).withColumn("soft_failed", soft_failed())
    bad = host_verdicts(m, h, host_limit).filter("distrusted").select(F.col(h).alias(f))
    row = measure(d.select(F.struct("*").alias("_row"), F.col("text")), "text", ["_row"]).withColumn("soft_failed", soft_failed())
    row = row.filter(~F.col("base_failed") & ~soft_failed(SEVERE))
    out = row.join(materialise(bad, "distrusted"), F.col("_row")[h] == F.col(f), "left")
    return out.filter(F.col(f).isNull() | ~F.col("soft_failed")).select(*[F.col("_row")[c].alias(c) for c in own])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
