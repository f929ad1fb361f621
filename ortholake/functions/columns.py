"""Column expressions shared by plans and operators.

Every helper returns a ``Column`` made of built-in functions, so it stays inside
whole-stage code generation. No Python UDFs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the studied system's for equal results)
# ---------------------------------------------------------------------------
# COG functional categories, letter -> name, in the standard order of the
# functional-class listing.
COG_CATEGORIES: list[tuple[str, str]] = [
    ("J", "TRANSLATION, RIBOSOMAL STRUCTURE AND BIOGENESIS"),
    ("A", "RNA PROCESSING AND MODIFICATION"),
    ("K", "TRANSCRIPTION"),
    ("L", "REPLICATION, RECOMBINATION AND REPAIR"),
    ("B", "CHROMATIN STRUCTURE AND DYNAMICS"),
    ("D", "CELL CYCLE CONTROL, CELL DIVISION, CHROMOSOME PARTITIONING"),
    ("Y", "NUCLEAR STRUCTURE"),
    ("V", "DEFENSE MECHANISMS"),
    ("T", "SIGNAL TRANSDUCTION MECHANISMS"),
    ("M", "CELL WALL/MEMBRANE/ENVELOPE BIOGENESIS"),
    ("N", "CELL MOTILITY"),
    ("Z", "CYTOSKELETON"),
    ("W", "EXTRACELLULAR STRUCTURES"),
    ("U", "INTRACELLULAR TRAFFICKING, SECRETION, AND VESICULAR TRANSPORT"),
    ("O", "POSTTRANSLATIONAL MODIFICATION, PROTEIN TURNOVER, CHAPERONES"),
    ("X", "MOBILOME: PROPHAGES, TRANSPOSONS"),
    ("C", "ENERGY PRODUCTION AND CONVERSION"),
    ("G", "CARBOHYDRATE TRANSPORT AND METABOLISM"),
    ("E", "AMINO ACID TRANSPORT AND METABOLISM"),
    ("F", "NUCLEOTIDE TRANSPORT AND METABOLISM"),
    ("H", "COENZYME TRANSPORT AND METABOLISM"),
    ("I", "LIPID TRANSPORT AND METABOLISM"),
    ("P", "INORGANIC ION TRANSPORT AND METABOLISM"),
    ("Q", "SECONDARY METABOLITES BIOSYNTHESIS, TRANSPORT AND CATABOLISM"),
    ("R", "GENERAL FUNCTION PREDICTION ONLY"),
    ("S", "FUNCTION UNKNOWN"),
]
NO_COG_LABEL = "No COG assigned"
# TPM bucket labels of the expression distribution, in report order.
TPM_BUCKETS = ["Low (<1 TPM)", "Medium (1-10 TPM)", "High (10-100 TPM)", "Very High (>100 TPM)"]
# Expression badge shown next to search hits.
TPM_BADGES = ["High", "Medium", "Low"]
# Protein ids are "<gene id>.p<N>".
PROTEIN_SUFFIX_MARK = ".p"
# The ingest treats this literal as "missing" in list-valued annotation fields.
MISSING = "-"


def gene_id(protein_id: Column | str) -> Column:
    """Gene id of a protein id: the text before the first ``.p``."""
    c = F.col(protein_id) if isinstance(protein_id, str) else protein_id
    return F.split_part(c, F.lit(PROTEIN_SUFFIX_MARK), F.lit(1))


def round_half_up(c: Column | str, digits: int) -> Column:
    """Decimal rounding with the same result in Spark and DuckDB: floor(x*10^d + 0.5)/10^d."""
    c = F.col(c) if isinstance(c, str) else c
    scale = 10.0 ** digits
    return (F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def sorted_string_agg(c: Column | str, sep: str) -> Column:
    """STRING_AGG(DISTINCT c, sep ORDER BY c); NULL when the group has no value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), sep), F.lit(""))


def nullif_dash(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(MISSING))


def any_informative(cols: list[str]) -> Column:
    """Three-valued OR of ``col != '-'``: a row whose fields are all NULL or '-' is not kept."""
    return reduce(lambda a, b: a | b, [F.col(c) != F.lit(MISSING) for c in cols])


def tpm_bucket(tpm: Column | str) -> Column:
    t = F.col(tpm) if isinstance(tpm, str) else tpm
    return (
        F.when(t < 1, F.lit(TPM_BUCKETS[0]))
        .when(t < 10, F.lit(TPM_BUCKETS[1]))
        .when(t < 100, F.lit(TPM_BUCKETS[2]))
        .otherwise(F.lit(TPM_BUCKETS[3]))
    )


def tpm_bucket_order(label: Column | str) -> Column:
    c = F.col(label) if isinstance(label, str) else label
    return (
        F.when(c == TPM_BUCKETS[0], 1).when(c == TPM_BUCKETS[1], 2).when(c == TPM_BUCKETS[2], 3).otherwise(4)
    )


def tpm_badge(tpm: Column | str) -> Column:
    t = F.col(tpm) if isinstance(tpm, str) else tpm
    return F.when(t > 100, F.lit(TPM_BADGES[0])).when(t > 10, F.lit(TPM_BADGES[1])).otherwise(F.lit(TPM_BADGES[2]))


def cog_dimension(spark: SparkSession) -> DataFrame:
    """COG letter -> name: 26 fixed rows, safe to broadcast."""
    schema = T.StructType(
        [T.StructField("cog_letter", T.StringType(), False), T.StructField("cog_name", T.StringType(), False)]
    )
    return spark.createDataFrame(COG_CATEGORIES, schema)


ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def content_id(seq: Column | str) -> Column:
    """Content-derived sequence id: ``v1_`` + SHA-256 of the sequence with ASCII letters
    upper-cased (sequence alphabets are ASCII; other characters are hashed as they are)."""
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.concat(F.lit("v1_"), F.sha2(F.translate(s, ASCII_LOWER, ASCII_UPPER), 256))


def words(text: Column | str) -> Column:
    """Lower-cased words of a text: maximal runs of letters and digits."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{N}]+"), 0)


def ngrams(word_array: Column | str, n: int) -> Column:
    """Word n-grams of an array of words, each joined by one space (empty when shorter than n).

    Built from n shifted slices zipped element-wise, so the cost is linear: no lambda refers
    back to the text. Pass a *column* holding the words (see ``with_words``): an expression
    here would be evaluated once per slice."""
    w = F.col(word_array) if isinstance(word_array, str) else word_array
    m = F.size(w) - F.lit(n) + F.lit(1)
    parts = [F.slice(w, k + 1, F.greatest(m, F.lit(1))) for k in range(n)]
    zipped = F.arrays_zip(*parts)
    grams = F.transform(zipped, lambda z: F.concat_ws(" ", *[z[str(k)] for k in range(n)]))
    return F.when(m > 0, grams).otherwise(F.array().cast("array<string>"))


def with_words(df: DataFrame, text_col: str, out: str = "_words") -> DataFrame:
    """Add the word array of ``text_col`` as a column, computed once per row."""
    return df.withColumn(out, words(text_col))


def with_ngrams(df: DataFrame, words_col: str, n: int, out: str = "_ngrams") -> DataFrame:
    """Add the word n-grams of ``words_col`` as a column using Spark ML's JVM-side ``NGram``
    transformer (space-joined sliding windows; empty when there are fewer than n words).
    Same result as ``ngrams`` without evaluating a lambda per n-gram."""
    from pyspark.ml.feature import NGram

    return NGram(n=n, inputCol=words_col, outputCol=out).transform(df)


def flat_text(seq_col: str) -> Column:
    """A sequence with ASCII letters upper-cased and white space left out."""
    return F.regexp_replace(F.translate(F.coalesce(F.col(seq_col), F.lit("")), ASCII_LOWER, ASCII_UPPER), r"\s", "")


def with_kmers(df: DataFrame, seq_col: str, k: int, out: str = "_ngrams") -> DataFrame:
    """Add the length-k substrings of a sequence, ASCII letters upper-cased, white space left out (none when
    shorter than k): the n-grams of its characters, which come space-joined."""
    from pyspark.ml.feature import NGram

    chars = df.withColumn("_chars", F.filter(F.split(flat_text(seq_col), ""), lambda c: c != ""))
    return NGram(n=k, inputCol="_chars", outputCol=out).transform(chars).drop("_chars")
