"""Column-expression helpers. Everything here builds JVM-side Catalyst expressions."""

from ortholake.functions.columns import (  # noqa: F401
    COG_CATEGORIES,
    any_informative,
    cog_dimension,
    content_id,
    gene_id,
    nullif_dash,
    round_half_up,
    sorted_string_agg,
    tpm_bucket,
    tpm_badge,
    ngrams,
    with_words,
    with_ngrams,
    words,
    with_kmers,
)
