"""Extra columns that bear the operators' own names, and ids that several texts share."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ortholake.llm import bpe, cotrain, license_rules, mixing, odd_sketch, quality_rules

SF = "/root/testdata/sf0.001"
#: Names that some operator gives to a column of its own.
INTERNAL = ["id", "_id", "label", "x", "key", "_key", "n", "hi", "lo", "rep", "rank", "a", "b", "k", "w", "m", "kept", "score", "component", "component_id",
            "_row", "_host", "_hostkey", "_distrusted", "_text", "_words", "_lines", "_h", "rate", "epoch", "_whole", "_cut", "domain", "language", "tokens",
            "url", "payload", "turns", "conv", "t", "item_id", "term", "tf", "df", "h1", "h2", "c", "f", "keep_id", "group_size", "quality"]


@pytest.fixture(scope="module")
def clashing(spark, odd_docs):
    have = {c.lower() for c in odd_docs.columns}
    return odd_docs.withColumns({c: F.lit(f"extra {c}") for c in INTERNAL if c.lower() not in have})


def test_operators_on_documents_with_clashing_columns(spark, odd_docs, clashing):
    labels = spark.createDataFrame([(1, 1), (7, 0), (9, 1), (9, 0), (3, None), (2, 0)], "doc_id long, quality int")
    labels = labels.withColumns({c: F.lit("extra") for c in INTERNAL if c != "quality"})
    plain = labels.select("doc_id", "quality")

    def rows(df):
        return sorted(map(repr, df.collect()))

    model, same = cotrain.train(clashing, labels), cotrain.train(odd_docs, plain)
    assert rows(cotrain.score(clashing, model)) == rows(cotrain.score(odd_docs, same))
    for f in (odd_sketch.near_duplicates, license_rules.scan_licenses, quality_rules.judge, lambda d: bpe.digest(d, *bpe.vocabulary())):
        assert rows(f(clashing)) == rows(f(odd_docs))
    assert mixing.select_mixture(clashing.drop("epoch"), mixing.tree()).columns == [*clashing.drop("epoch").columns, "epoch"]


def test_stages_with_clashing_columns(spark, odd_docs, clashing):
    for name, stage in corpus_pipeline.STAGES:
        out, own = stage(spark, clashing, SF), stage(spark, odd_docs, SF)
        assert out.count() == own.count(), name
        if name != "byte_bpe":
            assert out.columns == clashing.columns, name
            assert sorted(map(repr, out.select(own.columns).collect())) == sorted(map(repr, own.collect())), name


def test_texts_that_share_an_id_are_judged_by_themselves(spark, prose):
    rows = [(1, prose(1, 80), "x"), (1, prose(2, 80), "y"), (2, prose(2, 80), "z"), (3, prose(3, 80), "z"), (3, prose(3, 80), "z"), (4, prose(1, 80) + " more", "u"),
            (None, prose(1, 80), "n"), (0, prose(4, 80), "o"), (5, prose(4, 80), "o"), (5, prose(5, 80), "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in odd_sketch.keep_documents(df).collect())
    assert kept == sorted([(-1, prose(1, 80)), (0, prose(4, 80)), (1, prose(1, 80)), (1, prose(2, 80)), (3, prose(3, 80)), (5, prose(5, 80))])


def test_labelled_id_with_several_texts_counts_once(spark, prose):
    rows = [(i % 40, prose(i % 40, 30) if i % 2 else "## $$ " * 20, "en", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows + [(1, "other", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = docs.filter("text != 'other'").dropDuplicates(["doc_id"])
    a, b = cotrain.train(docs.filter("text != 'other'"), labels), cotrain.train(once, labels)
    assert a.constant is None and sorted(map(repr, cotrain.score(once, a).collect())) == sorted(map(repr, cotrain.score(once, b).collect()))
    assert cotrain.train(docs, labels).constant is None
