import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture(scope="session")
def prose():
    """Seeded texts without chance repeats: prose(seed, n) is n words."""
    import random

    def make(seed: int, n: int) -> str:
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + str(r.randrange(1000)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Documents with every kind of odd row: nulls, empty and very long texts, repeated rows, a
    clashing extra column."""
    rows = [
        (1, prose(1, 200), "en", "src1", 900, "x"), (2, prose(1, 200), "en", "src1", 900, "y"), (2, prose(1, 200), "en", "src1", 900, "y"),
        (3, prose(3, 30_000), "en", "src2", 200_000, None), (4, None, None, None, None, None), (5, "", "de", "src3", 0, ""),
        (6, " \n\t ", "de", "src3", 4, "k"), (7, "Two words", "fr", "src4", 9, "k"), (None, prose(8, 60), "fr", "src4", 300, "k"),
        (9, prose(9, 60) + "\n" + "Licensed under CC BY-NC 4.0.", "fr", "odd", 400, "k"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
