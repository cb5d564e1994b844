import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n: int, seed: int = 0) -> str:
    """n words in a fixed pseudo-random order."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


#: (doc_id, text): nulls in every column, empty and blank texts, repeated rows, ties
ODD = [(1, None), (None, "words of a row without an id"), (None, None), (2, ""), (3, " \n\t "), (4, "one"),
       (5, prose(60, 1)), (5, prose(60, 1)), (6, prose(60, 1)), (7, "Ünïcödé 日本語 текст 🙂 " * 5), (8, "12 34 !!"),
       (9, prose(4000, 2))]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with extra columns named like the operators' own."""
    rows = [(i, t, None, None, None if t is None else len(t), True, 1.0, "x", [1]) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", kept boolean, score double, text_hash string, removed array<int>").cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
