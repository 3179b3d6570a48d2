import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "river", "stone", "cloud", "Été", "naïve", "漢字"]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows and ids, blanks of every kind; extra columns with clashing names."""
    r = random.Random(5)
    long = " ".join(r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(30_000))
    text = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 60))) for _ in range(40)]
    rows = [(1, None), (2, ""), (3, "one"), (4, "Two words"), (5, "two  Words"), (6, " \t\n\x0b\x0c\r "), (7, long),
            (8, long + " end"), (None, "no id"), (None, None), (9, text[0]), (9, text[0]), (10, text[0].upper())]
    rows += [(100 + k, t) for k, t in enumerate(text)] + [(200 + k, t) for k, t in enumerate(text[:10])]
    return [(i, t, ["en", None, ""][k % 3], ["a", "a", "a", None, "b"][k % 5], k, f"n{k}", float(k))
            for k, (i, t) in enumerate(rows)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, score double"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
