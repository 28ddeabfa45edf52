import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, node string, h long, score double"

LINE = "This line of text is the same in many documents."
CLEAN = "The garden behind the old house was quiet in the morning, and a cat slept on the wall of it. "


def words(n, seed):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 5003}" for i in range(n))


def awkward():
    """Rows with nulls in any column, empty and very long texts, ties and repeated rows."""
    texts = [
        (0, words(60, 1)), (1, words(60, 1)), (2, words(60, 1) + " x"), (3, words(80, 2)), (4, None), (5, ""), (6, " \n\t "),
        (7, LINE + "\n" + words(30, 3)), (8, words(30, 4) + "\n  " + LINE.upper() + "  "), (9, LINE + "\n" + LINE), (None, LINE + "\nown line of it"),
        (None, None), (10, words(150_000, 5)), (11, "\n".join([words(40, 6)] * 3)), (12, "short"), (13, "two words"), (13, "two words"), (14, CLEAN * 4), (15, "é" * 25 + "\n" + "É" * 25),
    ]
    return [(d, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, None, 1, 2, "n", 3, 0.5) for i, (d, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(awkward(), SCHEMA)
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
