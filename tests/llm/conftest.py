import pytest

LONG = "word" + " lorem ipsum dolor sit amet" * 4000 + "."


def sentence(i: int) -> str:
    return " ".join(f"w{i}x{j}" for j in range(8)) + "."


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    base = " ".join(sentence(i) for i in range(30))
    near = base.replace("w7x3", "other")
    rows = [
        (1, base, "a", "x", 7, "r"),
        (2, base, "a", "x", 7, "r"),
        (3, near, "b", None, None, None),
        (3, near, "b", None, None, None),
        (None, base, None, "x", 1, "q"),
        (None, None, None, None, None, None),
        (4, None, "c", "x", 1, "q"),
        (5, "", "c", "x", 1, "q"),
        (6, " \t\n ", "c", "x", 1, "q"),
        (7, LONG, "a", "x", 1, "q"),
        (8, "one two three", "b", "x", 1, "q"),
        (8, "four five six", "b", "x", 1, "q"),
        (9, "Ünï¢ödé 😀 text. Mehr Wörter hier!", "c", "x", 1, "q"),
        *[(100 + i, " ".join(sentence(1000 * i + j) for j in range(5 + i % 7)), "abc"[i % 3], "x", i, "q") for i in range(40)],
    ]
    # the last columns are named like columns that operators add
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_words int, spans string").repartition(5)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
