import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rank int, n int, size string, score string, row string, kind string"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]) as documents with columns whose names the operators use themselves."""
    full = []
    for doc_id, text, *rest in rows:
        lang, source = (*rest, *(("en", "s") if not rest else ()))[:2] if len(rest) != 1 else (rest[0], "s")
        full.append((doc_id, text, lang, source, None if text is None else len(text), 1, 2, "x", "y", "z", "k"))
    return spark.createDataFrame(full, COLUMNS)


LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(60_000))
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "One  two\nthree"), (7, LONG), (8, "é ñ 日本 😀 ½"),
    (9, "same words here again"), (9, "same words here again"), (10, "same words here again", None, None), (11, "\x00 nul \x0b", "fr", ""),
]


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
