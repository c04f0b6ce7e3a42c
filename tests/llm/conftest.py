import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 string, row string, size string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows and columns with names that operators use."""
    long = " ".join(f"w{i % 700}" for i in range(9000))
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [
        (1, "alpha beta gamma " * 30, "en", "a", 5, "x", "y", "z"),
        (2, "alpha beta gamma " * 30, "en", "a", 5, "x", "y", "z"),
        (2, "alpha beta gamma " * 30, "en", "a", 5, "x", "y", "z"),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, None, None, None),
        (5, " \n\t ", "de", "b", 4, None, None, None),
        (None, "word " * 80, "en", "c", 400, None, None, None),
        (6, long, "en", "c", len(long), None, None, None),
        (7, "start here\n" + passage + "\nend here", "fr", "a", 1, None, None, None),
        (8, passage + " and more", "fr", "b", 1, None, None, None),
        (9, "tail " + passage, None, "b", 1, None, None, None),
        (10, "ÄÖ Ü É x one\x0btwo\x0cthree", "de", "a", 1, None, None, None),
        (11, "one", "de", "a", 1, None, None, None),
        (12, "one two", "de", "a", 1, None, None, None),
        (13, long + " tail", "en", "c", 1, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
