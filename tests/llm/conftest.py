import pytest

from shiftledger.llm.shipping import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing extra columns."""
    rows = [
        (1, "the cat sat on the mat and the dog sat on the log by the fog " * 4, "en", "a", 240, 1, "x"),
        (1, "the cat sat on the mat and the dog sat on the log by the fog " * 4, "en", "a", 240, 1, "x"),
        (2, "the cat sat on the mat and the dog sat on the log by the fog " * 4, None, None, None, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, 2, "y"),
        (5, " \n\t ", "de", "b", 4, 2, "y"),
        (None, "der hund und die katze sind im garten und der regen ist kalt heute abend", "de", "b", 70, 3, "z"),
        (None, None, None, None, None, None, None),
        (6, " ".join(f"wort{i}é" for i in range(30_000)), "de", "a", 300_000, 4, "z"),
        (2, "another text under a shared id", "en", "c", 30, 5, "w"),
        (7, "1234 !!! ???", "fr", "c", 12, 6, "v"),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long, size long, row string"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (4, 1, 0), (4, 0, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
