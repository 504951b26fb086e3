import pytest

from tidewatch.session import ensure_utc, ship_package


@pytest.fixture(scope="module")
def prepared(spark):
    ship_package(spark)
    return ensure_utc(spark)


@pytest.fixture(scope="module")
def documents(prepared):
    return prepared.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def labels(prepared):
    return prepared.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture(scope="module")
def odd(prepared):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns named like results."""
    long_ = " ".join(f"w{k % 977}x{k % 13}" for k in range(60_000))
    rows = [(1, "a b c d e f", "en", "s1"), (1, "a b c d e f", "en", "s1"), (2, "", "en", "s1"), (3, None, None, None),
            (None, "a b c d e f", None, "s2"), (4, long_, "fr", None), (5, long_ + " z", "fr", "s2"), (6, "A B c d e F", "en", ""),
            (7, " \n\t ", None, "s1"), (8, "one", "en", "s3"), (9, "é🎉" * 40, "en", "s3"), (None, None, None, None)]
    frame = prepared.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.selectExpr("*", "length(text) n_chars", "1 size", "2 score", "3 chunk", "4 copies", "5 distance", "6 `row_number`")
