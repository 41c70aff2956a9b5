import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    from factorfall.llm.common import given

    return lambda name: given(spark, SMALL, name)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, long and repeated rows, and columns named like the operators' own."""
    long = " ".join(f"word{i % 700} tail" for i in range(30_000))
    rows = [
        (1, "plain words here and there", "en", "a", 1, "x"),
        (1, "plain words here and there", "en", "a", 1, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "a", 0, ""),
        (4, long, "en", None, 9, "y"),
        (None, "a row without an id", "de", "b", 3, "z"),
        (6, " \t\n ", "xx", "b", 3, "z"),
        (7, "Ünïcödé \U0001f600 text", "de", "b", 3, "z"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fp string"
    ).selectExpr("*", "'clash' AS tokens", "1 AS host", "'c' AS block", "0 AS mask", "'s' AS content", "true AS kept", "'r' AS raw", "2 AS length")
