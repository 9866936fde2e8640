import pytest

from .samples import CLASHING, odd_rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd rows with extra columns whose names clash with the operators' own."""
    extra = ", ".join(f"`{name}` string" for name in CLASHING)
    rows = [(*row, None if row[1] is None else len(row[1]), *CLASHING) for row in odd_rows()]
    return spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    ).repartition(2)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 12)] + [(1, None, None), (None, 1, 1), (99, 1, 0), (3, 5, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def some_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
