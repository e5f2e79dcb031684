import pytest

from tillscope.llm.workers import ship_package


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """A maker of small document tables, with columns whose names clash with those of results."""

    def make(*texts, ids=None):
        rows = [(ids[k] if ids else k, text, "a", 1, True, "x") for k, text in enumerate(texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, n_words long, kept boolean, text_hash string"
        )

    return make
