import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def documents(spark):
    """Documents with every awkward case: nulls, empty and long texts, repeats, and extra columns with clashing names."""

    def make(texts, extra=True):
        rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or ""), "x", 1) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, fp int")

    return make
