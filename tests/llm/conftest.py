import pytest
from samples import DOCS, corpus


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Nulls in every column, repeated rows and ids, and columns with names used inside."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    same = (5, "alpha beta gamma delta epsilon", "en", "s1", 30)
    rows = [same, same, (None, None, None, None, None), (None, "alpha beta gamma delta epsilon", None, "s1", 30), (7, "", "en", None, 0), (5, "zeta eta", "en", "s1", 8)]
    df = spark.createDataFrame([(*r, 1, "x", b"y", 2.0) for r in rows], DOCS + ", row int, k1 string, sig binary, kept double")
    df.write.parquet(path)
    return spark.read.parquet(path)
