import pytest
from odd import DOCUMENTS, frame, odd_rows


@pytest.fixture(scope="session")
def rows():
    return odd_rows()


@pytest.fixture(scope="session")
def documents(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    frame(spark, rows).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
