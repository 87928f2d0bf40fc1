import pytest

from subtally.llm.common import prepared


@pytest.fixture(autouse=True)
def settings(spark):
    prepared(spark)


@pytest.fixture
def documents(spark, tmp_path):
    """Stores rows (doc_id, text, more columns) as the operators expect them: a written table."""

    def write(rows, schema="doc_id bigint, text string", name="documents"):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return write
