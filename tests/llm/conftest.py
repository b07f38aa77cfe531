import itertools

import pytest

NUMBERS = itertools.count()


@pytest.fixture(scope="session")
def frame(spark, tmp_path_factory):
    """Rows written as a table of a few files and read again, as the operators expect."""
    folder = tmp_path_factory.mktemp("tables")

    def write(rows, schema, files=3):
        path = str(folder / f"t{next(NUMBERS)}")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.schema(spark.createDataFrame([], schema).schema).parquet(path)

    return write


@pytest.fixture(scope="session")
def sf_folder(spark, tmp_path_factory):
    """A folder of tables given as {name: (rows, schema)}."""
    def write(tables):
        folder = str(tmp_path_factory.mktemp("sf"))
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
        return folder

    return write


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
