import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from text_cases import SCHEMA, corpus  # noqa: E402


@pytest.fixture(scope="session")
def rows_in():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows_in):
    return spark.createDataFrame(rows_in, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
