import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lectern.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column expression to a list of texts."""

    def apply(values, expression):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string")
        return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]

    return apply
