import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratafold.plans.layers import Layers  # noqa: E402
from stratafold.session import build_session, new_folder  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    place = tempfile.mkdtemp(prefix="stratafold-tests-")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": f"{place}/warehouse",
        "spark.checkpoint.dir": f"{place}/shared",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(spark):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    return Layers(spark, prefix, new_folder(spark, "layers")).create()


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples; NULL sorts first."""

    def collect(df, *columns):
        found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda row: [(value is not None, value) for value in row])

    return collect


@pytest.fixture
def frame(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)
