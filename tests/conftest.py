import logging
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
logging.disable(logging.CRITICAL)

from sparkweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="run-")
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": work, "spark.sql.maxMetadataStringLength": "10000", "spark.sql.warehouse.dir": f"{work}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def tables(spark, sf):
    from sparkweave.sources.tables import Tables

    return Tables(spark, sf)


@pytest.fixture(scope="session")
def plan():
    """Text of the plan that really ran, after adaptive changes."""

    def text(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
