from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parent)]
# For the test modules' own functions, which run in the workers too.
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE), os.environ.get("PYTHONPATH", "")])

from docloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("shared")
    SparkSession.builder.config("spark.checkpoint.dir", str(folder)).config(
        "spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))
    )
    session = local_session("tests", cores="8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """The optimised physical plan of a DataFrame as text."""

    def text(df) -> str:
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
