import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from presswork.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over a list of one-column inputs."""

    def run(values, column, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        rows = df.select("i", column.alias("out")).orderBy("i").collect()
        return [row.out for row in rows]

    return run
