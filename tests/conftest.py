import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from litscout.session import session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ship_package()
    return session("local[4]", **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "3g"})


@pytest.fixture
def tables(spark, tmp_path):
    """Writes small tables into a data directory: name -> (rows, schema)."""

    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
