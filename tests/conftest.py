import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tierwell import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = session(
        "tests",
        "local[8,3]",  # a task may fail twice
        spark_sql_shuffle_partitions="8",
        spark_checkpoint_dir=f"file://{shared}",
        spark_sql_warehouse_dir=f"{shared}/warehouse",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
