import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from lakeferry.session import configure

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    if os.environ.get("TEST_NO_BROADCAST"):
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        session.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50KB")
        session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    yield session
    session.stop()
