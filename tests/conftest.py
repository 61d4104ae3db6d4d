import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("punctuality-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edge_path(tmp_path_factory):
    from edge_data import full_width

    path = tmp_path_factory.mktemp("edge") / "flights.csv"
    path.write_text(full_width())
    return str(path)


@pytest.fixture(scope="session")
def edge(spark, edge_path):
    """The edge rows as the CSV reader sees them."""
    from punctuality.sources.flights import read_flights

    return read_flights(spark, edge_path)


@pytest.fixture(scope="session")
def driver_flights(spark):
    """The flights derived from the smallest driver tables."""
    from driver_tables import flights

    return flights(spark, "/root/testdata/sf0.001").cache()
