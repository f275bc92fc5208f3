import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orderloom import Lake, tune  # noqa: E402
from tests import shop  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


@pytest.fixture
def new_lake(spark, tmp_path):
    """Lakes of their own; without catalog views, which tests would share."""

    def make(name: str = "lake", **options) -> Lake:
        return Lake(spark, str(tmp_path / name), **{"in_catalog": False, **options})

    return make


@pytest.fixture(scope="session")
def built(spark, tmp_path_factory):
    """The small shop with all layers built and shown in the catalog."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("shop")))
    shop.build(lake)
    return lake
