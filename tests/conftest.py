from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


def make_spark():
    from pyspark.sql import SparkSession

    from basketry.scratch import name_local_folder
    from basketry.session import SETTINGS

    builder = SparkSession.builder.master("local[8]").appName("basketry-tests")
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_local_folder(spark)
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_spark()
    yield session
    session.stop()
