import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Shared folder: spark.checkpoint.dir when the session names one, else a
    # private temporary folder (set only because it is unset).
    from larder.session import shared_dir
    shared_dir(s)
    yield s


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def db(spark):
    from larder.plans.tables import scratch_database
    return scratch_database(spark, "test")
