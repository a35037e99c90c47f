import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def plan(df):
    """The formatted physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder
    builder = (
        builder.master("local[*]")
        .appName("ledgerline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.driver.memory", "4g")
    )
    # Further settings, as in TEST_CONF="spark.sql.ansi.enabled=false;spark.sql.adaptive.enabled=false"
    for setting in filter(None, os.environ.get("TEST_CONF", "").split(";")):
        builder = builder.config(*setting.split("=", 1))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def ansi(spark, request):
    """Set the session's ANSI flag and time zone for one test, then put them back."""
    flag, zone = request.param
    before = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    spark.conf.set("spark.sql.ansi.enabled", flag)
    spark.conf.set("spark.sql.session.timeZone", zone)
    yield flag, zone
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_small():
    return os.path.join(TESTDATA, "sf0.001")


@pytest.fixture(scope="session")
def sf_oracle():
    return os.path.join(TESTDATA, os.environ.get("ORACLE_SF", "sf0.01"))
