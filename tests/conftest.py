import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cardwatch.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .appName("cardwatch-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="cardwatch-warehouse-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="cardwatch-test-")
