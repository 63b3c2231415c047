import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ledgerline.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]").appName("ledgerline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
