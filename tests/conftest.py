import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    from offerboard.session import SQL_CONF
    b = (SparkSession.builder.master("local[4]").appName("offerboard-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
