import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from estatelens.session import configure

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="estatelens-test-"))
    configure(s)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from harness import SF_SMALL, duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_mid():
    from harness import SF_MID, duck
    return duck(SF_MID)
