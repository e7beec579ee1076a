import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quadrat.session import builder

    shared = tmp_path_factory.mktemp("shared")
    s = builder("local[8]", 8).config("spark.driver.memory", "6g").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", str(shared / "warehouse")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
