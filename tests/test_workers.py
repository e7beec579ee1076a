"""Queries whose functions run in Python workers need the package on the driver's path alone."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
import corpus_pipeline
from quadrat.session import builder
spark = builder("local[2]", 2).config("spark.checkpoint.dir", "file://" + sys.argv[2]).getOrCreate()
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
for _, stage in corpus_pipeline.STAGES[:2]:
    docs = stage(spark, docs, "/root/testdata/sf0.001")
assert docs.count() > 0
"""

URLS = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__
from quadrat.session import builder, ship
spark = builder("local[2]", 2).config("spark.checkpoint.dir", "file://" + sys.argv[2]).getOrCreate()
ship(spark)
got = __spark_entry__.queries()["op3_url_filter"](spark, "/root/testdata/sf0.001").collect()
assert len(got) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
"""

STAGE = """
import sys
sys.path.insert(0, sys.argv[1])
import corpus_pipeline
from quadrat.session import builder
spark = builder("local[2]", 2).config("spark.checkpoint.dir", "file://" + sys.argv[2]).getOrCreate()
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
assert corpus_pipeline.STAGES[%d][1](spark, docs, "/root/testdata/sf0.001").count() > 0
"""


@pytest.mark.parametrize("code", [CODE, URLS, *[STAGE % k for k in (2, 4)]])
def test_package_reaches_workers(tmp_path, code):
    root = str(Path(__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code, root, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-2000:]
