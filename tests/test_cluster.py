"""Queries on executors of their own, where a stream has no default for its state."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent
RUN = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__ as entry
name, sf_dir, work = sys.argv[1:]
spark = (SparkSession.builder.master("local-cluster[2,2,1024]")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.sql.session.timeZone", "UTC")
         .config("spark.executor.memory", "1024m").config("spark.checkpoint.dir", work)
         .getOrCreate())
entry.queries()[name](spark, sf_dir).write.parquet(f"{work}/result")
spark.stop()
"""


@pytest.mark.parametrize("name", ["stream_features_windowed", "stream_score_windowed",
                                  "stream_windows_growing"])
def test_stream_on_executors(spark, sf_dir, tmp_path, name):
    path = os.pathsep.join([str(REPO), os.environ.get("PYTHONPATH", "")])
    done = subprocess.run([sys.executable, "-c", RUN, name, sf_dir, str(tmp_path)], cwd=tmp_path,
                          env=os.environ | {"PYTHONPATH": path}, capture_output=True,
                          text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    found = spark.read.parquet(f"{tmp_path}/result")
    local = entry.queries()[name](spark, sf_dir)
    assert found.columns == local.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, local.collect()), key=repr)
