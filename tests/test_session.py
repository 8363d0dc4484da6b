"""Sessions without a preset checkpoint folder, and workers that cannot import this package."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT, SF0001

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from ledgerloom.session import checkpoint_dir, get_spark
spark = get_spark(master="local[2]", shuffle_partitions=2)
folder = checkpoint_dir(spark)
assert folder and checkpoint_dir(spark) == folder
import __spark_entry__
queries = __spark_entry__.queries()
for name in {names!r}:
    if name in queries:
        queries[name](spark, {sf!r}).write.format("noop").mode("overwrite").save()
        print("ran", name)
"""


@pytest.mark.parametrize("names", [["merchants_resolve", "merchants_substring"], ["op5_toxicity", "op12_centroid_clustering", "op13_vector_codes"]])
def test_runs_away_from_the_repository(tmp_path, names):
    (tmp_path / "conf").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    script = SCRIPT.format(root=ROOT, names=names, sf=SF0001)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
