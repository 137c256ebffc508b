"""The library on a Spark without any settings of its own."""

import os
import subprocess
import sys

from tests.conftest import ROOT

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from workbench.session import ensure_checkpoint_dir, materialised
first = ensure_checkpoint_dir(spark)
assert materialised(spark.range(3), "t").count() == 3
assert spark.range(4).checkpoint().count() == 4
again = ensure_checkpoint_dir(spark)
assert first in again, (first, again)
print("fine")
"""


def test_no_setting_is_needed_in_local_mode(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0 and done.stdout.strip().endswith("fine"), done.stderr[-2000:]
