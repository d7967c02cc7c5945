"""Tasks that fail and run again must neither lose nor repeat rows."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext
from pyspark.sql import functions as F

from fovea.operators.featurize import featurize
from fovea.operators.images import tensor_stack
from fovea.operators.moments import feature_moments
from fovea.session import build_session, stage

spark = build_session("retries", master="local[4,4]", spark__checkpoint__dir=sys.argv[2])
spark.sparkContext.setLogLevel("OFF")


def factory():
    def predict(batch):
        task = TaskContext.get()
        if task.partitionId() % 2 and task.attemptNumber() < 2:
            raise RuntimeError("lost")
        return batch * 2

    return predict


rows = spark.range(0, 1000, 1, 8).select(
    "id", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("t")
)
spread = featurize(
    rows, factory, tensor_stack((2,)), "t", ["id"], batch_rows=50, partitions=6, partition_key="id"
)
staged = stage(spread, "features")
found = staged.select("id", F.get("features", F.lit(0)).alias("x")).orderBy("id").collect()
assert [(r["id"], r["x"]) for r in found] == [(i, 2.0 * i) for i in range(1000)]
moments = feature_moments(staged, "features")
assert moments.n == 1000 and moments.mean.tolist() == [999.0, 2.0]
spark.stop()
print("whole")
"""


def test_failed_tasks_are_repeated_whole(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    done = subprocess.run(
        [sys.executable, str(script), ROOT, str(tmp_path / "shared")],
        capture_output=True, text=True, timeout=300, check=False,
    )
    assert done.stdout.strip().endswith("whole"), done.stderr[-3000:]
