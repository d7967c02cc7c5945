"""Stages that a later run takes up."""

from __future__ import annotations

import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from fovea.operators.images import file_stack
from fovea.plans.feature_table import build_feature_table
from fovea.session import finished_stage, input_fingerprint, shared_base
from fovea.sources.files import read_class_tree


@pytest.fixture
def tree(tmp_path):
    for name in ("a", "b"):
        (tmp_path / "tree" / name).mkdir(parents=True)
        for i in range(6):
            (tmp_path / "tree" / name / f"{i}.bin").write_bytes(bytes([i * 7 + ord(name), i * i]))
    return tmp_path / "tree"


def build(spark, tree, seen, **options):
    def decode(content):
        return np.frombuffer(content, np.uint8).reshape(1, 1, 2)

    def factory():
        def model(tensor):
            seen.add(len(tensor))
            return tensor.reshape(len(tensor), -1)

        return model

    options = {"identity": {"model": str(tree)}, "width": 2, "reduction": {"k": 2}, **options}
    table, _, _ = build_feature_table(
        read_class_tree(spark, str(tree)), factory, file_stack(decode, (1, 1, 2), preprocess=False), element="double", **options
    )
    return sorted((r["path"], tuple(r["features_std_pca"])) for r in table.collect())


def test_a_second_run_takes_up_the_features(spark, tree):
    seen = spark.sparkContext.accumulator(0)
    first = build(spark, tree, seen)
    assert seen.value == 12 and len(first) == 12
    assert build(spark, tree, seen) == first and seen.value == 12
    build(spark, tree, seen, batch_rows=5)  # another parameter
    assert seen.value == 24
    build(spark, tree, seen, identity={"model": "another"})
    assert seen.value == 36
    (tree / "a" / "new.bin").write_bytes(b"xy")  # other files
    assert len(build(spark, tree, seen)) == 13 and seen.value == 49
    build(spark, tree, seen, identity=None)
    build(spark, tree, seen, identity=None)
    assert seen.value == 49 + 26


def test_a_stage_left_unfinished_is_written_anew(spark):
    df = spark.range(10)
    staged, found = finished_stage(df, "numbers", {"step": 1})
    assert not found and staged.count() == 10
    folder = os.path.join(shared_base(spark), "stages")
    path = os.path.join(folder, next(x for x in os.listdir(folder) if x.startswith("numbers")))
    os.remove(os.path.join(path, "_SUCCESS"))  # as after a driver was lost
    shutil.copy(next(os.path.join(path, x) for x in os.listdir(path) if x.startswith("part")), os.path.join(path, "part-x.parquet"))
    staged, found = finished_stage(df, "numbers", {"step": 1})
    assert not found and sorted(r["id"] for r in staged.collect()) == list(range(10))
    assert finished_stage(df, "numbers", {"step": 1})[1] and not finished_stage(df, "numbers", {"step": 2})[1]
    other = df.select(F.col("id").cast("int"))
    assert not finished_stage(other, "numbers", {"step": 1})[1]  # another schema


def test_fingerprints_do_not_depend_on_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    again = df.orderBy(F.desc("id")).repartition(3)
    assert input_fingerprint(df, ["id", "x"]) == input_fingerprint(again, ["id", "x"])
    assert input_fingerprint(df, ["id", "x"]) != input_fingerprint(df.limit(99), ["id", "x"])
    assert input_fingerprint(df.limit(0), ["id"]) == "0:0"


def test_the_staging_folder_must_be_shared():
    class Conf:
        @staticmethod
        def get(name, *default):
            return default[0] if name == "spark.checkpoint.dir" else "file:/warehouse"

    class Session:
        conf = Conf
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_base(Session)
    Session.sparkContext.master = "local[2]"
    assert shared_base(Session) == "file:/warehouse/fovea-scratch"
