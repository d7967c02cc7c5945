from __future__ import annotations

import os

import numpy as np
import pytest
from fixture_files import png
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import picture
from fovea import session
from fovea.functions.paths import class_from_path, plain_path
from fovea.sources import files, object_store, sinks


def test_class_tree_has_the_files_of_the_classes(spark, image_root):
    df = files.read_class_tree(spark, image_root)
    assert df.columns == ["path", "modificationTime", "length", "content"]
    counts = df.groupBy(class_from_path("path").alias("c")).count().collect()
    assert {r["c"]: r["count"] for r in counts} == {"Apple Red": 6, "Pear": 4, "Plum": 5}


@pytest.mark.parametrize("name", ["plain", "[odd] {name}", "with*star", "."])
def test_class_tree_is_the_two_level_glob(spark, tmp_path, name):
    root = tmp_path / name
    (root / "a" / "deep" / "deeper").mkdir(parents=True)
    (root / "b c").mkdir()
    for file in ("a/x.bin", "a/deep/y.bin", "a/deep/deeper/w.bin", "b c/v.bin", "z.bin"):
        (root / file).write_text(file)
    spelled = files.literal_path(str(tmp_path)) + "/" + (files.literal_path(name))
    tree = files.read_class_tree(spark, spelled).select("path", "length")
    glob = files.read_binary(spark, spelled + "/*/*").select("path", "length")
    assert sorted(tree.collect()) == sorted(glob.collect())
    assert {r["path"].rsplit("/", 1)[1] for r in tree.collect()} == {"x.bin", "y.bin", "v.bin"}


def test_class_tree_of_a_glob_or_relative_root(spark, image_root):
    parent = image_root.rsplit("/", 1)[0]
    assert files.read_class_tree(spark, parent + "/train*").count() == 15
    assert files.read_class_tree(spark, image_root + "/.").count() == 15
    with pytest.raises(FileNotFoundError, match="no class folder"):
        files.read_class_tree(spark, image_root + "/nowhere")


def test_packed_files_are_the_files(spark, image_root, tmp_path):
    out = str(tmp_path / "packed")
    files.pack_files(spark, image_root, out)
    packed = files.read_packed(spark, out)
    tree = files.read_class_tree(spark, image_root).select("path", "length", "content")
    assert packed.select("path", "length", "content").exceptAll(tree).count() == 0
    assert packed.count() == 15
    assert {r["class"] for r in packed.collect()} == {"Apple Red", "Pear", "Plum"}


def test_pattern_and_recursion(spark, image_root):
    assert files.read_class_tree(spark, image_root, "*.txt").count() == 1
    everything = files.read_binary(spark, image_root, recursive=True)
    assert everything.count() == 16
    listed = files.read_binary(spark, [image_root + "/Pear", image_root + "/Plum"])
    assert listed.count() == 9


def test_binary_content_is_the_file(spark, image_root):
    row = (
        files.read_class_tree(spark, image_root)
        .where(F.col("path").endswith("Apple Red/3.png"))
        .first()
    )
    expected = png(picture(3))
    assert bytes(row["content"]) == expected and row["length"] == len(expected)


def test_images_are_bgr_top_row_first(spark, image_root):
    images = files.read_images(spark, image_root + "/*", drop_invalid=True)
    row = images.where(F.col("image.origin").endswith("Apple%20Red/3.png")).first()["image"]
    found = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], 3)
    assert (found == picture(3)[..., ::-1]).all()


def test_images_and_files_share_paths(spark, image_root):
    images = files.read_image_tree(spark, image_root).select("path")
    raw = files.read_class_tree(spark, image_root).select("path")
    assert images.count() == 15 and images.exceptAll(raw).count() == 0
    valid = files.read_image_tree(spark, image_root, drop_invalid=True)
    assert valid.count() == 13 and valid.columns == ["path", "image"]


def test_invalid_images_are_marked(spark, image_root):
    images = files.read_images(spark, image_root + "/Pear")
    bad = images.where("image.height < 0").select(plain_path("image.origin").alias("p")).collect()
    assert sorted(r.p.rsplit("/", 1)[1] for r in bad) == ["bad.png", "notes.txt"]


def test_list_files(spark, image_root, tmp_path):
    pear = files.list_files(spark, image_root + "/Pear")
    assert "content" not in pear.columns and pear.count() == 4
    assert files.list_files(spark, image_root, recursive=True).count() == 16
    out = str(tmp_path / "out")
    sinks.write_table(spark.range(10).coalesce(1), out)
    names = [r["path"] for r in files.list_files(spark, out).collect()]
    assert len(names) == 1 and names[0].endswith(".parquet")


def test_inventory(spark, image_root):
    rows = files.dataset_inventory(files.read_class_tree(spark, image_root)).collect()
    assert {r["class"]: r["n_files"] for r in rows} == {"Apple Red": 6, "Pear": 4, "Plum": 5}
    total = sum(r["total_bytes"] for r in rows)
    assert total == files.read_class_tree(spark, image_root).agg(F.sum("length")).first()[0]


def test_small_files_share_tasks(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for i in range(200):
        (tmp_path / "c" / f"{i}.bin").write_bytes(b"x" * 100)
    names = ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        partitions = {}
        for per_task in (1, 10, 1000):
            files.plan_small_files(spark, per_task)
            scan = files.read_class_tree(spark, str(tmp_path)).select("length")
            partitions[per_task] = scan.rdd.getNumPartitions()
        assert partitions[1] >= 190
        assert 8 <= partitions[10] <= 30
        # fewer files than one task could take are still spread over the cores
        assert 4 <= partitions[1000] <= 12
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_delimited_with_spaces_in_names(spark, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text("User name,Access key ID,Secret access key\nann,A1,S/K+=\nbob,B1,t\n")
    df = files.read_delimited(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3
    settings = object_store.store_settings_from_table(df, "ann", "pictures", endpoint="http://e")
    assert settings == {
        "fs.s3a.bucket.pictures.access.key": "A1",
        "fs.s3a.bucket.pictures.secret.key": "S/K+=",
        "fs.s3a.bucket.pictures.endpoint": "http://e",
    }
    with pytest.raises(LookupError):
        object_store.store_settings_from_table(df, "eve", "pictures")


def test_store_settings_reach_the_session(spark):
    object_store.use_store(spark, object_store.store_settings("b", "A", "S"))
    assert spark.conf.get("fs.s3a.bucket.b.access.key") == "A"
    assert object_store.store_uri("b", "train/", "/x") == "s3a://b/train/x"


def test_delimited_with_schema_and_separator(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a;b\n1;x\n2;y\n")
    df = files.read_delimited(spark, str(path), "a int, b string", sep=";")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, "y")]


def test_second_write_fails_by_default(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_table(spark.range(3), path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_table(spark.range(3), path)
    sinks.write_table(spark.range(5), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(3), path, mode="append")


def test_partitioned_write_splits_a_hot_class(spark, tmp_path):
    """Two thirds of the rows are of one class; its rows must not end up in one task."""
    path = str(tmp_path / "out")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        df = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7))
            .alias("class"),
            F.rand(1).alias("x"),
        )
        sinks.write_table(df, path, partition_by="class")
    finally:
        spark.conf.set(name, before)
    written = spark.read.parquet(path)
    assert written.count() == 120_000
    per_file = written.where("class = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 3


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert first.startswith(base + "/x-") and first != second


def test_shared_dir_without_the_setting_is_in_the_warehouse():
    class Conf:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}.get(name, default)

    class Context:
        applicationId = "none"

    class Session:
        conf, sparkContext = Conf(), Context()

    assert session.shared_dir(Session(), "x").startswith("hdfs://store/warehouse/fovea-scratch/x-")


def test_staged_tables_can_be_deleted(spark, monkeypatch):
    monkeypatch.setattr(session, "_shared", {})
    staged = session.stage(spark.range(3), "gone")
    folder = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    assert session.clear_shared(spark) == 1 and not os.path.exists(folder)
    assert session.clear_shared(spark) == 0


def test_stage_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, [1.0, None], bytearray(b"x"))], "a int, f array<float>, b binary")
    staged = session.stage(df, "t")
    assert staged.schema == df.schema and staged.collect() == df.collect()
    assert "Scan parquet" in staged._jdf.queryExecution().executedPlan().toString()
