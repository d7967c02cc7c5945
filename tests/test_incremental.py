"""Packing new files only, versioned tables, mounted names, and delimited text with its rejects."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fovea.sources import files, manifest, object_store, sinks, versions

# --- packing what is new


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree [a]"
    for name, n in (("Apple Red", 3), ("Pear", 2)):
        (root / name).mkdir(parents=True)
        for i in range(n):
            (root / name / f"{i} {{x}}.txt").write_text(f"{name} {i}")
    return root


def packed(spark, out):
    rows = manifest.read_current(spark, out).collect()
    assert len({r["path"] for r in rows}) == len(rows)
    return {r["class"] + "/" + os.path.basename(r["path"]): bytes(r["content"]).decode() for r in rows}


def pattern(tree):
    return files.literal_path(str(tree))


def test_only_new_and_changed_files_are_packed(spark, tree, tmp_path):
    out = str(tmp_path / "packed")
    assert manifest.pack_changed(spark, pattern(tree), out) == 5
    assert manifest.pack_changed(spark, pattern(tree), out) == 0
    (tree / "Pear" / "new.txt").write_text("new")
    (tree / "Apple Red" / "1 {x}.txt").write_text("changed, and longer")
    os.remove(tree / "Apple Red" / "0 {x}.txt")
    assert manifest.pack_changed(spark, pattern(tree), out) == 2
    assert packed(spark, out) == {
        "Apple Red/0 {x}.txt": "Apple Red 0", "Apple Red/1 {x}.txt": "changed, and longer",
        "Apple Red/2 {x}.txt": "Apple Red 2", "Pear/0 {x}.txt": "Pear 0", "Pear/1 {x}.txt": "Pear 1",
        "Pear/new.txt": "new",
    }
    gone = manifest.missing_files(spark, pattern(tree), out).collect()
    assert [os.path.basename(r["path"]) for r in gone] == ["0 {x}.txt"]
    state = {os.path.basename(r["path"]): r["batch"] for r in manifest.manifest(spark, out).collect() if r["class"] == "Pear"}
    assert state == {"0 {x}.txt": 1, "1 {x}.txt": 1, "new.txt": 2}


def test_a_run_that_failed_is_taken_up(spark, tree, tmp_path, monkeypatch):
    """It fails in the second class: once before the manifest, once while the data is written."""
    out = str(tmp_path / "packed")
    whole, calls = manifest._pack_batch, []

    def fails(spark, out, paths, depth):
        calls.append(paths)
        if len(calls) == 2:
            rows = spark.createDataFrame([("half", 4, bytearray(b"half"), "Pear")], manifest.DATA)
            rows.write.mode("overwrite").parquet(f"{out}/data/00000002")  # no manifest for it
            raise OSError("lost")
        return whole(spark, out, paths, depth)

    monkeypatch.setattr(manifest, "_pack_batch", fails)
    with pytest.raises(OSError, match="lost"):
        manifest.pack_changed(spark, pattern(tree), out, folders_at_once=1)
    assert len(packed(spark, out)) == 3
    monkeypatch.setattr(manifest, "_pack_batch", whole)
    assert manifest.pack_changed(spark, pattern(tree), out) == 2
    assert len(packed(spark, out)) == 5 and "half" not in packed(spark, out).values()
    monkeypatch.setattr(manifest, "PATHS_AT_ONCE", 1)
    for i in range(3):
        (tree / "Pear" / f"more{i}").write_text("m")
    assert manifest.pack_changed(spark, pattern(tree), out) == 3
    assert len(packed(spark, out)) == 8


def test_nothing_is_packed_yet(spark, tmp_path):
    assert manifest.read_current(spark, str(tmp_path / "none")).count() == 0
    assert manifest.manifest(spark, str(tmp_path / "none")).count() == 0


# --- versions


def rows_of(df):
    return sorted(r["id"] for r in df.collect())


def test_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError, match="no version"):
        versions.read_version(spark, root)
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    assert versions.write_version(df, root) == 1
    # the new version is made from the table itself
    assert versions.write_version(versions.read_version(spark, root).where("id < 4"), root, "part", base=1) == 2
    assert rows_of(versions.read_version(spark, root)) == [0, 1, 2, 3]
    assert rows_of(versions.read_version(spark, root, 1)) == list(range(10))
    assert versions.versions(spark, root) == [1, 2]
    with pytest.raises(FileNotFoundError, match="no version 7"):
        versions.read_version(spark, root, 7)
    assert versions.restore_version(spark, root, 1) == 3
    assert rows_of(versions.read_version(spark, root)) == list(range(10))
    assert versions.drop_versions(spark, root, 1) == 1  # version 2's folder; 3 uses that of 1
    assert versions.versions(spark, root) == [3] and rows_of(versions.read_version(spark, root)) == list(range(10))
    assert versions.write_version(df.limit(1), root) == 4
    with pytest.raises(ValueError):
        versions.drop_versions(spark, root, 0)


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    versions.write_version(spark.range(5), root)
    broken = spark.range(100).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        versions.write_version(broken, root)
    assert versions.versions(spark, root) == [1] and rows_of(versions.read_version(spark, root)) == list(range(5))
    assert versions.write_version(spark.range(6), root) == 2
    assert rows_of(versions.read_version(spark, root)) == list(range(6))
    assert versions.drop_versions(spark, root, 2) == 1  # what the failed write left


def test_the_later_of_two_writers_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    versions.write_version(spark.range(1), root)
    with pytest.raises(versions.CommitConflict, match="is at version 1"):
        versions.write_version(spark.range(3), root, base=0)
    commit = versions._commit

    def late(spark, root, version, folder):
        commit(spark, root, version, "00000001")  # another writer was first
        commit(spark, root, version, folder)

    monkeypatch.setattr(versions, "_commit", late)
    with pytest.raises(versions.CommitConflict, match="another writer"):
        versions.write_version(spark.range(3), root)
    assert rows_of(versions.read_version(spark, root)) == [0]


# --- mounted names


def test_readers_and_sinks_go_through_a_mount(spark, tree, tmp_path):
    name = "pictures-test"
    links = {"training": f"file://{tree.parent}/tree%20[a]", "/results/": f"file://{tmp_path}/results"}
    os.rename(tree, tmp_path / "plain")
    links["training"] = f"file://{tmp_path}/plain"
    object_store.use_store(spark, object_store.mount_settings(name, links))
    assert object_store.mounts(spark, name) == {"/training": links["training"], "/results": links["/results/"]}
    uri = object_store.mount_uri(name, "training")
    assert uri == "viewfs://pictures-test/training"
    found = files.read_class_tree(spark, uri)
    assert {r["path"] for r in found.select("path").collect()} and found.count() == 5
    assert all(r["path"].startswith(uri) for r in found.collect())
    counts = {r["class"]: r["n_files"] for r in files.dataset_inventory(found).collect()}
    assert counts == {"Apple Red": 3, "Pear": 2} or counts == {"Apple%20Red": 3, "Pear": 2}
    out = object_store.mount_uri(name, "/results/", "table")
    sinks.write_table(found.select("path", "length"), out)
    assert spark.read.parquet(out).count() == 5 and os.path.exists(f"{tmp_path}/results/table/_SUCCESS")
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(found.select("path"), out)
    versions.write_version(found.select("length"), object_store.mount_uri(name, "results", "versioned"))
    assert versions.read_version(spark, object_store.mount_uri(name, "results", "versioned")).count() == 5
    assert manifest.pack_changed(spark, uri, object_store.mount_uri(name, "results", "packed")) == 5
    # the same name may lead elsewhere later
    object_store.use_store(spark, object_store.mount_settings(name, {"training": f"file://{tmp_path}/results"}))
    assert files.list_files(spark, object_store.mount_uri(name, "training", "table")).count() > 0
    with pytest.raises(ValueError):
        object_store.mount_settings(name, {})


# --- delimited text


def test_lines_that_do_not_fit_are_told_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,name,when\n1,"x, y",2024-01-02\n2,short\n3,many,2024-01-03,more\nfour,z,2024-01-04\n'
        '5,z,not a day\n6,,\n,q,2024-01-05\nx,"say \\"hi\\", you",y\n'
    )
    (tmp_path / "b.csv").write_text("id,name,when\n7,last,2024-02-29\n")
    schema = "id bigint, name string, when date"
    rows, rejects = files.read_delimited_checked(spark, str(tmp_path), schema)
    assert rows.columns == ["id", "name", "when"]
    assert sorted((r["id"] or 0, r["name"], str(r["when"])) for r in rows.collect()) == [
        (0, "q", "2024-01-05"), (1, "x, y", "2024-01-02"), (6, None, "None"), (7, "last", "2024-02-29"),
    ]
    found = {r["line"]: (os.path.basename(r["path"]), r["reject_reason"]) for r in rejects.collect()}
    assert found == {
        "2,short": ("a.csv", "too few fields"),
        "3,many,2024-01-03,more": ("a.csv", "too many fields"),
        "four,z,2024-01-04": ("a.csv", "not of its type: id"),
        "5,z,not a day": ("a.csv", "not of its type: when"),
        'x,"say \\"hi\\", you",y': ("a.csv", "not of its type: id, when"),
    }
    # columns nobody asks for are checked all the same
    assert rows.select("name").count() == 4 and rejects.count() == 5


def test_delimited_text_of_other_shapes(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    rows, rejects = files.read_delimited_checked(spark, str(tmp_path / "none"), "a int, _corrupt string")
    assert rows.count() == rejects.count() == 0 and rows.columns == ["a", "_corrupt"]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "t.tsv").write_text("1|x\n2\n|\n")
    rows, rejects = files.read_delimited_checked(spark, str(tmp_path / "t"), "`a b` int, c string", "|", header=False)
    assert Counter((r["a b"], r["c"]) for r in rows.collect()) == Counter([(1, "x"), (None, None)])
    assert [(r["line"], r["reject_reason"]) for r in rejects.collect()] == [("2", "too few fields")]
