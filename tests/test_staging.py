from __future__ import annotations

import os

from fovea.plans import staging

ROWS = [("1", b"BM\xff\x00\n"), ("1", b"same"), ("1", b"same"), ("page", b""), ("page", None), (None, "ä".encode())]


def _files(root: str) -> list[tuple[str, bytes]]:
    found = []
    for parent, _, names in os.walk(root):
        for name in names:
            if not name.startswith(("_", ".")):
                with open(os.path.join(parent, name), "rb") as file:
                    found.append((os.path.basename(parent), file.read()))
    return sorted(found)


def test_local_files_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "FILES_PER_TASK", 2)
    rows = spark.createDataFrame(ROWS, "label string, value binary")
    rows = rows.select("label", rows["value"].cast("string").alias("value"))
    staging.write_files(rows, f"file:{tmp_path}/own")
    monkeypatch.setattr(staging, "local_folder", lambda *_: None)
    staging.write_files(rows, f"file:{tmp_path}/sparks")
    own = _files(f"{tmp_path}/own")
    assert own == _files(f"{tmp_path}/sparks") and len(own) == len(ROWS)
    assert ("label=__HIVE_DEFAULT_PARTITION__", "ä\n".encode()) in own and own.count(("label=page", b"\n")) == 2


def test_local_files_are_not_created_by_hadoop(spark, tmp_path):
    """Each file that its local file system creates costs four processes; its checksum files show that it did."""
    rows = spark.createDataFrame([("1", "x"), ("2", "y")], "label string, value string")
    staging.write_files(rows, f"{tmp_path}/root")
    names = [name for _, _, names in os.walk(tmp_path / "root") for name in names]
    assert len(names) == 2 and not any(name.endswith(".crc") or name.startswith("_") for name in names)


def test_other_stores_have_no_local_folder(spark, tmp_path):
    assert staging.local_folder(spark, f"file:{tmp_path}/a b") == f"{tmp_path}/a b"
    spark.conf.set("fs.viewfs.mounttable.staging.link./t", f"file:{tmp_path}")
    assert staging.local_folder(spark, "viewfs://staging/t/x") is None
