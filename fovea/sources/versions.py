"""Tables that are replaced as a whole without ever being gone.

    <root>/data/00000003/      one folder per version, written once and never changed
    <root>/log/00000003        one small file per commit, which names the folder that counts from then on

A write goes to a folder of its own, and only when it is complete a log file is created that must not
exist yet. A write that fails, or is killed, leaves the log and with it the table as it was; of two
writers at a time the later one fails to commit. Readers resolve the newest log file, or an older one.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

DIGITS = 8


class CommitConflict(RuntimeError):
    """Another writer committed a version in the meantime."""


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _numbers(spark: SparkSession, root: str, what: str) -> list[int]:
    path, system = _path(spark, root, what)
    if not system.exists(path):
        return []
    names = (status.getPath().getName() for status in system.listStatus(path))
    return sorted(int(name) for name in names if name.isdigit())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    return _numbers(spark, root, "log")


def _folder(spark: SparkSession, root: str, version: int) -> str:
    path, system = _path(spark, root, "log", f"{version:0{DIGITS}}")
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)["folder"]


def _commit(spark: SparkSession, root: str, version: int, folder: str) -> None:
    path, system = _path(spark, root, "log", f"{version:0{DIGITS}}")
    try:
        stream = system.create(path, False)  # fails if it exists
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            raise CommitConflict(f"version {version} of {root} was committed by another writer") from error
        raise
    stream.write(bytearray(json.dumps({"version": version, "folder": folder}).encode()))
    stream.close()


def write_version(
    df: DataFrame, root: str, partition_by: str | None = None, base: int | None = None
) -> int:
    """Write `df` as the next version of the table and commit it; returns the version's number.

    With `base`, the number of the version that `df` was made from, a commit by another writer since then is
    a conflict too. `df` may read the table itself. As in `write_table`, `partition_by` groups rows by the
    rebalance hint.
    """
    spark = df.sparkSession
    committed = versions(spark, root)
    last = committed[-1] if committed else 0
    if base is not None and base != last:
        raise CommitConflict(f"{root} is at version {last}, not {base}")
    # a folder of a write that failed keeps its number
    number = max([last, *_numbers(spark, root, "data")]) + 1
    folder = f"{number:0{DIGITS}}"
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{root}/data/{folder}")
    _commit(spark, root, last + 1, folder)
    return last + 1


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one of that number."""
    committed = versions(spark, root)
    if not committed:
        raise FileNotFoundError(f"no version of {root} is committed")
    version = committed[-1] if version is None else version
    if version not in committed:
        raise FileNotFoundError(f"{root} has no version {version}; there are {committed}")
    return spark.read.parquet(f"{root}/data/{_folder(spark, root, version)}")


def restore_version(spark: SparkSession, root: str, version: int) -> int:
    """Make an older version the newest again, without copying it; returns its new number."""
    committed = versions(spark, root)
    if version not in committed:
        raise FileNotFoundError(f"{root} has no version {version}; there are {committed}")
    _commit(spark, root, committed[-1] + 1, _folder(spark, root, version))
    return committed[-1] + 1


def drop_versions(spark: SparkSession, root: str, keep: int) -> int:
    """Delete all but the newest `keep` versions, and what failed writes left; returns the folders deleted.

    Not while a write is under way, nor while a query reads an older version.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    committed = versions(spark, root)
    used = {_folder(spark, root, version) for version in committed[-keep:]}
    for version in committed[:-keep]:
        path, system = _path(spark, root, "log", f"{version:0{DIGITS}}")
        system.delete(path, False)
    gone = [number for number in _numbers(spark, root, "data") if f"{number:0{DIGITS}}" not in used]
    for number in gone:
        path, system = _path(spark, root, "data", f"{number:0{DIGITS}}")
        system.delete(path, True)
    return len(gone)
