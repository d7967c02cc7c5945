"""Packing a class tree again and again, each time only the files that are new or have changed.

    <out>/data/00000007/     (path, length, content, class) of one batch of files
    <out>/files/00000007/    (path, length, modificationTime, class) of the same files: the manifest

A batch holds files of a few class folders. Its manifest is written after its data, and a batch counts once
its manifest is complete (Spark marks that with `_SUCCESS`). So a run that fails halfway keeps the batches it
finished; the next one takes up what is missing, under the number that failed, and no row comes
twice. A file that changed is packed anew; readers see the newest version of each path.

One run at a time may write to `out`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.functions.paths import path_segments
from fovea.sources.files import _two_levels, class_folders, literal_path, read_binary

DIGITS = 8
#: Class folders that the driver lists at a time, and paths that one reader is given at a time.
FOLDERS_AT_ONCE, PATHS_AT_ONCE = 64, 10_000
DATA = "path string, length bigint, content binary, class string"
FILES = "path string, length bigint, modificationTime timestamp, class string"


def _batches(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the complete batches, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/files/*/_SUCCESS")
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = system.globStatus(path) or []
    return sorted(int(status.getPath().getParent().getName()) for status in found)


def _union(spark: SparkSession, out: str, what: str, schema: str) -> DataFrame:
    """The rows of all complete batches with `batch`, their number."""
    batches = _batches(spark, out)
    if not batches:
        return spark.createDataFrame([], f"{schema}, batch bigint")
    folders = [f"{out}/{what}/{number:0{DIGITS}}" for number in batches]
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/([0-9]+)/[^/]*$", 1)
    return spark.read.schema(schema).parquet(*folders).withColumn("batch", number.cast("bigint"))


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """(path, length, modificationTime, class, batch) of the newest version of every file packed so far."""
    rows = _union(spark, out, "files", FILES)
    newest = F.max_by(F.struct("length", "modificationTime", "class", "batch"), "batch").alias("_newest")
    return rows.groupBy("path").agg(newest).select("path", "_newest.*")


def changed_files(spark: SparkSession, listing: DataFrame, packed: DataFrame) -> DataFrame:
    """Rows of a listing (path, length, modificationTime) that the manifest does not hold just so, with
    `change`: new or changed. Contents are not read."""
    known = packed.select("path", F.col("length").alias("_length"), F.col("modificationTime").alias("_time"))
    rows = listing.select("path", "length", "modificationTime").join(known, "path", "left")
    new = F.col("_length").isNull()
    rows = rows.withColumn("change", F.when(new, F.lit("new")).otherwise(F.lit("changed")))
    differs = new | (F.col("length") != F.col("_length")) | (F.col("modificationTime") != F.col("_time"))
    return rows.where(differs).drop("_length", "_time")


def missing_files(spark: SparkSession, root: str, out: str, pattern: str | None = None) -> DataFrame:
    """The manifest's rows of files that the class tree no longer has."""
    folders = class_folders(spark, root)
    listing = read_binary(spark, [literal_path(f) for f in folders], pattern, recursive=True)
    return manifest(spark, out).join(_two_levels(listing, folders).select("path"), "path", "left_anti")


def pack_changed(
    spark: SparkSession,
    root: str,
    out: str,
    pattern: str | None = None,
    folders_at_once: int = FOLDERS_AT_ONCE,
) -> int:
    """Pack the files of `<root>/*/*` that are new or changed since the last call; returns their number.

    The driver lists `folders_at_once` class folders at a time (one, where a class has very many files) and
    holds the paths of their changed files.
    """
    total = 0
    folders = class_folders(spark, root)
    for begin in range(0, len(folders), folders_at_once):
        group = [literal_path(folder) for folder in folders[begin : begin + folders_at_once]]
        listing = _two_levels(read_binary(spark, group, pattern, recursive=True), folders)
        changed = changed_files(spark, listing, manifest(spark, out)).select("path")
        paths = sorted(row["path"] for row in changed.collect())
        for low in range(0, len(paths), PATHS_AT_ONCE):
            total += _pack_batch(spark, out, paths[low : low + PATHS_AT_ONCE], folders[0].count("/") + 1)
    return total


def _pack_batch(spark: SparkSession, out: str, paths: list[str], depth: int) -> int:
    """One more batch; `depth` is the number of the path's part that names the class."""
    number = max(_batches(spark, out), default=0) + 1
    rows = read_binary(spark, [literal_path(path) for path in paths])
    rows = rows.withColumn("class", F.element_at(path_segments("path"), depth))
    target = f"{number:0{DIGITS}}"
    rows.select("path", "length", "content", "class").write.mode("overwrite").parquet(f"{out}/data/{target}")
    # times are taken from the same listing as the contents; a file that changes later is seen next time
    files = rows.select("path", "length", "modificationTime", "class")
    files.write.mode("overwrite").parquet(f"{out}/files/{target}")
    return len(paths)


def read_current(spark: SparkSession, out: str) -> DataFrame:
    """(path, length, content, class) of the newest version of every packed file.

    Only rows of files that were packed more than once are looked up, so contents are not shuffled as long
    as those are few.
    """
    rows = _union(spark, out, "data", DATA)
    files = _union(spark, out, "files", FILES)
    again = files.groupBy("path").agg(F.max("batch").alias("_newest"), F.count("*").alias("_n")).where("_n > 1")
    older = files.join(again, "path").where(F.col("batch") < F.col("_newest")).select("path", "batch")
    return rows.join(older, ["path", "batch"], "left_anti").select("path", "length", "content", "class")
