"""Table rows as files, so that the file readers can be checked against the tables.

Every embedding becomes an 8x8 bitmap and every page an HTML file, one file per row as in an image
collection, below `label=<class>/`. Each file ends with a line feed. On a shared local folder tasks write the files
themselves: Hadoop's local file system starts four `chmod` processes for each file it creates. On
any other store Spark's text writer does it. A lost task leaves no half-written file behind either way.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.session import shared_dir

FILES_PER_TASK = 256
SIDE = 8
SHAPE = (SIDE, SIDE, 3)

_staged: dict[tuple[str, str], str] = {}


def bitmap_header(side: int = SIDE) -> bytes:
    """Header of an uncompressed 24-bit bitmap of side x side pixels, stored bottom row first.

    `side` has to be a multiple of four, else the rows would need padding.
    """
    size = side * side * 3
    info = struct.pack("<IiiHHIIiiII", 40, side, side, 1, 24, 0, size, 2835, 2835, 0, 0)
    return struct.pack("<2sIHHI", b"BM", 54 + size, 0, 0, 54) + info


def gray_level(value: Column) -> Column:
    """An embedding value as a pixel level from 0 to 255."""
    level = F.floor(F.lit(128) + 400 * value.cast("double"))
    return F.least(F.lit(255), F.greatest(F.lit(0), level)).cast("int")


def bitmap(embedding: Column) -> Column:
    """Bitmap file of one embedding: level p gives blue 7p mod 256, green 255-p and red p."""

    def pixel(value: Column) -> Column:
        p = gray_level(value)
        return F.concat(*[F.lpad(F.hex(c), 2, "0") for c in ((p * 7) % 256, 255 - p, p)])

    pixels = F.unhex(F.concat_ws("", F.transform(embedding, pixel)))
    return F.concat(F.unhex(F.lit(bitmap_header().hex())), pixels)


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, value): the class and the bytes of each file to be."""
    images = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("label").cast("string").alias("label"),
        bitmap(F.col("embedding")).cast("string").alias("value"),
    )
    notes = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.lit("page").alias("label"), F.col("html").alias("value")
    )
    return images.unionByName(notes)


def staged_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the files of `sf_dir`, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        root = shared_dir(spark, "files")
        write_files(file_rows(spark, sf_dir), root)
        _staged[key] = root
    return _staged[key]


def write_files(rows: DataFrame, root: str) -> None:
    """Each row of (label, value) as a file of its own, `<root>/label=<label>/*.txt`."""
    # a task writes its files in turn: as many tasks as it takes for FILES_PER_TASK each
    rows = rows.repartition(-(-rows.count() // FILES_PER_TASK) or 1)
    folder = local_folder(rows.sparkSession, root)
    if folder is None:
        # tasks put their own files in place; names are the same in every attempt
        writer = rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.partitionBy("label").option("maxRecordsPerFile", 1).text(root)
        return
    os.makedirs(folder)
    label = F.coalesce("label", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("label")
    # sorted, so that another attempt of a task gives its files the same names
    rows = rows.select(label, F.col("value").cast("binary").alias("value")).sortWithinPartitions("label", "value")
    rows.mapInArrow(_file_writer(folder), "files bigint").write.format("noop").mode("overwrite").save()


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The local name of a path, or None on another store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if system.getUri().getScheme() != "file":
        return None
    return system.makeQualified(path).toUri().getPath()


def _file_writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, number, made = f"part-{task.partitionId():06d}", 0, set()
        for batch in batches:
            for label, value in zip(batch.column("label").to_pylist(), batch.column("value").to_pylist()):
                parent = f"{folder}/label={label}"
                if label not in made:
                    os.makedirs(parent, exist_ok=True)
                    made.add(label)
                # readers skip names that begin with `_`
                unfinished = f"{parent}/_{name}-{number}-{task.taskAttemptId()}"
                with open(unfinished, "wb") as file:
                    file.write((value or b"") + b"\n")
                os.replace(unfinished, f"{parent}/{name}-{number}.txt")
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], ["files"])

    return write
