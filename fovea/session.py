"""Session defaults, the shared scratch folder, and staging of intermediate tables."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))

_shared: dict[str, list[str]] = {}


def build_session(app_name: str = "fovea", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tested with; `conf` keys use `__` for dots."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # rows that go to a Python worker at a time; records of images are large
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        # a scan task takes about a thousand small files
        "spark.sql.files.openCostInBytes": "128k",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder the cluster shares: `spark.checkpoint.dir`.

    Where that is unset, a folder in the warehouse. A warehouse in a local folder of the driver will do for a
    session in one process; on a cluster executors would not see it, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/fovea-scratch"
        if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the folder the cluster shares.

    `clear_shared` deletes what was written under these names.
    """
    folder = f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"
    _shared.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear_shared(spark: SparkSession) -> int:
    """Delete the folders that this application was given by `shared_dir`; the number of them.

    Call it when no DataFrame that reads a staged table is needed any more.
    """
    folders = _shared.pop(spark.sparkContext.applicationId, [])
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(configuration).delete(path, True)
    return len(folders)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Compute `df` once into a Parquet table in the shared folder and continue from that table.

    Every later pass reads columns from storage, so neither another pass nor a lost executor runs
    the upstream work (file reads, model inference) again.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished_stage(df: DataFrame, purpose: str, identity: dict) -> tuple[DataFrame, bool]:
    """`df` staged under a name made of `identity`, and whether an earlier run had finished it already.

    `identity` holds whatever the result depends on, as values that JSON can hold: versions and parameters
    of the steps, and a fingerprint of the input (`input_fingerprint`). A stage that a lost driver left
    unfinished is written anew. Such stages outlive the application and are not deleted by `clear_shared`.
    """
    text = json.dumps({"schema": df.schema.jsonValue(), **identity}, sort_keys=True)
    path = f"{shared_base(df.sparkSession)}/stages/{purpose}-{hashlib.sha256(text.encode()).hexdigest()[:32]}"
    marker = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    system = marker.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf())
    found = system.exists(marker)
    if not found:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), found


def input_fingerprint(df: DataFrame, columns: list[str]) -> str:
    """Number of rows and sum of their hashes over `columns`, whatever the order of the rows.

    For files, take path, length and modificationTime: no contents are read.
    """
    total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    row = df.agg(F.count("*").alias("n"), F.coalesce(total, F.lit(0)).cast("string").alias("total")).first()
    return f"{row['n']}:{row['total']}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per SparkContext."""
    context = spark.sparkContext
    archive = "fovea_package.zip"
    if any(name.endswith(archive) for name in context.listFiles):
        return
    folder = os.path.join(SparkFiles.getRootDirectory(), "outgoing")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, archive)
    with zipfile.ZipFile(target, "w") as bundle:
        for parent, _, names in os.walk(PACKAGE_DIR):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(parent, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(PACKAGE_DIR)))
    context.addPyFile(target)
