"""What several operators of this subpackage share: staging, sizes, batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.session import ship_package, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    return stage(df, purpose)


def prepare(spark: SparkSession) -> None:
    """Python workers can import this package."""
    ship_package(spark)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: str) -> Iterator[None]:
    """What is computed inside sends at most so many rows and bytes to a Python worker at a time.

    Texts are held in the executor and in the worker, there as Arrow and as Python strings too.
    """
    settings = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": size,
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def row_slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive (begin, end) of rows whose sizes add up to about `limit`, one row at least."""
    begin = total = 0
    end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield begin, end
            begin, total = end, 0
    if end > begin:
        yield begin, end


def running_offsets(totals: DataFrame, key: str, total: str, fan_in: int = 1024) -> DataFrame:
    """(key, offset): the sum of `total` over all smaller keys (non-negative whole numbers).

    Two levels, so that no task adds up more than `fan_in` keys, or one number for each `fan_in` of
    them: keys are task numbers or bucket numbers, never rows.
    """
    from pyspark.sql import Window

    before = lambda w: F.coalesce(
        F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    block = F.floor(F.col(key) / fan_in).alias("_block")
    keyed = totals.select(key, total, block)
    inner = keyed.withColumn("_inner", before(Window.partitionBy("_block").orderBy(key)))
    blocks = keyed.groupBy("_block").agg(F.sum(total).alias(total))
    outer = blocks.select("_block", before(Window.orderBy("_block")).alias("_outer"))
    return inner.join(F.broadcast(outer), "_block").select(
        key, (F.col("_inner") + F.col("_outer")).cast("bigint").alias("offset")
    )
