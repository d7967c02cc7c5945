"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

SAVE_MODES = ("errorifexists", "overwrite")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    file_format: str = "parquet",
    partition_by: str | None = None,
) -> None:
    """Write `df`; by default a second run on the same path fails instead of replacing it.

    With `partition_by`, the rebalance hint groups rows by that column so that not every task
    writes a file into every directory, and adaptive execution still splits a hot value.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, not {mode!r}")
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode(mode).format(file_format)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)
