"""Batch featurization: one Arrow UDF that loads the model once and feeds it whole batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fovea.functions.tensors import global_pool
from fovea.operators.images import Stacker
from fovea.session import ship_package

Model = Callable[[np.ndarray], np.ndarray]

# Groups that the tasks of a report are merged in.
MERGED = 64
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of raw files that are decoded and scored together.
BATCH_BYTES = 64 << 20

# Models that a worker keeps; the one unused for longest goes.
KEPT_MODELS = 4

_worker_models: dict[str, Model] = {}


def _load_once(key: str, factory: Callable[[], Model]) -> Model:
    """The model of this Python worker; reused workers keep it from task to task."""
    model = _worker_models.pop(key) if key in _worker_models else factory()
    _worker_models[key] = model
    while len(_worker_models) > KEPT_MODELS:
        del _worker_models[next(iter(_worker_models))]
    return model


def set_batch_rows(spark: SparkSession, rows: int) -> None:
    """Bound the rows per Arrow batch of the whole session, for records large enough to exhaust a worker."""
    spark.conf.set(ARROW_ROWS, str(rows))


def set_batch_bytes(spark: SparkSession, size: int) -> None:
    """Bound the bytes per Arrow batch of the whole session; a single larger record is a batch of its own."""
    spark.conf.set(ARROW_BYTES, str(size))


def batch_bounds(sizes: np.ndarray, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive (begin, end) of at most `rows` records and `size` bytes; a larger record stands alone."""
    begin = total = 0
    for at, own in enumerate(sizes.tolist()):
        if at > begin and (at - begin >= rows or total + own > size):
            yield begin, at
            begin, total = at, 0
        total += own
    if begin < len(sizes):
        yield begin, len(sizes)


def _bytes_of(batch: pa.Array) -> np.ndarray:
    """Bytes of each record's content; 0 where it is NULL or has a fixed size."""
    if pa.types.is_struct(batch.type):  # a decoded image
        names = [field.name for field in batch.type if _has_bytes(field.type)]
        return sum((_bytes_of(batch.field(name)) for name in names), np.zeros(len(batch), np.int64))
    if not _has_bytes(batch.type):
        return np.zeros(len(batch), np.int64)
    return pc.binary_length(batch).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _has_bytes(kind: pa.DataType) -> bool:
    return pa.types.is_binary(kind) or pa.types.is_large_binary(kind) or pa.types.is_string(kind)


def _feature_column(features: list[np.ndarray], good: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list per input row: the next feature vector where `good`, else NULL."""
    values = np.concatenate(features) if features else np.empty((0, 0))
    width = values.shape[1]
    offsets = np.concatenate([[0], np.cumsum(np.where(good, width, 0))]).astype(np.int32)
    flat = pa.array(np.ascontiguousarray(values).reshape(-1), kind)
    return pa.ListArray.from_arrays(offsets, flat, mask=pa.array(~good))


def feature_udf(
    model_factory: Callable[[], Model],
    stack: Stacker,
    batch_rows: int = 1024,
    element: str = "float",
    batch_bytes: int = BATCH_BYTES,
):
    """Arrow UDF from an input column to struct(features, reason).

    Rows that `stack` refuses get a reason and no features instead of failing the task.
    """
    key = uuid.uuid4().hex
    kind = {"float": pa.float32(), "double": pa.float64()}[element]

    @F.arrow_udf(f"struct<features: array<{element}>, reason: string>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _load_once(key, model_factory)
        for batch in batches:
            features, reasons = [], []
            for start, end in batch_bounds(_bytes_of(batch), batch_rows, batch_bytes):
                tensor, refused = stack(batch.slice(start, end - start))
                reasons.extend(refused)
                if len(tensor):
                    output = np.asarray(model(tensor))
                    features.append(output.reshape(len(tensor), -1))
            good = np.array([reason is None for reason in reasons], dtype=bool)
            yield pa.StructArray.from_arrays(
                [_feature_column(features, good, kind), pa.array(reasons, pa.string())],
                names=["features", "reason"],
            )

    # Otherwise a filter on the result would be pushed below it with a second run of the model.
    return apply.asNondeterministic()


def featurize(
    df: DataFrame,
    model_factory: Callable[[], Model],
    stack: Stacker,
    input_col: str,
    keep: list[str],
    output_col: str = "features",
    reason_col: str = "reject_reason",
    batch_rows: int = 1024,
    partitions: int | None = None,
    partition_key: str | None = None,
    element: str = "float",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """`keep` columns plus the feature array and, where there is none, the reason.

    `model_factory` runs in the worker and returns a callable from a batch (rows first) to a
    batch; outputs of any rank are flattened to one vector a row. It sees every row once, whatever
    is filtered afterwards, so filter by path or class before. `partitions` spreads the input
    first. That shuffles the raw input, so leave it out where the scan already has enough tasks;
    with a unique `partition_key` the spread needs no sort to be repeatable. Arrow batches are cut to
    `batch_rows` records and `batch_bytes` of their contents, whichever comes first; what the session sends
    at a time is set by `set_batch_rows` and `set_batch_bytes`.
    """
    ship_package(df.sparkSession)
    rows = df.select(*keep, input_col) if input_col not in keep else df.select(*keep)
    if partitions:
        rows = rows.repartition(partitions, *([partition_key] if partition_key else []))
    apply = feature_udf(model_factory, stack, batch_rows, element, batch_bytes)
    return rows.select(*keep, apply(input_col).alias("_result")).select(
        *keep,
        F.col("_result.features").alias(output_col),
        F.col("_result.reason").alias(reason_col),
    )


def split_rejects(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows); stage `df` first if it is expensive to compute."""
    usable = df.where(F.col(reason_col).isNull()).drop(reason_col)
    return usable, df.where(F.col(reason_col).isNotNull())


def pooling_report(df: DataFrame, tensor_col: str, channels: int) -> DataFrame:
    """Max against average pooling over the whole table: overall statistics, and the mean over
    dimensions of the spread between rows (a low one means the pooling smooths).

    One pass computes both; tasks are merged in groups, then the groups' rows per channel.
    """
    poolings, metrics = ("max", "avg"), ("mean", "variance", "min", "max")
    # tasks next to each other are merged together, and only a few rows a channel are left after that
    near = F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("near")
    summary = df.groupBy(near).agg(
        *[
            Summarizer.metrics("count", *metrics)
            .summary(array_to_vector(global_pool(tensor_col, channels, how)))
            .alias(how)
            for how in poolings
        ]
    )

    def per_dimension(how: str) -> Column:
        zipped = F.arrays_zip(*[vector_to_array(f"{how}.{m}").alias(m) for m in metrics])
        count = F.col(f"{how}.count").alias("n")
        return F.transform(
            zipped,
            lambda dim, at: F.struct(
                F.lit(how).alias("pooling"), at.alias("dim"), count,
                *[dim[m].alias(m) for m in metrics],
            ),
        )

    parts = summary.select(F.inline(F.concat(*[per_dimension(how) for how in poolings])))
    dim = Window.partitionBy("pooling", "dim")
    center = F.sum(F.col("n") * F.col("mean")).over(dim) / F.sum("n").over(dim)
    apart = F.col("n") * (F.col("mean") - F.col("center")) ** 2
    dims = (
        parts.withColumn("center", center)
        .groupBy("pooling", "dim")
        .agg(
            F.sum("n").alias("n"),
            F.first("center").alias("mean"),
            F.sum((F.col("n") - 1) * F.col("variance") + apart).alias("squares"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
        )
    )
    n, count = F.max("n"), F.count(F.lit(1))
    between = n * count * F.var_pop("mean")
    return dims.groupBy("pooling").agg(
        F.avg("mean").alias("mean"),
        F.sqrt((F.sum("squares") + between) / (n * count - 1)).alias("stddev"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.avg(F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("mean_dim_stddev"),
    )


def pooling_quantiles(
    df: DataFrame,
    tensor_col: str,
    channels: int,
    quantiles: tuple[float, ...] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
) -> DataFrame:
    """(pooling, dim, quantile, value): quantiles of each pooled dimension over the whole table, both poolings.

    Tasks send a sketch of about `accuracy` values per dimension; the rank of a value is off by at most
    1 / `accuracy` of the rows, and exact for fewer rows than that.
    """
    pooled = F.array(
        *[F.struct(F.lit(how).alias("pooling"), global_pool(tensor_col, channels, how).alias("values"))
          for how in ("max", "avg")]
    )
    flat = df.select(F.inline(pooled)).select("pooling", F.posexplode("values").alias("dim", "value"))
    sketch = F.percentile_approx("value", list(quantiles), accuracy).alias("found")
    found = flat.groupBy("pooling", "dim").agg(sketch)
    asked = F.array(*map(F.lit, quantiles))
    pairs = F.arrays_zip(asked.alias("quantile"), F.col("found").alias("value"))
    return found.select("pooling", "dim", F.inline(pairs).alias("quantile", "value"))
