"""Figures beyond the per-query bench: featurizer throughput, model runs per row, fit cost.

    python tools/measure.py            # prints Markdown tables
"""

from __future__ import annotations

import os
import sys
import time

import numpy as np
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from fovea.operators import reduce  # noqa: E402
from fovea.operators.backends import linear_model, not_pretrained_conv  # noqa: E402
from fovea.operators.featurize import featurize  # noqa: E402
from fovea.operators.images import decode_bitmap, file_stack, tensor_stack  # noqa: E402
from fovea.operators.moments import feature_moments  # noqa: E402
from fovea.plans.feature_table import build_feature_table  # noqa: E402
from fovea.plans.staging import bitmap_header  # noqa: E402
from fovea.session import build_session, shared_dir, stage  # noqa: E402
from fovea.sources.sinks import write_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))


def seconds(action, runs: int = 3) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return sorted(times)[len(times) // 2]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def random_features(spark, rows: int, width: int):
    def make(batches):
        for batch in batches:
            n = batch.num_rows
            seed = batch.column(0)[0].as_py() if n else 0
            values = np.random.default_rng(seed).normal(size=n * width).astype(np.float32)
            offsets = np.arange(n + 1, dtype=np.int32) * width
            lists = pa.ListArray.from_arrays(offsets, pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "features"])

    ids = spark.range(0, rows, 1, 2 * int(CPUS))
    return stage(ids.mapInArrow(make, "id bigint, features array<float>"), "measure")


def random_bitmaps(spark, rows: int):
    """100x100 bitmaps of random pixels."""
    header = bitmap_header(100)

    def make(batches):
        for batch in batches:
            rng = np.random.default_rng(batch.column(0)[0].as_py() if batch.num_rows else 0)
            contents = [header + rng.bytes(30_000) for _ in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(contents, pa.binary())], ["id", "content"]
            )

    ids = spark.range(0, rows, 1, 2 * int(CPUS))
    return stage(ids.mapInArrow(make, "id bigint, content binary"), "measure")


def featurizer(spark) -> None:
    print("| featurizer | rows | seconds | rows/s | model rows per input row |")
    print("|---|---|---|---|---|")
    embeddings = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    n = embeddings.count()
    weights = np.random.default_rng(0).normal(size=(64, 512)).astype(np.float32)
    cases = [
        ("linear 64 -> 512 on `embeddings`", embeddings, n, linear_model(spark, weights),
         tensor_stack((64,)), "embedding", "vec_id"),
        ("linear 64 -> 512 on generated rows", random_features(spark, 400_000, 64), 400_000,
         linear_model(spark, weights), tensor_stack((64,)), "features", "id"),
        ("3x3 convolution, 512 channels, on 100x100 bitmaps", random_bitmaps(spark, 4000), 4000,
         not_pretrained_conv(512), file_stack(decode_bitmap, (100, 100, 3)), "content", "id"),
    ]
    for name, df, rows, model, stack, column, key in cases:
        seen = spark.sparkContext.accumulator(0)

        def counted(model=model, seen=seen):
            loaded = model()

            def predict(batch):
                seen.add(len(batch))
                return loaded(batch)

            return predict

        out = featurize(df, counted, stack, column, [key])
        consume(out.where(F.col("reject_reason").isNull()))
        calls = seen.value / rows
        took = seconds(lambda: consume(featurize(df, model, stack, column, [key])))
        print(f"| {name} | {rows} | {took:.2f} | {rows / took:,.0f} | {calls:.2f} |", flush=True)


def fits(spark) -> None:
    print("\n| width | rows | scaler + full PCA on the data | one-pass moments "
          "| whole `fit_reduction` | project on all | project on k=24 |")
    print("|---|---|---|---|---|---|---|")
    for width in (64, 512):
        for rows in (2_000, 20_000, 200_000):
            features = random_features(spark, rows, width)
            df = reduce.with_vectors(features).select("features", "vectors")

            def direct():
                scaled = reduce.fit_scaler(df).transform(df)
                return reduce.fit_pca(scaled, "vectors_std")

            def short():
                return reduce.fit_reduction(df, features_col="features", threshold=0.1)

            scaler = reduce.fit_scaler(df)
            full = direct()
            cut = reduce.fit_pca(scaler.transform(df.limit(1000)), "vectors_std", k=24)
            took = [
                seconds(direct),
                seconds(lambda: feature_moments(df, "features")),
                seconds(short),
                seconds(lambda: consume(full.transform(scaler.transform(df)).select("pca"))),
                seconds(lambda: consume(cut.transform(scaler.transform(df)).select("pca"))),
            ]
            print(f"| {width} | {rows} | " + " | ".join(f"{t:.2f}" for t in took) + " |", flush=True)


def whole_way(spark) -> None:
    rows = 4000
    files = random_bitmaps(spark, rows).select(
        F.concat(F.lit("/pictures/c"), F.col("id") % 7, F.lit("/"), F.col("id")).alias("path"),
        "content",
    )
    stack = file_stack(decode_bitmap, (100, 100, 3))
    components = []

    def run():
        table, _, fitted = build_feature_table(files, not_pretrained_conv(512), stack, width=512)
        write_table(table, shared_dir(spark, "measure"))
        components.append(fitted.k)

    took = seconds(run)
    features = featurize(files, not_pretrained_conv(512), stack, "content", ["path"])
    model = seconds(lambda: consume(features))
    print("\n| 100x100 bitmaps to written table | features | components | seconds | of it the model |")
    print("|---|---|---|---|---|")
    print(f"| {rows} | 512 | {components[-1]} | {took:.2f} | {model:.2f} |", flush=True)


def main() -> None:
    spark = build_session(
        "fovea-measure", master=f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    featurizer(spark)
    fits(spark)
    whole_way(spark)


if __name__ == "__main__":
    main()
