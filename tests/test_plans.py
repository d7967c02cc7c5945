"""What reaches the scan, what shuffles, and what leaves the JVM."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fovea.functions import paths, tensors
from fovea.operators import inspect, reduce
from fovea.plans import catalogue
from fovea.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_inventory_reads_no_contents(spark, image_root):
    text = plan(files.dataset_inventory(files.read_class_tree(spark, image_root)))
    assert "ReadSchema: struct<path:string,length:bigint>" in text
    # partial sums before the only shuffle, so a hot class sends one row per task
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2


def test_size_filter_reaches_the_scan(spark, image_root):
    scan = files.read_class_tree(spark, image_root).where("length < 1000").select("path")
    assert "LessThan(length,1000)" in plan(scan)


@pytest.mark.parametrize(
    "name", ["project", "class_from_path", "path_split", "url_encode_rfc3986", "format_uri",
             "flatten_tensor", "preprocess_bgr_mean", "global_max_pool", "to_vector"],
)
def test_row_wise_queries_neither_shuffle_nor_leave_the_jvm(spark, sf_dir, name):
    text = plan(catalogue.QUERIES[name](spark, sf_dir))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize(
    "name, schema",
    [
        ("project", "doc_id:bigint,lang:string,source:string"),
        ("class_from_path", "page_id:bigint,url:string"),
        ("filter_eq", "c_custkey:bigint,c_name:string,c_mktsegment:string"),
        ("global_max_pool", "vec_id:bigint,embedding:array<float>"),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, schema):
    assert f"ReadSchema: struct<{schema}>" in plan(catalogue.QUERIES[name](spark, sf_dir))


def test_equality_reaches_the_scan(spark, sf_dir):
    assert "EqualTo(c_mktsegment,BUILDING)" in plan(catalogue.filter_eq(spark, sf_dir))


@pytest.mark.parametrize("name", ["featurize_linear", "featurize_max_pool"])
def test_featurizer_is_one_arrow_step_without_shuffle(spark, sf_dir, name):
    text = plan(catalogue.QUERIES[name](spark, sf_dir))
    assert text.count("ArrowEvalPython") == 1 and "Exchange" not in text


def test_pooling_report_is_one_pass(spark, sf_dir):
    text = plan(catalogue.pooling_comparison(spark, sf_dir))
    assert text.count("Scan parquet") == 1


def test_scree_comparison_joins_by_broadcast(spark):
    table = reduce._scree_table([0.7, 0.3], spark)
    assert "BroadcastHashJoin" in plan(reduce.compare_scree(table, table))


def test_projection_runs_in_the_jvm(spark, sf_dir):
    rows = catalogue.vectors(spark, sf_dir)
    fitted = reduce.fit_reduction(rows, output_col="r")
    text = plan(fitted.model.transform(rows).select("vec_id", "r"))
    assert "Exchange" not in text and "Python" not in text


def test_array_arguments_are_computed_once(spark):
    """A nested expression as the tensor must not be repeated per element."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def tensor(i):
        calls.add(1)
        return [float(i + j) for j in range(12)]

    df = spark.range(10).select(
        tensors.bgr_minus_mean(tensor("id")).alias("a"),
    )
    df.agg(F.sum(F.size("a"))).collect()
    assert calls.value == 10


def test_preview_and_profile_read_once(spark, sf_dir):
    documents = catalogue.table(spark, sf_dir, "documents")
    assert plan(inspect.schema_profile(documents)).count("Scan parquet") == 1
    encoded = documents.select(paths.percent_encode("lang"))
    assert "ReadSchema: struct<lang:string>" in plan(encoded)
