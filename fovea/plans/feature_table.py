"""The whole way: files to features to reduced, labelled feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fovea.functions.paths import class_from_path
from fovea.functions.tensors import FEATURE_REJECTS, feature_reject_reason
from fovea.operators.featurize import Model, featurize, split_rejects
from fovea.operators.images import Stacker
from fovea.operators.moments import feature_moments
from fovea.operators.reduce import Reduction, feature_width, fit_reduction, with_vectors
from fovea.session import finished_stage, input_fingerprint, stage


def reduce_features(
    features: DataFrame,
    keep: list[str],
    features_col: str = "features",
    output_col: str = "features_std_pca",
    width: int | None = None,
    **options,
) -> tuple[DataFrame, DataFrame, Reduction]:
    """(keep..., reduced vector) from a staged table of feature arrays, the rows that cannot enter
    the fit as (keep..., reject_reason), and the fitted model.

    The features are read twice: once for their moments, where the rejects are counted as well
    (`Reduction.rejected`), and once when the result is computed. Without `width` the most frequent one is
    looked up before, in a scan of its own.
    """
    rows = features.select(*dict.fromkeys([*keep, features_col]))
    if width is None:
        width = feature_width(rows, features_col)
    reason = feature_reject_reason(features_col, width)
    counted = Observation()
    seen = rows.withColumn("_reason", reason).observe(
        counted, *[F.count_if(F.col("_reason") == why).alias(why) for why in FEATURE_REJECTS]
    )
    moments = feature_moments(seen.where(F.col("_reason").isNull()), features_col)
    vectors = with_vectors(rows.where(reason.isNull()), features_col)
    reduction = fit_reduction(
        vectors, output_col=output_col, features_col=features_col, moments=moments, **options
    )
    reduction.rejected = {why: n for why, n in counted.get.items() if n}
    table = reduction.model.transform(vectors).select(*keep, output_col)
    rejects = rows.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
    return table, rejects.select(*keep, "reject_reason"), reduction


def build_feature_table(
    files: DataFrame,
    model_factory: Callable[[], Model],
    stack: Stacker,
    width: int,
    input_col: str = "content",
    path_col: str = "path",
    keep: list[str] = (),
    output_col: str = "features_std_pca",
    reduction: dict | None = None,
    identity: dict | None = None,
    **featurize_options,
) -> tuple[DataFrame, DataFrame, Reduction]:
    """(path, kept columns, reduced vector, class), the rejected rows with reasons, and the model.

    Features are staged once: the model sees every file one time, while the scaler, the PCA and
    the final projection read the staged table.

    With `identity`, which names the model and the stacker and their parameters, a later run, also of another
    driver, takes up features that an earlier one has finished. They count as the same only for the same
    identity, width, other options, and files: those are told apart by whichever of path, length and
    modificationTime `files` has.
    """
    columns = [path_col, *keep]
    features = featurize(files, model_factory, stack, input_col, columns, **featurize_options)
    checked = features.withColumn(
        "reject_reason",
        F.coalesce("reject_reason", feature_reject_reason("features", width)),
    )
    if identity is None:
        staged = stage(checked, "features")
    else:
        known = [c for c in dict.fromkeys((path_col, "path", "length", "modificationTime")) if c in files.columns]
        staged, _ = finished_stage(checked, "features", {
            "identity": identity, "width": width, "columns": [input_col, *columns],
            "options": {k: repr(v) for k, v in featurize_options.items()},
            "files": input_fingerprint(files, known),
        })
    usable, rejects = split_rejects(staged)
    reduced, _, fitted = reduce_features(
        usable, columns, output_col=output_col, width=width, **(reduction or {})
    )
    table = reduced.withColumn("class", class_from_path(path_col))
    return table, rejects.select(*columns, "reject_reason"), fitted
