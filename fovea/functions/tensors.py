"""Column functions on tensors kept as flat arrays, pixel by pixel with the channels innermost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fovea.functions.paths import ColumnOrName, as_column

# fixed values: mean blue, green and red of the ImageNet training images
IMAGENET_MEANS_BGR = (103.939, 116.779, 123.68)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once a row.

    A lambda that mentions an outer expression computes it again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bgr_minus_mean(pixels: ColumnOrName) -> Column:
    """RGB values to BGR values less the channel mean; array<double>."""
    means = F.array(*[F.lit(mean) for mean in IMAGENET_MEANS_BGR])

    def prepare(source: Column) -> Column:
        def value(_: Column, position: Column) -> Column:
            channel = position % 3
            mirrored = position - channel + (2 - channel)
            return F.get(source, mirrored).cast("double") - F.get(means, channel)

        return F.transform(source, value)

    return _bind(as_column(pixels), prepare)


def global_pool(tensor: ColumnOrName, channels: int, how: str) -> Column:
    """Largest (`max`) or mean (`avg`) value per channel over all positions; array<double>.

    An array that is no whole number of positions is an error. Touches every element once. For wide maps, `pooling_model` in `featurize` is faster still.
    """
    if how not in ("max", "avg"):
        raise ValueError(f"pooling must be 'max' or 'avg', not {how!r}")

    def pool(values: Column) -> Column:
        ragged = F.raise_error(F.lit(f"the length is no multiple of {channels} channels"))
        whole = F.when(F.size(values) % channels == 0, F.size(values) / channels)
        positions = F.coalesce(whole, ragged.cast("double")).cast("int")

        def channel_values(steps: Column, channel: Column) -> Column:
            return F.transform(steps, lambda p: F.get(values, p * channels + channel))

        def reduced(steps: Column, channel: Column) -> Column:
            found = channel_values(steps, channel)
            if how == "max":
                return F.array_max(found)
            return F.aggregate(found, F.lit(0.0), lambda acc, v: acc + v) / positions

        return _bind(
            F.sequence(F.lit(0), positions - 1),
            lambda steps: F.transform(
                F.slice(values, 1, channels), lambda _, channel: reduced(steps, channel)
            ),
        )

    return _bind(as_column(tensor).cast("array<double>"), pool)


def flatten_tensor(nested: ColumnOrName, levels: int = 1) -> Column:
    """Nested arrays to one flat array, `levels` levels down."""
    flat = as_column(nested)
    for _ in range(levels):
        flat = F.flatten(flat)
    return flat


#: What `feature_reject_reason` may say.
FEATURE_REJECTS = ("missing", "wrong width", "not finite")


def feature_reject_reason(features: ColumnOrName, width: int) -> Column:
    """Why a feature array cannot enter a fit, or NULL if it can."""
    values = as_column(features)
    bad = F.exists(
        values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )
    return (
        F.when(values.isNull(), F.lit(FEATURE_REJECTS[0]))
        .when(F.size(values) != width, F.lit(FEATURE_REJECTS[1]))
        .when(bad, F.lit(FEATURE_REJECTS[2]))
    )


def image_reject_reason(image: ColumnOrName, shape: tuple[int, int, int]) -> Column:
    """Why a decoded image does not fit the model input (height, width, channels), or NULL."""
    image = as_column(image)
    height, width, channels = shape
    return (
        F.when(image.isNull() | (image["height"] < 0), F.lit("not an image"))
        .when(image["nChannels"] != channels, F.lit("wrong channels"))
        .when((image["height"] != height) | (image["width"] != width), F.lit("wrong size"))
    )
