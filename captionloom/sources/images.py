"""Images: Spark's image source, and pixel work on its rows in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, width, height, channels, mode and data (rows of BGR or BGRA bytes) of images that can be decoded."""
    rows = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    return rows.select(F.col("image.origin").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"), F.col("image.mode").alias("mode"), F.col("image.data").alias("data"))


def with_load_errors(items: DataFrame, images: DataFrame, key: str = "path") -> DataFrame:
    """Every item, with its image or the error that it could not be read."""
    found = images.withColumn("__found", F.lit(True))
    out = items.join(found, key, "left")
    return out.withColumn("error", F.when(F.col("__found").isNull(), F.lit("cannot decode image"))).drop("__found")


def _rgb(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    """RGB pixels; transparency is laid over white, grey is repeated."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float32)
    if channels == 1:
        return np.repeat(a, 3, axis=2)
    color = a[:, :, 2::-1]
    if channels == 4:
        alpha = a[:, :, 3:4] / 255.0
        color = color * alpha + 255.0 * (1.0 - alpha)
    return color


@pandas_udf(T.BinaryType())
def flatten_rgb(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """(data, width, height, channels) to packed RGB bytes over white."""
    for data, width, height, channels in batches:
        yield pd.Series([None if d is None else np.rint(_rgb(d, w, h, c)).astype(np.uint8).tobytes() for d, w, h, c in zip(data, width, height, channels, strict=True)])


def _resized(a: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, by pixel centres."""
    h, w = a.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    top = a[y0][:, x0] * (1 - fx) + a[y0][:, x1] * fx
    low = a[y1][:, x0] * (1 - fx) + a[y1][:, x1] * fx
    return top * (1 - fy) + low * fy


def pixel_steps(a: np.ndarray, steps: list[dict]) -> np.ndarray:
    """Applies steps of a preprocessing configuration in order; kinds that are not known are left out.

    pad_to_size (width, height): scaled to fit and centred on white; resize (width, height); center_crop (width, height);
    to_tensor: to 0..1; normalize (mean, std).
    """
    for step in steps:
        kind = step["type"]
        if kind in ("pad_to_size", "resize", "center_crop"):
            w, h = step["width"], step["height"]
        if kind == "pad_to_size":
            scale = min(w / a.shape[1], h / a.shape[0])
            nw, nh = int(a.shape[1] * scale), int(a.shape[0] * scale)
            canvas = np.full((h, w, 3), 255.0, np.float32)
            top, left = (h - nh) // 2, (w - nw) // 2
            canvas[top : top + nh, left : left + nw] = _resized(a, nw, nh)
            a = canvas
        elif kind == "resize":
            a = _resized(a, w, h)
        elif kind == "center_crop":
            top, left = max(0, (a.shape[0] - h) // 2), max(0, (a.shape[1] - w) // 2)
            a = a[top : top + h, left : left + w]
        elif kind == "to_tensor":
            a = a / 255.0
        elif kind == "normalize":
            a = (a - np.asarray(step["mean"], np.float32)) / np.asarray(step["std"], np.float32)
    return a


def tensors(steps: list[dict]) -> Column:
    """A vectorised function (data, width, height, channels) to the flat float tensor that a tagger takes."""

    @pandas_udf("array<float>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for data, width, height, channels in batches:
            yield pd.Series([None if d is None else pixel_steps(_rgb(d, w, h, c), steps).astype(np.float32).ravel() for d, w, h, c in zip(data, width, height, channels, strict=True)])

    return run
