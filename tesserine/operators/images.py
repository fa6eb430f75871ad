"""Neighbourhood metrics of images (M05, M06). An image is rows (id, y, values), y from 0
without gaps and values an array from left to right.

Images are cut into bands of rows. A band gets the rows of its halo too, so that a window of a
few rows around each of its own is whole, and no image, however high, meets one task. Inside a
row arrays are worked on in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BAND = 256
#: The level from which an edge counts, and the weights of the score.
EDGE_LEVEL, ENTROPY_WEIGHT, EDGE_WEIGHT = 32, 0.7, 30.0


def in_bands(rows: DataFrame, halo: int, band: int = BAND) -> DataFrame:
    """rows, each once for every band whose rows it is within halo of, with _band."""
    first, last = (F.expr(f"cast(floor((y {sign} {halo}) / {band}) as int)") for sign in "-+")
    return rows.withColumn("_band", F.explode(F.sequence(first, last)))


def own_rows(rows: DataFrame, band: int = BAND) -> DataFrame:
    return rows.filter(F.col("_band") == F.expr(f"y div {band}")).drop("_band")


def _around(keys: Sequence[str], reach: int) -> Window:
    return Window.partitionBy(*keys, "_band").orderBy("y").rowsBetween(-reach, reach)


def _along(values: Column, reach: int, pick: Callable[[Column], Column]) -> Column:
    """pick of the values within reach of each place of a row."""
    return F.transform(values, lambda _, i: pick(F.slice(values, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1)))


def _across(values: Column, window: Window, pick: Callable[[Column, Column], Column]) -> Column:
    """pick of the values of each column within a window of rows."""
    held = F.collect_list(values).over(window)
    return F.aggregate(F.slice(held, 2, 1 << 20), held[0], lambda a, b: F.zip_with(a, b, lambda x, y: pick(x, y)))


def changed(a: Column, b: Column, threshold: float) -> Column:
    """1 for each pixel (an array of channels) whose largest difference is above the
    threshold, else 0."""
    gap = lambda x, y: F.array_max(F.zip_with(x, y, lambda p, q: F.abs(p.cast("int") - q.cast("int"))))
    return F.zip_with(a, b, lambda x, y: (gap(x, y) > threshold).cast("int"))


def opened(rows: DataFrame, mask: str, size: int, keys: Sequence[str] = ("id",), band: int = BAND) -> DataFrame:
    """rows with their mask opened by a square of odd size: the least of each square, then the
    greatest of those. Squares end at the image's edges. Size 1 or less leaves it."""
    if size <= 1:
        return rows
    if size % 2 == 0:
        raise ValueError("the square's size must be odd")
    reach = size // 2
    out, window = in_bands(rows, 2 * reach, band), _around(keys, reach)
    out = out.withColumn(mask, _along(F.col(mask), reach, F.array_min)).withColumn(mask, _across(F.col(mask), window, F.least))
    out = out.withColumn(mask, _along(F.col(mask), reach, F.array_max)).withColumn(mask, _across(F.col(mask), window, F.greatest))
    return own_rows(out, band)


def change_masks(rows: DataFrame, threshold: float, size: int, keys: Sequence[str] = ("id",), band: int = BAND) -> DataFrame:
    """Rows (keys, y, before, after) with mask. Sizes must agree: an image whose rows
    differ in length is an error, as there is no resampling here."""
    same = F.when(F.size("before") == F.size("after"), F.col("before")).otherwise(F.raise_error(F.lit("images differ in size")).cast(rows.schema["before"].dataType))
    return opened(rows.withColumn("mask", changed(same, F.col("after"), threshold)).drop("before", "after"), "mask", size, keys, band)


def change_stats(rows: DataFrame, threshold: float, size: int, keys: Sequence[str] = ("id",), band: int = BAND) -> DataFrame:
    """Keys, changed_pixels, total_pixels, changed_ratio."""
    on = F.aggregate("mask", F.lit(0), lambda a, x: a + x)
    out = change_masks(rows, threshold, size, keys, band).groupBy(*keys).agg(F.sum(on).alias("changed_pixels"), F.sum(F.size("mask")).alias("total_pixels"))
    return out.withColumn("changed_ratio", F.when(F.col("total_pixels") > 0, F.col("changed_pixels") / F.col("total_pixels")).otherwise(F.lit(0.0)))


def gray(pixels: Column) -> Column:
    """Brightness 0 to 255 of an array of (red, green, blue)."""
    # The usual weights, in 65536ths, rounded.
    return F.transform(pixels, lambda p: F.shiftright(p[0] * 19595 + p[1] * 38470 + p[2] * 7471 + 32768, 16))


def edges(rows: DataFrame, keys: Sequence[str] = ("id",), band: int = BAND) -> DataFrame:
    """rows (keys, y, values, height) with edge: 8 times each value less its eight neighbours,
    held within 0 to 255. Values on the image's border, and of images less than 3 wide or high,
    stay."""
    window = Window.partitionBy(*keys, "_band").orderBy("y")
    out = in_bands(rows, 1, band).withColumns({"_up": F.lag("values").over(window), "_down": F.lead("values").over(window)})
    three = F.zip_with(F.zip_with("_up", "values", lambda a, b: a + b), F.col("_down"), lambda a, b: a + b)
    out = own_rows(out.withColumn("_three", three), band)
    width = F.size("values")
    inside = lambda i: (F.col("y") > 0) & (F.col("y") < F.col("height") - 1) & (i > 0) & (i < width - 1) & (width >= 3) & (F.col("height") >= 3)
    turn = lambda v, i: 9 * v - F.get("_three", i - 1) - F.get("_three", i) - F.get("_three", i + 1)
    kept = F.transform("values", lambda v, i: F.when(inside(i), F.greatest(F.lit(0), F.least(F.lit(255), turn(v, i)))).otherwise(v))
    return out.withColumn("edge", kept).drop("_up", "_down", "_three")


def entropy_edge_scores(rows: DataFrame, keys: Sequence[str] = ("id",), band: int = BAND) -> DataFrame:
    """Rows (keys, y, values of 0 to 255) -> keys, entropy (bits), edge_density, score. An
    image without pixels scores 0. Counts of values are combined before their shuffle, and no
    image is brought together."""
    sizes = rows.groupBy(*keys).agg((F.max("y") + 1).alias("height"), F.sum(F.size("values")).alias("pixels"))
    counts = rows.select(*keys, F.explode("values").alias("value")).groupBy(*keys, "value").agg(F.count("*").alias("n"))
    bits = counts.join(sizes.select(*keys, "pixels"), list(keys)).withColumn("p", F.col("n") / F.col("pixels"))
    bits = bits.groupBy(*keys).agg(F.sum(-F.col("p") * F.log2("p")).alias("entropy"))
    drawn = edges(rows.join(sizes.select(*keys, "height"), list(keys)), keys, band)
    strong = drawn.groupBy(*keys).agg(F.sum(F.size(F.filter("edge", lambda v: v >= EDGE_LEVEL))).alias("strong"))
    out = sizes.join(bits, list(keys), "left").join(strong, list(keys), "left")
    full = lambda c: F.when(F.col("pixels") > 0, c).otherwise(F.lit(0.0))
    out = out.select(*keys, full(F.col("entropy")).alias("entropy"), full(F.col("strong") / F.col("pixels")).alias("edge_density"))
    return out.withColumn("score", F.col("entropy") * ENTROPY_WEIGHT + F.col("edge_density") * EDGE_WEIGHT)
