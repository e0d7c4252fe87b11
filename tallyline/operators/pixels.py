"""Statistics of pixels, decisions on them, and stencils.

Images are relations of pixels (img_id, y, x, v); neighbours meet by window, so
no image is held whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def statistics(pixels: DataFrame) -> DataFrame:
    """Population moments, range, entropy of the values, share of extremes, and
    1st and 99th percentiles of every image."""
    shares = pixels.groupBy("img_id", "v").agg(F.count("*").alias("k"))
    p = F.col("k") / F.sum("k").over(W.partitionBy("img_id"))
    entropy = shares.select("img_id", (-p * F.log2(p + 1e-8)).alias("e")).groupBy("img_id").agg(F.sum("e").alias("entropy"))
    moments = pixels.groupBy("img_id").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.var_pop("v").alias("var"), (F.max("v") - F.min("v")).alias("dyn_range"),
        F.avg(((F.col("v") <= 0) | (F.col("v") >= 255)).cast("double")).alias("extremes"), F.percentile("v", F.lit(0.01)).alias("p1"), F.percentile("v", F.lit(0.99)).alias("p99"),
    )
    return moments.join(entropy, "img_id")


def contrast(stats: DataFrame) -> DataFrame:
    """Whether an image needs equalising, and by how much: images of some range
    by their variance, flat ones under a fixed deviation."""
    limit = F.when(F.col("dyn_range") > 50, F.greatest(F.lit(30.0), 0.6 * F.col("var"))).otherwise(20.0)
    return stats.select("img_id", (F.col("std") < limit).alias("equalise"), F.least(F.lit(3.0), F.greatest(F.lit(1.0), 0.01 * F.col("dyn_range"))).alias("clip"))


def stencils(pixels: DataFrame) -> DataFrame:
    """img_id, y, x, laplacian, gx, gy (3 by 3 Sobel) of inner pixels."""
    row, col = W.partitionBy("img_id", "y").orderBy("x"), W.partitionBy("img_id", "x").orderBy("y")
    across = pixels.select("*", F.lag("v").over(row).alias("l"), F.lead("v").over(row).alias("r"))
    across = across.select("*", (F.col("l") + 2 * F.col("v") + F.col("r")).alias("smooth"), (F.col("r") - F.col("l")).alias("step"))
    up, down = (lambda c: F.lag(c).over(col)), (lambda c: F.lead(c).over(col))
    full = across.select(
        "img_id", "y", "x", (F.col("l") + F.col("r") + up("v") + down("v") - 4 * F.col("v")).alias("laplacian"),
        (up("step") + 2 * F.col("step") + down("step")).alias("gx"), (down("smooth") - up("smooth")).alias("gy"),
    )
    return full.where("laplacian IS NOT NULL")


def sharpness(pixels: DataFrame) -> DataFrame:
    """Variance of the Laplacian, mean gradient, and the decisions on them: smooth
    (blurred: variance under 80) and sharpen (weak gradients)."""
    edge = stencils(pixels).groupBy("img_id").agg(F.var_pop("laplacian").alias("focus"), F.avg(F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2)).alias("gradient"))
    var = pixels.groupBy("img_id").agg(F.var_pop("v").alias("var"))
    return edge.join(var, "img_id").select("img_id", "focus", "gradient", (F.col("focus") < 80).alias("smooth"), (F.col("gradient") < F.greatest(F.lit(30.0), 0.5 * F.col("var"))).alias("sharpen"))


def salt_pepper(pixels: DataFrame) -> DataFrame:
    """Pixels at or beyond the 1st and 99th percentiles: their share, how many
    have no other such pixel around them (those on the border have), and the
    median's size where they should go, by the image's area."""
    row, col = W.partitionBy("img_id", "y").orderBy("x"), W.partitionBy("img_id", "x").orderBy("y")
    ends = pixels.groupBy("img_id").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.99))).alias("p"))
    low, high = F.floor(F.greatest(F.lit(0.0), F.get("p", F.lit(0)))), F.floor(F.least(F.lit(255.0), F.get("p", F.lit(1))))
    marked = pixels.join(ends, "img_id").withColumn("e", ((F.col("v") <= low) | (F.col("v") >= high)).cast("int"))
    across = marked.withColumn("s", F.lag("e").over(row) + F.col("e") + F.lead("e").over(row))
    around = across.withColumn("k", F.lag("s").over(col) + F.col("s") + F.lead("s").over(col))
    each = around.groupBy("img_id").agg(
        F.count("*").alias("area"), F.avg("e").alias("share"), F.sum(((F.col("e") == 1) & (F.coalesce("k", F.lit(9)) <= 1)).cast("int")).alias("isolated"), (F.least(F.max("x") - F.min("x"), F.max("y") - F.min("y")) + 1).alias("side")
    )
    band = lambda a, b, c: F.when(F.col("area") < 2000, a).when(F.col("area") < 10_000, b).otherwise(c)
    size = F.greatest(band(3, 3, 5), F.when(F.col("side") >= 50, 5).otherwise(3))
    return each.select("img_id", "isolated", "share", F.when((F.col("share") > band(0.06, 0.03, 0.015)) & (F.col("isolated") >= band(10, 20, 30)), size).otherwise(0).alias("kernel"))


def otsu(pixels: DataFrame) -> DataFrame:
    """img_id, threshold: the value that parts dark from light with the greatest
    variance between them; of equals the least."""
    hist = pixels.groupBy("img_id", "v").agg(F.count("*").alias("k"))
    image, below = W.partitionBy("img_id"), W.partitionBy("img_id").orderBy("v")
    s = hist.select("img_id", "v", F.sum("k").over(below).alias("n0"), F.sum(F.col("k") * F.col("v")).over(below).alias("s0"), F.sum("k").over(image).alias("n"), F.sum(F.col("k") * F.col("v")).over(image).alias("s"))
    n1 = F.col("n") - F.col("n0")
    between = F.col("n0") * n1 * F.pow(F.col("s0") / F.col("n0") - F.try_divide(F.col("s") - F.col("s0"), n1), 2) / (F.col("n") * F.col("n"))
    best = F.row_number().over(image.orderBy(F.round(between, 6).desc_nulls_last(), "v"))
    return s.withColumn("r", best).where("r = 1").select("img_id", F.col("v").alias("threshold"))


def binarized(pixels: DataFrame, thresholds: DataFrame) -> DataFrame:
    return pixels.join(thresholds, "img_id").select("img_id", "y", "x", F.when(F.col("v") > F.col("threshold"), 255).otherwise(0).alias("v"))


def block_size(height: Column) -> Column:
    """An odd side for local thresholds, by the image's height."""
    side = F.when(height < 20, 11).when(height < 60, 25).otherwise(41)
    return side + (side % 2 == 0).cast("int")


def median_angle(lines: DataFrame, low: float = -20.0, high: float = 20.0, least: float = 0.15) -> DataFrame:
    """img_id, angle, rotate from segments(img_id, angle): the median of angles
    inside the open interval, 0 where there is none."""
    inside = F.when((F.col("angle") > low) & (F.col("angle") < high), F.col("angle"))
    angle = F.coalesce(F.percentile(inside, F.lit(0.5)), F.lit(0.0))
    return lines.groupBy("img_id").agg(angle.alias("angle")).withColumn("rotate", F.abs("angle") > least)
