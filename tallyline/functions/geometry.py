"""Column functions on boxes and points."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PADDING = 5


def box(corners: Column) -> list[Column]:
    """xmin, ymin, xmax, ymax, cx, cy of an array of (x, y)."""
    x, y = F.transform(corners, lambda c: c.x), F.transform(corners, lambda c: c.y)
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda a, b: a + b) / F.size(v)
    return [F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"), F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax"), mean(x).alias("cx"), mean(y).alias("cy")]


def padded(low: Column, high: Column, size: Column, by: int = PADDING) -> tuple[Column, Column]:
    """A side cut to whole pixels, widened, and kept inside the image."""
    return F.greatest(F.lit(0), low.cast("int") - by), F.least(size.cast("int"), high.cast("int") + by)


def cosine(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Cosine of two vectors from the origin; 0 if one has no length."""
    lengths = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by)
    return F.when(lengths == 0, 0.0).otherwise((ax * bx + ay * by) / F.when(lengths == 0, 1.0).otherwise(lengths))


def close(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b))
