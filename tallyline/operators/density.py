"""Density features of lines, their clusters, and the tabular interval."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import encode

FEATURES = ("n", "mean", "std_dev", "iqr", "p50", "skewness", "bbox_width", "align_prev", "ratio_area", "aspect_ratio")
EPS, MIN_SAMPLES = 2.0, 2


def statistics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sample moments and quartiles of the codes of text, for texts of two
    characters or more; all of a row's are computed from its own codes. Rows are told
    apart by keys."""
    codes = F.array_sort(F.transform(encode(F.col("text")), lambda c: c.cast("double")))
    each = rows.select(*keys, codes.alias("codes")).where("size(codes) > 1")
    n = F.size("codes")
    total = lambda of: F.aggregate("codes", F.lit(0.0), lambda a, c: a + of(c))
    each = each.select(*keys, n.cast("long").alias("n"), "codes", (total(lambda c: c) / n).alias("mean"))
    gap = lambda c: c - F.col("mean")
    each = each.select("*", F.sqrt(total(lambda c: gap(c) * gap(c)) / (F.col("n") - 1)).alias("std_dev"), (total(lambda c: gap(c) * gap(c) * gap(c)) / F.col("n")).alias("third"))

    def quartile(share: float) -> Column:
        at = (F.col("n") - 1) * share
        low = F.floor(at).cast("int")
        below, above = F.get("codes", low), F.get("codes", F.least(low + 1, n - 1))
        return below + (above - below) * (at - low)

    quartiles = {name: quartile(share) for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    # the third moment over the sample deviation: 0 where all codes are equal
    skew = F.when(F.col("std_dev") == 0, 0.0).otherwise(F.col("third") / F.pow("std_dev", F.lit(3.0)))
    return each.select(*keys, "n", "mean", "std_dev", *[c.alias(k) for k, c in quartiles.items()], (quartiles["p75"] - quartiles["p25"]).alias("iqr"), skew.alias("skewness"))


def geometry(lines: DataFrame, page_size: float) -> DataFrame:
    """Width, share of the page, aspect, and the cosine with the x-axis of the
    way to the line before. A line without height spoils its whole page."""
    page = W.partitionBy("doc_id")
    order = page.orderBy("cy", "line_no")
    dx, dy = F.lag("cx").over(order) - F.col("cx"), F.lag("cy").over(order) - F.col("cy")
    height = F.col("ymax") - F.col("ymin")
    moved = lines.select("*", dx.alias("dx"), dy.alias("dy"), F.max((height == 0).cast("int")).over(page).alias("flat")).where("flat = 0")
    way = F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2)
    return moved.select(
        "doc_id", "line_no", (F.col("xmax") - F.col("xmin")).alias("bbox_width"),
        F.when(F.col("dx").isNull(), 0.0).when(way == 0, 1.0).otherwise(F.try_divide(F.col("dx"), way)).alias("align_prev"),
        (100.0 / page_size * (F.col("xmax") - F.col("xmin")) * height).alias("ratio_area"), ((F.col("xmax") - F.col("xmin")) / height).alias("aspect_ratio"),
    )


def features(lines: DataFrame, page_size: float) -> DataFrame:
    return statistics(lines, ["doc_id", "line_no"]).join(geometry(lines, page_size), ["doc_id", "line_no"]).select("doc_id", "line_no", *FEATURES)


def scaled(rows: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """Features with mean 0 and deviation 1 inside their page; constant ones 0."""
    page = W.partitionBy("doc_id")
    put = lambda c: ((F.col(c) - F.avg(c).over(page)) / F.when(F.stddev_pop(c).over(page) < 1e-9, 1.0).otherwise(F.stddev_pop(c).over(page))).alias(c)
    return rows.select("doc_id", "line_no", *map(put, names))


def neighbours(rows: DataFrame, eps: float = EPS, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """doc_id, a, b: pairs a < b of lines of one page within eps. Lines meet those
    whose first feature is in the same strip of width eps, or in one beside it."""
    point = F.array(*[F.col(c).cast("double") for c in names])
    strip = F.floor(F.get("p", F.lit(0)) / eps)
    each = rows.select("doc_id", "line_no", point.alias("p")).withColumn("strip", strip)
    other = each.select("doc_id", F.col("line_no").alias("b"), F.col("p").alias("q"), F.explode(F.array(F.col("strip") - 1, F.col("strip"), F.col("strip") + 1)).alias("strip"))
    met = each.withColumnRenamed("line_no", "a").join(other, ["doc_id", "strip"]).where("a < b")
    square = F.aggregate(F.zip_with("p", "q", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return met.where(square <= eps * eps).select("doc_id", "a", "b")


def page_labels(points: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    """Density clusters of one page. A point with min_samples neighbours, itself
    included, is a core; cores within eps share a cluster, numbered in the order of
    their first cores; another point belongs to the first cluster with a core near
    it, or is noise (-1). Memory grows with the points, not with their pairs."""
    near = lambda i: np.flatnonzero(((points - points[i]) ** 2).sum(1) <= eps * eps)
    n = len(points)
    core = np.fromiter((len(near(i)) >= min_samples for i in range(n)), bool, n)
    labels, found = np.full(n, -1), 0
    for i in np.flatnonzero(core):
        if labels[i] < 0:
            todo = [i]
            labels[i] = found
            while todo:
                for j in near(todo.pop()):
                    if labels[j] < 0:
                        labels[j] = found
                        if core[j]:
                            todo.append(j)
            found += 1
    return labels


def clusters(rows: DataFrame, eps: float = EPS, names: tuple[str, ...] = FEATURES, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """doc_id, line_no, label: `page_labels` of every page. A task takes its pages
    one after the other, in the order of their lines."""
    point = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]
    dealt = rows.select("doc_id", "line_no", *point).repartition("doc_id").sortWithinPartitions("doc_id", "line_no")
    keys = dealt.select("doc_id", "line_no").schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys) + ", label int"

    def run(frames):
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = held["doc_id"].iloc[-1] if len(held) else None
            whole = len(held) - int((held["doc_id"] == last).to_numpy()[::-1].cumprod().sum()) if len(held) else 0
            if whole:  # the last page may go on in the next frame
                yield labelled(held.iloc[:whole])
                held = held.iloc[whole:].reset_index(drop=True)
        if held is not None and len(held):
            yield labelled(held)

    def labelled(frame):
        points = frame.iloc[:, 2:].to_numpy()
        doc = frame["doc_id"].to_numpy()
        cuts = [0, *(np.flatnonzero(doc[1:] != doc[:-1]) + 1), len(doc)]
        label = np.concatenate([page_labels(points[a:b], eps, min_samples) for a, b in zip(cuts, cuts[1:])])
        return frame[["doc_id", "line_no"]].assign(label=label.astype(np.int32))

    return dealt.where("doc_id IS NOT NULL").mapInPandas(run, schema)


def tabular_interval(labels: DataFrame) -> DataFrame:
    """doc_id, label, size, first_line, last_line of the largest cluster (of
    equals the one with the least label)."""
    sizes = labels.where("label >= 0").groupBy("doc_id", "label").agg(F.count("*").alias("size"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))
    best = F.max(F.struct("size", (-F.col("label")).alias("l"), "first_line", "last_line")).alias("m")
    return sizes.groupBy("doc_id").agg(best).select("doc_id", (-F.col("m.l")).alias("label"), "m.size", "m.first_line", "m.last_line")


def mark_tabular(lines: DataFrame, interval: DataFrame) -> DataFrame:
    """lines with tabular_line."""
    found = lines.join(interval.select("doc_id", "first_line", "last_line"), "doc_id", "left")
    return found.withColumn("tabular_line", F.coalesce(F.col("line_no").between(F.col("first_line"), F.col("last_line")), F.lit(False))).drop("first_line", "last_line")
