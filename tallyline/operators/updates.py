"""Relations brought up to date: recognised words, header flags and texts, metadata
of images; and plug-ins that recognise or detect."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def metadata(images: DataFrame) -> DataFrame:
    """doc_id, image_name, format, width, height, size, date_creation, color as the
    schema has them; images without both sides go."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    number = lambda c: F.col(c).try_cast("int")
    made = F.coalesce(F.col("date_creation").cast("string"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    sized = images.where(number("width").isNotNull() & number("height").isNotNull() & (number("width") > 0))
    return sized.select(
        F.col("doc_id").cast("string").alias("doc_id"), text("image_name").alias("image_name"), text("format").alias("format"), number("width").alias("width"), number("height").alias("height"),
        F.col("size").try_cast("bigint").alias("size"), made.alias("date_creation"), F.col("color").cast("string").alias("color"),
    )


def recognised(polygons: DataFrame, results: DataFrame, keys: list[str], key: str) -> DataFrame:
    """polygons with the words of results(keys, ids, results): the i-th of results,
    struct(text, confidence), is that of the polygon whose key is the i-th of ids.
    Polygons without a result, or with a null one, stay as they are; results beyond
    the ids go; a polygon named twice has its last one."""
    each = results.select(*keys, "ids", F.posexplode("results").alias("i", "r")).where("r IS NOT NULL AND i < size(ids)")
    named = each.select(*keys, F.get("ids", F.col("i")).alias(key), "i", F.col("r.text").alias("t"), F.col("r.confidence").alias("c"))
    last = named.groupBy(*keys, key).agg(F.max(F.struct("i", F.coalesce("t", F.lit("")).alias("t"), "c")).alias("new"))
    found = polygons.join(last, [*keys, key], "left")
    put = lambda old, new: F.when(F.col("new").isNotNull(), F.col(f"new.{new}")).otherwise(F.col(old)).alias(old)
    return found.select(*[put("ocr_text", "t") if c == "ocr_text" else put("confidence", "c") if c == "confidence" else F.col(c) for c in polygons.columns])


def staged(polygons: DataFrame, stage: str, done: Column | None = None) -> DataFrame:
    """polygons with the stage that they have passed, and whether it went well."""
    return polygons.withColumn("stage", F.lit(stage)).withColumn("status", F.lit(True) if done is None else done)


def mark_header(lines: DataFrame, header: DataFrame) -> DataFrame:
    """lines with header_line: whether header(doc_id, header_line) names it."""
    named = header.select("doc_id", F.col("header_line").alias("line_no"), F.lit(True).alias("header_line"))
    return lines.drop("header_line").join(named, ["doc_id", "line_no"], "left").withColumn("header_line", F.coalesce("header_line", F.lit(False)))


def header_texts(assigned: DataFrame, header: DataFrame) -> DataFrame:
    """doc_id, header: the words of the header line in their order, empty ones left out."""
    words = assigned.join(header, "doc_id").where("line_no = header_line AND ocr_text <> ''")
    return words.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "ocr_text"))), lambda x: x.ocr_text).alias("header"))


#: Models of this Python worker, made once each.
_MODELS: dict[str, object] = {}


def model(name: str, make: Callable[[], object]) -> object:
    if name not in _MODELS:
        _MODELS[name] = make()
    return _MODELS[name]


def recognise(crops: DataFrame, name: str, make: Callable[[], Callable], batch: int = 64) -> DataFrame:
    """doc_id, poly_no, ocr_text, confidence of crops(doc_id, poly_no, height, width,
    gray). make() gives, once a worker, a function from a list of (height, width,
    bytes) to a list of (text, share of certainty); texts are trimmed, shares become
    percents of two places. Where a batch comes back with another length, its words
    are unknown."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = model(name, make)
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                found = read([*zip(part["height"], part["width"], part["gray"], strict=True)])
                if len(found) != len(part):
                    found = [None] * len(part)
                words = [(None, None) if f is None else ((f[0] or "").strip(), round(100 * float(f[1]), 2)) for f in found]
                yield part[["doc_id", "poly_no"]].assign(ocr_text=[w for w, _ in words], confidence=[c for _, c in words])

    fields = crops.select("doc_id", "poly_no").schema
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return crops.select("doc_id", "poly_no", "height", "width", "gray").mapInPandas(run, f"{keys}, ocr_text string, confidence double")


def detect(images: DataFrame, name: str, make: Callable[[], Callable]) -> DataFrame:
    """doc_id, poly_no, coords of images(doc_id, height, width, gray): make() gives,
    once a worker, a function from (height, width, bytes) to a list of polygons, each
    a list of (x, y). Images without a polygon give no rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = model(name, make)
        for frame in frames:
            for doc, height, width, gray in frame.itertuples(index=False):
                found = find(height, width, gray)
                if not found:
                    continue
                yield pd.DataFrame({"doc_id": [doc] * len(found), "poly_no": range(len(found)), "coords": [[{"x": float(x), "y": float(y)} for x, y in p] for p in found]})

    doc = images.schema["doc_id"].dataType.simpleString()
    return images.select("doc_id", "height", "width", "gray").mapInPandas(run, f"doc_id {doc}, poly_no int, coords array<struct<x:double,y:double>>")
