"""Readers: image manifests, pages of polygons, lexicons, word lists, databases."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

# File extensions of images.
EXTENSIONS = ("png", "jpg", "jpeg", "bmp", "tif", "tiff", "webp", "gif", "pbm", "pgm", "ppm", "jp2", "ico")
#: More images than this are a batch.
INTERACTIVE = 5

POLYGONS = (
    "doc_id string, poly_id string, poly_no int, coords array<struct<x:double,y:double>>, xmin double, ymin double, xmax double, ymax double,"
    " cx double, cy double, ocr_text string, ocr_confidence double, perimeter double, line_id string, was_fragmented boolean, status boolean, stage string"
)


@dataclass(frozen=True)
class Config:
    """Parameters in force. Unknown names are ignored, as a typed document model
    would ignore them."""

    padding: int = 5
    min_confidence: float = 70.0
    overlap: float = 0.3
    eps: float = 2.0
    min_samples: int = 2
    numeric_ratio: float = 0.6
    tolerance: float = 0.05
    axioms: str = "coded"
    keep_fills: bool = False
    extensions: tuple[str, ...] = field(default=EXTENSIONS)

    @classmethod
    def of(cls, values: dict) -> Config:
        return cls(**{k: v for k, v in values.items() if k in {f.name for f in fields(cls)}})

    @classmethod
    def load(cls, path: str) -> Config:
        """From a JSON file, or a YAML file where a YAML parser is installed."""
        text = Path(path).read_text()
        if path.endswith((".yml", ".yaml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("YAML files need the package yaml; JSON files don't") from e
            return cls.of(yaml.safe_load(text) or {})
        return cls.of(json.loads(text))


def image_manifest(spark: SparkSession, *roots: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """path, name, extension, folder, bytes of every image under the roots;
    contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(roots)).select("path", F.col("length").alias("bytes"))
    found = files.withColumn("extension", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))).where(F.col("extension").isin(*extensions))
    return found.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("name"), "extension", F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"), "bytes")


def plan(manifest: DataFrame) -> DataFrame:
    """status, total_images, mode of a manifest, in one row."""
    n = F.count("*")
    return manifest.agg(
        F.when(n > 0, "success").otherwise("no_images").alias("status"), n.alias("total_images"), F.when(n > INTERACTIVE, "batch").otherwise("interactive").alias("mode")
    )


def images(spark: SparkSession, *roots: str) -> DataFrame:
    """Decoded images as gray bytes: path, height, width, gray; broken ones have
    null sides."""
    raw = spark.read.format("image").option("recursiveFileLookup", "true").load(list(roots)).select("image.*")
    known = F.col("width") > 0
    return raw.select(F.col("origin").alias("path"), F.when(known, F.col("height")).alias("height"), F.when(known, F.col("width")).alias("width"), F.col("nChannels").alias("channels"), "data")


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """Word boxes from JSON lines, in the schema POLYGONS."""
    return spark.read.schema(POLYGONS).json(path)


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """word: the distinct lower-case lines of a text file."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where("word <> ''").distinct()


def density_map(spark: SparkSession, path: str) -> DataFrame:
    """char, code from a JSON object."""
    text = spark.read.option("wholetext", "true").text(path)
    return text.select(F.explode(F.from_json("value", "map<string,int>")).alias("char", "code"))


def database(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query over JDBC."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()
