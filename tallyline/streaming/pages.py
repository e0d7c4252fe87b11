"""Pages that arrive as files. An extension: each micro-batch of whole pages goes
through the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.registry import TABLES, run

SCHEMA = "doc_id long, poly_no int, ocr_text string, confidence double, xmin double, ymin double, xmax double, ymax double"


def pages(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Word boxes of JSON files; a file holds whole pages."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_a_batch).json(folder)


def tables(stream: DataFrame, out: str, checkpoint: str, steps=TABLES) -> StreamingQuery:
    """Writes the cells of every page under out/batch=N; a batch that is run
    again replaces its own folder, so each page is there once."""

    def batch(df: DataFrame, number: int) -> None:
        run(steps, {"polygons": df})["cells"].write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
