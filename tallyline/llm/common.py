"""What the operators of this subpackage share: table access, written
intermediate tables and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.shared import dropped, new_folder, written

__all__ = ["bound_batches", "by_batch", "cached_by", "claim", "dropped", "hashed_sample", "new_folder", "table", "written"]

#: Rows and bytes of one Arrow batch that Python sees; a bound for a task's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLAIMED: list[str] = []
_CACHES: dict[str, Callable[[], None]] = {}


def cached_by(owner: str, clear: Callable[[], None]) -> None:
    """Says how a module frees what its tasks remember in a Python worker."""
    _CACHES[owner] = clear


def claim(owner: str) -> None:
    """A task of owner starts in this worker: workers outlive tasks, so what
    other modules remember is freed."""
    if _CLAIMED != [owner]:
        for name, clear in _CACHES.items():
            if name != owner:
                clear()
        _CLAIMED[:] = [owner]


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def hashed_sample(df: DataFrame, key: str, rows: int, total: int, spare: int = 20) -> DataFrame:
    """At most rows rows of df, in the order of the key's hash. Of total rows (the
    count of df itself, else the sample falls short of its bound),
    those whose hash is high cannot be among them and are left out before the
    sort: about spare * rows are left, which one task can order."""
    part = F.pmod(F.xxhash64(F.lit(99), key), F.lit(1 << 30))
    bound = min(1 << 30, -(-spare * rows * (1 << 30) // max(total, 1)))
    return df.where(part < bound).orderBy(F.xxhash64(key), key).limit(rows)


def by_batch(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict]],
    schema: str,
) -> DataFrame:
    """mapInArrow with state made once a task: make() gives a function from a
    batch to columns (name to list or array)."""
    bound_batches(df.sparkSession)
    fields = _arrow_schema(df.sparkSession, schema)

    owner = make.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        step = make()
        for batch in batches:
            if batch.num_rows:
                cols = step(batch)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := cols[f.name], pa.Array) else pa.array(x, f.type) for f in fields],
                    schema=fields,
                )

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
