"""Tables, shared folders and Arrow batches for the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The six ASCII white-space characters.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, which all executors share.

    A session without that setting gets one of its own only if it is local,
    where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"/tmp/tidelog-llm-{os.getuid()}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts the lineage
    and survives the loss of any executor."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver does,
    if it is not installed for them anyway."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", root)
    return df.mapInArrow(function, schema)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have at most ``limit`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)
