"""Source tables read as DataFrames: Parquet folders or any JDBC database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.schemas import SOURCE_TABLES


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the four source tables from ``<path>/<name>``."""
    return spark.read.schema(SOURCE_TABLES[name]).parquet(f"{path}/{name}")


def read_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """One of the four source tables from a database.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read it in parallel.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, customSchema=SOURCE_TABLES[name], **options)
        .load()
    )


def sample(df: DataFrame, rows: int = 10) -> DataFrame:
    """A few rows for a look at a table or view."""
    return df.limit(rows)
