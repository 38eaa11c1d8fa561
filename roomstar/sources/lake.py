"""Batch sources: driver tables, the raw lake, the real-time sink, published tables.

Always read a *directory*: for a streaming file sink the ``_spark_metadata`` log decides
which files are committed, and a glob would also pick up files of failed batches.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from roomstar.schema import EVENT_SCHEMA
from roomstar.sources.adapter import live_events


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live events made from the driver's ``events`` table."""
    return live_events(driver_table(spark, sf_dir, "events"))


def _missing(err: AnalysisException) -> bool:
    cond = (err.getCondition() if hasattr(err, "getCondition") else None) or ""
    return "PATH_NOT_FOUND" in cond or "UNABLE_TO_INFER_SCHEMA" in cond or "Path does not exist" in str(err)


def read_parquet_dir(spark: SparkSession, path: str, schema: StructType | None = None,
                     required: bool = True) -> DataFrame:
    """Parquet directory; if absent, an error (required) or an empty frame of ``schema``."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
        if schema is not None:
            df.schema  # resolve now so an absent path surfaces here
        return df
    except AnalysisException as err:
        if required or schema is None or not _missing(err):
            raise
        return spark.createDataFrame([], schema)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Raw event lake written by the stream (its files carry EVENT_SCHEMA)."""
    return read_parquet_dir(spark, path, EVENT_SCHEMA, required=True)
