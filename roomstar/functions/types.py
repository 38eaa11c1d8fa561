"""Type normalisation at the query edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def ntz_times(df: DataFrame) -> DataFrame:
    """Zone-aware timestamps as wall-clock UTC (TIMESTAMP_NTZ), the form SQL engines
    without zones return; other columns unchanged. Expects the session zone to be UTC."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])
