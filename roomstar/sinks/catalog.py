"""K9: idempotent catalog DDL over the published Parquet folders.

Tables are external (``USING parquet LOCATION``): dropping one removes the catalog entry,
never the data, and re-running the registration is a no-op or a clean replace.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_q(database)}.{_q(table)}")


def drop_view(spark: SparkSession, database: str, view: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {_q(database)}.{_q(view)}")


def register_table(spark: SparkSession, database: str, table: str, path: str,
                   replace: bool = True) -> None:
    """Point ``database.table`` at a Parquet folder (partition columns are discovered)."""
    ensure_database(spark, database)
    if replace:
        drop_table(spark, database, table)
    loc = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(database)}.{_q(table)} USING parquet LOCATION '{loc}'")
    cols = [r["col_name"] for r in spark.sql(f"DESCRIBE TABLE {_q(database)}.{_q(table)}").collect()]
    if "# Partition Information" in cols:
        spark.sql(f"MSCK REPAIR TABLE {_q(database)}.{_q(table)}")


def register_tables(spark: SparkSession, database: str, paths: dict[str, str]) -> None:
    for table, path in paths.items():
        register_table(spark, database, table, path)
