"""File sinks: month-partitioned sorted layout, commit markers, folder removal."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows per output file for the serving layout; keeps files large enough to read fast and
# small enough that one month is spread over many files (and many writer tasks).
ROWS_PER_FILE = 5_000_000
# Target rows per file when the row count is known in advance.
TARGET_ROWS_PER_FILE = 2_000_000


def files_for(spark, rows: int | None) -> int | None:
    """Output files for a layout of ``rows`` rows: about TARGET_ROWS_PER_FILE each, and at
    least one per core so later scans run in parallel; None when the size is unknown."""
    if rows is None:
        return None
    return max(spark.sparkContext.defaultParallelism, -(-rows // TARGET_ROWS_PER_FILE))


def write_partitioned_sorted(df: DataFrame, path: str, partition_cols: str | list[str],
                             sort_cols: list[str], mode: str = "overwrite",
                             dynamic: bool = False, rows_per_file: int = ROWS_PER_FILE,
                             bloom_cols: list[str] | None = None,
                             num_files: int | None = None, in_ranges: bool = False) -> None:
    """K4: Hive-style partitions, rows sorted by the sort key inside them.

    Range partitioning on (partitions, sort key) instead of hash on the partition value:
    a month holding a third of all rows is split over many writer tasks, and every file
    covers one contiguous key range, so Parquet min/max statistics skip row groups for
    predicates on a prefix of the sort key. AQE may merge small ranges; it never breaks
    their order. ``dynamic`` replaces only the partitions present in ``df``. ``bloom_cols``
    get Parquet bloom filters, for equality lookups that min/max statistics cannot prune
    (a column that is not a prefix of the sort key). ``num_files`` fixes the number of
    ranges (e.g. from ``files_for``); otherwise AQE sizes them from the shuffle. ``in_ranges``: the
    rows are dealt into ranges of these keys already (e.g. before joins that keep them there).
    """
    parts = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    keys = [*parts, *sort_cols]
    if in_ranges:
        ranged = df
    else:
        ranged = df.repartitionByRange(num_files, *keys) if num_files else df.repartitionByRange(*keys)
    w = (ranged.sortWithinPartitions(*keys)
           .write.mode(mode)
           .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
           .option("maxRecordsPerFile", rows_per_file))
    for c in bloom_cols or []:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.partitionBy(*parts).parquet(path)


def _on_file_system(spark, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete(spark, path: str) -> None:
    """Remove a folder on whatever file system holds it."""
    files, target = _on_file_system(spark, path)
    files.delete(target, True)


def committed(spark, path: str) -> bool:
    """Whether a write to a folder has committed (Spark's marker file is there)."""
    files, target = _on_file_system(spark, f"{path}/_SUCCESS")
    return files.exists(target)
