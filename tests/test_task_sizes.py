"""What one task holds follows from the rows of a table, not from the session's number of partitions."""

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from roomstar import queries, session
from roomstar.plans import serving, warehouse
from roomstar.sources.lake import fixture_events


def largest_task(spark, path):
    """(rows of the largest file, files) of a table that every task writes a file of."""
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    return files.agg(F.max("count"), F.count("*")).first()


@pytest.fixture()
def small_tasks(spark, monkeypatch):
    """Limits in proportion to the small table, in a session of few partitions."""
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 250, raising=False)
    monkeypatch.setattr(session, "TASK_CONF", {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024"}, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1")
    session.configure(spark)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    monkeypatch.undo()
    session.configure(spark)


def test_fact_tasks_do_not_grow_with_the_table(spark, scratch, small_tasks):
    wh = warehouse.build(spark, fixture_events(spark, SF01), scratch)
    rows, files = largest_task(spark, f"{wh.path}/fact_live_engagement")
    assert rows < 1000 and files > 20
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_tasks_of_many_loads_do_not_grow_with_the_table(spark, small_tasks, monkeypatch):
    places = []
    refresh = serving.refresh
    monkeypatch.setattr(serving, "refresh", lambda *a, **b: places.append(refresh(*a, **b)) or places[-1])
    monkeypatch.setattr(queries, "_BUILDS", {})
    monkeypatch.setattr(queries, "_SERVING", {})
    assert queries.multi_load_rollup(spark, SF01).count() == 1497
    for load in range(3):
        rows, files = largest_task(spark, f"{places[-1].path}/olap_detail/writer=load/load_id={load}")
        assert rows < 1000 and files > 20


def test_settings_of_the_submitter_are_kept(spark, monkeypatch):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64m")
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", f"--conf {key}=64m pyspark-shell")
    session.configure(spark)
    assert spark.conf.get(key) == "64m"
    monkeypatch.undo()
    session.configure(spark)
    assert spark.conf.get(key) == session.TASK_CONF[key]
