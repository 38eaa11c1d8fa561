"""Serving layout, month pruning, rollup merge, formatting helpers."""

from pyspark.sql import functions as F

from conftest import SF001
from roomstar.functions import readable_size, rank_label, thousands
from roomstar.plans import serving
from roomstar.queries import ORDERS_WINDOW, orders_layout, serving_for


def test_month_pruning_reaches_the_scan(spark):
    path = orders_layout(spark, SF001)
    df = serving.read_date_range(spark, path, "o_orderdate", *ORDERS_WINDOW)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "ym#" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    months = {r["ym"] for r in df.select("ym").distinct().collect()}
    assert months == {199603, 199604, 199605, 199606, 199607, 199608, 199609}


def test_detail_files_are_sorted_ranges(spark):
    s = serving_for(spark, SF001)
    d = s.detail().select("ym", "event_date", "room_id", "user_id", F.input_file_name().alias("f"))
    # every file covers a contiguous key range: consecutive files do not overlap
    ranges = (d.groupBy("f").agg(F.min(F.struct("event_date", "room_id", "user_id")).alias("lo"),
                                 F.max(F.struct("event_date", "room_id", "user_id")).alias("hi"))
               .orderBy("lo").collect())
    for a, b in zip(ranges, ranges[1:]):
        assert tuple(a["hi"]) <= tuple(b["lo"])


def test_the_fact_is_dealt_out_before_the_joins(spark, scratch):
    from roomstar.queries import warehouse_for
    wh = warehouse_for(spark, SF001)
    rows, in_ranges = serving.detail_rows(wh, 4)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert in_ranges and plan.count("rangepartitioning(date_key") == 1
    assert plan.index("BroadcastHashJoin") < plan.index("rangepartitioning")  # joins stand above the exchange
    assert "hashpartitioning" not in plan
    small = dict(wh.rows, dim_user=10**9)  # too large to broadcast: ranges are made after the joins
    rows, in_ranges = serving.detail_rows(type(wh)(spark, wh.path, small), 4)
    assert not in_ranges and "rangepartitioning" not in rows._jdf.queryExecution().executedPlan().toString()


def test_files_of_a_skewed_month_have_like_sizes(spark, scratch):
    from roomstar.sinks.files import write_partitioned_sorted
    days = F.when(F.col("id") % 10 < 8, F.lit("2024-02-01")).otherwise(F.concat(F.lit("2024-0"), (F.col("id") % 3 + 3).cast("string"), F.lit("-07")))
    df = spark.range(80_000).select(days.cast("date").alias("d"), F.sha1(F.col("id").cast("string")).alias("u")) \
        .withColumn("ym", F.year("d") * 100 + F.month("d"))
    write_partitioned_sorted(df, f"{scratch}/t", "ym", ["d", "u"], num_files=16)
    rows = [r["count"] for r in spark.read.parquet(f"{scratch}/t").where("ym = 202402")
            .groupBy(F.input_file_name()).count().collect()]
    inner = sorted(rows)[1:-1]  # the first and the last file of a month share a range with its neighbours
    assert len(rows) >= 12 and max(rows) < 2 * 5_000 and min(inner) > 5_000 / 2


def test_rollup_matches_detail(spark):
    row = serving.rollup_reconcile(serving_for(spark, SF001)).first()
    assert (row["rollup_only"], row["detail_only"], row["sum_mismatches"],
            row["user_mismatches"]) == (0, 0, 0, 0)


def test_append_load_and_replay(spark, scratch):
    s0 = serving_for(spark, SF001)
    detail = s0.detail()
    s = serving.Serving(spark, scratch)
    a, b = detail.where(F.col("coins") >= 100), detail.where(F.col("coins") < 100)
    serving.append(s, a, 1)
    serving.append(s, b, 2)
    serving.append(s, b.limit(0), 3)
    serving.append(s, b, 2)  # a re-run load replaces itself
    assert s.detail().count() == detail.count()
    got = serving.daily_rollup(s, None).collect()
    want = serving.daily_rollup(s0, None).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_running_total(spark):
    rows = serving.running_total(serving_for(spark, SF001), 10).collect()
    assert [r["room_id"] for r in rows] == sorted(r["room_id"] for r in rows)
    run = 0
    for r in rows:
        if r["room_id"] != rows[0]["room_id"]:
            break
        run += r["coins"]
        assert r["running"] == run


def test_partition_report(spark):
    rows = serving.partition_bytes(serving_for(spark, SF001)).collect()
    assert [r["ym"] for r in rows] == [202401]
    assert rows[0]["rows"] == 981 and rows[0]["bytes"] > 0 and rows[0]["size"].endswith("KiB")


def test_formatting(spark):
    df = spark.createDataFrame([(57139, 3, "room_0007")], "b long, r int, n string")
    r = df.select(readable_size("b").alias("s"), rank_label("r", "n").alias("l"),
                  thousands("b").alias("t")).first()
    assert (r["s"], r["l"], r["t"]) == ("55.80 KiB", "03 room_0007", "57,139")


def test_exact_users_come_from_the_states_alone(spark):
    s = serving_for(spark, SF001)
    for keys in (["event_date", "room_id"], ["room_id"], ["event_date"]):
        found = serving.exact_users(s, *keys)
        assert all("/agg_room_users/" in f for f in found.inputFiles())
        want = s.detail().groupBy(*keys).agg(F.countDistinct("user_id").alias("users"))
        assert found.exceptAll(want).count() == 0 and found.count() == want.count()
    assert all("/agg_country_users/" in f for f in serving.country_exact(s).inputFiles())


def test_partition_report_reads_no_detail_column(spark):
    plan = serving.partition_bytes(serving_for(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(scans) == 2 and any("ReadSchema: struct<>" in x for x in scans) and any("length" in x and "content" not in x for x in scans)


def test_bloom_filter_written_for_high_cardinality_users(spark, scratch):
    """parquet-mr skips the filter when a chunk is fully dictionary-encoded (few users);
    with many distinct users the dictionary gives up and the bloom filter is written."""
    import glob
    from roomstar.sinks.files import write_partitioned_sorted
    df = spark.range(300_000).select(F.lit(202401).alias("ym"),
                                     F.format_string("user_%09d", F.col("id")).alias("user_id"),
                                     F.col("id").alias("coins"))
    write_partitioned_sorted(df, f"{scratch}/t", "ym", ["user_id"], bloom_cols=["user_id"])
    f = glob.glob(f"{scratch}/t/ym=*/*.parquet")[0]
    jvm = spark.sparkContext._jvm  # footer read through parquet-mr, test only
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(
        spark.sparkContext._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path(f))
    cols = {c.getPath().toDotString(): c.getBloomFilterOffset()
            for c in footer.getBlocks().get(0).getColumns()}
    assert cols["user_id"] >= 0 and cols["coins"] < 0
    got = spark.read.parquet(f"{scratch}/t").where(F.col("user_id") == "user_000000042").count()
    assert got == 1
