"""Data-quality checks over a built star schema: one report frame, one gate.

Checks that read the same table are evaluated in one aggregation pass. Every check
counts violations; 0 passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomstar.functions import any_null
from roomstar.operators.joins import maybe_broadcast

FACT_KEYS = ["date_key", "room_key", "user_key", "gift_key"]
_DIM_OF = {"date_key": "dim_date", "room_key": "dim_room", "user_key": "dim_user",
           "gift_key": "dim_gift"}

# Report order and meaning of every check.
CHECKS = [
    ("null_fact_keys", "no null keys in the fact"),
    ("duplicate_event_ids", "no duplicate event_id in staging"),
    ("orphan_room_keys", "every fact room_key exists in dim_room"),
    ("orphan_user_keys", "every fact user_key exists in dim_user"),
    ("negative_coins", "coins are never negative"),
    ("staging_reconciliation", "sum of fact event_count equals staging rows"),
    ("orphan_date_keys", "every fact date_key exists in dim_date"),
    ("orphan_gift_keys", "every fact gift_key exists in dim_gift"),
]


def digest(c: Column) -> Column:
    """64 bits of an id, for counting before the ids themselves are looked at."""
    return F.xxhash64(c)


def duplicate_ids(stg: DataFrame, id_col: str = "event_id") -> tuple[int, int]:
    """(COUNT(*) - COUNT(DISTINCT id), COUNT(*)). Null ids are violations (COUNT(DISTINCT) skips
    them).

    Digests of 8 bytes are counted first, in a hash aggregation that shuffles no id. Only ids whose
    digest occurs twice are fetched and counted themselves, so a collision of digests costs a
    lookup and never changes the result; without such digests staging is not read again."""
    ids = stg.select(F.col(id_col).alias("_id"), digest(F.col(id_col)).alias("_digest"), F.col(id_col).isNull().alias("_none"))
    per_digest = ids.groupBy("_digest", "_none").agg(F.count(F.lit(1)).alias("_n"))
    twice = ~F.col("_none") & (F.col("_n") > 1)
    seen = per_digest.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(twice).alias("suspects"),
                          F.coalesce(F.sum(F.when(F.col("_none"), F.col("_n"))), F.lit(0)).alias("nulls")).first()
    extra = 0
    if seen["suspects"]:
        suspects = maybe_broadcast(per_digest.where(twice).select("_digest"), seen["suspects"])
        per_id = ids.where(~F.col("_none")).join(suspects, "_digest", "left_semi").groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
        extra = per_id.agg(F.sum(F.col("_n") - 1).alias("extra")).first()["extra"]
    return seen["nulls"] + extra, seen["rows"]


def with_missing_keys(fact: DataFrame, dims: dict[str, DataFrame],
                      rows: dict[str, int] | None = None) -> DataFrame:
    """The fact with ``_missing``: the key columns that have no dimension row (a null key has
    none). One pass: the four dimensions are joined one after another, small ones broadcast."""
    out = fact
    for key, dim in _DIM_OF.items():
        known = dims[dim].select(F.col(key).alias(f"_d_{key}")).distinct()
        known = maybe_broadcast(known, (rows or {}).get(dim))
        out = out.join(known, out[key] == known[f"_d_{key}"], "left")
    missing = [F.when(F.col(f"_d_{key}").isNull(), F.lit(key)) for key in _DIM_OF]
    return out.select(*fact.columns, F.array_compact(F.array(*missing)).alias("_missing"))


def violations(stg: DataFrame, fact: DataFrame, dims: dict[str, DataFrame],
               rows: dict[str, int] | None = None) -> DataFrame:
    """(check_name, violations) for every check in CHECKS: staging and fact are read once.
    ``rows`` are known row counts of the dimensions."""
    def tally(condition):
        return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0)).cast("long")

    labelled = with_missing_keys(fact.select(*FACT_KEYS, "coins", "event_count"), dims, rows)
    fact_pass = labelled.agg(
        tally(any_null(*FACT_KEYS)).alias("null_fact_keys"),
        tally(F.col("coins") < 0).alias("negative_coins"),
        *[tally(F.array_contains("_missing", key)).alias(f"orphan_{key}s") for key in _DIM_OF],
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("_events"))
    dups, events = duplicate_ids(stg)
    both = fact_pass.select(
        *[c for c in fact_pass.columns if c != "_events"], F.lit(dups).cast("long").alias("duplicate_event_ids"),
        F.abs(F.col("_events") - F.lit(events)).cast("long").alias("staging_reconciliation"))
    return both.unpivot([], both.columns, "check_name", "violations")


def inject_faults(stg: DataFrame, fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A deliberately broken copy of staging and fact, for exercising the checks:
    staging gets one duplicated event; the fact gets four one-event rows cloned from its
    first row (by key), with a null user key, an unknown room key, negative coins and an
    unknown gift key. Expected violations: 1 null key, 1 duplicate, 1 orphan each of room,
    user (the null) and gift, 1 negative, reconciliation off by 4 - 1 = 3.

    The two rows are fetched here, once, and added as literal rows."""
    spark = stg.sparkSession

    def literal(frame: DataFrame, rows: list[dict]) -> DataFrame:
        return frame.unionByName(spark.createDataFrame(
            [tuple(r[c] for c in frame.columns) for r in rows], frame.schema))

    event = [r.asDict() for r in stg.orderBy("event_id").limit(1).collect()]
    faults = [{"user_key": None}, {"room_key": -1}, {"coins": -5}, {"gift_key": -1}]
    first = [r.asDict() for r in fact.orderBy(*FACT_KEYS).limit(1).collect()]
    broken = [{**r, "event_count": 1, **fault} for r in first for fault in faults]
    return literal(stg, event), literal(fact, broken)


def orphan_rows(fact: DataFrame, dims: dict[str, DataFrame],
                rows: dict[str, int] | None = None) -> DataFrame:
    """The fact rows whose key has no dimension row, once per missing key."""
    return (with_missing_keys(fact, dims, rows).where(F.size("_missing") > 0)
            .select(*fact.columns, F.explode("_missing").alias("missing_key")))


def quality_report(stg: DataFrame, fact: DataFrame, dims: dict[str, DataFrame],
                   rows: dict[str, int] | None = None) -> DataFrame:
    """G1: check_name, description, violations, status (PASS/FAIL), in CHECKS order."""
    spark = stg.sparkSession
    meta = spark.createDataFrame([(n, d, i) for i, (n, d) in enumerate(CHECKS)],
                                 "check_name string, description string, _order int")
    return (violations(stg, fact, dims, rows).join(F.broadcast(meta), "check_name")
            .orderBy("_order")
            .select("check_name", "description", "violations",
                    F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status")))


def passing(report: DataFrame) -> DataFrame:
    """One row: passing and total checks."""
    return report.agg(F.sum(F.when(F.col("status") == "PASS", 1).otherwise(0)).cast("long").alias("passing"),
                      F.count(F.lit(1)).alias("checks"))
