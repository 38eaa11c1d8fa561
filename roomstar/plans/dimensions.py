"""The four dimensions from one read of staging.

Staging is grouped once by four grouping sets (date; room; user and country; gift name) with
aggregates of fixed width, so both sides of the one shuffle are hash aggregations and a hot room
or user is one row for each map task. What is left (a row for each natural key, a few for a
user with several countries) is folded to one row a key and numbered for all dimensions in one
sort (``dense_keys`` with ``within``); the table it writes is what every dimension is selected from.

A user's country is that of the first event with a country. Two countries can tie at one event
time; then the smaller event id decides, and only then are the tied users' events looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomstar.functions import date_key, day_of_week, is_weekend, tier
from roomstar.operators.joins import maybe_broadcast
from roomstar.operators.keys import dense_keys
from roomstar.schema import DIMENSIONS

# Columns of the grouping sets, and the dimension that each set makes.
_COLUMNS = ["full_date", "room_id", "user_id", "country", "gift_name"]
_SETS = {"dim_date": ["full_date"], "dim_room": ["room_id"], "dim_user": ["user_id", "country"],
         "dim_gift": ["gift_name"]}


def _set_number(columns: list[str]) -> int:
    """Value of grouping_id() for a set: a bit for each column that is not in it, first column highest."""
    return sum((c not in columns) << (len(_COLUMNS) - 1 - i) for i, c in enumerate(_COLUMNS))


def _model() -> Column:
    out = F.lit(None).cast("string")
    for name, columns in _SETS.items():
        out = F.when(F.col("_set") == _set_number(columns), F.lit(name)).otherwise(out)
    return out


def natural_keys(stg: DataFrame) -> DataFrame:
    """One row per (model, natural key) with what any dimension needs of it: ``first_seen_ts``,
    ``last_seen_ts``, ``coin_value``, and ``_first``/``_other``: the time of the first event with a country, and
    the least and greatest of its countries (equal unless two tie)."""
    events = stg.select(F.to_date("event_ts").alias("full_date"), *_COLUMNS[1:], "event_ts", "coins")
    sets = [[F.col(c) for c in columns] for columns in _SETS.values()]
    seen = events.groupingSets(sets, *[F.col(c) for c in _COLUMNS]).agg(
        F.grouping_id().alias("_set"), F.min("event_ts").alias("first_seen_ts"), F.max("event_ts").alias("last_seen_ts"),
        F.max("coins").alias("coin_value"))
    natural = F.coalesce(F.col("full_date").cast("string"), "room_id", "user_id", "gift_name")  # one is grouped
    at = F.unix_micros(F.col("first_seen_ts").cast("timestamp"))
    known = F.col("country").isNotNull()
    return (seen.select(_model().alias("model"), natural.alias("natural"), "first_seen_ts", "last_seen_ts", "coin_value",
                        F.when(known, F.struct(at.alias("at"), "country")).alias("_lo"),
                        F.when(known, F.struct((-at).alias("before"), "country")).alias("_hi"))
            .groupBy("model", "natural")
            .agg(F.min("first_seen_ts").alias("first_seen_ts"), F.max("last_seen_ts").alias("last_seen_ts"),
                 F.max("coin_value").alias("coin_value"), F.min("_lo").alias("_first"), F.max("_hi").alias("_other")))


def _settle_ties(stg: DataFrame, users: DataFrame, n_tied: int) -> DataFrame:
    """``users`` with the country of tied ones taken from their smallest event id at that time."""
    tied = users.where(F.col("_tied")).select("natural", F.col("_first.at").alias("_at"))
    here = F.unix_micros(F.col("event_ts").cast("timestamp"))
    events = stg.where(F.col("country").isNotNull()).select("event_id", "user_id", "country", here.alias("_here"))
    same = F.col("user_id").eqNullSafe(F.col("natural")) & (F.col("_here") == F.col("_at"))
    settled = (events.join(maybe_broadcast(tied, n_tied), same).groupBy("natural")
                     .agg(F.min_by("country", "event_id").alias("_settled")).withColumnRenamed("natural", "_tied_user"))
    settled = maybe_broadcast(settled, n_tied)
    return (users.join(settled, F.col("natural").eqNullSafe(F.col("_tied_user")), "left")
                 .withColumn("country", F.coalesce("_settled", "country")))


def dimensions(stg: DataFrame, path: str | None = None) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """(dimension frames by name, their row counts). All frames read one table of numbered natural
    keys, kept at ``path`` (in the work folder if not given)."""
    keyed = dense_keys(natural_keys(stg), "natural", "key", within="model", path=path)
    keyed = keyed.withColumns({"country": F.col("_first.country"),
                               "_tied": F.coalesce(F.col("_first.country") != F.col("_other.country"), F.lit(False))})
    counted = {r["model"]: r for r in keyed.groupBy("model").agg(
        F.count("*").alias("rows"), F.count_if("_tied").alias("tied")).collect()}
    rows = {name: counted[name]["rows"] if name in counted else 0 for name in DIMENSIONS}
    n_tied = sum(r["tied"] for r in counted.values())

    def of(name: str) -> DataFrame:
        return keyed.where(F.col("model") == name)

    users = of("dim_user")
    if n_tied:
        users = _settle_ties(stg, users, n_tied)
    day = F.col("natural").cast("date")
    return {
        "dim_date": of("dim_date").select(
            date_key(day).alias("date_key"), day.alias("full_date"), F.year(day).cast("long").alias("year"),
            F.month(day).cast("long").alias("month"), F.dayofmonth(day).cast("long").alias("day"),
            day_of_week(day).alias("day_of_week"), is_weekend(day).alias("is_weekend")),
        "dim_room": of("dim_room").select(F.col("key").alias("room_key"), F.col("natural").alias("room_id"),
                                          "first_seen_ts", "last_seen_ts"),
        "dim_user": users.select(F.col("key").alias("user_key"), F.col("natural").alias("user_id"), "country", "first_seen_ts"),
        "dim_gift": of("dim_gift").select(F.col("key").alias("gift_key"), F.col("natural").alias("gift_name"),
                                          "coin_value", tier("coin_value").alias("gift_tier")),
    }, rows
