"""Lineage, impact analysis and catalog gaps against the golden answers."""

import pytest

from conftest import SF001
from roomstar.plans import governance as g
from roomstar.queries import warehouse_for
from roomstar.schema import MODELS


def _impact(df):
    return {r["model"]: r["columns"] for r in df.collect()}


@pytest.fixture(scope="module")
def edges(spark):
    return g.lineage_edges(spark)


def test_leaves(edges):
    got = {(r["model"], r["column"]): r["leaves"] for r in g.lineage_leaves(edges).collect()}
    assert got[("fact_live_engagement", "avg_ingest_lag_s")] == ["stg_events.event_ts", "stg_events.ingest_ts"]
    assert got[("fact_live_engagement", "event_count")] == ["stg_events.*"]


def test_one_hop_coins(edges):
    assert _impact(g.impact_one_hop(edges, "coins")) == {
        "dim_gift": ["coin_value", "gift_tier"], "fact_live_engagement": ["coins"]}


def test_one_hop_country(edges):
    assert _impact(g.impact_one_hop(edges, "stg_events.country")) == {"dim_user": ["country"]}


def test_one_hop_event_ts(edges):
    assert _impact(g.impact_one_hop(edges, "stg_events.event_ts")) == {
        "dim_date": sorted(["date_key", "full_date", "year", "month", "day", "day_of_week", "is_weekend"]),
        "dim_room": ["first_seen_ts", "last_seen_ts"],
        "dim_user": ["country", "first_seen_ts"],
        "fact_live_engagement": ["avg_ingest_lag_s"]}


def test_transitive_gift_name(edges):
    assert _impact(g.impact_transitive(edges, "stg_events.gift_name")) == {
        "dim_gift": ["gift_key", "gift_name"], "fact_live_engagement": ["gift_key"]}


def test_transitive_event_ts(edges):
    got = _impact(g.impact_transitive(edges, "stg_events.event_ts"))
    assert got["fact_live_engagement"] == ["avg_ingest_lag_s", "date_key"]


def test_transitive_terminates_on_cycle(spark):
    e = spark.createDataFrame([("a", "x", "b.y"), ("b", "y", "a.x"), ("a", "x", "s.z")],
                              "model string, column string, upstream string")
    assert _impact(g.impact_transitive(e, "s.z")) == {"a": ["x"], "b": ["y"]}


def test_catalog_gaps(spark):
    models = spark.createDataFrame([(m,) for m in MODELS + ["extra_model"]], "model string")
    got = {r["model"]: r["gaps"] for r in g.catalog_gaps(models, g.catalog_table(spark)).collect()}
    assert got["dim_user"] == ["classification"]
    assert got["extra_model"] == ["not in catalog"]
    assert all(got[m] == [] for m in MODELS if m != "dim_user")


def test_summary_and_drift_against_a_build(spark):
    wh = warehouse_for(spark, SF001)
    tables = {m: wh.table(m) for m in MODELS}
    cols = g.model_columns(spark, tables)
    assert g.lineage_drift(g.lineage_edges(spark), cols).count() == 0
    models = cols.select("model").distinct()
    gaps = g.catalog_gaps(models, g.catalog_table(spark))
    s = {r["model"]: (r["columns"], r["sources"], r["gap_count"])
         for r in g.model_summary(cols, g.model_sources(spark), gaps).collect()}
    assert s["stg_events"] == (10, "(lake)", 0)
    assert s["fact_live_engagement"] == (11, "dim_date, dim_gift, dim_room, dim_user, stg_events", 0)
    assert s["dim_user"][2] == 1


def test_drift_detects_unlisted_column(spark):
    cols = spark.createDataFrame([("dim_gift", "gift_key", 0), ("dim_gift", "new_col", 1),
                                  ("stg_events", "gift_name", 0)], "model string, column string, position int")
    edges = spark.createDataFrame([("dim_gift", "gift_key", "stg_events.gift_name")],
                                  "model string, column string, upstream string")
    problems = {(r["column"], r["problem"]) for r in g.lineage_drift(edges, cols).collect()}
    assert problems == {("new_col", "column has no lineage")}


def test_governance_json(spark, edges):
    import json
    models = spark.createDataFrame([(m,) for m in MODELS], "model string")
    doc = json.loads(g.governance_json(g.lineage_leaves(edges),
                                       g.catalog_gaps(models, g.catalog_table(spark))).first()["json"])
    assert doc["catalog_gaps"] == {"dim_user": ["classification"]}
    assert doc["lineage"]["dim_gift"]["coin_value"] == ["stg_events.coins"]


def test_cli_impact_json(spark, capsys):
    import json
    from roomstar.__main__ import main
    assert main(["lineage", "--column", "coins", "--json"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"column": "stg_events.coins", "impact": {"dim_gift": ["coin_value", "gift_tier"],
                                                 "fact_live_engagement": ["coins"]}}
