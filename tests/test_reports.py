"""Report fixtures, fixed tables spelled out, ranks over ranges, and the shared folder."""

import pytest
from pyspark.sql import functions as F

from pairtrace.functions import expr, shared
from pairtrace.operators import property_graph as pg
from pairtrace.operators import reports, rules
from pairtrace.sources import orders

CLUSTER = (
    "order_id string, customer_id string, driver_id string, reason_code string, pair_core_score double, network_support_score double, priority_score double, n_trips long, n_ghost long, "
    "min_gap_min double, ghost_rate double, high_confidence boolean, avg_gmv double, supporting_signal_count long, linked_pair_count long, component_size long, component_density double, risk_tier string"
)


def test_rule_cluster_takes_the_strongest_figures_of_a_pair(spark):
    rows = [
        ("o1", "c1", "d1", "KB-C", 66.65, 82.78, 72.3, 64, 20, 0.9, 20 / 64, True, 12390.0, 4, 6, 7, 0.57, "HIGH"),
        ("o2", "c1", "d1", "KB-C", 66.65, 80.0, 71.0, 64, 20, 1.2, 20 / 64, True, 12390.0, 4, 6, 7, 0.57, "HIGH"),
        ("o3", "c2", "d2", "KB-C", 43.0, 50.0, 45.0, 13, 1, 8.0, 1 / 13, False, 45000.0, 1, 1, 2, 1.0, "WATCHLIST"),
    ]
    first = reports.rule_cluster_summary(spark.createDataFrame(rows, CLUSTER), ("customer_id", "driver_id")).first().asDict()
    assert first == {
        "customer_id": "c1", "driver_id": "d1", "flagged_orders": 2, "max_n_trips": 64, "max_n_ghost": 20, "max_ghost_rate": 20 / 64, "max_priority_score": 72.3,
        "max_supporting_signal_count": 4, "max_linked_pair_count": 6, "max_component_size": 7, "min_gap_min": 0.9, "high_confidence": True, "avg_gmv": 12390.0,
        "avg_pair_core_score": 66.65, "avg_network_support_score": 81.39, "top_risk_tier": "HIGH",
    }


def test_windows_end_on_the_latest_day(spark):
    rows = [("o1", "2026-07-14", "HIGH"), ("o2", "2026-07-17", "WATCHLIST")]
    flags = spark.createDataFrame(rows, "order_id string, order_date string, risk_tier string").withColumn("order_date", F.col("order_date").cast("date"))
    got = {r.label: r for r in reports.window_metrics(flags).collect()}
    assert (got["1D"].flagged_orders, got["1D"].watchlist_orders, got["1D"].high_risk_orders) == (1, 1, 0)
    assert (got["7D"].flagged_orders, got["7D"].high_risk_orders) == (2, 1)
    assert str(got["1D"].start_date) == str(got["1D"].end_date) == "2026-07-17"
    assert {r.high_risk_orders for r in reports.window_metrics(flags, ("WATCHLIST",)).collect()} == {1}


def test_fixed_tables():
    """Spelled out again, as the SQL of the checks is built from the same tables."""
    locked, ghost, route, network = "REPEATED_LOCKED_PAIR", "GHOST_TRIP_EXECUTION_PATTERN", "ROUTE_FARMING_PATTERN", "COORDINATED_NETWORK_PATTERN"
    assert [r[:2] for r in rules.REASONS] == [
        ("KB-C_EXTREME_VOLUME", locked), ("KB-C_TIGHT_PAIR_SHARE", locked), ("KB-C_SUSPICIOUS_COMPONENT", network),
        ("KB-C_HIGH_GHOST_RATE", ghost), ("KB-C_SUPERFAST_GAP", ghost), ("KB-C_ROUTE_LOOP", route),
    ]
    assert [r[2] for r in rules.REASONS] == ["weighted_edge_outlier", "bipartite_pair_concentration", "wcc_component_support", "ghost_trip_density", "temporal_turnaround", "route_loop_reuse"]
    assert set(rules.LABELS) == set(rules.STORIES) == {locked, ghost, route, network} and set(rules.REASON_TEXTS) == {r[0] for r in rules.REASONS}
    assert rules.LABELS[locked].startswith("Cặp lặp lại") and rules.LABELS[ghost].startswith("Dấu hiệu đơn ảo") and rules.LABELS[route].startswith("Mẫu farming") and rules.LABELS[network].startswith("Cụm liên kết")
    ends = {t: (a, b) for t, a, b in pg.EDGES}
    assert ends == {
        "PLACED": ("customer_id", "order_id"), "SERVED": ("driver_id", "order_id"), "PICKUP_AT": ("order_id", "pickup_key"), "DROPOFF_AT": ("order_id", "dropoff_key"),
        "PAID_BY": ("order_id", "payment_method"), "USED_PROMO": ("order_id", "promotion_code"), "IN_CAMPAIGN": ("promotion_code", "promotion_campaign_code"),
        "CANCELLED_BY": ("order_id", "cancel_by"), "HAS_CANCEL_REASON": ("order_id", "cancel_description"), "USES_SERVICE": ("order_id", "service_name"),
        "USES_SERVICE_TYPE": ("order_id", "service_type"), "USES_SUB_VERTICAL": ("order_id", "sub_vertical_name"), "USES_TRAVEL_MODE": ("order_id", "travel_mode"),
        "USES_CHANNEL_TYPE": ("order_id", "channel_type"),
    }
    assert len(pg.NODES) == 14 and pg.NODES["Address"] == ("pickup_key", "dropoff_key") and pg.NODES["CancelActor"] == ("cancel_by",) and pg.NODES["RideService"] == ("service_name",)


def test_running_total_and_share_over_ranges(spark):
    rows = [("a", i % 37, i) for i in range(500)] + [("b", None, 1), ("b", 5, 2), ("b", 5, 3)]
    df = spark.createDataFrame(rows, "k string, v int, n int").repartition(5)
    got = {(r.k, r.n): r.total for r in expr.running_total(df, ["k"], [F.desc("n")], F.lit(1), "total").collect()}
    assert all(got["a", i] == 500 - i for i in range(500)) and got["b", 1] == 3
    share = {(r.k, r.n): r.share for r in expr.cumulative_share(df, ["k"], "v", "share").collect()}
    assert share["b", 1] == 0 and share["b", 2] == share["b", 3] == 1 and share["a", 0] == 14 / 500


def test_numbers_that_are_absent_or_bad_take_the_default(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,), ("NaN",)], "v string")
    got = [r[0] for r in df.select(expr.numeric_or_default(df, "v", -1.0)).collect()]
    assert got == [7.0, -1.0, -1.0, -1.0] and df.select(expr.numeric_or_default(df, "gone", 2.0)).first()[0] == 2.0


def test_reports_of_an_empty_folder_are_empty(spark, tmp_path):
    read = orders.read_reports(spark, str(tmp_path))
    assert reports.rule_overview(read["flagged_orders"]).count() == 0 and reports.reason_overview(read["pair_reasons"]).count() == 0
    assert reports.filter_pairs(read["pair_summary"], "2020-01-01", "2020-12-31", "s", "r").count() == 0
    assert reports.rule_cluster_summary(read["flagged_orders"]).count() == 0 and reports.period_summary(read["flagged_orders"], "week").count() == 0


def test_intermediates_are_dropped_and_need_a_shared_folder(spark):
    path = shared.fresh_path(spark, "kept")
    spark.range(3).write.parquet(path)
    before = shared.generation()
    assert shared.changed_at(spark, path) > 0
    shared.drop_intermediates(spark)
    assert shared.changed_at(spark, path) == 0 and shared.generation() == before + 1
    far = type("Far", (), {"conf": type("Conf", (), {"get": lambda *_: None})(), "sparkContext": type("Context", (), {"master": "yarn", "getCheckpointDir": lambda _: None})()})()
    with pytest.raises(ValueError):
        shared.shared_dir(far)


def test_graph_rows_of_a_small_ring(spark):
    rows = [("o1", "d1", "c1"), ("o2", "d1", "c1"), ("o3", "d2", "c1"), ("o4", "d1", "c2"), ("o5", "d2", "c2"), ("o6", "d3", "c3")]
    table = spark.createDataFrame(rows, "order_id string, driver_id string, customer_id string")
    pay = {"o1": "k", "o2": "own", "o3": "k", "o6": "k"}
    edges = [("PLACED", c, o) for o, _, c in rows] + [("SERVED", d, o) for o, d, _ in rows] + [("PAID_BY", o, p) for o, p in pay.items()]
    edges = spark.createDataFrame(edges, "type string, src string, dst string")
    seeds = spark.createDataFrame([("d1", "c1")], "driver_id string, customer_id string")
    rows_of = lambda df: sorted(map(tuple, df.collect()))
    assert rows_of(pg.pair_infrastructure(table, edges, seeds)) == [("d1", "c1", "PAID_BY", "k", 1, 2)]
    assert rows_of(pg.infrastructure_orders(table, edges, seeds)) == [("PAID_BY", "k", o) for o in ("o1", "o3", "o6")]
    assert rows_of(pg.shared_customer_counts(table, seeds)) == [("d1", "c1", "d2", 1)]
    assert len(rows_of(pg.pair_history(table, edges, seeds))) == 6
    assert ("d1", "PLACED", "c1", 2) in rows_of(pg.driver_neighbors(table, edges, seeds))
    named = spark.createDataFrame([("d1", "d2"), ("d1", "d3")], "first string, second string")
    sides = {(r.second, r.side, r.customer_id, r.order_id) for r in pg.compared_orders(table, named).collect()}
    assert ("d2", "shared", "c1", "o3") in sides and ("d3", "only_second", "c3", "o6") in sides and ("d3", "only_first", "c2", "o4") in sides and len(sides) == 5 + 4


@pytest.mark.parametrize("bad", [{"extreme_trip_quantile": 0}, {"extreme_trip_quantile": 1}, {"min_extreme_trip_threshold": 0}])
def test_pair_bounds(bad):
    from pairtrace.config import PairConfig

    with pytest.raises(ValueError):
        PairConfig(**bad)


@pytest.mark.parametrize("bad", [{"payment_max_degree": 1}, {"min_shared_signals": 0}, {"max_entity_gap_days": -1}])
def test_graph_bounds(bad):
    from pairtrace.config import GraphConfig

    with pytest.raises(ValueError):
        GraphConfig(**bad)
