"""Literal fixtures: the locked pair, unsorted gaps, the hub, and edges apart in time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pairtrace.config import GraphConfig, PairConfig, RuleConfig, ShortlistConfig
from pairtrace.functions.membership import maybe_among
from pairtrace.operators import clean, graph, pairs
from pairtrace.operators.components import connected_components
from pairtrace.plans.detection import Detection
from pairtrace.sources.orders import ORDER_TYPES, conform, derive_order_date


def order(i, driver, customer, at, status="COMPLETED", kmh=0.0, **more):
    base = {"order_id": i, "driver_id": driver, "customer_id": customer, "order_status": status, "order_time_local_tz": at, "avg_kmh": kmh, "gmv": 12000.0,
            "discount": 5000.0, "service_name": "bike", "pickup_province_name": "HCM", "pickup_address": "A", "last_dropoff_province_name": "HCM",
            "last_dropoff_address": "B", "payment_method": "wallet", "promotion_code": "P1"}
    return base | more


def table(spark, rows):
    columns = sorted({c for r in rows for c in r})
    kinds = ", ".join(f"{c} {'double' if ORDER_TYPES[c] == 'double' else 'string'}" for c in columns)
    raw = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], kinds)
    return derive_order_date(conform(raw, ORDER_TYPES)).withColumn("window_id", F.lit("all"))


def test_locked_pair_end_to_end(spark):
    rows = [
        order("o1", "d1", "c1", "2026-07-14T10:00:00"), order("o2", "d1", "c1", "2026-07-14T10:00:54"), order("o3", "d1", "c1", "2026-07-14T10:30:00", kmh=20.0),
        order("o4", "d2", "c2", "2026-07-14T11:00:00", kmh=30.0), order("o5", "d1", "c1", "2026-07-14T12:00:00", status="CANCELLED"),
    ]
    found = Detection(
        table(spark, rows), PairConfig(extreme_trip_quantile=0.5), ShortlistConfig(3, 0.5, 35, 0.3, 0.3, 0.3),
        RuleConfig(high_ghost_rate=0.3, superfast_gap_min=5, min_pair_trips_for_share_rule=3, dominant_route_share=0.5, min_high_confidence_trips=3, min_superfast_trips=3),
    )
    (pair,) = found.pair_summary.collect()
    assert (pair.n_trips, pair.n_ghost, round(pair.ghost_rate, 4), pair.min_gap_min) == (3, 2, 0.6667, 0.9)
    assert pair.high_confidence and pair.pair_core_score > 40
    assert pair.business_rule == "GHOST_TRIP_EXECUTION_PATTERN"
    flags = found.flags.collect()
    assert len({f.reason_code for f in flags}) == 5 and len({f.order_id for f in flags}) == 3


def test_gap_ignores_input_order(spark):
    rows = [order("a", "d", "c", f"2026-07-14T{t}") for t in ("10:00:54", "10:00:00", "10:02:00")]
    active = clean.prepare_active_orders(table(spark, rows))
    assert pairs.pair_gaps(active).first().min_gap_min == 0.9


def test_gaps_of_a_pair_across_ranges(spark):
    """One pair's orders fill several ranges; its least gap may lie inside one or between two."""
    rnd = random.Random(6)
    ids = "window_id string, driver_id string, customer_id string, s long"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be one
    try:
        for orders in (3, 60, 3_000):
            times = {("d", "c"): sorted(rnd.sample(range(10**9, 2 * 10**9), orders)), ("d", "e"): [5], ("f", "c"): [7, 7], ("g", "c"): sorted(rnd.sample(range(10**6), 40))}
            df = spark.createDataFrame([("w", d, c, t) for (d, c), ts in times.items() for t in ts], ids).repartition(7)
            if orders == 3_000:
                part = df.repartitionByRange("window_id", "driver_id", "customer_id", "s").filter("driver_id = 'd' AND customer_id = 'c'")
                assert part.select(F.spark_partition_id()).distinct().count() > 1
            rows = pairs.pair_gaps(df.withColumn("order_time_local_tz", F.timestamp_seconds("s").cast("timestamp_ntz"))).collect()
            got = {(r.driver_id, r.customer_id): None if r.min_gap_min is None else round(r.min_gap_min * 60) for r in rows}
            assert got == {k: min((b - a for a, b in zip(ts, ts[1:], strict=False)), default=None) for k, ts in times.items()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_candidate_orders_beyond_a_broadcast(spark, monkeypatch):
    """Same rows either way; the filter drops most others before the shuffle and none that match."""
    active = spark.range(20_000).select(F.lit("w").alias("window_id"), (F.col("id") % 1_000).cast("string").alias("driver_id"), F.when(F.col("id") % 9 > 0, (F.col("id") % 37).cast("string")).alias("customer_id"), F.col("id").alias("order_id"))
    keys = active.filter("order_id % 101 = 0").select("window_id", "driver_id", "customer_id").distinct()
    want = {r.order_id for r in pairs.candidate_orders(active, keys).collect()}
    monkeypatch.setattr(pairs, "BROADCAST_PAIRS", -1)
    assert {r.order_id for r in pairs.candidate_orders(active, keys).collect()} == want and len(want) > 150
    some = maybe_among(active, keys, ["window_id", "driver_id", "customer_id"])
    assert some.columns == active.columns and len(want) <= some.count() < 1.2 * len(want) + 1_000
    assert maybe_among(active, keys, ["driver_id"], words=1).count() <= 20_000
    nulls = active.filter("customer_id IS NULL")
    assert maybe_among(nulls, nulls, ["driver_id", "customer_id"]).count() == nulls.count()


@pytest.mark.parametrize("days", [None, 5])
def test_hub_and_distant_use_give_no_edges(spark, days):
    rows = [order(f"o{i}", f"d{i}", f"c{i}", "2026-07-14T10:00:00", payment_method="Cash", promotion_code="HUB", pickup_address="X" if i < 2 else "Y", last_dropoff_address=f"z{i}") for i in range(3)]
    if days:
        rows = [order(f"o{i}", f"d{i}", f"c{i}", f"2026-07-{14 + i * days}T10:00:00") for i in range(2)]
    active = clean.prepare_active_orders(table(spark, rows))
    entities = graph.pair_entities(active)
    edges = graph.pair_edges(graph.signal_edges(entities, graph.entity_degree(entities)))
    assert edges.count() == 0
    short = pairs.score_pairs(pairs.pair_stats(active))
    assert graph.components(short, edges).select("label").distinct().count() == len(rows)


def test_degree_cap_and_single_signal(spark):
    day = dt.date(2026, 7, 14)
    rows = [("all", "payment", "hub", f"p{i:02d}", day, day) for i in range(51)]
    rows += [("all", "payment", e, p, day, day) for e in ("k1", "k2") for p in ("x", "y")]
    entities = spark.createDataFrame(rows, "window_id string, signal string, entity string, pair_key string, first_day date, last_day date")
    degrees = graph.entity_degree(entities, GraphConfig())
    (edge,) = graph.pair_edges(graph.signal_edges(entities, degrees)).collect()
    assert (edge.left, edge.right, edge.weight, edge.shared_entity_count) == ("x", "y", 1.8205, 2)


def test_components_of_chain_star_and_cliques(spark):
    chain = [(i, i + 1) for i in range(1000, 1400)]
    star = [(5000, i) for i in range(5001, 5100)]
    cliques = [(a, b) for lo in (1, 10) for a in range(lo, lo + 5) for b in range(a + 1, lo + 5)] + [(3, 12)]
    got = connected_components(spark.createDataFrame(chain + star + cliques + [(7777, 7777)], "a long, b long"), "a", "b")
    label = {r.id: r.component for r in got.collect()}
    assert {label[i] for i in range(1000, 1401)} == {1000} and {label[i] for i in range(5000, 5100)} == {5000}
    assert {v for k, v in label.items() if k < 20} == {1} and 7777 not in label


def test_config_ranges():
    with pytest.raises(ValueError):
        PairConfig(extreme_trip_quantile=1.5)
