from pyspark.sql import functions as F

import __spark_entry__
from pairtrace import graph_catalog
from pairtrace.functions import membership
from pairtrace.operators import pairs, reports
from pairtrace.operators import property_graph as pg
from pairtrace.operators.adjacency import AdjacencyIndex
from pairtrace.plans.detection import Detection

PLACES = [f"{p}_{c}" for p in ("pickup", "last_dropoff") for c in pg.PLACE]
COLUMNS = ["order_id", "driver_id", "customer_id", *PLACES, "payment_method", "promotion_code", "promotion_campaign_code", "cancel_by", "cancel_description", "service_name", "service_type", "sub_vertical_name", "travel_mode", "channel_type"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def orders(spark):
    made = spark.range(400).select(
        (F.col("id") % 390).cast("string").alias("order_id"), F.concat(F.lit("d"), F.col("id") % 7).alias("driver_id"), F.concat(F.lit("c"), F.col("id") % 31).alias("customer_id"),
        *[F.when(F.col("id") % 11 > 0, F.concat(F.lit("Phố  Số " if i % 2 else "a "), F.col("id") % (5 + i))).alias(c) for i, c in enumerate(PLACES)],
        *[F.when(F.col("id") % (3 + i) > 0, F.concat(F.lit("v"), F.col("id") % 4)).alias(c) for i, c in enumerate(COLUMNS[9:])],
    )
    return made


def every_edge(keyed):
    """One row an edge, told apart over all edges at once."""
    found = F.array(*[F.struct(F.lit(t).alias("type"), F.col(a).alias("src"), F.col(b).alias("dst")) for t, a, b in pg.EDGES])
    return keyed.select(F.explode(found).alias("e")).select("e.*").filter("src IS NOT NULL AND dst IS NOT NULL").distinct()


def test_edges_of_repeated_orders_are_distinct(spark):
    keyed = pg.with_address_keys(orders(spark))
    assert rows(pg.graph_edges(keyed)) == rows(every_edge(keyed))


def test_edges_are_shuffled_once_an_order(spark):
    plan = pg.graph_edges(pg.with_address_keys(orders(spark)), ("PLACED", "SERVED", "PAID_BY"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == 1 and plan.count("Exchange") == 1


def test_edges_at_seeds_match_those_of_all_orders(spark, monkeypatch):
    table, seeds = orders(spark), spark.createDataFrame([("3",), ("5",), ("nobody",)], "order_id string")
    edges = every_edge(pg.with_address_keys(table))
    at = F.when(F.col("type").isin("PLACED", "SERVED"), F.col("dst")).otherwise(F.col("src"))
    expected = rows(edges.filter("type <> 'IN_CAMPAIGN'").filter(at.isin("3", "5")))
    assert rows(pg.order_edges(table, seeds)) == expected
    monkeypatch.setattr(membership.among, "__defaults__", (-1,))
    assert rows(pg.order_edges(table, seeds)) == expected


def test_ends_and_their_orders_match_the_plain_form(spark):
    table = orders(spark)
    edges = every_edge(pg.with_address_keys(table))
    seeds = spark.createDataFrame([("d1", "c1"), ("d3", "c10")], "driver_id string, customer_id string")
    mine = pg.pair_orders(table, seeds)
    used = edges.filter(F.col("type").isin(*pg.INFRASTRUCTURE)).select(F.col("src").alias("order_id"), "type", "dst")
    own = mine.join(used, "order_id").groupBy("driver_id", "customer_id", "type", "dst").agg(F.count("*").alias("own_orders"))
    shared, at = pg.infrastructure_at(table, own, "own_orders")
    assert rows(shared.select("driver_id", "customer_id", "type", "dst", "own_orders", "other_orders")) == rows(pg.pair_infrastructure(table, edges, seeds))
    found = at.join(shared.select("type", "dst").distinct(), ["type", "dst"], "left_semi").select("type", "dst", "order_id")
    assert rows(found) == rows(pg.infrastructure_orders(table, edges, seeds))


def test_graph_queries_write_no_index(spark, monkeypatch):
    monkeypatch.setattr(AdjacencyIndex, "write", classmethod(lambda *_: 1 / 0))
    assert __spark_entry__.queries()["component_paths"](spark, __spark_entry__.SMOKE_DIR).columns
    assert not hasattr(graph_catalog, "_graph")


def test_shortlist_needs_no_scores_of_small_pairs(spark):
    active = spark.range(3_000).select(
        F.lit("w").alias("window_id"), F.concat(F.lit("d"), F.when(F.col("id") < 60, F.lit(0)).otherwise(F.col("id") % 50)).alias("driver_id"),
        F.concat(F.lit("c"), F.when(F.col("id") < 60, F.lit(0)).otherwise(F.col("id") % 700)).alias("customer_id"), (F.col("id") % 5 == 0).alias("is_ghost"),
        F.lit("s").alias("service_name"), F.lit("p").alias("pickup_province_name"), F.col("id").cast("string").alias("order_id"),
    )
    base = pairs.written_base(active)
    whole = pairs.score_pairs(pairs.pair_stats(None, base=base))
    assert rows(pairs.score_pairs(pairs.pair_stats(None, base=base, least_trips=4))) == rows(whole.filter("n_trips >= 4"))
    detection = Detection(active)
    detection.__dict__["active"] = active
    assert rows(detection.shortlist) == rows(pairs.shortlist(whole)) and "scored" not in detection.__dict__


def test_actor_orders_keep_marked_orders_and_every_actor(spark):
    table, marks = orders(spark), spark.createDataFrame([("3", 1.0, "t")], "order_id string, priority_score double, risk_tier string")
    kept = pg.actor_orders(table, marks, "driver")
    assert kept.count() < 20 and kept.select("driver_id").distinct().count() == 7
    assert {r.driver_id: r.flagged_order_count for r in pg.actor_flags(table, marks, "driver").collect()} == {f"d{i}": int(i in (3, 393 % 7)) for i in range(7)}


def test_driver_neighborhood_counts(spark):
    table = orders(spark)
    want = table.filter("driver_id = 'd1'").groupBy("driver_id").agg(*[F.countDistinct(c) for c in ("order_id", "customer_id", "service_name")])
    places = table.filter("driver_id = 'd1'").select(F.explode(F.array("pickup_address", "last_dropoff_address")).alias("a")).distinct().filter("a IS NOT NULL").count()
    got = pg.driver_neighborhood(table, spark.createDataFrame([("d1",)], "driver_id string"))
    assert [tuple(r) for r in got.select("driver_id", "orders", "customers", "services", "addresses").collect()] == [(*want.first(), places)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_component_display_ids_beyond_999(spark, monkeypatch):
    flags = spark.range(1_001).select(
        F.lit("w").alias("window_id"), F.format_string("k%05d", "id").alias("component_id"), *[F.col("id").cast("string").alias(c) for c in ("order_id", "driver_id", "customer_id")],
        *[F.lit("x").alias(c) for c in ("service_name", "business_rule_label", "business_rule_story")],
        *[F.lit(1.0).alias(c) for c in ("priority_score", "network_risk_score", "network_support_score", "component_density")], *[F.lit(1).alias(c) for c in ("component_size", "component_edge_count")],
    )
    monkeypatch.setattr(graph_catalog, "_detect", lambda *_: type("D", (), {"flags": flags}))
    found = {r.component_id: r.component_display_id for r in __spark_entry__.queries()["component_overview"](spark, "").collect()}
    assert found["k00000"] == "WCC-001" and found["k00998"] == "WCC-999" and found["k00999"] == "WCC-100"
    whole = {r.component_id: r.component_display_id for r in reports.component_overview(flags).collect()}
    assert whole["k00999"] == "WCC-1000"
