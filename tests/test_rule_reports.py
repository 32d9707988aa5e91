"""Reports over rules with figures worked out by hand, and means that don't depend on the order of rows."""

import datetime as dt
import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from pairtrace.functions import expr
from pairtrace.operators import reports, rules

FLAGS = (
    "order_id string, driver_id string, customer_id string, rule_name string, domain string, order_date date, order_time_local_tz timestamp_ntz, gmv double, discount double, priority_score double, "
    "network_support_score double, pair_risk_score double, pair_core_score double, suspected_ghost_score double, business_impact_score double, high_confidence boolean"
)
DAY, TIME = dt.date(2026, 7, 14), dt.datetime(2026, 7, 14, 10)


def flags(spark):
    rows = [
        ("o1", "d1", "c1", "R", "ride", DAY, TIME, 100.0, 5.0, 60.0, 40.0, 50.1, 66.65, 80.0, 30.0, True),
        ("o1", "d1", "c1", "R", "ride", DAY, TIME, 100.0, 5.0, 60.0, 40.0, 50.1, 66.65, 80.0, 30.0, True),  # a second reason of the order
        ("o2", "d2", "c1", "R", "ride", DAY, TIME, 200.1, 7.0, 71.5, 45.5, 50.2, 43.0, 90.0, 20.0, False),
        ("o3", "d2", "c2", "S", "ride", DAY, TIME, None, 1.0, 10.0, 0.0, 12.34, 1.0, 20.0, 3.0, True),
    ]
    return spark.createDataFrame(rows, FLAGS)


def test_rule_comparison_means_support_and_ghost_scores(spark):
    got = {r.rule_name: r.asDict() for r in rules.rule_comparison(flags(spark)).collect()}
    assert got["R"] == {
        "domain": "ride", "rule_name": "R", "flagged_orders": 2, "flagged_customers": 1, "avg_priority_score": 65.75, "avg_network_support_score": 42.75,
        "avg_pair_risk_score": 50.15, "avg_ghost_score": 85.0, "model_overlap_orders": 0, "model_overlap_rate": 0.0,
    }
    assert got["S"]["avg_ghost_score"] == 20.0


def test_recommendations_blend_means_on_the_scale_of_100(spark):
    first, second = rules.priority_recommendations(flags(spark)).collect()
    # 0.35 * 50.15 + 0.15 * 42.75 + 0.20 * 25 + 0.30 * 85 = 54.465, half way, to the even digit
    assert (first.rule_name, first.priority_score, first.flagged_orders, first.high_confidence_orders) == ("R", 54.46, 2, 1)
    assert (first.total_gmv, first.total_discount, first.avg_pair_core_score, first.avg_business_impact_score) == (300.1, 12.0, 54.825, 25.0)
    # 0.35 * 12.34 + 0.20 * 3 + 0.30 * 20 = 10.919
    assert (second.rule_name, second.priority_score, second.total_gmv) == ("S", 10.92, 0.0)
    assert first.recommendation.startswith("Prioritize pairs with strong ghost evidence") and first.model_overlap_rate == 0.0


def test_daily_summary_counts_an_order_once(spark):
    got = [tuple(r) for r in rules.daily_flag_summary(flags(spark)).collect()]
    assert got == [("ride", DAY, "R", 2, 1, 0, 300.1, 12.0), ("ride", DAY, "S", 1, 1, 0, 0.0, 1.0)]


def test_component_tier_goes_by_mean_network_risk(spark):
    schema = "window_id string, component_id string, driver_id string, customer_id string, investigation_priority_score double, fraud_risk_score double, supporting_signal_count long, component_edge_count long, component_density double, network_risk_score double"
    rows = [
        ("w", "k1", "d1", "c1", 65.0, 95.0, 2, 3, 0.6667, 49.99), ("w", "k1", "d1", "c2", 64.99, 10.01, 1, 3, 0.6667, 50.0), ("w", "k1", "d2", "c2", 90.0, 30.0, 0, 3, 0.6667, 50.02),
        ("w", "k2", "d9", "c9", 10.0, 99.0, 0, 0, 0.0, 49.994),
    ]
    first, second = (r.asDict() for r in rules.component_case_summary(spark.createDataFrame(rows, schema)).collect())
    assert first == {
        "window_id": "w", "component_id": "k1", "driver_count": 2, "customer_count": 2, "pair_count": 3, "high_risk_pair_count": 2, "average_pair_score": 45.0, "maximum_pair_score": 95.0,
        "rare_shared_entity_count": 3, "weighted_internal_edge_sum": 3, "component_density": 0.67, "network_risk_score": 50.0, "high_risk_pair_ratio": 0.6667, "component_risk_tier": "MONITOR",
    }
    assert (second["network_risk_score"], second["component_risk_tier"], second["maximum_pair_score"]) == (49.99, "LOW_PRIORITY", 99.0)


def test_counts_of_distinct_values_repeat_no_row(spark):
    """Equal to the engine's distinct counts, nulls and absent values included, without an expanded plan."""
    rnd = random.Random(7)
    some = lambda n: rnd.choice([None, *map(str, range(n))])
    rows = [(some(4), some(40), some(6), some(9)) for _ in range(700)] + [("only nulls", None, None, None)]
    df = spark.createDataFrame(rows, "k string, a string, b string, c string").repartition(3)
    counts = {"n_a": ("a",), "n_b": ("b",), "n_pairs": ("b", "c")}
    order = lambda d: sorted(map(tuple, d.collect()), key=str)
    got = expr.distinct_counts(df, ["k"], counts)
    want = [F.countDistinct("a").alias("n_a"), F.countDistinct("b").alias("n_b"), F.countDistinct(F.struct("b", "c")).alias("n_pairs")]
    assert order(got) == order(df.groupBy("k").agg(*want)) and order(expr.distinct_counts(df, [], counts)) == order(df.agg(*want))
    assert order(expr.distinct_counts(df.limit(0), [], counts)) == [(0, 0, 0)] and expr.distinct_counts(df.limit(0), ["k"], counts).count() == 0
    looked = reports.case_lookup(flags(spark).withColumns({"business_rule_label": F.lit("x"), "risk_tier": F.lit("y")}), "customer")
    for report in (got, reports.period_summary(flags(spark), "day"), looked):
        assert "Expand" not in report._jdf.queryExecution().toString() and report.count()


def test_means_do_not_depend_on_the_order_of_rows(spark):
    rnd = random.Random(3)
    rows = [(f"KB{i % 7}", "s", "t", rnd.randrange(10_001) / 100, rnd.randrange(1, 9) / 9) for i in range(4_000)]
    rows += [("TIE", "s", "t", 50.4662, 0.5), ("TIE", "s", "t", 50.4663, 0.25), ("DOWN", None, None, 50.4663, 1 / 3), ("DOWN", "s", None, 50.4664, 1 / 3)]
    df = spark.createDataFrame(rows, "reason_code string, supporting_signal string, flag_reason string, investigation_priority_score double, ghost_rate double")
    want = None
    for parts in (1, 2, 3, 5):
        got = [tuple(r) for r in reports.reason_overview(df.repartition(parts)).collect()]
        want = want or got
        assert got == want
    by = {r[0]: r for r in want}
    assert (by["TIE"][2], by["TIE"][3], by["DOWN"][2], by["DOWN"][3]) == (50.4662, 0.375, 50.4664, 0.3333)
    for code in ("KB0", "KB6"):
        mine = [Decimal(str(r[3])) for r in rows if r[0] == code]
        assert by[code][2] == float((sum(mine) / len(mine)).quantize(Decimal("0.0001"), ROUND_HALF_EVEN))


@pytest.mark.parametrize(("values", "digits", "mean"), [([0.5, 1.0], 1, 0.8), ([0.5, 0.0], 1, 0.2), ([-0.5, -1.0], 1, -0.8), ([1e5, 1e-9], 9, 50000.0), ([None, 3.0], 2, 3.0), ([None], 2, None)])
def test_exact_mean(spark, values, digits, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(expr.exact_mean("v", digits).alias("m"), expr.exact_sum("v").alias("s")).first()
    assert got.m == mean and got.s == (sum(v for v in values if v is not None) if mean is not None else None)


def test_low_value_takes_the_percentile_as_it_is(spark):
    """Three pairs of one cohort: percentiles are thirds, which four digits would cut."""
    from pairtrace.operators import scoring

    schema = "window_id string, volume_cohort string, pair_key string, avg_gmv double, total_discount double, total_gmv double, min_gap_min double, dominant_route_share double, volume_score double, ghost_rate double, pair_collusion_score double"
    rows = [("w", "k", f"p{i}", float(i), 1.0, 1.0, None, 0.0, 1.0, 0.0, 0.0) for i in range(1, 4)]
    got = {r.pair_key: r for r in scoring.pair_risk_features(spark.createDataFrame(rows, schema)).select("*", F.lit(1)).collect()}
    assert (got["p1"].avg_gmv_percentile_by_cohort, got["p1"].low_value_farming_score, got["p2"].low_value_farming_score) == (0.3333, 0.6667, 0.3333)
    assert (got["p1"].suspected_ghost_score, got["p1"].pair_risk_score) == (13.33, 7.33)
