"""Registered queries of the library and their DuckDB SQL.

Each entry names the step it shows, its columns, and the relation of the SQL chain with the same
rows. Doubles that a step leaves unrounded are rounded to six digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairtrace.functions.expr import np_round
from pairtrace.functions.shared import changed_at, generation
from pairtrace.operators import clean, graph, pairs, rules
from pairtrace.oracle import PAIR, exact_blend, exact_mean, exact_ratio, exact_sum, with_steps
from pairtrace.plans.detection import Detection
from pairtrace.sources.trips import TABLES, trips

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _six(df: DataFrame, columns: str) -> DataFrame:
    names = [c.strip() for c in columns.split(",")]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[np_round(c, 6).alias(c) if isinstance(kinds[c], T.DoubleType) else F.col(c) for c in names])


def register(name: str, columns: str, relation: str, tail: str = "", doubles: str = ""):
    """``relation``: a relation of the chain, or a SELECT over it in brackets; ``doubles``: its columns to round."""
    rounded = {c.strip() for c in doubles.split(",")} - {""}
    picks = ", ".join(f'round_even(CAST("{c}" AS DOUBLE), 6) AS "{c}"' if c in rounded else f'"{c}"' for c in map(str.strip, columns.split(",")))

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: _six(f(spark, sf_dir), columns)
        ORACLES[name] = with_steps(f"SELECT {picks} FROM {relation} {tail}")
        return f

    return add


_detections: dict[tuple, Detection] = {}


def _detect(spark: SparkSession, sf_dir: str) -> Detection:
    """The detection over a folder's orders; one serves all reports of a session as long as the tables stay unchanged."""
    marks = tuple(changed_at(spark, f"{sf_dir}/{t}.parquet") for t in TABLES)
    key = (spark.sparkContext.applicationId, sf_dir, marks, generation())
    if key not in _detections:
        _detections.clear()
        _detections[key] = Detection(trips(spark, sf_dir))
    return _detections[key]


_STATS = "pair_share_driver, pair_share_customer, ghost_rate, trip_threshold, cohort_trip_threshold"
_SHORT = f"{PAIR}, n_trips, n_ghost, pair_core_score, concentration_score, volume_score, is_extreme_volume, ghost_rate"
_NET = "component_size, component_edge_count, component_density, component_id, linked_pair_count, supporting_signal_count"


@register("read_orders", "order_id, driver_id, customer_id, order_status, order_time_local_tz, order_date, service_name, gmv, discount, payment_method", "trips", doubles="gmv, discount")
def _(spark, d):
    return trips(spark, d)


@register("active_orders", "order_id, driver_id, customer_id, order_time_local_tz, is_ghost, route_key, discount", "active", doubles="discount")
def _(spark, d):
    return _detect(spark, d).active


@register("pair_counts", f"{PAIR}, n_trips, n_ghost", "counts")
def _(spark, d):
    return pairs.pair_counts(_detect(spark, d).active)


@register("pair_counts_distinct", f"{PAIR}, n_trips", f"(SELECT {PAIR}, count(DISTINCT order_id) AS n_trips FROM active GROUP BY ALL)")
def _(spark, d):
    return pairs.pair_counts(_detect(spark, d).active, pairs.PairConfig(trip_count="distinct"))


@register("driver_totals", "window_id, driver_id, driver_trip_count", "drivers")
def _(spark, d):
    return pairs.entity_totals(pairs.pair_counts(_detect(spark, d).active), "driver")


@register("customer_totals", "window_id, customer_id, customer_trip_count", "customers")
def _(spark, d):
    return pairs.entity_totals(pairs.pair_counts(_detect(spark, d).active), "customer")


@register("modal_cohort", f"{PAIR}, top_service_name, top_pickup_province_name", "cohorts")
def _(spark, d):
    return pairs.modal_cohort(_detect(spark, d).active)


@register("trip_threshold", "window_id, trip_threshold", "thresholds", doubles="trip_threshold")
def _(spark, d):
    return pairs.trip_threshold(pairs.pair_counts(_detect(spark, d).active))


@register("cohort_threshold", "window_id, volume_cohort, cohort_trip_threshold", "cohort_thresholds", doubles="cohort_trip_threshold")
def _(spark, d):
    active = _detect(spark, d).active
    return pairs.cohort_threshold(pairs.with_cohort(pairs.pair_counts(active).join(pairs.modal_cohort(active), PAIR.split(", "))))


@register("distinct_counterparties", "window_id, driver_id, driver_counterparties", "drivers")
def _(spark, d):
    return pairs.distinct_counterparties(pairs.pair_counts(_detect(spark, d).active), "driver")


@register("distinct_counterparties_customer", "window_id, customer_id, customer_counterparties", "customers")
def _(spark, d):
    return pairs.distinct_counterparties(pairs.pair_counts(_detect(spark, d).active), "customer")


@register("pair_stats", f"{PAIR}, n_trips, n_ghost, volume_cohort, {_STATS}, trip_count_percentile, volume_score, is_extreme_volume, concentration_score, raw_concentration, expected_concentration, concentration_gap, support_factor", "pairs", doubles=_STATS)
def _(spark, d):
    return _detect(spark, d).scored


@register("score_pairs", f"{PAIR}, pair_core_score, pair_collusion_score", "scored")
def _(spark, d):
    return _detect(spark, d).scored


@register("ranked_shortlist", _SHORT, "shortlist", doubles="ghost_rate")
def _(spark, d):
    return pairs.shortlist(_detect(spark, d).scored).orderBy(F.desc("pair_core_score"), F.desc("n_trips"), "driver_id", "customer_id")


@register("top_pairs", _SHORT, "shortlist", "ORDER BY pair_core_score DESC, n_trips DESC, driver_id, customer_id LIMIT 20", doubles="ghost_rate")
def _(spark, d):
    return _detect(spark, d).shortlist.orderBy(F.desc("pair_core_score"), F.desc("n_trips"), "driver_id", "customer_id").limit(20)


@register("candidate_orders", f"{PAIR}, order_id, order_time_local_tz, gmv", "candidates", doubles="gmv")
def _(spark, d):
    return _detect(spark, d).candidates


@register("pair_rollups", f"{PAIR}, avg_gmv, total_gmv, total_discount, active_days, latest_order_date, top_dropoff_province_name", f"rollups LEFT JOIN dropoffs USING ({PAIR})", doubles="avg_gmv, total_gmv, total_discount")
def _(spark, d):
    return pairs.pair_rollups(_detect(spark, d).candidates)


@register("pair_gaps", f"{PAIR}, min_gap_min", "gaps", doubles="min_gap_min")
def _(spark, d):
    return pairs.pair_gaps(_detect(spark, d).candidates)


@register("dominant_route", f"{PAIR}, dominant_route, dominant_route_trips", "routes")
def _(spark, d):
    return pairs.dominant_route(_detect(spark, d).candidates)


@register("enriched_pairs", f"{PAIR}, avg_gmv, min_gap_min, dominant_route, dominant_route_share, high_confidence", "details", doubles="avg_gmv, min_gap_min, dominant_route_share")
def _(spark, d):
    return _detect(spark, d).risk


@register("pair_risk_features", f"{PAIR}, avg_gmv_percentile_by_cohort, gap_score, temporal_score, low_value_farming_score, suspected_ghost_score, pair_risk_score, business_impact_score", "risk")
def _(spark, d):
    return _detect(spark, d).risk


@register("pair_entities", "window_id, signal, entity, pair_key, first_day, last_day", "entities")
def _(spark, d):
    return _detect(spark, d).entities


@register("entity_degree", "window_id, signal, entity, degree, eligible, rarity", "degrees", doubles="rarity")
def _(spark, d):
    return _detect(spark, d).degrees


@register("entity_degree_report", "window_id, signal, entity, degree, eligible, rarity", "(SELECT * REPLACE (round_even(rarity, 4) AS rarity) FROM degrees)", doubles="rarity")
def _(spark, d):
    return graph.entity_degree_report(_detect(spark, d).degrees)


@register("signal_edges", "window_id, signal, entity, left, right, gap_days, weight", "signal_edges", doubles="weight")
def _(spark, d):
    return _detect(spark, d).signal_edges


@register("pair_edges", "window_id, left, right, weight, shared_entity_count, max_gap_days, signals", "(SELECT *, array_to_string(signal_types, ',') AS signals FROM edges)", doubles="weight")
def _(spark, d):
    return _detect(spark, d).edges.withColumn("signals", F.array_join("signal_types", ","))


@register("supporting_signals", "window_id, pair_key, supporting_signal_count", "support_of")
def _(spark, d):
    return graph.supporting_signals(_detect(spark, d).edges)


@register("linked_pair_count", "window_id, pair_key, linked_pair_count", "degree_of")
def _(spark, d):
    return graph.linked_pair_count(_detect(spark, d).edges)


@register("connected_components", "window_id, pair_key, label", "members")
def _(spark, d):
    return _detect(spark, d).members


@register("component_stats", "window_id, label, component_size, component_edge_count, component_density", "component_stats")
def _(spark, d):
    x = _detect(spark, d)
    return graph.component_stats(x.members, x.edges)


@register("component_ids", "window_id, label, component_id", "component_ids")
def _(spark, d):
    x = _detect(spark, d)
    return graph.component_ids(x.members, x.shortlist)


@register("shared_entity_counts", "window_id, pair_key, shared_payment_count, shared_promo_count, shared_pickup_count, shared_dropoff_count, shared_route_count", "shared_of")
def _(spark, d):
    x = _detect(spark, d)
    return graph.shared_entity_counts(x.entities, x.degrees)


@register("graph_features", f"{PAIR}, {_NET}, network_support_score, network_risk_score, fraud_risk_score, investigation_priority_score", "networked")
def _(spark, d):
    return _detect(spark, d).networked


@register(
    "graph_quality", "window_id, metric, value",
    f"""(UNPIVOT (SELECT window_id, count(*)::DOUBLE AS candidate_pairs, count(*)::DOUBLE AS graph_nodes, sum(linked_pair_count)::DOUBLE / 2 AS graph_edges,
      count(DISTINCT component_id)::DOUBLE AS component_count, max(component_size)::DOUBLE AS largest_component_size, round_even(max(component_size) / count(*), 4) AS largest_component_share,
      (count(*) FILTER (WHERE linked_pair_count = 0))::DOUBLE AS isolated_pairs, {exact_mean("linked_pair_count", 4)} AS avg_linked_pair_count,
      round_even(quantile_cont(linked_pair_count, 0.9), 4)::DOUBLE AS p90_linked_pair_count FROM networked GROUP BY window_id) ON COLUMNS(* EXCLUDE window_id) INTO NAME metric VALUE value)""",
    doubles="value",
)
def _(spark, d):
    x = _detect(spark, d)
    return graph.graph_quality(x.shortlist, x.edges, x.members)


@register(
    "graph_signal_summary", "window_id, signal, entities, eligible_entities, filtered_entities, avg_degree, max_degree, avg_rarity, retained_edges",
    f"""(SELECT d.*, coalesce(retained_edges, 0) AS retained_edges FROM (SELECT window_id, signal, count(*) AS entities, count(*) FILTER (WHERE eligible) AS eligible_entities,
      count(*) FILTER (WHERE NOT eligible) AS filtered_entities, {exact_mean("degree", 4)} AS avg_degree, max(degree) AS max_degree, {exact_mean("rarity", 4)} AS avg_rarity FROM degrees GROUP BY ALL) d
      LEFT JOIN (SELECT window_id, s AS signal, count(*) AS retained_edges FROM (SELECT window_id, unnest(signal_types) AS s FROM edges) GROUP BY ALL) e USING (window_id, signal))""",
)
def _(spark, d):
    x = _detect(spark, d)
    return graph.graph_signal_summary(x.degrees, x.edges)


@register("business_rule_scores", f"{PAIR}, repeated_pair_rule_score, ghost_trip_rule_score, route_farming_rule_score, network_pattern_rule_score, business_rule, business_rule_score", "networked")
def _(spark, d):
    return _detect(spark, d).networked


@register("reason_rules", f"{PAIR}, rule_name, reason_code, reason_order, supporting_signal, business_rule, business_rule_label", "reasons")
def _(spark, d):
    return _detect(spark, d).reasons


@register("rule_assignment", f"{PAIR}, triggered_business_rules, triggered_reason_codes, business_rule, business_rule_label, business_rule_score", "summary")
def _(spark, d):
    return _detect(spark, d).pair_summary


@register("flagged_orders", f"{PAIR}, order_id, order_date, rule_name, reason_code, risk_tier, priority_score, n_trips, ghost_rate, high_confidence, component_id, gmv, rule_version, merchant_id, pair_ratio, customer_repeat_ratio, pair_orders, triggered_business_rules, triggered_reason_codes, business_rule_score, business_rule_story, flag_reason, trip_threshold, active_days",
    "(SELECT *, 'kbc_v2_pair_graph_core' AS rule_version, CAST(NULL AS VARCHAR) AS merchant_id, pair_share_driver AS pair_ratio, pair_share_customer AS customer_repeat_ratio, n_trips AS pair_orders FROM flags)",
    doubles="ghost_rate, gmv, pair_ratio, customer_repeat_ratio, trip_threshold")
def _(spark, d):
    return _detect(spark, d).flags


_EVIDENCE = {
    **dict.fromkeys("ghost_rate pair_share_driver pair_share_customer volume_score raw_concentration support_factor concentration_score temporal_score low_value_farming_score dominant_route_share component_density".split(), 4),
    **dict.fromkeys("pair_core_score pair_collusion_score suspected_ghost_score pair_risk_score business_rule_score network_support_score network_risk_score business_impact_score fraud_risk_score priority_score".split(), 2),
    "min_gap_min": 3,
}
_NAMES = "n_trips n_ghost linked_pair_count supporting_signal_count component_size business_rule business_rule_label triggered_business_rules triggered_reason_codes dominant_route component_id driver_id customer_id high_confidence".split()


@register("flag_evidence", f"window_id, order_id, reason_code, {', '.join([*_EVIDENCE, *_NAMES])}, suspected_ghost_rate, investigation_priority_score",
    f"""(SELECT window_id, order_id, reason_code, {', '.join(f'round_even({c}, {n}) AS {c}' for c, n in _EVIDENCE.items())}, {', '.join(_NAMES)}, round_even(ghost_rate, 4) AS suspected_ghost_rate,
      round_even(priority_score, 2) AS investigation_priority_score FROM flags)""")  # fmt: skip
def _(spark, d):
    return _detect(spark, d).flags.select("window_id", "order_id", "reason_code", "evidence.*")


_VALUE = f"coalesce({exact_sum('gmv', 6)}, 0) AS total_gmv, coalesce({exact_sum('discount', 6)}, 0) AS total_discount"


def _means(of: dict[str, str]) -> str:
    return ", ".join(f"{exact_mean(c, 6)} AS {name}" for name, c in of.items())


@register("daily_flag_summary", "domain, order_date, rule_name, flagged_orders, flagged_customers, model_overlap_orders, total_gmv, total_discount",
    f"""(SELECT domain, order_date, rule_name, count(*) AS flagged_orders, count(DISTINCT customer_id) AS flagged_customers, 0 AS model_overlap_orders, {_VALUE} FROM once GROUP BY ALL)""")
def _(spark, d):
    return rules.daily_flag_summary(_detect(spark, d).flags)


@register("rule_comparison", "domain, rule_name, flagged_orders, flagged_customers, avg_priority_score, avg_network_support_score, avg_pair_risk_score, avg_ghost_score, model_overlap_orders, model_overlap_rate",
    f"""(SELECT domain, rule_name, count(*) AS flagged_orders, count(DISTINCT customer_id) AS flagged_customers, {_means({"avg_priority_score": "priority_score", "avg_network_support_score": "network_support_score",
      "avg_pair_risk_score": "pair_risk_score", "avg_ghost_score": "suspected_ghost_score"})}, 0 AS model_overlap_orders, CAST(0 AS DOUBLE) AS model_overlap_rate FROM once GROUP BY ALL)""")  # fmt: skip
def _(spark, d):
    return rules.rule_comparison(_detect(spark, d).flags)


@register("priority_recommendations", "domain, rule_name, flagged_orders, high_confidence_orders, total_discount, total_gmv, avg_pair_core_score, avg_network_support_score, avg_pair_risk_score, avg_ghost_score, avg_business_impact_score, priority_score, recommendation, model_overlap_rate",
    f"""(SELECT domain, rule_name, count(*) AS flagged_orders, count(*) FILTER (WHERE high_confidence) AS high_confidence_orders, {_VALUE}, {_means({"avg_pair_core_score": "pair_core_score",
      "avg_network_support_score": "network_support_score", "avg_pair_risk_score": "pair_risk_score", "avg_ghost_score": "suspected_ghost_score", "avg_business_impact_score": "business_impact_score"})},
      {exact_blend({"pair_risk_score": 35, "network_support_score": 15, "business_impact_score": 20, "suspected_ghost_score": 30}, 2)} AS priority_score,
      '{rules.RECOMMENDATION}' AS recommendation, CAST(0 AS DOUBLE) AS model_overlap_rate FROM once GROUP BY ALL)""")  # fmt: skip
def _(spark, d):
    return rules.priority_recommendations(_detect(spark, d).flags)


@register("component_case_summary", "window_id, component_id, driver_count, customer_count, pair_count, high_risk_pair_count, high_risk_pair_ratio, average_pair_score, maximum_pair_score, rare_shared_entity_count, weighted_internal_edge_sum, component_density, network_risk_score, component_risk_tier",
    f"""(SELECT *, {exact_ratio("high_risk_pair_count", "pair_count", 4)} AS high_risk_pair_ratio,
      CASE WHEN network_risk_score >= 80 THEN 'IMMEDIATE_REVIEW' WHEN network_risk_score >= 65 THEN 'HIGH_RISK' WHEN network_risk_score >= 50 THEN 'MONITOR' ELSE 'LOW_PRIORITY' END AS component_risk_tier FROM (
      SELECT window_id, component_id, count(DISTINCT driver_id) AS driver_count, count(DISTINCT customer_id) AS customer_count, count(*) AS pair_count,
      count(*) FILTER (WHERE investigation_priority_score >= 65) AS high_risk_pair_count, {exact_mean("fraud_risk_score", 2)} AS average_pair_score, round_even(max(fraud_risk_score), 2) AS maximum_pair_score,
      sum(supporting_signal_count)::BIGINT AS rare_shared_entity_count, max(component_edge_count) AS weighted_internal_edge_sum, round_even(max(component_density), 2) AS component_density,
      {exact_mean("network_risk_score", 2)} AS network_risk_score FROM networked GROUP BY ALL))""")  # fmt: skip
def _(spark, d):
    return rules.component_case_summary(_detect(spark, d).networked)


@register("pair_evidence", f"{PAIR}, reason_code, supporting_signal, observed_value, threshold, score_contribution, data_quality_level, description",
    f"""(SELECT DISTINCT {PAIR}, 'derived' AS data_quality_level, flag_reason AS description, reason_code, supporting_signal, round_even(CASE reason_code WHEN 'KB-C_EXTREME_VOLUME' THEN n_trips WHEN 'KB-C_TIGHT_PAIR_SHARE' THEN concentration_score
      WHEN 'KB-C_SUSPICIOUS_COMPONENT' THEN component_size WHEN 'KB-C_HIGH_GHOST_RATE' THEN ghost_rate WHEN 'KB-C_SUPERFAST_GAP' THEN min_gap_min ELSE dominant_route_share END, 4) AS observed_value,
      round_even(CASE reason_code WHEN 'KB-C_EXTREME_VOLUME' THEN cohort_trip_threshold WHEN 'KB-C_TIGHT_PAIR_SHARE' THEN 0.6 WHEN 'KB-C_SUSPICIOUS_COMPONENT' THEN 3.0
      WHEN 'KB-C_HIGH_GHOST_RATE' THEN 0.5 WHEN 'KB-C_SUPERFAST_GAP' THEN 2.0 ELSE 0.7 END, 4) AS threshold, round_even(investigation_priority_score, 2) AS score_contribution FROM reasons)""")  # fmt: skip
def _(spark, d):
    return rules.pair_evidence(_detect(spark, d).reasons)


@register("quality_report", "metric, value",
    f"""(SELECT 'raw_orders' AS metric, count(*)::DOUBLE AS value FROM trips UNION ALL SELECT 'active_orders', count(*) FROM active UNION ALL SELECT 'trip_threshold_q9999', round_even(max(trip_threshold), 4) FROM pairs
      UNION ALL SELECT 'candidate_pairs', count(*) FROM shortlist UNION ALL SELECT 'high_confidence_pairs', count(*) FILTER (WHERE high_confidence) FROM details
      UNION ALL SELECT 'flagged_rows', count(*) FROM flags UNION ALL SELECT 'flagged_pairs', count(*) FROM (SELECT DISTINCT {PAIR} FROM flags))""", doubles="value")  # fmt: skip
def _(spark, d):
    x = _detect(spark, d)
    return rules.quality_report(x.orders, x.active, x.scored, x.risk, x.flags)


@register("known_pair_evaluation", "driver_id, customer_id, reason_code, is_flagged",
    """(SELECT k.*, reason_code, reason_code IS NOT NULL AS is_flagged FROM (SELECT DISTINCT driver_id, customer_id FROM active WHERE driver_id LIKE 'R%') k
      LEFT JOIN (SELECT DISTINCT driver_id, customer_id, reason_code FROM flags) USING (driver_id, customer_id))""")  # fmt: skip
def _(spark, d):
    x = _detect(spark, d)
    return x.known(x.base.filter(F.col("driver_id").startswith("R")).select("driver_id", "customer_id").distinct())


@register("known_pair_hit_rate", "metric, value", """(WITH k AS (SELECT a.driver_id, a.customer_id, reason_code IS NOT NULL AS hit FROM (SELECT DISTINCT driver_id, customer_id FROM active WHERE driver_id LIKE 'R%') a
      LEFT JOIN (SELECT DISTINCT driver_id, customer_id, reason_code FROM flags) USING (driver_id, customer_id))
      SELECT 'row_hit_rate' AS metric, round_even(avg(hit::INT), 4) AS value FROM k UNION ALL SELECT 'pair_hit_rate', round_even(avg(h::INT), 4) FROM (SELECT bool_or(hit) AS h FROM k GROUP BY driver_id, customer_id))""")  # fmt: skip
def _(spark, d):
    x = _detect(spark, d)
    return rules.known_pair_hit_rate(x.known(x.base.filter(F.col("driver_id").startswith("R")).select("driver_id", "customer_id").distinct()))


@register("normalized_payment", "order_id, entity, n", "(SELECT order_id, CASE WHEN lower(trim(payment_method)) NOT IN ('cash') THEN trim(payment_method) END AS entity, count(*) AS n FROM trips GROUP BY ALL)")
def _(spark, d):
    return trips(spark, d).groupBy("order_id", clean.normalize_entity("payment", F.col("payment_method")).alias("entity")).agg(F.count("*").alias("n"))
