"""DuckDB SQL of the detection steps: one chain of CTEs that every check selects from."""

from __future__ import annotations

import re

from pairtrace.operators.rules import LABELS, REASON_TEXTS, REASONS, STORIES
from pairtrace.sources.trips import TRIPS_SQL

PAIR = "window_id, driver_id, customer_id"
_clip = lambda x: f"greatest(0.0, least(1.0, coalesce({x}, 0.0)))"
_share = lambda n, d: f"coalesce(CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0), 0)"


def exact_ratio(top: str, bottom: str, digits: int) -> str:
    """SQL: top / bottom of whole numbers that are not negative, rounded half-even once."""
    a = f"({top} * {10**digits})"
    return f"(({a} // {bottom}) + CASE WHEN 2 * ({a} % {bottom}) > {bottom} OR (2 * ({a} % {bottom}) = {bottom} AND ({a} // {bottom}) % 2 = 1) THEN 1 ELSE 0 END) / 1e{digits}"


def _whole(x: str, units: int) -> str:
    return f"sum(CAST(round_even(CAST({x} AS DOUBLE) * 1e{units}, 0) AS HUGEINT))"


def exact_sum(x: str, units: int = 9) -> str:
    return f"CAST({_whole(x, units)} AS DOUBLE) / 1e{units}"


def exact_mean(x: str, digits: int, units: int = 9) -> str:
    return exact_ratio(_whole(x, units), f"(CAST(count({x}) AS HUGEINT) * {10**units})", digits)


def exact_blend(weights: dict[str, int], digits: int, units: int = 9) -> str:
    return exact_ratio("(" + " + ".join(f"{w} * {_whole(x, units)}" for x, w in weights.items()) + ")", f"(CAST(count(*) AS HUGEINT) * {100 * 10**units})", digits)


def _entity(signal: str, column: str) -> str:
    bare = f"trim({column})"
    bad = f"lower({bare}) IN ('', 'nan', '<na>', 'none', 'null', 'unknown')"
    if signal == "payment":
        bad += f" OR lower({bare}) IN ('cash', 'ti_n_mat', 'tien_mat')"
    if signal in ("pickup", "dropoff"):
        bad += f" OR replace({bare}, ' ', '') IN ('(0.000000,0.000000)', '(0.0,0.0)', '0,0', '0.0,0.0', '0.000000,0.000000')"
    return f"SELECT window_id, driver_id || '||' || customer_id AS pair_key, order_date AS day, '{signal}' AS signal, CASE WHEN NOT ({bad}) THEN {bare} END AS entity FROM candidates"


_ENTITIES = " UNION ALL ".join(
    _entity(s, c) for s, c in (("payment", "payment_method"), ("promo", "promotion_code"), ("pickup", "pickup_address"), ("dropoff", "last_dropoff_address"), ("route", "route_key"))
)
_RULE_OF = "CASE reason_code " + " ".join(f"WHEN '{c}' THEN '{r}'" for c, r, _ in REASONS) + " END"
_SIGNAL_OF = "CASE reason_code " + " ".join(f"WHEN '{c}' THEN '{s}'" for c, _, s in REASONS) + " END"
_LABEL_OF, _STORY_OF = ("CASE business_rule " + " ".join(f"WHEN '{r}' THEN '{t}'" for r, t in texts.items()) + " END" for texts in (LABELS, STORIES))
_TEXT_OF = "CASE reason_code " + " ".join(f"WHEN '{r}' THEN '{t}'" for r, t in REASON_TEXTS.items()) + " END"
_TESTS = (
    "is_extreme_volume AND n_trips >= 8 AND (pair_share_driver >= 0.6 OR pair_share_customer >= 0.6)",
    "n_trips >= 8 AND pair_share_driver >= 0.6 AND pair_share_customer >= 0.6",
    "component_size >= 3 AND linked_pair_count >= 2 AND supporting_signal_count >= 2",
    "ghost_rate >= 0.5 AND n_trips >= 4",
    "min_gap_min >= 0 AND min_gap_min < 2 AND ghost_rate >= 0.2 AND n_trips >= 6",
    "n_trips >= 8 AND dominant_route_share >= 0.7",
)
_REASONS = " UNION ALL ".join(f"SELECT *, {i} AS reason_order, '{code}' AS reason_code FROM networked WHERE {t}" for i, ((code, _, _), t) in enumerate(zip(REASONS, _TESTS, strict=True)))

PREFIX = f"""
WITH RECURSIVE trips AS ({TRIPS_SQL}),
active AS (
  SELECT * REPLACE (trim(driver_id) AS driver_id, trim(customer_id) AS customer_id, coalesce(discount, 0.0) AS discount),
    coalesce(avg_kmh = 0, false) AS is_ghost, coalesce(pickup_address, '') || ' -> ' || coalesce(last_dropoff_address, '') AS route_key
  FROM trips WHERE upper(trim(order_status)) = 'COMPLETED' AND driver_id IS NOT NULL AND customer_id IS NOT NULL AND order_time_local_tz IS NOT NULL),
counts AS (SELECT {PAIR}, count(*) AS n_trips, count(*) FILTER (WHERE is_ghost) AS n_ghost FROM active GROUP BY ALL),
votes AS (SELECT {PAIR}, service_name, pickup_province_name, count(*) AS v FROM active GROUP BY ALL),
cohorts AS (
  SELECT {PAIR}, service_name AS top_service_name, pickup_province_name AS top_pickup_province_name FROM votes
  QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY v DESC, service_name NULLS LAST, pickup_province_name NULLS LAST) = 1),
drivers AS (SELECT window_id, driver_id, count(*) AS driver_trip_count, count(DISTINCT customer_id) AS driver_counterparties FROM active GROUP BY ALL),
customers AS (SELECT window_id, customer_id, count(*) AS customer_trip_count, count(DISTINCT driver_id) AS customer_counterparties FROM active GROUP BY ALL),
base AS (
  SELECT *, {_share("n_trips", "driver_trip_count")} AS pair_share_driver, {_share("n_trips", "customer_trip_count")} AS pair_share_customer,
    {_share("n_ghost", "n_trips")} AS ghost_rate,
    trim(coalesce(top_service_name, 'unknown')) || '|' || trim(coalesce(top_pickup_province_name, 'unknown')) AS volume_cohort
  FROM counts JOIN cohorts USING ({PAIR}) JOIN drivers USING (window_id, driver_id) JOIN customers USING (window_id, customer_id)),
thresholds AS (SELECT window_id, greatest(2.0, quantile_cont(n_trips, 0.9999)) AS trip_threshold FROM base GROUP BY ALL),
cohort_thresholds AS (SELECT window_id, volume_cohort, greatest(2.0, quantile_cont(n_trips, 0.9999)) AS cohort_trip_threshold FROM base GROUP BY ALL),
shaped AS (
  SELECT *, cume_dist() OVER (PARTITION BY window_id, volume_cohort ORDER BY n_trips) AS pct,
    {_clip("least(pair_share_driver, pair_share_customer)")} AS raw, least(1.0 / (driver_counterparties + 1), 1.0 / (customer_counterparties + 1)) AS expected,
    greatest(2.0, least(30.0, greatest(10.0, 1.5 * trip_threshold))) AS cap
  FROM base JOIN thresholds USING (window_id) JOIN cohort_thresholds USING (window_id, volume_cohort)),
stats AS (
  SELECT *, {_clip("(raw - expected) / nullif(1 - expected, 0)")} AS gap, {_clip("ln(1 + n_trips) / ln(1 + cap)")} AS support FROM shaped),
pairs AS (
  SELECT *, round_even(pct, 4) AS trip_count_percentile,
    round_even(least(3.0, greatest(0.0, n_trips / greatest(coalesce(cohort_trip_threshold, trip_threshold), 1.0))) / 3, 4) AS volume_score,
    n_trips >= cohort_trip_threshold AS is_extreme_volume, round_even({_clip("gap * support")}, 4) AS concentration_score,
    round_even(raw, 4) AS raw_concentration, round_even(expected, 4) AS expected_concentration, round_even(gap, 4) AS concentration_gap, round_even(support, 4) AS support_factor
  FROM stats),
scored AS (
  SELECT *, round_even(100 * (0.45 * volume_score + 0.55 * concentration_score), 2) AS pair_core_score,
    round_even(100 * (0.45 * volume_score + 0.55 * concentration_score), 2) AS pair_collusion_score FROM pairs),
shortlist AS (
  SELECT * FROM scored WHERE n_trips >= 4 AND (ghost_rate >= 0.5 OR (is_extreme_volume
    AND (pair_share_driver >= 0.4 OR pair_share_customer >= 0.6) AND (concentration_score >= 0.85 OR pair_core_score >= 50)))),
candidates AS (SELECT a.* FROM active a SEMI JOIN shortlist USING ({PAIR})),
rollups AS (
  SELECT {PAIR}, {exact_mean("gmv", 6, 6)} AS avg_gmv, coalesce({exact_sum("gmv", 6)}, 0) AS total_gmv, coalesce({exact_sum("discount", 6)}, 0) AS total_discount,
    count(DISTINCT order_date) AS active_days, max(order_date) AS latest_order_date FROM candidates GROUP BY ALL),
dropoffs AS (
  SELECT {PAIR}, last_dropoff_province_name AS top_dropoff_province_name FROM (SELECT {PAIR}, last_dropoff_province_name, count(*) AS n FROM candidates WHERE last_dropoff_province_name IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY n DESC, last_dropoff_province_name) = 1),
gaps AS (
  SELECT {PAIR}, min(g) AS min_gap_min FROM (SELECT {PAIR}, date_diff('microsecond', lag(order_time_local_tz) OVER (
    PARTITION BY {PAIR} ORDER BY order_time_local_tz, order_id), order_time_local_tz) / 60e6 AS g FROM candidates) GROUP BY ALL),
routes AS (
  SELECT {PAIR}, route_key AS dominant_route, n AS dominant_route_trips FROM (SELECT {PAIR}, route_key, count(*) AS n FROM candidates GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY n DESC, route_key) = 1),
details AS (
  SELECT *, {_share("dominant_route_trips", "n_trips")} AS dominant_route_share,
    coalesce(ghost_rate >= 0.5 AND n_trips >= 4, false) OR coalesce(min_gap_min >= 0 AND min_gap_min < 2 AND ghost_rate >= 0.2 AND n_trips >= 6, false) AS high_confidence
  FROM shortlist JOIN rollups USING ({PAIR}) JOIN gaps USING ({PAIR}) JOIN routes USING ({PAIR})),
ranked AS (
  SELECT *, cume_dist() OVER (PARTITION BY window_id, volume_cohort ORDER BY avg_gmv) AS cohort_pct,
    cume_dist() OVER (PARTITION BY window_id ORDER BY total_discount) AS disc_pct, cume_dist() OVER (PARTITION BY window_id ORDER BY total_gmv) AS gmv_pct,
    {_clip("(30 - coalesce(min_gap_min, 30.0)) / 30")} AS gap_raw FROM details),
timed AS (SELECT *, {_clip("0.7 * gap_raw + 0.3 * dominant_route_share")} AS temporal_raw, {_clip("volume_score * (1 - cohort_pct)")} AS low_raw FROM ranked),
ghosts AS (SELECT *, 100 * (0.5 * ghost_rate + 0.3 * temporal_raw + 0.2 * low_raw) AS ghost_raw FROM timed),
risk AS (
  SELECT *, round_even(cohort_pct, 4) AS avg_gmv_percentile_by_cohort, round_even(gap_raw, 4) AS gap_score, round_even(temporal_raw, 4) AS temporal_score, round_even(low_raw, 4) AS low_value_farming_score,
    round_even(ghost_raw, 2) AS suspected_ghost_score, round_even(0.45 * pair_collusion_score + 0.55 * ghost_raw, 2) AS pair_risk_score,
    round_even(100 * (0.45 * disc_pct + 0.35 * gmv_pct + 0.20 * volume_score), 2) AS business_impact_score FROM ghosts),
entities AS (
  SELECT window_id, signal, entity, pair_key, min(day) AS first_day, max(day) AS last_day FROM ({_ENTITIES}) WHERE entity IS NOT NULL GROUP BY ALL),
degrees AS (
  SELECT *, degree >= 2 AND degree <= CASE signal WHEN 'payment' THEN 50 WHEN 'promo' THEN 40 WHEN 'route' THEN 20 ELSE 25 END AS eligible,
    CASE signal WHEN 'payment' THEN 1.0 WHEN 'promo' THEN 0.85 WHEN 'route' THEN 0.7 ELSE 0.8 END / greatest(ln(1 + degree), 1) AS rarity
  FROM (SELECT window_id, signal, entity, count(*) AS degree FROM entities GROUP BY ALL)),
linked AS (SELECT e.*, d.rarity FROM entities e JOIN degrees d USING (window_id, signal, entity) WHERE eligible),
signal_edges AS (
  SELECT *, rarity * greatest(0.25, 1 - gap_days / 4.0) AS weight FROM (
    SELECT a.window_id, a.signal, a.entity, a.pair_key AS "left", b.pair_key AS "right", a.rarity,
      CASE WHEN a.last_day < b.first_day THEN b.first_day - a.last_day WHEN b.last_day < a.first_day THEN a.first_day - b.last_day ELSE 0 END AS gap_days
    FROM linked a JOIN linked b ON a.window_id = b.window_id AND a.signal = b.signal AND a.entity = b.entity AND a.pair_key < b.pair_key) WHERE gap_days <= 3),
edges AS (
  SELECT window_id, "left", "right", round_even(w, 4) AS weight, signal_types, shared_entity_count, max_gap_days FROM (
    SELECT window_id, "left", "right", {exact_sum("weight")} AS w, list_sort(list(DISTINCT signal)) AS signal_types, count(*) AS shared_entity_count, max(gap_days) AS max_gap_days
    FROM signal_edges GROUP BY ALL) WHERE (len(signal_types) >= 2 AND w >= 1.35) OR (shared_entity_count >= 2 AND w >= 1.75)),
ends AS (SELECT window_id, "left" AS pair_key, "right" AS other, signal_types FROM edges UNION ALL SELECT window_id, "right", "left", signal_types FROM edges),
nodes AS (SELECT *, driver_id || '||' || customer_id AS pair_key FROM risk),
reach(window_id, pair_key, other) AS (
  SELECT window_id, pair_key, pair_key FROM nodes UNION SELECT r.window_id, r.pair_key, e.other FROM reach r JOIN ends e ON r.window_id = e.window_id AND r.other = e.pair_key),
members AS (SELECT window_id, pair_key, min(other) AS label FROM reach GROUP BY ALL),
component_stats AS (
  SELECT *, CASE WHEN component_size > 1 THEN round_even(2.0 * component_edge_count / (component_size * (component_size - 1)), 4) ELSE 0.0 END AS component_density FROM (
    SELECT m.window_id, label, count(DISTINCT m.pair_key) AS component_size, count(e."left") AS component_edge_count
    FROM members m LEFT JOIN edges e ON m.window_id = e.window_id AND m.pair_key = e."left" GROUP BY ALL)),
component_ids AS (
  SELECT window_id, label, window_id || '_ride_component_' || dense_rank() OVER (PARTITION BY window_id ORDER BY r) AS component_id FROM (
    SELECT window_id, label, min(r) AS r FROM members JOIN (
      SELECT window_id, pair_key, row_number() OVER (PARTITION BY window_id ORDER BY pair_core_score DESC, n_trips DESC, pair_key) AS r FROM nodes) USING (window_id, pair_key) GROUP BY ALL)),
degree_of AS (SELECT window_id, pair_key, count(*) AS linked_pair_count FROM ends GROUP BY ALL),
support_of AS (SELECT window_id, pair_key, count(DISTINCT s) AS supporting_signal_count FROM (SELECT window_id, pair_key, unnest(signal_types) AS s FROM ends) GROUP BY ALL),
shared_of AS (
  SELECT window_id, pair_key, {", ".join(f"count(*) FILTER (WHERE signal = '{s}') AS shared_{s}_count" for s in ("payment", "promo", "pickup", "dropoff", "route"))} FROM linked GROUP BY ALL),
joined AS (
  SELECT n.*, component_id, component_size, component_edge_count, component_density, coalesce(linked_pair_count, 0) AS linked_pair_count,
    coalesce(supporting_signal_count, 0) AS supporting_signal_count,
    {", ".join(f"coalesce(shared_{s}_count, 0) AS shared_{s}_count" for s in ("payment", "promo", "pickup", "dropoff", "route"))}
  FROM nodes n JOIN members USING (window_id, pair_key) JOIN component_stats USING (window_id, label) JOIN component_ids USING (window_id, label)
  LEFT JOIN degree_of USING (window_id, pair_key) LEFT JOIN support_of USING (window_id, pair_key) LEFT JOIN shared_of USING (window_id, pair_key)),
supported AS (
  SELECT *, round_even(100 * (0.35 * {_clip("ln(1 + linked_pair_count) / ln(9.0)")} + 0.30 * {_clip("supporting_signal_count / 4")}
    + 0.20 * {_clip("ln(1 + shared_payment_count + shared_promo_count + shared_pickup_count + shared_dropoff_count + shared_route_count) / ln(13.0)")}
    + 0.15 * {_clip("component_density * 4 / ln(1 + greatest(component_size, 2))")}), 2) AS network_support_score FROM joined),
aligned AS (
  SELECT *, round_even(network_support_score * greatest(0.35, least(1.0, 0.35 + 0.35 * pair_collusion_score / 100 + 0.30 * suspected_ghost_score / 100)), 2) AS network_risk_score FROM supported),
frauds AS (SELECT *, round_even(0.35 * pair_collusion_score + 0.45 * suspected_ghost_score + 0.20 * network_risk_score, 2) AS fraud_risk_score FROM aligned),
ruled AS (
  SELECT *, round_even(0.75 * fraud_risk_score + 0.25 * business_impact_score, 2) AS investigation_priority_score,
    round_even(100 * (0.60 * (pair_collusion_score / 100) + 0.25 * concentration_score + 0.15 * volume_score), 2) AS repeated_pair_rule_score,
    round_even(100 * (0.65 * suspected_ghost_score / 100 + 0.20 * temporal_score + 0.15 * ghost_rate), 2) AS ghost_trip_rule_score,
    round_even(100 * ((0.55 * {_clip("dominant_route_share")} + 0.20 * temporal_score + 0.15 * (pair_collusion_score / 100) + 0.10 * ghost_rate) * {_clip("n_trips / 6")}), 2) AS route_farming_rule_score,
    round_even(100 * (0.55 * network_risk_score / 100 + 0.20 * {_clip("supporting_signal_count / 4")} + 0.15 * {_clip("linked_pair_count / 6")} + 0.10 * {_clip("component_density")}), 2) AS network_pattern_rule_score
  FROM frauds),
topped AS (SELECT *, greatest(repeated_pair_rule_score, ghost_trip_rule_score, route_farming_rule_score, network_pattern_rule_score) AS business_rule_score FROM ruled),
networked AS (
  SELECT *, CASE business_rule_score WHEN repeated_pair_rule_score THEN 'REPEATED_LOCKED_PAIR' WHEN ghost_trip_rule_score THEN 'GHOST_TRIP_EXECUTION_PATTERN'
    WHEN route_farming_rule_score THEN 'ROUTE_FARMING_PATTERN' ELSE 'COORDINATED_NETWORK_PATTERN' END AS business_rule FROM topped),
reason_rows AS ({_REASONS}),
reasons AS (
  SELECT *, {_LABEL_OF} AS business_rule_label, {_STORY_OF} AS business_rule_story, {_TEXT_OF} AS flag_reason FROM (SELECT * REPLACE ({_RULE_OF} AS business_rule), {_SIGNAL_OF} AS supporting_signal,
    'REPEATED_CUSTOMER_DRIVER' AS rule_name FROM reason_rows)),
reason_scores AS (
  SELECT *, CASE business_rule WHEN 'REPEATED_LOCKED_PAIR' THEN repeated_pair_rule_score WHEN 'GHOST_TRIP_EXECUTION_PATTERN' THEN ghost_trip_rule_score
    WHEN 'ROUTE_FARMING_PATTERN' THEN route_farming_rule_score ELSE network_pattern_rule_score END AS s FROM reasons),
primaries AS (
  SELECT {PAIR}, business_rule AS primary_rule, s AS primary_score FROM reason_scores QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY s DESC, reason_order) = 1),
triggered AS (
  SELECT {PAIR}, string_agg(reason_code, ' | ' ORDER BY reason_order) AS triggered_reason_codes FROM reasons GROUP BY ALL),
rule_lists AS (
  SELECT {PAIR}, string_agg(business_rule, ' | ' ORDER BY o) AS triggered_business_rules FROM (SELECT {PAIR}, business_rule, min(reason_order) AS o FROM reasons GROUP BY ALL) GROUP BY ALL),
summary AS (
  SELECT *, {_LABEL_OF} AS business_rule_label FROM (
    SELECT n.* REPLACE (coalesce(primary_rule, business_rule) AS business_rule, coalesce(primary_score, business_rule_score) AS business_rule_score), triggered_business_rules, triggered_reason_codes
    FROM networked n LEFT JOIN primaries USING ({PAIR}) LEFT JOIN triggered USING ({PAIR}) LEFT JOIN rule_lists USING ({PAIR}))),
flags AS (
  SELECT c.*, r.rule_name, r.reason_code, r.supporting_signal, r.business_rule, r.business_rule_label, r.n_trips, r.n_ghost, r.ghost_rate, r.high_confidence, r.component_id, r.component_size,
    r.network_risk_score, r.pair_risk_score, r.business_impact_score, r.investigation_priority_score AS priority_score, 'ride' AS domain, r.avg_gmv, r.pair_core_score, r.network_support_score,
    r.min_gap_min, r.supporting_signal_count, r.linked_pair_count, r.component_density, r.component_edge_count, r.pair_share_driver, r.pair_share_customer, r.volume_score,
    r.raw_concentration, r.support_factor, r.concentration_score, r.pair_collusion_score, r.temporal_score, r.low_value_farming_score, r.suspected_ghost_score, r.business_rule_score,
    r.fraud_risk_score, r.dominant_route, r.dominant_route_share, r.business_rule_story, r.flag_reason, t.triggered_reason_codes, l.triggered_business_rules, r.trip_threshold, r.active_days,
    CASE WHEN (r.ghost_rate >= 0.8 AND r.n_trips >= 10) OR r.investigation_priority_score >= 80 THEN 'IMMEDIATE_REVIEW' WHEN r.investigation_priority_score >= 65 THEN 'HIGH_RISK'
      WHEN r.investigation_priority_score >= 50 THEN 'MONITOR' ELSE 'LOW_PRIORITY' END AS risk_tier
  FROM candidates c JOIN reasons r USING ({PAIR}) JOIN triggered t USING ({PAIR}) JOIN rule_lists l USING ({PAIR})),
once AS (
  SELECT * FROM flags QUALIFY row_number() OVER (PARTITION BY order_id, rule_name ORDER BY priority_score DESC, driver_id DESC, customer_id DESC, order_time_local_tz DESC, gmv DESC) = 1)
"""


def _steps() -> dict[str, str]:
    """Name of each step to its text, as ``name(columns) AS MATERIALIZED (...)``."""
    body = PREFIX.strip().removeprefix("WITH RECURSIVE ")
    starts = list(re.finditer(r"^(\w+)(\([\w, ]+\))? AS \(", body, re.MULTILINE))
    ends = [m.start() for m in starts[1:]] + [len(body)]
    return {m[1]: body[m.start() : e].strip().rstrip(",").replace(" AS (", " AS MATERIALIZED (" if m[1] != "reach" else " AS (", 1) for m, e in zip(starts, ends, strict=True)}


STEPS = _steps()


def with_steps(select: str) -> str:
    """``select`` behind the steps it needs, each bound once."""
    need, todo = set(), [select]
    while todo:
        text = todo.pop()
        for name in STEPS:
            if name not in need and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need.add(name)
                todo.append(STEPS[name])
    steps = [text for name, text in STEPS.items() if name in need]
    return f"WITH RECURSIVE {', '.join(steps)} {select}" if steps else select
