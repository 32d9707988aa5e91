"""Reason codes, business rules, flagged orders and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairtrace.config import RuleConfig
from pairtrace.functions.expr import PAIR_KEY, exact_blend, exact_mean, exact_ratio, exact_sum, np_round, numeric_or_default, truth
from pairtrace.operators.scoring import RULE_SCORES

RULE_NAME = "REPEATED_CUSTOMER_DRIVER"
# Reason code, its business rule and supporting signal, in the order of evaluation.
REASONS = (
    ("KB-C_EXTREME_VOLUME", "REPEATED_LOCKED_PAIR", "weighted_edge_outlier"),
    ("KB-C_TIGHT_PAIR_SHARE", "REPEATED_LOCKED_PAIR", "bipartite_pair_concentration"),
    ("KB-C_SUSPICIOUS_COMPONENT", "COORDINATED_NETWORK_PATTERN", "wcc_component_support"),
    ("KB-C_HIGH_GHOST_RATE", "GHOST_TRIP_EXECUTION_PATTERN", "ghost_trip_density"),
    ("KB-C_SUPERFAST_GAP", "GHOST_TRIP_EXECUTION_PATTERN", "temporal_turnaround"),
    ("KB-C_ROUTE_LOOP", "ROUTE_FARMING_PATTERN", "route_loop_reuse"),
)
LABELS = {
    "REPEATED_LOCKED_PAIR": "Cặp lặp lại và phụ thuộc bất thường",
    "GHOST_TRIP_EXECUTION_PATTERN": "Dấu hiệu đơn ảo hoặc quay đầu bất thường",
    "ROUTE_FARMING_PATTERN": "Mẫu farming theo tuyến",
    "COORDINATED_NETWORK_PATTERN": "Cụm liên kết đáng ngờ nhiều cặp",
}
# What a business rule and a reason say to a reader.
STORIES = {
    "REPEATED_LOCKED_PAIR": "Tài xế và khách hàng đi với nhau nhiều lần và có mức độ phụ thuộc bất thường so với hành vi thông thường.",
    "GHOST_TRIP_EXECUTION_PATTERN": "Cặp này có nhiều chuyến mang dấu hiệu đơn ảo, không di chuyển thật hoặc tạo chuyến quá sát nhau về thời gian.",
    "ROUTE_FARMING_PATTERN": "Cặp này lặp lại cùng một kiểu tuyến đường với mật độ đáng ngờ, giống hành vi farming hơn là di chuyển tự nhiên.",
    "COORDINATED_NETWORK_PATTERN": "Cặp này nằm trong một cụm có nhiều cặp đáng ngờ khác cùng chia sẻ tín hiệu như địa điểm, tuyến, khuyến mãi hoặc phương thức thanh toán.",
}
REASON_TEXTS = {
    "KB-C_EXTREME_VOLUME": "Cặp tài xế - khách hàng này lặp lại với tần suất rất cao trong cửa sổ phân tích hiện tại.",
    "KB-C_TIGHT_PAIR_SHARE": "Cặp tài xế - khách hàng này chiếm tỷ trọng bất thường trong tổng hoạt động của cả tài xế và khách hàng.",
    "KB-C_SUSPICIOUS_COMPONENT": "Cặp tài xế - khách hàng này nằm trong một nhóm liên kết đáng nghi và chia sẻ đầu mối với nhiều cặp khác.",
    "KB-C_HIGH_GHOST_RATE": "Tỷ lệ ghost trip của cặp tài xế - khách hàng này cao, với nhiều chuyến có avg_kmh = 0.",
    "KB-C_SUPERFAST_GAP": "Cặp tài xế - khách hàng này tạo các chuyến liên tiếp quá nhanh, không giống vận hành bình thường.",
    "KB-C_ROUTE_LOOP": "Cặp này lặp lại cùng một kiểu tuyến đường với mật độ đáng ngờ, giống hành vi farming hơn là di chuyển tự nhiên.",
}
RULE_VERSION = "kbc_v2_pair_graph_core"


def lookup(values: dict[str, str], c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[c]


def apply_reason_rules(pairs: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """One row for each reason a pair hits, from a single pass over the pairs."""
    col = F.col
    often = col("n_trips") >= cfg.min_pair_trips_for_share_rule
    by_driver = col("pair_share_driver") >= cfg.tight_pair_share_driver
    by_customer = col("pair_share_customer") >= cfg.tight_pair_share_customer
    gap = col("min_gap_min")
    tests = {
        "KB-C_EXTREME_VOLUME": col("is_extreme_volume") & often & (by_driver | by_customer),
        "KB-C_TIGHT_PAIR_SHARE": often & by_driver & by_customer,
        "KB-C_SUSPICIOUS_COMPONENT": (col("component_size") >= cfg.min_component_size) & (col("linked_pair_count") >= cfg.min_network_linked_pairs)
        & (col("supporting_signal_count") >= cfg.min_network_supporting_signals),
        "KB-C_HIGH_GHOST_RATE": (col("ghost_rate") >= cfg.high_ghost_rate) & (col("n_trips") >= cfg.min_high_confidence_trips),
        "KB-C_SUPERFAST_GAP": (gap >= 0) & (gap < cfg.superfast_gap_min) & (col("ghost_rate") >= cfg.superfast_ghost_rate) & (col("n_trips") >= cfg.min_superfast_trips),
        "KB-C_ROUTE_LOOP": often & (col("dominant_route_share") >= cfg.dominant_route_share),
    }
    hits = [
        F.when(truth(tests[code]), F.struct(F.lit(i).alias("ord"), F.lit(code).alias("code"), F.lit(rule).alias("rule"), F.lit(signal).alias("signal")))
        for i, (code, rule, signal) in enumerate(REASONS)
    ]
    rows = pairs.withColumn("__r", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())))
    return rows.withColumns(
        {
            "rule_name": F.lit(RULE_NAME), "reason_order": F.col("__r.ord"), "reason_code": F.col("__r.code"),
            "supporting_signal": F.col("__r.signal"), "business_rule": F.col("__r.rule"), "business_rule_label": lookup(LABELS, F.col("__r.rule")),
            "business_rule_story": lookup(STORIES, F.col("__r.rule")), "flag_reason": lookup(REASON_TEXTS, F.col("__r.code")),
        }
    ).drop("__r")


def with_triggered(reasons: DataFrame) -> DataFrame:
    """Reasons with all rules and codes of their pair, in reason order."""
    lists = reasons.groupBy(PAIR_KEY).agg(F.array_sort(F.collect_list(F.struct("reason_order", "reason_code", "business_rule"))).alias("__l"))
    lists = lists.select(
        *PAIR_KEY, F.array_join(F.array_distinct(F.transform("__l", lambda x: x["business_rule"])), " | ").alias("triggered_business_rules"),
        F.array_join(F.transform("__l", lambda x: x["reason_code"]), " | ").alias("triggered_reason_codes"),
    )
    return reasons.join(lists, PAIR_KEY)


def finalize_rule_assignment(pairs: DataFrame, reasons: DataFrame) -> DataFrame:
    """Triggered rules and codes in reason order, and the primary rule: the triggered one of highest score."""
    score = F.coalesce(*[F.when(F.col("business_rule") == r, F.col(s)) for r, s in RULE_SCORES.items()])
    per_pair = with_triggered(reasons).withColumn("__s", score).groupBy(*PAIR_KEY, "triggered_business_rules", "triggered_reason_codes").agg(
        F.max_by("business_rule", F.struct("__s", -F.col("reason_order"))).alias("__primary"), F.max("__s").alias("__score")
    )
    df = pairs.join(per_pair, PAIR_KEY, "left")
    df = df.withColumns({"business_rule": F.coalesce("__primary", "business_rule"), "business_rule_score": F.coalesce("__score", "business_rule_score")})
    texts = {"business_rule_label": lookup(LABELS, F.col("business_rule")), "business_rule_story": lookup(STORIES, F.col("business_rule"))}
    return df.withColumns(texts).drop("__primary", "__score")


def risk_tier(priority: Column) -> Column:
    urgent = truth((F.col("ghost_rate") >= 0.8) & (F.col("n_trips") >= 10))
    return F.when(urgent | (priority >= 80), "IMMEDIATE_REVIEW").when(priority >= 65, "HIGH_RISK").when(priority >= 50, "MONITOR").otherwise("LOW_PRIORITY")


#: Figures of a pair that a flag shows, with the digits that its evidence keeps; absent ones count as 0.
SCORES = {
    **dict.fromkeys(("ghost_rate", "pair_share_driver", "pair_share_customer", "volume_score", "raw_concentration", "support_factor", "concentration_score"), 4),
    **dict.fromkeys(("pair_core_score", "pair_collusion_score"), 2), "temporal_score": 4, "low_value_farming_score": 4,
    **dict.fromkeys(("suspected_ghost_score", "pair_risk_score", "business_rule_score", "network_support_score", "network_risk_score", "business_impact_score", "fraud_risk_score"), 2),
    "dominant_route_share": 4, "component_density": 4,
}
COUNTS = ("n_trips", "n_ghost", "linked_pair_count", "supporting_signal_count", "component_size", "component_edge_count", *(f"shared_{s}_count" for s in ("payment", "promo", "pickup", "dropoff", "route")))
TEXTS = ("business_rule", "business_rule_label", "triggered_business_rules", "triggered_reason_codes", "dominant_route", "component_id")


def evidence_struct() -> Column:
    """The 38 numbers and names behind a flag, rounded; a pair without a gap has none."""
    figures = {c: np_round(c, n).alias(c) for c, n in SCORES.items()}
    figures |= {c: F.col(c) for c in (*COUNTS[:5], *TEXTS, "driver_id", "customer_id", "high_confidence")}
    figures |= {"min_gap_min": np_round("min_gap_min", 3).alias("min_gap_min"), "suspected_ghost_rate": np_round("ghost_rate", 4).alias("suspected_ghost_rate")}
    figures |= {c: np_round("priority_score", 2).alias(c) for c in ("investigation_priority_score", "priority_score")}
    return F.struct(*figures.values())


def flagged_orders(candidates: DataFrame, reasons: DataFrame, flagged_at: str | None = None) -> DataFrame:
    """Candidate orders times the reasons of their pair, with tier and evidence; ``flagged_at`` is given, never the clock.

    Figures that the reasons lack are 0, names that they lack are null.
    """
    named = lambda c, kind: F.col(c) if c in reasons.columns else F.lit(None).cast(kind)
    given = {c: numeric_or_default(reasons, c, 0.0).alias(c) for c in SCORES}
    given |= {c: numeric_or_default(reasons, c, 0.0).cast("long").alias(c) for c in COUNTS}
    given |= {c: named(c, "string").alias(c) for c in (*TEXTS, "rule_name", "reason_code", "supporting_signal", "business_rule_story", "flag_reason", "volume_cohort", "top_service_name", "top_pickup_province_name", "top_dropoff_province_name")}
    given |= {c: named(c, "double").alias(c) for c in ("min_gap_min", "avg_gmv", "total_gmv", "total_discount", "trip_threshold", "cohort_trip_threshold", "avg_gmv_percentile_by_cohort", "trip_count_percentile", *RULE_SCORES.values())}
    given |= {"high_confidence": F.coalesce(named("high_confidence", "boolean"), F.lit(False)).alias("high_confidence"), "latest_order_date": named("latest_order_date", "date").alias("latest_order_date")}
    given |= {"active_days": named("active_days", "long").alias("active_days")}
    priority = F.coalesce(*[named(c, "double") for c in ("priority_score", "investigation_priority_score", "pair_risk_score")])
    facts = reasons.select(*PAIR_KEY, priority.alias("priority_score"), *given.values())
    facts = facts.withColumns({"risk_tier": risk_tier(F.col("priority_score")), "evidence": evidence_struct()})
    orders = candidates.select(*PAIR_KEY, "order_id", "order_date", "order_time_local_tz", "complete_time_local_tz", "service_name", "payment_method", "gmv", "discount", F.coalesce("promotion_code", F.lit("")).alias("promotion_code"))
    df = orders.join(facts, PAIR_KEY)
    same = {"customer_repeat_ratio": F.col("pair_share_customer"), "pair_ratio": F.col("pair_share_driver"), "pair_orders": F.col("n_trips")}
    fixed = {"domain": F.lit("ride"), "rule_version": F.lit(RULE_VERSION), "merchant_id": F.lit(None).cast("string"), "flagged_at": F.lit(flagged_at).cast("timestamp_ntz")}
    return df.withColumns(same | fixed)


#: Figures of an order that the reports over rules read.
_REPORTED = ("gmv", "discount", "priority_score", "network_support_score", "pair_risk_score", "pair_core_score", "suspected_ghost_score", "business_impact_score")
# Fixed value: what a recommendation says.
RECOMMENDATION = (
    "Prioritize pairs with strong ghost evidence first, then confirm pair concentration and only use the shared-entity network as supporting evidence for coordinated behavior."
)


def _once_per_rule(flags: DataFrame) -> DataFrame:
    """One row an order and rule: the one of highest priority, then of the greatest ids, time and value."""
    best = F.max_by(F.struct("domain", "order_date", "customer_id", *_REPORTED, "high_confidence"), F.struct("priority_score", "driver_id", "customer_id", "order_time_local_tz", "gmv"))
    return flags.groupBy("order_id", "rule_name").agg(best.alias("x")).select("order_id", "rule_name", "x.*")


def _total(c: str) -> Column:
    return F.coalesce(exact_sum(c, 6), F.lit(0.0)).alias(f"total_{c}")


def daily_flag_summary(flags: DataFrame) -> DataFrame:
    """Per day and rule: distinct orders and customers and their value; by day, then most orders first."""
    df = _once_per_rule(flags).groupBy("domain", "order_date", "rule_name").agg(
        F.countDistinct("order_id").alias("flagged_orders"), F.countDistinct("customer_id").alias("flagged_customers"), F.lit(0).alias("model_overlap_orders"), _total("gmv"), _total("discount")
    )
    return df.orderBy("order_date", F.desc("flagged_orders"), "domain", "rule_name")


def rule_comparison(flags: DataFrame) -> DataFrame:
    """Per rule: orders, customers and mean scores over the orders, at six digits."""
    means = {"avg_priority_score": "priority_score", "avg_network_support_score": "network_support_score", "avg_pair_risk_score": "pair_risk_score", "avg_ghost_score": "suspected_ghost_score"}
    return _once_per_rule(flags).groupBy("domain", "rule_name").agg(
        F.countDistinct("order_id").alias("flagged_orders"), F.countDistinct("customer_id").alias("flagged_customers"),
        *[exact_mean(c, 6).alias(name) for name, c in means.items()], F.lit(0).alias("model_overlap_orders"), F.lit(0.0).alias("model_overlap_rate"),
    )


def priority_recommendations(flags: DataFrame) -> DataFrame:
    """Per rule its priority: 35 % pair risk, 15 % network support, 20 % impact, 30 % ghost score, of mean scores; highest first."""
    scores = {c: F.coalesce(c, F.lit(0.0)) for c in _REPORTED if c.endswith("_score")}
    means = {"avg_ghost_score": "suspected_ghost_score", **{f"avg_{c}": c for c in ("pair_core_score", "network_support_score", "pair_risk_score", "business_impact_score")}}
    blend = {"pair_risk_score": 35, "network_support_score": 15, "business_impact_score": 20, "suspected_ghost_score": 30}
    df = _once_per_rule(flags).withColumns(scores).groupBy("domain", "rule_name").agg(
        F.countDistinct("order_id").alias("flagged_orders"), F.sum(F.col("high_confidence").cast("long")).alias("high_confidence_orders"), _total("discount"), _total("gmv"),
        *[exact_mean(c, 6).alias(name) for name, c in means.items()], exact_blend(blend, 100, 2).alias("priority_score"),
    )
    return df.withColumns({"recommendation": F.lit(RECOMMENDATION), "model_overlap_rate": F.lit(0.0)}).orderBy(F.desc("priority_score"), F.desc("flagged_orders"), "domain", "rule_name")


def component_case_summary(pairs: DataFrame) -> DataFrame:
    """Per component: its pairs, those of high risk, and its tier by the mean network risk; highest first."""
    df = pairs.groupBy("window_id", "component_id").agg(
        F.countDistinct("driver_id").alias("driver_count"), F.countDistinct("customer_id").alias("customer_count"), F.count("*").alias("pair_count"),
        F.coalesce(F.sum((F.col("investigation_priority_score") >= 65).cast("long")), F.lit(0).cast("long")).alias("high_risk_pair_count"),
        exact_mean("fraud_risk_score", 2).alias("average_pair_score"), np_round(F.max("fraud_risk_score"), 2).alias("maximum_pair_score"),
        F.sum("supporting_signal_count").alias("rare_shared_entity_count"), F.max("component_edge_count").alias("weighted_internal_edge_sum"),
        np_round(F.max("component_density"), 2).alias("component_density"), exact_mean("network_risk_score", 2).alias("network_risk_score"),
    )
    risk = F.col("network_risk_score")
    tier = F.when(risk >= 80, "IMMEDIATE_REVIEW").when(risk >= 65, "HIGH_RISK").when(risk >= 50, "MONITOR").otherwise("LOW_PRIORITY")
    share = exact_ratio(F.col("high_risk_pair_count"), F.col("pair_count"), 4)
    return df.withColumns({"high_risk_pair_ratio": share, "component_risk_tier": tier}).orderBy("window_id", F.desc("network_risk_score"), F.desc("pair_count"), "component_id")


def pair_evidence(reasons: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Observed value and threshold of each reason; thresholds are those of the configuration."""
    values = {
        "KB-C_EXTREME_VOLUME": ("n_trips", F.col("cohort_trip_threshold")), "KB-C_TIGHT_PAIR_SHARE": ("concentration_score", F.lit(cfg.tight_pair_share_driver)),
        "KB-C_SUSPICIOUS_COMPONENT": ("component_size", F.lit(cfg.min_component_size)), "KB-C_HIGH_GHOST_RATE": ("ghost_rate", F.lit(cfg.high_ghost_rate)),
        "KB-C_SUPERFAST_GAP": ("min_gap_min", F.lit(cfg.superfast_gap_min)), "KB-C_ROUTE_LOOP": ("dominant_route_share", F.lit(cfg.dominant_route_share)),
    }
    pick = lambda i: F.coalesce(*[F.when(F.col("reason_code") == code, (F.col(v[0]) if i == 0 else v[1]).cast("double")) for code, v in values.items()])
    return reasons.select(
        *PAIR_KEY, "reason_code", "supporting_signal", np_round(pick(0), 4).alias("observed_value"), np_round(pick(1), 4).alias("threshold"),
        F.lit("derived").alias("data_quality_level"), F.col("flag_reason").alias("description"),
        np_round(F.coalesce("investigation_priority_score", "pair_risk_score"), 2).alias("score_contribution"),
    ).distinct()


def quality_report(raw: DataFrame, active: DataFrame, pairs: DataFrame, short: DataFrame, flags: DataFrame) -> DataFrame:
    """(metric, value); one-row aggregates, unpivoted."""
    one = lambda df, **aggs: df.agg(*[v.cast("double").alias(k) for k, v in aggs.items()])
    parts = [
        one(raw, raw_orders=F.count("*")), one(active, active_orders=F.count("*")), one(pairs, trip_threshold_q9999=np_round(F.max("trip_threshold"), 4)),
        one(short, candidate_pairs=F.count("*"), high_confidence_pairs=F.sum(F.col("high_confidence").cast("long"))),
        one(flags, flagged_rows=F.count("*"), flagged_pairs=F.countDistinct(F.struct(*PAIR_KEY))),
    ]
    out = None
    for p in parts:
        rows = p.unpivot([], p.columns, "metric", "value")
        out = rows if out is None else out.unionAll(rows)
    return out


def evaluate_known_pairs(flags: DataFrame, known: DataFrame) -> DataFrame:
    hit = flags.select("driver_id", "customer_id", "reason_code").distinct()
    return known.join(hit, ["driver_id", "customer_id"], "left").withColumn("is_flagged", F.col("reason_code").isNotNull())


def known_pair_hit_rate(evaluation: DataFrame) -> DataFrame:
    """(metric, value): share of flagged rows, and of flagged distinct pairs; null without rows."""
    pairs = evaluation.groupBy("driver_id", "customer_id").agg(F.bool_or("is_flagged").alias("is_flagged"))
    rate = lambda df, name: df.agg(np_round(F.avg(F.col("is_flagged").cast("double")), 4).alias("value")).select(F.lit(name).alias("metric"), "value")
    return rate(evaluation, "row_hit_rate").unionAll(rate(pairs, "pair_hit_rate"))
