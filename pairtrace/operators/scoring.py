"""Risk features, network scores and business-rule scores of shortlisted pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.config import RuleConfig
from pairtrace.functions.expr import clip, cumulative_share, np_round, truth
from pairtrace.functions.shared import materialize

#: Order in which equal rule scores are resolved for a pair without reasons.
RULE_SCORES = {
    "REPEATED_LOCKED_PAIR": "repeated_pair_rule_score",
    "GHOST_TRIP_EXECUTION_PATTERN": "ghost_trip_rule_score",
    "ROUTE_FARMING_PATTERN": "route_farming_rule_score",
    "COORDINATED_NETWORK_PATTERN": "network_pattern_rule_score",
}


def annotate_signals(pairs: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    ghost = (F.col("ghost_rate") >= cfg.high_ghost_rate) & (F.col("n_trips") >= cfg.min_high_confidence_trips)
    gap = F.col("min_gap_min")
    fast = (gap >= 0) & (gap < cfg.superfast_gap_min) & (F.col("ghost_rate") >= cfg.superfast_ghost_rate) & (F.col("n_trips") >= cfg.min_superfast_trips)
    return pairs.withColumn("high_confidence", truth(ghost) | truth(fast))


def pair_risk_features(pairs: DataFrame) -> DataFrame:
    """Ghost, temporal, value and impact scores. Intermediates made here feed each other unrounded."""
    pairs = materialize(pairs, "annotated-pairs")
    df = cumulative_share(pairs, ["window_id", "volume_cohort"], "avg_gmv", "__gmv_pct")
    df = cumulative_share(cumulative_share(df, ["window_id"], "total_discount", "__disc"), ["window_id"], "total_gmv", "__gmv")
    gap = clip((30 - F.coalesce("min_gap_min", F.lit(30.0))) / 30)
    temporal = clip(0.7 * gap + 0.3 * F.col("dominant_route_share"))
    df = df.withColumns({"__gap": gap, "__temporal": temporal})
    df = df.withColumn("__low", clip(F.col("volume_score") * (1 - F.col("__gmv_pct"))))
    df = df.withColumn("__ghost", 100 * (0.5 * F.col("ghost_rate") + 0.3 * F.col("__temporal") + 0.2 * F.col("__low")))
    risk = np_round(0.45 * F.col("pair_collusion_score") + 0.55 * F.col("__ghost"), 2)
    df = df.withColumns(
        {
            "avg_gmv_percentile_by_cohort": np_round("__gmv_pct", 4),
            "gap_score": np_round("__gap", 4),
            "temporal_score": np_round("__temporal", 4),
            "low_value_farming_score": np_round("__low", 4),
            "suspected_ghost_score": np_round("__ghost", 2),
            "pair_risk_score": risk,
            "business_impact_score": np_round(100 * (0.45 * F.col("__disc") + 0.35 * F.col("__gmv") + 0.20 * F.col("volume_score")), 2),
            "fraud_risk_score": risk,
            "investigation_priority_score": risk,
        }
    )
    return df.drop("__gmv_pct", "__disc", "__gmv", "__gap", "__temporal", "__low", "__ghost")


def network_scores(pairs: DataFrame) -> DataFrame:
    """Support and risk of a pair's network; rounded columns feed the later steps."""
    shared = sum((F.coalesce(f"shared_{s}_count", F.lit(0)) for s in ("payment", "promo", "pickup", "dropoff", "route")), F.lit(0))
    linked = clip(F.log1p("linked_pair_count") / F.log1p(F.lit(8.0)))
    cohesion = clip(F.col("component_density") * 4 / F.log1p(F.greatest(F.col("component_size"), F.lit(2))))
    df = pairs.withColumn(
        "network_support_score",
        np_round(100 * (0.35 * linked + 0.30 * clip(F.col("supporting_signal_count") / 4) + 0.20 * clip(F.log1p(shared) / F.log1p(F.lit(12.0))) + 0.15 * cohesion), 2),
    )
    align = F.greatest(F.lit(0.35), F.least(F.lit(1.0), 0.35 + 0.35 * F.col("pair_collusion_score") / 100 + 0.30 * F.col("suspected_ghost_score") / 100))
    df = df.withColumn("network_risk_score", np_round(F.col("network_support_score") * align, 2))
    df = df.withColumn("fraud_risk_score", np_round(0.35 * F.col("pair_collusion_score") + 0.45 * F.col("suspected_ghost_score") + 0.20 * F.col("network_risk_score"), 2))
    return df.withColumn("investigation_priority_score", np_round(0.75 * F.col("fraud_risk_score") + 0.25 * F.col("business_impact_score"), 2))


def business_rule_scores(pairs: DataFrame) -> DataFrame:
    col, ghost_rate = F.col, F.coalesce("ghost_rate", F.lit(0.0))
    collusion = col("pair_collusion_score") / 100
    scores = {
        "repeated_pair_rule_score": 0.60 * collusion + 0.25 * col("concentration_score") + 0.15 * col("volume_score"),
        "ghost_trip_rule_score": 0.65 * col("suspected_ghost_score") / 100 + 0.20 * col("temporal_score") + 0.15 * ghost_rate,
        "route_farming_rule_score": (0.55 * clip(col("dominant_route_share")) + 0.20 * col("temporal_score") + 0.15 * collusion + 0.10 * ghost_rate) * clip(col("n_trips") / 6),
        "network_pattern_rule_score": 0.55 * col("network_risk_score") / 100 + 0.20 * clip(col("supporting_signal_count") / 4)
        + 0.15 * clip(col("linked_pair_count") / 6) + 0.10 * clip(col("component_density")),
    }
    df = pairs.withColumns({k: np_round(100 * v, 2) for k, v in scores.items()})
    top = F.greatest(*RULE_SCORES.values())
    rule = F.coalesce(*[F.when(F.col(score) == top, F.lit(name)) for name, score in RULE_SCORES.items()])
    return df.withColumns({"business_rule": rule, "business_rule_score": top})
