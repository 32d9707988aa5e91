"""Report tables over flagged orders: periods, overviews, clusters, cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.functions.expr import PAIR_KEY, distinct_counts, exact_mean, running_total

UNKNOWN = "Không rõ"
GRAINS = ("day", "week", "month")
#: Trailing windows, in days, that end on the latest day of the data.
TRAILING = (("1D", 1), ("7D", 7))
#: Tiers of high risk; the others are for watching.
HIGH_TIERS = ("IMMEDIATE_REVIEW", "HIGH_RISK", "HIGH")
# Texts of supporting signals for readers.
SIGNAL_TEXTS = {
    "weighted_edge_outlier": "Tần suất lặp lại của cặp cao bất thường",
    "wcc_component_support": "Được củng cố bởi nhóm liên kết WCC",
    "temporal_turnaround": "Khoảng cách giữa các chuyến quá ngắn",
    "bipartite_pair_concentration": "Mức độ phụ thuộc hai chiều giữa tài xế và khách hàng quá cao",
}


def _distinct(c: str | Column, name: str) -> Column:
    return F.countDistinct(c).alias(name)


def _avg(c: str) -> Column:
    return exact_mean(c, 4).alias(f"avg_{c}")


def normalize_flags(flags: DataFrame, signal_texts: dict[str, str] = SIGNAL_TEXTS, reason_texts: dict[str, str] | None = None) -> DataFrame:
    """Flags with the day, week (from Monday) and month of their order, and their texts for readers; rows without a day go.

    A signal or reason that the dictionaries lack stays as it is.
    """
    made = {f"order_{g}": F.date_trunc(g, F.col("order_date")).cast("date") for g in GRAINS}
    for column, texts in (("supporting_signal", signal_texts), ("flag_reason", reason_texts or {})):
        if column in flags.columns:
            found = [F.when(F.col(column) == k, F.lit(v)) for k, v in texts.items()]
            made[f"{column}_vi"] = F.coalesce(*found, F.col(column))
    return flags.filter(F.col("order_date").isNotNull()).withColumns(made)


def filter_reports(flags: DataFrame, start: str | None = None, end: str | None = None, service: str | None = None, risk: str | None = None, rule: str | None = None) -> DataFrame:
    """Flags of the days ``start`` to ``end``, both included, and of one service, tier or rule label where given."""
    tests = [
        (start, F.col("order_date") >= F.lit(start).cast("date")), (end, F.col("order_date") <= F.lit(end).cast("date")),
        (service, F.col("service_name") == service), (risk, F.col("risk_tier") == risk), (rule, F.col("business_rule_label") == rule),
    ]
    for given, test in tests:
        flags = flags.filter(test) if given is not None else flags
    return flags


def filter_pairs(pairs: DataFrame, start: str | None = None, end: str | None = None, service: str | None = None, rule: str | None = None) -> DataFrame:
    """Pairs, or their reasons, whose latest order is of the days ``start`` to ``end``, of one leading service and rule label where given; the tier has no say."""
    tests = [
        (start, F.col("latest_order_date") >= F.lit(start).cast("date")), (end, F.col("latest_order_date") <= F.lit(end).cast("date")),
        (service, F.col("top_service_name") == service), (rule, F.col("business_rule_label") == rule),
    ]
    for given, test in tests:
        pairs = pairs.filter(test) if given is not None else pairs
    return pairs


def period_summary(flags: DataFrame, grain: str) -> DataFrame:
    """Distinct orders (under two names), drivers, customers and pairs of each day, week or month."""
    if grain not in GRAINS:
        raise ValueError(f"grain is one of {GRAINS}")
    counts = {"flagged_orders": ("order_id",), "flagged_drivers": ("driver_id",), "flagged_customers": ("customer_id",), "flagged_pairs": ("driver_id", "customer_id")}
    df = distinct_counts(normalize_flags(flags).withColumn("period_start", F.col(f"order_{grain}")), ["period_start"], counts)
    return df.withColumn("total_orders_in_scope", F.col("flagged_orders")).orderBy("period_start")


def overview_metrics(flags: DataFrame) -> DataFrame:
    """One row: distinct orders (under two names), drivers and customers, and the largest component."""
    counts = distinct_counts(flags, [], {"flagged_orders": ("order_id",), "flagged_drivers": ("driver_id",), "flagged_customers": ("customer_id",)})
    largest = flags.agg(F.coalesce(F.max("component_size"), F.lit(0)).alias("largest_component_size"))
    return counts.crossJoin(largest).withColumn("total_orders_in_scope", F.col("flagged_orders"))  # one row each


def rule_overview(flags: DataFrame) -> DataFrame:
    story = F.coalesce(F.min("business_rule_story"), F.lit("")).alias("business_rule_story")
    df = flags.groupBy("business_rule_label").agg(_distinct("order_id", "flagged_orders"), _distinct("customer_id", "flagged_customers"), _avg("priority_score"), story)
    return df.orderBy(F.desc("flagged_orders"), F.desc("avg_priority_score"), "business_rule_label")


def reason_overview(reasons: DataFrame) -> DataFrame:
    """Pairs that a reason affects, with their mean priority and ghost rate; most pairs first."""
    texts = [F.min("supporting_signal").alias("supporting_signal"), F.coalesce(F.min("flag_reason"), F.lit("")).alias("flag_reason_vi")]
    df = reasons.groupBy("reason_code").agg(F.count("*").alias("affected_pairs"), exact_mean("investigation_priority_score", 4).alias("avg_priority_score"), _avg("ghost_rate"), *texts)
    return df.orderBy(F.desc("affected_pairs"), F.desc("avg_priority_score"), "reason_code")


def component_overview(flags: DataFrame) -> DataFrame:
    """One row a component, numbered by size, highest priority and orders."""
    df = flags.groupBy("window_id", "component_id").agg(
        _distinct("order_id", "flagged_orders"), _distinct("driver_id", "flagged_drivers"), _distinct("customer_id", "flagged_customers"),
        _distinct(F.struct("driver_id", "customer_id"), "flagged_pairs"), F.coalesce(F.mode("service_name", True), F.lit(UNKNOWN)).alias("top_service"),
        F.coalesce(F.mode("business_rule_label", True), F.lit(UNKNOWN)).alias("top_rule"), F.max("priority_score").alias("max_priority_score"),
        _avg("priority_score"), _avg("network_risk_score"), F.max("component_size").alias("component_size"),
        _avg("network_support_score"), F.max("component_edge_count").alias("component_edge_count"), F.max("component_density").alias("component_density"),
        F.coalesce(F.min("business_rule_story"), F.lit("")).alias("top_rule_story"),
    )
    order = [F.desc("component_size"), F.desc("max_priority_score"), F.desc("flagged_orders"), F.asc("component_id")]
    return running_total(df, ["window_id"], order, F.lit(1), "component_rank").withColumn("component_display_id", F.format_string("WCC-%03d", "component_rank"))


def breakdown(flags: DataFrame, dimension: str, top: int = 10) -> DataFrame:
    """Distinct flagged orders of the ``top`` most frequent values of one column."""
    value = F.coalesce(F.col(dimension).cast("string"), F.lit(UNKNOWN)).alias("value")
    return flags.groupBy(value).agg(_distinct("order_id", "flagged_orders")).orderBy(F.desc("flagged_orders"), "value").limit(top)


def rule_cluster_summary(flags: DataFrame, keys: tuple[str, ...] = (*PAIR_KEY, "business_rule_label")) -> DataFrame:
    """Per business rule and pair: its orders, its strongest figures, and the tier of its highest priority; highest priority first."""
    most = {f"max_{c}": F.max(c) for c in ("n_trips", "n_ghost", "ghost_rate", "priority_score", "supporting_signal_count", "linked_pair_count", "component_size")}
    mean = {"avg_gmv": exact_mean("avg_gmv", 6, 6), **{f"avg_{c}": exact_mean(c, 2) for c in ("pair_core_score", "network_support_score")}}
    rest = {"min_gap_min": F.min("min_gap_min"), "high_confidence": F.bool_or("high_confidence"), "top_risk_tier": F.max_by("risk_tier", F.struct("priority_score", "risk_tier"))}
    df = flags.groupBy(*keys).agg(_distinct("order_id", "flagged_orders"), *[c.alias(name) for name, c in (most | mean | rest).items()])
    return df.orderBy(F.desc("max_priority_score"), *keys)


def window_metrics(flags: DataFrame, high_tiers: tuple[str, ...] = HIGH_TIERS) -> DataFrame:
    """Orders, those of a tier of high risk and the others in the trailing windows that end on the latest day."""
    latest = flags.agg(F.max("order_date").alias("end_date"))
    spans = F.explode(F.array(*[F.struct(F.lit(n).alias("label"), F.lit(d).alias("days")) for n, d in TRAILING]))
    spans = latest.select("end_date", spans.alias("w")).select("w.label", F.date_sub("end_date", F.col("w.days") - 1).alias("start_date"), "end_date")
    high = F.col("risk_tier").isin(*high_tiers)
    inside = flags.join(F.broadcast(spans), F.col("order_date").between(F.col("start_date"), F.col("end_date")))
    inside = inside.withColumns({"high_order": F.when(high, F.col("order_id")), "watched_order": F.when(~high, F.col("order_id"))})
    return distinct_counts(inside, ["label", "start_date", "end_date"], {"flagged_orders": ("order_id",), "high_risk_orders": ("high_order",), "watchlist_orders": ("watched_order",)})


def insights(flags: DataFrame, grain: str = "month") -> DataFrame:
    """Four rows (kind, name, value): change of orders against the period before, leading service, rule and component."""
    by_period = period_summary(flags, grain).select("period_start", "flagged_orders")
    ordered = Window.orderBy("period_start")  # one row a period
    change = by_period.withColumn("before", F.lag("flagged_orders").over(ordered)).orderBy(F.desc("period_start")).limit(1)
    rows = change.select(F.lit("change").alias("kind"), F.col("period_start").cast("string").alias("name"), (F.col("flagged_orders") - F.coalesce("before", F.lit(0))).alias("value"))
    for kind, column in (("service", "service_name"), ("rule", "business_rule_label"), ("component", "component_id")):
        rows = rows.unionAll(breakdown(flags, column, 1).select(F.lit(kind), "value", "flagged_orders"))
    return rows


def case_dedup(flags: DataFrame) -> DataFrame:
    """One row an order: highest priority, then latest completion, then full tie-break."""
    rank = F.struct("priority_score", "complete_time_local_tz", "driver_id", "customer_id", "gmv", "reason_code")
    row = F.struct(*PAIR_KEY, "order_date", "complete_time_local_tz", "service_name", "reason_code", "business_rule_label", "risk_tier", "priority_score", "gmv")
    return flags.groupBy("order_id").agg(F.max_by(row, rank).alias("x")).select("order_id", "x.*")


def case_lookup(flags: DataFrame, by: str, value: str | None = None) -> DataFrame:
    """Per order, driver or customer (all, or one): related orders, drivers, customers, rules and tiers."""
    key = {"order": "order_id", "driver": "driver_id", "customer": "customer_id"}[by]
    rows = flags.filter(F.col(key) == value) if value is not None else flags
    rows = rows.withColumn("lookup_value", F.col(key))
    counts = distinct_counts(rows, ["lookup_value"], {"related_orders": ("order_id",), "related_drivers": ("driver_id",), "related_customers": ("customer_id",)})
    listed = lambda c, name: F.array_join(F.array_sort(F.collect_set(c)), " | ").alias(name)
    texts = rows.groupBy(F.col("lookup_value").alias("of")).agg(listed("business_rule_label", "rules"), listed("risk_tier", "tiers"))
    return counts.join(texts, F.col("lookup_value").eqNullSafe(F.col("of"))).drop("of")
