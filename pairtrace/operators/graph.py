"""Shared-entity graph over shortlisted pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.config import GraphConfig
from pairtrace.functions.expr import exact_mean, exact_sum, np_round, pair_key, running_total
from pairtrace.operators.clean import normalize_entity
from pairtrace.operators.components import connected_components
from pairtrace.operators.scoring import network_scores

SIGNALS = ("payment", "promo", "pickup", "dropoff", "route")
_COLUMN = {"payment": "payment_method", "promo": "promotion_code", "pickup": "pickup_address", "dropoff": "last_dropoff_address", "route": "route_key"}
_BASE = {"payment": 1.0, "promo": 0.85, "pickup": 0.8, "dropoff": 0.8, "route": 0.7}


def _caps(cfg: GraphConfig) -> dict[str, int]:
    place = cfg.address_max_degree
    return {"payment": cfg.payment_max_degree, "promo": cfg.promo_max_degree, "pickup": place, "dropoff": place, "route": cfg.route_max_degree}


def _per_signal(values: dict) -> F.Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("signal")]


def pair_entities(candidates: DataFrame) -> DataFrame:
    """(window, signal, entity, pair) with first and last day of use; one pass over the orders."""
    day = F.col("order_date") if "order_date" in candidates.columns else F.lit(None).cast("date")
    given = [F.struct(F.lit(s).alias("signal"), normalize_entity(s, F.col(_COLUMN[s])).alias("entity")) for s in SIGNALS if _COLUMN[s] in candidates.columns]
    rows = candidates.select("window_id", pair_key().alias("pair_key"), day.alias("day"), F.explode(F.array(*given)).alias("e"))
    rows = rows.select("window_id", "pair_key", "day", "e.signal", "e.entity").filter("entity IS NOT NULL")
    return rows.groupBy("window_id", "signal", "entity", "pair_key").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def entity_degree(entities: DataFrame, cfg: GraphConfig = GraphConfig()) -> DataFrame:
    df = entities.groupBy("window_id", "signal", "entity").agg(F.count("*").alias("degree"))
    rarity = _per_signal(_BASE) / F.greatest(F.log(F.col("degree") + F.lit(1.0)), F.lit(1.0))
    return df.withColumns({"eligible": (F.col("degree") >= 2) & (F.col("degree") <= _per_signal(_caps(cfg))), "rarity": rarity})


def signal_edges(entities: DataFrame, degrees: DataFrame, cfg: GraphConfig = GraphConfig()) -> DataFrame:
    """Pairs that share an eligible entity in time; the degree cap bounds an entity's rows before the self-join."""
    key = ["window_id", "signal", "entity"]
    kept = entities.join(degrees.filter("eligible").select(*key, "rarity"), key)
    right = kept.select(*key, F.col("pair_key").alias("right"), F.col("first_day").alias("rf"), F.col("last_day").alias("rl"))
    both = kept.withColumnRenamed("pair_key", "left").join(right, key).filter(F.col("left") < F.col("right"))
    apart = F.when(F.col("last_day") < F.col("rf"), F.datediff("rf", "last_day")).when(F.col("rl") < F.col("first_day"), F.datediff("first_day", "rl")).otherwise(0)
    both = both.withColumn("gap_days", apart).filter(F.col("gap_days") <= cfg.max_entity_gap_days)
    weight = F.col("rarity") * F.greatest(F.lit(0.25), 1 - F.col("gap_days") / (cfg.max_entity_gap_days + 1))
    return both.select(*key, "left", "right", "gap_days", weight.alias("weight"))


def pair_edges(edges: DataFrame, cfg: GraphConfig = GraphConfig()) -> DataFrame:
    df = edges.groupBy("window_id", "left", "right").agg(
        exact_sum("weight").alias("weight"), F.array_sort(F.collect_set("signal")).alias("signal_types"),
        F.count("*").alias("shared_entity_count"), F.max("gap_days").alias("max_gap_days"),
    )
    several = (F.size("signal_types") >= cfg.min_shared_signals) & (F.col("weight") >= cfg.min_edge_weight)
    single = (F.col("shared_entity_count") >= cfg.single_signal_min_shared_entities) & (F.col("weight") >= cfg.single_signal_min_weight)
    return df.filter(several | single).withColumn("weight", np_round("weight", 4))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select("window_id", F.explode(F.array("left", "right")).alias("pair_key"), "signal_types")


def supporting_signals(edges: DataFrame) -> DataFrame:
    rows = _ends(edges).select("window_id", "pair_key", F.explode("signal_types").alias("s"))
    return rows.groupBy("window_id", "pair_key").agg(F.countDistinct("s").alias("supporting_signal_count"))


def linked_pair_count(edges: DataFrame) -> DataFrame:
    return _ends(edges).groupBy("window_id", "pair_key").agg(F.count("*").alias("linked_pair_count"))


def components(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """(window, pair, label) over all shortlisted pairs; the label is the least linked pair, isolated ones label themselves."""
    node = lambda c: F.concat_ws("\u0001", "window_id", c)
    found = connected_components(edges.select(node("left").alias("l"), node("right").alias("r")), "l", "r")
    all_pairs = pairs.select("window_id", pair_key().alias("pair_key")).withColumn("id", node("pair_key"))
    label = F.coalesce(F.element_at(F.split("component", "\u0001"), 2), F.col("pair_key"))
    return all_pairs.join(found, "id", "left").select("window_id", "pair_key", label.alias("label"))


def component_stats(members: DataFrame, edges: DataFrame) -> DataFrame:
    size = members.groupBy("window_id", "label").agg(F.count("*").alias("component_size"))
    inside = edges.join(members.withColumnRenamed("pair_key", "left"), ["window_id", "left"]).groupBy("window_id", "label").agg(F.count("*").alias("component_edge_count"))
    df = size.join(inside, ["window_id", "label"], "left").withColumn("component_edge_count", F.coalesce("component_edge_count", F.lit(0)))
    n = F.col("component_size")
    density = F.when(n > 1, 2.0 * F.col("component_edge_count") / (n * (n - 1))).otherwise(0.0)
    return df.withColumn("component_density", np_round(density, 4))


def component_ids(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """window-prefixed ids, numbered by each component's first member in shortlist order."""
    ranked = pairs.select("window_id", pair_key().alias("pair_key"), "pair_core_score", "n_trips")
    ranked = running_total(ranked, ["window_id"], [F.desc("pair_core_score"), F.desc("n_trips"), F.asc("pair_key")], F.lit(1), "__r")
    first = members.join(ranked, ["window_id", "pair_key"]).groupBy("window_id", "label").agg(F.min("__r").alias("__r"))
    first = running_total(first, ["window_id"], [F.col("__r")], F.lit(1), "__n")
    return first.select("window_id", "label", F.format_string("%s_ride_component_%d", F.col("window_id"), F.col("__n")).alias("component_id"))


def shared_entity_counts(entities: DataFrame, degrees: DataFrame) -> DataFrame:
    key = ["window_id", "signal", "entity"]
    rows = entities.join(degrees.filter("eligible").select(key), key)
    df = rows.groupBy("window_id", "pair_key").pivot("signal", list(SIGNALS)).count()
    return df.select("window_id", "pair_key", *[F.coalesce(s, F.lit(0)).alias(f"shared_{s}_count") for s in SIGNALS])


def enrich_graph_features(pairs: DataFrame, entities: DataFrame, degrees: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    key = ["window_id", "pair_key"]
    df = pairs.withColumn("pair_key", pair_key()).join(members, key, "left")
    for part in (linked_pair_count(edges), supporting_signals(edges), shared_entity_counts(entities, degrees)):
        df = df.join(part, key, "left")
    df = df.join(component_stats(members, edges), ["window_id", "label"], "left").join(component_ids(members, pairs), ["window_id", "label"], "left")
    return network_scores(df.fillna(0, ["linked_pair_count", "supporting_signal_count", *[f"shared_{s}_count" for s in SIGNALS]])).drop("label")


def graph_quality(pairs: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    """One (metric, value) table for each window."""
    sizes = members.groupBy("window_id", "label").agg(F.count("*").alias("n")).groupBy("window_id").agg(
        F.count("*").cast("double").alias("component_count"), F.max("n").cast("double").alias("largest_component_size"), F.sum("n").cast("double").alias("graph_nodes")
    )
    links = members.join(linked_pair_count(edges), ["window_id", "pair_key"], "left").fillna(0, ["linked_pair_count"]).groupBy("window_id").agg(
        F.sum((F.col("linked_pair_count") == 0).cast("double")).alias("isolated_pairs"), (F.sum("linked_pair_count") / 2).alias("graph_edges"),
        exact_mean("linked_pair_count", 4).alias("avg_linked_pair_count"), np_round(F.percentile("linked_pair_count", F.lit(0.9)), 4).alias("p90_linked_pair_count"),
    )
    df = sizes.join(links, "window_id").withColumns({"candidate_pairs": F.col("graph_nodes"), "largest_component_share": np_round(F.col("largest_component_size") / F.col("graph_nodes"), 4)})
    return df.unpivot(["window_id"], [c for c in df.columns if c != "window_id"], "metric", "value")


def graph_signal_summary(degrees: DataFrame, edges: DataFrame) -> DataFrame:
    df = degrees.groupBy("window_id", "signal").agg(
        F.count("*").alias("entities"), F.sum(F.col("eligible").cast("long")).alias("eligible_entities"), F.sum((~F.col("eligible")).cast("long")).alias("filtered_entities"),
        exact_mean("degree", 4).alias("avg_degree"), F.max("degree").alias("max_degree"), exact_mean("rarity", 4).alias("avg_rarity"),
    )
    kept = edges.select("window_id", F.explode("signal_types").alias("signal")).groupBy("window_id", "signal").agg(F.count("*").alias("retained_edges"))
    return df.join(kept, ["window_id", "signal"], "left").fillna(0, ["retained_edges"])


def entity_degree_report(degrees: DataFrame) -> DataFrame:
    return degrees.withColumn("rarity", np_round("rarity", 4)).orderBy(F.desc("eligible"), F.desc("degree"), "signal", "entity")
