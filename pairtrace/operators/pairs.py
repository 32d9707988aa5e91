"""Aggregation of orders to driver-customer pairs, and the pair mathematics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.config import PairConfig, ShortlistConfig
from pairtrace.functions.expr import PAIR_KEY, clip, exact_mean, exact_sum, np_round, ratio, running_total, truth
from pairtrace.functions.membership import BROADCAST_KEYS, among, maybe_among, maybe_in, written_filter
from pairtrace.functions.shared import materialize

#: So many pairs of three ids are broadcast, about 100 bytes each.
BROADCAST_PAIRS = BROADCAST_KEYS


def pair_counts(active: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    trips = F.count("*") if cfg.trip_count == "rows" else F.countDistinct("order_id")
    return active.groupBy(PAIR_KEY).agg(trips.alias("n_trips"), F.sum(F.col("is_ghost").cast("long")).alias("n_ghost"))


def entity_totals(pairs: DataFrame, side: str) -> DataFrame:
    """Trips per driver or customer, from the pair counts: far fewer rows than the orders."""
    return pairs.groupBy("window_id", f"{side}_id").agg(F.sum("n_trips").alias(f"{side}_trip_count"))


def _votes(active: DataFrame) -> DataFrame:
    """Orders and ghost trips of each pair, service and province: one pass over the orders, summed map-side."""
    return active.groupBy(*PAIR_KEY, "service_name", "pickup_province_name").agg(F.count("*").alias("votes"), F.sum(F.col("is_ghost").cast("long")).alias("ghosts"))


def _most_frequent() -> list[Column]:
    """Jointly most frequent (service, province) of votes; ties to the smallest, nulls last."""
    place = F.struct(F.col("service_name").alias("top_service_name"), F.col("pickup_province_name").alias("top_pickup_province_name"))
    rank = F.struct(-F.col("votes"), F.isnull("service_name"), "service_name", F.isnull("pickup_province_name"), "pickup_province_name")
    return [F.min_by(place, rank).alias("top")]


def modal_cohort(active: DataFrame) -> DataFrame:
    """Jointly most frequent (service, province) of each pair; ties to the smallest, nulls last."""
    return _votes(active).groupBy(PAIR_KEY).agg(*_most_frequent()).select(*PAIR_KEY, "top.*")


#: Bits of a place's number behind the votes in a rank: up to 2 billion places and 4 billion votes.
PLACE_BITS = 31


def _places(active: DataFrame) -> DataFrame:
    """Each (service, province) with its number in their order, nulls last."""
    order = [F.isnull("service_name"), F.asc("service_name"), F.isnull("pickup_province_name"), F.asc("pickup_province_name")]
    numbered = running_total(active.select("service_name", "pickup_province_name").distinct(), [], order, F.lit(1), "place")
    return materialize(numbered.select(F.col("service_name").alias("top_service_name"), F.col("pickup_province_name").alias("top_pickup_province_name"), "place"), "places")


def pair_base(active: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """n_trips, n_ghost, n_orders (rows) and modal cohort of each pair, all from the votes; ``active`` is read twice.

    Places vote as numbers in their order, so votes and place are one whole number and no
    pairs have to be sorted to find the greatest: grouped texts would be.
    """
    places = _places(active)
    at = F.col("service_name").eqNullSafe(F.col("top_service_name")) & F.col("pickup_province_name").eqNullSafe(F.col("top_pickup_province_name"))
    votes = active.join(places, at).groupBy(*PAIR_KEY, "place").agg(F.count("*").alias("votes"), F.sum(F.col("is_ghost").cast("long")).alias("ghosts"))
    last = F.lit((1 << PLACE_BITS) - 1)
    rank = F.shiftleft("votes", PLACE_BITS) + last - F.col("place")
    df = votes.groupBy(PAIR_KEY).agg(F.sum("votes").alias("n_orders"), F.sum("ghosts").alias("n_ghost"), F.max(rank).alias("top"))
    df = df.withColumn("place", last - F.col("top").bitwiseAND(last)).join(places, "place").drop("place", "top")
    if cfg.trip_count == "rows":
        return df.withColumn("n_trips", F.col("n_orders"))
    return df.join(pair_counts(active, cfg).select(*PAIR_KEY, "n_trips"), PAIR_KEY)


def _extreme(cfg: PairConfig, weight: str | None) -> Column:
    trips = F.percentile("n_trips", F.lit(cfg.extreme_trip_quantile), F.col(weight)) if weight else F.percentile("n_trips", F.lit(cfg.extreme_trip_quantile))
    return F.greatest(F.lit(cfg.min_extreme_trip_threshold), trips)


def trip_threshold(pairs: DataFrame, cfg: PairConfig = PairConfig(), weight: str | None = None) -> DataFrame:
    """``weight``: column that says how many pairs a row stands for."""
    return pairs.groupBy("window_id").agg(_extreme(cfg, weight).alias("trip_threshold"))


def with_cohort(pairs: DataFrame) -> DataFrame:
    part = lambda c: F.trim(F.coalesce(c, F.lit("unknown")))
    return pairs.withColumn("volume_cohort", F.concat_ws("|", part(F.col("top_service_name")), part(F.col("top_pickup_province_name"))))


def cohort_threshold(pairs: DataFrame, cfg: PairConfig = PairConfig(), weight: str | None = None) -> DataFrame:
    return pairs.groupBy("window_id", "volume_cohort").agg(_extreme(cfg, weight).alias("cohort_trip_threshold"))


def distinct_counterparties(pairs: DataFrame, side: str) -> DataFrame:
    """Pairs are unique, so a count of rows is a count of counterparties."""
    return pairs.groupBy("window_id", f"{side}_id").agg(F.greatest(F.count("*"), F.lit(1)).alias(f"{side}_counterparties"))


def volume_table(pairs: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """Per window, cohort and trip count: both thresholds and the share of the cohort's pairs with no more trips."""
    hist = materialize(pairs.groupBy("window_id", "volume_cohort", "n_trips").agg(F.count("*").alias("__pairs")), "trip-histogram")
    cohort = ["window_id", "volume_cohort"]
    hist = running_total(hist, cohort, [F.col("n_trips")], F.col("__pairs"), "__run")
    total = hist.groupBy(cohort).agg(F.max("__run").alias("__all"), _extreme(cfg, "__pairs").alias("cohort_trip_threshold"))
    hist = hist.join(total, cohort).join(trip_threshold(hist, cfg, "__pairs"), "window_id")
    return hist.select(*cohort, "n_trips", "trip_threshold", "cohort_trip_threshold", (F.col("__run") / F.col("__all")).alias("__pct"))


def finalize_pair_stats(pairs: DataFrame, cfg: PairConfig = PairConfig(), base: DataFrame | None = None) -> DataFrame:
    """Cohort percentile, concentration, support factor, volume and concentration scores of unique pairs.

    ``pairs`` have their counterparties and ``volume_cohort``; ``base`` has the same pairs' window,
    cohort and trips where these are at hand in a written table.
    """
    volumes = materialize(volume_table(pairs if base is None else base, cfg), "volumes")  # a row a cohort and trip count
    df = pairs.join(volumes, ["window_id", "volume_cohort", "n_trips"])
    raw = clip(F.least("pair_share_driver", "pair_share_customer"))
    exp = F.least(1.0 / (F.col("driver_counterparties") + 1), 1.0 / (F.col("customer_counterparties") + 1))
    df = df.withColumns({"__raw": raw, "__exp": exp})
    cap = F.greatest(F.lit(2.0), F.least(F.lit(30.0), F.greatest(F.lit(10.0), F.col("trip_threshold") * 1.5)))
    df = df.withColumns({"__gap": clip(F.try_divide(F.col("__raw") - F.col("__exp"), 1 - F.col("__exp"))), "__support": clip(F.log1p("n_trips") / F.log1p(cap))})
    bar = F.greatest(F.coalesce("cohort_trip_threshold", "trip_threshold"), F.lit(1.0))
    df = df.withColumns(
        {
            "trip_count_percentile": np_round("__pct", 4),
            "volume_score": np_round(clip(F.col("n_trips") / bar, 0.0, 3.0) / 3, 4),
            "is_extreme_volume": truth(F.col("n_trips") >= F.col("cohort_trip_threshold")),
            "concentration_score": np_round(clip(F.col("__gap") * F.col("__support")), 4),
            "raw_concentration": np_round("__raw", 4),
            "expected_concentration": np_round("__exp", 4),
            "concentration_gap": np_round("__gap", 4),
            "support_factor": np_round("__support", 4),
        }
    )
    return df.drop("__pct", "__raw", "__exp", "__gap", "__support")


def written_base(active: DataFrame, cfg: PairConfig = PairConfig()) -> DataFrame:
    """``pair_base`` with the cohort of each pair, written."""
    return materialize(with_cohort(pair_base(active, cfg)), "pair-base")


def pair_stats(active: DataFrame | None, cfg: PairConfig = PairConfig(), base: DataFrame | None = None, least_trips: float = 0) -> DataFrame:
    """All pairs, or those of ``least_trips``, with their shares and scores.

    The orders are read once; the pairs, far fewer, are written, and totals, counterparties,
    thresholds and percentiles come from that table, always of all pairs. Entity totals count
    orders, whichever way a pair's trips are counted. ``base`` is ``written_base`` where that is at
    hand. With ``least_trips`` only the totals of drivers and customers of such pairs are shuffled.
    """
    if base is None:
        base = written_base(materialize(active.select(*PAIR_KEY, "order_id", "service_name", "pickup_province_name", "is_ghost"), "active-ids"), cfg)
    df = base.filter(F.col("n_trips") >= least_trips) if least_trips else base
    kept = df
    for side in ("driver", "customer"):
        key = ["window_id", f"{side}_id"]
        rows = maybe_among(base, kept, key) if least_trips else base
        both = rows.groupBy(key).agg(F.sum("n_orders").alias(f"{side}_trip_count"), F.count("*").alias(f"{side}_counterparties"))
        df = df.join(both, key)
    df = df.withColumns(
        {
            "pair_share_driver": ratio(F.col("n_trips"), F.col("driver_trip_count")),
            "pair_share_customer": ratio(F.col("n_trips"), F.col("customer_trip_count")),
            "ghost_rate": ratio(F.col("n_ghost"), F.col("n_trips")),
        }
    )
    return finalize_pair_stats(df.drop("n_orders"), cfg, base)


def score_pairs(pairs: DataFrame) -> DataFrame:
    score = np_round(100 * (0.45 * F.col("volume_score") + 0.55 * F.col("concentration_score")), 2)
    return pairs.withColumns({"pair_core_score": score, "pair_collusion_score": score})


def shortlist(pairs: DataFrame, cfg: ShortlistConfig = ShortlistConfig()) -> DataFrame:
    locked = (F.col("pair_share_driver") >= cfg.min_repeat_share_driver) | (F.col("pair_share_customer") >= cfg.min_repeat_share_customer)
    strong = (F.col("concentration_score") >= cfg.min_concentration_score) | (F.col("pair_core_score") >= cfg.min_pair_core_score)
    hit = (F.col("is_extreme_volume") & locked & strong) | (F.col("ghost_rate") >= cfg.min_ghost_rate)
    return pairs.filter((F.col("n_trips") >= cfg.min_pair_trips) & truth(hit))


def candidate_orders(active: DataFrame, pairs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Active orders of the shortlisted pairs.

    ``ids`` are the same orders' ids in a written table, where that is at hand: the whole orders
    are then cut by order and customer id where these are read, before any join they come from.
    """
    if ids is not None:
        mine = materialize(among(ids, pairs, PAIR_KEY, BROADCAST_PAIRS).select("order_id", "customer_id"), "candidate-ids")
        for c in mine.columns:
            active = active.filter(maybe_in(written_filter(mine, [c]), [c]))
    return among(active, pairs, PAIR_KEY, BROADCAST_PAIRS)


def pair_rollups(candidates: DataFrame) -> DataFrame:
    """Sums of all-null columns are 0; modal values ignore nulls and break ties to the smallest."""
    return candidates.groupBy(PAIR_KEY).agg(
        exact_mean("gmv", 6, 6).alias("avg_gmv"),
        F.coalesce(exact_sum("gmv", 6), F.lit(0.0)).alias("total_gmv"),
        F.coalesce(exact_sum("discount", 6), F.lit(0.0)).alias("total_discount"),
        F.countDistinct("order_date").alias("active_days"),
        F.max("order_date").alias("latest_order_date"),
        F.mode("last_dropoff_province_name", True).alias("top_dropoff_province_name"),
    )


def pair_gaps(candidates: DataFrame) -> DataFrame:
    """Least minutes between consecutive orders of a pair; null for a single order.

    Orders are dealt to ranges of (pair, time), so a pair of many orders is split. A range gives
    its least gap inside and its first and last time of each pair; between ranges the last time
    meets the next first one.
    """
    timed = candidates.filter("order_time_local_tz IS NOT NULL").select(*PAIR_KEY, F.unix_micros(F.col("order_time_local_tz").cast("timestamp")).alias("at"))
    dealt = timed.repartitionByRange(*PAIR_KEY, "at").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "time-ranges")
    inside = Window.partitionBy(*PAIR_KEY, "part").orderBy("at")
    ranges = dealt.withColumn("gap", F.col("at") - F.lag("at").over(inside)).groupBy(*PAIR_KEY, "part").agg(F.min("gap").alias("gap"), F.min("at").alias("first"), F.max("at").alias("last"))
    between = Window.partitionBy(PAIR_KEY).orderBy("part")  # a row for each range that a pair reaches into
    gaps = ranges.select(*PAIR_KEY, F.least("gap", F.col("first") - F.lag("last").over(between)).alias("gap"))
    return gaps.groupBy(PAIR_KEY).agg((F.min("gap") / 60e6).alias("min_gap_min"))


def dominant_route(candidates: DataFrame) -> DataFrame:
    """Most frequent route of each pair, ties to the smallest key."""
    votes = candidates.groupBy(*PAIR_KEY, "route_key").agg(F.count("*").alias("n"))
    best = votes.groupBy(PAIR_KEY).agg(F.min_by(F.struct("route_key", "n"), F.struct(-F.col("n"), "route_key")).alias("x"))
    return best.select(*PAIR_KEY, F.col("x.route_key").alias("dominant_route"), F.col("x.n").alias("dominant_route_trips"))


def enrich_pair_details(candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    df = pairs.join(pair_rollups(candidates), PAIR_KEY, "left").join(pair_gaps(candidates), PAIR_KEY, "left")
    df = df.join(dominant_route(candidates), PAIR_KEY, "left")
    df = df.withColumn("dominant_route_trips", F.coalesce("dominant_route_trips", F.lit(0)))
    return df.withColumn("dominant_route_share", ratio(F.col("dominant_route_trips"), F.col("n_trips")))
