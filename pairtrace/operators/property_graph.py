"""Order graph as tables: cleaned wide orders, nodes, edges, upsert, flags on nodes, pattern queries.

Pattern queries answer for every seed row at once; give one seed to ask about one.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairtrace.functions.expr import np_round
from pairtrace.functions.membership import among, maybe_among, maybe_in, with_maybe, written_filter
from pairtrace.functions.shared import materialize

# Edge type, source column, target column.
EDGES = (
    ("PLACED", "customer_id", "order_id"), ("SERVED", "driver_id", "order_id"), ("PICKUP_AT", "order_id", "pickup_key"), ("DROPOFF_AT", "order_id", "dropoff_key"),
    ("PAID_BY", "order_id", "payment_method"), ("USED_PROMO", "order_id", "promotion_code"), ("IN_CAMPAIGN", "promotion_code", "promotion_campaign_code"),
    ("CANCELLED_BY", "order_id", "cancel_by"), ("HAS_CANCEL_REASON", "order_id", "cancel_description"), ("USES_SERVICE", "order_id", "service_name"),
    ("USES_SERVICE_TYPE", "order_id", "service_type"), ("USES_SUB_VERTICAL", "order_id", "sub_vertical_name"), ("USES_TRAVEL_MODE", "order_id", "travel_mode"),
    ("USES_CHANNEL_TYPE", "order_id", "channel_type"),
)
# Node label and the columns that hold its keys.
NODES = {
    "Order": ("order_id",), "Customer": ("customer_id",), "Driver": ("driver_id",), "Address": ("pickup_key", "dropoff_key"), "PaymentMethod": ("payment_method",),
    "PromotionCode": ("promotion_code",), "PromotionCampaign": ("promotion_campaign_code",), "CancelActor": ("cancel_by",), "CancelReason": ("cancel_description",),
    "RideService": ("service_name",), "ServiceType": ("service_type",), "SubVertical": ("sub_vertical_name",), "TravelMode": ("travel_mode",), "ChannelType": ("channel_type",),
}
INFRASTRUCTURE = ("PICKUP_AT", "DROPOFF_AT", "PAID_BY", "USED_PROMO")
PLACE = ("province_name", "district_name", "address")
#: Orders of a block where the pairs at a shared end are listed; pairs a task, and so many tasks at most.
PAIR_BLOCK, PAIRS_A_TASK, MOST_TASKS = 1_000, 2_000_000, 20_000
ADDRESS_KEYS = {"pickup_key": "pickup_", "dropoff_key": "last_dropoff_"}


def _blank_null(orders: DataFrame, columns: set[str]) -> DataFrame:
    return orders.withColumns({f.name: F.nullif(F.trim(f.name), F.lit("")) for f in orders.schema.fields if f.name in columns and isinstance(f.dataType, T.StringType)})


def named_orders(orders: DataFrame) -> DataFrame:
    """Rows with an order id, which is trimmed; the other columns are left as they are."""
    return _blank_null(orders, {"order_id"}).filter(F.col("order_id").isNotNull())


def clean_named_orders(orders: DataFrame) -> DataFrame:
    """``clean_wide_orders`` of rows whose order ids are clean; these columns stay as they are partitioned."""
    df = _blank_null(orders, {*orders.columns} - {"order_id"})
    return df.withColumns({"domain": F.lit("ride"), "is_completed": F.coalesce(F.col("order_status") == "COMPLETED", F.lit(False))})


def clean_wide_orders(orders: DataFrame) -> DataFrame:
    """Trimmed texts, blanks null, rows without an order id dropped; is_completed compares in upper case only."""
    return clean_named_orders(named_orders(orders))


def ingest_quality(orders: DataFrame) -> DataFrame:
    """(metric, value): missing ids and times, and repeated order ids over the whole input."""
    missing = lambda c: F.count_if(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNull())
    ids = F.coalesce(F.trim("order_id"), F.lit(""))
    df = orders.agg(
        missing("order_id").alias("missing_order_id"), missing("customer_id").alias("missing_customer_id"), missing("order_time_local_tz").alias("missing_order_time"),
        (F.count("*") - F.countDistinct(ids)).alias("duplicate_order_id"),
    )
    return df.unpivot([], df.columns, "metric", "value")


@F.pandas_udf(T.StringType())
def _folded(text: pd.Series) -> pd.Series:
    if text.isna().all():
        return text
    return text.map(lambda t: None if t is None else "|".join(" ".join(unicodedata.normalize("NFKC", p).casefold().split()) for p in t.split("\0")))


def _place_text(prefix: str = "") -> Column:
    """Text that names the place in columns that start with ``prefix``; null where the address is blank. Only texts beyond ASCII meet Python."""
    parts = [F.coalesce(F.col(f"{prefix}{c}"), F.lit("")) for c in PLACE]
    whole = F.concat_ws("|", *parts)
    plain = F.octet_length(whole) == F.char_length(whole)
    spaced = whole.rlike(r"[\s\x00]")
    # A separator that is part of a text would shift the parts.
    cut = [F.translate(p, "\0", " ") for p in parts]
    named = F.trim(f"{prefix}address") != ""
    folded = _folded(F.when(named & ~plain, F.concat_ws("\0", *cut)))
    even = F.concat_ws("|", *[F.trim(F.lower(F.regexp_replace(p, r"\s+", " "))) for p in cut])
    return F.when(named, F.when(~plain, folded).when(spaced, even).otherwise(F.lower(whole)))


def _address_key(prefix: str = "") -> Column:
    """Key of a place's text."""
    return F.sha1(_place_text(prefix))


def address_keys(places: DataFrame) -> DataFrame:
    """Distinct (province_name, district_name, address) with address_key; a blank address has none."""
    return places.select(*PLACE).filter(F.trim("address") != "").distinct().withColumn("address_key", _address_key())


def with_address_keys(orders: DataFrame) -> DataFrame:
    """Orders with pickup_key and dropoff_key, made where the order is: there can be as many places as orders."""
    return orders.withColumns({key: _address_key(prefix) for key, prefix in ADDRESS_KEYS.items()})


def graph_nodes(orders: DataFrame) -> DataFrame:
    """Distinct (label, key) of keyed orders, in one pass."""
    found = [F.struct(F.lit(label).alias("label"), F.col(c).cast("string").alias("key")) for label, columns in NODES.items() for c in columns]
    return orders.select(F.explode(F.array(*found)).alias("n")).select("n.*").filter("key IS NOT NULL").distinct()


#: Ids and keys of an order, which are its edges and not its properties.
_NOT_PROPERTIES = {"order_id", "customer_id", "driver_id", "pickup_key", "dropoff_key", *(f"{p}_{c}" for p in ("pickup", "last_dropoff") for c in PLACE)}


def order_nodes(orders: DataFrame) -> DataFrame:
    """One row an order with its properties; of repeated orders each property's last value that is not null counts, as a merge leaves it."""
    properties = [c for c in orders.columns if c not in _NOT_PROPERTIES]
    at = F.struct("order_time_local_tz", "driver_id", "customer_id", "gmv", "discount", "avg_kmh")
    return orders.groupBy("order_id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in properties])


def address_nodes(orders: DataFrame) -> DataFrame:
    """One row an address key: address, district and province as the last order wrote them."""
    ends = [F.struct(F.col(key).alias("address_key"), *[F.col(f"{p}_{c}").alias(c) for c in PLACE]) for p, key in (("pickup", "pickup_key"), ("last_dropoff", "dropoff_key"))]
    rows = orders.select("order_time_local_tz", "order_id", F.posexplode(F.array(*ends)).alias("end", "x")).select("order_time_local_tz", "order_id", "end", "x.*")
    last = F.max_by(F.struct(*PLACE), F.struct("order_time_local_tz", "order_id", "end", *PLACE))
    df = rows.filter(F.col("address_key").isNotNull()).groupBy("address_key").agg(last.alias("x"))
    return df.select("address_key", "x.address", F.col("x.district_name").alias("district"), F.col("x.province_name").alias("province"))


def graph_edges(orders: DataFrame, types: tuple[str, ...] = tuple(t for t, _, _ in EDGES)) -> DataFrame:
    """Distinct (type, src, dst) of orders; an edge without an end is none.

    Edges at an order are made after the rows of an order id met, once an order and not once an
    edge; a row's edges differ, so only a repeated order id has any to drop. Orders without
    address keys meet with the places' texts, which shrink in a shuffle as keys don't, and the
    keys are made of them behind it.
    """
    edges = [e for e in EDGES if e[0] in types]
    at = [e for e in edges if "order_id" in e[1:]]
    columns = sorted({c for e in at for c in e[1:]} - {"order_id"})
    texts = {c: _place_text(p).alias(c) for c, p in ADDRESS_KEYS.items() if c not in orders.columns}
    met = orders.filter(F.col("order_id").isNotNull()).select("order_id", F.struct(*[texts.get(c, F.col(c).cast("string").alias(c)) for c in columns]).alias("row"))
    met = met.groupBy("order_id").agg(F.collect_set("row").alias("rows"))
    key = F.col("order_id").cast("string")
    end = lambda row, c: key if c == "order_id" else F.sha1(row[c]) if c in texts else row[c]
    of = lambda row: F.array(*[F.struct(F.lit(t).alias("type"), end(row, a).alias("src"), end(row, b).alias("dst")) for t, a, b in at])
    every = F.when(F.size("rows") == 1, of(F.col("rows")[0])).otherwise(F.array_distinct(F.flatten(F.transform("rows", of))))
    found = met.select(F.explode(every).alias("e")).select("e.*").filter("src IS NOT NULL AND dst IS NOT NULL")
    for t, a, b in (e for e in edges if e not in at):
        rest = orders.select(F.lit(t).alias("type"), F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst"))
        found = found.unionAll(rest.filter("src IS NOT NULL AND dst IS NOT NULL").distinct())
    return found


def order_edges(orders: DataFrame, seeds: DataFrame, types: tuple[str, ...] = tuple(t for t, a, b in EDGES if "order_id" in (a, b))) -> DataFrame:
    """Distinct (type, src, dst) at the seed orders (order_id) alone: other orders are dropped before any edge is made.

    ``orders`` are wide orders without address keys; ``seeds`` are best a written table. Where the
    orders are a join, a filter of the ids reaches the table that has them, before the join.
    """
    ids = materialize(seeds.select("order_id").distinct(), "seed-ids")
    kept = orders.filter(maybe_in(written_filter(ids, ["order_id"]), ["order_id"]))
    return graph_edges(among(kept, ids, ["order_id"]), types)


def ends_used(orders: DataFrame, used: DataFrame) -> DataFrame:
    """(type, dst, order_id): the orders at those ends of ``used`` (type, dst), which are infrastructure, and some of other ends.

    An order's rows at other ends go before the shuffle, but for a few that the membership filter
    lets pass; an exact join on (type, dst) has to follow.
    """
    ends = {t: b for t, _, b in EDGES if t in INFRASTRUCTURE}
    rows = with_address_keys(orders).filter(F.col("order_id").isNotNull())
    found = F.array(*[F.struct(F.lit(t).alias("type"), F.col(c).cast("string").alias("dst")) for t, c in ends.items()])
    rows = rows.select(F.col("order_id").cast("string").alias("order_id"), F.explode(found).alias("e")).select("e.type", "e.dst", "order_id").filter("dst IS NOT NULL")
    return maybe_among(rows, used, ["type", "dst"]).distinct()


def first_per_order(batch: DataFrame, order: list[Column | str]) -> DataFrame:
    """One row an order id: the first by ``order``."""
    return batch.groupBy("order_id").agg(F.min_by(F.struct(*[c for c in batch.columns if c != "order_id"]), F.struct(*order)).alias("x")).select("order_id", "x.*")


def upsert_orders(existing: DataFrame, batch: DataFrame, order: list[Column | str]) -> tuple[DataFrame, DataFrame]:
    """(merged, counters): rows of the batch replace those of equal order id."""
    valid = batch.filter(F.trim("order_id") != "")
    fresh = first_per_order(valid, order)
    merged = existing.join(fresh.select("order_id"), "order_id", "left_anti").unionByName(fresh, allowMissingColumns=True)
    known = fresh.select("order_id").join(existing.select("order_id", F.lit(1).alias("known")).distinct(), "order_id", "left")
    counts = known.agg(F.count_if(F.col("known").isNull()).alias("new"), F.count("known").alias("updated"), F.count("*").alias("valid"))
    counts = counts.unpivot([], counts.columns, "metric", "value")
    return merged, counts.unionAll(batch.agg(F.count("*").alias("processed")).unpivot([], ["processed"], "metric", "value"))


def demo_base_orders(orders: DataFrame, max_orders: int | None = None) -> DataFrame:
    """order_id, driver_id, customer_id, order_date: one row an order, latest first."""
    ids = ("order_id", "driver_id", "customer_id")
    df = orders.select(*[F.trim(c).alias(c) for c in ids], F.col("order_date").cast("date").alias("order_date"))
    for c in ids:
        df = df.filter(F.col(c) != "")
    df = first_per_order(df, ["order_date", "driver_id", "customer_id"]).orderBy(F.desc("order_date"), "order_id")
    return df.limit(max_orders) if max_orders else df


def demo_scope(orders: DataFrame, flags: DataFrame) -> DataFrame:
    """Distinct orders of any flagged driver or customer, flagged ones included."""
    rows = orders.select("order_id", "driver_id", "customer_id")
    parts = [rows.join(flags.select(c).distinct(), c, "left_semi").select(*rows.columns) for c in rows.columns]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).distinct()


def order_flags(flags: DataFrame, top_n: int | None = None) -> DataFrame:
    """Per order its highest priority and that row's tier; the ``top_n`` highest where given."""
    best = flags.filter(F.trim("order_id") != "").groupBy(F.trim("order_id").alias("order_id")).agg(F.max_by(F.struct("priority_score", "risk_tier"), F.struct("priority_score", "risk_tier")).alias("x"))
    df = best.select("order_id", np_round("x.priority_score", 2).alias("priority_score"), "x.risk_tier")
    return df.orderBy(F.desc("priority_score"), "order_id").limit(top_n) if top_n else df


def flag_orders(orders: DataFrame, marks: DataFrame) -> DataFrame:
    """Orders with is_flagged, priority_score and risk_tier; unflagged ones have false and nulls."""
    df = orders.join(marks.withColumn("is_flagged", F.lit(True)), "order_id", "left")
    return df.withColumn("is_flagged", F.coalesce("is_flagged", F.lit(False)))


def actor_flags(orders: DataFrame, marks: DataFrame, actor: str) -> DataFrame:
    """Per driver or customer: flagged_order_count, zero included, and is_flagged."""
    key = f"{actor}_id"
    df = flag_orders(actor_orders(orders, marks, actor), marks).groupBy(key).agg(F.count_if("is_flagged").alias("flagged_order_count"))
    return df.withColumn("is_flagged", F.col("flagged_order_count") > 0)


def actor_orders(orders: DataFrame, marked: DataFrame, actor: str) -> DataFrame:
    """Distinct (order_id, driver or customer) of the orders in ``marked`` (order_id), and every other actor with a null order id.

    Orders without a mark are combined where they are read.
    """
    key = f"{actor}_id"
    rows = with_maybe(orders.select("order_id", key), marked, ["order_id"], "__marked")
    return rows.select(F.when(F.col("__marked"), F.col("order_id")).alias("order_id"), key).distinct()


def flag_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(order_id, change, priority_score, risk_tier): marks that were added, removed, or changed in score or tier; a removed one has none.

    ``before`` and ``after`` are marks of ``order_flags``, a row an order.
    """
    old = before.select("order_id", F.struct("priority_score", "risk_tier").alias("old"))
    both = old.join(after.select("order_id", F.struct("priority_score", "risk_tier").alias("new")), "order_id", "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.withColumn("change", change).filter("change IS NOT NULL").select("order_id", "change", "new.priority_score", "new.risk_tier")


def apply_flag_changes(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """Order rows of ``flag_orders`` after the changes; only orders that changed are written anew."""
    new = changes.select("order_id", F.struct((F.col("change") != "removed").alias("is_flagged"), "priority_score", "risk_tier").alias("__new"))
    given = {c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in ("is_flagged", "priority_score", "risk_tier")}
    return nodes.join(new, "order_id", "left").withColumns(given).drop("__new")


def refresh_actor_flags(known: DataFrame, orders: DataFrame, changes: DataFrame, actor: str) -> DataFrame:
    """``actor_flags`` brought up to date by the changes: orders that gained or lost their mark are counted, other actors stay as they are.

    ``known`` has every actor of ``orders``, as ``actor_flags`` gives them.
    """
    key = f"{actor}_id"
    moved = changes.filter("change <> 'changed'").select("order_id", F.when(F.col("change") == "added", 1).otherwise(-1).alias("by"))
    gained = orders.select("order_id", key).join(moved, "order_id").distinct().groupBy(key).agg(F.sum("by").alias("__by"))
    df = known.join(gained, key, "left").withColumn("flagged_order_count", F.col("flagged_order_count") + F.coalesce("__by", F.lit(0)))
    return df.withColumn("is_flagged", F.col("flagged_order_count") > 0).drop("__by")


def pair_orders(orders: DataFrame, seeds: DataFrame) -> DataFrame:
    """Orders between the driver and customer of each seed pair."""
    return orders.join(seeds.select("driver_id", "customer_id").distinct(), ["driver_id", "customer_id"], "left_semi").select("driver_id", "customer_id", "order_id").distinct()


def pair_history(orders: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Edges of all orders of each seed pair: (driver_id, customer_id, order_id, type, other), its ends and its infrastructure."""
    at = _order_edges(edges).filter(F.col("type").isin("PLACED", "SERVED", *INFRASTRUCTURE))
    return pair_orders(orders, seeds).join(at, "order_id").select("driver_id", "customer_id", "order_id", "type", "other")


def related_actors(orders: DataFrame, seeds: DataFrame, actor: str) -> DataFrame:
    """For each seed pair, the other drivers of its customer (or other customers of its driver) with their trips."""
    other, via = ("driver_id", "customer_id") if actor == "driver" else ("customer_id", "driver_id")
    met = orders.groupBy(F.col(other).alias("related"), via).agg(F.count("*").alias("trips"))
    df = seeds.select("driver_id", "customer_id").distinct().join(met, via)
    return df.filter(F.col("related") != F.col(other)).select("driver_id", "customer_id", "related", "trips")


def compare_drivers(orders: DataFrame, first: str, second: str) -> DataFrame:
    """Customers of two drivers: shared, only_first or only_second, with the trips to each."""
    rows = orders.filter(F.col("driver_id").isin(first, second)).groupBy("customer_id").agg(
        F.count_if(F.col("driver_id") == first).alias("first_trips"), F.count_if(F.col("driver_id") == second).alias("second_trips")
    )
    side = F.when((F.col("first_trips") > 0) & (F.col("second_trips") > 0), "shared").when(F.col("first_trips") > 0, "only_first").otherwise("only_second")
    return rows.withColumn("side", side)


def customer_sets(orders: DataFrame, first: str, second: str) -> DataFrame:
    """(side, customer_id): the intersection of two drivers' customers, and both differences."""
    one, two = (orders.filter(F.col("driver_id") == d).select("customer_id") for d in (first, second))
    named = lambda side, df: df.select(F.lit(side).alias("side"), "customer_id")
    return named("shared", one.intersect(two)).unionAll(named("only_first", one.subtract(two))).unionAll(named("only_second", two.subtract(one)))


def compared_orders(orders: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each (first, second) of drivers, the orders of both with their side: shared, only_first or only_second customers.

    Set at a time: the customers of all drivers named are met once.
    """
    named = pairs.select("first", "second").distinct()
    met = orders.select("driver_id", "customer_id").distinct()
    seen = [named.join(met.withColumnRenamed("driver_id", c), c).select("first", "second", "customer_id", F.lit(c == "first").alias("f"), F.lit(c == "second").alias("s")) for c in ("first", "second")]
    sides = seen[0].unionAll(seen[1]).groupBy("first", "second", "customer_id").agg(F.bool_or("f").alias("f"), F.bool_or("s").alias("s"))
    side = F.when(F.col("f") & F.col("s"), "shared").when(F.col("f"), "only_first").otherwise("only_second")
    rows = sides.select("first", "second", "customer_id", side.alias("side"), F.explode(F.array_distinct(F.array("first", "second"))).alias("driver_id"))
    return rows.join(orders.select("driver_id", "customer_id", "order_id").distinct(), ["driver_id", "customer_id"]).select("first", "second", "side", "customer_id", "driver_id", "order_id")


def shared_customer_counts(orders: DataFrame, seeds: DataFrame) -> DataFrame:
    """For each seed pair and other driver of its customer: how many further customers both drivers served.

    Customers of the seed drivers are met once for each driver, not for each pair, and counted
    before they meet the pairs; ``shared_customers`` lists the members.
    """
    met = orders.select("driver_id", "customer_id").distinct()
    own = met.join(seeds.select("driver_id").distinct(), "driver_id", "left_semi")
    both = own.join(met.withColumnRenamed("driver_id", "other_driver"), "customer_id").filter(F.col("driver_id") != F.col("other_driver"))
    counts = both.groupBy("driver_id", "other_driver").agg((F.count("*") - 1).alias("shared_customers"))  # less the seed's own customer
    others = related_actors(orders, seeds, "driver").select("driver_id", "customer_id", F.col("related").alias("other_driver"))
    return others.join(counts, ["driver_id", "other_driver"]).filter("shared_customers > 0").select("driver_id", "customer_id", "other_driver", "shared_customers")


def shared_customers(orders: DataFrame, seeds: DataFrame) -> DataFrame:
    """For each seed pair: customers of its driver whom another driver of its customer served too.

    The members of two drivers are sought once, from the one of fewer customers: its list is
    spelled out and met with the other's. ``shared_customer_estimate`` bounds the rows before.
    """
    met = orders.select("driver_id", "customer_id").distinct()
    others = related_actors(orders, seeds, "driver").select("driver_id", "customer_id", F.col("related").alias("other_driver"))
    sought = _smaller_lists(met, others)
    one = sought.join(met.select(F.col("driver_id").alias("few"), F.col("customer_id").alias("shared_customer")), "few")
    both = one.join(met.select(F.col("driver_id").alias("many"), F.col("customer_id").alias("shared_customer")), ["many", "shared_customer"], "left_semi")
    rows = others.join(both.select("driver_id", "other_driver", "shared_customer"), ["driver_id", "other_driver"])
    return rows.filter(F.col("shared_customer") != F.col("customer_id")).select("driver_id", "customer_id", "other_driver", "shared_customer")


def _smaller_lists(met: DataFrame, others: DataFrame) -> DataFrame:
    """(driver_id, other_driver, few, many, customers): the two drivers by their numbers of customers, and the smaller number."""
    degree = met.groupBy("driver_id").agg(F.count("*").alias("n"))
    df = others.select("driver_id", "other_driver").distinct().join(degree, "driver_id").join(degree.select(F.col("driver_id").alias("other_driver"), F.col("n").alias("m")), "other_driver")
    less = F.col("n") <= F.col("m")
    pick = lambda a, b: F.when(less, F.col(a)).otherwise(F.col(b))
    return df.select("driver_id", "other_driver", pick("driver_id", "other_driver").alias("few"), pick("other_driver", "driver_id").alias("many"), F.least("n", "m").alias("customers"))


def shared_customer_estimate(orders: DataFrame, seeds: DataFrame) -> DataFrame:
    """(driver_id, others, most_members): for each seed driver, the drivers to compare and how many members they can share at most."""
    met = orders.select("driver_id", "customer_id").distinct()
    others = related_actors(orders, seeds, "driver").select("driver_id", "customer_id", F.col("related").alias("other_driver"))
    return _smaller_lists(met, others).groupBy("driver_id").agg(F.count("*").alias("others"), F.sum("customers").alias("most_members"))


def _order_edges(edges: DataFrame) -> DataFrame:
    """(order_id, type, other) of the edges at an order."""
    incoming = F.col("type").isin("PLACED", "SERVED")
    at = edges.filter(F.col("type") != "IN_CAMPAIGN")
    return at.select(F.when(incoming, F.col("dst")).otherwise(F.col("src")).alias("order_id"), "type", F.when(incoming, F.col("src")).otherwise(F.col("dst")).alias("other"))


def order_neighborhood(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """All edges of each seed order: (order_id, type, other)."""
    return _order_edges(edges).join(seeds.select("order_id").distinct(), "order_id", "left_semi")


def infrastructure_at(orders: DataFrame, own: DataFrame, count: str, listed: bool = True) -> tuple[DataFrame, DataFrame]:
    """(own ends with other_orders, the (type, dst, order_id) they were counted from); ``count`` of ``own`` has the orders that don't count.

    The second is written where it is to be ``listed``; counts alone are summed where the orders are read.
    """
    at = ends_used(orders, own.select("type", "dst").distinct())
    at = materialize(at, "orders-at-ends") if listed else at
    all_of = at.groupBy("type", "dst").agg(F.count("*").alias("n"))
    return own.join(all_of, ["type", "dst"]).withColumn("other_orders", F.col("n") - F.col(count)).filter("other_orders > 0").drop("n"), at


def shared_infrastructure(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Per type and place, payment or promotion that seed orders use: how many seed and other orders use it."""
    used = edges.filter(F.col("type").isin(*INFRASTRUCTURE))
    marks = seeds.select(F.col("order_id").alias("src")).distinct().withColumn("seed", F.lit(True))
    rows = used.join(marks, "src", "left").groupBy("type", "dst").agg(F.count("seed").alias("seed_orders"), F.count_if(F.col("seed").isNull()).alias("other_orders"))
    return rows.filter("seed_orders > 0 AND other_orders > 0")


def pair_infrastructure(orders: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(driver_id, customer_id, type, dst, own_orders, other_orders): what each seed pair's orders use and other orders use too.

    Membership of the other side is ``infrastructure_orders``; a seed pair's other orders are
    the rows of its ends there, so pairs of orders are never listed.
    """
    used = edges.filter(F.col("type").isin(*INFRASTRUCTURE)).select(F.col("src").alias("order_id"), "type", "dst")
    own = pair_orders(orders, seeds).join(used, "order_id").groupBy("driver_id", "customer_id", "type", "dst").agg(F.count("*").alias("own_orders"))
    all_of = used.groupBy("type", "dst").agg(F.count("*").alias("n"))
    df = own.join(all_of, ["type", "dst"]).withColumn("other_orders", F.col("n") - F.col("own_orders"))
    return df.filter("other_orders > 0").select("driver_id", "customer_id", "type", "dst", "own_orders", "other_orders")


def infrastructure_orders(orders: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(type, dst, order_id): all orders at the ends that some seed pair shares with others."""
    ends = pair_infrastructure(orders, edges, seeds).select("type", "dst").distinct()
    return edges.join(ends, ["type", "dst"], "left_semi").select("type", "dst", F.col("src").alias("order_id"))


def driver_neighbors(orders: DataFrame, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(driver_id, type, neighbor, orders): customers, services and addresses of each seed driver, and by how many of its orders."""
    mine = orders.join(seeds.select("driver_id").distinct(), "driver_id", "left_semi").select("driver_id", "order_id").distinct()
    at = _order_edges(edges).filter(F.col("type").isin("PLACED", "USES_SERVICE", "PICKUP_AT", "DROPOFF_AT"))
    return mine.join(at, "order_id").groupBy("driver_id", "type", F.col("other").alias("neighbor")).agg(F.count("*").alias("orders"))  # edges of an order are distinct


def driver_neighborhood(orders: DataFrame, seeds: DataFrame) -> DataFrame:
    """Per seed driver: distinct orders, customers, services and addresses, from one pass and one table of distinct values."""
    df = among(orders, seeds.select("driver_id").distinct(), ["driver_id"])
    kinds = {"orders": ("order_id",), "customers": ("customer_id",), "services": ("service_name",), "addresses": ("pickup_address", "last_dropoff_address")}
    found = [F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value")) for kind, columns in kinds.items() for c in columns]
    seen = df.select("driver_id", F.explode(F.array(*found)).alias("x")).select("driver_id", "x.*").distinct()
    numbers = seen.groupBy("driver_id", "kind").agg(F.count("value").alias("n"))
    return numbers.groupBy("driver_id").agg(*[F.max(F.when(F.col("kind") == kind, F.col("n"))).alias(kind) for kind in kinds])


def component_subgraph(flags: DataFrame, edges: DataFrame) -> DataFrame:
    """Per component, among all its flagged orders: (component_id, type, dst, orders) that two or more share.

    The counted form of ``component_subgraph_paths``, to know the size before: a shared end is one
    row with its number of orders, which stands for the pairs among them.
    """
    orders = flags.select("component_id", F.col("order_id").alias("src")).distinct()
    shared = edges.filter(F.col("type").isin(*INFRASTRUCTURE)).join(orders, "src")
    return shared.groupBy("component_id", "type", "dst").agg(F.count("*").alias("orders")).filter("orders > 1")


def component_paths(flags: DataFrame, edges: DataFrame) -> DataFrame:
    """Core paths of each component: (component_id, customer_id, order_id, driver_id) of all its flagged orders."""
    orders = flags.select("component_id", "order_id").distinct()
    end = lambda kind, name: edges.filter(F.col("type") == kind).select(F.col("dst").alias("order_id"), F.col("src").alias(name))
    paths = orders.join(end("PLACED", "customer_id"), "order_id").join(end("SERVED", "driver_id"), "order_id")
    return paths.select("component_id", "customer_id", "order_id", "driver_id")


def component_subgraph_paths(flags: DataFrame, edges: DataFrame) -> DataFrame:
    """The subgraph of each component as paths of three nodes: (component_id, type, src, via, dst).

    CORE paths lead from customer over order to driver, for all its flagged orders; paths of a
    type of infrastructure lead from one of these orders over the end to another that shares it,
    the lesser id first. Flags and edges are read several times, so both are best written tables.
    """
    core = component_paths(flags, edges).select("component_id", F.lit("CORE").alias("type"), F.col("customer_id").alias("src"), F.col("order_id").alias("via"), F.col("driver_id").alias("dst"))
    return core.unionAll(_sharing_pairs(flags, edges))


def _sharing_pairs(flags: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs of a component's orders at each end that they share: (component_id, type, src, via, dst).

    They grow with the square of an end's orders, so these are dealt into blocks, and every two
    blocks of an end meet by themselves: a large end is spread over tasks, whose number follows
    the pairs, and a task holds one block. Few rows make many, so neither side is broadcast.
    """
    key = ["component_id", "type", "via"]
    orders = flags.select("component_id", F.col("order_id").alias("src")).distinct()
    at = materialize(edges.filter(F.col("type").isin(*INFRASTRUCTURE)).select("type", "src", F.col("dst").alias("via")).join(orders, "src"), "component-ends")
    sizes = at.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    pairs = sizes.agg(F.sum(F.col("n").cast("decimal(38,0)") * (F.col("n") - 1) / 2)).first()[0] or 0
    tasks = int(min(MOST_TASKS, 1 + pairs // PAIRS_A_TASK))
    dealt = at.join(sizes, key).withColumn("blocks", F.ceil(F.col("n") / PAIR_BLOCK).cast("int")).withColumn("b", F.expr("cast(pmod(xxhash64(src), blocks) as int)"))
    side = lambda name, i, j, among: dealt.select(*key, F.col("src").alias(name), "b", F.explode(among).alias("k")).select(*key, name, F.col(i).alias("i"), F.col(j).alias("j")).repartition(tasks, *key, "i", "j")
    one = side("one", "b", "k", F.sequence("b", F.col("blocks") - 1))
    other = side("other", "k", "b", F.sequence(F.lit(0), F.col("b")))
    met = one.hint("merge").join(other, [*key, "i", "j"]).filter("i < j OR one < other")
    return met.select("component_id", "type", F.least("one", "other").alias("src"), "via", F.greatest("one", "other").alias("dst"))
