"""Cleaning of orders and of the entities that link pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.expr import truth

# Texts that mean "no value", cash payments, and zero coordinates without blanks.
NO_VALUE = ("", "nan", "<na>", "none", "null", "unknown")
CASH = ("cash", "ti_n_mat", "tien_mat")
ZERO_PLACE = ("(0.000000,0.000000)", "(0.0,0.0)", "0,0", "0.0,0.0", "0.000000,0.000000")


def filter_completed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.upper(F.trim("order_status")) == "COMPLETED")


def prepare_active_orders(orders: DataFrame) -> DataFrame:
    """Completed orders with both ids and a time; ids trimmed; is_ghost and route_key added."""
    kept = filter_completed(orders).filter("driver_id IS NOT NULL AND customer_id IS NOT NULL AND order_time_local_tz IS NOT NULL")
    return kept.withColumns(
        {
            "driver_id": F.trim("driver_id"),
            "customer_id": F.trim("customer_id"),
            "discount": F.coalesce("discount", F.lit(0.0)),
            "is_ghost": truth(F.col("avg_kmh") == 0),
            "route_key": F.concat(F.coalesce("pickup_address", F.lit("")), F.lit(" -> "), F.coalesce("last_dropoff_address", F.lit(""))),
        }
    )


def normalize_entity(signal: str, value: Column) -> Column:
    """Trimmed entity value, null where it names nothing shared."""
    bare = F.trim(value)
    low = F.lower(bare)
    bad = low.isin(*NO_VALUE)
    if signal == "payment":
        bad = bad | low.isin(*CASH)
    if signal in ("pickup", "dropoff"):
        bad = bad | F.replace(low, F.lit(" "), F.lit("")).isin(*ZERO_PLACE)
    return F.when(~bad, bare)
