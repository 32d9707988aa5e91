"""Order sources and sinks: Parquet and CSV in, result tables out."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairtrace.operators.property_graph import demo_base_orders
from pairtrace.sources import manifest

_STRINGS = (
    "order_id", "driver_id", "customer_id", "order_status", "service_name", "pickup_province_name", "pickup_district_name",
    "pickup_address", "last_dropoff_province_name", "last_dropoff_district_name", "last_dropoff_address", "promotion_code", "payment_method",
)
_TIMES = ("order_time_local_tz", "pickup_completed_at_local_tz", "complete_time_local_tz")
_DOUBLES = ("avg_kmh", "gmv", "discount")
ORDER_TYPES = {**dict.fromkeys(_STRINGS, "string"), **dict.fromkeys(_TIMES, "timestamp_ntz"), **dict.fromkeys(_DOUBLES, "double"), "order_date": "date"}
WIDE_TYPES = ORDER_TYPES | {
    **dict.fromkeys(("cancel_by", "cancel_description", "service_type", "sub_vertical_name", "travel_mode", "channel_type", "promotion_campaign_code"), "string"),
    **dict.fromkeys(("is_now_order", "is_schedule_order"), "boolean"),
    **dict.fromkeys(("declared_km", "actual_km", "km_ratio", "commission", "net_income"), "double"),
    **dict.fromkeys(("intrip_time_second", "rate_by_customer", "rate_by_driver"), "int"),
}


def coerce_timestamp(c: Column, kind: T.DataType) -> Column:
    """Timestamps as they are, numbers as epoch seconds, strings parsed; what cannot be read is null."""
    if isinstance(kind, T.NumericType):
        return F.timestamp_seconds(c).cast("timestamp_ntz")
    return c.cast("timestamp_ntz") if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else c.try_cast("timestamp_ntz")


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The contract's columns in their types; absent ones are null, NaN is null, bad values are null."""
    given = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, kind in types.items():
        if name not in given:
            c = F.lit(None).cast(kind)
        elif kind == "timestamp_ntz":
            c = coerce_timestamp(F.col(name), given[name])
        elif kind == "double":
            c = F.col(name).try_cast("double")
            c = F.when(~F.isnan(c), c)
        else:
            c = F.col(name).try_cast(kind)
        out.append(c.alias(name))
    return df.select(*out, *(["window_id"] if "window_id" in given else []))


def derive_order_date(df: DataFrame) -> DataFrame:
    """order_date, or else the day of the order time."""
    return df.withColumn("order_date", F.coalesce("order_date", F.col("order_time_local_tz").cast("date")))


def read_orders(spark: SparkSession, path: str | list[str], window_from: str = "file", types: dict[str, str] | None = None, schema: str | T.StructType | None = None) -> DataFrame:
    """A file, folder or glob of Parquet orders, or a list of them; ``window_from`` is file or date.

    The parts of a list are read and brought to the contract one by one, so they may disagree on
    types. With ``schema``, that of the files, no footer is read before the scan; without it,
    columns of all files are merged, which reads the footer of each.
    """
    if not isinstance(path, str):
        return reduce(DataFrame.unionByName, [read_orders(spark, p, window_from, types, schema) for p in path])
    raw = (spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)).parquet(path)
    if "window_id" not in raw.columns and window_from == "file":
        raw = raw.withColumn("window_id", F.col("_metadata.file_name"))
    out = derive_order_date(conform(raw, types or ORDER_TYPES))
    return out if "window_id" in out.columns else out.withColumn("window_id", F.col("order_date").cast("string"))


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV orders with a header, read as text and brought to the wide contract."""
    return derive_order_date(conform(spark.read.csv(path, header=True), WIDE_TYPES))


def read_known_pairs(spark: SparkSession, path: str | None) -> DataFrame:
    """Labelled pairs (driver_id, customer_id); no path gives an empty table."""
    schema = "driver_id string, customer_id string"
    return spark.read.csv(path, header=True).select("driver_id", "customer_id") if path else spark.createDataFrame([], schema)


def write_outputs(outputs: dict[str, DataFrame], folder: str, keep: int = 2) -> str:
    """Publish the three result tables of one run together and return the run's folder.

    Flagged orders are Parquet by window; pairs and reasons are CSV, structs as JSON. All are
    written under a new run id, then one manifest makes them the current set: whoever reads
    meanwhile, or after a run that was interrupted, finds the set before. Runs older than the
    last ``keep`` are removed.
    """
    spark = outputs["flagged_orders"].sparkSession
    run, schemas = f"run-{uuid.uuid4().hex}", {}
    for name in ("flagged_orders", "pair_summary", "pair_reasons"):
        df, path = outputs[name], f"{folder}/runs/{run}/{name}"
        if name == "flagged_orders":
            df.write.partitionBy("window_id").parquet(path)
        else:
            df = df.select(*[F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(c) for c in df.columns])
            df.write.csv(path, header=True, escape='"')
        schemas[name] = df.schema.jsonValue()
    before = manifest.latest(spark, folder) or {"runs": []}
    runs = [*before["runs"], run][-keep:]
    manifest.publish(spark, folder, {"run": run, "runs": runs, "schemas": schemas})
    for old in before["runs"]:
        if old not in runs:
            manifest.remove(spark, f"{folder}/runs/{old}")
    return f"{folder}/runs/{run}"


#: What report queries read of each table; a missing table is empty and has these columns.
REPORT_TYPES = {
    "flagged_orders": "window_id string, driver_id string, customer_id string, order_id string, order_date date, complete_time_local_tz timestamp_ntz, service_name string, gmv double, "
    "discount double, rule_name string, reason_code string, business_rule_label string, business_rule_story string, supporting_signal string, flag_reason string, risk_tier string, "
    "priority_score double, n_trips bigint, n_ghost bigint, ghost_rate double, min_gap_min double, avg_gmv double, high_confidence boolean, component_id string, component_size bigint, "
    "component_edge_count bigint, component_density double, network_risk_score double, network_support_score double, pair_core_score double, pair_risk_score double, business_impact_score double, "
    "supporting_signal_count bigint, linked_pair_count bigint, domain string",
    "pair_summary": "window_id string, driver_id string, customer_id string, n_trips bigint, ghost_rate double, latest_order_date date, top_service_name string, business_rule_label string, investigation_priority_score double",
    "pair_reasons": "window_id string, driver_id string, customer_id string, reason_code string, supporting_signal string, flag_reason string, latest_order_date date, top_service_name string, "
    "business_rule_label string, investigation_priority_score double, ghost_rate double",
}


def write_demo_base_orders(orders: DataFrame, path: str, max_orders: int | None = None) -> None:
    """The compact order table (order_id, driver_id, customer_id, order_date) as Parquet, overwritten."""
    demo_base_orders(orders, max_orders).write.mode("overwrite").parquet(path)


def read_reports(spark: SparkSession, folder: str, window_id: str | None = None) -> dict[str, DataFrame]:
    """The current set of result tables in the types they were written with, of one window where given.

    Nothing is inferred: ids stay texts whatever they look like, and the files are read once. In
    CSV an empty text is a blank field like a null, so it comes back as null.
    One window of the flagged orders reads that window's files only. A table that is missing is
    empty, with the columns that reports read.
    """
    current = manifest.latest(spark, folder)
    out = {}
    for name, columns in REPORT_TYPES.items():
        if current is None:
            out[name] = spark.createDataFrame([], columns)
            continue
        path, schema = f"{folder}/runs/{current['run']}/{name}", T.StructType.fromJson(current["schemas"][name])
        if name == "flagged_orders":
            df = spark.read.schema(schema).parquet(path)
        else:
            df = spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True, enforceSchema=False)
        out[name] = df.filter(F.col("window_id") == window_id) if window_id is not None else df
    return out
