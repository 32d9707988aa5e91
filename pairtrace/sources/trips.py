"""Orders derived from the star-schema tables, for running every operator at any scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "customer")
_SQL = """
SELECT
  cast(l_orderkey * 10 + l_linenumber AS string) AS order_id,
  CASE WHEN o_custkey % 25 = 0 AND l_linenumber <= 5 THEN 'R' || cast(o_custkey AS string)
       ELSE 'D' || cast(l_suppkey AS string) END AS driver_id,
  'C' || cast(o_custkey AS string) AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN ' completed ' ELSE 'CANCELLED' END AS order_status,
  o_orderdate + @SECS(45 * l_linenumber) AS order_time_local_tz,
  o_orderdate + @SECS(45 * l_linenumber + 60) AS pickup_completed_at_local_tz,
  o_orderdate + @SECS(45 * l_linenumber + 600) AS complete_time_local_tz,
  cast(o_orderdate AS date) AS order_date,
  'svc_' || l_returnflag AS service_name,
  'prov_' || cast(c_nationkey AS string) AS pickup_province_name,
  'dist_' || cast(o_custkey % 7 AS string) AS pickup_district_name,
  'A' || cast(CASE WHEN o_custkey % 25 = 0 THEN cast(floor(o_custkey / 25) AS bigint) % 8 ELSE o_custkey END AS string) AS pickup_address,
  'prov_' || cast(l_suppkey % 25 AS string) AS last_dropoff_province_name,
  'dist_' || cast(l_partkey % 7 AS string) AS last_dropoff_district_name,
  'B' || cast(CASE WHEN o_custkey % 25 = 0 AND l_partkey % 4 <> 0 THEN cast(floor(o_custkey / 25) AS bigint) % 8 ELSE l_partkey END AS string) AS last_dropoff_address,
  CASE WHEN l_quantity <= 10 THEN cast(0.0 AS double) ELSE cast(l_quantity AS double) END AS avg_kmh,
  l_extendedprice AS gmv,
  l_extendedprice * l_discount AS discount,
  CASE WHEN l_discount = 0 THEN NULL
       ELSE 'P' || cast(CASE WHEN o_custkey % 75 = 0 THEN cast(floor(o_custkey / 75) AS bigint) % 6 ELSE l_partkey % 300 END AS string) END AS promotion_code,
  CASE WHEN l_discount = 0 THEN NULL ELSE 'K' || cast(l_partkey % 10 AS string) END AS promotion_campaign_code,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Cash'
       ELSE 'PM' || cast(cast(floor(o_custkey / 25) AS bigint) % 8 AS string) END AS payment_method,
  CASE WHEN o_orderstatus = 'P' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'driver' ELSE 'customer' END END AS cancel_by,
  CASE WHEN o_orderstatus = 'P' THEN 'reason_' || o_orderpriority END AS cancel_description,
  l_linestatus AS service_type,
  c_mktsegment AS sub_vertical_name,
  l_returnflag AS travel_mode,
  'ch_' || cast(l_linenumber % 3 AS string) AS channel_type,
  'all' AS window_id
FROM @lineitem JOIN @orders ON l_orderkey = o_orderkey JOIN @customer ON o_custkey = c_custkey
"""
TRIPS_SQL = _SQL.replace("@SECS(", "to_seconds(").replace("@", "")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived orders; only the columns a query needs reach the scans."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    text = _SQL.replace("@SECS(", "make_dt_interval(0, 0, 0, ")
    # Customers meet the orders, of which there are fewer, and the lines come last.
    text = text.replace("@lineitem JOIN @orders ON l_orderkey = o_orderkey JOIN @customer ON o_custkey = c_custkey", "@lineitem JOIN (SELECT * FROM @orders JOIN @customer ON o_custkey = c_custkey) ON l_orderkey = o_orderkey")
    for t in tables:
        text = text.replace(f"@{t}", "{" + t + "}")
    return spark.sql(text, **tables)
