"""A written index of the property graph's edges: by source and by target in buckets, with degrees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairtrace.operators.property_graph import INFRASTRUCTURE, pair_orders

EDGE = "type string, src string, dst string"
#: Edges that lead to an order; the others start from one.
TO_ORDER = ("PLACED", "SERVED")


class AdjacencyIndex:
    """Edges under ``path``, a folder for each end; a lookup reads the buckets of its nodes only.

    Files of a bucket are sorted by node and type, so row groups of other nodes are skipped too.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets

    @classmethod
    def write(cls, edges: DataFrame, path: str, buckets: int = 64) -> AdjacencyIndex:
        """Write distinct ``edges`` (type, src, dst) by both ends, and the degree of every target by type."""
        index = cls(edges.sparkSession, path, buckets)
        for end in ("src", "dst"):
            if end == "dst":  # made once: the second end is dealt from the written first
                edges = index.spark.read.schema(f"{EDGE}, bucket int").parquet(f"{path}/src").drop("bucket")
            # A hub's edges go to several tasks and files of its bucket.
            dealt = edges.withColumn("bucket", index._bucket(F.col(end))).repartitionByRange("bucket", end, "type", "dst" if end == "src" else "src")
            dealt.sortWithinPartitions("bucket", end, "type").write.partitionBy("bucket").parquet(f"{path}/{end}")
        degrees = index.spark.read.schema(f"{EDGE}, bucket int").parquet(f"{path}/dst").groupBy("bucket", "type", "dst").agg(F.count("*").alias("degree"))
        degrees.repartition("bucket").sortWithinPartitions("bucket", "dst").write.partitionBy("bucket").parquet(f"{path}/degrees")
        return index

    def _bucket(self, node: Column) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(self.buckets)).cast("int")

    def _of(self, folder: str, schema: str, end: str, nodes: DataFrame) -> DataFrame:
        """Rows of ``folder`` whose ``end`` is one of ``nodes`` (node)."""
        named = nodes.select(F.col("node").cast("string").alias(end)).filter(F.col(end).isNotNull()).distinct()
        numbers = [r[0] for r in named.select(self._bucket(F.col(end))).distinct().collect()]  # at most ``buckets`` numbers
        rows = self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.path}/{folder}").filter(F.col("bucket").isin(numbers))
        return rows.drop("bucket").join(named, end, "left_semi")

    def leaving(self, nodes: DataFrame) -> DataFrame:
        """Edges from ``nodes`` (node)."""
        return self._of("src", EDGE, "src", nodes).select("type", "src", "dst")

    def reaching(self, nodes: DataFrame) -> DataFrame:
        """Edges to ``nodes`` (node)."""
        return self._of("dst", EDGE, "dst", nodes).select("type", "src", "dst")

    def degrees(self, nodes: DataFrame) -> DataFrame:
        """(type, dst, degree): edges of each type to ``nodes`` (node)."""
        return self._of("degrees", "type string, dst string, degree long", "dst", nodes).select("type", "dst", "degree")

    def at_orders(self, orders: DataFrame) -> DataFrame:
        """All edges of the orders (order_id), as a part of the edge table that the pattern queries take."""
        nodes = orders.select(F.col("order_id").alias("node"))
        return self.leaving(nodes).filter(~F.col("type").isin(*TO_ORDER)).unionAll(self.reaching(nodes).filter(F.col("type").isin(*TO_ORDER)))

    def _used(self, orders: DataFrame) -> DataFrame:
        used = self.at_orders(orders).filter(F.col("type").isin(*INFRASTRUCTURE))
        return used.select(F.col("src").alias("order_id"), "type", "dst")

    def shared_infrastructure(self, seeds: DataFrame) -> DataFrame:
        """Per type and end that seed orders use: how many seed and other orders use it; the others are its degree less the seeds."""
        used = self._used(seeds).groupBy("type", "dst").agg(F.count("*").alias("seed_orders"))
        df = used.join(self.degrees(used.select(F.col("dst").alias("node"))), ["type", "dst"])
        return df.select("type", "dst", "seed_orders", (F.col("degree") - F.col("seed_orders")).alias("other_orders")).filter("other_orders > 0")

    def pair_infrastructure(self, orders: DataFrame, seeds: DataFrame) -> DataFrame:
        """(driver_id, customer_id, type, dst, own_orders, other_orders): what each seed pair's orders use and other orders use too."""
        mine = pair_orders(orders, seeds)
        own = mine.join(self._used(mine), "order_id").groupBy("driver_id", "customer_id", "type", "dst").agg(F.count("*").alias("own_orders"))
        df = own.join(self.degrees(own.select(F.col("dst").alias("node"))), ["type", "dst"])
        return df.select("driver_id", "customer_id", "type", "dst", "own_orders", (F.col("degree") - F.col("own_orders")).alias("other_orders")).filter("other_orders > 0")

    def infrastructure_orders(self, orders: DataFrame, seeds: DataFrame) -> DataFrame:
        """(type, dst, order_id): all orders at the ends that some seed pair shares with others."""
        ends = self.pair_infrastructure(orders, seeds).select("type", "dst").distinct()
        return self.reaching(ends.select(F.col("dst").alias("node"))).join(ends, ["type", "dst"], "left_semi").select("type", "dst", F.col("src").alias("order_id"))


def seed_orders(orders: DataFrame, seeds: DataFrame, *keys: str) -> DataFrame:
    """Orders (order_id) whose ``keys`` are those of a seed."""
    same = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return orders.filter(same).join(seeds.select(*keys).distinct(), list(keys), "left_semi").select("order_id").distinct()
