"""Incremental ingest of order files into a log-structured keyed table.

A batch is appended as one segment, sorted by order id; older segments are left alone, so a
batch costs what it holds and not what the table holds. Of an order id the row of the latest
batch counts, which reading decides. Neighbouring segments of one size tier are merged into one
of the next tier, so a row is rewritten once a tier. A manifest names the segments that count.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pairtrace.operators.property_graph import clean_named_orders, named_orders
from pairtrace.sources import manifest

#: Order of the rows of one batch that share an order id; the first stays. All columns that are left follow by name, so equal tables come from equal files.
FIRST = ("order_time_local_tz", "driver_id", "customer_id")
#: So many neighbouring segments of one tier are merged; bytes of the smallest tier, whose multiples by FANOUT bound the others.
FANOUT, TIER_BYTES = 4, 1 << 24
#: Rows of a range of order ids that one task sorts, about 250 MB of wide orders; up to so many ranges a task hands its rows on as it reads them (spark.shuffle.sort.bypassMergeThreshold), beyond it would collect them first and spill.
RANGE_ROWS, MOST_RANGES = 500_000, 200


def tier(size: int) -> int:
    n = 0
    while size > TIER_BYTES * FANOUT**n:
        n += 1
    return n


def _merged_schema(known: T.StructType, given: T.StructType) -> T.StructType:
    kinds = {f.name: f.dataType for f in known.fields}
    odd = [f.name for f in given.fields if kinds.get(f.name, f.dataType) != f.dataType]
    if odd:
        raise ValueError(f"columns change their type: {', '.join(odd)}")
    return T.StructType([*known.fields, *[f for f in given.fields if f.name not in kinds]])


def _parts(spark: SparkSession, schema: T.StructType, segments: list[dict]) -> DataFrame:
    return spark.read.schema(schema).parquet(*[s["path"] for s in segments])


def _rows(spark: SparkSession, schema: T.StructType, segments: list[dict]) -> DataFrame:
    """Rows of the segments with ``batch``; of each order id that of the latest one.

    The last segment's rows all count; the others meet the later order ids alone, by a broadcast
    where these are few, and with no more columns than the reader asks for.
    """
    last = _parts(spark, schema, segments[-1:])
    if len(segments) == 1:  # a segment has an order id once
        return last
    later = _parts(spark, schema, segments[1:]).select(F.col("order_id").alias("__id"), F.col("batch").alias("__batch"))
    older = _parts(spark, schema, segments[:-1])
    return older.join(later, (F.col("order_id") == F.col("__id")) & (F.col("batch") < F.col("__batch")), "left_anti").unionAll(last)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of an ingested table, one an order id."""
    state = manifest.latest(spark, table)
    if state is None:
        raise ValueError(f"nothing was ingested into {table}")
    return _rows(spark, T.StructType.fromJson(state["schema"]), state["segments"]).drop("batch")


def _first_sorted(rows: DataFrame, count: int, order: list[Column | str], made=lambda df: df) -> DataFrame:
    """Of each order id the first of ``count`` rows by ``order``, sorted by order id over all partitions.

    Rows are shuffled once, by ranges of order ids, in which those of an id lie together; columns
    that ``made`` derives of a row are made behind that shuffle. The number of ranges follows the
    rows, so that a task can sort its own in memory.
    """
    ranges = made(rows.repartitionByRange(min(MOST_RANGES, 1 + count // RANGE_ROWS), "order_id"))
    place = F.row_number().over(Window.partitionBy("order_id").orderBy(*order))
    return ranges.withColumn("__place", place).filter("__place = 1").drop("__place")


def _write_segment(rows: DataFrame, table: str, low: int, high: int) -> dict:
    """Write sorted rows under a path of their own."""
    spark, path = rows.sparkSession, f"{table}/segments/{low:012d}-{high:012d}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return {"path": path, "low": low, "high": high, "bytes": manifest.written_bytes(spark, path)}


def _counters(spark: SparkSession, fresh: DataFrame, processed: int, schema: T.StructType, segments: list[dict]) -> DataFrame:
    """(metric, value): new, updated, valid, processed. Only order ids between the batch's least and greatest are read of the table."""
    low, high, valid = fresh.agg(F.min("order_id"), F.max("order_id"), F.count("*")).first()
    updated = 0
    if segments:
        ids = _parts(spark, schema, segments).filter(F.col("order_id").between(low, high)).select("order_id")
        updated = ids.join(fresh.select("order_id"), "order_id", "left_semi").distinct().count()
    rows = [("new", valid - updated), ("updated", updated), ("valid", valid), ("processed", processed)]
    return spark.createDataFrame(rows, "metric string, value long")


def compact(spark: SparkSession, table: str) -> int:
    """Merge the latest FANOUT segments as long as they are of one tier; returns the number of merges."""
    merges = 0
    while True:
        state = manifest.latest(spark, table)
        last = state["segments"][-FANOUT:]
        if len(last) < FANOUT or len({tier(s["bytes"]) for s in last}) > 1:
            return merges
        rows = _parts(spark, T.StructType.fromJson(state["schema"]), last)
        whole = _write_segment(_first_sorted(rows, rows.count(), [F.desc("batch")]), table, last[0]["low"], last[-1]["high"])
        _publish(spark, table, state | {"segments": [*state["segments"][:-FANOUT], whole]}, [s["path"] for s in last])
        merges += 1


def _publish(spark: SparkSession, table: str, state: dict, gone: list[str]) -> None:
    """Publish the state; segments that the state before it had replaced are removed, as no reader starts from them any more."""
    earlier = state.get("replaced", [])
    manifest.publish(spark, table, state | {"replaced": gone})
    for path in earlier:
        manifest.remove(spark, path)


def merge_batch(batch: DataFrame, table: str, number: int, order: list[str], counters: str | None = None) -> None:
    """Append a batch as a segment and publish it; a number that was published before changes nothing.

    ``counters``: folder that gets the new, updated, valid and processed rows of the batch, a
    part a batch, before it is published. A batch without rows writes nothing. The batch is read
    more than once and not copied, so its source has to give it again, as files do.
    """
    spark = batch.sparkSession
    state = manifest.latest(spark, table) or {"batch": -1, "schema": T.StructType([]).jsonValue(), "segments": []}
    if number <= state["batch"]:
        return
    named = named_orders(batch)
    processed = named.count()
    if not processed:
        return
    columns = clean_named_orders(named).columns
    whole = [*order, *sorted(c for c in columns if c not in order and c != "order_id")]
    fresh = _first_sorted(named, processed, whole, clean_named_orders).withColumn("batch", F.lit(number).cast("long"))
    schema = _merged_schema(T.StructType.fromJson(state["schema"]), fresh.schema)
    segment = _write_segment(fresh, table, number, number)
    if counters:
        written = spark.read.schema(fresh.schema).parquet(segment["path"])
        made = _counters(spark, written, processed, schema, state["segments"])
        made.coalesce(1).write.mode("overwrite").parquet(f"{counters}/batch={number}")
    _publish(spark, table, state | {"batch": number, "schema": schema.jsonValue(), "segments": [*state["segments"], segment]}, [])
    compact(spark, table)


def incremental_ingest(spark: SparkSession, source: str, table: str, checkpoint: str, schema, order: tuple[str, ...] = FIRST, counters: str | None = None) -> StreamingQuery:
    """Read every new Parquet file of ``source`` once, append it to ``table``, then stop; ``read_table`` gives the rows.

    The checkpoint numbers the batches, so a batch that is run again is known by its number; a
    table belongs to one checkpoint.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(lambda batch, n: merge_batch(batch, table, n, list(order), counters)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
