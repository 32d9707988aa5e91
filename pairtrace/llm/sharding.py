"""Sharding by sampled splitters: size-weighted key samples, quantile ranges, exact placement.

Records are ordered by (hash of the text, doc_id), so equal texts are neighbours. Quantiles of a
sample, weighted by bytes and by rows alike, cut that order into many ranges; a range that turns
out overfull of either is cut again from a denser sample of it. Byte totals per range then place
every record exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize

#: Ranges: RANGES_PER_SHARD for each shard, and more where they would hold over ROWS_PER_RANGE rows.
SHARDS, RANGES_PER_SHARD, ROWS_PER_RANGE, SAMPLES_PER_RANGE = 16, 8, 4_000_000, 40
#: A group of equal texts of more than this part of a shard's bytes is divided between shards.
HEAVY_PART = 1 / 16


def _quantiles(keys: list[tuple[int, int]], parts: int) -> list[tuple[int, int]]:
    keys = sorted(keys)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _sample(records: DataFrame, wanted: float, total: float, rows: float, salt: int) -> list[tuple[int, int]]:
    """About ``wanted`` keys, half of them drawn in proportion to bytes and half to rows (a chance of 1 at most)."""
    draw = F.pmod(F.xxhash64(F.lit(salt), "key", "tie", "size"), F.lit(1 << 30)) / float(1 << 30)
    chance = F.col("size") * (wanted / 2 / max(total, 1)) + wanted / 2 / max(rows, 1)
    return [(r.key, r.tie) for r in records.filter(draw < chance).select("key", "tie").collect()]


def _with_range(records: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Range number of each record: how many splitters are at or below its key."""
    high = np.array([k for k, _ in splitters], np.int64)
    low = np.array([t for _, t in splitters], np.int64)

    @F.pandas_udf("int")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        left, right = np.searchsorted(high, k, "left"), np.searchsorted(high, k, "right")
        out = right.copy()
        for i in np.flatnonzero(right > left).tolist():
            out[i] = left[i] + np.searchsorted(low[left[i] : right[i]], t[i], "right")
        return pd.Series(out.astype(np.int32))

    return records.withColumn("part", place("key", "tie") if splitters else F.lit(0))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", heavy_part: float = HEAVY_PART, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for every row; shard sizes are near equal.

    Size is the text's UTF-8 bytes (null: none) plus 1. Equal texts stay together in one shard,
    next to each other, unless they fill over ``heavy_part`` of a shard's share: such a group is
    subdivided by id. ``slot`` numbers a shard's rows from 0 without gaps, in that order. A null
    id sorts as the least id and stays null; repeated rows each get a slot; further columns may
    have any name; an empty table gives no rows. Driver-side data are the splitters, a sample of
    40 keys a range and the totals of the ranges, of which there are 128 at least and one for
    each ``rows_per_range`` rows.
    """
    text = F.col(text_col).cast("string")
    records = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("tie"),
    )
    spark = docs.sparkSession
    records = materialize(records, "shard-records")
    total, rows = records.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-rows // rows_per_range))
    splitters = _quantiles(_sample(records, ranges * SAMPLES_PER_RANGE, total, rows, 1), ranges)
    found = _with_range(records, splitters).groupBy("part").agg(F.sum("size").alias("s"), F.count("*").alias("c")).collect()
    overfull = [r for r in found if r.s > 2 * total / ranges or r.c > 2 * rows / ranges]
    if overfull:  # at most ``ranges`` of them
        inside = _with_range(records, splitters).join(F.broadcast(spark.createDataFrame([(r.part,) for r in overfull], "part int")), "part", "left_semi")
        again = _sample(inside, ranges * SAMPLES_PER_RANGE, sum(r.s for r in overfull), sum(r.c for r in overfull), 2)
        splitters = sorted({*splitters, *_quantiles(again, 2 * ranges)})

    # Large groups, of which there are few: of bytes, which are divided between shards, and of rows, which are only divided between ranges.
    groups = records.groupBy("key").agg(F.sum("size").alias("s"), F.count("*").alias("c"))
    by_bytes = F.col("s") > total * heavy_part / shards
    large = {r.key: r.heavy for r in groups.filter(by_bytes | (F.col("c") > rows / ranges)).select("key", by_bytes.alias("heavy")).collect()}
    splitters = sorted({(k, t) if k in large else (k, -(1 << 63)) for k, t in splitters})
    named = F.broadcast(spark.createDataFrame(list(large.items()), "key long, heavy boolean"))
    placed = materialize(_with_range(records, splitters).join(named, "key", "left"), "shard-ranges")
    totals = dict(placed.groupBy("part").agg(F.sum("size")).collect())
    start, base = 0, []
    for p in range(len(splitters) + 1):
        base.append((p, start))
        start += totals.get(p, 0)

    order = Window.partitionBy("part").orderBy("key", "tie", "size", "text_crc32")
    group = Window.partitionBy("part", "key")
    run = placed.join(F.broadcast(spark.createDataFrame(base, "part int, base long")), "part").withColumn("run", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("before", F.col("base") + F.col("run") - F.col("size"))
    run = run.withColumns({"group_start": F.min("before").over(group), "group_size": F.sum("size").over(group)})
    run = materialize(run.select("id", "size", "text_crc32", "key", "tie", "part", "heavy", "before", "group_start", "group_size"), "shard-runs")
    # A group of many rows and few bytes lies in several ranges; its first place and its size are those of all of them.
    wide = run.filter("NOT heavy").groupBy("key").agg(F.min("before").alias("whole_start"), F.sum("size").alias("whole_size"))
    run = run.join(F.broadcast(wide), "key", "left")
    whole = F.coalesce("whole_start", "group_start") + F.coalesce("whole_size", "group_size") / 2
    middle = F.when(F.col("heavy"), F.col("before") + F.col("size") / 2).otherwise(whole)
    sharded = run.withColumn("shard", F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int"))
    sharded = materialize(
        sharded.withColumn("n", F.row_number().over(Window.partitionBy("part", "shard").orderBy("key", "tie", "size", "text_crc32"))).select(
            "id", "size", "text_crc32", "part", "shard", "n"
        ),
        "shard-places",
    )
    counts = {(r.shard, r.part): r.c for r in sharded.groupBy("shard", "part").agg(F.count("*").alias("c")).collect()}
    offsets, running = [], {}
    for shard, part in sorted(counts):
        offsets.append((shard, part, running.get(shard, 0)))
        running[shard] = running.get(shard, 0) + counts[shard, part]
    table = spark.createDataFrame(offsets, "shard int, part int, first long")  # a row for each range and shard it meets
    return sharded.join(F.broadcast(table), ["shard", "part"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("n") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
