"""A membership filter of fixed size, to drop rows that cannot match before a join shuffles them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize

#: Words of 64 bits: the broadcast side has at most so many rows of 12 bytes, whatever the number of keys.
WORDS = 1 << 17
#: So many keys of a few ids are broadcast, about 100 bytes each.
BROADCAST_KEYS = 100_000


def maybe_among(rows: DataFrame, keys: DataFrame, on: list[str], words: int = WORDS) -> DataFrame:
    """``rows`` less most of those whose ``on`` columns are those of no row of ``keys``; never less one that matches.

    Every key sets one bit of ``64 * words``, so with n keys a row without a match stays with a
    probability of about n / (64 * words). Nulls are like other values. The filter is made by a
    grouped aggregate and its size is bounded by ``words``; an exact join has to follow.
    """
    return _met(rows, keys, on, words, "inner").filter("__maybe").drop("__maybe")


def with_maybe(rows: DataFrame, keys: DataFrame, on: list[str], out: str, words: int = WORDS) -> DataFrame:
    """``rows`` with the boolean ``out``: false only where the ``on`` columns are those of no row of ``keys``."""
    return _met(rows, keys, on, words, "left").withColumn(out, F.coalesce("__maybe", F.lit(False))).drop("__maybe")


def _met(rows: DataFrame, keys: DataFrame, on: list[str], words: int, how: str) -> DataFrame:
    word, bit = _place(on, words)
    bits = keys.select(word.alias("__word"), F.expr("1L").alias("__one"), bit.alias("__bit")).select("__word", F.call_function("shiftleft", "__one", "__bit").alias("__set"))
    bits = bits.groupBy("__word").agg(F.bit_or("__set").alias("__bits"))
    joined = rows.withColumns({"__at": word, "__bit": bit}).join(F.broadcast(bits), F.col("__at") == F.col("__word"), how)
    return joined.withColumn("__maybe", F.getbit("__bits", F.col("__bit")) == 1).drop("__at", "__bit", "__word", "__bits")


def written_filter(keys: DataFrame, on: list[str], words: int = WORDS) -> DataFrame:
    """The filter of ``keys`` as one written row, an array of ``words`` longs (1 MB), whatever the number of keys."""
    word, bit = _place(on, words)
    bits = keys.select(word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).select("word", F.call_function("shiftleft", "one", "bit").alias("bits"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    bits = bits.unionAll(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = bits.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("x"))
    return materialize(row.select(F.transform("x", lambda x: x["bits"]).alias("bits")), "membership")


def maybe_in(written: DataFrame, on: list[str], words: int = WORDS) -> Column:
    """Whether the ``on`` columns may be those of a key of ``written_filter``; false only where they are not.

    A plain predicate, so it is tested where its columns are read, before any join of the rows' own plan.
    """
    word, bit = _place(on, words)
    return F.getbit(F.get(written.scalar(), word), bit) == 1


def _place(on: list[str], words: int) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(*on), F.lit(64 * words))
    return F.shiftright(place, 6).cast("int"), F.pmod(place, F.lit(64)).cast("int")


def among(rows: DataFrame, keys: DataFrame, on: list[str], broadcast: int = BROADCAST_KEYS) -> DataFrame:
    """``rows`` whose ``on`` columns are those of a row of ``keys``, which are read up to three times.

    Few keys are broadcast after they are counted. Beyond that a filter of fixed size drops most
    other rows where they are read, and the rest meets the keys by a shuffle.
    """
    keys = keys.select(on)
    if keys.limit(broadcast + 1).count() <= broadcast:
        return rows.join(F.broadcast(keys), on, "left_semi")
    return maybe_among(rows, keys, on).join(keys.hint("merge"), on, "left_semi")
