"""Bounded labelled samples and the held-out rule shared by the trained classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus)).cast("int")


def held_out(id_col: str, modulus: int, held: int) -> Column:
    """True where the remainder is ``held``; a null id is not held out, nor is it ever learned from."""
    return F.coalesce(remainder(id_col, modulus) == held, F.lit(False))


def label_table(labels: DataFrame, label_col: str) -> DataFrame:
    """One row per id: ``(id long, label int)``; null ids or labels go, the largest of repeated labels stays."""
    rows = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    return rows.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))


def lowest_hashes(rows: DataFrame, bound: int, salt: int) -> DataFrame:
    """At most ``bound`` rows, those whose hashed id is least: the same rows however they are partitioned."""
    return rows.orderBy(F.xxhash64(F.lit(salt), "id"), "id").limit(bound)


def join_texts(docs: DataFrame, picked: DataFrame, text_col: str) -> DataFrame:
    """(picked columns, text): the least text of each picked id, however the rows are partitioned; ``picked`` holds at most the sample bound, so it is broadcast."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "id").groupBy(*picked.columns).agg(F.min("text").alias("text"))
