"""Site-relative line frequency: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize

#: A line is dropped if its share of the host's pages exceeds RATIO and it is on LEAST_PAGES pages.
RATIO, LEAST_PAGES = 0.08, 5
#: Boilerplate tables up to so many lines are broadcast (16 bytes a line); larger ones are joined by shuffle.
BROADCAST_LINES = 200_000


def line_keys(lines: Column) -> Column:
    """64-bit keys of lines without outer blanks; blank lines have key null."""
    return F.transform(lines, lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """(host, key, pages, share) of each boilerplate line of ``pages`` (host, id, lines).

    A line counts once a page. Counting is a grouped sum with map-side combining, so neither a
    hot host nor a very common line meets in one task. Per host the result holds at most
    1/ratio times the mean number of lines a page.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    seen = pages.select("host", F.explode(F.array_distinct(line_keys(F.col("lines")))).alias("key")).filter("key is not null")
    counts = seen.groupBy("host", "key").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least)
    return counts.join(totals, counts.host.eqNullSafe(totals.host)).select(
        counts.host, "key", "pages", (F.col("pages") / F.col("total")).alias("share")
    ).filter(F.col("share") > ratio)


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text, and n_lines, n_dropped in place of any columns of these names.

    Lines end at a line feed; a line is compared without outer blanks and blank lines always
    stay. Null hosts form one host. A null text stays null with no lines; an empty text is one
    blank line. Kept lines are joined by line feeds as they were. All other columns and all rows stay, repeated
    ones too, whatever their ids; an empty table gives no rows. A host of fewer than ``least``
    pages loses nothing. A line is sought among at most 1/ratio times the mean number of lines
    of its host's pages.
    """
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    rows = docs.select(F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"), F.struct(*names).alias("row"))
    lines = F.split("text", "\n", -1)
    bad = materialize(boilerplate(rows.select("host", lines.alias("lines")).filter("lines is not null"), ratio, least), "boilerplate-lines")
    per_host = bad.groupBy(F.col("host").alias("of")).agg(F.collect_set("key").alias("bad"))
    same = F.col("host").eqNullSafe(F.col("of"))
    if bad.count() <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(per_host), same, "left")
    else:  # a hot host is dealt to 64 salted keys
        salts = 64
        salted = per_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = rows.withColumn("s", F.pmod(F.xxhash64(F.lit(7), "text"), F.lit(salts)).cast("int")).join(salted, same & (F.col("s") == F.col("salt")), "left")
    drops = lambda x: (F.trim(x) != "") & F.array_contains("bad", F.xxhash64(F.trim(x)))
    kept = F.when(F.col("bad").isNotNull(), F.filter(lines, lambda x: ~drops(x))).otherwise(lines)
    counted = lambda c: F.when(F.col("text").isNull(), 0).otherwise(F.size(c)).cast("long")
    out = joined.select("row", "text", kept.alias("kept"), counted(lines).alias("n_lines")).withColumn("n_dropped", F.col("n_lines") - counted("kept"))
    text = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.array_join("kept", "\n"))
    return out.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names], "n_lines", "n_dropped")


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, pos, line, trim(line, ' ') AS bare FROM (
    SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL))),
totals AS (SELECT source, count(*) AS total FROM documents WHERE text IS NOT NULL GROUP BY source),
bad AS (
  SELECT l.source, bare FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
  WHERE bare <> '' GROUP BY l.source, bare, total
  HAVING count(DISTINCT doc_id) >= {LEAST_PAGES} AND count(DISTINCT doc_id) / total > {RATIO}),
marked AS (
  SELECT l.*, b.bare IS NOT NULL AS gone FROM lines l
  LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.bare = b.bare)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
