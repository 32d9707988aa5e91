"""Spelling variants: words one edit apart, found by dense tiles of code-point matrices.

Words of one edit share what stands before and behind the edit. The shorter word is cut into
parts; each part names a group of the words that agree outside of it (in the prefix before and
the suffix behind). Members of a group are rows of a padded matrix of code points, which is
compared with itself in tiles: two words are one edit apart if their common prefix and suffix
together reach the longer length less one. A pair counts in the first group that it satisfies,
so nothing has to be told apart afterwards, and only totals and the best partner of each word
leave a task. Groups larger than a tile are dealt to pairs of parts.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize
from pairtrace.llm.crc import CRC_TABLE, crc32
from pairtrace.llm.rows import tables

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, DOMINANCE = 5, 3, 2
#: A word is cut into so many parts: groups agree in all but one of them.
PARTS = 3
#: Members of a group in one tile, rows of a matrix, and pairs compared at once.
TILE, MATRIX, PAIRS = 1_000, 50_000, 1 << 19
#: Tables of large groups up to so many rows are broadcast.
BROADCAST_ROWS = 100_000


def _lowered(word: Column) -> Column:
    """A-Z lower-cased."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int | None = None, length: int = LEAST_LENGTH, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words of ``length`` letters or more that occur ``least`` times or more; counted map-side first.

    With ``slips``, a word loses a letter where the crc32 of ``<id>:<word>`` is a multiple of it:
    the letter at that number modulo the word's length.
    """
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("word")).select("id", _lowered(F.col("word")).alias("word"))
    if slips:
        h = F.crc32(F.concat_ws(":", "id", "word").cast("binary"))
        rows = rows.select("word", h.alias("h"))
        at = F.pmod("h", F.char_length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.char_length("word")))
        rows = rows.select(F.when(F.pmod("h", F.lit(slips)) == 0, cut).otherwise(F.col("word")).alias("word"))
        rows = rows.filter(F.char_length("word") >= length)
    return rows.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def bounds(length: int, parts: int = PARTS) -> list[int]:
    return [length * j // parts for j in range(parts + 1)]


def _groups(words: DataFrame, tile: int) -> DataFrame:
    """(wide, part, key, lo, hi, longer, own, word, n): a row for each group and tile of a word (latin-1 bytes).

    ``wide`` is the length of the group's shorter words; ``longer`` marks words of one letter more.
    """
    size = F.char_length("word")

    def spots(wide: Column, longer: bool) -> list[Column]:
        made = []
        for j in range(PARTS):
            before, behind = F.floor(wide * j / PARTS).cast("int"), (wide - F.floor(wide * (j + 1) / PARTS)).cast("int")
            key = F.xxhash64(F.substring(F.col("word"), F.lit(1), before), F.right("word", behind))
            made.append(F.struct(wide.alias("wide"), F.lit(j).alias("part"), key.alias("key"), F.lit(longer).alias("longer")))
        return made

    rows = words.select("word", "n", F.explode(F.array(*spots(size, False), *spots(size - 1, True))).alias("x"))
    rows = rows.select("x.*", F.encode("word", "ISO-8859-1").alias("word"), "n")
    large = materialize(rows.groupBy("wide", "part", "key").agg(F.count("*").alias("members")).filter(F.col("members") > tile), "large-groups")
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    rows = rows.join(large, ["wide", "part", "key"], "left").withColumn("cuts", F.ceil(F.coalesce("members", F.lit(1)) / tile).cast("int"))
    own = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda o: F.struct(F.least(o, own).alias("lo"), F.greatest(o, own).alias("hi")))
    return rows.select("wide", "part", "key", "longer", own.alias("own"), "word", "n", F.explode(meets).alias("m")).select("wide", "part", "key", "m.lo", "m.hi", "longer", "own", "word", "n")


def near_pairs(matrix: np.ndarray, wide: int, left: np.ndarray, right: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the pairs one edit apart, the first part that each pair satisfies).

    Rows of ``matrix`` are words of ``wide`` or, where ``longer``, one more code points.
    """
    one, two = matrix[left, :wide], matrix[right]
    stop = np.zeros((left.size, 1), bool)
    prefix = np.argmin(np.hstack([one == two[:, :wide], stop]), axis=1)
    ends = np.where(longer[right][:, None], two[:, 1:], two[:, :wide])
    suffix = np.argmin(np.hstack([(one == ends)[:, ::-1], stop]), axis=1)
    near = prefix + suffix >= wide - 1 + longer[right]
    cuts = bounds(wide)
    first = np.full(left.size, PARTS)
    for j in reversed(range(PARTS)):
        first[(prefix >= cuts[j]) & (suffix >= wide - cuts[j + 1])] = j
    return near, first


def _tile_totals(table: pa.Table):
    """(word, near, best n, best word) of the words of one table of whole groups, for its own pairs."""
    wide = table.column("wide").to_numpy()
    part, own = table.column("part").to_numpy(), table.column("own").to_numpy()
    longer = table.column("longer").to_numpy()
    n = table.column("n").to_numpy()
    mixed = (table.column("lo").to_numpy() != table.column("hi").to_numpy())
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for name in ("wide", "part", "key", "lo", "hi"):
        c = table.column(name).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(change)
    end = np.r_[starts[1:], table.num_rows][np.cumsum(change) - 1]
    words = np.array(table.column("word").to_pylist(), f"S{int(wide.max()) + 1}")
    matrix = words.view(np.uint8).reshape(table.num_rows, -1)
    order = np.lexsort((words, -n))
    rank = np.empty(order.size, np.int64)
    rank[order] = np.arange(order.size)
    near, best = np.zeros(order.size, np.int64), np.full(order.size, order.size, np.int64)
    for w in np.unique(wide).tolist():
        rows = np.flatnonzero((wide == w) & ~longer & (end - np.arange(end.size) > 1))  # shorter words stand first in their group
        many = end[rows] - rows - 1
        at = np.cumsum(many)
        lo = 0
        while lo < rows.size:
            hi = max(lo + 1, int(np.searchsorted(at, (at[lo - 1] if lo else 0) + PAIRS, side="right")))
            left = np.repeat(rows[lo:hi], many[lo:hi])
            right = left + 1 + np.arange(left.size) - np.repeat(np.cumsum(many[lo:hi]) - many[lo:hi], many[lo:hi])
            meets = ~mixed[left] | (own[left] != own[right])
            left, right = left[meets], right[meets]
            hit, first = near_pairs(matrix[:, : w + 1], w, left, right, longer)
            hit &= first == part[left]
            left, right = left[hit], right[hit]
            for x, y in ((left, right), (right, left)):
                near += np.bincount(x, minlength=order.size)
                np.minimum.at(best, x, rank[y])
            lo = hi
    met = np.flatnonzero(near)
    top = order[best[met]]
    return pa.RecordBatch.from_arrays([pa.array(words[met].astype(object), pa.binary()), pa.array(near[met]), pa.array(n[top]), pa.array(words[top].astype(object), pa.binary())], ["word", "near", "best_n", "best"])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): how many words are one edit away from each that has any, and the commonest, least of them."""

    def run(batches):
        for table in tables(batches, "wide", "part", "key", "lo", "hi", least=MATRIX):
            yield _tile_totals(table)

    keys = ["wide", "part", "key", "lo", "hi"]
    rows = _groups(words, tile).repartition(*keys).sortWithinPartitions(*keys, "longer")
    found = rows.mapInArrow(run, "word binary, near long, best_n long, best binary")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    plain = lambda c: F.decode(c, "ISO-8859-1")
    return found.select(plain(F.col("word")).alias("word"), "n_near", (-F.col("b.n")).alias("best_n"), plain(F.col("b.best")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the last of its chain, by doubling; counts at least double along a chain."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        made = materialize(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = made.select("word", "root")
        if made.filter("moved").isEmpty():
            return at


def variants(counts: DataFrame, dominance: int = DOMINANCE, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``counts`` (word, n).

    Two words are near if one inserted, deleted or replaced code point turns one into the other.
    The form of a word is its near word of largest n, the least in code-point order of several,
    if that n is ``dominance`` (over 1) times the word's or more; else null. The root is the last
    word on the way from form to form. Words have code points below 256 and are distinct; an
    empty table gives no rows.
    """
    words = materialize(counts.select("word", "n"), "spelled-words")
    near = materialize(near_words(words, tile), "near-words")
    rows = words.join(near, "word", "left")
    formed = F.col("best_n") >= F.col("n") * dominance
    rows = materialize(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int | None = None) -> DataFrame:
    """``variants`` of the words of whole texts: letter runs, A-Z lower-cased, of 5 letters and 3 occurrences or more.

    Null and empty texts have no words. A null id is written as nothing, repeated rows count
    again, further columns are ignored, and an empty table gives no rows.
    """
    return variants(word_counts(docs, id_col, text_col, slips))


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT id, w, length(w) AS len, count(*) AS k FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[{LETTERS}]+')) AS w FROM documents)
  WHERE length(w) >= {LEAST_LENGTH} GROUP BY id, w),
hashed AS (SELECT w, len, k, {crc32("id || ':' || w")} AS h FROM runs, crc_table),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN substring(w, 1, h % len) || substring(w, h % len + 2) ELSE w END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slipped WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
masks AS (
  SELECT word, n, unnest(list_concat(
    list_transform(range(1, length(word) + 1), lambda i: substring(word, 1, i - 1) || '?' || substring(word, i + 1)),
    list_transform(range(0, length(word) + 1), lambda i: substring(word, 1, i) || '?' || substring(word, i + 1)))) AS mask FROM words),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM masks a JOIN masks b USING (mask) WHERE a.word <> b.word),
near AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS best_n, (list(other ORDER BY other_n DESC, other))[1] AS best
  FROM pairs WHERE abs(length(word) - length(other)) <= 1 GROUP BY word, n),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {DOMINANCE} * w.n THEN best END AS form,
    CASE WHEN best_n >= {DOMINANCE} * w.n THEN best_n END AS form_n FROM words w LEFT JOIN near USING (word)),
chain(word, last) AS (
  SELECT word, word FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.last = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.last AS root FROM chain c JOIN formed f ON c.last = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
