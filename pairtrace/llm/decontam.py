"""Benchmark decontamination by a positional inverted index of the training texts.

The training texts are cut into words once and stored with their positions. Test windows are
looked up by their rarest terms: term frequencies come from all training tokens, postings
(term, document, position) of the two rarest terms of each window are stored, and their lists
are intersected after adjusting each position by the term's offset. Windows that share their
rarest terms form a segment, and equal segments of all items are one, so a question frame or a
repeated phrase is looked up once. What is left is compared word by word. Only DataFrame functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.functions.membership import maybe_among
from pairtrace.functions.shared import materialize
from pairtrace.llm.rows import text_mark

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, RAREST = 10, 2
#: Tables of up to so many bytes, spelled as JSON, are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 8 << 20
#: Rows a word that a text's postings may give; texts beyond are looked up by window.
CROWDED = 20


def words(text: str) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    plain = F.octet_length(t) == F.char_length(t)  # then lower() is A-Z alone, and faster
    lowered = F.when(plain, F.lower(t)).otherwise(F.translate(t, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def test_passages(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct item texts with words: passage, words, items (ids as strings)."""
    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(text_col).alias("words"))
    rows = rows.filter(F.size("words") > 0).groupBy("words").agg(F.collect_set("item").alias("items"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("passage"), "words", "items"), "test-passages")


def _beside(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a materialised table, broadcast after its bytes are counted."""
    spelled = F.octet_length(F.to_json(F.struct(*small.columns))).cast("long")
    weight = small.agg(F.coalesce(F.sum(spelled), F.lit(0))).first()[0]
    return big.join(F.broadcast(small) if weight <= BROADCAST_BYTES else small, on, how)


def token_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored words of the training texts: id, twin (a hash of the text, which tells rows of one id apart), words in order."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("id"), text_mark(text_col).alias("twin"), words(text_col).alias("words"))
    return materialize(rows, "tokens")


def term_frequencies(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences in all training texts of each term of ``vocabulary``; counted map-side first."""
    terms = tokens.select(F.explode("words").alias("term"))
    return _beside(terms, vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def _rarest(passages: DataFrame, frequencies: DataFrame, window: int) -> DataFrame:
    """(passage, start, wide, terms) for each window: its rarest terms, as (n, offset, term); windows with a term unseen in training are left out."""
    places = passages.select("passage", F.size("words").alias("size"), F.posexplode("words").alias("offset", "term"))
    places = places.join(frequencies, "term")
    wide = F.least(F.lit(window), F.col("size"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("offset") - wide + 1), F.least(F.col("offset"), F.col("size") - wide))
    per_window = places.withColumn("start", F.explode(starts)).groupBy("passage", "start", wide.alias("wide")).agg(
        F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("terms")
    )
    return per_window.filter(F.size("terms") == F.col("wide")).withColumn("terms", F.slice("terms", 1, RAREST))


def segments(passages: DataFrame, frequencies: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct runs of windows with the same rarest terms: segment, span (its words), wide (words of a window), items, terms (offset, term).

    The windows of a passage that share their rarest places are neighbours. A span longer than
    ``wide`` holds several windows. Equal spans of all passages are one segment with all their items.
    """
    rarest = _rarest(passages, frequencies, window)
    runs = rarest.groupBy("passage", "wide", F.transform("terms", lambda t: t["offset"]).alias("places")).agg(
        F.min("start").alias("low"), F.count("*").alias("windows"), F.min("terms").alias("terms")
    )
    span = F.slice("words", F.col("low") + 1, (F.col("wide") + F.col("windows") - 1).cast("int"))
    terms = F.transform("terms", lambda t: F.struct((t["offset"] - F.col("low")).alias("offset"), t["term"].alias("term")))
    spans = runs.join(passages, "passage").select(span.alias("span"), "wide", terms.alias("terms"), F.explode("items").alias("item"))
    rows = spans.groupBy("span", "wide", "terms").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("segment"), "span", "wide", "items", "terms"), "segments")


def postings(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored index: (id, twin, size, position, term) for every occurrence of ``terms`` in the training texts; size is the text's words."""
    rows = tokens.select("id", "twin", F.size("words").alias("size"), F.posexplode("words").alias("position", "term"))
    return materialize(_beside(rows, terms, "term", "left_semi"), "postings")


def _index(tokens: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments, anchors, postings): anchors (segment, bit, offset, term) are the rarest terms of each segment."""
    passages = test_passages(items)
    vocabulary = materialize(passages.select(F.explode("words").alias("term")).distinct(), "test-terms")
    frequencies = materialize(term_frequencies(tokens, vocabulary), "term-frequencies")
    made = segments(passages, frequencies, window)
    anchors = materialize(made.select("segment", F.posexplode(F.col("terms").cast("array<struct<offset:int,term:string>>")).alias("bit", "t")).select("segment", "bit", "t.*"), "rarest-terms")
    return made, anchors, postings(tokens, materialize(anchors.select("term").distinct(), "anchor-terms"))


def _hits(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """(id, twin, segment, bit, position, at): the segment's first word would stand on document word ``at``, by its rarest term number ``bit``."""
    return _beside(index, anchors, "term").select("id", "twin", "segment", "bit", "position", (F.col("position") - F.col("offset")).alias("at"))


def crowded_texts(index: DataFrame, anchors: DataFrame, most: int = CROWDED) -> DataFrame:
    """(id, twin) of texts whose postings meet over ``most`` segments a word: few words that many windows share."""
    load = materialize(anchors.groupBy("term").agg(F.count("*").alias("segments")), "term-loads")
    cost = _beside(index, load, "term").groupBy("id", "twin").agg(F.sum("segments").alias("rows"), F.max("size").alias("size"))
    return materialize(cost.filter(F.col("rows") > most * F.col("size")).select("id", "twin"), "crowded-texts")


def _by_windows(tokens: DataFrame, crowded: DataFrame, made: DataFrame) -> DataFrame:
    """(id, twin, segment, at) of the crowded texts: each place's words, hashed, are looked up among the windows of all segments.

    A text costs one row a word and window size, whatever its words; equal hashes are compared
    by words later, like all candidates.
    """
    spots = F.sequence(F.lit(0), F.size("span") - F.col("wide"))
    windows = made.select("segment", "wide", F.posexplode(F.transform(spots, lambda j: F.xxhash64(F.slice("span", j + 1, F.col("wide"))))).alias("j", "key"))
    windows = materialize(windows, "window-keys")
    widths = [r.wide for r in windows.select("wide").distinct().collect()]  # at most as many as a window has words
    texts = _beside(tokens, crowded, ["id", "twin"], "left_semi").withColumn("wide", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>")))
    places = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("wide")), lambda p: F.xxhash64(F.slice("words", p + 1, F.col("wide"))))
    rows = texts.filter(F.size("words") >= F.col("wide")).select("id", "twin", "wide", F.posexplode(places).alias("p", "key"))
    return _beside(rows, windows, ["wide", "key"]).select("id", "twin", "segment", (F.col("p") - F.col("j")).alias("at"))


def alignments(tokens: DataFrame, items: DataFrame, window: int = WINDOW, most: int = CROWDED) -> tuple[DataFrame, DataFrame]:
    """(segments, candidates): candidates (id, twin, segment, ats) list where a segment's first word may stand in a text.

    Every true window is among them: all its rarest terms are posted with that ``at``, and in a
    crowded text its hash is found.
    """
    made, anchors, index = _index(tokens, items, window)
    crowded = crowded_texts(index, anchors, most)
    several = not crowded.isEmpty()
    index = _beside(index, crowded, ["id", "twin"], "left_anti") if several else index
    power = lambda n: F.pow(F.lit(2), n).cast("int")
    met = _hits(index, anchors).groupBy("id", "twin", "segment", "at").agg(F.bit_or(power(F.col("bit"))).alias("bits"))
    need = made.select("segment", (power(F.size("terms")) - 1).alias("need"))
    whole = _beside(met, need, "segment").filter("bits = need").select("id", "twin", "segment", "at")
    whole = whole.unionByName(_by_windows(tokens, crowded, made).distinct()) if several else whole
    return made, materialize(whole.groupBy("id", "twin", "segment").agg(F.collect_list("at").alias("ats")), "alignments")


def _found(tokens: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(id, twin, n_hit, items, hits) of the texts in which a window occurs, one row each."""
    made, candidates = alignments(tokens, items, window)
    parts = _beside(candidates, made.select("segment", "span", "wide", "items"), "segment")
    per_doc = materialize(parts.groupBy("id", "twin").agg(F.collect_list(F.struct("segment", "span", "wide", "items", "ats")).alias("found")), "aligned-texts")
    # Texts without candidates are dropped before the rest is dealt to the candidates, at every size.
    rows = maybe_among(tokens.select("id", "twin", "words"), per_doc, ["id", "twin"]).join(per_doc.hint("merge"), ["id", "twin"])
    word = F.get  # null beyond either end

    def starts(c: Column) -> Column:
        """Document positions where a window of the segment begins."""
        equal = lambda p, j: F.forall(F.sequence(F.lit(0), c["wide"] - 1), lambda k: F.coalesce(word(F.col("words"), p + k) == word(c["span"], j + k), F.lit(False)))
        windows = F.sequence(F.lit(0), F.size(c["span"]) - c["wide"])
        return F.flatten(F.transform(c["ats"], lambda at: F.transform(F.filter(windows, lambda j: equal(at + j, j)), lambda j: at + j)))

    made_hits = F.transform("found", lambda c: F.struct(c["segment"].alias("segment"), c["wide"].alias("wide"), c["items"].alias("items"), starts(c).alias("starts")))
    rows = materialize(rows.select("id", "twin", F.filter(made_hits, lambda h: F.size(h["starts"]) > 0).alias("hits")), "verified-hits")
    spans = F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.transform(h["starts"], lambda s: F.struct(s.alias("a"), (s + h["wide"]).alias("b")))))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], acc["end"]))).cast("long").alias("n"), F.greatest(acc["end"], x["b"]).alias("end"))
    rows = rows.filter(F.size("hits") > 0).dropDuplicates(["id", "twin"])
    named = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    hits = F.transform("hits", lambda h: F.struct(h["segment"].alias("segment"), h["wide"].alias("wide"), h["starts"].alias("starts")))
    return rows.select("id", "twin", F.aggregate(spans, start, step, lambda acc: acc["n"]).alias("n_hit"), named.alias("items"), hits.alias("hits"))


def contaminated_rows(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct (id, text_mark) of rows in which a window occurs. Edge cases are those of ``find_benchmark_text``."""
    found = _found(token_table(docs, id_col, text_col), items, window)
    return found.select(F.nullif("id", F.lit(-(1 << 63))).alias(id_col), F.col("twin").alias("text_mark"))


def find_benchmark_text(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_hit, items (sorted strings), hits (array of segment, wide, starts), text_mark for every row.

    A window is ``window`` consecutive item words; a shorter item with words is one window. A
    document word inside any occurrence of a window is hit. Null and empty texts have no words.
    Items with null id or no words match nothing; equal items are compared once. Rows sharing an
    id are judged apart by their texts; repeated rows get equal results. A null id stays null,
    and further columns of either table may have any name. Empty tables give no hits or rows.
    A text costs its words and one row for each place of a window's rarest terms; where that
    would be over ``CROWDED`` rows a word, one row a word and window size.
    """
    tokens = token_table(docs, id_col, text_col)
    found = materialize(_found(tokens, items, window), "contaminated-texts")
    rows = _beside(tokens.select("id", "twin", F.size("words").cast("long").alias("n_words")), found, ["id", "twin"], "left")
    return rows.select(
        F.nullif("id", F.lit(-(1 << 63))).alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hits", F.col("twin").alias("text_mark"),
    )


def proximity_matches(docs: DataFrame, items: DataFrame, slack: int = 3, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, item, position, gap): places where a window's two rarest terms stand within ``slack`` words of their distance in the item.

    Each hit of a window's term is compared with the last hit of its other term before it, in the
    order in which they place the window, so no group emits all pairs; a word is not its own partner. ``gap`` is 0 where the
    distance is that of the item, and ``position`` that of the later hit. Windows of one word
    have no other term. Edge cases are those of ``find_benchmark_text``.
    """
    made, anchors, index = _index(token_table(docs, id_col, text_col), items, window)
    hits = _hits(index, anchors)
    order = Window.partitionBy("id", "twin", "segment").orderBy("at", "bit", "position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda bit: F.last(F.when(F.col("bit") == bit, F.struct("at", "position")), ignorenulls=True).over(order)
    near = hits.distinct().withColumn("other", F.when(F.col("bit") == 0, last(1)).otherwise(last(0)))
    near = near.withColumn("gap", F.col("at") - F.col("other.at")).filter((F.col("gap") <= slack) & (F.col("position") != F.col("other.position")))
    near = _beside(near, made.select("segment", "items"), "segment")
    return near.select(F.nullif("id", F.lit(-(1 << 63))).alias(id_col), F.explode("items").alias("item"), "position", "gap").distinct()


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Digest columns of ``find_benchmark_text``."""
    found = find_benchmark_text(docs, items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 8), lambda s: array_to_string(w[s:s + 9], ' ')) END) AS g,
    least(len(w), 10) AS k FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS s,
    unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS g
  FROM d, sizes WHERE len(w) >= k),
m AS (SELECT DISTINCT doc_id, s, iw.k, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.k = iw.k),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
