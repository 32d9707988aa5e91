"""Near duplicates by bottom-k sketches of one hash function.

A document's sketch is the ``K`` least hashes of its set of word shingles. Inverted lists of the
retained values bring documents together: of a document's values only the rarest are listed, as
many as make sure that two sketches with the overlap of a link share a listed one. Inside a list
the overlaps are counted, the Jaccard similarity is estimated from the sketch of the union, and
what passes is compared exactly on the full sets. Lists first report leaders and their members:
each document in its largest list, then those without a leader in all of theirs. Documents that
are left apart from their list's main group are then compared with all of it, so that no link
between groups is lost and no group emits all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize
from pairtrace.llm.rows import frugal, slices, tables, text_mark
from pairtrace.llm.simhash import BROADCAST_ROWS, shingle_hashes, split_words
from pairtrace.operators.components import connected_components

#: Values that a sketch retains, and the overlap that it must have with a partner's. A link at the
#: least similarity, 0.85, has a smaller overlap with probability 4e-11 (a binomial tail, 48 draws).
K, OVERLAP = 48, 22
#: Share of a list's documents that must have one largest list in common for the list to go into it.
MERGE = 90
#: Partners of one document up to which pairs are compared one by one.
FEW = 16
_ABSENT = -(1 << 63)


def bottom(hashes: np.ndarray) -> np.ndarray:
    """The K least of a sorted set."""
    return hashes[:K]


def needed(size: int, percent: int) -> int:
    """Values that the sketch of a set of ``size`` shares with that of any partner."""
    return min(OVERLAP, -(-percent * size // 100))


def union_passes(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the union's sketch admits a link; exact where neither sketch is cut."""
    union = np.union1d(a, b)
    both = np.intersect1d(a, b, assume_unique=True)
    if a.size < K and b.size < K:
        return 100 * both.size >= percent * union.size
    union = union[:K]
    return int((both <= union[-1]).sum()) >= min(OVERLAP, union.size)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact comparison of two sorted sets."""
    if 100 * min(a.size, b.size) < percent * max(a.size, b.size):
        return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (a.size + b.size - both)


def _sketched(source: DataFrame, shingle: int) -> DataFrame:
    """(id, mark, n, key, sketch) of (id, mark, text): ``key`` names the set by 128 bits, ``sketch`` is absent without words."""

    def run(batches):
        for batch in slices(batches):
            sizes, keys, sketches = [], [], []
            for text in batch.column("text"):  # one full set at a time
                found = np.unique(shingle_hashes(split_words(text.as_py()), shingle))
                sizes.append(found.size)
                keys.append(xxhash.xxh3_128_digest(found))
                sketches.append(bottom(found).view(np.int64).copy() if found.size else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), *columns], ["id", "mark", "n", "key", "sketch"])

    return source.mapInArrow(frugal(run), "id long, mark long, n long, key binary, sketch array<long>")


def _needed(n: Column, percent: int) -> Column:
    return F.least(F.lit(OVERLAP), F.ceil(n * percent / 100)).cast("int")


def _lists(sets: DataFrame, percent: int) -> DataFrame:
    """(value, node, listed, members): the inverted lists of two or more documents; of lists of the same documents that of the least value stays.

    A document lists its values from the rarest on; what only it has needs no list. Lists of much the same documents are one
    (``_merged``). ``listed`` are all lists that a document is in.
    """
    values = sets.select("node", "n", F.explode("sketch").alias("value"))
    common = materialize(values.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1"), "shared-values")
    shared = values.join(common, "value").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
    shared = shared.withColumn("most", F.size("shared") - _needed(F.col("n"), percent) + 1).filter("most > 0")
    listed = shared.select("node", F.transform(F.slice("shared", F.lit(1), F.col("most")), lambda x: x["value"]).alias("listed"))
    rows = materialize(listed.select("node", F.explode("listed").alias("value")), "listed-values")
    mark = F.xxhash64(F.lit(1), "node")
    lists = rows.groupBy("value").agg(F.count("*").alias("members"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 20)).alias("s")).filter("members > 1")
    lists = lists.groupBy("members", "x", "s").agg(F.min("value").alias("value"))
    return _merged(materialize(rows.join(materialize(lists.select("value", "members"), "value-lists"), "value"), "inverted-lists"))


def _merged(lists: DataFrame) -> DataFrame:
    """The lists as fewer ones: those of whose documents MERGE percent have the same largest list go into it, whole.

    Documents that share a list share what it went into, so no pair is lost; near copies, which have
    all their lists in common but for a few documents each, then meet in one list and not in each.
    """
    held = lists.groupBy("node").agg(F.collect_list(F.struct("members", "value")).alias("of"))
    votes = held.select(F.array_max("of")["value"].alias("main"), F.explode("of").alias("x")).groupBy("x.value", "x.members", "main").agg(F.count("*").alias("c"))
    best = votes.groupBy("value", "members").agg(F.max(F.struct("c", "main")).alias("best"))
    into = best.select("value", F.when(100 * F.col("best.c") >= MERGE * F.col("members"), F.col("best.main")).otherwise(F.col("value")).alias("into"))
    met = lists.join(materialize(into, "list-targets"), "value").groupBy("node").agg(F.array_sort(F.collect_set("into")).alias("listed"))
    met = materialize(met.select("node", "listed", F.explode("listed").alias("value")), "merged-lists")
    return materialize(met.join(met.groupBy("value").agg(F.count("*").alias("members")), "value"), "counted-lists")


class Counted:
    """Sets of numbers that count what one of them shares with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.row = np.repeat(np.arange(len(sets)), [s.size for s in sets])
        self.ends = np.cumsum([0, *[s.size for s in sets]])
        _, self.code = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(self.code.max(initial=-1) + 1, bool)

    def shared(self, i: int) -> np.ndarray:
        mine = self.code[self.ends[i] : self.ends[i + 1]]
        self.mark[mine] = True
        found = np.bincount(self.row[self.mark[self.code]], minlength=self.ends.size - 1)
        self.mark[mine] = False
        return found


def leader_pairs(sketches: list[np.ndarray], need: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(leader, member): each member with the leader before it of largest overlap whose union passes; others lead."""
    count, leaders, out = Counted(sketches), [0], []
    for i in range(1, len(sketches)):
        at = np.array(leaders)
        equal = count.shared(i)[at]
        best = int(equal.argmax())
        lead = leaders[best]
        if equal[best] >= max(need[i], need[lead]) and union_passes(sketches[lead], sketches[i], percent):
            out.append((lead, i))
        else:
            leaders.append(i)
    return out


def _unpacked(column) -> list[np.ndarray]:
    """Lists of longs as unsigned numbers, in their ascending order."""
    return [np.sort(np.array(x.values, np.int64).view(np.uint64)) for x in column]


def _recounted(rows: DataFrame) -> DataFrame:
    """(value, node, members) of the lists that have two or more of ``rows``."""
    counts = rows.groupBy("value").agg(F.count("*").alias("members")).filter("members > 1")
    return rows.select("value", "node").join(materialize(counts, "list-members"), "value")


def _leaders(lists: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Distinct (a, b) of leaders and members of all lists; a list over ``most`` is dealt to several tasks."""

    def run(batches):
        for table in tables(batches, "value", "part"):
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            order = np.argsort(node, kind="stable")  # so that the lists of a group choose the same leaders
            sketches = _unpacked(table.column("sketch"))
            need = np.array([needed(int(n[i]), percent) for i in order.tolist()])
            pairs = np.array(leader_pairs([sketches[i] for i in order.tolist()], need, percent), np.int64).reshape(-1, 2)
            ends = node[order][pairs]
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / most)).cast("int")
    rows = lists.select("value", "node", part.alias("part")).join(sets.select("node", "n", "sketch"), "node")
    return rows.repartition("value", "part").sortWithinPartitions("value", "part").mapInArrow(frugal(run), "a long, b long").distinct()


def _full_sets(nodes: DataFrame, sets: DataFrame, source: DataFrame, shingle: int) -> DataFrame:
    """(node, grams): the sorted set of shingle hashes of each of ``nodes``, cut from a whole text."""

    def cut(batches):
        for batch in slices(batches):
            made = [np.unique(shingle_hashes(split_words(t.as_py()), shingle)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], ["node", "grams"])

    met = materialize(sets.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "id", "mark"), "listed-texts")
    small = met.count() <= BROADCAST_ROWS
    whole = source.join(F.broadcast(met) if small else met, ["id", "mark"]).select("node", "text")
    made = materialize(whole.mapInArrow(frugal(cut), "node long, grams binary"), "full-sets")
    # Rows that share id and text come more than once; their sets are the same.
    return made if made.groupBy("node").count().filter("count > 1").isEmpty() else made.dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sides = zip(batch.column("left"), batch.column("right"), strict=True)
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda end, name: grams.select(F.col("node").alias(end), F.col("grams").alias(name))
    return pairs.join(side("a", "left"), "a").join(side("b", "right"), "b").mapInArrow(frugal(run), "a long, b long")


def settled_pairs(
    grams: list[np.ndarray], sketches: list[np.ndarray], listed: list[np.ndarray], groups: list[int], value: int, asks: np.ndarray, answers: np.ndarray, order: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Pairs (i, j) that span all links between ``asks`` and ``answers`` rows of different groups of one list.

    A pair is compared in the list of the least value that both list; two asking rows are
    compared once, by their ``order``.
    """
    _, group = np.unique(groups, return_inverse=True)
    sizes = np.array([g.size for g in grams])
    need = np.array([needed(n, percent) for n in sizes.tolist()])
    before, overlap, whole, out = Counted([x[x < value] for x in listed]), None, None, []
    for i in np.flatnonzero(asks).tolist():
        can = answers & (group != group[i]) & ~(asks & (order <= order[i]))
        can &= percent * np.maximum(sizes, sizes[i]) <= 100 * np.minimum(sizes, sizes[i])
        if can.any():
            can &= before.shared(i) == 0
        if not can.any():
            continue
        overlap = overlap or Counted(sketches)
        can &= overlap.shared(i) >= np.maximum(need, need[i])
        found = np.flatnonzero(can)
        if found.size > FEW:  # then all full sets are counted at once
            whole = whole or Counted(grams)
            both = whole.shared(i)[found]
            found = found[100 * both >= percent * (sizes[found] + sizes[i] - both)]
        else:
            found = np.array([j for j in found.tolist() if union_passes(sketches[i], sketches[j], percent) and linked(grams[i], grams[j], percent)], np.int64)
        for j in found.tolist():
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                out.append((i, j))
    return out


def _settled(lists: DataFrame, groups: DataFrame, sets: DataFrame, grams: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links that span what the documents of one list still have between different groups.

    Only lists of several groups are read, and in these the documents outside the largest group
    are compared with all. Both sides are dealt to blocks, so a list costs its rows once for each
    ``block`` of documents outside its largest group, and a task holds two blocks at most.
    """
    named = lists.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named, "list-groups")
    sizes = named.groupBy("value", "component").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("value").agg(F.count("*").alias("groups"), F.max_by("component", F.struct("c", "component")).alias("main"), (F.sum("c") - F.max("c")).alias("k")).filter("groups > 1")
    rows = named.join(materialize(mixed.select("value", "main", "k"), "mixed-lists"), "value")
    asks = F.col("component") != F.col("main")
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    place = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "node"), blocks(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    row, ask = F.col("row"), F.col("ask")
    spot = lambda o, r, q, a: F.struct(o.alias("o"), r.alias("r"), q.alias("asks"), a.alias("answers"))
    answering = F.transform(F.filter(every("k"), lambda o: ~asks | (o != ask)), lambda o: spot(o, row, F.lit(False), F.lit(True)))
    asking = F.when(asks, F.transform(every("members"), lambda r: spot(ask, r, F.lit(True), r == row))).otherwise(F.array().cast("array<struct<o:int,r:int,asks:boolean,answers:boolean>>"))
    rows = rows.withColumns({"row": place(2, "members"), "ask": place(3, "k")}).select("value", "node", "listed", "component", F.explode(F.concat(answering, asking)).alias("x"))
    rows = rows.select("value", "node", "listed", "component", "x.*").join(sets.select("node", "sketch"), "node").join(grams, "node")

    def run(batches):
        for table in tables(batches, "value", "o", "r"):
            node = table.column("node").to_numpy()
            whole = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
            listed = [np.sort(np.array(x.values, np.int64)) for x in table.column("listed")]
            flags = [table.column(c).to_numpy() for c in ("asks", "answers")]
            found = settled_pairs(whole, _unpacked(table.column("sketch")), listed, table.column("component").to_pylist(), table.column("value")[0].as_py(), *flags, node, percent)
            ends = node[np.array(found, np.int64).reshape(-1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return rows.repartition("value", "o", "r").sortWithinPartitions("value", "o", "r").mapInArrow(frugal(run), "a long, b long").distinct()


def _groups(sets: DataFrame, source: DataFrame, shingle: int, percent: int, most: int, block: int) -> DataFrame:
    """(node, component) of every set with a link."""
    lists = _lists(sets, percent)
    grams = _full_sets(lists, sets, source, shingle)

    def links(some: DataFrame) -> DataFrame:
        pairs = materialize(_leaders(_recounted(some), sets, percent, most), "leader-pairs")
        return materialize(_confirmed(pairs, grams, percent), "leader-links")

    largest = lists.groupBy("node").agg(F.max_by("value", F.struct("members", "value")).alias("value"))
    good = links(largest)
    # A member is stood for by its leader, so a group's documents don't meet again in each of their lists.
    good = good.unionAll(links(lists.select("value", "node").join(good.select(F.col("b").alias("node")).distinct(), "node", "left_anti")))
    named = lambda edges: materialize(connected_components(edges, "a", "b").withColumnRenamed("id", "node"), "set-groups")
    groups = named(good)
    rest = materialize(_settled(lists, groups, sets, grams, percent, block), "settled-links")
    return groups if rest.isEmpty() else named(good.unionAll(rest))


def linked_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85, most: int = 500, block: int = 1_000
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row; component_id is the smallest id reachable over links, kept says that it is the row's own.

    A document's set are its distinct ``shingle``-word shingles (A-Z lower-cased, words split at
    white space); a shorter text's words are one shingle. Two sets are linked where 100 times
    their intersection is at least ``percent`` (85 or more) times their union, checked on the
    full sets. Null, empty and blank texts have no set and no links, not even with each other.
    Equal sets are collapsed first, so a group of copies costs one row. Null ids count as the
    least id and come back null; rows of a repeated id are judged by their texts. Repeated rows
    stay, further columns are ignored, an empty table gives no rows. Neither ``most`` nor ``block``
    changes the groups: they bound what a task holds.
    """
    if percent < 85:
        raise ValueError("the sketches are sized for links of 85 percent or more")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_ABSENT)).alias("id"), text_mark(text_col).alias("mark"), text.alias("text"))
    rows = materialize(_sketched(source, shingle), "bottom-sketches")
    sets = rows.filter("n > 0").groupBy("key").agg(F.min(F.struct("id", "mark")).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sets = materialize(sets.select(F.monotonically_increasing_id().alias("node"), "key", "first.*", "n", "sketch"), "distinct-sets")
    groups = _groups(sets, source, shingle, percent, most, block)
    members = sets.select("node", "key", "id").join(groups, "node")
    lowest = members.groupBy("component").agg(F.min("id").alias("component_id"))
    members = members.join(lowest, "component").select("key", "component_id")
    per_set = materialize(sets.select("key", "id").join(members, "key", "left").select("key", F.coalesce("component_id", "id").alias("component_id")), "set-components")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    joined = rows.select("id", "n", "key").join(per_set, "key", "left").select("id", "n", own.alias("component_id"))
    back = lambda c: F.nullif(F.col(c), F.lit(_ABSENT))
    return joined.select(back("id").alias(id_col), F.col("n").alias("n_shingles"), back("component_id").alias("component_id"), (F.col("id") == F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
cut AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM cut),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k
  FROM members a JOIN members b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * k >= 85 * (na + nb - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT DISTINCT a, a FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
low AS (SELECT a, least(min(a), min(b)) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM cut LEFT JOIN low ON a = doc_id
"""
