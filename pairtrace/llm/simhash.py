"""SimHash fingerprints linked through sharded BK-trees, closed to components.

Sharding: 64 bits are cut into ``radius + 2`` blocks. Two fingerprints within the radius agree
in at least two blocks, so they meet in the shard of some pair of blocks. Each shard builds a
BK-tree (children keyed by Hamming distance to the parent) and follows only edges within the
radius. A shard reports a spanning star of its linked fingerprints, never all pairs.

For near copies of a stated similarity the radius would be too wide for blocks of bits (at a
Jaccard similarity of 0.8 fingerprints differ in about 10 of 64 bits). ``similar_documents``
therefore shards by bands of minima over the same shingle hashes and searches each shard's
BK-tree with a wider radius; links are checked on the whole texts. What the trees leave apart is
settled exactly: texts of a shard that are not in its main group are compared with all of it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize
from pairtrace.llm.rows import frugal, slices, tables, text_mark
from pairtrace.operators.components import connected_components

CHUNK = 1 << 16
#: Members of shards that a task of ``fingerprint_links`` takes at a time, besides those of one shard.
MEMBERS = 20_000
#: Bands of minima: two texts of similarity 0.8 share none of them with probability 0.00000005.
BANDS, ROWS = 32, 4
#: Radius of the trees that look for near copies, and links a text reports to each group that it touches.
#: Both only order the work: what they miss is found by ``settled_links``.
WIDE_RADIUS, LINKS = 16, 2
#: Tables up to so many rows of 16 bytes are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
_FACTORS = np.random.default_rng(64).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ABSENT = -(1 << 63)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; fewer words make one shingle, none make none."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, len(words) - k + 1)


def simhash(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, hashes.size, CHUNK):
        part = hashes[lo : lo + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > hashes.size).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles, repeats included; no words give zero."""
    return simhash(shingle_hashes(split_words(text), shingle))


def minima(hashes: np.ndarray) -> np.ndarray:
    """Least value of the hashes under each of BANDS * ROWS multipliers."""
    least = np.full(_FACTORS.size, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, hashes.size, 2048):
        np.minimum(least, (_FACTORS[:, None] * hashes[None, lo : lo + 2048]).min(axis=1), out=least)
    return least


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add_and_find(self, value: int, radius: int) -> list[int]:
        """Members within ``radius`` of ``value``, which then joins the tree."""
        if self.root is None:
            self.root = (value, {})
            return []
        found, stack = [], [self.root]
        while stack:
            node, children = stack.pop()
            d = (node ^ value).bit_count()
            if d <= radius:
                found.append(node)
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return found
            if d not in node[1]:
                node[1][d] = (value, {})
                return found
            node = node[1][d]


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, root) for each value that is linked to another one within the shard."""
    tree, up = BKTree(), {}

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for value in values:
        up.setdefault(value, value)
        for other in tree.add_and_find(value, radius):
            a, b = top(value), top(other)
            if a != b:
                up[max(a, b)] = min(a, b)
    return [(x, top(x)) for x in up if top(x) != x]


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(id, fp long)`` for every row: the fingerprint's 64 bits as a signed long."""

    def run(batches):
        for batch in slices(batches):
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(frugal(run), "id long, fp long")


def _shards(fps: DataFrame, radius: int, most: int) -> DataFrame:
    """Rows (shard, fp) of shards with two or more members; shards over ``most`` become pairs of parts."""
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:], strict=False)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = [
        F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(signed[a] | signed[b])))
        for n, (a, b) in enumerate(combinations(range(blocks), 2))
    ]
    return _meeting(fps.select("fp", F.explode(F.array(*keys)).alias("shard")), "fp", most)


def _meeting(rows: DataFrame, member: str, most: int) -> DataFrame:
    """Members of shards of two or more; a shard over ``most`` becomes pairs of parts, in which any two still meet."""
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    rows = rows.join(sizes, "shard").withColumn("parts", F.ceil(F.col("n") / most).cast("int"))
    part = F.pmod(F.xxhash64(member, "shard"), F.col("parts")).cast("int")
    meet = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.concat_ws(":", F.col("shard"), F.least(j, part), F.greatest(j, part)),
    )
    return rows.select(member, F.explode(meet).alias("shard"))


def fingerprint_links(fps: DataFrame, radius: int = 4, most: int = 20_000) -> DataFrame:
    """``(a, b)``: enough links between distinct fingerprints to span every linked set."""

    def run(batches):
        for table in tables(batches, "shard", least=MEMBERS):
            shard, value = table.column("shard").to_numpy(zero_copy_only=False), table.column("fp").to_numpy().view(np.uint64)
            cuts = np.r_[0, np.flatnonzero(shard[1:] != shard[:-1]) + 1, shard.size]
            links: set[tuple[int, int]] = set()
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hi - lo > 1:
                    links.update(shard_links(np.sort(value[lo:hi]).tolist(), radius))
            ends = np.array(sorted(links), np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    shards = _shards(fps, radius, most)
    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(frugal(run), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``(id, fp, component_id)`` per row; component_id is the smallest id reachable over links.

    Links join fingerprints at ``radius`` or fewer differing bits. Null, empty and blank texts
    have fingerprint zero and link like any other. Equal fingerprints are collapsed before
    linking (map-side minimum), so a group of copies costs one row. A repeated id keeps its
    rows; an empty table gives an empty result; further columns are ignored.
    """
    marked = materialize(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    fps = materialize(marked.groupBy("fp").agg(F.min("id").alias("low")), "distinct-fingerprints")
    links = materialize(fingerprint_links(fps, radius), "fingerprint-links")
    groups = connected_components(links, "a", "b").withColumnRenamed("id", "fp")
    linked = fps.join(groups, "fp")
    lowest = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    member = linked.join(lowest, "component").select("fp", "component_id")
    per_fp = fps.join(member, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id"))
    per_fp = materialize(per_fp, "fingerprint-groups")  # so that the join below is free to split a hot fingerprint
    return marked.join(per_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, mark, words, fp, minima, bands) of (id, mark, text): ``words`` hashes the word sequence, ``minima`` has 16 bits of each."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for text in batch.column("text"):
                found = split_words(text.as_py())
                hashes = np.unique(shingle_hashes(found, shingle))  # links go by sets, so a repeated line weighs once
                low = minima(hashes)
                bands = [xxhash.xxh64_intdigest(low[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)] if found else []
                out.append((xxhash.xxh64_intdigest(b" ".join(found)), simhash(hashes), low.astype(np.uint16).tobytes(), np.array(bands, np.uint64).tobytes()))
            longs = [pa.array(np.array([row[i] for row in out], np.uint64).view(np.int64)) for i in (0, 1)]
            lists = [np.frombuffer(r[3], np.int64) for r in out]
            columns = [batch.column("id"), batch.column("mark"), *longs, pa.array([r[2] for r in out], pa.binary()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "words", "fp", "minima", "bands"])

    return docs.mapInArrow(frugal(run), "id long, mark long, words long, fp long, minima binary, bands array<long>")


class Groups:
    """Sets that are joined; members are numbered from 0."""

    def __init__(self, first: list[int]):
        self.up = first

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def similar_links(fps: list[int], sketches: np.ndarray, links: int = LINKS, radius: int = WIDE_RADIUS) -> list[tuple[int, int]]:
    """Pairs (i, j) of rows of one shard to be checked.

    A BK-tree finds partners within the radius, which are ordered by their equal minima. Each
    row reports its ``links`` best partners in every set of earlier rows that it touches, then
    joins these sets, so pairs are at most about ``2 * links`` times the rows.
    """
    sets, tree, at, out = Groups(list(range(len(fps)))), BKTree(), {}, []
    for i, fp in enumerate(fps):
        others = np.array([j for f in tree.add_and_find(fp, radius) for j in at[f]], np.int64)
        at.setdefault(fp, []).append(i)
        if not others.size:
            continue
        equal = (sketches[others] == sketches[i]).mean(axis=1)
        told: dict[int, int] = {}
        for j in others[np.argsort(-equal, kind="stable")].tolist():
            group = sets.top(j)
            told[group] = told.get(group, 0) + 1
            if told[group] <= links:
                out.append((j, i))
        for group in told:
            sets.join(group, i)
    return out


def settled_links(
    grams: list[np.ndarray], groups: list[int], bands: np.ndarray, band: int, asks: np.ndarray, answers: np.ndarray, order: np.ndarray, similarity: float
) -> list[tuple[int, int]]:
    """Pairs (i, j) that span all links between ``asks`` and ``answers`` rows of different groups of one shard.

    ``grams`` are sorted sets. Rows of one group are linked already. A pair is compared in the
    first band that it shares; two asking rows are compared once, by their ``order``.
    """
    sets = Groups(_firsts(groups))
    size = np.array([g.size for g in grams])
    rows = np.flatnonzero(answers)
    flat = np.concatenate([grams[i] for i in rows.tolist()]) if rows.size else np.zeros(0, np.uint64)
    starts = np.cumsum(size[rows]) - size[rows]
    vocabulary, code, out = None, None, []
    for i in np.flatnonzero(asks).tolist():
        small, large = np.minimum(size[rows], size[i]), np.maximum(size[rows], size[i])
        shared = bands[rows] == bands[i]
        can = (small >= similarity * large) & (shared.argmax(axis=1) == band) & shared[:, band] & ~(asks[rows] & (order[rows] <= order[i])) & (rows != i)
        own = sets.top(i)
        at = [n for n in np.flatnonzero(can).tolist() if sets.top(int(rows[n])) != own]
        if not at:
            continue
        if len(at) > 32:  # counts what the row shares with every answering row at once
            if vocabulary is None:
                vocabulary, code = np.unique(flat, return_inverse=True)
            mark = np.zeros(vocabulary.size, np.int64)
            mark[np.searchsorted(vocabulary, np.intersect1d(grams[i], vocabulary, assume_unique=True))] = 1
            both = np.add.reduceat(mark[code], starts)
        else:
            at.sort(key=lambda n: -int(shared[n].sum()))
            both = None
        for n in at:
            j = int(rows[n])
            if sets.top(j) == sets.top(i):
                continue
            common = np.intersect1d(grams[i], grams[j], assume_unique=True).size if both is None else int(both[n])
            if common >= similarity * (int(size[i]) + int(size[j]) - common) and sets.join(i, j):
                out.append((i, j))
    return out


def _firsts(values: list[int]) -> list[int]:
    first: dict[int, int] = {}
    return [first.setdefault(v, i) for i, v in enumerate(values)]


def _spans(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _members(texts: DataFrame) -> DataFrame:
    """(words, band, shard, n) of shards of two or more texts; of shards with the same texts the first band's stays."""
    rows = texts.select("words", F.posexplode("bands").alias("band", "shard"))
    mark = F.xxhash64(F.lit(1), "words")
    shards = rows.groupBy("shard").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 20)).alias("s"), F.min("band").alias("band")).filter("n > 1")
    shards = shards.groupBy("n", "x", "s").agg(F.min_by("shard", F.struct("band", "shard")).alias("shard"))
    shards = materialize(shards.select("shard", "n"), "band-shards")
    return materialize(rows.join(shards, "shard"), "band-members")


def _shingle_sets(members: DataFrame, texts: DataFrame, source: DataFrame, shingle: int) -> DataFrame:
    """(words, grams): the sorted set of shingle hashes of every text that meets another one; each text is cut once."""

    def cut(batches):
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(split_words(t.as_py()), shingle)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("words"), pa.array(sets, pa.binary())], ["words", "grams"])

    met = materialize(texts.join(members.select("words").distinct(), "words", "left_semi").select("words", "id", "mark"), "meeting-texts")
    met = F.broadcast(met) if met.count() <= BROADCAST_ROWS else met
    whole = source.join(met, ["id", "mark"]).select("words", "text")
    made = materialize(whole.mapInArrow(frugal(cut), "words long, grams binary"), "shingle-sets")
    # Rows that share id and text come more than once; their sets are the same.
    return made if made.groupBy("words").count().filter("count > 1").isEmpty() else made.dropDuplicates(["words"])


def _candidates(members: DataFrame, texts: DataFrame, most: int, links: int) -> DataFrame:
    """Distinct (a, b), hashes of word sequences near each other in the tree of some shard; a shard over ``most`` is dealt to several trees."""

    def run(batches):
        for table in tables(batches, "shard", "part"):
            words, fp = table.column("words").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
            sketch = np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint16).reshape(-1, _FACTORS.size)
            # Shards take their rows in different orders, so that they don't all report the same partners.
            order = np.argsort(words.view(np.uint64) * (2 * table.column("shard").to_numpy()[:1].view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
            words, fp, sketch = words[order], fp[order], sketch[order]
            pairs = np.array(similar_links(fp.tolist(), sketch, links), np.int64).reshape(-1, 2)
            ends = np.sort(words[pairs], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    part = F.pmod(F.xxhash64("words", "shard"), F.ceil(F.col("n") / most)).cast("int")
    rows = members.select("words", "shard", part.alias("part")).join(texts.select("words", "fp", "minima"), "words")
    return rows.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(frugal(run), "a long, b long").distinct()


def _checked(pairs: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles have a Jaccard similarity of ``similarity`` or more."""

    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                one, two = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both = 0
                if min(one.size, two.size) >= similarity * max(one.size, two.size):
                    both = np.intersect1d(one, two, assume_unique=True).size
                keep.append(both >= similarity * (one.size + two.size - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda end, name: grams.select(F.col("words").alias(end), F.col("grams").alias(name))
    return pairs.join(side("a", "left"), "a").join(side("b", "right"), "b").mapInArrow(frugal(run), "a long, b long")


def _settled(members: DataFrame, groups: DataFrame, texts: DataFrame, grams: DataFrame, similarity: float, block: int) -> DataFrame:
    """(a, b): links that span what the texts of one shard still have between different groups.

    Only shards of several groups are read, and in these the texts outside the largest group
    are compared with all. Both sides are dealt to blocks, so a shard costs its rows once for
    each ``block`` of texts outside its largest group, and a task holds two blocks at most.
    """
    named = members.join(groups, "words", "left").withColumn("component", F.coalesce("component", "words"))
    named = materialize(named, "band-groups")
    sizes = named.groupBy("shard", "component").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("shard").agg(F.count("*").alias("groups"), F.max_by("component", F.struct("c", "component")).alias("main"), (F.sum("c") - F.max("c")).alias("k")).filter("groups > 1")
    rows = named.join(materialize(mixed.select("shard", "main", "k"), "mixed-shards"), "shard")
    asks = F.col("component") != F.col("main")
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    place = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "words"), blocks(n)).cast("int")
    up_to = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    row, ask = F.col("row"), F.col("ask")
    spot = lambda o, r, q, a: F.struct(o.alias("o"), r.alias("r"), q.alias("asks"), a.alias("answers"))
    answering = F.transform(F.filter(up_to("k"), lambda o: ~asks | (o != ask)), lambda o: spot(o, row, F.lit(False), F.lit(True)))
    asking = F.when(asks, F.transform(up_to("n"), lambda r: spot(ask, r, F.lit(True), r == row))).otherwise(F.array().cast("array<struct<o:int,r:int,asks:boolean,answers:boolean>>"))
    rows = rows.withColumns({"row": place(2, "n"), "ask": place(3, "k")}).select("shard", "band", "words", "component", F.explode(F.concat(answering, asking)).alias("x"))
    rows = rows.select("shard", "band", "words", "component", "x.*").join(texts.select("words", "bands"), "words").join(grams, "words")

    def run(batches):
        for table in tables(batches, "shard", "o", "r"):
            words = table.column("words").to_numpy()
            bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            flag = [table.column(c).to_numpy() for c in ("asks", "answers")]
            found = settled_links(_spans(table.column("grams")), table.column("component").to_pylist(), bands, table.column("band")[0].as_py(), *flag, words, similarity)
            ends = words[np.array(found, np.int64).reshape(-1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return rows.repartition("shard", "o", "r").sortWithinPartitions("shard", "o", "r").mapInArrow(frugal(run), "a long, b long").distinct()


def _similar_groups(texts: DataFrame, source: DataFrame, shingle: int, similarity: float, most: int, links: int, block: int) -> DataFrame:
    """(words, component) of every text with a link."""
    members = _members(texts)
    grams = _shingle_sets(members, texts, source, shingle)
    pairs = materialize(_candidates(members, texts, most, links), "tree-pairs")
    good = materialize(_checked(pairs, grams, similarity), "tree-links")
    named = lambda edges: materialize(connected_components(edges, "a", "b").withColumnRenamed("id", "words"), "similar-groups")
    groups = named(good)
    rest = materialize(_settled(members, groups, texts, grams, similarity, block), "settled-links")
    return groups if rest.isEmpty() else named(good.unionAll(rest))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, most: int = 500, links: int = LINKS, block: int = 1_000
) -> DataFrame:
    """``(id, component_id, text_mark, stays)`` per row; component_id is the smallest id reachable over similar texts.

    ``stays`` is true for rows with the least (id, text_mark) of their group and false for the others.

    Two texts are linked where the sets of their word shingles (A-Z lower-cased, split at white
    space) have a Jaccard similarity of ``similarity`` or more; every link is checked on the whole
    texts. Texts that share a band of minima are all accounted for, by trees of up to ``most``
    texts and then by blocks of ``block``; neither number changes the groups. Equal word sequences
    are collapsed first, so a group of copies costs one row; texts without words are one group.
    Null ids count as the least id and come back null. A repeated id keeps its rows; an empty
    table gives an empty result; further columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_ABSENT)).alias("id"), text_mark(text_col).alias("mark"), text.alias("text"))
    rows = materialize(_sketches(source, shingle), "sketches")
    first = F.min(F.struct("id", "mark")).alias("first")
    texts = rows.groupBy("words").agg(first, F.min_by(F.struct("fp", "minima", "bands"), F.struct("id", "mark")).alias("x"))
    texts = materialize(texts.select("words", "first.*", "x.*"), "distinct-sketches")
    groups = _similar_groups(texts, source, shingle, similarity, most, links, block)
    linked = texts.select("words", "id", "mark").join(groups, "words")
    lowest = linked.groupBy("component").agg(F.min(F.struct("id", "mark")).alias("first"))
    member = linked.join(lowest, "component").select("words", "first")
    per_text = texts.select("words", F.struct("id", "mark").alias("own")).join(member, "words", "left").select("words", F.coalesce("first", "own").alias("first"))
    back = lambda c: F.nullif(c, F.lit(_ABSENT))
    return rows.select("id", "mark", "words").join(materialize(per_text, "first-of-text"), "words").select(
        back(F.col("id")).alias(id_col), back(F.col("first.id")).alias("component_id"), F.col("mark").alias("text_mark"),
        (F.struct("id", "mark") == F.col("first")).alias("stays"),
    )


def as_hex(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
