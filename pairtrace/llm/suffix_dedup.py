"""Exact removal of long repeated byte strings by a logarithmic family of sparse suffix arrays.

Every string of SPAN bytes contains a sampled suffix start: the position of its least K-byte
hash. Equal strings sample the same offset, so a repeated string always shows as two sampled
suffixes that agree on K bytes, and on L bytes before and R bytes behind them with
L + R >= SPAN - K. A suffix is held as its first K bytes and a 128-bit digest of its whole reach
(REACH bytes before to REACH bytes behind them); arrays are in the order of those bytes.
Sampled suffixes are dealt by their first K bytes.

* A map task's batch becomes a suffix array. Suffixes whose whole reach repeats an earlier one in
  the batch are settled there and not sent on.
* A reducer keeps a family of levels. A new batch gets its suffix array, which is merge-scanned
  against every level; the later of two suffixes of equal reach is settled, so levels never hold
  one twice. Levels of equal size are merged.
* Suffixes that agree on K bytes but not on their whole reach lie near the edge of a match. They
  are dealt again by K bytes and half a reach on the side that agrees, with their bytes, and the
  exact extents are found; every string removed there was compared byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize
from pairtrace.llm.rows import tables, text_mark

SPAN, K = 100, 32
REACH = SPAN - K
HALF = REACH // 2
DIGEST = 16
CHUNK_BYTES = 2 << 20
#: Suffixes of one batch, of 76 bytes each: what a suffix array is made of before it is sent on or meets the levels.
BATCH_ROWS = 150_000
#: Whole buckets of edge suffixes are compared together up to so many rows, of about 1 KB each.
MATCH_ROWS = 20_000
#: ``key``: K bytes and the digest; ``before`` and ``behind``: hashes of half a reach, 0 where the text is shorter.
SUFFIX = np.dtype([("key", f"S{K + DIGEST}"), ("before", "u4"), ("behind", "u4"), ("pos", "u4"), ("id", "i8"), ("twin", "i8")])
KIND_LATER, KIND_BEFORE, KIND_BEHIND = 1, 2, 3


def _mix(x: np.ndarray, n: int) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
    return x ^ (x >> np.uint64(29))


def _grow(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of strings twice as long; the last ``step`` entries run over the end and mean nothing."""
    out = _mix(h, step)
    out[:-step] += h[step:]
    return _mix(out, step + 1)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width], entries beyond the end left out."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = out.copy()
        out[:-step] = pick(out[:-step], out[step:])
        done += step
    return out


def sample_suffixes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """SUFFIX rows (without id and twin) of the texts laid end to end, and each row's text number."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts) + bytes(SPAN * 2), np.uint8)
    starts, size = np.cumsum(lens) - lens, int(lens.sum())
    if not (lens >= SPAN).any():
        return np.zeros(0, SUFFIX), np.zeros(0, np.int64)
    h = {1: _mix(data.astype(np.uint64) + np.uint64(1), 0)}
    for n in (1, 2, 4, 8, 16, 32):
        h[2 * n] = _grow(h[n], n)
    key = h[K]
    low = _slide(key, SPAN - K + 1, np.minimum)
    ends = np.repeat(starts + lens, lens)
    low[:size][np.arange(size) + SPAN > ends] = 0
    low[size:] = 0
    # A position is sampled if some window that holds it has it for its least: look back over those windows.
    reach = _slide(low[::-1], SPAN - K + 1, np.maximum)[::-1]
    at = np.flatnonzero(reach[:size] == key[:size])
    doc = np.repeat(np.arange(len(texts)), lens)[at]
    pos, left, right = at - starts[doc], at - starts[doc], starts[doc] + lens[doc] - at - K
    rows = np.zeros(at.size, SUFFIX)
    rows["pos"] = pos
    keys = np.empty((at.size, K + DIGEST), np.uint8)
    keys[:, :K] = np.lib.stride_tricks.sliding_window_view(data, K)[at]
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    x, y = np.minimum(left, REACH), np.minimum(right, REACH)
    seeds = x * 256 + y  # reaches of different shape never compare equal
    spans = zip((at - x).tolist(), (at + K + y).tolist(), seeds.tolist(), strict=True)
    keys[:, K:] = np.frombuffer(b"".join([digest(view[p:q], s) for p, q, s in spans]), np.uint8).reshape(-1, DIGEST)
    rows["key"] = keys.view(rows["key"].dtype).ravel()
    some = left >= HALF
    i = at[some]
    rows["before"][some] = np.maximum((_mix(h[32][i - HALF], 11) + h[2][i - 2]) >> np.uint64(32), 1)
    some = right >= HALF
    i = at[some]
    rows["behind"][some] = np.maximum((_mix(h[32][i + K], 13) + h[2][i + K + 32]) >> np.uint64(32), 1)
    return rows, doc


def _grams(rows: np.ndarray) -> np.ndarray:
    """The first K bytes of each suffix as rows of 64-bit words."""
    return np.ascontiguousarray(rows["key"]).view(np.uint8).reshape(-1, K + DIGEST)[:, :K].copy().view(np.uint64)


def suffix_array(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in the order of their bytes, the earliest of each reach, and the later ones."""
    rows = rows[np.lexsort((rows["pos"], rows["twin"], rows["id"]))]
    rows = rows[np.argsort(rows["key"], kind="stable")]
    again = np.r_[False, rows["key"][1:] == rows["key"][:-1]] if rows.size else np.zeros(0, bool)
    return rows[~again], rows[again]


def _earlier(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """True where a row of ``a`` comes before the one of ``b`` beside it."""
    same_id, same_twin = a["id"] == b["id"], a["twin"] == b["twin"]
    return (a["id"] < b["id"]) | (same_id & ((a["twin"] < b["twin"]) | (same_twin & (a["pos"] < b["pos"]))))


class LevelFamily:
    """Suffix arrays without a common reach whose sizes double from level to level."""

    def __init__(self):
        self.levels: dict[int, np.ndarray] = {}
        self.later: list[np.ndarray] = []

    def add(self, batch: np.ndarray) -> None:
        array, later = suffix_array(batch)
        self.later.append(later)
        for level in self.levels.values():
            array = self._scan(array, level)
        n = max(array.size, 1).bit_length()
        while n in self.levels:  # sorted arrays without a common key: each goes to its place in the other
            old = self.levels.pop(n)
            array = np.insert(old, np.searchsorted(old["key"], array["key"]), array)
            n = max(n + 1, array.size.bit_length())
        self.levels[n] = array

    def _scan(self, array: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Settle the later of each match between a new array and a level, which keeps the earlier one; returns the rest."""
        if not array.size or not level.size:
            return array
        at = np.minimum(np.searchsorted(level["key"], array["key"]), level.size - 1)
        match = level["key"][at] == array["key"]
        new, at = array[match], at[match]
        old = level[at]
        first = _earlier(new, old)
        self.later.append(np.where(first, old, new))
        level[at[first]] = new[first]
        return array[~match]

    def settled(self) -> np.ndarray:
        """Every suffix settled since the last call."""
        later, self.later = self.later, []
        return np.concatenate([np.zeros(0, SUFFIX), *later])

    def close(self) -> np.ndarray:
        """The suffixes of all levels."""
        return np.concatenate([np.zeros(0, SUFFIX), *self.levels.values()])


def edge_suffixes(array: np.ndarray) -> list[np.ndarray]:
    """Suffixes that may share SPAN bytes with another of different reach: those that agree on half a reach before, and behind."""
    words = _grams(array)
    gram = np.zeros(array.size, np.uint64)
    for n in range(K // 8):
        gram = _mix(gram + words[:, n], 41 + n)
    out = []
    for side, salt in (("before", 17), ("behind", 19)):
        has = np.flatnonzero(array[side] > 0)
        key = _mix(gram[has] + _mix(array[side][has].astype(np.uint64), salt), salt)
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        out.append(array[has[counts[inverse] > 1]])
    return out


def edge_intervals(window: np.ndarray, left: np.ndarray, right: np.ndarray, reaches: range) -> list[tuple[int, int]]:
    """(row, bytes before the suffix) of each SPAN-byte string that an earlier row holds at the same offset, for offsets in ``reaches``.

    ``window``: rows of REACH + SPAN bytes with the K shared ones in the middle, the earliest
    row first; ``left`` and ``right`` of the REACH bytes beside these are of the text. Rows are
    grouped by hashes, and a group's bytes are compared with its first row's.
    """
    n, found = len(window), []
    prefix = {}
    gram = np.zeros(n, np.uint64)
    for c in range(K):
        gram = _mix(gram + window[:, REACH + c] + np.uint64(1), c)
    for side, columns in ((0, window[:, :REACH][:, ::-1]), (1, window[:, REACH + K :])):
        lengths = {x if side == 0 else REACH - x for x in reaches}
        h = np.zeros(n, np.uint64)
        for c in range(max(lengths) + 1):
            if c in lengths:
                prefix[side, c] = h
            if c < REACH:
                h = _mix(h + columns[:, c] + np.uint64(1), c)
    for x in reaches:
        ok = np.flatnonzero((left >= x) & (right >= REACH - x))
        key = _mix(gram[ok] + _mix(prefix[0, x][ok], 23), 29) + _mix(prefix[1, REACH - x][ok], 31)
        by = np.argsort(key, kind="stable")
        if by.size < 2:
            continue
        again = np.r_[False, key[by][1:] == key[by][:-1]]
        first = ok[by[np.maximum.accumulate(np.where(again, 0, np.arange(by.size)))]]
        row, first = ok[by[again]], first[again]
        a, b = REACH - x, REACH - x + SPAN
        equal = (window[row, a:b] == window[first, a:b]).all(axis=1)
        found += [(i, x) for i in row[equal].tolist()]
        if not equal.all():  # different strings of one hash: told apart by their bytes
            seen = set()
            for i in ok.tolist():
                text = window[i, a:b].tobytes()
                if text in seen:
                    found.append((i, x))
                seen.add(text)
    return found


def _utf8(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


PIECE = "bucket int, kind int, id long, twin long, spot long, body binary"


def _piece(**columns) -> pa.RecordBatch:
    types = {"bucket": pa.int32(), "kind": pa.int32(), "id": pa.int64(), "twin": pa.int64(), "spot": pa.int64(), "body": pa.binary()}
    n = len(columns["bucket"])
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()], list(types))


def _pack(start, stop):
    return start.astype(np.int64) * (1 << 32) + stop.astype(np.int64)


def _covered(rows: np.ndarray) -> np.ndarray:
    """Packed byte intervals of settled suffixes; ends beyond the text are cut later."""
    pos = rows["pos"].astype(np.int64)
    return _pack(np.maximum(pos - REACH, 0), pos + SPAN)


def _pieces(rows: np.ndarray, buckets: int):
    """Pieces to send on of one batch: settled suffixes, and each bucket's part of the suffix array."""
    rows, later = suffix_array(rows)
    if later.size:
        spread = (np.arange(later.size) * 7919 + rows.size) % buckets
        yield _piece(bucket=spread, kind=np.full(later.size, KIND_LATER), id=later["id"], twin=later["twin"], spot=_covered(later))
    words = _grams(rows)
    bucket = (_mix(_mix(words[:, 0] + _mix(words[:, 1], 3), 5) + _mix(words[:, 2] + _mix(words[:, 3], 7), 9), 11) >> np.uint64(20)) % np.uint64(buckets)
    by = np.argsort(bucket, kind="stable")  # each bucket's part stays in the order of the bytes
    rows, bucket = rows[by], bucket[by]
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, bucket.size]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            body = b"".join(rows[name][a:b].tobytes() for name in SUFFIX.names)
            yield _piece(bucket=[int(bucket[a])], kind=[0], body=[body])


def _map_batches(buckets: int):
    def run(batches):
        for batch in batches:
            ids, twins, column = batch.column("id").to_numpy(), batch.column("twin").to_numpy(), batch.column("text").cast(pa.binary())
            parts, held, lo = [], 0, 0
            while lo < batch.num_rows:
                texts, size = [], 0
                while lo + len(texts) < batch.num_rows and (not texts or size <= CHUNK_BYTES):
                    texts.append(column[lo + len(texts)].as_py())
                    size += len(texts[-1])
                rows, doc = sample_suffixes(texts)
                rows["id"], rows["twin"] = ids[lo : lo + len(texts)][doc], twins[lo : lo + len(texts)][doc]
                parts.append(rows)
                held += rows.size
                lo += len(texts)
                if held >= BATCH_ROWS:
                    yield from _pieces(np.concatenate(parts), buckets)
                    parts, held = [], 0
            if parts:
                yield from _pieces(np.concatenate(parts), buckets)

    return run


def _unpack(body: bytes) -> np.ndarray:
    n = len(body) // SUFFIX.itemsize
    out, at = np.zeros(n, SUFFIX), 0
    for name in SUFFIX.names:
        kind = SUFFIX[name]
        out[name] = np.frombuffer(body, kind, n, at)
        at += n * kind.itemsize
    return out


def _told(kind: int, rows: np.ndarray, spot: np.ndarray):
    for lo in range(0, rows.size, 50_000):
        part = rows[lo : lo + 50_000]
        yield _piece(bucket=np.zeros(part.size, int), kind=np.full(part.size, kind), id=part["id"], twin=part["twin"], spot=spot[lo : lo + 50_000])


def _reduce_batches(batches):
    family, parts, held = LevelFamily(), [], 0
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        old = batch.filter(pa.array(kind == KIND_LATER))
        if old.num_rows:
            yield _piece(bucket=np.zeros(old.num_rows, int), kind=np.full(old.num_rows, KIND_LATER), **{c: old.column(c).to_numpy() for c in ("id", "twin", "spot")})
        body = batch.column("body")
        for n in np.flatnonzero(kind == 0).tolist():
            parts.append(_unpack(body[n].as_py()))
            held += parts[-1].size
            if held >= BATCH_ROWS:
                family.add(np.concatenate(parts))
                parts, held = [], 0
                later = family.settled()
                yield from _told(KIND_LATER, later, _covered(later))
    if parts:
        family.add(np.concatenate(parts))
    later = family.settled()
    yield from _told(KIND_LATER, later, _covered(later))
    for kind, rows in zip((KIND_BEFORE, KIND_BEHIND), edge_suffixes(family.close()), strict=True):
        yield from _told(kind, rows, rows["pos"].astype(np.int64))


def _edge_bytes(batches):
    """The reach of each edge suffix, dealt by its K bytes and half a reach on the side that agrees with another."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("bucket", "kind", "id", "twin", "spot", "body")}

        def emit():
            made = _piece(**out)
            for held in out.values():
                held.clear()
            return made

        for text, spots, key, twin in zip(_utf8(batch), batch.column("spots").to_pylist(), batch.column("id").to_pylist(), batch.column("twin").to_pylist(), strict=True):
            for spot in set(spots):
                p, kind = spot >> 2, spot & 3
                near = text[p - HALF : p + K] if kind == KIND_BEFORE else text[p : p + K + HALF]
                out["bucket"].append(xxhash.xxh32_intdigest(near, kind) >> 1)
                out["kind"].append(kind)
                out["id"].append(key)
                out["twin"].append(twin)
                out["spot"].append(p)
                out["body"].append(text[max(p - REACH, 0) : p + SPAN])
            if len(out["id"]) >= 50_000:
                yield emit()
        yield emit()


def _edge_matches(batches):
    """Repeated strings among the rows of each bucket and side; the stream is sorted by bucket, and some whole buckets are read at a time."""
    for table in tables(batches, "bucket", least=MATCH_ROWS):
        ids, twins, spots, kinds = (table.column(c).to_numpy() for c in ("id", "twin", "spot", "kind"))
        order = np.lexsort((spots, twins, ids))
        ids, twins, spots, kinds = ids[order], twins[order], spots[order], kinds[order]
        bodies = table.column("body").to_pylist()
        left = np.minimum(spots, REACH)
        window = np.zeros((order.size, REACH + SPAN), np.uint8)
        size = np.empty(order.size, np.int64)
        for i, n in enumerate(order.tolist()):
            at = REACH - int(left[i])
            size[i] = len(bodies[n])
            window[i, at : at + size[i]] = np.frombuffer(bodies[n], np.uint8)
        del bodies
        right = size - left - K
        for kind, reaches in ((KIND_BEFORE, range(HALF, REACH + 1)), (KIND_BEHIND, range(HALF + 1))):
            of = np.flatnonzero(kinds == kind)
            found = edge_intervals(window[of], left[of], right[of], reaches)
            row = of[np.array([i for i, _ in found], np.int64)]
            start = spots[row] - np.array([x for _, x in found], np.int64)
            yield _piece(bucket=np.zeros(row.size, int), kind=np.full(row.size, KIND_LATER), id=ids[row], twin=twins[row], spot=_pack(start, start + SPAN))


def cut(text: bytes, spots: list[int] | None) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs of ``text``, and what is left of it."""
    runs: list[list[int]] = []
    for spot in sorted(set(spots or ())):
        a, b = spot >> 32, min(spot & 0xFFFFFFFF, len(text))
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return [(a, b) for a, b in runs], b"".join([*kept, text[at:]])


def _cut_batches(batches):
    for batch in batches:
        out = []
        for text, spots in zip(_utf8(batch), batch.column("spots").to_pylist(), strict=True):
            runs, kept = cut(text, spots)
            out.append((len(text), sum(b - a for a, b in runs), len(runs), runs, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        runs = pa.array([[{"start": a, "stop": b} for a, b in r] for r in cols[3]], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(c, pa.int64()) for c in cols[:3]), runs, pa.array(cols[4], pa.string())],
            ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"],
        )


def _distinct_rows(source: DataFrame) -> DataFrame:
    """``source`` with one row of each (id, twin); only rows that repeat are dealt out."""
    key = ["id", "twin"]
    copies = materialize(source.groupBy(key).count().filter("count > 1").select(key), "repeated-rows")
    if copies.isEmpty():
        return source
    return source.join(copies, key, "left_anti").unionAll(source.join(copies, key, "left_semi").groupBy(key).agg(F.min("text").alias("text")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, spans, kept_sha256 for every row.

    A byte goes if a SPAN-byte string over it also starts earlier: in a document of smaller id,
    or earlier in the same one. Texts are UTF-8 bytes; null counts as empty; texts under SPAN
    bytes lose nothing. Rows that share id and text are one document and get equal results;
    rows that share only the id are ordered by a hash of their text; a null id is the least.
    ``spans`` are the removed byte ranges. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), text.alias("text"))
    # The text's hash tells rows of a repeated id apart; without such ids it would only fill the disk.
    unique = source.groupBy("id").count().filter("count > 1").isEmpty()
    source = source.select("id", (F.lit(0).cast("long") if unique else text_mark("text")).alias("twin"), "text")
    distinct = source if unique else _distinct_rows(source)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * 16
    sampled = distinct.mapInArrow(_map_batches(buckets), PIECE)
    scanned = materialize(sampled.repartition(parts, "bucket").mapInArrow(_reduce_batches, PIECE).select("kind", "id", "twin", "spot"), "suffix-scan")

    def per_document(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id", "twin").agg(F.collect_list("spot").alias("spots"))

    edges = scanned.filter(F.col("kind") != KIND_LATER).withColumn("spot", F.shiftleft("spot", 2) + F.col("kind"))
    fetched = distinct.join(per_document(edges), ["id", "twin"], "left").filter("spots is not null").mapInArrow(_edge_bytes, PIECE)
    dealt = fetched.repartition(parts, "bucket").sortWithinPartitions("bucket")
    matched = dealt.mapInArrow(_edge_matches, PIECE).select("kind", "id", "twin", "spot")
    removed = per_document(scanned.filter(F.col("kind") == KIND_LATER).unionAll(matched))
    out = source.join(removed, ["id", "twin"], "left").mapInArrow(
        _cut_batches, "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept_sha256 string"
    )
    return out.withColumn("id", F.nullif("id", F.lit(-(1 << 63)))).withColumnRenamed("id", id_col)
