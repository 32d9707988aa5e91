"""Exact top-k inner products: tiles of queries times tiles of shards, merged as a tree."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairtrace.functions.shared import materialize

#: Most vectors of a tile, and most components of one: longer vectors make smaller tiles.
TILE_ROWS, QUERY_ROWS, TILE_NUMBERS = 4096, 1024, 1 << 20
#: Bytes of query tiles that a task holds while shard tiles stream by, as doubles.
HELD_BYTES = 16 << 20
TILE_SCHEMA = "dim int, tile long, n int, item string, ids binary, body binary"
#: Scores beyond it are ties: what a decimal(38) holds.
MOST_SCORE = 10**38 - 1
_LIMB = 20


def usable(vector: str) -> Column:
    """True where the vector is present, not empty, and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def one_row_each(rows: DataFrame) -> DataFrame:
    """``rows`` (id, v, is_query) with one row of each id: of rows that share it, the one of least vector.

    Only ids that repeat are dealt out with their vectors; usually none does.
    """
    repeated = materialize(rows.groupBy("id").count().filter("count > 1").select("id"), "repeated-vectors")
    if repeated.isEmpty():
        return rows
    least = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("v", "is_query")).alias("r")).select("id", "r.v", "r.is_query")
    return rows.join(repeated, "id", "left_anti").unionAll(least)


def _narrow(body: np.ndarray) -> np.ndarray:
    """The same integers in the smallest of int16, int32 and float64 that holds them."""
    most = np.abs(body).max(initial=0)
    return body.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def pack(vectors: DataFrame, most: int) -> DataFrame:
    """Rows (id, v) to tiles of at most ``most`` integer vectors of one length, ids ascending within a tile."""

    def run(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def emit(dim, ids, body):
            nonlocal made
            order = np.argsort(ids, kind="stable")
            made += 1
            body = _narrow(body[order])
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()), "tile": [part * (1 << 32) + made], "n": pa.array([len(ids)], pa.int32()),
                    "item": [body.dtype.str], "ids": [ids[order].tobytes()], "body": [body.tobytes()],
                }
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            lists = batch.column("v")
            lens = np.diff(lists.offsets.to_numpy())
            flat = np.floor(256.0 * lists.flatten().to_numpy().astype(np.float64))
            starts = np.cumsum(lens) - lens
            for dim in np.unique(lens).tolist():
                rows = max(1, min(most, TILE_NUMBERS // dim))
                at = np.flatnonzero(lens == dim)
                body = flat[starts[at][:, None] + np.arange(dim)]
                old = held.pop(dim, None)
                all_ids, all_body = (ids[at], body) if old is None else (np.r_[old[0], ids[at]], np.vstack((old[1], body)))
                while len(all_ids) >= rows:
                    yield emit(dim, all_ids[:rows], all_body[:rows])
                    all_ids, all_body = all_ids[rows:], all_body[rows:]
                if len(all_ids):
                    held[dim] = (all_ids, all_body)
        for dim, (ids, body) in held.items():
            yield emit(dim, ids, body)

    return vectors.mapInArrow(run, TILE_SCHEMA)


def _limbs(m: np.ndarray) -> list[np.ndarray]:
    """Matrices of integers below 2**_LIMB in size, least first, whose weighted sum is ``m``; all steps are exact on doubles."""
    out = []
    while m.any():
        low = np.fmod(m, 2.0**_LIMB)
        out.append(low)
        m = (m - low) / 2.0**_LIMB
    return out or [m]


def exact_products(queries: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Inner products of rows of integer-valued doubles: int64 where the sums fit a double's 53 bits, else Python integers."""
    queries, body = queries.astype(np.float64), body.astype(np.float64)
    if float(np.abs(queries).max(initial=0)) * float(np.abs(body).max(initial=0)) * queries.shape[1] < 2.0**53:
        return (queries @ body.T).astype(np.int64)
    total = np.zeros((len(queries), len(body)), object)
    wide = 1 << (52 - 2 * _LIMB)  # so many products of limbs add up below 2**53
    for lo in range(0, queries.shape[1], wide):
        left, right = _limbs(queries[:, lo : lo + wide]), _limbs(body[:, lo : lo + wide])
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                total += (x @ y.T).astype(np.int64).astype(object) * (1 << (_LIMB * (i + j)))
    return total


def best_of(queries: np.ndarray, q_ids: np.ndarray, body: np.ndarray, ids: np.ndarray, k: int):
    """(query row, candidate row, score) of each query's k best in one tile; equal scores go to the smaller id. ``ids`` ascend."""
    scores = exact_products(queries, body)
    own = q_ids[:, None] == ids[None, :]
    n, take = len(ids), min(k, len(ids))
    if scores.dtype != object and np.abs(scores).max(initial=0) < 2**62 // (n + 1):
        order = scores * n + (n - 1 - np.arange(n))
        order[own] = order.min(initial=0) - 1
        picked = np.argpartition(order, n - take, axis=1)[:, n - take :]
    else:  # the first of equal scores is the smaller id; the own row comes last
        picked = np.array([heapq.nsmallest(take, range(n), key=lambda j, r=row, o=mine: (o[j], -int(r[j]), j)) for row, mine in zip(scores, own, strict=True)], np.int64).reshape(-1, take)
    rows, cols = np.repeat(np.arange(len(q_ids)), take), picked.ravel()
    keep = ~own[rows, cols]
    rows, cols = rows[keep], cols[keep]
    return rows, cols, scores[rows, cols]


def _merged(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query among (query id, vector id, score)."""
    by = np.lexsort((v, -s, q)) if s.dtype != object else np.array(sorted(range(len(q)), key=lambda i: (q[i], -s[i], v[i])), np.int64)
    q, v, s = q[by], v[by], s[by]
    first = np.r_[True, q[1:] != q[:-1]] if q.size else np.zeros(0, bool)
    rank = np.arange(q.size) - np.maximum.accumulate(np.where(first, np.arange(q.size), 0))
    return q[rank < k], v[rank < k], s[rank < k]


def _lanes(parts: int, shards: int, asked: int) -> tuple[int, int]:
    """(rows, columns) of a grid of about ``parts`` tasks: with this shape the fewest bytes are copied."""
    columns = max(1, min(parts, round(math.sqrt(parts * asked / max(shards, 1)))))
    return max(1, parts // columns), columns


def top_k(vectors: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", fan: int = 16) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's ``k`` best other rows by integer inner product.

    Components become floor(256 * x). Ties go to the smaller id; ranking is exact for scores of
    up to 38 digits, and a score beyond the range of long is given as the nearest long. Rows with
    null id, and vectors that are null, empty or hold null or non-finite components, take no
    part; a vector meets only those of its length. Rows that share an id count once, as the row
    of least vector. Further columns may have any name. An empty table gives no rows.

    Shard tiles and query tiles are dealt on a grid of lanes, so each side is copied along one
    axis only. In a lane a block of at most about ``HELD_BYTES`` of query tiles is held while the
    lane's shard tiles stream by, each sent once a block. Their top lists are merged there, and
    two windows merge the tasks'.
    Arrow batches are bounded by spark.sql.execution.arrow.maxBytesPerBatch.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(query, F.lit(False)).alias("is_query"))
    rows = one_row_each(rows.filter(F.col("id").isNotNull() & usable("v")))
    shards = materialize(pack(rows.select("id", "v"), TILE_ROWS), "shard-tiles")
    asked = materialize(pack(rows.filter("is_query").select("id", "v"), QUERY_ROWS), "query-tiles")
    sizes = [df.agg(F.coalesce(F.sum(F.col("n").cast("long") * F.col("dim")), F.lit(0))).first()[0] for df in (shards, asked)]
    down, across = _lanes(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), *sizes)
    lane = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "tile"), F.lit(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = max(1, math.ceil(8 * sizes[1] / across / HELD_BYTES))
    keys = ["dim", "row", "col", "block"]
    tile = ["tile", "item", "ids", "body"]
    right = asked.select("dim", lane(across, 2).alias("col"), lane(blocks, 3).alias("block"), F.lit(0).alias("kind"), *tile).withColumn("row", copies(down))
    left = shards.select("dim", lane(down, 1).alias("row"), F.lit(1).alias("kind"), *tile).withColumn("col", copies(across)).withColumn("block", copies(blocks))

    def run(batches):
        now, asking, found = None, [], []

        def flush():
            for q, v, s in (x for x in found if x is not None):
                far = s.dtype == object
                clipped = np.array([max(-(1 << 63), min((1 << 63) - 1, int(x))) for x in s], np.int64) if far else s
                exact = [str(max(-MOST_SCORE, min(MOST_SCORE, int(x)))) if far else None for x in s]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(clipped), pa.array(exact, pa.string())], ["query_id", "vec_id", "score", "beyond"])

        for batch in batches:
            for n in range(batch.num_rows):
                r = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                if (key := tuple(r[c] for c in keys)) != now:
                    yield from flush()
                    now, asking, found = key, [], []
                ids, body = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["body"], r["item"]).reshape(-1, r["dim"])
                if r["kind"] == 0:  # the block's queries come first and stay
                    asking.append((ids, body))
                    found.append(None)
                    continue
                for i, (q_ids, queries) in enumerate(asking):
                    a, b, s = best_of(queries, q_ids, body, ids, k)
                    new = (q_ids[a], ids[b], s)
                    found[i] = _merged(*(new if found[i] is None else (np.concatenate(x) for x in zip(found[i], new, strict=True))), k)
        yield from flush()

    dealt = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "kind")
    pairs = dealt.mapInArrow(run, "query_id long, vec_id long, score long, beyond string")
    # ``beyond`` has the true score as text where doubles could not hold the sums.
    true = F.coalesce(F.col("beyond").try_cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)"))
    order = [F.desc("true"), F.asc("vec_id")]
    some = Window.partitionBy("query_id", "branch").orderBy(*order)
    all_of = Window.partitionBy("query_id").orderBy(*order)
    part = pairs.withColumns({"true": true, "branch": F.pmod(F.xxhash64("vec_id"), F.lit(fan))}).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    best = part.withColumn("rank", F.row_number().over(all_of)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
