"""Byte-level BPE by corpus-level merge replay.

The corpus of a task comes in pieces of a bounded number of bytes. The distinct pre-tokens of a
piece that the task has not met yet are laid end to end, an inverted index maps every mergeable
token pair to the positions holding it, and merges are applied in rank order to all positions at
once. Only the neighbours of a merged position get a new index entry. Work is per distinct
pre-token of a task, so copies cost a dictionary lookup.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.llm.rows import frugal

NEVER = 1 << 30
EDGE, GONE = -1, -2
#: Characters of the texts that are merged together (one text at least), and rows of an output batch.
CORPUS_CHARS, OUT_ROWS = 4 << 20, 512
#: Positions whose pairs are looked up at a time.
BLOCK = 1 << 16
#: Distinct pre-tokens, and characters of them, that a task remembers; beyond either it starts anew.
KNOWN_WORDS, KNOWN_CHARS = 200_000, 8 << 20


class Merges:
    """Rank file as lookup tables; ``content`` is the file's bytes."""

    def __init__(self, content: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        self.size = max(self.rank.values()) + 1
        self.token = [b""] * self.size
        for text, rank in self.rank.items():
            self.token[rank] = text
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for text, rank in self.rank.items():
            for cut in range(1, len(text)):
                left, right = self.rank.get(text[:cut]), self.rank.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.forget()

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NEVER where there is none."""
        out = np.empty(left.size, np.int32)
        for lo in range(0, left.size, BLOCK):  # the keys of all positions at once would be the largest arrays of a replay
            a, b = left[lo : lo + BLOCK], right[lo : lo + BLOCK]
            key = np.where((a < 0) | (b < 0), -1, a.astype(np.int64) * self.size + b)
            at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
            out[lo : lo + BLOCK] = np.where(self.keys[at] == key, self.merged[at], NEVER)
        return out

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of ``words`` laid end to end, and each word's token count."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lens + 1)
        total = int(ends[-1])
        tok = np.full(total + 1, EDGE, np.int32)
        tok[np.arange(data.size) + np.repeat(np.arange(len(words)), lens)] = self.byte[data]
        place = np.int32 if total < NEVER else np.int64
        after = np.minimum(np.arange(1, total + 2, dtype=place), total)
        before = np.arange(-1, total, dtype=place)
        before[0] = total
        due = np.full(total + 1, NEVER, np.int32)
        due[:-1] = self.of(tok[:-1], tok[1:])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(positions, cuts), strict=True):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(heap, rank)

        if (some := np.flatnonzero(due < NEVER).astype(place)).size:
            file(some, due[some])
        while heap:
            rank = heapq.heappop(heap)
            parts = index.pop(rank)
            p = parts[0] if len(parts) == 1 else np.concatenate(parts)
            p = np.unique(p[due[p] == rank])
            if not p.size:
                continue
            n = after[p]
            if p.size > 1 and (chained := np.r_[False, n[:-1] == p[1:]]).any():
                at = np.arange(p.size)  # in a run of overlapping pairs the leftmost goes first
                keep = (at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0
                p, n = p[keep], n[keep]
            tok[p], tok[n], due[n] = rank, GONE, NEVER
            nn = after[n]
            after[p], before[nn] = nn, p
            touched = np.concatenate((p, before[p]))
            ranks = self.of(tok[touched], tok[after[touched]])
            due[touched] = ranks
            if (live := ranks < NEVER).any():
                file(touched[live], ranks[live])
        alive = tok[:-1] >= 0
        counts = np.add.reduceat(alive, ends - lens - 1)
        return tok[:-1][alive], counts.astype(np.int64)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.flat, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def encode(self, texts: list[str | None], split: regex.Pattern) -> list[np.ndarray]:
        """Token ids of each text; null gives none."""
        if len(self.known) > KNOWN_WORDS or self.chars > KNOWN_CHARS:
            self.forget()
        known, old = self.known, len(self.known)
        docs = [np.array([known.setdefault(w, len(known)) for w in split.findall(t or "")], np.int32) for t in texts]
        fresh = list(islice(known, old, None))  # a dict keeps its order
        self.chars += sum(map(len, fresh))
        raw = [w.encode() for w in fresh]
        whole = np.array([self.rank.get(w, -1) for w in raw], np.int32)
        todo = np.flatnonzero(whole < 0)
        made, made_n = self.replay([raw[i] for i in todo.tolist()])
        count = np.ones(len(raw), np.int32)
        count[todo] = made_n
        start = np.cumsum(count, dtype=np.int64) - count
        flat = np.repeat(whole, count)
        flat[np.repeat(start[todo] - (np.cumsum(made_n) - made_n), made_n) + np.arange(made.size)] = made
        self.flat, self.count = np.concatenate((self.flat, flat)), np.concatenate((self.count, count))
        count, flat = self.count, self.flat
        start = np.cumsum(count, dtype=np.int64) - count
        out = []
        for words in docs:
            n = count[words]
            ids = flat[np.repeat(start[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            out.append(ids.astype("<u4"))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def pieces(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows of up to CORPUS_CHARS characters, or of one longer text."""
    size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    cuts, held = [0], 0
    for i, n in enumerate(size.tolist()):
        if held + n > CORPUS_CHARS and i > cuts[-1]:
            cuts.append(i)
            held = 0
        held += n
    return [(a, b) for a, b in zip(cuts, [*cuts[1:], len(texts)], strict=True) if b > a]


@lru_cache(2)
def _merges(content: bytes) -> Merges:
    return Merges(content)


def encode_decode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens long, ids binary, decoded binary)`` for every row.

    ``ids`` are little-endian unsigned 32-bit integers as the reference tokenizer library gives
    for ordinary text (no special tokens); ``decoded`` is what those ids decode to. Null and
    empty texts give no ids; repeated rows are kept; other columns are ignored. The rank file
    (``vocabulary``, read on the driver, under 1 MB) is broadcast.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches):
        table, split = _merges(content.value), regex.compile(pattern)
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                ids = table.encode(part.column("text").to_pylist(), split)
                for at in range(0, len(ids), OUT_ROWS):
                    piece = [x.tobytes() for x in ids[at : at + OUT_ROWS]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id").slice(at, OUT_ROWS),
                            pa.array([len(x) // 4 for x in piece], pa.int64()),
                            pa.array(piece, pa.binary()),
                            pa.array([table.decode(x) for x in piece], pa.binary()),
                        ],
                        ["id", "n_tokens", "ids", "decoded"],
                    )
        table.forget()  # an idle worker keeps the table, not the words of a task

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = source.mapInArrow(frugal(run), "id long, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def token_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Digest columns of ``encode_decode``: n_tokens, ids_sha256, decoded_sha256."""
    made = encode_decode(docs, vocabulary, pattern)
    return made.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
