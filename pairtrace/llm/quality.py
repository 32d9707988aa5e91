"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are complete binary trees in heap order, flattened to arrays of feature, threshold and
leaf value, so scoring a batch is ``depth`` gathers per tree over all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.llm.labelled import held_out, join_texts, label_table, lowest_hashes, remainder
from pairtrace.llm.rows import frugal, slices

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "mean_word", "sd_word", "upper", "digit", "symbol", "space", "high_byte",
    "bang", "pipe", "distinct_words", "distinct_bigrams", "top_word", "stutter", "symbol_tail_words", "upper_words",
    "short_words", "words_per_line", "repeated_lines", "longest_word", "control", "stop_marks",
)

#: The sample that the trees are fitted on holds at most so many labelled rows.
TRAIN_ROWS = 20_000

_KIND = np.zeros(256, np.int64)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[128:] = 5
_KIND[[i for i in range(32) if i not in (9, 10, 11, 12, 13)]] = 6


def statistics(text: str | None) -> np.ndarray:
    """The STATISTICS of one whole text; null counts as empty."""
    raw = (text or "").encode()
    out = np.zeros(len(STATISTICS))
    if not raw:
        return out
    data = np.frombuffer(raw, np.uint8)
    counts = np.bincount(data, minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=7)
    n = data.size
    words, lines = raw.split(), raw.split(b"\n")
    m = max(len(words), 1)
    out[0], out[1], out[2] = np.log1p(n), np.log1p(len(words)), np.log1p(len(lines))
    out[5], out[6], out[7], out[8], out[9] = kinds[1] / n, kinds[3] / n, kinds[0] / n, kinds[4] / n, kinds[5] / n
    out[10], out[11], out[22] = counts[33] / n, counts[124] / n, kinds[6] / n
    out[23] = (counts[44] + counts[46]) / m
    out[19] = len(words) / len(lines)
    out[20] = 1 - len(set(lines)) / len(lines)
    if words:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        out[3], out[4], out[21] = lens.mean(), lens.std(), np.log1p(lens.max())
        out[18] = (lens <= 2).mean()
        code = np.fromiter(map(hash, words), np.int64, len(words))
        _, repeats = np.unique(code, return_counts=True)
        out[12], out[14] = repeats.size / m, repeats.max() / m
        if m > 1:
            out[13] = np.unique(code[:-1] * 31 + code[1:]).size / (m - 1)
            out[15] = (code[:-1] == code[1:]).mean()
        ends = np.cumsum(lens) - 1
        joined = np.frombuffer(b"".join(words), np.uint8)
        out[16] = (_KIND[joined[ends]] == 0).mean()
        out[17] = (_KIND[joined[ends - lens + 1]] == 1).mean()
    return out


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold``: (trees, inner nodes); ``value``: (trees, leaves)."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            margin += value[at - len(feature)]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss on histograms of quantile bins; no rows gives score 0.5."""
    inner, d = 2**depth - 1, len(STATISTICS)
    if not len(x):
        return Trees(0.0, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    codes = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    rate_of = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(rate_of / (1 - rate_of)))
    margin = np.full(len(x), base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            best, pick = np.full(wide, 1e-6), np.full((wide, 2), -1)
            for j in range(d):
                cell = (node - first) * bins + codes[j]
                gs = np.bincount(cell, g, wide * bins).reshape(wide, bins).cumsum(1)
                hs = np.bincount(cell, h, wide * bins).reshape(wide, bins).cumsum(1)
                G, H = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (G - gs) ** 2 / (H - hs + ridge) - G**2 / (H + ridge)
                gain[:, len(edges[j]) :] = -1
                gain[(hs < 1) | (H - hs < 1)] = -1
                at = gain.argmax(1)
                top = gain[np.arange(wide), at]
                better = top > best
                best[better], pick[better, 0], pick[better, 1] = top[better], j, at[better]
            for k in np.flatnonzero(pick[:, 0] >= 0).tolist():
                feature[first + k], threshold[first + k] = pick[k, 0], edges[pick[k, 0]][pick[k, 1]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[leaf]
        features.append(feature), thresholds.append(threshold), values.append(value)
    return Trees(base, depth, np.array(features), np.array(thresholds), np.array(values))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", modulus: int = 5, held: int = 0, bound: int = TRAIN_ROWS, text_col: str = "text") -> Trees:
    """Trees fitted on at most ``bound`` labelled rows whose crc32 remainder is not ``held``.

    Only the sample's statistics (24 numbers a row) reach the driver.
    """
    known = label_table(labels, label_col).filter(remainder("id", modulus) != held)
    sample = join_texts(docs, lowest_hashes(known, bound, 17), text_col)

    def run(batches):
        for batch in slices(batches):
            x = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([r.tolist() for r in x], pa.list_(pa.float64()))], ["id", "label", "x"])

    rows = sorted(sample.select("id", "label", "text").mapInArrow(frugal(run), "id long, label int, x array<double>").collect())
    x = np.array([r.x for r in rows]).reshape(-1, len(STATISTICS))
    return fit(x, np.array([float(r.label > 0) for r in rows]))


def score_quality(docs: DataFrame, trees: Trees, text_col: str = "text", into: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``into`` (0 to 1), in place of any of that name, from each whole text; null and empty texts are scored too."""
    docs = docs.drop(into)
    model = docs.sparkSession.sparkContext.broadcast(trees)
    names = [f.name for f in docs.schema.fields]
    schema = docs.withColumn(into, F.lit(0.0)).schema

    def run(batches):
        for batch in slices(batches):
            x = np.array([statistics(t.as_py()) for t in batch.column(names.index(text_col))]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.value.score(x))], [*batch.schema.names, into])

    return docs.mapInArrow(frugal(run), schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; labels, lang, source and id never enter a score.

    Without usable labels every score is 0.5. Null and empty texts are scored like any other, and
    texts of any length in whole. Repeated and null ids keep their rows (a null id is not held
    out); of repeated labels the largest counts; other columns are ignored, whatever their names;
    an empty table gives no rows.
    """
    trees = train(docs, labels)
    scored = score_quality(docs.select("doc_id", F.col("text").cast("string").alias("text")), trees)
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).cast("int").alias("predicted")
    )
