"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

A logistic model over the hashed presence of words and word beginnings is fitted from confirmed
toxic texts and unlabelled texts alone. With class prior p, the risk is p*R_pos(+) + max(0, R_unl(-) - p*R_pos(-)); when
the bracket turns negative its gradient is reversed. Soft thresholding zeroes the weights of
words that carry no evidence, so long texts don't gather noise.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairtrace.llm.labelled import held_out, join_texts, label_table, lowest_hashes, remainder

BITS = 20
#: Bounds of the fitting sample, in rows of the label table.
POSITIVE_ROWS, UNLABELLED_ROWS = 3_000, 8_000
#: Bytes of the word beginnings that are features beside the whole word.
BEGINNINGS = (3, 4, 5)

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> set[bytes]:
    """Distinct words of a whole text: runs of letters, digits and non-ASCII bytes, A-Z lower-cased."""
    return set((text or "").encode().translate(_LOWER).split())


def features(found: set[bytes]) -> set[bytes]:
    """Whole words, and marked beginnings."""
    return found.union(*({b"^" + w[:n] for w in found} for n in BEGINNINGS))


def codes(text: str | None) -> np.ndarray:
    """Sorted hash codes of a text's features."""
    found = features(words(text))
    return np.unique(np.fromiter(map(zlib.crc32, found), np.int64, len(found)) & ((1 << BITS) - 1))


@dataclass(frozen=True)
class WordModel:
    """Words by hash code: ``code`` sorted, ``weight`` beside it."""

    bias: float
    code: np.ndarray
    weight: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        table = dict(zip(self.code.tolist(), self.weight.tolist(), strict=True))
        mask = (1 << BITS) - 1
        held: dict[bytes, tuple] = {}  # a word's codes that carry weight
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found: set[int] = set()
            for word in words(text):
                hit = held.get(word)
                if hit is None:
                    hit = tuple(c for f in features({word}) if (c := zlib.crc32(f) & mask) in table)
                    if len(held) < 500_000:
                        held[word] = hit
                if hit:
                    found.update(hit)
            out[i] = self.bias + sum(table[c] for c in sorted(found))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def risk_parts(z: np.ndarray, is_p: np.ndarray, prior: float) -> tuple[float, float]:
    """Risk of the positives, and of the negatives as estimated from unlabelled less positive rows; the second may be negative."""
    plus, minus = np.logaddexp(0, -z), np.logaddexp(0, z)  # losses of a row that is positive and of one that is negative
    return float(prior * plus[is_p].mean()), float(minus[~is_p].mean() - prior * minus[is_p].mean())


def risk_gradient(z: np.ndarray, is_p: np.ndarray, prior: float) -> np.ndarray:
    """By each margin: of both parts' sum, or, where the second part is negative, the reversed one of that part alone."""
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    n_p, n_u = is_p.sum(), (~is_p).sum()
    plus = np.where(is_p, prior * (p - 1) / n_p, 0)
    minus = np.where(is_p, -prior * p / n_p, p / n_u)
    return plus + minus if risk_parts(z, is_p, prior)[1] >= 0 else -minus


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 200, rate: float = 0.1, shrink: float = 2e-3, apart: float = 0.01, sigmas: float = 5.0) -> WordModel:
    """Full-batch Adam on the non-negative risk over codes whose shares in the two samples differ by ``apart`` and beyond chance.

    Without positive or unlabelled texts the score is the prior (0.5 where that is unknown too).
    """
    prior = min(max(prior, 1e-3), 0.999)
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return WordModel(bias, np.zeros(0, np.int64), np.zeros(0))
    flat = np.concatenate([*positive, *unlabelled])
    lens = np.array([len(x) for x in (*positive, *unlabelled)])
    n_p, n_u = len(positive), len(unlabelled)
    first = int(lens[:n_p].sum())
    share_p, share_u = (np.bincount(x, minlength=1 << BITS) / n for x, n in ((flat[:first], n_p), (flat[first:], n_u)))
    both = (share_p * n_p + share_u * n_u) / (n_p + n_u)
    chance = sigmas * np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    code = np.flatnonzero(np.abs(share_p - share_u) >= np.maximum(apart, chance))
    column = np.full(1 << BITS, -1)
    column[code] = np.arange(code.size)
    inverse = flat
    cell, row = column[inverse], np.repeat(np.arange(len(lens)), lens)
    row, cell = row[cell >= 0], cell[cell >= 0]
    is_p = np.arange(len(lens)) < n_p
    w, b = np.zeros(code.size), bias
    m, v = np.zeros(code.size + 1), np.zeros(code.size + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[cell], len(lens)) + b
        g = risk_gradient(z, is_p, prior)
        grad = np.r_[np.bincount(cell, g[row], code.size), g.sum()]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
        w, b = w - step[:-1], b - step[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * shrink * 10, 0)
    return WordModel(float(b), code[w != 0], w[w != 0])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", modulus: int = 4, held: int = 2, positives: int = POSITIVE_ROWS, unlabelled: int = UNLABELLED_ROWS, text_col: str = "text") -> WordModel:
    """Model from at most ``positives`` confirmed toxic rows and ``unlabelled`` rows, none of them held out.

    Both samples are of rows of the label table; the second is drawn without a look at the label,
    so it stands for unlabelled text. The class prior is the share of label 1 over all usable
    labels. Only hashed word codes of the two bounded samples reach the driver.
    """
    known = label_table(labels, label_col).filter(remainder("id", modulus) != held)
    share = known.agg(F.avg((F.col("label") > 0).cast("double"))).first()[0]
    parts = [
        lowest_hashes(known.filter("label > 0").select("id"), positives, 23).withColumn("kind", F.lit(1)),
        lowest_hashes(known.select("id"), unlabelled, 29).withColumn("kind", F.lit(0)),
    ]

    def run(batches):
        for batch in batches:
            made = [codes(t).astype(np.int32).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.binary())], ["id", "codes"])

    found = [
        sorted(join_texts(docs, part.drop("kind"), text_col).mapInArrow(run, "id long, codes binary").collect())
        for part in parts
    ]
    p, u = ([np.frombuffer(r.codes, np.int32).astype(np.int64) for r in rows] for rows in found)
    return fit(p, u, 0.5 if share is None else float(share))


def score_toxicity(docs: DataFrame, model: WordModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), in place of any of that name, from each whole text; null and empty texts get the model's bias."""
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in docs.schema.fields]
    schema = docs.withColumn("toxicity", F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            made = shared.value.score(batch.column(names.index(text_col)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], [*batch.schema.names, "toxicity"])

    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; labels, lang, source and id never enter a score.

    Without confirmed toxic rows every score is the prior (0.5 where no label is usable). Null
    and empty texts get the model's bias; texts of any length are scored in whole. Repeated and
    null ids keep their rows (a null id is not held out); of repeated labels the largest counts;
    other columns are ignored, whatever their names; an empty table gives no rows.
    """
    model = train(docs, labels)
    scored = score_toxicity(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return scored.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= threshold).cast("int").alias("predicted")
    )
