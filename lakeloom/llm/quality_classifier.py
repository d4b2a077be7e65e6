"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader.

Terms are lower-cased words, runs of symbols and bigrams of these, hashed to
2^``BITS`` places, each valued log(1 + count) and scaled to unit length. The
model is fitted on at most ``TRAIN_ROWS`` labelled rows (a bounded, documented
sample, taken in order of a hash of doc_id from the rows that are not held out)
by FTRL-proximal with L1 and L2 terms, in one task. Scores are sparse dot
products over whole texts.

Odd input: null and empty texts have no terms and get the score of the bias; rows
without doc_id are scored (held_out false); repeated rows are scored each; very long
texts are read whole, in pieces; label rows without id, label or document are not used;
of a labelled id that many rows share one text is learned from, and ties go by the hash,
then the id; without any usable label every score is 0.5; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.common import release
from lakeloom.llm.text_terms import ngram_terms, sample_terms, scored, train_in_one_task, training_sample

BITS = 18
TRAIN_ROWS = 12_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
PARTS, PART = 3, 1


def _values(counts: np.ndarray) -> np.ndarray:
    v = np.log1p(counts.astype(np.float64))
    return v / np.sqrt((v * v).sum() + 1e-12)


def fit_ftrl(labels, terms, counts, bits: int = BITS, epochs: int = EPOCHS) -> bytes:
    """Weights as float32; the last is the bias (not regularised by L1)."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weight(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    feats = [(np.append(t, np.int32(size - 1)), np.append(_values(c), 1.0).astype(np.float32)) for t, c in zip(terms, counts, strict=True)]
    for _ in range(epochs):
        for y, (at, x) in zip(labels, feats, strict=True):
            w = weight(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weight(np.arange(size)).astype(np.float32).tobytes()


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = PARTS, part: int = PART,
                rows: int = TRAIN_ROWS, bits: int = BITS) -> np.ndarray:
    sample = training_sample(labels, label, parts, part, rows)
    samples = sample_terms(docs, sample, lambda texts: ngram_terms(texts, bits))
    return np.frombuffer(train_in_one_task(samples, lambda y, t, c: fit_ftrl(y, t, c, bits)), np.float32)


def quality_scores(docs: DataFrame, weights: np.ndarray, parts: int = PARTS, part: int = PART) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    score = text_scorer(weights)
    return scored(docs, score, parts, part)


def accepted(docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, all columns."""
    score = text_scorer(weights)
    at = docs.columns.index("text")

    def run(rows):
        for batch in rows:
            yield batch.filter(pa.array(score(batch.column(at).cast(pa.string()).fill_null("")) >= least))
        release()
    return docs.mapInArrow(run, docs.schema)


def text_scorer(weights: np.ndarray):
    bits = (len(weights) - 1).bit_length() - 1

    def score(texts):
        out = np.empty(len(texts))
        for i, term, count in ngram_terms(texts, bits):
            out[i] = (weights[term].astype(np.float64) @ _values(count) if len(term) else 0.0) + weights[-1]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))
    return score
