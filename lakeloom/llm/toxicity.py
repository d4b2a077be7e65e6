"""Toxicity: factorization machine over hashed terms.

Terms are lower-cased words and the first bytes of longer words (so inflected
and compounded insults share a term), hashed to 2^``BITS`` places. From at most
``TRAIN_ROWS`` labelled documents (bounded, documented sample in order of a hash of
doc_id, held-out rows left out) a factorization machine

    y(x) = w0 + sum_i w_i x_i + c sum_{i<j} <v_i, v_j> x_i x_j

is fitted in one task, in two rounds. The first takes the ``TERMS`` terms that tell
the labels apart best on their own (AdaGrad; presence is not scaled by length, so one
insult counts the same in a long text; c = 1). The second takes every term of three
sampled documents and learns what is left over: weights under an L1 penalty
(follow-the-regularised-leader) and factors for all pairs, with c = ``FULL`` / number of
terms for longer texts. So a pair is learned even if neither of its terms tells anything
alone, such as a mild word beside the mention of a group. A part of the sample
that neither round is fitted on decides after how many epochs the second round stops,
and that it is left out where it does not lower the loss.

Odd input: null and empty texts have no terms and get the score of the bias; very
long texts are read whole, in pieces; rows without doc_id are scored (held_out false);
repeated rows are scored each; of a labelled id that many rows share one text is
learned from; label rows without id, label or document are not used; ties go by the
hash, then the id; without any usable label every score is 0.5; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame

from lakeloom.llm.text_terms import sample_terms, scored, train_in_one_task, training_sample, word_terms

BITS = 20
PREFIXES = (4, 5)
TRAIN_ROWS = 12_000
TERMS = 2_048
FACTORS = 8
EPOCHS = 12
RATE, L2 = 0.1, 1e-4
FULL, ROUNDS, CHECKED = 64, 8, 0.15
ALPHA, L1, LW, V_RATE, V_L2 = 0.3, 2.0, 1.0, 0.02, 1e-3
PARTS, PART = 5, 0


def _telling(labels, terms, bits: int, most: int) -> np.ndarray:
    """The terms of largest G statistic against the label, in three documents at least."""
    size, pos = 1 << bits, float(labels.sum())
    neg = len(labels) - pos
    a, b = np.zeros(size), np.zeros(size)
    for y, t in zip(labels, terms, strict=True):
        (a if y else b)[t] += 1
    seen = np.flatnonzero(a + b >= 3)
    a, b = a[seen], b[seen]
    total, share = a + b, pos / max(pos + neg, 1)
    part = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    g = 2 * (part(a, total * share) + part(b, total * (1 - share)) + part(pos - a, (pos + neg - total) * share)
             + part(neg - b, (pos + neg - total) * (1 - share)))
    keep = np.flatnonzero(g > 10.8)  # chi-square of one degree, p = 0.001
    return np.sort(seen[keep[np.argsort(-g[keep], kind="stable")[:most]]])


def fit_machine(labels, terms, counts=None, bits: int = BITS, most: int = TERMS, factors: int = FACTORS,
                epochs: int = EPOCHS) -> bytes:
    """Pickled machine of the first round, (terms, w0, w, v), and of the second or None."""
    if not len(labels):
        return pickle.dumps(((np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, factors))), None))
    held = np.random.default_rng(11).random(len(labels)) < CHECKED
    kept = np.flatnonzero(~held)
    part = _first_round(labels[kept], [terms[i] for i in kept], bits, most, factors, epochs)
    pairs = _second_round(labels, terms, held, machine_scores(part, terms, bits), bits, factors)
    return pickle.dumps((_first_round(labels, terms, bits, most, factors, epochs), pairs))


def machine_scores(model, terms, bits: int = BITS, scaled: bool = False) -> np.ndarray:
    """The machine's value for each array of terms; ``scaled``: pairs of long texts count less."""
    chosen, w0, w, v = model
    place = np.full(1 << bits, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    out = np.empty(len(terms))
    for i, t in enumerate(terms):
        at = place[t]
        at = at[at >= 0]
        s = v[at].sum(axis=0)
        out[i] = w0 + w[at].sum() + 0.5 * (_scale(len(at)) if scaled else 1.0) * float((s * s).sum() - (v[at] ** 2).sum())
    return out


def _scale(n: int) -> float:
    return min(1.0, FULL / max(1, n))


def _loss(values: np.ndarray, labels: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(labels > 0, -values, values)).sum())


def _second_round(labels, terms, held, base: np.ndarray, bits: int, factors: int):
    """The machine over all terms of three documents, fitted to what ``base`` leaves over; None where it does not help."""
    seen = np.zeros(1 << bits, np.int32)
    for t in terms:
        seen[t] += 1
    chosen = np.flatnonzero(seen >= 3)
    place = np.full(1 << bits, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    rows = [p[p >= 0] for p in (place[t] for t in terms)]
    rng = np.random.default_rng(7)
    size = len(chosen)
    z, n, w0, g0 = np.zeros(size), np.zeros(size), 0.0, 1.0
    v, gv = rng.normal(0, 0.01, (size, factors)), np.full((size, factors), 1e-2)

    def weight(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((1 + np.sqrt(n[at])) / ALPHA + LW)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    check, learn = np.flatnonzero(held), np.flatnonzero(~held)
    best, found, since = 0.98 * _loss(base[check], labels[check]), None, 0
    for _ in range(ROUNDS if len(check) and size else 0):
        for i in rng.permutation(learn):
            at = rows[i]
            va, w, c = v[at], weight(at), _scale(len(at))
            s = va.sum(axis=0)
            y = base[i] + w0 + w.sum() + 0.5 * c * float((s * s).sum() - (va * va).sum())
            d = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[i]
            if abs(d) < 1e-3:
                continue
            g0 += d * d
            w0 -= RATE * d / np.sqrt(g0)
            z[at] += d - (np.sqrt(n[at] + d * d) - np.sqrt(n[at])) / ALPHA * w
            n[at] += d * d
            h = c * d * (s - va) + V_L2 * va
            gv[at] += h * h
            v[at] = va - V_RATE * h / np.sqrt(gv[at])
        now = (chosen, w0, weight(np.arange(size)).astype(np.float32), v.astype(np.float32))
        loss = _loss(base[check] + machine_scores(now, [terms[i] for i in check], bits, True), labels[check])
        since = 0 if loss < best else since + 1
        if loss < best:
            best, found = loss, now
        if since == 3:
            break
    return found


def _first_round(labels, terms, bits: int, most: int, factors: int, epochs: int):
    """(terms, w0, w, v) over the terms that tell the labels apart alone."""
    chosen = _telling(labels, terms, bits, most)
    place = np.full(1 << bits, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    rows = [p[p >= 0] for p in (place[t] for t in terms)]
    rng = np.random.default_rng(7)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w0, g0 = float(np.log(share / (1 - share))), 1.0
    w, v = np.zeros(len(chosen)), rng.normal(0, 0.01, (len(chosen), factors))
    gw, gv = np.full(len(chosen), 1e-2), np.full((len(chosen), factors), 1e-2)
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            at = rows[i]
            s = v[at].sum(axis=0)
            y = w0 + w[at].sum() + 0.5 * float((s * s).sum() - (v[at] ** 2).sum())
            d = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[i]
            g0 += d * d
            w0 -= RATE * d / np.sqrt(g0)
            if len(at):
                g = d + L2 * w[at]
                gw[at] += g * g
                w[at] -= RATE * g / np.sqrt(gw[at])
                h = d * (s - v[at]) + L2 * v[at]
                gv[at] += h * h
                v[at] -= 0.1 * RATE * h / np.sqrt(gv[at])
    return chosen, w0, w, v


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = PARTS, part: int = PART,
                 rows: int = TRAIN_ROWS, bits: int = BITS):
    sample = training_sample(labels, label, parts, part, rows)
    samples = sample_terms(docs, sample, lambda texts: word_terms(texts, bits, PREFIXES))
    return pickle.loads(train_in_one_task(samples, lambda y, t, c: fit_machine(y, t, c, bits)))


def text_scorer(model, bits: int = BITS):
    first, pairs = model

    def score(texts):
        terms = [t for _, t, _ in word_terms(texts, bits, PREFIXES)]
        out = machine_scores(first, terms, bits)
        if pairs is not None:
            out += machine_scores(pairs, terms, bits, True)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))
    return score


def toxicity_scores(docs: DataFrame, model, parts: int = PARTS, part: int = PART) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    return scored(docs, text_scorer(model), parts, part)
