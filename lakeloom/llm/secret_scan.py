"""Secret scans: two character Markov models compared by log-likelihood ratio.

``fit`` counts character transitions over all documents, from labelled samples:
strings that the three fixed formats find are "random", all other long runs of
the same characters are "ordinary". ``scan`` keeps every span of the fixed
formats and adds runs (kind ``markov``) that do not touch one of those and whose
log-likelihood ratio random : ordinary reaches ``THRESHOLD`` nats. The random
model starts from a uniform prior, since keys draw their characters evenly.

Odd input: a null text is empty; an empty text has no spans (the hash of the empty
string); offsets are code points, end exclusive; very long texts are scanned whole;
repeated rows are scanned each; runs of equal likelihood ratio are treated alike, there
are no ties to break; with no document at all both models are the prior, nothing is added
and no row is returned; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, release, text_pieces

# The formats every scan must report.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
RUN_LENGTH, SAMPLE_LENGTH, HEX_LENGTH = 20, 8, 32
THRESHOLD = 10.0
PRIOR = 50.0
_N = len(ALPHABET)
_CODE = np.full(256, -1, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(_N)
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of runs of true of length ``least`` or more that do not cross rows."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    edge = offsets[:-1][offsets[:-1] < len(mask)]
    first[edge] = mask[edge]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    stop = offsets[1:][offsets[1:] > 0] - 1
    last[stop] = mask[stop]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    keep = b - a >= least
    return a[keep], b[keep]


def _pairs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of the character pairs inside the segments."""
    inside = np.zeros(len(raw) + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends - 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    return np.bincount(_CODE[raw[at]] * _N + _CODE[raw[at + 1]], minlength=_N * _N)


def _samples(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(random, ordinary) pair counts of a batch."""
    rand, every = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
    for lo, hi, raw, offsets in text_pieces(texts):
        every += _pairs(raw, *_runs(_CODE[raw] >= 0, offsets, SAMPLE_LENGTH))
        for i in _suspects(raw, offsets, HEX_LENGTH):
            text = raw[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
            for a, b, kind in base_spans(text):
                value = text[a:b] if kind != "assign" else ASSIGN.match(text, a)[2]
                for run in re.findall(r"[A-Za-z0-9+/_=-]{8,}", value):
                    code = _CODE[np.frombuffer(run.encode(), np.uint8)]
                    rand += np.bincount(code[:-1] * _N + code[1:], minlength=_N * _N)
    return rand, np.maximum(every - rand, 0)


def _suspects(raw: np.ndarray, offsets: np.ndarray, least_run: int, runs: bool = False) -> list[int]:
    """Rows that can hold a span: '=' or ':', 'AKIA', a long hex run; with ``runs`` any long run."""
    marks = [np.flatnonzero((raw == 61) | (raw == 58)), _runs(_HEX[raw], offsets, least_run)[0]]
    if len(raw) > 4:
        marks.append(np.flatnonzero((raw[:-3] == 65) & (raw[1:-2] == 75) & (raw[2:-1] == 73) & (raw[3:] == 65)))
    if runs:
        marks.append(_runs(_CODE[raw] >= 0, offsets, RUN_LENGTH)[0])
    return np.unique(np.searchsorted(offsets, np.concatenate(marks), side="right") - 1).tolist()


def fit(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each character pair; counts of all documents, one small table a partition."""
    def run(rows):
        rand, ordinary = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
        for _, texts in batches_of(rows, "text"):
            r, o = _samples(texts)
            rand += r
            ordinary += o
        cell = np.flatnonzero(rand + ordinary)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(rand[cell]), pa.array(ordinary[cell])],
                                         names=["cell", "random", "ordinary"])
    rows = (docs.select(F.col("text").cast("string")).mapInArrow(run, "cell int, random long, ordinary long")
            .groupBy("cell").agg(F.sum("random").alias("random"), F.sum("ordinary").alias("ordinary"))
            .collect())  # one row per pair of characters at most
    rand, ordinary = np.zeros((_N, _N)), np.zeros((_N, _N))
    for r in rows:
        rand[divmod(r["cell"], _N)] = r["random"]
        ordinary[divmod(r["cell"], _N)] = r["ordinary"]
    log = lambda c, prior: np.log((c + prior) / (c + prior).sum(axis=1, keepdims=True))
    # shares of the random samples weigh as PRIOR observations a character, beside as many uniform ones
    scale = PRIOR * _N / max(rand.sum() / _N, 1.0)
    return log(rand * min(1.0, scale), PRIOR) - log(ordinary, 0.5)


def ratio(run: str, model: np.ndarray) -> float:
    code = _CODE[np.frombuffer(run.encode(), np.uint8)]
    return float(model[code[:-1], code[1:]].sum())


def spans(text: str, model: np.ndarray, threshold: float = THRESHOLD) -> tuple[list, list]:
    """(base spans, all spans), each by start, then kind as listed."""
    base = base_spans(text)
    added = [(m.start(), m.end(), "markov") for m in RUN.finditer(text)
             if not any(a < m.end() and m.start() < b for a, b, _ in base) and ratio(m[0], model) >= threshold]
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str, found: list, by: str = "[SECRET]") -> str:
    """``text`` with every (merged) span replaced."""
    out, at = [], 0
    for a, b, _ in found:
        if a >= at:
            out += [text[at:a], by]
        at = max(at, b)
    return "".join(out) + text[at:]


def _said(found: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def _found(texts: pa.Array, model: np.ndarray):
    """(row, text, base spans, all spans) of the rows that can hold a span."""
    for lo, _, raw, offsets in text_pieces(texts):
        for i in _suspects(raw, offsets, HEX_LENGTH, runs=True):
            text = texts[lo + i].as_py()
            yield (lo + i, text, *spans(text, model))


def scan(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """(doc_id, n_<kind>..., base_sha256, spans) per row of ``docs``."""
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            n = len(texts)
            count = {k: np.zeros(n, np.int64) for k in KINDS}
            sha, said = [hashlib.sha256(b"").hexdigest()] * n, [""] * n
            for i, _, base, every in _found(texts, model):
                for _, _, k in every:
                    count[k][i] += 1
                sha[i], said[i] = hashlib.sha256(_said(base).encode()).hexdigest(), _said(every)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(count[k]) for k in KINDS), pa.array(sha, pa.string()), pa.array(said, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redacted(docs: DataFrame, model: np.ndarray, by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced in column text; all other columns as they are."""
    at = docs.columns.index("text")

    def run(rows):
        for batch in rows:
            texts = batch.column(at).cast(pa.string())
            clean = {i: redact(text, every, by) for i, text, _, every in _found(texts.fill_null(""), model) if every}
            if clean:
                texts = pa.array([clean.get(i, t) for i, t in enumerate(texts.to_pylist())], pa.string())
            yield batch.set_column(at, "text", texts)
        release()
    return docs.mapInArrow(run, docs.schema)
