"""Quality rules: a bitmask ledger.

Every rule is evaluated once per document: ``ledger`` holds the measurements and
one bit per failed rule. Policies are versioned masks over these bits, applied
later without reading a text again (``apply_policy``); ``ablations`` tells, from
counts per bit pattern, what each rule rejects alone and what leaving it out
would keep.

Odd input: a null or empty text measures 0 everywhere and fails ``few_words``; a
very long text is measured whole; repeated rows are separate rows; rows with equal
measurements get the same bits, there are no ties to break; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, mix64, segment_hashes, text_pieces, word_bounds

#: Rules by bit: name and failure condition over the measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("capitals", "n_letters > 0 AND 100 * n_capitals > 60 * n_letters"),
    ("repeated_words", "100 * n_same_as_last > 25 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Policy versions: the rules whose failure rejects a document.
POLICIES = {"v1": BASE, "v2": (1 << len(RULES)) - 1}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
            "n_capitals", "n_same_as_last")


def measure(texts: pa.Array) -> np.ndarray:
    """One row of ``MEASURES`` per text."""
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    for lo, hi, raw, offsets in text_pieces(texts):
        starts, ends, _ = word_bounds(raw, offsets)
        words = segment_hashes(raw, starts, ends)
        bounds = np.searchsorted(starts, offsets)

        def total(mask, offsets=offsets):
            return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])

        inside = np.zeros(len(raw) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        in_word = np.cumsum(inside[:-1]) > 0
        upper = (raw >= 65) & (raw <= 90)
        out[lo:hi, 0] = np.diff(bounds)
        out[lo:hi, 1] = total(in_word & ((raw & 0xC0) != 0x80))
        out[lo:hi, 2] = total(symbol[raw])
        out[lo:hi, 6] = total(upper | ((raw >= 97) & (raw <= 122)))
        out[lo:hi, 7] = total(upper)

        line = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(raw == 10) + 1)))
        line = line[line < len(raw)]
        stop = np.append(line[1:], len(raw))
        stop = stop - (raw[stop - 1] == 10) if len(stop) else stop
        with_word = np.searchsorted(starts, stop) > np.searchsorted(starts, line)
        line, stop = line[with_word], stop[with_word]
        lines = segment_hashes(raw, line, stop)
        cut = np.searchsorted(line, offsets)
        for i in range(hi - lo):
            own = lines[cut[i]:cut[i + 1]]
            out[lo + i, 5] = len(own)
            out[lo + i, 3] = len(own) - len(np.unique(own))
            w = words[bounds[i]:bounds[i + 1]]
            out[lo + i, 8] = (w[1:] == w[:-1]).sum()
            if len(w) >= 4:
                window = mix64(w[:-2] ^ mix64(w[1:-1] ^ mix64(w[2:])))
                _, where, count = np.unique(window, return_inverse=True, return_counts=True)
                again = count[where] > 1
                covered = np.zeros(len(w), bool)
                for k in range(3):
                    covered[k:k + len(again)] |= again
                out[lo + i, 4] = covered.sum()
    return out


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, failures int): each rule evaluated once per row."""
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            found = measure(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(len(MEASURES)))],
                                             names=["doc_id", *MEASURES])
    measured = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return measured.withColumn("failures", mask)


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds base_failed, kept and the policy's version to ledger rows."""
    return rows.withColumns({
        "base_failed": F.col("failures").bitwiseAND(BASE) != 0,
        "kept": F.col("failures").bitwiseAND(POLICIES[version] | BASE) == 0,
        "policy": F.lit(version)})


def ablations(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule: rows failing it, rows only it rejects, rows kept by the policy and kept without the rule."""
    mask = POLICIES[version]
    patterns = rows.groupBy(F.col("failures").bitwiseAND(mask).alias("f")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).alias("bit"))
                                for name, _ in RULES if BIT[name] & mask)))
    n, f, bit = F.col("n"), F.col("f"), F.col("r.bit")
    return (patterns.select("f", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(f.bitwiseAND(bit) != 0, n).otherwise(0)).alias("failed"),
        F.sum(F.when(f == bit, n).otherwise(0)).alias("only_this"),
        F.sum(F.when(f == 0, n).otherwise(0)).alias("kept"),
        F.sum(F.when((f == 0) | (f == bit), n).otherwise(0)).alias("kept_without")))
