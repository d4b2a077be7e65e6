"""URL filters: fixed rules first, gradient-boosted trees on lexical features for the rest.

Features: lengths of host, path and url, label and path depth, digit ratio,
hyphens, entropy of the host's characters, number of parameters, and smoothed
block rates of host suffix and first path segment. The rates come from all
distinct labelled URLs outside the held-out quarter: counts per value and fold are
joined to the rows, and a labelled URL does not count in its own fold's rate, so
no rate has seen the label it helps to predict. Trees are boosted on a logistic
loss over at most ``TRAIN_ROWS`` of these URLs (a bounded, documented sample in
order of a hash of the url) in one task; the threshold is the one of best F1 over
all of the held-out quarter, counted in ``CUTS`` bins of the score. URLs are
labelled by ``labelled_urls``: hosts with one of the fixed words in a hyphenated
label are blocked examples, hosts that no rule blocks are allowed ones.

Odd input: a null url, or one without ``://``, has an empty host and path, no rule
and the model's verdict on the empty features; very long urls are read whole;
repeated rows are judged each; of rules that fit the longest wins, no two are as long;
other columns are ignored; without labelled urls everything the rules leave open is
allowed; an empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored

# The rules (verdict, host, path prefix) and the words of blocked examples.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKED_WORDS = ("ads", "bets", "casino", "pills", "poker", "porn", "track", "viagra")

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, L2 = 40, 3, 0.2, 32, 1.0
FEATURES = ("url_length", "host_length", "path_length", "labels", "depth", "digits", "hyphens", "parameters",
            "entropy", "suffix_rate", "segment_rate")
FOLDS, CUTS = 4, 1_000  # the last fold is held out
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds host and path by the contract's definition; both empty without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def matching_rule() -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits host and path, else nulls; ties: the earlier host rule."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, host, prefix in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(prefix)
        rule, verdict = F.when(fits, F.lit(host + prefix)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def features(rows: DataFrame) -> DataFrame:
    """Adds the plain features and the keys of the two rates."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    size = F.length(url)
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    chars = F.filter(F.split("host", ""), lambda c: c != "")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    return rows.withColumns({
        "url_length": size, "host_length": F.length("host"), "path_length": F.length("path"),
        "labels": count(F.col("host"), "."), "depth": count(F.col("path"), "/"),
        "digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(size, F.lit(1)),
        "hyphens": count(F.col("host"), "-"),
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "entropy": F.when(F.col("host") == "", 0.0).otherwise(entropy),
        "suffix": F.substring_index("host", ".", -2),
        "segment": F.regexp_extract("path", r"\A/?([^/]*)", 1)})


def labelled_urls(rows: DataFrame) -> DataFrame:
    """Adds label (1 block, 0 allow, null: none) to rows that have host, rule and verdict."""
    word = r"(^|[.])[a-z0-9-]*\b(" + "|".join(BLOCKED_WORDS) + r")\b[a-z0-9-]*[.]"
    return rows.withColumn("label", F.when(F.col("host").rlike(word), 1)
                           .when((F.col("host") != "") & F.coalesce(F.col("rule_verdict") != "block", F.lit(True)), 0))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> tuple[float, list, list]:
    """(bias, bin edges per feature, trees of (feature, bin, left, right) or leaf values)."""
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T, strict=True)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    score, out = np.full(len(y), bias), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)

        def grow(rows, depth, g=g, h=h):
            sg, sh = g[rows].sum(), h[rows].sum()
            leaf = float(RATE * sg / (sh + L2))
            best = (1e-6, None, None)
            if depth < DEPTH and len(rows) >= 10:
                for f in range(binned.shape[1]):
                    b = binned[rows, f]
                    cg, ch = (np.cumsum(np.bincount(b, weights=v[rows], minlength=BINS + 1)) for v in (g, h))
                    gain = cg ** 2 / (ch + L2) + (sg - cg) ** 2 / (sh - ch + L2) - sg ** 2 / (sh + L2)
                    k = int(gain[:-1].argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
            if best[1] is None:
                score[rows] += leaf
                return leaf
            left = binned[rows, best[1]] <= best[2]
            return (best[1], best[2], grow(rows[left], depth + 1), grow(rows[~left], depth + 1))
        out.append(grow(np.arange(len(y)), 0))
    return bias, edges, out


def boosted_score(model: tuple[float, list, list], x: np.ndarray) -> np.ndarray:
    bias, edges, trees = model
    binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T, strict=True)], axis=1)
    out = np.full(len(x), bias)

    def walk(node, rows):
        if isinstance(node, float):
            out[rows] += node
        elif len(rows):
            left = binned[rows, node[0]] <= node[1]
            walk(node[2], rows[left])
            walk(node[3], rows[~left])
    for tree in trees:
        walk(tree, np.arange(len(x)))
    return 1 / (1 + np.exp(-out))


_PLAIN = FEATURES[:-2]


def _fold(url: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(url, F.lit(""))), F.lit(FOLDS)).cast("int")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    cols = [batch.column(batch.schema.get_field_index(c)) for c in FEATURES]
    return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols], axis=1)


def block_counts(labelled: DataFrame, key: str) -> DataFrame:
    """(key, yes, n, folds): blocked and all labelled urls of each value outside the held-out fold, and by fold."""
    of = lambda q, c: F.sum(F.when(F.col("fold") == q, c).otherwise(0))
    folds = F.array(*(F.struct(of(q, F.col("label")).alias("yes"), of(q, F.lit(1)).alias("n")) for q in range(FOLDS - 1)))
    return (labelled.filter(F.col("fold") < FOLDS - 1).groupBy(key)
            .agg(F.sum("label").alias(f"{key}_yes"), F.count("*").alias(f"{key}_n"), folds.alias(f"{key}_folds")))


def with_rates(rows: DataFrame, counts: dict[str, DataFrame], overall: float) -> DataFrame:
    """Adds the smoothed block rates (ten rows of the overall rate); a row with label and fold leaves its fold out."""
    for key, table in counts.items():
        rows = rows.join(table, key, "left")
        yes, n = (F.coalesce(F.col(f"{key}_{c}"), F.lit(0)) for c in ("yes", "n"))
        if "fold" in rows.columns:
            own = F.get(F.col(f"{key}_folds"), F.col("fold"))
            yes, n = yes - F.coalesce(own["yes"], F.lit(0)), n - F.coalesce(own["n"], F.lit(0))
        rows = rows.withColumn(f"{key}_rate", (yes + 10 * F.lit(overall)) / (n + 10)).drop(f"{key}_yes", f"{key}_n", f"{key}_folds")
    return rows


def _boosted(sample: DataFrame):
    """Trees boosted in one task on the bounded sample."""
    def run(batches):
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        order = np.lexsort((table.column("url").to_pylist(),))
        table = table.take(pa.array(order, pa.int64()))
        trees = boost(_matrix(table.to_batches()[0]), np.array(table.column("label").to_pylist(), np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], names=["model"])
    return pickle.loads(bytes(sample.repartition(1).mapInArrow(run, "model binary").collect()[0]["model"]))


def _scores(rows: DataFrame, keep: list[str], schema: str, trees) -> DataFrame:
    def run(batches):
        for batch in batches:
            score = np.zeros(len(batch)) if trees is None else boosted_score(trees, _matrix(batch))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(score, pa.float64())],
                                             names=[*keep, "score"])
    return rows.select(*keep, *FEATURES).mapInArrow(run, f"{schema}, score double")


def _threshold(held: DataFrame) -> float:
    """Least score to block: best F1 over all held-out rows, in the middle between scores that occur."""
    bins = (held.groupBy(F.floor(F.col("score") * CUTS).alias("b"))
            .agg(F.sum("label").alias("yes"), F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
            .orderBy(F.desc("b")).collect())
    total, yes, n, best, cut = sum(r["yes"] for r in bins), 0, 0, 0.0, 0.5
    if not total:
        return cut
    for i, r in enumerate(bins):
        yes, n = yes + r["yes"], n + r["n"]
        if (f1 := 2 * yes / (n + total)) >= best:
            best, cut = f1, (r["low"] + bins[i + 1]["high"]) / 2 if i + 1 < len(bins) else r["low"]
    return cut


def fit_urls(rows: DataFrame, sample_rows: int = TRAIN_ROWS):
    """(counts per value, overall rate, trees, threshold) from the labelled rows, or None without both labels."""
    labelled = stored(rows.filter("label is not null").select("url", "label", *_PLAIN, "suffix", "segment").distinct()
                      .withColumn("fold", _fold(F.col("url"))), "url-labelled")
    seen = labelled.filter(F.col("fold") < FOLDS - 1)
    n, yes = seen.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < yes < n:
        return None
    counts = {key: stored(block_counts(labelled, key), f"url-{key}") for key in ("suffix", "segment")}
    sample = seen.orderBy(F.xxhash64("url"), "url", "label").limit(sample_rows)
    trees = _boosted(with_rates(sample, counts, yes / n).select("url", "label", *FEATURES))
    held = labelled.filter(F.col("fold") == FOLDS - 1)
    return counts, yes / n, trees, _threshold(_scores(with_rates(held, counts, yes / n), ["label"], "label int", trees))


def judge_urls(pages: DataFrame, sample_rows: int = TRAIN_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row of ``pages``."""
    rows = with_host_and_path(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")))
    rule, verdict = matching_rule()
    rows = features(rows.withColumns({"rule": rule, "rule_verdict": verdict}))
    model = fit_urls(labelled_urls(rows), sample_rows)
    counts, overall, trees, least = model or ({}, 0.0, None, 2.0)
    rows = with_rates(rows, counts, overall) if model else rows.withColumns({c: F.lit(0.0) for c in FEATURES[-2:]})
    out = _scores(rows, ["page_id", "host", "path", "rule", "rule_verdict"],
                  "page_id long, host string, path string, rule string, rule_verdict string", trees)
    own = F.when(F.col("score") >= least, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")
