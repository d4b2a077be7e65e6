"""Collocations, spelling variants and line dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm import collocations, line_dedup, spelling_variants
from lakeloom.session import scratch_path

DOCS = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("key", T.StringType()),
    ("n", T.StringType()), ("f", T.StringType()), ("word", T.StringType()), ("a", T.StringType()))])
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, langs=("en",), parts=3):
    rows = [(i, t, langs[i % len(langs)], "k", "n", "f", "w", "a") for i, t in enumerate(texts)]
    if rows:
        rows += [(None, "A line without id\nand another", None, None, None, None, None, None), rows[0]]
    return spark.createDataFrame(rows, DOCS).repartition(parts), [r[:3] for r in rows]


# ------------------------------------------------------------------ collocations
def phrases_by_hand(rows, least, top, most=4):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII)):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = [(lang, p, a) for (lang, p), a in f.items() if len(p) > 1 and a >= least]
    covered = defaultdict(int)
    for lang, p, a in found:
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                covered[lang, p[i:i + k]] = max(covered[lang, p[i:i + k]], a)
    out = defaultdict(list)
    for lang, p, a in found:
        if 100 * covered[lang, p] >= 80 * a:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
            for lang, got in out.items() for i, (score, a, p, left, right) in enumerate(sorted(got)[:top])]


@pytest.mark.parametrize("least,top,limit", [(1, 10_000, 1 << 22), (3, 10_000, 40), (5, 12, 1 << 22)])
def test_collocations(spark, monkeypatch, least, top, limit):
    monkeypatch.setattr(collocations, "CHUNK", limit)
    rnd = random.Random(4)
    words = ["new", "york", "City", "of", "the", "und", "éa", "ÉA", "c-3", "\x1fx", "日本"]
    texts = [None, "", " .,; ", "the", "New York\tCity  of the. New York", "a b c d e " * 30, "the " * 400, "x" * 3000]
    texts += ["".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", "\x0b"]) for _ in range(60)) for _ in range(40)]
    df, rows = frame(spark, texts, ("en", "fr", None))
    monkeypatch.setattr(collocations.phrase_counts, "__defaults__", (limit,))
    got = collocations.collocations(df, min_count=least, top=top)
    assert sorted(map(tuple, got.collect())) == sorted(phrases_by_hand(rows, least, top))
    assert not collocations.collocations(df.limit(0)).count()


def test_collocation_streams_are_merged(spark):
    df, _ = frame(spark, ["a b c d"] * 40)
    totals, rows = collocations.estimation_streams(df, min_count=30)
    got = {r["phrase"]: r for r in rows.filter("lang = 'en'").collect()}
    assert set(got) == {"a b", "b c", "c d", "a b c", "b c d", "a b c d"}
    assert got["a b c d"]["lefts"] == [41] * 3 and got["b c"]["extended"] == 41 and got["a b c d"]["extended"] == 0
    assert {r["lang"]: r["n"] for r in totals.collect()}["en"] == 164
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ spelling variants
def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(rows, least=7, min_count=2, ratio=10):
    n = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= min_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, all_near in near.items():
        best = min(all_near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_spelling_variants(spark):
    rnd = random.Random(6)
    letters = "abcéÿ×"
    base = ["".join(rnd.choice(letters) for _ in range(k)) for k in (7, 7, 8, 9, 10, 13, 20)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    texts = [None, "", "short", "1" * 40, "Straße Ünterschied" * 3, "b" * 30_000, "b" * 29_999 + "c"]
    texts += ["chaining " * 400, "chaininga " * 30, "chainingab " * 3]  # a chain of two steps
    texts += ["b" * 30_000] * 3 + ["b" * 29_999] * 2
    for w in base:
        texts += [f"{w} {w.upper()}, {w}" for _ in range(60)]
        for _ in range(25):
            v = list(w)
            for _ in range(rnd.choice((1, 1, 2))):
                at, kind = rnd.randrange(len(v)), rnd.randrange(3)
                v[at:at + (kind != 1)] = [] if kind == 0 else [rnd.choice(letters)]
            texts += ["".join(v)] * rnd.choice((1, 2, 3, 5, 6))
    df, rows = frame(spark, texts)
    got = spelling_variants.spelling_variants(df)
    exp = variants_by_hand(rows)
    assert sum(e[1] is not None for e in exp) > 20 and any(e[2] != e[1] for e in exp if e[1])
    assert sorted(map(tuple, got.collect())) == sorted(exp)
    assert not spelling_variants.spelling_variants(df.limit(0)).count()


def test_each_edit_of_each_length_shares_a_key(spark):
    words = set()
    for size in range(7, 13):
        w = "abcdefghijklmnop"[:size]
        words |= {w} | {w[:i] + w[i + 1:] for i in range(size)} | {w[:i] + "z" + w[i:] for i in range(size + 1)}
        words |= {w[:i] + "z" + w[i + 1:] for i in range(size)}
    words = sorted(words)
    got = spelling_variants.near_words(spark.createDataFrame([(w, 2) for w in words], "word string, n long"))
    pairs = [(r["word"], r["near"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}


# ------------------------------------------------------------------ line dedup
def lines_by_hand(rows, least):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(ASCII)
    seen = Counter()
    for _, text, _ in rows:
        seen.update({key(x) for x in (text or "").split("\n")})
    gone = {k for k, n in seen.items() if n >= least and k}
    out = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("least,batch", [(10, 1_000_000), (10, 40), (2, 25), (1, 60)])
def test_line_dedup(spark, least, batch):
    rnd = random.Random(7)
    pool = [f"Line {i % 17} of {i}" for i in range(60)] + ["", " ", "\x85odd", "\x0b\x0c", "É", "é", "x" * 4000]
    texts = [None, "", "\n\n", "one\r\ntwo\r", " same ", "only"] + ["Common line \n" + "copied text\n" * 3] * 12
    texts += ["\n".join(rnd.choice(["{}", " {}", "{}\t\r"]).format(rnd.choice([str.upper, str])(rnd.choice(pool)))
                        for _ in range(rnd.randrange(1, 9))) for _ in range(60)]
    df, rows = frame(spark, texts, parts=6)
    got = [tuple(r) for r in line_dedup.dedup_lines(df, least, batch).collect()]
    assert sorted(got, key=repr) == sorted(lines_by_hand(rows, least), key=repr)
    assert not line_dedup.dedup_lines(df.limit(0)).count()


def test_line_runs_levels_and_reopening(spark):
    root = scratch_path(spark, "runs-test")
    rnd = random.Random(8)
    total = Counter()
    runs = line_dedup.LineRuns(spark, root, min_docs=6, fanout=2, buckets=4)
    for step in range(7):
        batch = Counter(rnd.choice("abcdefghij") * 3 for _ in range(8 + step))
        total += batch
        runs.add(spark.createDataFrame([(bytearray(k.encode()), n) for k, n in batch.items()], "key binary, n long"))
        if step == 3:  # as another session would find it
            runs = line_dedup.LineRuns(spark, root, min_docs=6, fanout=2, buckets=4)
    assert max(r.level for r in runs.runs) >= 2 and len([r for r in runs.runs if r.kind == "open" and r.level == 0]) < 2
    assert {bytes(r["key"]).decode() for r in runs.settled().collect()} == {k for k, n in total.items() if n >= 6}


def test_batches_merge_with_runs_without_shuffling_them(spark):
    runs = line_dedup.LineRuns(spark, scratch_path(spark, "runs-plan"), min_docs=1, fanout=1, buckets=4)
    keys = spark.range(50).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(3).cast("long").alias("n"))
    runs.add(keys)
    batch = keys.groupBy("key").agg(F.sum("n").alias("n"))
    left = runs._unsettled(batch)
    assert left.count() == 0
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Bucketed: true") == 1
