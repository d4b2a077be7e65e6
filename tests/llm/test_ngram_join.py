import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from lakeloom.llm.ngram_join import choose_prefix, ngram_jaccard_join

SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("cls", T.StringType()), ("comp", T.StringType()))])


def brute(rows):
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, ngram_jaccard_join(df).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def corpus(seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rnd.choices(words, k=30))
    rows = []
    base = rnd.choices(words, k=80)
    for _ in range(25):  # near copies of one text, some only linked through others
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(80)] = rnd.choice(words)
        rows.append(" ".join(w))
    for _ in range(20):
        w = rnd.choices(words, k=rnd.randint(1, 60))
        rows.append(" ".join(w))
        if rnd.random() < 0.4:
            w[rnd.randrange(len(w))] = "other"
            rows.append("  ".join(w).upper())
    for _ in range(10):
        rows.append(passage + " " + " ".join(rnd.choices(words, k=rnd.randint(1, 12))))
    rows += ["", "   \t", None, "one two", "ONE  two", "one two three", "é É ünï x y z", "É É ünï x y z", rows[0], "a " * 3000]
    return list(enumerate(rows))


def test_matches_brute_force(spark):
    rows = corpus() + [(None, "one two"), (3, "a text of its own under a used number"), (0, corpus()[0][1])]
    assert run(spark, rows) == brute(rows)


def test_long_lists_by_blocks(spark, monkeypatch):
    """Near copies of one text, many not alike: every list is long, blocks are small."""
    from lakeloom.llm import ngram_join
    monkeypatch.setattr(ngram_join, "SMALL", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(60)] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(w)))
    assert run(spark, rows) == brute(rows)
    assert len({c for *_, c in brute(rows)}) > 3


def test_block_pairs_grow_with_the_copies_beside_a_stray(spark, monkeypatch):
    """A component of n classes and one class apart that has a token of theirs: pairs in proportion to n."""
    from lakeloom.llm import ngram_join
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    found = []
    for n in (400, 800, 1600):
        rows = [(token, cls, 0, n) for token in range(5) for cls in range(n)] + [(0, n, n, n)]
        large = spark.createDataFrame(rows, "token long, cls long, comp long, size long")
        found.append(ngram_join._block_pairs(large, ngram_join._blocks(large)).count())
    assert found[0] <= 2 * 400 / 16 + 1 and found[2] <= 4.5 * found[0]


def test_copies_with_a_stray(spark, monkeypatch):
    from lakeloom.llm import ngram_join
    monkeypatch.setattr(ngram_join, "SMALL", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:50], f"x{i}", *base[50:]])) for i in range(40)]
    rows += [(100, " ".join([*base[:20], *(f"y{i}" for i in range(15))])), (101, " ".join([*base[:20], *(f"y{i}" for i in range(16))]))]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("df,need,longer", [([1] * 10, 8, False), ([1, 1, 5, 5, 5, 5, 5, 5, 900, 900], 8, False),
                                            ([2000] * 20, 16, True)])
def test_prefix_grows_with_cost(df, need, longer):
    match, length = choose_prefix(np.array(df), need)
    assert length == len(df) - need + match
    assert (match > 1) == longer


def full_bitmap(*_):
    """Counts of a corpus so large that every token looks like a repeated one."""
    from lakeloom.llm.ngram_join import TokenCounts
    return TokenCounts(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.full(4096, 255, np.uint8))


def test_a_full_bitmap_stores_no_lone_classes(spark, monkeypatch):
    """Texts that have a few tokens in common with others, too few for a pair, bring no postings and no sets."""
    from lakeloom.llm import ngram_join
    rows, tables = corpus(), {}
    real = ngram_join.stored

    def noted(df, name):
        out = real(df, name)
        tables.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "token_counts", full_bitmap)
    monkeypatch.setattr(ngram_join, "stored", noted)
    quote = " ".join(f"q{i}" for i in range(6))  # two tokens that all of these share
    rows += [(1000 + k, " ".join(f"u{k}x{i}" for i in range(100)) + " " + quote) for k in range(60)]
    assert run(spark, rows) == brute(rows)
    assert tables["ngram-sets"][0] < 60
    assert sum(tables.get("ngram-prefix-tokens", [])) == 0


def test_tables_go_when_they_are_done(spark):
    from lakeloom import session
    names = lambda: set(session.list_names(spark, f"{session.checkpoint_root(spark)}/lakeloom"))
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in corpus()], SCHEMA).repartition(3)
    before = names()
    ngram_jaccard_join(df)
    assert {n.rsplit("-", 1)[0] for n in names() - before} == {"ngram-classes", "ngram-comps"}


def test_shuffles_of_a_stored_table_go_with_its_write(spark):
    from lakeloom.llm.common import stored
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {x for i in range(files.size()) if "shuffle_" in (x := files.apply(i).getName())}
    before = shuffles()
    rows = stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "test-shuffles")
    assert not shuffles() - before
    assert rows.count() == 7


def test_often_repeated_tokens_beyond_the_frequent_are_known(spark, monkeypatch):
    from lakeloom.llm import ngram_join
    monkeypatch.setattr(ngram_join, "BITMAP_BITS", 1 << 15)
    rows = [(i, f"a{i // 2} b c d {i // 2}") for i in range(5000)]  # 2,500 tokens found twice, in texts that differ
    rows = [(i, f"{t} tail{i}") for i, t in rows]
    rows += [(10000 + i, f"l{i % 4} m n o p e{i}") for i in range(400)]  # 4 tokens found 100 times
    rows += [(20000 + i, f"r s t u v e{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = ngram_join.token_counts(df, keep=1)
    tokens = lambda text: next(iter(ngram_join.shingle_sets(pa.array([text]))))[1]
    est = {t: int(counts.estimate(tokens(t))[0]) for t in ("a7 b c d 7", "l2 m n o p", "r s t u v", "z z y y x")}
    assert est["r s t u v"] == 900 and est["l2 m n o p"] > 50 and est["a7 b c d 7"] == 2
