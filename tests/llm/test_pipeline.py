import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from lakeloom.llm import ngram_join, quality_classifier, secret_scan
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_text_ops import HEX40

DOCS = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("spans", T.StringType()), ("__x", T.ArrayType(T.IntegerType())))])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def fixture(rnd):
    words = [f"w{i}" for i in range(400)]
    item = " ".join(rnd.choices(words, k=20))
    texts = []
    for i in range(160):
        w = rnd.choices(words, k=rnd.randint(20, 90))
        if i % 4 == 0:
            w = [x + "$$$" for x in w]
        if i % 11 == 1:
            w += item.split()
        if i % 7 == 2:
            w += ["token", "=", f'"{HEX40}"']
        texts.append(" ".join(w))
    texts += [texts[1], texts[5] + " tail", texts[6], None, ""]
    rows = [(i, t, "en", "s", len(t or ""), "mine", [i]) for i, t in enumerate(texts)]
    rows += [rows[3], (9, "another text of a used number " * 3, "en", "s", 90, "mine", None)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(160)]
    return rows, labels, [(1, item)]


def test_pipeline_matches_brute_force(spark, tmp_out):
    pytest.importorskip("public_tokenizers")
    rows, labels, items = fixture(random.Random(12))
    sf = tmp_out("sf")
    for name, data, schema in (("documents", rows, DOCS), ("labels", labels, LABELS), ("benchmark", items, ITEMS)):
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/{name}.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    score = quality_classifier.text_scorer(quality_classifier.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    kept = [r for r in rows if score(pa.array([r[1] or ""]))[0] >= 0.5]
    assert {r[0] for r in kept} >= {i for i in range(160) if i % 4} and not {r[0] for r in kept} & {i for i in range(160) if i % 4 == 0}
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    assert first.schema == docs.schema
    assert sorted(map(str, first.collect())) == sorted(str(T.Row(**dict(zip(DOCS.names, r)))) for r in kept)

    group = components([(r[0], r[1]) for r in kept])
    stay = []
    for r in kept:
        mine = [c for d, n, c in group if d == r[0] and n == len(set(zip(*[(r[1] or "").split()[k:] for k in range(5)])))]
        if not (r[1] or "").split() or r[0] in mine:
            stay.append(r)
    stay = [r for i, r in enumerate(stay) if r not in stay[:i]]
    df = spark.createDataFrame(kept, DOCS)
    second = corpus_pipeline.STAGES[1][1](spark, df, sf)
    assert second.schema == df.schema
    assert sorted(map(str, second.collect())) == sorted(str(T.Row(**dict(zip(DOCS.names, r)))) for r in stay)

    clean = [r for r in stay if items[0][1] not in (r[1] or "")]
    third = corpus_pipeline.STAGES[2][1](spark, spark.createDataFrame(stay, DOCS), sf)
    assert sorted(r[0] for r in third.collect()) == sorted(r[0] for r in clean) and third.schema == df.schema

    fourth = corpus_pipeline.STAGES[3][1](spark, spark.createDataFrame(clean, DOCS), sf)
    said = {r["doc_id"]: r for r in fourth.collect()}
    for d, t, *_ in clean:
        if (d, t) != (9, rows[-1][1]):
            want = None if t is None else re.sub(rf'token = "{HEX40}', "[SECRET]", t)
            assert said[d]["text"] == want or d == 9
    assert all(r["n_chars"] == len(r["text"] or "") for r in said.values())

    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == {r[0] for r in clean}
    assert sum(r["length"] for r in out) == sum(r["doc_tokens"] for r in out if r["start"] == 0)
    assert ngram_join.WORDS == 5 and secret_scan.KINDS[0] == "assign"


def test_what_a_stage_has_read_goes(spark, tmp_out, monkeypatch):
    """Only the rows that the last stage reads, and what near_duplicates still reads when its rows are written, stay on disk."""
    from lakeloom.session import checkpoint_root, list_names
    all_names = lambda: set(list_names(spark, f"{checkpoint_root(spark)}/lakeloom"))
    sf = tmp_out("sf")
    spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e  f"), (3, "u v w x y z")], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    before = all_names()
    clean = ngram_join.without_near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    assert {n.rsplit("-", 1)[0] for n in all_names() - before} == {"ngram-away", "ngram-again"}
    assert sorted(r["doc_id"] for r in clean.collect()) == [1, 3]
    same = lambda spark, docs, sf_dir: docs
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", same), ("two", same), ("three", same), ("four", same)])
    before = all_names()
    assert corpus_pipeline.run(spark, sf).count() == 3
    assert {n.rsplit("-", 1)[0] for n in all_names() - before} == {"corpus-three"}
