"""Empty tables, odd rows and clashing names for operators 5, 7, 9, 10 and each stage; operator 10 against plain sums."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blockloom.llm import langid, neardup, pii, quality, queries
from blockloom.llm.words import Words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def odd(spark):
    long = "".join(f"Mr {chr(65 + i % 26)}ab{chr(97 + i % 25)} wrote to a{i}@b.org " for i in range(1_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id here", "en", None, 10), (3, "same words again and again for once", "en", "s", 9), (3, "same words again and again for once", "en", "s", 9), (4, long, "de", "s", len(long)), (5, "a" * 300_000, "de", "s", 300_000), (6, " \n\t", None, "s", 3)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, sf, empty, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, empty, sf).count() == 0
    last = name == corpus_pipeline.STAGES[-1][0]
    got = stage(spark, odd, sf)
    assert last or got.columns == odd.columns
    keys = collections.Counter(r.doc_id for r in got.select("doc_id").collect())
    want = {"language ID": {None: 1, 3: 2, 4: 1, 5: 1}, "MinHash near-dedup": {1: 1, 2: 1, None: 1, 3: 1, 4: 1, 5: 1, 6: 1}}.get(name, {1: 1, 2: 1, None: 1, 3: 2, 4: 1, 5: 1, 6: 1})
    assert dict(keys) == want


def test_op5_edges(spark, empty, odd):
    docs = spark.createDataFrame([(1, "abc abd", "b"), (2, "abc abd", "a"), (3, "xyz", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "a", 2: "a", 3: "a"} and got[1][1] == pytest.approx(0.5)  # equal languages: the first in name
    assert langid.predict(empty, model, ["doc_id"]).count() == 0 and langid.predict(odd, model, ["doc_id"]).count() == odd.count()
    for name in ("lang_pred", "score"):
        with pytest.raises(ValueError, match="names of results"):
            langid.predict(docs.withColumn(name, F.lit(1)), model, [name])


def test_op7_edges(spark, empty, odd):
    assert pii.replace_entities(empty, "k").count() == 0
    got = pii.replace_entities(odd.withColumn("n_entities", F.lit("x")), "k")
    rows = {(r.doc_id, r.text if r.doc_id != 4 else None): r.n_entities for r in got.collect()}
    assert got.columns == [*odd.columns, "n_entities"] and rows[4, None] == 2_000 and rows[1, None] == 0 and rows[2, ""] == 0


def test_op9_edges(spark, empty, odd):
    assert neardup.near_duplicates(empty).count() == 0
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(odd).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got[3, 3, 3, True] == 2 and got[1, 0, 1, True] == 1 and got[5, 1, 5, True] == 1 and got[None, 1, None, True] == 1 and sum(got.values()) == odd.count()


def test_op10_plain(spark, empty):
    """Ratios, the threshold and the verdicts of the query, by plain sums over the n-grams' buckets."""
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    raw_of = {k: t.encode() for k, t in docs}
    grams_of = {k: quality.features(Words(np.frombuffer(t, np.uint8), np.array([0, len(t)]), fold=True), quality.BUCKETS)[0].tolist() for k, t in raw_of.items()}
    fits = {r.doc_id for r in labels.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(quality.FIT)) == 0).collect()}
    bad = {r.doc_id for r in labels.collect() if r.quality == 0 or r.toxic == 1}
    good = {r.doc_id for r in labels.collect() if r.quality == 1} - bad
    count = lambda keys: collections.Counter(b for k in keys for b in grams_of[k])
    target, raw = count(good - fits), count(grams_of)
    size = quality.BUCKETS
    ratio = lambda b: math.log((target[b] + 1) / (sum(target.values()) + size)) - math.log((raw[b] + 1) / (sum(raw.values()) + size))
    llr = {k: sum(map(ratio, g)) / max(len(g), 1) for k, g in grams_of.items()}
    got = {r.doc_id: r for r in queries.QUERIES["op10_ngram_ratio"](spark, sf).collect()}
    assert all(got[k].llr == pytest.approx(v, abs=1e-9) for k, v in llr.items())
    # the steps' edges at which fewest labelled rows are on the wrong side, the least of equals
    known = [(math.floor(got[k].llr * quality.STEPS), k in good) for k in (good & fits) | bad if k in got and not got[k].base_failed]
    steps = sorted({s for s, _ in known})
    wrong = lambda at: sum(quality.FIT for s, ok in known if ok and s <= at) + sum(1 for s, ok in known if not ok and s > at)
    best = min([steps[0] - 1, *steps], key=lambda at: (wrong(at), at))
    kept = {k for k, r in got.items() if r.kept}
    if best >= steps[0]:
        after = min([s for s in steps if s > best], default=best + 1)
        edge = (best + 1 + after) / 2 / quality.STEPS
        assert kept == {k for k, r in got.items() if not r.base_failed and r.llr >= edge}
    else:
        assert kept == {k for k, r in got.items() if not r.base_failed and r.llr >= steps[0] / quality.STEPS}
    assert quality.judge(empty, np.zeros(16)).count() == 0 and quality.quality(empty, labels).count() == 0 and quality.quality(empty, labels.limit(0)).count() == 0
    clash = spark.createDataFrame([(None, "some words", 1.0), (1, None, 2.0), (1, "x", 3.0)], "doc_id long, text string, llr double")
    assert sorted(r.n_words for r in quality.quality(clash, labels).collect()) == [0, 1, 2]
