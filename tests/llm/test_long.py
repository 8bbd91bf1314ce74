"""Operators 3 and 6 on texts that make ties and repeats: they end, and give the rows of brute force."""

import hashlib
import itertools
import random
import time

import pytest

from blockloom.llm import decontam, pieces, queries


@pytest.fixture(scope="module")
def coder():
    return pieces.Segmenter(queries.tokenizer_file("piece_bpe_32k.model"))


def paths(coder, text):
    """Every segmentation of a segment as (score, ids)."""
    v = coder.v
    known = {v.decoded[i].decode(errors="ignore"): (s, i) for _, ids, scores, _ in v.tables.values() for i, s in zip(ids.tolist(), scores.tolist())}
    if not text:
        return [(0.0, ())]
    out = [(known[text[:n]][0] + s, (known[text[:n]][1], *ids)) for n in range(1, len(text) + 1) if text[:n] in known for s, ids in paths(coder, text[n:])]
    if text[0] not in known:
        raw = text[0].encode()
        out += [(len(raw) * v.byte_score + s, (*(v.bytes[b] for b in raw), *ids)) for s, ids in paths(coder, text[1:])]
    return out


@pytest.mark.parametrize("long", [False, True])
def test_op3_ties(coder, monkeypatch, long):
    """Scores of the n best are those of all segmentations, and each one is a segmentation of its score."""
    if long:
        monkeypatch.setattr(pieces, "LONG", 0)
        monkeypatch.setattr(pieces, "STRETCH", 3)
    dice = random.Random(2)
    for text in ["aaaaaaa", "ababab", "thethe", "ééé", "ing日ing", *("".join(dice.choice("atheé") for _ in range(dice.randrange(1, 8))) for _ in range(12))]:
        coder.clear()
        every = paths(coder, " " + text)
        scores = {}
        for s, ids in every:
            scores.setdefault(ids, s)
        ids, best, own = next(iter(coder.encode([text], 4)))
        assert [s for s, _ in best] == pytest.approx(sorted((s for s, _ in every), reverse=True)[:4])
        full = [tuple(p for j, x in enumerate(own.tolist()) for p in dict(changed).get(j, coder.ids(x).tolist())) for _, changed in best]
        assert len(set(full)) == len(full) and [scores[x] for x in full] == pytest.approx([s for s, _ in best]) and full[0] == tuple(ids.tolist())
    coder.clear()


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 15_000, " " * 20_000, "".join(itertools.islice(itertools.cycle("qwertyuiopé日"), 60_000)), ("a" * 1000 + " ") * 30])
def test_op3_long(coder, text):
    began = time.time()
    ids, best, _ = next(iter(coder.encode([text])))
    assert coder.v.decode(ids) == text and [s for s, _ in best] == sorted((s for s, _ in best), reverse=True)
    assert time.time() - began < 60
    coder.clear()


def test_op6_repeats(spark):
    """Words that repeat on both sides: every place against every place would be 10^8 pairs."""
    docs = spark.createDataFrame([(1, "a " * 60_000), (2, "b a " * 20_000), (3, "c " + "a " * 12), (4, "a " * 13), (5, "x y " * 30 + "a " * 14), (6, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a " * 2000), (2, "A b " * 900), (3, "a"), (4, "a " * 13)], "item_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontam.contamination(docs, items).collect()}
    assert got == {1: (60_000, 60_000, 3, True), 2: (40_000, 40_000, 2, True), 3: (13, 12, 1, True), 4: (13, 13, 3, True), 5: (74, 14, 3, True), 6: (1, 1, 1, True)}
    assert time.time() - began < 60


def test_op6_hot_passage(spark):
    """A passage of many items in many documents."""
    passage = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(i, f"{i} {passage} tail{i}") for i in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"head{i} {passage}") for i in range(200)], "item_id long, text string")
    got = decontam.contamination(docs, items).collect()
    sha = hashlib.sha256(",".join(sorted(map(str, range(200)))).encode()).hexdigest()
    assert {(r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got} == {(22, 20, 200, sha)} and len(got) == 300
