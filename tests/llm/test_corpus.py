"""Operators 1, 2, 4, 6, 9, 10 against brute force, on sf0.01 and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from blockloom.llm import neardup, queries, sharding, substring, token_store
from blockloom.llm.words import argmin_slide

THUE = "a"
for _ in range(11):
    THUE += THUE.translate(str.maketrans("ab", "ba"))
ODD = [
    (20, THUE, "en"), (21, THUE.translate(str.maketrans("ab", "ba")), "en"), (22, f"{THUE}\n{THUE.translate(str.maketrans('ab', 'ba'))}", "en"), (23, " ".join(THUE), "en"), (24, " ".join(THUE.translate(str.maketrans("ab", "ba"))), "en"),
    (1, None, "en"), (2, "", "en"), (3, " \t\n\r\x0b\x0c ", "de"), (4, "one", None), (4, "one", None), (5, "a\x00b é ü x  y  z \n", "fr"),
    (6, "w " * 30_000, "en"), (7, " ".join(f"t{i}" for i in range(120)), "en"), (8, "lead " + " ".join(f"t{i}" for i in range(120)) + " tail", "en"),
    (9, " ".join(f"T{i}" for i in range(120)), "en"), (10, "Don't <|endoftext|> stop\r\n\r\n  now", None), (None, "no id at all", "en"),
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, i, "x", i) for i, r in enumerate(ODD)], "doc_id long, text string, lang string, n int, k string, at int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_argmin():
    h = np.array([5, 3, 3, 9, 1, 7, 1, 2], np.uint64)
    for w in range(1, 9):
        assert argmin_slide(h, w).tolist() == [i + int(np.argmin(h[i : i + w])) for i in range(len(h) - w + 1)]


def test_op1(spark, sf, rows, odd, empty):
    got = {r.doc_id: r for r in queries.QUERIES["op1_byte_shards"](spark, sf).collect()}
    total, before, seen = sum(len(t.encode()) + 16 for _, t in rows), 0, collections.Counter()
    for k, t in rows:
        size = len(t.encode()) + 16
        r, shard = got[k], min(39, (2 * before + size) * 40 // (2 * total))
        assert (r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) == (size, zlib.crc32(t.encode()), "bytes", shard, seen[shard], None)
        before, seen[shard] = before + size, seen[shard] + 1
    assert sharding.byte_shards(odd, 3).count() == len(ODD)
    assert sharding.byte_shards(empty, 3).count() == 0


def test_op2(spark, sf, rows, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def expect(rows):
        start, out = 0, []
        for k, t in rows:
            ids = [*model.encode(t, add_special_tokens=False).ids, 0]
            out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        return out

    got = queries.QUERIES["op2_token_store"](spark, sf).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expect(rows)
    named = sorted(((k, t or "") for k, t, _ in ODD), key=lambda x: x[0] or 0)
    files = token_store.write_store(odd, public_tokenizers.path("byte_bpe_50k.json"))
    assert [tuple(r) for r in token_store.read_store(files).orderBy("start").collect()] == expect(named)
    some = {r.doc_id: r.ids for r in token_store.fetch(files, [7, 10]).collect()}
    assert set(some) == {7, 10} and some[10] == [*model.encode(dict(named)[10], add_special_tokens=False).ids, 0]
    assert token_store.read_store(token_store.write_store(empty, public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


def test_frames_are_read_alone(tmp_path):
    import pyarrow.fs as pafs

    fs = pafs.LocalFileSystem()
    w = token_store.Writer(fs.open_output_stream(str(tmp_path / "x"), compression=None), frame_ids=100)
    for i in range(40):
        w.put(i, np.arange(i, dtype=np.uint32))
    w.close()
    data = bytearray((tmp_path / "x").read_bytes())
    first = token_store.frames(fs.open_input_file(str(tmp_path / "x")))[0]
    data[first[1] // 2] ^= 0xFF
    (tmp_path / "x").write_bytes(data)
    file = fs.open_input_file(str(tmp_path / "x"))
    assert [d for d, _ in token_store.read_documents(file, [39])] == [39]  # the damaged frame isn't touched
    with pytest.raises(Exception):
        list(token_store.read_documents(file))


def cut(rows, n=50):
    first, words = {}, {k: t.encode().split() for k, t in rows}
    for k, w in sorted(words.items(), reverse=True):
        for i in range(len(w) - n + 1):
            first[tuple(w[i : i + n])] = k
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < k:
                gone[i : i + n] = [True] * n
        out[k] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def cut_by(spans, rows):
    gone = {(r.k, i) for r in spans.collect() for x in r.spans for i in range(x.at, x.end)}
    out = {}
    for k, t in rows:
        w = t.encode().split()
        kept = [x for i, x in enumerate(w) if (k, i) not in gone]
        out[k] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_op4(spark, sf, rows, odd, empty):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.QUERIES["op4_substring_dedup"](spark, sf).collect()}
    assert got == cut(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(odd).where("doc_id is not null").collect()}
    assert got == cut([(k, t or "") for k, t, _ in ODD if k is not None])
    assert got[8][1] == 120 and got[6][1] == 0
    assert substring.remove_repeats(empty).count() == 0


def test_op4_many_edits(spark):
    """A family of copies with words replaced, so that every window must be found through the automaton."""
    base, rows = [f"b{i}" for i in range(400)], []
    rng = np.random.default_rng(5)
    for k in range(40):
        w = list(base)
        for i in rng.integers(0, 400, 5):
            w[i] = f"e{rng.integers(0, 3)}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(df).collect()} == cut(rows)
    # every anchor counts as crowded
    assert {(r.k, x.at, x.end) for r in substring.repeated_windows(df, crowded=1).collect() for x in r.spans} and cut(rows) == cut_by(substring.repeated_windows(df, crowded=1), rows)


def components(rows, k, percent=80):
    sets = {}
    for d, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t).encode().split()
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    has = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            has[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        shared = collections.Counter(e for x in s for e in has[x] if e > d)
        for e, i in shared.items():
            if 100 * i >= percent * (len(s) + len(sets[e]) - i):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def test_op9(spark, sf, rows, odd, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.QUERIES["op9_minmax_neardup"](spark, sf).collect()}
    assert got == components(rows, 4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(odd, 4).where("doc_id is not null").collect()}
    assert got == components([(k, t or "") for k, t, _ in ODD if k is not None], 4)
    assert neardup.near_duplicates(empty).count() == 0


def test_op9_family(spark):
    """Copies of one text with few to many replaced words: links on both sides of the threshold."""
    rng, rows = np.random.default_rng(3), []
    for k in range(300):
        w = [f"b{i}" for i in range(150)]
        for i in rng.integers(0, 150, rng.integers(0, 12)):
            w[i] = f"e{rng.integers(0, 1000)}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df, 5).collect()} == components(rows, 5)
