"""Removal of long word sequences that an earlier document has (operator 4).

Suffix automata of reference shards, streamed for matching statistics. A shard holds the passages around one anchor: the
least 12-gram hash of a window. Equal windows choose equal anchors, so a window and every earlier copy of it meet in
one shard, and the work grows with the repeated text, not with shards times documents. Passages that are equal word for
word are one entry of the shard with the least document that has it; the automaton is built over entries in ascending
document order, and each entry is streamed against the automaton of those before it.

The automata aren't broadcast: the reference is the whole corpus, for which no bound holds. Passages travel to their
shard by the anchor instead. A crowded anchor (a phrase with many contexts) is split: its passages are cut where the least
gram under one of SPLITS further hashes changes, and these grams, which equal windows share too, name the shard.

Passages count as equal by two 64-bit hashes, of the anchor's gram and of the words' hashes (neither is linear, so it isn't
the structure of a text that makes them agree); two different ones of one anchor are taken for equal with a chance of 2^-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, staged
from blockloom.llm.words import Words, argmin_slide, chunks, grams, mix

WINDOW, GRAM = 50, 12
#: Anchors of more entries are split by this many further hashes.
CROWDED, SPLITS = 256, 4


def passages(words: Words, window: int, gram: int):
    """(text, anchor, first window, number of windows, hash) of each run of windows with one anchor."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 5
    g = grams(words.hash, gram)
    p = argmin_slide(g, window - gram + 1)[:n]
    whole = words.doc[:n] == words.doc[window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (p[1:] != p[:-1]) | ~whole[:-1] | (words.doc[1:n] != words.doc[: n - 1])
    starts = np.flatnonzero(whole & new)
    stops = np.append(np.flatnonzero(new), n)
    ends = stops[np.searchsorted(stops, starts, "right")]
    doc = words.doc[starts]
    raw = words.hash.tobytes()
    snip = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip((8 * starts).tolist(), (8 * (ends + window - 1)).tolist(), strict=True)], np.uint64)
    return doc, g[p[starts]], starts - words.first[doc], ends - starts, snip


def split(body: bytes, window: int, gram: int) -> list[tuple[int, int, int]]:
    """(shard, first, end window) of the runs of a passage's windows whose least grams under all further hashes are the same."""
    h = Words(np.frombuffer(body, np.uint8), np.array([0, len(body)])).hash
    g, key = grams(h, gram), np.zeros(len(h) - window + 1, np.uint64)
    for i in range(1, SPLITS + 1):
        v = mix(g ^ np.uint64(i))
        key = mix(key ^ v[argmin_slide(v, window - gram + 1)])
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return list(zip(key[at].view(np.int64).tolist(), at.tolist(), [*at[1:].tolist(), len(key)], strict=True))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class Automaton:
    """Suffix automaton over words of several texts; each state knows the first text it was made for."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.owner = [-1], [0], [-1]

    def _add(self, length: int, owner: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.len.append(length)
        self.owner.append(owner)
        return len(self.len) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A copy of q for the shorter strings that reach it from p."""
        copy = self._add(self.len[p] + 1, self.owner[q], dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def insert(self, words: list[bytes], owner: int) -> None:
        last = 0
        for w in words:
            q = self.next[last].get(w)
            if q is not None:
                last = q if self.len[q] == self.len[last] + 1 else self._split(last, w, q)
                continue
            state = self._add(self.len[last] + 1, owner, {}, 0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                self.link[state] = q if self.len[q] == self.len[p] + 1 else self._split(p, w, q)
            last = state

    def repeats(self, words: list[bytes], owner: int, window: int) -> list[int]:
        """First words of the windows that a text with a smaller owner has: matching statistics cut at the window."""
        out, state, size = [], 0, 0
        following, link, length = self.next, self.link, self.len
        for i, w in enumerate(words):
            q = following[state].get(w)
            while q is None and state:
                state = link[state]
                size = length[state]
                q = following[state].get(w)
            if q is None:
                continue
            state, size = q, size + 1
            if size >= window:
                while length[link[state]] >= window:
                    state = link[state]
                size = window
                if self.owner[state] < owner:
                    out.append(i - window + 1)
        return out


def _runs(at: list[int]) -> list[int]:
    """[start, end, start, end, ...] of runs of consecutive numbers."""
    out: list[int] = []
    for i in at:
        if out and out[-1] == i:
            out[-1] = i + 1
        else:
            out += [i, i + 1]
    return out


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """(k, fp, spans) for texts with removed windows; spans: (first word, end word) of runs, ends past the last word."""
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("fp"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1)):
                doc, anchor, at, n, snip = passages(Words(data, offsets), window, gram)
                if len(doc):
                    rows = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).take(rows), b.column(2).slice(lo, hi - lo).take(rows), _signed(anchor), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), _signed(snip)], names=["k", "fp", "anchor", "at", "n", "snip"])

    rows = staged(source.where("k is not null").mapInArrow(released(anchors), "k long, fp long, anchor long, at int, n int, snip long"), "passages")
    entries = rows.groupBy("anchor", "snip").agg(F.min(F.struct("k", "fp", "at", "n")).alias("first"), F.max("k").alias("last"))
    shared = entries.groupBy("anchor").agg(F.count(F.lit(1)).alias("entries"), F.max("last").alias("hi"), F.min("first.k").alias("lo")).where("hi > lo")
    entries = staged(entries.join(shared.select("anchor", "entries"), "anchor"), "entries")

    # entries that meet others under their anchor: their words, from the first document that has them
    wanted = entries.where("entries > 1").groupBy(F.col("first.k").alias("k"), F.col("first.fp").alias("fp")).agg(F.collect_list(F.struct("anchor", "snip", F.col("first.at").alias("at"), F.col("first.n").alias("n"), (F.col("entries") > crowded).alias("many"))).alias("want"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, k, out = b.column(1)[i].as_py().encode().split(), b.column(0)[i].as_py(), []
                for x in b.column(2)[i].as_py():
                    part = words[x["at"] : x["at"] + x["n"] + window - 1]
                    for shard, lo, hi in split(b" ".join(part), window, gram) if x["many"] else ((0, 0, x["n"]),):
                        out.append((x["anchor"], shard, x["snip"], lo, k, b" ".join(part[lo : hi + window - 1])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["anchor", "shard", "snip", "off", "k", "body"])

    bodies = source.join(wanted, ["k", "fp"]).select("k", "t", "want").mapInArrow(released(cut), "anchor long, shard long, snip long, off int, k long, body binary")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard, seen = None, Automaton(), set()
        for b in batches:
            out: dict[str, list] = {"anchor": [], "snip": [], "again": []}
            for anchor, part, snip, off, k, body in zip(*(b.column(c).to_pylist() for c in ("anchor", "shard", "snip", "off", "k", "body")), strict=True):
                if (anchor, part) != now:
                    now, shard, seen = (anchor, part), Automaton(), set()
                if (snip, off) in seen:  # a repeated row
                    continue
                seen.add((snip, off))
                words = body.split()
                again = shard.repeats(words, k, window)
                shard.insert(words, k)
                if again:
                    for c, v in zip(out, (anchor, snip, [x + off for x in _runs(again)]), strict=True):
                        out[c].append(v)
            if out["snip"]:
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("anchor", pa.int64()), ("snip", pa.int64()), ("again", pa.list_(pa.int32()))]))

    found = bodies.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard", "k", "snip", "off").mapInArrow(released(match), "anchor long, snip long, again array<int>")

    # a document after the first that has an entry loses all its windows; the first loses those that streaming found
    known = entries.where("last > first.k").select("anchor", "snip", F.col("first.k").alias("first_k"))
    later = rows.join(known, ["anchor", "snip"]).where("k > first_k").select("k", "fp", "at", (F.col("at") + F.col("n") + window - 1).alias("end"))
    own = found.join(entries.select("anchor", "snip", F.col("first.k").alias("first_k")), ["anchor", "snip"]).join(rows, ["anchor", "snip"]).where("k = first_k")
    own = own.select("k", "fp", "at", F.explode(F.expr("transform(sequence(0, size(again) div 2 - 1), i -> named_struct('a', again[2 * i], 'b', again[2 * i + 1]))")).alias("r"))
    own = own.select("k", "fp", (F.col("at") + F.col("r.a")).alias("at"), (F.col("at") + F.col("r.b") + window - 1).alias("end"))
    return later.unionByName(own).groupBy("k", "fp").agg(F.collect_set(F.struct("at", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256[, kept]) for each row of docs.

    A word goes if a window of `window` words over it is, word for word, also a window of a document with a smaller key.
    Null or empty text: no words, the hash of the empty string. Rows that share key and text lose the same words; two
    texts under one key don't count as earlier for each other. A null key: nothing is removed. An empty table gives no rows.
    Keys are whole numbers (others are cast to long). Other columns aren't read, also where they have the name of a result.
    """
    spans = repeated_windows(docs, window, key=key, text=text)
    whole = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("fp")).join(spans, ["k", "fp"], "left").select("k", "t", "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for t, spans in zip(b.column(1), b.column(2), strict=True):
                words = (t.as_py() or "").encode().split()
                n = len(words)
                if spans.is_valid:
                    gone = np.zeros(n, bool)
                    for x in spans.as_py():
                        gone[x["at"] : x["end"]] = True
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = b" ".join(words)
                out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            n, removed, sha, kept = zip(*out, strict=True) if out else ((), (), (), ())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array([x.decode() for x in kept], pa.string())] if keep_text else []), names=[key, "n_words", "n_removed", "kept_sha256"] + ["kept"] * keep_text)

    return whole.mapInArrow(released(apply), f"{key} long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)
