"""Removal of long byte strings that stand earlier in the corpus (operator 11).

Common-prefix interval trees of enhanced suffix arrays. A window of 100 bytes is filed under its anchor, the least hash of
the 24-byte grams in it; equal windows have equal anchors, wherever they stand. A passage is a run of windows of one text
with one anchor. Anchors of a single passage are dropped by counts; passages that are equal byte for byte are one entry,
kept with its earliest place, and every later place goes whole.

What else repeats are parts of different entries of an anchor. The entries' bytes go to the anchor's shard, in order of
their places. Each task ranks the suffixes of its shards by prefix doubling up to a window, sorts those that share one
into a suffix array, takes the common prefixes of neighbours from the ranks, and scans both with a stack: each interval of suffixes with a common prefix of at least a window
closes as a node of the tree. A node whose suffixes stand after different bytes, or at the edge of a passage, is a maximal
repeat group with all its occurrences. All but the earliest occurrence go: each suffix is handed out once, at the deepest
node where an earlier one joins it, so nested groups cost no more than the suffixes.

A crowded anchor (a phrase in many contexts) is split by the least hash of the 80-byte grams of a window, which equal
windows share too. Passages of periodic text are cut at LONGEST windows. A shard that is still of more than GATHERED bytes is
taken in parts, in order of places: each part has its own suffix array, and only windows without an earlier one in their part
are kept and compared over all parts, by classes of equal windows (`Large`). Anchor and body hashes (128 bits, not linear)
decide equality of whole passages; within a shard bytes are compared.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, staged
from blockloom.llm.words import argmin_slide, chunks, mix

WINDOW, GRAM, LONGEST = 100, 24, 4096
#: Anchors of more entries are split by longer grams. Shards are gathered to about so many bytes for one suffix array.
CROWDED, SPLIT_GRAM, GATHERED = 256, 80, 1 << 19
#: Ranks that suffixes are sorted by at once, before those that still tie go on.
STRETCHES = 8
_P, _EDGE = np.uint64(0x9E3779B97F4A7C15), 256


def byte_grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of `gram` bytes (a multiple of 8), eight bytes a step."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    h = np.full(n, gram, np.uint64)
    for j in range(0, gram, 8):
        h = (h ^ eight[j : j + n]) * _P
        h ^= h >> np.uint64(29)
    return mix(h)


def passages(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """(text, anchor, first window, windows, body hash, whether the anchor's gram stands in it twice) of each passage."""
    n = len(data) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 6
    g = byte_grams(data, gram)
    p = argmin_slide(g, window - gram + 1)[:n]
    v = g[p]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = text[:n] == text[window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (v[1:] != v[:-1]) | ~whole[:-1] | ~whole[1:]
    starts = np.flatnonzero(whole & new)
    stops = np.append(np.flatnonzero(new), n)
    size = stops[np.searchsorted(stops, starts, "right")] - starts
    times = -(-size // LONGEST)
    if (times > 1).any():
        part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        starts = np.repeat(starts, times) + part * LONGEST
        size = np.minimum(np.repeat(size, times) - part * LONGEST, LONGEST)
    ends = starts + size
    raw = data.tobytes()
    snip = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), (ends + window - 1).tolist(), strict=True)), np.uint64, len(starts))
    return text[starts], v[starts], starts - offsets[text[starts]], size, snip, p[starts] != p[ends - 1]


def split(body: bytes, window: int) -> list[tuple[int, int, int]]:
    """(shard, first, end window) of the runs of a body's windows whose least long gram is the same."""
    gram = min(SPLIT_GRAM, window // 8 * 8)
    g = byte_grams(np.frombuffer(body, np.uint8), gram)
    key = g[argmin_slide(g, window - gram + 1)]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return list(zip(key[at].view(np.int64).tolist(), at.tolist(), [*at[1:].tolist(), len(key)], strict=True))


def ranks(data: np.ndarray, left: np.ndarray, window: int) -> list[tuple[int, np.ndarray]]:
    """Ranks (from 1, equal for equal strings) of all suffixes by their first 8, 16, ... bytes, up to the last power within a window.

    left: bytes from each position to the end of its own body. A suffix ends with its body and sorts before what it is
    the start of.
    """
    n = len(data)
    eight = np.ndarray((n,), ">u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,)).astype(np.uint64)
    tail = np.flatnonzero(left < 8)  # bytes past the body's end don't count
    eight[tail] &= ~(np.uint64((1 << 64) - 1) >> (8 * left[tail]).astype(np.uint64))
    order = np.argsort(eight)
    sorted_, short = eight[order], np.minimum(left, 8)[order]
    fresh = sorted_[1:] != sorted_[:-1]
    if (short[1:] != short[:-1])[~fresh].any():  # zero bytes at a body's end
        order = np.lexsort((np.minimum(left, 8), eight))
        sorted_, short = eight[order], np.minimum(left, 8)[order]
        fresh = (sorted_[1:] != sorted_[:-1]) | (short[1:] != short[:-1])
    levels, h = [], 8
    while True:
        rank = np.empty(n, np.int64)
        rank[order] = np.append(1, 1 + np.cumsum(fresh))
        levels.append((h, rank))
        if 2 * h > window:
            return levels
        key = rank << 32
        key[: n - h] |= np.where(left[: n - h] > h, rank[h:], 0)
        order, h = np.argsort(key), 2 * h
        sorted_ = key[order]
        fresh = sorted_[1:] != sorted_[:-1]


def suffix_array(left: np.ndarray, levels: list[tuple[int, np.ndarray]], group: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Order of the suffixes at `places`, which ascend by group, by group and then by all their bytes."""
    h, rank = levels[-1]
    order, tied, slots, at = np.arange(len(places)), group.copy(), np.arange(len(places)), 0
    # a suffix that has ended sorts before those that go on, so it stays with them
    while (left[of := places[order[slots]]] > at).any():
        keys = [tied[slots]]
        for j in range(at, at + h * STRETCHES, h):
            more = left[of] > j
            if not more.any():
                break
            keys.append(np.where(more, rank[np.where(more, of + j, 0)], 0))
        by, at = np.lexsort(keys[::-1]), at + h * STRETCHES
        order[slots] = order[slots][by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = np.any([k[by[1:]] != k[by[:-1]] for k in keys], axis=0)
        tied[slots] = np.maximum.accumulate(np.where(fresh, slots, 0))
        slots = slots[~(fresh & np.append(fresh[1:], True))]
    return order


def common_prefixes(data: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Length of the common prefix of suffixes a[i] and b[i], by ranks of whole stretches, then byte by byte."""
    most, same = np.minimum(left[a], left[b]), np.zeros(len(a), np.int64)
    for h, rank in reversed(levels):
        at = np.arange(len(a))
        while len(at):
            at = at[same[at] < most[at]]
            at = at[rank[a[at] + same[at]] == rank[b[at] + same[at]]]
            same[at] = np.minimum(same[at] + h, most[at])
            if h < levels[-1][0]:
                break
    live = np.flatnonzero(same < most)
    for _ in range(8):
        live = live[data[a[live] + same[live]] == data[b[live] + same[live]]]
        same[live] += 1
        live = live[same[live] < most[live]]
    return same


def interval_tree(places: list[int], common: list[int], before: list[int], window: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """((place, length) of suffixes that have an earlier one, (length, first, end) of maximal repeat groups).

    places: suffixes in order; common[i]: common prefix of i - 1 and i; before: the byte before each, _EDGE at an edge. A
    node is [length, first, earliest place, byte before, whether these differ, places that an earlier one joined].
    """
    again, groups, stack, n = [], [], [], len(places)
    for i in range(n):
        length = common[i + 1] if i + 1 < n else 0
        first, best, char, differ = i, places[i], before[i], before[i] == _EDGE
        while stack and stack[-1][0] > length:
            node = stack.pop()
            _join(node, best, char, differ)
            if node[4]:
                again += [(x, node[0]) for x in node[5]]
                groups.append((node[0], node[1], i + 1))
            _, first, best, char, differ, _ = node
        if stack and stack[-1][0] == length:
            _join(stack[-1], best, char, differ)
        elif length >= window:
            stack.append([length, first, best, char, differ, []])
    return again, groups


def _join(node: list, best: int, char: int, differ: bool) -> None:
    node[4] = node[4] or differ or char != node[3]
    node[5].append(max(best, node[2]))
    node[2] = min(best, node[2])


def joined(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the bodies end to end, bytes from each to the end of its body, first place of each body)."""
    size = np.array([len(x) for x in bodies])
    ends = np.cumsum(size)
    return np.frombuffer(b"".join(bodies), np.uint8), np.repeat(ends, size) - np.arange(size.sum()), ends - size


def trees(data: np.ndarray, left: np.ndarray, first: np.ndarray, window: int) -> Iterator[tuple[list[int], list[tuple[int, int]], list[tuple[int, int, int]]]]:
    """(places in order, what interval_tree finds in them) of each set of suffixes that share a window, over `joined` bodies."""
    before = np.append(_EDGE, data[:-1].astype(np.int64))
    before[first] = _EDGE
    levels = ranks(data, left, window)
    h, rank = levels[-1]
    # suffixes that share a window; where all stand after one byte no node above them is maximal, so these aren't sorted
    places = np.flatnonzero(left >= window)
    key = rank[places] << 32 | rank[places + window - h]
    by = np.argsort(key)
    key, places = key[by], places[by]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    lo, hi, many = np.minimum.reduceat(before[places], heads), np.maximum.reduceat(before[places], heads), np.diff(np.append(heads, len(places)))
    wanted = (many > 1) & ((lo != hi) | (hi == _EDGE))
    places, group = places[np.repeat(wanted, many)], np.repeat(np.arange(wanted.sum()), many[wanted])
    if len(places):
        order = places[suffix_array(left, levels, group, places)]
        common = np.append(0, common_prefixes(data, left, order[:-1], order[1:], levels))
        del levels, rank, key, by
        heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        common[heads] = 0
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
            places_ = order[a:b].tolist()
            yield places_, *interval_tree(places_, common[a:b].tolist(), before[order[a:b]].tolist(), window)


def shard_repeats(bodies: list[bytes], window: int) -> tuple[list[tuple[int, int]], list[tuple[int, list[int]]], np.ndarray]:
    """((place, length) that go, (length, places) of maximal repeat groups, first place of each body), over bodies end to end.

    Groups are nested: in periodic text their places together grow with the square of it. `removed` doesn't gather them.
    """
    data, left, first = joined(bodies)
    again, groups = [], []
    for places, gone, found in trees(data, left, first, window):
        again += gone
        groups += [(length, places[x:y]) for length, x, y in found]
    return again, groups, first


def removed(bodies: list[bytes], window: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
    """((first, end) of runs of bytes that go, (first, end) of runs covered by windows without an earlier one, first place of each body).

    Places are over bodies end to end; no run goes over the edge of a body.
    """
    data, left, first = joined(bodies)
    place, length, n = array("q"), array("q"), len(data)
    for _, gone, _ in trees(data, left, first, window):
        for x, size in gone:
            place.append(x)
            length.append(size)
    x, size = np.array(place, np.int64), np.array(length, np.int64)
    fresh = np.flatnonzero((left >= window) & ~_covered(x, x + size - window + 1, n))
    edge = np.zeros(n, bool)
    edge[first] = True

    def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.flatnonzero(mask & (edge | ~np.append(False, mask[:-1]))), np.flatnonzero(mask & np.append(edge[1:] | ~mask[1:], True)) + 1

    return runs(_covered(x, x + size, n)), runs(_covered(fresh, fresh + window, n)), first


def _covered(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n places is in one of the ranges a to b."""
    return np.cumsum(np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1))[:n] > 0


class Large:
    """What goes of a shard that comes in parts, in order of places; holds the bytes of windows without an earlier one in their part.

    Such a window stands in each part once at most, so however often it repeats, classes of them stay small.
    """

    def __init__(self, window: int):
        self.window = window
        self.raw: list[bytes] = []
        self.held: list[tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]] = []  # size, k, fp, at of the runs

    def add(self, part: dict[str, pa.Array]) -> pa.RecordBatch:
        bodies = part["body"].to_pylist()
        gone, (a, b), first = removed(bodies, self.window)
        raw, body = b"".join(bodies), np.searchsorted(first, a, "right") - 1
        rows = pa.array(body)
        self.raw.append(b"".join(raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)))
        self.held.append((b - a, part["k"].take(rows), part["fp"].take(rows), np.asarray(part["at"])[body] + a - first[body]))
        return _spans(part["k"], part["fp"], np.asarray(part["at"]), first, *gone)

    def rest(self) -> Iterator[pa.RecordBatch]:
        """What goes by windows of an earlier part."""
        raw, size = b"".join(self.raw), np.concatenate([x[0] for x in self.held])
        k, fp, at = pa.concat_arrays([x[1] for x in self.held]), pa.concat_arrays([x[2] for x in self.held]), np.concatenate([x[3] for x in self.held])
        self.raw, first = [], np.cumsum(size) - size
        for x in self.classes(np.frombuffer(raw, np.uint8), first, size) if len(raw) > GATHERED else [None]:
            a, b = (first, first + size) if x is None else self.around(x, first)
            (lo, hi), _, start = removed([raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)], self.window)
            if len(lo):
                body = np.searchsorted(start, lo, "right") - 1
                yield _spans(k, fp, at, first, lo + (a - start)[body], hi + (a - start)[body])

    def around(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of the runs that the windows at x, ascending, cover in the runs held."""
        of = np.searchsorted(first, x, "right")
        new = np.append(True, (of[1:] != of[:-1]) | (x[1:] > x[:-1] + self.window))
        return x[new], x[np.append(new[1:], True)] + self.window

    def classes(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
        """Places of windows that may stand more than once, ascending; equal windows are in one class, of about GATHERED bytes."""
        window, gram, n = self.window, self.window // 8 * 8, len(data)
        whole = np.zeros(n, np.int8)  # 1 where a window begins
        whole[first], whole[first + size - window + 1] = 1, -1
        whole = np.cumsum(whole, dtype=np.int8, out=whole).view(bool)
        mark = np.zeros(n, np.uint32)
        for lo in range(0, n - gram + 1, GATHERED):
            found = byte_grams(data[lo : lo + GATHERED + gram - 1], gram)
            mark[lo : lo + len(found)] = found & np.uint64(0xFFFFFFFF)
        parts = -(-n // GATHERED)
        for c in range(parts):
            x = np.flatnonzero(whole & (mark % parts == c))
            by = np.argsort(mark[x])
            same = np.diff(mark[x[by]]) == 0
            x = x[by[np.append(False, same) | np.append(same, False)]] if len(x) else x
            times = -(-len(x) * window // GATHERED)
            for i in range(times):
                if len(y := x[mark[x] // parts % times == i]):
                    yield np.sort(y)


def _spans(k: pa.Array, fp: pa.Array, at: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(k, fp, a, b) of runs a to b over bodies that begin at `first`, in their texts at `at`."""
    body = np.searchsorted(first, a, "right") - 1
    rows, shift = pa.array(body), at[body] - first[body]
    return pa.RecordBatch.from_arrays([k.take(rows), fp.take(rows), pa.array((a + shift).astype(np.int32)), pa.array((b + shift).astype(np.int32))], names=["k", "fp", "a", "b"])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def shard_spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(k, fp, a, b): bytes a to b go, over rows of `Repeats.shards`. Memory is that of GATHERED bytes, and a large shard's distinct windows."""
    large, of = None, None
    for table, part in _gathered(batches, parted=True):
        if large and part != of:
            yield from large.rest()
            large = None
        if part:
            large, of = large or Large(window), part
            yield large.add(table)
        else:
            gone, _, first = removed(table["body"].to_pylist(), window)
            if len(gone[0]):
                yield _spans(table["k"], table["fp"], np.asarray(table["at"]), first, *gone)
    if large:
        yield from large.rest()


class Repeats:
    """Tables of the passages that repeat, over docs with a key and a text.

    `rows`: (k, fp, anchor, at, n, snip, loop) of all places of passages whose anchor stands more than once; `entries`: one
    row for each different passage, with its earliest place. Texts that share a key are ordered by a hash of the text, and
    rows that repeat both are one text. Null keys and texts shorter than a window have no passage.
    """

    def __init__(self, docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", crowded: int = CROWDED):
        if window < 8:
            raise ValueError("a window has 8 bytes at least")
        self.window, self.gram, self.crowded = window, min(GRAM, window // 8 * 8), crowded
        self.source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("fp"))
        self.key_type = dict(self.source.dtypes)["k"]
        kind, w, gram = self.key_type, window, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo, hi, data, offsets in chunks(b.column(1)):
                    of, anchor, at, n, snip, loop = passages(data, offsets, w, gram)
                    if len(of):
                        rows = pa.array(of)
                        cols = [b.column(0).slice(lo, hi - lo).take(rows), b.column(2).slice(lo, hi - lo).take(rows), _signed(anchor), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), _signed(snip), pa.array(loop)]
                        yield pa.RecordBatch.from_arrays(cols, names=["k", "fp", "anchor", "at", "n", "snip", "loop"])

        found = self.source.where(f"k is not null and octet_length(t) >= {w}").mapInArrow(released(run), f"k {kind}, fp long, anchor long, at int, n int, snip long, loop boolean")
        every = staged(found, "passages", tidy=True)
        several = every.groupBy("anchor").agg(F.sum(F.when(F.col("loop"), 2).otherwise(1)).alias("c")).where("c > 1").select("anchor")
        self.rows = staged(every.join(several, "anchor"), "repeated", tidy=True)
        each = self.rows.groupBy("anchor", "snip").agg(F.min(F.struct("k", "fp", "at", "n")).alias("first"), F.max(F.struct("k", "fp", "at", "n")).alias("last"), F.max("loop").alias("loop"))
        each = staged(each, "each", tidy=True)
        count = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("entries"))
        self.entries = staged(each.join(count, "anchor"), "entries", tidy=True)

    def bodies(self, entries: DataFrame) -> DataFrame:
        """(anchor, shard, snip, off, k, fp, at, body): the bytes of the entries, from their earliest places; twice where a row stands twice."""
        window, kind = self.window, self.key_type
        want = F.struct("anchor", "snip", F.col("first.at").alias("at"), F.col("first.n").alias("n"), (F.col("entries") > self.crowded).alias("many"))
        wanted = entries.groupBy(F.col("first.k").alias("k"), F.col("first.fp").alias("fp")).agg(F.collect_list(want).alias("want"))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    raw, row, out = b.column(2)[i].as_py().encode(), [], []
                    for x in b.column(3)[i].as_py():
                        part = raw[x["at"] : x["at"] + x["n"] + window - 1]
                        for shard, lo, hi in split(part, window) if x["many"] else ((0, 0, x["n"]),):
                            out.append((x["anchor"], shard, x["snip"], lo, x["at"] + lo, part[lo : hi + window - 1]))
                            row.append(i)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    anchor, shard, snip, off, at, body = (pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))
                    yield pa.RecordBatch.from_arrays([anchor, shard, snip, off, b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), at, body], names=["anchor", "shard", "snip", "off", "k", "fp", "at", "body"])

        return self.source.join(wanted, ["k", "fp"]).select("k", "fp", "t", "want").mapInArrow(released(cut), f"anchor long, shard long, snip long, off int, k {kind}, fp long, at int, body binary")

    def shards(self, entries: DataFrame) -> DataFrame:
        return self.bodies(entries).repartition("anchor", "shard").sortWithinPartitions("anchor", "shard", "k", "fp", "at")

    def spans(self) -> DataFrame:
        """(k, fp, a, b): bytes a to b go, all but the earliest occurrence of each repeat group."""
        window, kind = self.window, self.key_type

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from shard_spans(batches, window)

        own = self.shards(self.entries.where("entries > 1 or loop")).mapInArrow(released(match), f"k {kind}, fp long, a int, b int")
        own = staged(own, "spans", tidy=True)
        known = self.entries.where("last > first").select("anchor", "snip", "first")
        later = self.rows.join(known, ["anchor", "snip"]).where(F.struct("k", "fp", "at", "n") > F.col("first"))
        return own.unionByName(later.select("k", "fp", F.col("at").alias("a"), (F.col("at") + F.col("n") + window - 1).alias("b")))

    def groups(self) -> DataFrame:
        """(repeat, length, k, fp, start): maximal repeat groups, a row for each occurrence; repeat: a digest of the bytes.

        Maximal within the passages of an anchor: a repeat that is longer than a passage has a group for each part.
        """
        window = self.window

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, _ in _gathered(batches):
                bodies = table["body"].to_pylist()
                data, left, first = joined(bodies)
                found = ((length, places[x:y]) for places, _, groups in trees(data, left, first, window) for length, x, y in groups)
                raw = b"".join(bodies)
                for length, places in chain(found, ((len(x), [a]) for x, a in zip(bodies, first.tolist(), strict=True))):  # a whole passage, if its entry has several places
                    at = np.array(places)
                    body = np.searchsorted(first, at, "right") - 1
                    off = np.asarray(table["off"])[body] + at - first[body]
                    digest = hashlib.blake2b(raw[at[0] : at[0] + length], digest_size=16).digest()
                    rows = pa.array(body)
                    yield pa.RecordBatch.from_arrays([pa.array([digest] * len(at), pa.binary()), pa.array([length] * len(at), pa.int32()), table["anchor"].take(rows), table["snip"].take(rows), pa.array(off.astype(np.int32))], names=["repeat", "length", "anchor", "snip", "off"])

        found = self.shards(self.entries.where("entries > 1 or loop or last > first")).mapInArrow(released(match), "repeat binary, length int, anchor long, snip long, off int").distinct()
        every = found.join(self.rows, ["anchor", "snip"]).select("repeat", "length", "k", "fp", (F.col("at") + F.col("off")).alias("start")).distinct()
        every = staged(every, "groups", tidy=True)
        several = every.groupBy("repeat").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("repeat")
        return every.join(several, "repeat")


def _gathered(batches: Iterator[pa.RecordBatch], parted: bool = False) -> Iterator[tuple[dict[str, pa.Array], tuple[int, int] | None]]:
    """(columns of whole shards of about GATHERED bytes together, None); rows are sorted by anchor and shard, each comes once.

    parted: a shard of more bytes comes in several parts, each with its (anchor, shard).
    """
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    names = ("anchor", "shard", "snip", "off")

    def edge(t: pa.Table | pa.RecordBatch, row: int) -> np.ndarray:
        """The rows of other shards than that of `row`."""
        a, s = t["anchor"].to_numpy(), t["shard"].to_numpy()
        return np.flatnonzero((a != a[row]) | (s != s[row]))

    for b in batches:
        if last and b.num_rows:  # the shard of the last part goes on, perhaps with its last row once more
            a, s, snip, off = (b[c].to_numpy() for c in names)
            other = np.flatnonzero((a != last[0]) | (s != last[1]))
            stop = int(other[0]) if len(other) else len(a)
            again = (snip[:stop] == last[2]) & (off[:stop] == last[3])
            lo = stop if again.all() else int(np.argmin(again))
            if lo < stop:
                yield from _pieces(pa.Table.from_batches([b.slice(lo, stop - lo)]), parted, last[:2])
                last = tuple(int(x[stop - 1]) for x in (a, s, snip, off))
            b, last = b.slice(stop), None if stop < len(a) else last
        if not b.num_rows:
            continue
        held.append(b)
        size += b.nbytes
        if size >= GATHERED:
            whole = pa.Table.from_batches(held)
            other = edge(whole, -1)
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from _pieces(whole.slice(0, cut), parted)
                held = whole.slice(cut).to_batches()
                size = sum(x.nbytes for x in held)
            if parted and size >= GATHERED:
                whole = pa.Table.from_batches(held)
                last = tuple(whole[c][-1].as_py() for c in names)
                yield from _pieces(whole, parted, last[:2])
                held, size = [], 0
    if held and (whole := pa.Table.from_batches(held)).num_rows:
        yield from _pieces(whole, parted)


def _pieces(t: pa.Table, parted: bool, part: tuple[int, int] | None = None) -> Iterator[tuple[dict[str, pa.Array], tuple[int, int] | None]]:
    """Runs of whole shards of about GATHERED bytes, each body once; parted: larger shards in parts. part: t is of this one, and has only some of it."""
    columns = [t[c].to_numpy() for c in ("anchor", "shard", "snip", "off")]
    new = np.append(True, np.any([x[1:] != x[:-1] for x in columns], axis=0))
    t = t.filter(pa.array(new)).combine_chunks()
    a, s = t["anchor"].to_numpy(), t["shard"].to_numpy()
    heads = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])))
    done = np.append(0, np.cumsum(np.diff(np.asarray(t["body"].chunk(0).buffers()[1]).view(np.int32)[t["body"].chunk(0).offset :][: len(a) + 1])))
    lo = 0
    while lo < len(a):
        # the rows that fit, one at least
        fit = max(lo + 1, int(np.searchsorted(done, done[lo] + GATHERED, "right")) - 1)
        fits, after = heads[(heads > lo) & (heads <= fit)], heads[heads > lo]
        hi = int(fits[-1]) if len(fits) else int(after[0]) if len(after) else len(a)
        if fit == len(a):
            hi = fit
        of, stop = part, hi
        if parted and (part or hi > fit):  # one shard
            of, hi = of or (int(a[lo]), int(s[lo])), min(fit, hi)
        while lo < stop:
            cut = t.slice(lo, hi - lo)
            yield {c: cut[c].combine_chunks() for c in cut.column_names}, of
            lo, hi = hi, min(stop, max(hi + 1, int(np.searchsorted(done, done[hi] + GATHERED, "right")) - 1)) if hi < stop else stop


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for each row of docs.

    A byte goes if a string of `window` bytes over it also starts earlier: under a smaller key, or before it in the same
    text. n_spans: maximal runs of removed bytes; kept: what is left, as bytes. Null or empty text: no bytes, the hash of
    nothing. Texts under one key are ordered by a hash of the text; rows that share key and text lose the same bytes. A
    null key: nothing is removed, and nothing counts as earlier. An empty table gives no rows. Other columns aren't read.
    """
    found = Repeats(docs, window, key, text)
    spans = found.spans().groupBy("k", "fp").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    whole = found.source.join(spans, ["k", "fp"], "left").select("k", "t", "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for t, spans in zip(b.column(1), b.column(2), strict=True):
                raw = (t.as_py() or "").encode()
                removed = runs = 0
                kept = raw
                if spans.is_valid:
                    turn = np.zeros(len(raw) + 1, np.int32)
                    a, e = (x.to_numpy() for x in spans.values.flatten())
                    np.add.at(turn, a, 1)
                    np.add.at(turn, e, -1)
                    gone = np.cumsum(turn)[:-1] > 0
                    removed, runs = int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(cols if keep_bytes else cols[:4])], names=["k", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes)

    return whole.mapInArrow(released(apply), f"k {found.key_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes).withColumnRenamed("k", key)
