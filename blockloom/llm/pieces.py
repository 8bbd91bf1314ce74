"""N-best encoding with a piece vocabulary, and exact decoding (operator 3).

The vocabulary is read from a model file and never trained. With `scores="rank"` a piece's log probability follows Zipf's law
over its rank in the file, -ln(rank + 2), as files of merges (BPE) hold ranks and no probabilities; segmentations then
are the likeliest under that law, and not those of the merges. With `scores="file"` the file's own scores are taken, as
a unigram model has them. A character outside the vocabulary is spelled in byte pieces, each 2 below the least piece.

A text becomes one lattice: a space mark stands before it and for each space. As no piece but runs of marks
has a mark after its first character, the lattice falls apart at each mark that follows another character, and the best
path of a text is made of the best paths of these segments. Each distinct segment gets forward (Viterbi) scores of all its
positions. The N best paths come from a backward A* search over the segment's lattice, whose heuristic is the forward
score: it is exact, so paths leave the agenda in order. Segments are searched only where the text's N best need it: by
forward and backward scores, a text's N best differ from its best in its N - 1 cheapest segments at most.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, ship
from blockloom.llm.words import distinct, mix

MARK, N_BEST, CACHE, CHUNK_CHARS = "▁", 3, 200_000, 1 << 19
#: Segments of more characters are solved edge by edge, their edges found in stretches of so many positions.
LONG, STRETCH = 2048, 1 << 15
#: Stands for a mark character that the text itself has; outside Unicode, so no piece has it.
_OWN_MARK = 0x110000
_P = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    def __init__(self, path: str, scores_of: str = "rank"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [(i, model.id_to_piece(i), -model.get_score(i)) for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        for _, p, _ in normal:
            if MARK in p.lstrip(MARK):
                raise ValueError("a piece has a space mark inside")
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.vocab_size()) if model.is_byte(i)}
        scores = [-r if scores_of == "file" else -math.log(max(r, 0) + 2) for _, _, r in normal]
        self.byte_score = min(scores) - 2
        self.longest = max(len(p) for _, p, _ in normal)
        self.decoded: list[bytes] = [b""] * model.vocab_size()
        for b, i in self.bytes.items():
            self.decoded[i] = bytes([b])
        by_length: dict[int, list] = {}
        for (i, p, _), s in zip(normal, scores, strict=True):
            self.decoded[i] = p.replace(MARK, " ").encode()
            by_length.setdefault(len(p), []).append((int(_rolled(np.array([ord(c) for c in p], np.uint64))), i, s))
        self.tables = {}
        for n, rows in by_length.items():
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            sieve = np.zeros(1 << 16, bool)
            sieve[h >> np.uint64(48)] = True
            self.tables[n] = h, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), sieve

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.decoded.__getitem__, ids.tolist())).decode()
        return text[1:] if text else text


def _rolled(cp: np.ndarray) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for c in cp:
        h = h * _P + mix(np.array([c], np.uint64))
    return mix(h)[0]


class Segmenter:
    """Best paths of segments, each distinct one computed once, and N best where asked for."""

    def __init__(self, path: str, scores: str = "rank"):
        self.v = Vocabulary(path, scores)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.nbest: dict[int, list[tuple[float, list[int]]]] = {}
        #: By slot: score of the best path, its lead over the second best, and where its pieces are in flat.
        self.score, self.gap, self.first, self.count = np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def ids(self, slot: int) -> np.ndarray:
        return self.flat[self.first[slot] : self.first[slot] + self.count[slot]]

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of the slots one after another, how many before each slot and in all)."""
        n = self.count[slots]
        edges = np.append(0, np.cumsum(n))
        return self.flat[np.repeat(self.first[slots] - edges[:-1], n) + np.arange(edges[-1])], edges

    def _edges(self, cp: np.ndarray):
        """(scores, pieces) of shape (longest + 1, length, segments): the piece of each length at each start; cp, of shape (length, segments), padded with -1."""
        width, n = cp.shape
        hashed = mix(np.maximum(cp, 0).astype(np.uint64))
        top = min(self.v.longest, width)
        score, piece = np.full((top + 1, width, n), -np.inf), np.full((top + 1, width, n), -1)
        h = np.zeros((width, n), np.uint64)
        for m in range(1, top + 1):
            part = h[: width - m + 1]
            part *= _P
            part += hashed[m - 1 :]
            if m in self.v.tables:
                known, ids, scores, sieve = self.v.tables[m]
                at = np.flatnonzero(cp[m - 1 :] >= 0)  # same shape as part, so the same flat positions
                x = mix(part.ravel()[at])
                maybe = sieve[x >> np.uint64(48)]
                at, x = at[maybe], x[maybe]
                j = np.minimum(np.searchsorted(known, x), len(known) - 1)
                hit = known[j] == x
                score[m].reshape(-1)[at[hit]], piece[m].reshape(-1)[at[hit]] = scores[j[hit]], ids[j[hit]]
        real = np.where(cp == _OWN_MARK, 0x2581, cp)
        size = 1 + (real >= 0x80).astype(int) + (real >= 0x800) + (real >= 0x10000)
        spelled = (cp >= 0) & (piece[1] < 0)
        score[1][spelled] = (size * self.v.byte_score)[spelled]
        return score, piece

    def _grids(self, keys: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(positions in keys, code points of shape (length, segments), sizes): segments of similar length share a grid."""
        size = np.array([len(k) // 4 for k in keys], np.int64)
        flat = np.frombuffer(b"".join(keys), np.int32)
        first = np.cumsum(size) - size
        unit = np.maximum(4, 1 << np.maximum(np.log2(np.maximum(size, 1)).astype(np.int64) - 3, 0))
        width = unit * -(-size // unit)
        for w in np.unique(width).tolist():
            group, step = np.flatnonzero(width == w), max(1, 40_000 // w)
            for lo in range(0, len(group), step):
                g = group[lo : lo + step]
                at = np.arange(w)[:, None]
                yield g, np.where(at < size[g], flat[np.minimum(first[g] + at, len(flat) - 1)], -1).astype(np.int64), size[g]

    def learn(self, keys: list[bytes]) -> None:
        """Adds new segments, given as 32-bit code points."""
        base = len(self.keys)
        self.keys += keys
        none = np.zeros(len(keys))
        self.score, self.gap = np.append(self.score, none), np.append(self.gap, none)
        self.first, self.count = np.append(self.first, none.astype(np.int64)), np.append(self.count, none.astype(np.int64))
        found, end = [self.flat], len(self.flat)
        for x in [x for x, k in enumerate(keys) if len(k) > 4 * LONG]:
            self.score[base + x], self.gap[base + x], ids = self._solve_long(np.frombuffer(keys[x], np.int32).astype(np.int64))
            self.first[base + x], self.count[base + x] = end, len(ids)
            found.append(ids)
            end += len(ids)
        short = np.array([x for x, k in enumerate(keys) if len(k) <= 4 * LONG], np.int64)
        for g, cp, size in self._grids([keys[x] for x in short.tolist()]) if len(short) else ():
            best, gap, ids, count = self._solve(cp, size)
            g = short[g]
            self.score[base + g], self.gap[base + g], self.count[base + g] = best, gap, count
            self.first[base + g] = end + np.cumsum(count) - count
            found.append(ids)
            end += len(ids)
        self.flat = np.concatenate(found)

    def _solve(self, cp: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(best scores, leads over the second best, pieces one segment after another, pieces of each segment)."""
        width, n = cp.shape
        score, piece = self._edges(cp)
        top, live_edges = len(score) - 1, (score > -np.inf).any(2).tolist()
        forward, came = np.full((width + 1, n), -np.inf), np.zeros((width + 1, n), np.int64)
        forward[0] = 0
        for j in range(1, width + 1):
            for m in range(1, min(top, j) + 1):
                if live_edges[m][j - m]:
                    s = forward[j - m] + score[m, j - m]
                    better = s > forward[j]
                    np.copyto(forward[j], s, where=better)
                    came[j][better] = m
        back, each = np.full((width + 1, n), -np.inf), np.arange(n)
        back[size, each] = 0
        for j in range(width - 1, -1, -1):
            for m in range(1, min(top, width - j) + 1):
                if live_edges[m][j]:
                    np.maximum(back[j], back[j + m] + score[m, j], out=back[j])
        # the best path that uses an edge off the best path is the second best
        pos, best = size.copy(), forward[size, each]
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while (live := np.flatnonzero(pos > 0)).size:
            m = came[pos[live], live]
            start = pos[live] - m
            score[m, start, live] = -np.inf
            steps.append((live, start, piece[m, start, live]))
            pos[live] = start
        second = np.full(n, -np.inf)
        for m in range(1, top + 1):
            for j in range(width - m + 1):
                if live_edges[m][j]:
                    np.maximum(second, forward[j] + score[m, j] + back[j + m], out=second)
        row, start, ids = (np.concatenate([x[i] for x in steps]) for i in range(3))
        by = np.lexsort((start, row))
        row, start, ids = row[by], start[by], ids[by]
        spelled = np.flatnonzero(ids < 0)
        bytes_of = [self._spell(c) for c in cp[start[spelled], row[spelled]].tolist()]
        times = np.ones(len(ids), np.int64)
        times[spelled] = [len(x) for x in bytes_of]
        begin = np.cumsum(times) - times
        out = np.repeat(ids, times).astype(np.int32)
        for at, x in zip(begin[spelled].tolist(), bytes_of, strict=True):
            out[at : at + len(x)] = x
        return best, best - second, out, np.bincount(row, times, n).astype(np.int64)

    def _edge_list(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, lengths, scores, pieces) of one segment's edges, by end and length; stretch by stretch, so no grid of the whole segment is made."""
        parts, over = [], self.v.longest - 1
        for lo in range(0, len(cp), STRETCH):
            score, piece = self._edges(cp[lo : lo + STRETCH + over, None])
            m, s, _ = np.nonzero(score[:, :STRETCH] > -np.inf)
            parts.append((lo + s, m, score[m, s, 0], piece[m, s, 0]))
        s, m, x, p = (np.concatenate(c) for c in zip(*parts, strict=True))
        by = np.lexsort((m, s + m))
        return s[by], m[by], x[by], p[by]

    def _solve_long(self, cp: np.ndarray) -> tuple[float, float, np.ndarray]:
        """(best score, lead over the second best, pieces) of one segment, in time and memory linear in its edges."""
        start, m, x, piece = self._edge_list(cp)
        end = start + m
        forward, came = [0.0] + [-math.inf] * len(cp), [-1] * (len(cp) + 1)
        for i, (s, e, score) in enumerate(zip(start.tolist(), end.tolist(), x.tolist(), strict=True)):
            if forward[s] + score > forward[e]:
                forward[e], came[e] = forward[s] + score, i
        back, by = [-math.inf] * len(cp) + [0.0], np.argsort(-start, kind="stable")
        for s, e, score in zip(start[by].tolist(), end[by].tolist(), x[by].tolist(), strict=True):
            if back[e] + score > back[s]:
                back[s] = back[e] + score
        path, at = [], len(cp)
        while at:
            path.append(came[at])
            at = int(start[came[at]])
        rest = np.ones(len(start), bool)
        rest[path] = False
        others = (np.array(forward)[start] + x + np.array(back)[end])[rest]
        ids: list[int] = []
        for i in reversed(path):
            ids += [int(piece[i])] if piece[i] >= 0 else self._spell(int(cp[start[i]]))
        return forward[-1], forward[-1] - float(others.max(initial=-math.inf)), np.array(ids, np.int32)

    def _spell(self, c: int) -> list[int]:
        return [self.v.bytes[b] for b in chr(0x2581 if c == _OWN_MARK else c).encode()]

    def search(self, slots: list[int], n: int) -> None:
        """Searches segments that haven't been; their lattices are made together."""
        new = [x for x in dict.fromkeys(slots) if x not in self.nbest]
        for k in [x for x in new if len(self.keys[x]) > 4 * LONG]:
            cp = np.frombuffer(self.keys[k], np.int32).astype(np.int64)
            s, m, x, p = self._edge_list(cp)
            into: list[list[tuple[int, float, int]]] = [[] for _ in range(len(cp) + 1)]
            for a, e, score, i in zip(s.tolist(), (s + m).tolist(), x.tolist(), p.tolist(), strict=True):
                into[e].append((a, score, i))
            self.nbest[k] = self._led(k, self._a_star(cp, into, n))
        new = [x for x in new if x not in self.nbest]
        for g, cp, size in self._grids([self.keys[x] for x in new]) if new else ():
            score, piece = self._edges(cp)
            m, s, row = np.nonzero(score > -np.inf)
            by = np.argsort(row, kind="stable")
            m, s, row = m[by], s[by], row[by]
            x, p, cut = score[m, s, row].tolist(), piece[m, s, row].tolist(), np.searchsorted(row, np.arange(len(g) + 1)).tolist()
            end, s = (s + m).tolist(), s.tolist()
            for i, k in enumerate(g.tolist()):
                into: list[list[tuple[int, float, int]]] = [[] for _ in range(int(size[i]) + 1)]
                for e in range(cut[i], cut[i + 1]):
                    into[end[e]].append((s[e], x[e], p[e]))
                self.nbest[new[k]] = self._led(new[k], self._a_star(cp[: size[i], i], into, n))

    def _led(self, slot: int, found: list[tuple[float, list[int]]]) -> list[tuple[float, list[int]]]:
        """The n best with the segment's own best path in front, which may be any of several that are equally good."""
        own = self.ids(slot).tolist()
        return [(found[0][0], own), *[x for x in found if x[1] != own]][: len(found)]

    def _a_star(self, cp: np.ndarray, into: list[list[tuple[int, float, int]]], n: int) -> list[tuple[float, list[int]]]:
        """Up to n best (score, pieces) of a segment, best first: A* from the end, forward scores as its heuristic.

        A position is expanded n times at most: paths leave the agenda in order, and of those through a position no
        more than n are among the n best. Of equal ones the path that has come nearest to the start goes first.
        """
        width = len(cp)
        forward = [0.0] + [-math.inf] * width
        for j in range(1, width + 1):
            forward[j] = max((forward[s] + x for s, x, _ in into[j]), default=-math.inf)
        out, count, expanded = [], 0, [0] * (width + 1)
        agenda: list[tuple] = [(-forward[width], width, 0, 0.0, None)]
        while agenda and len(out) < n:
            cost, at, _, done, path = heapq.heappop(agenda)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    (s, p), path = path
                    ids += [p] if p >= 0 else self._spell(int(cp[s]))
                out.append((-cost, ids))
                continue
            if expanded[at] == n:
                continue
            expanded[at] += 1
            for s, x, p in into[at]:
                if forward[s] > -math.inf and expanded[s] < n:
                    count += 1
                    heapq.heappush(agenda, (-(forward[s] + x + done), s, count, x + done, ((s, p), path)))
        return out

    def encode(self, texts: list[str], n: int = N_BEST) -> Iterator[tuple[np.ndarray, list[tuple[float, list[tuple[int, list[int]]]]], np.ndarray]]:
        """For each text: the best ids; up to n best as (score, replaced segments); the segments' slots."""
        if len(self.known) > CACHE:
            self.clear()
        cps = []
        for t in texts:
            cp = np.frombuffer((" " + t if t else "").encode("utf-32-le"), np.uint32).astype(np.int64)
            cp[cp == 0x2581] = _OWN_MARK
            cp[cp == 0x20] = 0x2581
            cps.append(cp)
        sizes = np.array([len(c) for c in cps])
        flat = np.concatenate(cps) if cps else np.zeros(0, np.int64)
        if not len(flat):
            for _ in texts:
                yield np.zeros(0, np.int32), [(0.0, [])], np.zeros(0, np.int64)
            return
        cut = np.zeros(len(flat), bool)
        cut[1:] = (flat[1:] == 0x2581) & (flat[:-1] != 0x2581)
        edges = np.append(0, np.cumsum(sizes))
        cut[edges[:-1][sizes > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(flat))
        narrow = flat.astype(np.int32)
        where, backs = distinct(narrow.view(np.uint8), 4 * starts, 4 * ends)
        raw = narrow.tobytes()
        keys = [raw[4 * a : 4 * b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        new = list(dict.fromkeys(k for k in keys if k not in self.known))
        for k in new:
            self.known[k] = len(self.known)
        self.learn(new)
        slots = np.fromiter((self.known[k] for k in keys), np.int64, len(keys))[backs]
        gaps, scores = self.gap[slots], self.score[slots]
        ids, before = self.gather(slots)
        at = np.searchsorted(starts, edges)
        near = [_nearest(gaps[a:b], n) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        self.search([x for a, j in zip(at[:-1], near, strict=True) for x in slots[a + j].tolist()], n)
        for i in range(len(texts)):
            own = slots[at[i] : at[i + 1]]
            total = float(scores[at[i] : at[i + 1]].sum())
            yield ids[before[at[i]] : before[at[i + 1]]], self._text_n_best(own, near[i], total, n), own

    def _text_n_best(self, own: np.ndarray, near: np.ndarray, total: float, n: int) -> list[tuple[float, list[tuple[int, list[int]]]]]:
        best: list[tuple[float, list[tuple[int, list[int]]]]] = [(0.0, [])]
        for j in near.tolist():
            options = self.nbest[int(own[j])]
            top = options[0][0]
            merged = [(d + (s - top), r if o == 0 else [*r, (j, ids)]) for d, r in best for o, (s, ids) in enumerate(options)]
            best = heapq.nlargest(n, merged, key=lambda x: (x[0], -len(x[1]), [-j for j, _ in x[1]]))
        return [(total + d, r) for d, r in best]


def _nearest(gap: np.ndarray, n: int) -> np.ndarray:
    """Segments that a text's n best can change."""
    k = min(n - 1, len(gap))
    if k < 1:
        return np.zeros(0, np.int64)
    return np.lexsort((np.arange(len(gap)), gap))[:k] if len(gap) <= 4 * n else _smallest(gap, k)


def _smallest(gap: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k least values, the leftmost of equals first."""
    bound = np.partition(gap, k - 1)[k - 1]
    below = np.flatnonzero(gap < bound)
    level = np.flatnonzero(gap == bound)[: k - len(below)]
    near = np.concatenate((below, level))
    return near[np.lexsort((near, gap[near]))]


@lru_cache(maxsize=1)
def segmenter(path: str, scores: str = "rank") -> Segmenter:
    return Segmenter(path, scores)


def encode(docs: DataFrame, model: str, n: int = N_BEST, key: str = "doc_id", text: str = "text", with_ids: bool = False, scores: str = "rank") -> DataFrame:
    """(key, n_pieces, best_score, nbest_scores, n_segments, ids_crc32, decoded_ok[, ids, nbest]) for each row of docs.

    nbest_scores: log probabilities of the up to n best segmentations, best first; with equal scores, fewer changes from
    the best and earlier ones come first. decoded_ok: decoding the ids gives the text back. Null or empty text: no
    pieces, one segmentation of score 0. `nbest`: for each, the ids in full. Rows may repeat and keys be null; an empty
    table gives no rows. Other columns aren't read. scores: `rank` or `file`, as above.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = dict(source.dtypes)["k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = segmenter(model, scores)
        for b in batches:
            texts, lo = [x or "" for x in b.column(1).to_pylist()], 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK_CHARS):
                    size += len(texts[hi])
                    hi += 1
                rows: list[tuple] = []
                for t, (ids, best, own) in zip(texts[lo:hi], coder.encode(texts[lo:hi], n), strict=True):
                    full = None
                    if with_ids:
                        full = []
                        for _, changed in best:
                            path = {j: x for j, x in changed}
                            full.append([int(p) for j, s in enumerate(own.tolist()) for p in path.get(j, coder.ids(s))])
                    rows.append((len(ids), best[0][0], [s for s, _ in best], len(own), zlib.crc32(ids.astype("<u4").tobytes()), coder.v.decode(ids) == t, *((ids.tolist(), full) if with_ids else ())))
                cols = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *cols], names=names)
                lo = hi

    kinds = [pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))]
    names = ["k", "n_pieces", "best_score", "nbest_scores", "n_segments", "ids_crc32", "decoded_ok"] + ["ids", "nbest"] * with_ids
    schema = f"k {kind}, n_pieces long, best_score double, nbest_scores array<double>, n_segments long, ids_crc32 long, decoded_ok boolean" + ", ids array<int>, nbest array<array<int>>" * with_ids
    return source.mapInArrow(released(run), schema).withColumnRenamed("k", key)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) from ids; null ids give null."""
    ship(encoded.sparkSession)
    source = encoded.select(F.col(key).alias("k"), F.col(ids).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = segmenter(model).v
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else v.decode(np.array(x, np.int64)) for x in b.column(1).to_pylist()], pa.string())], names=["k", "text"])

    return source.mapInArrow(released(run), f"k {dict(source.dtypes)['k']}, text string").withColumnRenamed("k", key)
