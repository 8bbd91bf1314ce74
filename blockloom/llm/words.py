"""Words of many texts at once: numpy over the UTF-8 buffer of an Arrow string column.

A chunk holds whole texts, never parts of one. Words get 64-bit hashes of their bytes; hashes route and count, and two
different words of a corpus with ten million words share one with a probability below 3e-6. Each step of the hash is
non-linear, so strings don't collide by their structure. Where a text is looked up by a hash, `distinct` compares bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 1 << 18
_P, _U64 = 0x9E3779B97F4A7C15, (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def run_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each values[start:end], the same wherever the values stand; for runs of some words, not of thousands."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
LONG, SEED = 512, 0x5BD1E995


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], eight bytes a step; of the first LONG bytes, then of all bytes by xxh3."""
    size = ends - starts
    h = mix(size.astype(np.uint64) + np.uint64(SEED))
    eight = np.ndarray((len(data) + 1,), "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    at, done = np.flatnonzero(size > 0), 0
    while len(at) and done < LONG:
        left = size[at] - done
        h[at] = mix((h[at] ^ (eight[starts[at] + done] & _LOW[np.minimum(left, 8)])) * np.uint64(_P))
        at, done = at[left > 8], done + 8
    for i in at.tolist():
        h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), SEED))
    return h


def equal_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether each span has the bytes of span number other[i]."""
    todo = np.flatnonzero(other != np.arange(len(starts)))
    a, b, size = starts[todo], starts[other[todo]], (ends - starts)[todo]
    if not np.array_equal(size, (ends - starts)[other[todo]]):
        return False
    at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return np.array_equal(data[at], data[at + np.repeat(b - a, size)])


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a span of each distinct string, the number of its string for each span); equal hashes are compared byte by byte."""
    _, where, back = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
    if equal_spans(data, starts, ends, where[back]):
        return where, back
    raw, seen = data.tobytes(), {}
    back = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))
    return np.unique(back, return_index=True)[1], back


def mask_table(inside) -> np.ndarray:
    table = np.zeros(256, bool)
    for b in range(256):
        table[b] = inside(b)
    return table


#: `[^\x20\x09-\x0D]+`
PLAIN = mask_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALNUM = mask_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about `size` bytes; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    buffer = column.buffers()[2] if n else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of a chunk: byte starts and ends, hashes, each text's first word and number of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = PLAIN, fold: bool = False, hashes: bool = True):
        self.data = data = _FOLD[data] if fold else data
        self.offsets = offsets
        n = len(data)
        word = inside[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n + 1, bool)
        before[1:] = word
        here = np.zeros(n + 1, bool)
        here[:n] = word
        self.starts = np.flatnonzero(here & (~before | edge))
        self.ends = np.flatnonzero(before & (~here | edge))
        self.first = np.searchsorted(self.starts, offsets[:-1])
        self.count = np.searchsorted(self.starts, offsets[1:]) - self.first
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = span_hash(data, self.starts, self.ends) if hashes else None

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k hashes; of length max(0, len(h) - k + 1). Runs may cross texts: mask them."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_P) + h[j : j + n]
    return mix(out)


def argmin_slide(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the least (leftmost of equals) of each run of w values; by doubling, so in about log2(w) passes."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    v, p, step = h, np.arange(len(h)), 1
    while step * 2 <= w:
        right = v[step:] < v[: len(v) - step]
        p = np.where(right, p[step:], p[: len(p) - step])
        v = np.minimum(v[step:], v[: len(v) - step])
        step *= 2
    if step < w:
        d = w - step
        right = v[d : d + n] < v[:n]
        return np.where(right, p[d : d + n], p[:n])
    return p[:n]
