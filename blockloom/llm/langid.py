"""Language identification by prediction by partial matching (operator 5).

Each language has a context tree over bytes: contexts of 3, 2, 1 and 0 bytes, with the counts of the byte that followed.
A byte seen in the longest context costs -log2 n/(T+D) bits (n its count, T the context's total, D its distinct
bytes: escape method C); else the escape D/(T+D) is paid and the next shorter context is asked; below order 0 a byte
costs 8 bits. A context that was never seen is skipped free of charge. Statistics are frozen before scoring, so a text's
code length is an exact sum and doesn't depend on other texts.

Counts cover all training documents, and every counted context is used. What is in memory at once is bounded all the same:
contexts of orders 3 and 2 fall in slices by the two bytes before, so that a slice has all that a byte after these two
asks for; contexts of orders 1 and 0 (65,792 entries a language at most) are in each. Texts are scored against one slice
after another, and their code lengths added up. A slice has at most `slice_entries` entries of order 3 or those of a
single pair of bytes (65,536 a language at most).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, ship, staged
from blockloom.llm.words import _FOLD, chunks

ORDER, SLICE = 3, 1_000_000
#: Entries that a counting task holds at once.
HELD = 1_000_000


def _keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The last 4 bytes up to each byte, as one number; before a text stand spaces."""
    n = len(data)
    start = np.repeat(offsets[:-1], np.diff(offsets))
    at = np.arange(n) - start
    key = data.astype(np.uint32)
    for back in range(1, ORDER + 1):
        b = np.full(n, 0x20, np.uint32)
        b[back:] = data[: n - back] if n > back else b[back:]
        b[at < back] = 0x20
        key |= b << np.uint32(8 * back)
    return key


class Trees:
    """Frozen statistics: for each order and language the sorted entries, and the totals of their contexts."""

    def __init__(self, langs: list[str], entries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.langs, self.levels = langs, []
        for i in range(len(langs)):
            levels = []
            for order in range(ORDER, -1, -1):
                lang, key, n = entries[order]
                mine = lang == i
                k, c = key[mine].astype(np.uint32), n[mine].astype(np.float64)
                by = np.argsort(k)
                k, c = k[by], c[by]
                context, at = np.unique(k >> np.uint32(8), return_index=True)
                total = np.add.reduceat(c, at) if len(k) else np.zeros(0)
                levels.append((k, c, context, total, np.diff(np.append(at, len(k))).astype(np.float64)))
            self.levels.append(levels)

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """(keys, languages) code lengths of the last byte of each key after its first bytes."""
        out = np.zeros((len(keys), len(self.langs)))
        for i, levels in enumerate(self.levels):
            todo = np.arange(len(keys))
            for order, (k, c, context, total, distinct) in zip(range(ORDER, -1, -1), levels, strict=True):
                if not len(todo) or not len(k):
                    continue
                mine = keys[todo] & np.uint32(0xFFFFFFFF >> (8 * (ORDER - order)))
                j = np.minimum(np.searchsorted(context, mine >> np.uint32(8)), len(context) - 1)
                there = context[j] == mine >> np.uint32(8)
                e = np.minimum(np.searchsorted(k, mine), len(k) - 1)
                seen = there & (k[e] == mine)
                span = total[j] + distinct[j]
                out[todo[seen], i] += np.log2(span[seen] / c[e[seen]])
                escape = there & ~seen
                out[todo[escape], i] += np.log2(span[escape] / distinct[j[escape]])
                todo = todo[~seen]
            out[todo, i] += 8
        return out


def _pair() -> Column:
    """The two bytes before the last of a key."""
    return F.shiftright(F.col("k"), 8).bitwiseAND(0xFFFF)


class Model:
    """All counts (lang, k, n) of order 3 as a table, those of orders 1 and 0 at hand, and the slices by pairs of bytes."""

    def __init__(self, langs: list[str], counts: DataFrame | None = None, low: dict | None = None, slices: list[tuple[int, int]] | None = None):
        self.langs, self.counts, self.low, self.slices = langs, counts, low or {}, slices or []

    def trees(self, i: int) -> Trees:
        """The trees of slice i; orders 3 and 2 have what stands after its pairs of bytes."""
        lo, hi = self.slices[i]
        got = self.counts.where(_pair().between(lo, hi)).toPandas()
        lang, k, n = (got[c].to_numpy(np.int64) for c in ("lang", "k", "n"))
        both, at = np.unique(lang << 24 | k & 0xFFFFFF, return_inverse=True)
        two = np.zeros(len(both), np.int64)
        np.add.at(two, at, n)
        return Trees(self.langs, {3: (lang, k, n), 2: (both >> 24, both & 0xFFFFFF, two), **self.low})


def train(docs: DataFrame, text: str = "text", lang: str = "lang", slice_entries: int = SLICE) -> Model:
    """Count all texts of docs that have a language."""
    spark = docs.sparkSession
    # one row a language; the number of languages is the number of labels
    langs = sorted(r[0] for r in docs.where(F.col(lang).isNotNull()).select(lang).distinct().collect())
    index = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged(held):
            k = np.concatenate([x for x, _ in held])
            n = np.concatenate([x for _, x in held])
            by = np.argsort(k)
            k, n = k[by], n[by]
            at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            return k[at], np.add.reduceat(n, at)

        def given(k, n):
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000].astype(np.int64))], names=["key", "n"])

        for b in batches:
            ids = np.array([index[x] for x in b.column(1).to_pylist()], np.uint64)
            for lo, hi, data, offsets in chunks(b.column(0)):
                if not len(data):
                    continue
                key = _keys(_FOLD[data], offsets).astype(np.uint64) | np.repeat(ids[lo:hi], np.diff(offsets)) << np.uint64(32)
                key.sort()
                at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                held.append((key[at], np.diff(np.append(at, len(key)))))
                size += len(at)
                if size > HELD:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:  # summed up by Spark
                        yield from given(*held.pop())
                        size = 0
        if held:
            yield from given(*merged(held))

    if not langs:
        return Model([])
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    counted = known.mapInArrow(released(count), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = staged(counted.select(F.shiftright("key", 32).alias("lang"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("k"), "n"), "contexts")
    low = {}
    for order in (1, 0):
        got = counts.groupBy("lang", F.col("k").bitwiseAND((1 << 8 * (order + 1)) - 1).alias("k")).agg(F.sum("n").alias("n")).toPandas()
        low[order] = (got["lang"].to_numpy(), got["k"].to_numpy(), got["n"].to_numpy())
    slices, held = [], 0
    for pair, n in sorted(counts.groupBy(_pair().alias("pair")).agg(F.count(F.lit(1)).alias("n")).collect()):  # at most 65,536
        if slices and held + n <= slice_entries:
            slices[-1], held = (slices[-1][0], pair), held + n
        else:
            slices, held = [*slices, (pair, pair)], n
    # the slices meet, so that each pair is in one, seen or not
    ends = [*(lo - 1 for lo, _ in slices[1:]), 0xFFFF]
    return Model(langs, counts, low, [(lo if i else 0, hi) for i, ((lo, _), hi) in enumerate(zip(slices, ends, strict=bool(slices)))])


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of docs and lang_pred, score for every row.

    lang_pred: the language with the least code length of the whole text, the first in name of equals; `und` if the text
    is null or has no letter, or no language was learned. score: that language's probability if all are equally likely
    beforehand, 0 for `und`. One slice of the model at a time is sent to all executors. Rows that repeat are each judged;
    an empty table gives none. A column of `keep` that has the name of a result is refused.
    """
    if clash := {"lang_pred", "score"} & set(keep):
        raise ValueError(f"columns {sorted(clash)} have names of results")
    ship(docs.sparkSession)
    langs, names = model.langs, [f"c{i}" for i in range(len(keep))]
    # the text goes to the workers once, also where it is kept
    body = [] if text in keep else ["t"]
    place = keep.index(text) if text in keep else len(keep)
    kept = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], *[F.col(text).alias(c) for c in body], F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    types = dict(kept.dtypes)
    schema = "".join(f"{c} {types[c]}, " for c in names)

    def scored(frame: DataFrame, i: int, last: bool) -> DataFrame:
        sent, (lo_pair, hi_pair) = (docs.sparkSession.sparkContext.broadcast(model.trees(i)), model.slices[i]) if model.slices else (None, (0, 0))
        alone = len(model.slices) < 2

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = sent.value if sent else None
            for b in batches:
                letters = b.column("letters").to_numpy(zero_copy_only=False)
                sums = np.zeros((b.num_rows, len(langs)))
                if "sums" in b.schema.names:
                    sums += np.array(b.column("sums").to_pylist(), np.float64).reshape(sums.shape)
                for lo, hi, data, offsets in chunks(b.column(place)):
                    if len(data) and trees:
                        distinct, back = np.unique(_keys(_FOLD[data], offsets), return_inverse=True)
                        if alone:
                            bits = trees.bits(distinct)
                        else:  # the other slices' keys add nothing here
                            pair = distinct >> np.uint32(8) & np.uint32(0xFFFF)
                            mine = (pair >= lo_pair) & (pair <= hi_pair)
                            bits = np.zeros((len(distinct), len(langs)))
                            bits[mine] = trees.bits(distinct[mine])
                        full = np.flatnonzero(np.diff(offsets))
                        for j in range(len(langs)):
                            sums[lo + full, j] += np.add.reduceat(bits[back, j], offsets[full])
                if not last:
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(langs)), pa.array(sums.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*b.columns[: len(names) + len(body) + 1], flat], names=[*names, *body, "letters", "sums"])
                    continue
                lang, score = [], []
                for row, has in zip(sums, letters, strict=True):
                    best = int(np.argmin(row)) if has and langs else -1
                    lang.append("und" if best < 0 else langs[best])
                    score.append(0.0 if best < 0 else float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum()))
                yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

        return frame.mapInArrow(released(run), schema + ("lang_pred string, score double" if last else "t string, " * len(body) + "letters boolean, sums array<double>"))

    frame, several = kept, max(1, len(model.slices))
    for i in range(several):
        frame = scored(frame, i, i + 1 == several)
        if i + 1 < several:  # one slice at a time in an executor's memory
            frame = staged(frame, "code-lengths")
    return frame.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")
