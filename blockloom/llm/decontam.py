"""Benchmark passages in documents, found by winnowing (operator 6).

Texts and items are reduced to fingerprints: the least hash of the 8-word grams of each window of 13 words (6 grams; the
leftmost of equals). Equal windows have the same one, so every span of 13 or more shared words has a common fingerprint.
Document fingerprints are joined with those of all items, each once; a hit is extended to the document's windows that have
that fingerprint, and their words are joined with the items' windows, each once with the items that have it. So no pair of
places in a document and an item is made, however often words repeat, and equal windows are equal byte by byte. Items of
fewer than 13 words are one window each, with the whole item as its gram.

A sieve of fixed size (a bit for each leading 22 bits of the items' fingerprints) keeps most document fingerprints out of
the join; with more items it lets more of them through, and the join stays exact. Windows of the same items are one class;
a document is joined with its classes' items only after its windows were found, which grows as the item lists that it returns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, staged
from blockloom.llm.words import ALNUM, Words, argmin_slide, chunks, grams, mix

WINDOW, GRAM, SIEVE_BITS = 13, 8, 22


def winnow(words: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the fingerprints of the windows that lie in one text."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(words.hash, gram)
    p = argmin_slide(g, window - gram + 1)[:n]
    p = p[words.doc[:n] == words.doc[window - 1 :]]
    p = p[np.append(True, p[1:] != p[:-1])] if len(p) else p
    return p, g[p]


def _short(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of all runs of n words that lie in one text, apart from those of other lengths."""
    g = grams(words.hash, n)
    at = np.flatnonzero(words.doc[: len(g)] == words.doc[n - 1 :]) if len(g) else np.zeros(0, np.int64)
    return at, mix(g[at] + np.uint64(n))


def _parts(words: Words, at: np.ndarray, size: int, offsets: np.ndarray, body: bytes) -> dict[bytes, list[int]]:
    """Different windows of `size` words that start at the words `at` (ascending), each with the words that its occurrences cover, as [start, end, ...]."""
    out: dict[bytes, list[int]] = {}
    for i, x, y in zip(at.tolist(), offsets[at].tolist(), offsets[at + size].tolist(), strict=True):
        covered = out.setdefault(body[x : y - 1], [])
        if covered and covered[-1] >= i:
            covered[-1] = i + size
        else:
            covered += [i, i + size]
    return out


def _body(words: Words) -> tuple[bytes, np.ndarray]:
    """(the words, each with a space after it; where each starts, and the end)."""
    body = b"".join(words.text(i) + b" " for i in range(len(words)))
    return body, np.append(0, np.cumsum(words.ends - words.starts + 1))


def _items(bench: DataFrame, window: int, gram: int, item: str, item_text: str) -> DataFrame:
    """(i, n, prints, parts) of items with words: id, words of a window, different fingerprints and windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row, t in enumerate(b.column(1).to_pylist()):
                raw = t.encode()
                w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM, fold=True)
                if not len(w):
                    continue
                n = min(len(w), window)
                prints = winnow(w, gram, window)[1] if n == window else _short(w, n)[1]
                body, offsets = _body(w)
                out.append((row, n, np.unique(prints.view(np.int64)).tolist(), list(_parts(w, np.arange(len(w) - n + 1), n, offsets, body))))
            if out:
                row, n, prints, parts = zip(*out, strict=True)
                cols = [b.column(0).take(pa.array(row)), pa.array(n, pa.int32()), pa.array(prints, pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, names=["i", "n", "prints", "parts"])

    named = bench.where(F.col(item_text).isNotNull()).select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t"))
    return staged(named.mapInArrow(released(run), "i string, n int, prints array<long>, parts array<binary>"), "items")


def _fingerprints(source: DataFrame, sieve: np.ndarray, sizes: list[int], window: int, gram: int, at: int) -> DataFrame:
    """source with n_words and the different fingerprints that the sieve lets through; text is column `at`."""
    sent = source.sparkSession.sparkContext.broadcast(sieve)  # 2^SIEVE_BITS bits
    names, shift = source.columns, np.uint64(64 - SIEVE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(sent.value.view(np.uint8), bitorder="little").view(bool)
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(at)):
                w = Words(data, offsets, ALNUM, fold=True)
                found = [winnow(w, gram, window), *(_short(w, n) for n in sizes)]
                pos, fp = (np.concatenate([x[i] for x in found]) for i in (0, 1))
                keep = known[fp >> shift]
                fp, doc = fp[keep], w.doc[pos[keep]]
                by = np.lexsort((fp, doc))
                fp, doc = fp[by], doc[by]
                new = np.flatnonzero(np.append(True, (fp[1:] != fp[:-1]) | (doc[1:] != doc[:-1]))) if len(fp) else np.zeros(0, np.int64)
                edge = np.searchsorted(doc[new], np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, pa.array(w.count), pa.ListArray.from_arrays(pa.array(edge), pa.array(fp[new].view(np.int64)))], names=[*names, "n_words", "prints"])

    schema = ", ".join(f"{c} {k}" for c, k in source.dtypes)
    return source.mapInArrow(released(run), f"{schema}, n_words long, prints array<long>")


def _covered(spans: list[tuple[int, int]]) -> int:
    total, end = 0, -1
    for a, b in sorted(spans):
        total, end = total + max(0, b - max(a, end)), max(end, b)
    return total


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated, and the columns `keep`) for each row of docs.

    Words are ASCII-lower-cased runs of letters, digits and non-ASCII. contaminated: n_hit > 0 and 20 * n_hit >= n_words.
    Null or empty text has no words; items without words have no window; rows that repeat are each judged; items that
    repeat an id count once. Items with a null id hit words like others; together they count as one item, and the hash
    leaves them out. With no items nothing is hit. Columns but key, text and `keep` aren't read; a column of `keep` that
    has the name of a result is refused.
    """
    keep, gram = keep or [], min(GRAM, window)
    if clash := {"n_words", "n_hit", "n_items", "items_sha256", "contaminated"} & {key, *keep}:
        raise ValueError(f"columns {sorted(clash)} have names of results")
    items = _items(bench, window, gram, item, item_text)
    fps = items.select(F.explode("prints").alias("fp")).distinct()
    # windows with the ids of the items that have them; those of the same items are one class
    parts_of = items.select("i", F.explode("parts").alias("part")).groupBy("part").agg(F.sort_array(F.collect_set("i")).alias("ids"), F.max(F.col("i").isNull().cast("int")).alias("nameless"))
    parts_of = staged(parts_of.withColumn("class", F.sha2(F.to_json(F.struct("ids", "nameless")), 256)), "item-windows")
    classes = parts_of.groupBy("class").agg(F.first("ids").alias("ids"), F.first("nameless").alias("nameless"))
    place = F.shiftrightunsigned("fp", 64 - SIEVE_BITS)
    # at most 2^SIEVE_BITS / 64 rows
    sieve = np.zeros((1 << SIEVE_BITS) // 64, np.int64)
    for r in fps.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(fp, %d) & 63 as int))" % (64 - SIEVE_BITS))).alias("bits")).collect():
        sieve[r.w] = r.bits
    sizes = sorted(r.n for r in items.where(F.col("n") < window).select("n").distinct().collect())  # below the window

    # the text is a column of its own unless it is kept anyway
    names = [f"c{i}" for i in range(len(keep))]
    source = docs.select(F.col(key).alias("k"), *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], *([] if text in keep else [F.col(text).alias("t")]), F.monotonically_increasing_id().alias("row"))
    t = names[keep.index(text)] if text in keep else "t"
    marked = _fingerprints(source, sieve, sizes, window, gram, source.columns.index(t))
    met = F.size("prints") > 0
    rows = staged(marked if text in keep else marked.withColumn("t", F.when(met, F.col("t"))), "fingerprints")

    hits = rows.where(met).select("row", F.explode("prints").alias("fp")).join(fps, "fp")
    wanted = hits.groupBy("row").agg(F.collect_list("fp").alias("fps"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, body, fps in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                raw, met = body.as_py().encode(), fps.values.to_numpy().view(np.uint64)
                w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM, fold=True)
                whole, offsets = _body(w)
                at = {n: pos[np.isin(h, met)] for n in sizes for pos, h in (_short(w, n),)}
                if len(w) >= window:
                    g = grams(w.hash, gram)
                    at[window] = np.flatnonzero(np.isin(g[argmin_slide(g, window - gram + 1)], met))
                out = [(row, part, spans) for n, x in at.items() for part, spans in _parts(w, x, n, offsets, whole).items()]
                for i in range(0, len(out), 1000):
                    cols = zip(zip(*out[i : i + 1000], strict=True), (pa.int64(), pa.binary(), pa.list_(pa.int32())), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in cols], names=["row", "part", "spans"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = [_covered([(s[i], s[i + 1]) for s in x for i in range(0, len(s), 2)]) for x in b.column("spans").to_pylist()]
            yield b.drop_columns(["spans"]).append_column("n_hit", pa.array(hit, pa.int64()))

    parts = rows.where(met).select("row", F.col(t).alias("t")).join(wanted, "row").select("row", "t", "fps").mapInArrow(released(extend), "row long, part binary, spans array<int>")
    held = staged(parts.join(parts_of.select("part", "class"), "part").select("row", "class", "spans"), "hits")
    hit = held.groupBy("row").agg(F.collect_list("spans").alias("spans")).mapInArrow(released(count), "row long, n_hit long")
    of = held.select("row", "class").distinct().join(classes, "class").groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"), F.max("nameless").alias("nameless"))
    found = hit.join(of, "row").select("row", "n_hit", "ids", (F.size("ids") + F.col("nameless")).cast("long").alias("n_items"))

    # only documents that met a fingerprint are joined with what was found
    none = F.array().cast("array<string>")
    judged = rows.where(met).join(found, "row", "left").select("k", *names, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("ids", none).alias("ids"))
    whole = judged.unionByName(rows.where(~met).select("k", *names, "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), none.alias("ids")))
    sha = F.sha2(F.array_join("ids", ",").cast("binary"), 256)
    return whole.select(F.col("k").alias(key), *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_words", "n_hit", "n_items", sha.alias("items_sha256"), ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
