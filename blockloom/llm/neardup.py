"""Near-duplicates by min-max hashing (operator 9).

Each of 48 multiply-shift permutations of a document's shingle hashes gives both its minimum and its maximum, so 96
signature values cost 48 hash evaluations a shingle. 24 bands of 4 values, each of another permutation: a pair of
similarity 0.8 shares no band with a probability of (1 - 0.8^4)^24 = 3e-6. Candidates are confirmed on full sets.

Pairs are never emitted within a whole bucket. Equal sets are one node. In each bucket all nodes are first held against
one pivot, the node with the largest share of shingles that others have; after these links are merged, only nodes
outside the pivot's component are held against bucket members of other components. No candidate pair that could join two
components is left out. Pairs whose shared shingles can't reach the threshold (by how many of a set's shingles occur in
any other candidate's) are dropped beforehand; that bound is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, staged
from blockloom.llm.components import components
from blockloom.llm.words import Words, chunks, grams, mix, run_hash

BANDS, ROWS = 24, 4
#: Multipliers and addends of the permutations, from the 64-bit finalizer.
_A = mix(np.arange(1, BANDS * ROWS // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_B = mix(np.arange(1001, BANDS * ROWS // 2 + 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first hash of each text and the end): distinct k-word shingles of each text, sorted within it."""
    g = grams(words.hash, k)
    at = np.arange(len(g))
    inside = words.doc[at] == words.doc[at + k - 1] if len(g) else np.zeros(0, bool)
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    h = np.concatenate((g[inside], run_hash(words.hash, words.first[short], words.first[short] + words.count[short])))
    doc = np.concatenate((words.doc[at[inside]], short))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(len(words.count) + 1))


def signatures(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(texts, BANDS) band hashes; rows of empty texts are meaningless."""
    full = np.flatnonzero(edges[1:] > edges[:-1])
    out = np.zeros((len(edges) - 1, BANDS), np.uint64)
    if not len(full):
        return out
    starts, sig = edges[full], np.empty((BANDS * ROWS, len(full)), np.uint64)
    for i in range(len(_A)):
        x = (h ^ _B[i]) * _A[i]
        x ^= x >> np.uint64(32)
        sig[2 * i], sig[2 * i + 1] = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
    for band in range(BANDS):
        v = np.full(len(full), band, np.uint64)
        # minima of two permutations and maxima of the two after them: one permutation's minimum and maximum depend on each other in small sets
        for r in (4 * band, 4 * band + 2, (4 * band + 5) % len(sig), (4 * band + 7) % len(sig)):
            v = mix(v * np.uint64(0x9E3779B97F4A7C15) + sig[r])
        out[full, band] = v
    return out


def _sets(source: DataFrame, k: int) -> DataFrame:
    """(k, shingles): full shingle sets of the texts t of source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1)):
                h, edges = shingles(Words(data, offsets, fold=True), k)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(h.view(np.int64)))], names=["k", "s"])

    return source.mapInArrow(released(run), "k long, s array<long>")


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes na, nb of their sets and the number i of shared shingles."""
    both = pairs.join(sets.select(F.col("k").alias("b"), F.col("s").alias("sb")), "b").join(sets.select(F.col("k").alias("a"), F.col("s").alias("sa")), "a")
    return both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("i"))


def _linked(shared: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * |A and B| >= percent * |A or B|."""
    return shared.where(100 * F.col("i") >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of docs.

    A document's set: distinct k-word shingles of the ASCII-lower-cased text; with fewer words, the whole sequence as
    one. Documents whose sets meet the percentage are linked; component_id is the least key reachable. Null or empty
    text, or no words: empty set, linked with nothing, its own component. Rows that share a key are one document. A null
    key: linked with nothing, null component, kept. Two texts under one key: both rows stay, each linked by its own text, with
    the key as the vertex. An empty table gives no rows. Keys are whole numbers (others are cast to long). Other columns
    aren't read.
    """
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1)):
                h, edges = shingles(Words(data, offsets, fold=True), k)
                bands = signatures(h, edges)
                n, digest, raw = edges[1:] - edges[:-1], [], h.tobytes()
                for x, y in zip((8 * edges[:-1]).tolist(), (8 * edges[1:]).tolist(), strict=True):
                    digest.append(hashlib.blake2b(raw[x:y], digest_size=16).digest())
                cols = [b.column(0).slice(lo, hi - lo), pa.array(n), pa.array(digest, pa.binary()), pa.FixedSizeListArray.from_arrays(pa.array(bands.reshape(-1).view(np.int64)), BANDS).cast(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["k", "n", "digest", "bands"])

    signed = staged(source.mapInArrow(released(sign), "k long, n long, digest binary, bands array<long>"), "signatures")
    # equal sets are one node; min of the key, and any one's bands, which are equal
    real = signed.where("n > 0 and k is not null")
    node_of = real.groupBy("digest").agg(F.min("k").alias("node"), F.first("bands").alias("bands"), F.first("n").alias("n"))
    nodes = staged(node_of, "nodes")
    rows = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    crowded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    rows = staged(rows.join(crowded, "bucket"), "buckets")

    # full sets of the candidates, and how many of each set's shingles occur in another's
    candidates = rows.select(F.col("node").alias("k")).distinct()
    sets = staged(_sets(source.join(candidates, "k", "left_semi"), k), "sets")
    each = sets.select("k", F.explode("s").alias("h"))
    common = each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    weight = each.join(common, "h").groupBy(F.col("k").alias("node")).agg(F.count(F.lit(1)).alias("w"))
    # a node with fewer shared shingles than percent of its own can link with nothing
    rows = staged(rows.join(weight, "node").where(100 * F.col("w") >= percent * F.col("n")), "buckets")
    reach = lambda n1, w1, n2, w2: (100 + percent) * F.least(w1, w2) >= percent * (n1 + n2)

    pivots = rows.groupBy("bucket").agg(F.max(F.struct((F.col("w") / F.col("n")).alias("share"), (-F.col("node")).alias("neg"), "n", "w")).alias("p")).select("bucket", (-F.col("p.neg")).alias("a"), F.col("p.n").alias("pn"), F.col("p.w").alias("pw"))
    stars = rows.join(pivots, "bucket").where((F.col("node") != F.col("a")) & reach(F.col("pn"), F.col("pw"), F.col("n"), F.col("w"))).select("a", F.col("node").alias("b")).distinct()
    held = staged(_shared(stars, sets), "stars")
    links = _linked(held, percent)
    root = components(links)

    # each bucket's nodes with the shingles they share with its pivot, null where that wasn't asked
    labelled = rows.join(root.withColumnRenamed("v", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = labelled.join(pivots.select("bucket", "a"), "bucket").join(held.select("a", F.col("b").alias("node"), "i"), ["a", "node"], "left").withColumn("i", F.when(F.col("node") == F.col("a"), F.col("n")).otherwise(F.col("i")))
    main = labelled.join(pivots.select("bucket", F.col("a").alias("node")), ["bucket", "node"]).select("bucket", F.col("root").alias("main"))
    several = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
    labelled = staged(labelled.join(several, "bucket").join(main, "bucket").join(nodes.select("node", "bands"), "node"), "labelled")
    rest = labelled.where("root <> main").select("bucket", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("w").alias("wb"), F.col("i").alias("ib"), F.col("bands").alias("bb"))
    # what two nodes share lies within the pivot's set or outside: by their shares with the pivot neither part can be larger
    most = F.coalesce(F.least("i", "ib") + F.least(F.col("w") - F.least("i", "w"), F.col("wb") - F.least("ib", "wb")), F.least("w", "wb"))
    most = F.when(F.col("i").isNull() | F.col("ib").isNull(), F.least("w", "wb")).otherwise(F.least(most, F.col("w"), F.col("wb")))
    # a pair counts in the first of the buckets that both are in
    once = F.expr("array_position(zip_with(bands, bb, (x, y) -> x = y), true) = array_position(bands, bucket)")
    cross = labelled.join(rest, "bucket").where((F.col("root") != F.col("rb")) & ((100 + percent) * most >= percent * (F.col("n") + F.col("nb"))) & once)
    cross = cross.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _linked(_shared(cross.join(tested, ["a", "b"], "left_anti"), sets), percent)
    root = components(links.unionByName(staged(more, "links")))

    final = nodes.select("digest", "node").join(root.withColumnRenamed("v", "node"), "node", "left").select("digest", F.coalesce("root", "node").alias("component"))
    out = signed.select("k", "n", "digest").join(final, "digest", "left").select("k", "n", F.when((F.col("n") > 0) & F.col("k").isNotNull(), F.col("component")).otherwise(F.col("k")).alias("component"))
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("k").eqNullSafe(F.col("component")).alias("kept"))
