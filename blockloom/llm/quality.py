"""Quality by hashed n-gram log-likelihood ratio, beside plain text rules (operator 10).

Words and pairs of adjacent words of a text are hashed to buckets. Two multinomials over the buckets, the trusted target
and the raw corpus, give each text a mean log-likelihood ratio per n-gram. A text is kept if the mean reaches the threshold that best
separates trusted from rejected labelled rows, with the fewest on the wrong side: the verdict is a function of the text, the two count vectors and this number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import released, ship, staged
from blockloom.llm.words import PLAIN, Words, chunks, distinct, grams, mix, run_hash

#: THRESHOLD holds where labels of either kind are missing.
BUCKETS, THRESHOLD = 1 << 14, -0.05
#: One of FIT trusted documents helps to set the threshold.
STEPS, FIT = 1000, 4
_SYMBOL = np.zeros(256, bool)
#: Fixed: the characters that count as symbols.
_SYMBOL[list(b"#*$%&|<>")] = True
WINDOW = 8


def features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of each n-gram: single words, and pairs within a text."""
    pair = grams(words.hash, 2)
    inside = words.doc[:-1] == words.doc[1:] if len(words) > 1 else np.zeros(0, bool)
    one = run_hash(words.hash, np.arange(len(words)), np.arange(1, len(words) + 1))
    h = np.concatenate((one, pair[inside]))
    return (h % np.uint64(buckets)).astype(np.int64), np.concatenate((words.doc, words.doc[:-1][inside] if len(words) > 1 else words.doc[:0]))


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """n-grams of all texts by bucket; what comes to the driver is one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, data, offsets in chunks(b.column(0)):
                total += np.bincount(features(Words(data, offsets, fold=True), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select(text).mapInArrow(released(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Natural log of target over raw probability of each bucket, one added to every count."""
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def _repeats(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(lines equal to an earlier line, words in repeated windows) of each text."""
    n = len(offsets) - 1
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    newline = np.flatnonzero(data == 0x0A)
    starts = np.union1d(offsets[:-1], newline + 1)
    starts = starts[starts < len(data)]
    stops = np.union1d(offsets[1:], newline)
    # the stop at a line's own start is the end of the text before it
    ends = np.where(data[starts] == 0x0A, starts, stops[np.searchsorted(stops, starts, "right")]) if len(starts) else starts
    has = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has], ends[has]
    doc = np.searchsorted(offsets, starts, "right") - 1
    line = distinct(data, starts, ends)[1]
    order = np.lexsort((line, doc))
    same = (line[order][1:] == line[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    lines = np.bincount(doc[order][1:][same], minlength=n)

    word = distinct(data, words.starts, words.ends)[1]
    g = grams(mix(word.astype(np.uint64)), WINDOW)
    if not len(g):
        return lines, np.zeros(n, np.int64)
    at = np.flatnonzero(words.doc[: len(g)] == words.doc[WINDOW - 1 :])
    v = mix(g[at] + words.doc[at].astype(np.uint64))
    order = np.argsort(v)
    same = v[order][1:] == v[order][:-1]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    if not (np.array_equal(words.doc[a], words.doc[b]) and all(np.array_equal(word[a + r], word[b + r]) for r in range(WINDOW))):
        # two windows share a hash: they are told apart by their words
        rows = np.column_stack((words.doc[at], *(word[at + r] for r in range(WINDOW))))
        v = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        order = np.argsort(v)
        same = v[order][1:] == v[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, at[twice], 1)
    np.add.at(mark, at[twice] + WINDOW, -1)
    inside = np.cumsum(mark)[:-1] > 0
    return lines, np.bincount(words.doc[inside], minlength=n)


def judge(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept) for each row of docs.

    base_failed: fewer than 20 words, or over 30 % of them in 8-word windows that the text has twice. llr: mean log ratio
    of the text's n-grams, 0 without any. kept: not base_failed and llr >= threshold. Null and empty text has no words and
    no lines. Keys may be null or repeat: each row is judged by its text alone. An empty table gives no rows. Other columns
    aren't read, also where they have the name of a result.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(ratio)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = model.value
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for _, _, data, offsets in chunks(b.column(1)):
                n, plain = len(offsets) - 1, Words(data, offsets)
                total = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
                point = PLAIN[data] & ((data & 0xC0) != 0x80)
                lines, again = _repeats(data, offsets, plain)
                bucket, doc = features(Words(data, offsets, fold=True), len(ratio))
                sums, grams_of = np.bincount(doc, ratio[bucket], minlength=n), np.bincount(doc, minlength=n)
                for col, v in zip(cols, (plain.count, total(point), total(_SYMBOL[data]), lines, again, sums / np.maximum(grams_of, 1)), strict=True):
                    col.append(v)
            arrays = [pa.array(np.concatenate(c) if c else [], pa.int64() if i < 5 else pa.float64()) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["k", *names, "llr"])

    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    scored = source.mapInArrow(released(run), f"k {dict(source.dtypes)['k']}, " + ", ".join(f"{c} long" for c in names) + ", llr double")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.select(F.col("k").alias(key), *names, failed.alias("base_failed"), "llr", (~failed & (F.col("llr") >= threshold)).alias("kept"))


def cut(scored: DataFrame, fallback: float = THRESHOLD, weight: float = 1.0) -> float:
    """The threshold with the fewest labelled rows on the wrong side, a trusted row counting `weight`; of equals the least.

    scored: rows (good, base_failed, llr); rows that the base rules fail count on neither side. It lies in the middle of
    the gap between the values on either side of it, which are told apart in steps of 1/STEPS.
    """
    step = F.floor(F.col("llr") * STEPS).alias("step")
    # one row a step; log ratios of counts lie within some 50,000 steps
    rows = scored.where(~F.col("base_failed")).groupBy(step).agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")).orderBy("step").collect()
    if not any(r.good for r in rows) or not any(r.bad for r in rows):
        return fallback
    wrong = least = sum(r.bad for r in rows)
    at = rows[0].step / STEPS
    for r, after in zip(rows, [*rows[1:], rows[-1]], strict=True):
        wrong += weight * r.good - r.bad
        if wrong < least:
            least, at = wrong, (r.step + 1 + max(after.step, r.step + 1)) / 2 / STEPS
    return at


def quality(docs: DataFrame, labels: DataFrame, threshold: float | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """judge() with the target learned from trusted documents and the raw counts from all.

    Trusted: documents with a label of quality 1 and not toxic; rejected: those with a label of quality 0 or toxic 1. All of
    them are read. A fourth of the trusted, by a hash, and the rejected set the threshold by cut(), if none is given; the
    target is learned from the other trusted documents. Without any, every ratio is that of the smoothed raw counts alone. Labels without a
    key are left out; of labels that share one, a rejecting one counts. Rows with a null key are judged but teach nothing.
    """
    ship(docs.sparkSession)
    rejected = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("toxic") == 1, F.col("quality") == 0, F.lit(False))
    named = labels.groupBy(key).agg(F.max(rejected).alias("bad"), F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good")).where(F.col(key).isNotNull())
    fits = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(FIT)) == 0
    known = named.where("good or bad").select(key, (~F.col("bad")).alias("good"))
    # texts move once, at any size, and only labelled ones are written
    taught = staged(docs.select(key, text).join(known.hint("merge"), key), "labelled", tidy=True)
    target = bucket_counts(taught.where(F.col("good") & ~fits), text)
    raw = bucket_counts(docs, text)
    ratio = log_ratio(target, raw) if target.sum() else np.zeros(len(raw))
    if threshold is None:
        rows = judge(taught.where(~F.col("good") | fits), ratio, 0.0, key, text)
        threshold = cut(rows.join(known, key), weight=FIT)
    return judge(docs, ratio, threshold, key, text)
