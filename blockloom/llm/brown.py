"""Brown class bigram scores (operator 8).

log10 P(text) = sum over tokens of log10 P(class | class before) + log10 P(token | class).

Classes. Exchange clustering, in two steps. The CORE most frequent words are clustered one by one on the driver, each moving to
the class that raises the class bigram likelihood the most, until none moves. Then all other words of the corpus that
occur twice or more move in rounds on Spark: a pass over the training texts gathers the classes before and after every occurrence of a
word, and the word moves to the class under whose bigrams these are likeliest. Words seen once form one class with the
words never seen, so unseen words have the mass of those; the end of a text is a class and stands before its first token.

P(token | class) = (c + 0.5) / (N_class + 0.5 * (V_class + 1)); P(class | before) = (n + w * P(class)) / (n_before + w).

Size. All counts are of all training texts. Executors hold a table of the words that occur at least `least` times, the
smallest such number (2 or more) for which there are `known` of them at most; it gives the class before of a token. Words
outside the table get their classes as all others, and reach them and their counts by a join; as the token before, they all
count as the class of rare words. To the driver come that table, the bigrams of the core and the class bigrams.

Words are told apart by 64-bit hashes of their bytes; of 10^8 different words two share one with a chance of 3e-4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import partitions, released, ship, staged
from blockloom.llm.words import Words, chunks

KNOWN, CORE, CLASSES, ROUNDS, WEIGHT, BLOCK = 250_000, 500, 64, 2, 5.0, 2_000_000
#: Hash of the end token; word hashes are 64-bit, so a word has it with a probability of 2^-64.
END = np.uint64(0x656E64)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words and ends in order, tokens of each text)."""
    w = Words(data, offsets, fold=True)
    size = w.count + 1
    out = np.full(len(w) + len(size), END, np.uint64)
    out[np.arange(len(w)) + w.doc] = w.hash
    return out, size


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k, n = (np.concatenate([x[i] for x in held]) for i in (0, 1))
    by = np.argsort(k)
    k, n = k[by], n[by]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[at], np.add.reduceat(n, at)


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(w, c): how often each token, by hash, occurs in all texts; null is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for _, _, data, offsets in chunks(b.column(0)):
                held.append(np.unique(_tokens(data, offsets)[0], return_counts=True))
                size += len(held[-1][0])
                if size > BLOCK:
                    held = [_merge(held)]
                    size = len(held[0][0])
        if held:
            k, n = _merge(held)
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], names=["w", "c"])

    return docs.select(text).mapInArrow(released(run), "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


class Table:
    """Words at hand in hash order, with counts, classes and whether they are of the core; `rare` stands for all others, `end` for ends."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, classes: int):
        by = np.argsort(hashes)
        self.hashes, self.counts = hashes[by], counts[by]
        self.rare, self.end, self.size = classes, classes + 1, classes + 2
        self.cls, self.core = np.full(len(by), self.rare, np.uint8), np.zeros(len(by), bool)

    def place(self, tokens: np.ndarray) -> np.ndarray:
        """Places of tokens in the table, -1 for those outside."""
        if not len(self.hashes):
            return np.full(len(tokens), -1)
        distinct, back = np.unique(tokens, return_inverse=True)
        j = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return np.where(self.hashes[j] == distinct, j, -1)[back]

    def classes(self, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(tokens), self.rare, np.uint8)
        out[at >= 0] = self.cls[at[at >= 0]]
        out[tokens == END] = self.end
        return out


def _columns(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The two columns of a bounded table, the first unsigned."""
    got = df.toArrow()
    return got.column(0).to_numpy().astype(np.int64).view(np.uint64), got.column(1).to_numpy()


def _least(counts: DataFrame, known: int) -> int:
    """The least count of 2 or more that `known` words at most reach; counts are told apart by their 12 leading bits."""
    e = F.greatest(F.lit(0), F.floor(F.log2("c")).cast("int") - 11)
    step = F.expr("shiftleft(shiftright(c, e), e)")
    rows = counts.where("c > 1").withColumn("e", e).groupBy(step.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()  # some 80,000 at most
    total, least = 0, None
    for r in rows:
        total += r.n
        if total > known:
            return least or rows[0].c * 2
        least = r.c
    return 2


def core_bigrams(docs: DataFrame, core: np.ndarray, text: str = "text") -> np.ndarray:
    """Counts of adjacent tokens in all texts by their places in `core` (in hash order), all others as one, ends as one."""
    sent, size = docs.sparkSession.sparkContext.broadcast(core), len(core) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = sent.value
        total = np.zeros(size * size, np.int64)
        for b in batches:
            for _, _, data, offsets in chunks(b.column(0)):
                tokens = _tokens(data, offsets)[0]
                j = np.minimum(np.searchsorted(core, tokens), len(core) - 1)
                ids = np.where(core[j] == tokens, j, size - 2)
                ids[tokens == END] = size - 1
                total += np.bincount(np.append(size - 1, ids[:-1]) * size + ids, minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "n"])

    out = np.zeros(size * size, np.int64)
    if len(core):
        at, times = _columns(docs.select(text).mapInArrow(released(run), "i long, n long").groupBy("i").agg(F.sum("n").alias("n")))  # (CORE + 2)^2 at most
        out[at.astype(np.int64)] = times
    return out.reshape(size, size)


def exchange(n: np.ndarray, m: int, classes: int, rounds: int = 6) -> np.ndarray:
    """A class for each of m ids: each id in turn moves to the class that raises the class bigram likelihood the most.

    n: bigram counts of m clustered ids and the others, which keep one class each. Starts from ids dealt in their order;
    stops when no id moves. Only sums of x log x over class bigrams and class counts change, so a move costs O(classes).
    """
    size, fixed = len(n), len(n) - m
    k = classes + fixed
    own = np.concatenate((np.arange(m) % classes, classes + np.arange(fixed)))
    n = n.astype(np.float64)
    f = lambda x: x * np.log(np.maximum(x, 1))
    by = np.zeros((size, k))
    by[np.arange(size), own] = 1
    right, left = n @ by, n.T @ by  # of an id: counts before and after each class
    table = by.T @ right
    for _ in range(rounds):
        moved = 0
        for w in range(m):
            old, loop = own[w], n[w, w]
            after, before = right[w].copy(), left[w].copy()
            after[old], before[old] = after[old] - loop, before[old] - loop  # w itself apart
            table[old] -= right[w]
            table[:, old] -= left[w]
            table[old, old] += loop
            rows, cols = table.sum(1), table.sum(0)
            out, into = after.sum() + loop, before.sum() + loop
            c = np.arange(classes)
            # likelihood of w in each class, against none
            gain = (f(table[c] + after) - f(table[c])).sum(1) + (f(table[:, c] + before[:, None]) - f(table[:, c])).sum(0)
            d = table[c, c]
            gain += f(d + after[c] + before[c] + loop) - f(d + after[c]) - f(d + before[c]) + f(d)
            gain -= f(rows[c] + out) - f(rows[c]) + f(cols[c] + into) - f(cols[c])
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            row, col = right[w].copy(), left[w].copy()
            if new != old:
                moved += 1
                own[w] = new
                right[:, old] -= n[:, w]
                right[:, new] += n[:, w]
                left[:, old] -= n[w]
                left[:, new] += n[w]
                row, col = right[w].copy(), left[w].copy()
            table[new] += row
            table[:, new] += col
            table[new, new] -= loop
        if not moved:
            break
    return own


def _round(docs: DataFrame, table: Table, bigrams: np.ndarray, full: bool, text: str) -> DataFrame:
    """One round of moves: rows (w, n, cls, h). With w: a word's count and class. Without: how often class cls follows class h.

    Core words, ends and, unless the table is full, words outside it (all of them seen once) keep their classes, so that
    only their class bigrams are counted. Of every other word come the classes before and after each occurrence, as two
    bytes; a block of tokens sends one row a word.
    """
    sent, size, rare = docs.sparkSession.sparkContext.broadcast(table), table.size, table.rare

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, total, held, n = sent.value, np.zeros(size * size, np.int64), [], 0
        names = ["kind", "w", "around"]

        def rows():
            w, pair = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            by = np.argsort(w, kind="stable")
            w, pair = w[by], pair[by]
            at = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            raw = pa.py_buffer(pair.tobytes())
            edges = (2 * np.append(at, len(w))).astype(np.int32)
            around = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(edges.tobytes()), raw])
            whole = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(at), np.int32)), pa.array(w[at].view(np.int64)), around], names=names)
            for i in range(0, len(at), 50_000):
                yield whole.slice(i, 50_000)

        for b in batches:
            for _, _, data, offsets in chunks(b.column(0)):
                tokens, _ = _tokens(data, offsets)
                at = t.place(tokens)
                cls = t.classes(tokens, at)
                before, after = np.append(np.uint8(t.end), cls[:-1]), np.append(cls[1:], np.uint8(t.rare))
                fixed = tokens == END if full else (at < 0)
                fixed |= (at >= 0) & t.core[at]
                total += np.bincount(before[fixed].astype(np.int64) * size + cls[fixed], minlength=size * size)
                held.append((tokens[~fixed], np.stack((before[~fixed], after[~fixed]), 1)))
                n += len(held[-1][0])
                if n > BLOCK:
                    yield from rows()
                    held, n = [], 0
        if n:
            yield from rows()
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=names)

    known = np.maximum(bigrams.astype(np.float64), 0.1)
    # log likelihood of one occurrence in each class, by the class after and by the class before
    ahead = np.log(known[:rare] / known.sum(1)[:rare, None]).T.copy()
    behind = np.log(known[:, :rare] / known.sum(0)[None, :rare]).copy()
    scale = docs.sparkSession.sparkContext.broadcast((ahead, behind))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead, behind = scale.value
        total, open_w, open_n = np.zeros((size, size), np.int64), None, None

        def placed(w, before, after):
            """Classes of words with all their occurrences."""
            n = before.sum(1)
            cls = np.argmax(after @ ahead + before @ behind, 1)
            cls[n == 1] = rare
            order = np.argsort(cls, kind="stable")
            of, at = np.unique(cls[order], return_index=True)
            if len(of):
                total[:, of] += np.add.reduceat(before[order], at, 0).astype(np.int64).T
            return pa.RecordBatch.from_arrays([pa.array(w), pa.array(n.astype(np.int64)), pa.array(cls.astype(np.int32)), pa.nulls(len(w), pa.int32())], names=["w", "n", "cls", "h"])

        for b in batches:
            kind = b.column(0).to_numpy()
            for i in np.flatnonzero(kind == 1).tolist():
                total += np.frombuffer(b.column(2)[i].as_py(), np.int64).reshape(size, size)
            words = b.slice(0, int((kind == 0).sum()))  # kind 0 is sorted to the front
            for lo in range(0, words.num_rows, 10_000):
                part = words.slice(lo, 10_000)
                w = part.column(1).to_numpy()
                col = part.column(2)
                edge = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
                pair = np.frombuffer(col.buffers()[2], np.uint8)[edge[0] : edge[-1]].reshape(-1, 2)
                new = np.append(True, w[1:] != w[:-1])
                group, g = np.repeat(np.cumsum(new) - 1, np.diff(edge) // 2), int(new.sum())
                before, after = (np.bincount(group * size + pair[:, i], minlength=g * size).reshape(g, size).astype(np.float64) for i in (0, 1))
                w = w[new]
                if open_w is not None:  # the last word of what came before may go on
                    if w[0] == open_w:
                        before[0] += open_n[0]
                        after[0] += open_n[1]
                    else:
                        w, before, after = np.append(open_w, w), np.vstack((open_n[0], before)), np.vstack((open_n[1], after))
                open_w, open_n = w[-1], (before[-1], after[-1])
                if len(w) > 1:
                    yield placed(w[:-1], before[:-1], after[:-1])
        if open_w is not None:
            yield placed(np.array([open_w]), open_n[0][None], open_n[1][None])
        h, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.int64()), pa.array(total[h, c]), pa.array(c.astype(np.int32)), pa.array(h.astype(np.int32))], names=["w", "n", "cls", "h"])

    # a task's class bigrams (kind 1) are dealt by the task, words (kind 0) by the word
    met = docs.select(text).mapInArrow(released(gather), "kind int, w long, around binary")
    dealt = met.repartition(partitions(docs.sparkSession), "kind", "w").sortWithinPartitions("kind", "w")
    return staged(dealt.mapInArrow(released(move), "w long, n long, cls int, h int"), "classes")


class Model:
    """Table of known words, class bigrams, words and occurrences by class, and all words (w, c, cls) that are not in the table."""

    def __init__(self, table: Table, bigrams: np.ndarray, types: np.ndarray, n: int, v: int, ends: int, outside: DataFrame):
        self.table, self.bigrams, self.types, self.n, self.v, self.ends, self.outside = table, bigrams, types, n, v, ends, outside

    def logs(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(class | before) as (before, class), and log10 of what divides a token's c + 0.5."""
        single = self.bigrams.sum(0).astype(np.float64)
        prior = (single + 0.5) / (single.sum() + 0.5 * len(single))
        move = np.log10((self.bigrams + WEIGHT * prior) / (self.bigrams.sum(1, keepdims=True) + WEIGHT))
        return move, np.log10(single + 0.5 * (self.types + 1))


def train(docs: DataFrame, text: str = "text", known: int = KNOWN, core: int = CORE, classes: int = CLASSES, rounds: int = ROUNDS) -> Model:
    """The class model of all texts of docs; null is an empty text. classes: 250 at most."""
    counts = staged(token_counts(docs, text), "token-counts")
    end = F.col("w") == int(END)
    n_all, v_all, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(end, F.col("c"))), F.lit(0))).first()
    words = counts.where(~end)
    least = _least(words, known)
    table = Table(*_columns(words.where(F.col("c") >= least)), classes)  # `known` rows at most
    rank = np.lexsort((table.hashes, -table.counts))[:core]
    table.core[rank] = True
    mine = np.flatnonzero(table.core)
    n = core_bigrams(docs, table.hashes[mine], text)
    # dealt to the classes in order of frequency
    by = np.argsort(-table.counts[mine], kind="stable")
    order = np.append(by, [len(mine), len(mine) + 1])
    own = exchange(n[np.ix_(order, order)], len(mine), classes)
    table.cls[mine[by]] = own[: len(mine)]
    onto = np.zeros((len(order), table.size))
    onto[np.arange(len(order)), own] = 1
    bigrams = onto.T @ n[np.ix_(order, order)] @ onto
    found = None
    for _ in range(rounds):
        found = _round(docs, table, bigrams, least > 2, text)
        bigrams = np.zeros((table.size, table.size), np.int64)
        for r in found.where("w is null").groupBy("h", "cls").agg(F.sum("n").alias("n")).collect():  # classes squared
            bigrams[r.h, r.cls] = r.n
        moved, to = _columns(found.where(F.col("w").isNotNull() & (F.col("n") >= least)).select("w", "cls"))  # `known` rows at most
        # the classes of this round are predicted; the classes before them are those of the round before
        history = table
        table = Table(history.hashes, history.counts, classes)
        table.cls, table.core = history.cls.copy(), history.core
        table.cls[np.searchsorted(table.hashes, moved)] = to
        table.before = history.cls
    types = np.bincount(table.cls, minlength=table.size).astype(np.float64)
    rest = found.where(F.col("w").isNotNull() & (F.col("n") < least))
    for r in rest.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect():
        types[r.cls] += r.n
    placed = rest.select("w", F.col("n").alias("c"), "cls")
    outside = placed if least > 2 else words.where("c < 2").withColumn("cls", F.lit(table.rare))
    if least == 2:
        types[table.rare] += v_all - (ends > 0) - len(table.hashes)
    types[table.end] += ends > 0
    return Model(table, bigrams, types, int(n_all), int(v_all), int(ends), outside)


def score(docs: DataFrame, trained: str, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """(key, `keep`, n_tokens, n_known, train_tokens, base_score, score) for each row; learns from rows where `trained`, by train().

    Tokens: ASCII-lower-cased words, then one end. base_score: sum of log10((c+0.5)/(N+0.5(V+1))). Null text is empty:
    one token. Without training rows every count is 0 and the formulas still hold. Repeated rows count as often as they
    occur; keys may be null or repeat. An empty table gives no rows. Columns but key, text, `keep` and those in `trained`
    aren't read; a column of `keep` that has the name of a result is refused.
    """
    keep = keep or []
    if clash := {"n_tokens", "n_known", "train_tokens", "base_score", "score"} & {key, *keep}:
        raise ValueError(f"columns {sorted(clash)} have names of results")
    ship(docs.sparkSession)
    model = train(docs.where(trained), text, **options)
    sent = docs.sparkSession.sparkContext.broadcast((model.table, *model.logs(), model.ends))

    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.monotonically_increasing_id().alias("row"))
    kinds = dict(source.dtypes)
    kept = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, move, below, ends = sent.value
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1)):
                tokens, size = _tokens(data, offsets)
                at = t.place(tokens)
                cls = t.classes(tokens, at)
                history = cls.copy()
                history[at >= 0] = t.before[at[at >= 0]]
                start = np.cumsum(size) - size
                before = np.append(np.uint8(t.end), history[:-1])
                c = np.where(at >= 0, t.counts[at] if len(t.counts) else 0, np.where(tokens == END, ends, 0))
                out = (at < 0) & (tokens != END)
                steps = np.add.reduceat(np.where(out, 0.0, move[before, cls] - below[cls]), start)
                logs = np.add.reduceat(np.where(out, 0.0, np.log10(c + 0.5)), start)
                known = np.add.reduceat(((c > 0) & ~out).astype(np.int64), start)
                # a text's tokens outside the table, by token and class before
                doc = np.repeat(np.arange(len(size)), size)[out]
                w, h = tokens[out], before[out]
                by = np.lexsort((h, w, doc))
                w, h, doc = w[by], h[by], doc[by]
                new = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(w) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(w)))
                rare = pa.StructArray.from_arrays([pa.array(w[new].view(np.int64)), pa.array(h[new].astype(np.int32)), pa.array(times.astype(np.int32))], names=["w", "h", "tf"])
                edge = np.searchsorted(doc[new], np.arange(len(size) + 1)).astype(np.int32)
                rows = b.slice(lo, hi - lo)
                cols = [rows.column("k"), *(rows.column(x) for x in kept), rows.column("row"), pa.array(size), pa.array(known), pa.array(steps), pa.array(logs), pa.ListArray.from_arrays(pa.array(edge), rare)]
                yield pa.RecordBatch.from_arrays(cols, names=["k", *kept, "row", "n", "known", "steps", "logs", "rare"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, move, below, _ = sent.value
        for b in batches:
            h, tf, c, cls = (b.column(x).to_numpy(zero_copy_only=False) for x in ("h", "tf", "c", "cls"))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(tf * (move[h, cls] - below[cls])), pa.array(tf * np.log10(c + 0.5)), pa.array(np.where(c > 0, tf, 0).astype(np.int64))], names=["row", "s", "l", "k"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in ["k", *kept]) + ", row long, n long, known long, steps double, logs double, rare array<struct<w:long,h:int,tf:int>>"
    part = staged(source.mapInArrow(released(run), schema), "scores")
    rare = part.select("row", F.explode("rare").alias("x")).select("row", "x.w", "x.h", "x.tf").join(model.outside, "w", "left")
    rare = rare.select("row", "h", "tf", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("cls", F.lit(model.table.rare)).alias("cls"))
    rare = rare.mapInArrow(released(weigh), "row long, s double, l double, k long").groupBy("row").agg(F.sum("s").alias("s"), F.sum("l").alias("l"), F.sum("k").alias("more"))
    out = part.drop("rare").join(rare, "row", "left").withColumn("logs", F.col("logs") + F.coalesce("l", F.lit(0.0)))
    base = float(np.log10(model.n + 0.5 * (model.v + 1)))
    return out.select(
        F.col("k").alias(key), *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n") * F.lit(base)).alias("base_score"), (F.col("logs") + F.col("steps") + F.coalesce("s", F.lit(0.0))).alias("score"),
    )
