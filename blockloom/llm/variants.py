"""Words that differ by one letter, and the form each is a spelling of (operator 12).

Pivotal grams. Bigrams are ordered rare ones first. A word's prefix is its three first bigrams in that order, with all
places of the last one; among these, dynamic programming takes the two disjoint ones of least frequency as pivots. One
edit touches at most one of two disjoint bigrams, so of two near words the one whose prefix ends earlier in the order has
a pivot that is also in the other's prefix, at the same distance from the start (if the edit comes after the left pivot)
or from the end (if it comes before the right pivot's start). Pivots are held against the prefixes of other words by that
position limit: what lies between the word's edge and the gram must be equal too, so the join key is a hash of it,
together with the other word's length. What is left of the two words differs by one edit too, so its first or its second
half is the same, cut at half the shorter one's length: hashes of both halves drop nearly all other candidates, and the
rest are verified by edit distance.

The order is only a matter of speed, so the table of frequencies has the GRAMS commonest bigrams at most; others count as
rarest. A word sends six look-ups and two entries for each bigram of its prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import ascii_lower, released, ship, staged

#: Fixed: letters of the words.
LETTERS = "[A-Za-zÀ-ÿ]"
SHORTEST, GRAMS = 7, 20_000


def corpus_words(docs: DataFrame, key: str = "doc_id", text: str = "text", damaged: int | None = 31, least: int = SHORTEST, at_least: int = 2) -> DataFrame:
    """(word, n) of runs of letters in the texts, A-Z lower-cased: at least `least` letters and `at_least` occurrences.

    damaged: where it divides the crc32 of `<key>:<run>`, the run loses the letter number crc32 % length. Null and empty
    texts have no words; with a null key nothing is damaged. Rows that repeat count each time.
    """
    run = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("k"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("r"))
    run = run.select("k", ascii_lower(F.col("r")).alias("r"))
    word = F.col("r")
    if damaged:
        run = run.withColumn("h", F.crc32(F.concat("k", F.lit(":"), "r").cast("binary")))
        cut = F.expr("concat(substring(r, 1, cast(h % length(r) as int)), substring(r, cast(h % length(r) as int) + 2))")
        word = F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("r"))
    return run.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)


def prefix(word: str, rank: dict[str, int]) -> tuple[list[int], tuple[int, str], int, int]:
    """(places of the prefix's bigrams, the last one's order, left pivot, right pivot) of a word of four letters at least."""
    order = [(rank.get(word[i : i + 2], 0), word[i : i + 2]) for i in range(len(word) - 1)]
    last = sorted(order)[2]
    places = [i for i, x in enumerate(order) if x <= last]
    # cheapest pair (i, j) with i + 2 <= j: the best single one so far, then the best pair that ends at j
    best, one, lo = None, None, 0
    for j in places:
        while lo < len(places) and places[lo] + 2 <= j:
            i = places[lo]
            if one is None or order[i][0] < one[0]:
                one = (order[i][0], i)
            lo += 1
        if one is not None and (best is None or one[0] + order[j][0] < best[0]):
            best = (one[0] + order[j][0], one[1], j)
    return places, last, best[1], best[2]


def halves(part: str, size: int) -> tuple[int, int]:
    """Hashes of the first size // 2 letters and of the last size - size // 2 ones of a part of at least `size` letters."""
    cut = size // 2
    a, b = part[:cut], part[len(part) - (size - cut) :]
    return xxhash.xxh32_intdigest(a) - (1 << 31), xxhash.xxh32_intdigest(b) - (1 << 31)


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, na, nb) for each pair a < b of `words` (word, n) that one inserted, deleted or replaced letter makes equal.

    Words are distinct, not null and have four letters at least.
    """
    spark = words.sparkSession
    ship(spark)
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("c"))
    table = {r.gram: r.c for r in grams.orderBy(F.desc("c"), "gram").limit(GRAMS).collect()}
    sent = spark.sparkContext.broadcast(table)  # GRAMS entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = sent.value
        for b in batches:
            out: list[tuple] = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                places, (c, g), left, right = prefix(word, rank)
                size = len(word)
                for p in places:
                    for side, part, rest in (("<", word[: p + 2], word[p + 2 :]), (">", word[p:], word[:p])):
                        h = xxhash.xxh3_64_intdigest(side + part) - (1 << 63)
                        # the shorter rest is this one, or a letter less
                        out.append((False, h, size, word, n, c, g, *halves(rest, len(rest)), *halves(rest, max(len(rest) - 1, 0))))
                for side, part, rest in (("<", word[: left + 2], word[left + 2 :]), (">", word[right:], word[:right])):
                    h = xxhash.xxh3_64_intdigest(side + part) - (1 << 63)
                    same, less = halves(rest, len(rest)), halves(rest, max(len(rest) - 1, 0))
                    out += [(True, h, other, word, n, c, g, *(less if other < size else same), int(other > size), 0) for other in (size - 1, size, size + 1)]
            for i in range(0, len(out), 10_000):
                cols = zip(zip(*out[i : i + 10_000], strict=True), (pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int32()] * 4), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], names=["asks", "part", "size", "word", "n", "c", "g", "a", "b", "a1", "b1"])

    rows = staged(words.mapInArrow(released(run), "asks boolean, part long, size int, word string, n long, c long, g string, a int, b int, a1 int, b1 int"), "grams", tidy=True)
    ask = rows.where("asks").select("part", "size", *[F.col(x).alias(f"{x}_") for x in ("word", "n", "c", "g", "a", "b")], (F.col("a1") == 1).alias("longer"))
    held = rows.where("not asks").drop("asks")
    half = F.when(F.col("longer"), (F.col("a_") == F.col("a1")) | (F.col("b_") == F.col("b1"))).otherwise((F.col("a_") == F.col("a")) | (F.col("b_") == F.col("b")))
    earlier = (F.col("c_") < F.col("c")) | ((F.col("c_") == F.col("c")) & (F.col("g_") <= F.col("g")))
    # distances are only taken of what is left
    near = F.when(half & earlier & (F.col("word") != F.col("word_")), F.levenshtein("word_", "word", 1) == 1).otherwise(False)
    pairs = ask.join(held, ["part", "size"]).where(near)
    swap = F.col("word_") > F.col("word")
    pick = lambda c: (F.when(swap, F.col(c)).otherwise(F.col(f"{c}_")), F.when(swap, F.col(f"{c}_")).otherwise(F.col(c)))
    (a, b), (na, nb) = pick("word"), pick("n")
    return pairs.select(a.alias("a"), b.alias("b"), na.alias("na"), nb.alias("nb")).distinct()


def group_variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of `words` (word, n).

    form: the near word of largest n (of equals the least), if that is `factor` (2 at least) times n or more, else null;
    root: where following forms ends, the word itself without one. An empty table gives no rows.
    """
    if factor < 2:
        raise ValueError("a form must be commoner than its word")
    pairs = staged(near_words(words), "pairs", tidy=True)
    each = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m")))
    best = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("x"))
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("x.m") >= factor * F.col("n"), F.col("x")).alias("x"))
    found = staged(found.select("word", "n", "n_near", F.col("x.near").alias("form"), (-F.col("x.m")).alias("form_n")), "forms", tidy=True)
    # each form is `factor` times commoner, so chains are short and doubling ends after a few rounds
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = staged(roots.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots", tidy=True)
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.drop("moved")
    return found.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
