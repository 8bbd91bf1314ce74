"""A Merkle manifest of a dataset (operator 13): one hash tree per group of rows, and one over the groups' roots.

Van Emde Boas layout. A tree of arity 3 is cut into aligned blocks of HEIGHT levels; a block is one row, its nodes stored
in an order that splits the tree at half its height, the top first and each bottom subtree after it, and these again.
Addresses are arithmetic on (depth, index): the same function places a node when the block is made and finds siblings
when a proof is read, and a path touches few neighbouring stretches of the block at any size of cache line. Blocks' roots
are the leaves of the next tier's blocks, up to a single one. A block holds 3^HEIGHT leaves, so no group is
gathered whole, however large; each tier has that many times fewer rows, and every step of a proof is a join by block.

Ranks come from range partitions in key order and their counts; no window or task sees all rows of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockloom.llm.common import partitions, released, ship, staged

ARITY, HEIGHT = 3, 6
SPAN = ARITY**HEIGHT


def nodes_in(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(depth: int, index, levels: int):
    """Place of the index-th node at a depth (0: the root) of a tree with so many levels; index may be an array."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    below = ARITY ** (depth - top)
    return nodes_in(top) + index // below * nodes_in(levels - top) + address(depth - top, index % below, levels - top)


@lru_cache(maxsize=HEIGHT + 1)
def addresses(height: int) -> list[np.ndarray]:
    """Places of the nodes of each height above the leaves (0), in order."""
    return [address(height - up, np.arange(ARITY ** (height - up)), height + 1) for up in range(height + 1)]


def counts(n: int, height: int) -> list[int]:
    """Nodes of each height over n leaves."""
    return [-(-n // ARITY**up) for up in range(height + 1)]


def grow(leaves: list[bytes], height: int) -> bytes:
    """The block's nodes, 32 bytes each, in layout order; empty places are zero."""
    out = np.zeros((nodes_in(height + 1), 32), np.uint8)
    level, at = leaves, addresses(height)
    for up in range(height + 1):
        if up:
            names = [x.hex() for x in level]
            level = [hashlib.sha256("".join(names[i : i + ARITY]).encode()).digest() for i in range(0, len(names), ARITY)]
        out[at[up][: len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, 32)
    return out.tobytes()


def siblings(nodes: bytes, n: int, height: int) -> list[list[tuple[str, str]]]:
    """For each of the block's n leaves, from its level upwards: the hex digests before and after it in its run."""
    at, size = addresses(height), counts(n, height)
    names = [[nodes[32 * p : 32 * p + 32].hex() for p in at[up][: size[up]].tolist()] for up in range(height)]
    around = []
    for level in names:
        runs = [level[i : i + ARITY] for i in range(0, len(level), ARITY)]
        around.append([("".join(r[:j]), "".join(r[j + 1 :])) for r in runs for j in range(len(r))])
    return [[around[up][i // ARITY**up] for up in range(height)] for i in range(n)]


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = hashlib.sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def depth_of(n: int) -> int:
    """Levels above n leaves until one node remains."""
    up = 0
    while ARITY**up < n:
        up += 1
    return up


def digest(columns: list[Column]) -> Column:
    """Hex sha256 of the columns: `-` for null, else UTF-8 byte count, `:`, value."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text]), 256)


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df with `rank` (0-based, in the given order within the group) and `n`, the group's rows. group: a string without nulls."""
    spark, by = df.sparkSession, [group, *order]
    position, schema = df.columns.index(group), ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    names = [*df.columns, "pid", "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            code = b.column(position).dictionary_encode()
            ids = code.indices.to_numpy()
            heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            own = np.arange(b.num_rows) - np.repeat(heads, np.diff(np.append(heads, b.num_rows)))
            first = code.dictionary[ids[0]].as_py()
            if first == last:
                own[: heads[1] if len(heads) > 1 else None] += seen
            last, seen = code.dictionary[ids[-1]].as_py(), int(own[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, pid, np.int64)), pa.array(own)], names=names)

    parts = df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).mapInArrow(released(run), f"{schema}, pid long, own long")
    parts = staged(parts, "numbered", tidy=True)
    pieces = parts.groupBy(group, "pid").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(group)
    pieces = pieces.select(group, "pid", F.coalesce(F.sum("c").over(w.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("c").over(w).alias("n"))
    return parts.join(pieces, [group, "pid"]).withColumn("rank", F.col("before") + F.col("own")).drop("pid", "own", "before")


def blocks(nodes: DataFrame, tier: int, more: list[str]) -> DataFrame:
    """(g, n, block, nodes, top, items) from nodes (g, n, rank, digest and `more`): blocks of SPAN nodes in their layout; top: the block's root."""
    item = F.struct("rank", "digest", *more)
    grouped = nodes.groupBy("g", F.expr(f"rank div {SPAN}").alias("block")).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))
    grouped = grouped.select("g", "n", "block", "items")
    kind = dict(grouped.dtypes)["items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made, tops = [], []
            for n, items in zip(b.column(1).to_pylist(), b.column(3), strict=True):
                height = min(HEIGHT, depth_of(n) - HEIGHT * tier)
                made.append(grow([bytes.fromhex(x) for x in items.values.flatten()[1].to_pylist()], height))
                tops.append(made[-1][:32].hex())  # the root's address is 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary()), pa.array(tops, pa.string())], names=["g", "n", "block", "items", "nodes", "top"])

    return staged(grouped.mapInArrow(released(run), f"g string, n long, block long, items {kind}, nodes binary, top string"), f"tier-{tier}", tidy=True)


@dataclass
class Forest:
    """Blocks of the trees by tier; the first has the leaves."""

    tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """(g, n, root): one row for each tree."""
        out = [t.where(F.col("n") <= SPAN ** (i + 1)).where(F.col("n") > (SPAN**i if i else 0)).select("g", "n", F.col("top").alias("root")) for i, t in enumerate(self.tiers)]
        whole = out[0]
        for x in out[1:]:
            whole = whole.unionByName(x)
        return whole

    def paths(self, above: DataFrame, fields: str, pick) -> DataFrame:
        """Rows for the leaves. above: (g, more) with the path `above` over a tree's root; pick: a leaf's item and path to its row."""
        names = [c for c in above.columns if c not in ("g", "above")]
        # a tree's top block is its only one in the tier that it ends in
        waiting = above.withColumn("block", F.lit(0).cast("long"))
        ends = self.roots().select("g", "n")
        waiting = waiting.join(ends, "g")
        below = None
        for i in range(len(self.tiers) - 1, -1, -1):
            top = waiting.where((F.col("n") <= SPAN ** (i + 1)) & (F.col("n") > (SPAN**i if i else 0))).drop("n")
            known = top if below is None else below.unionByName(top)
            rows = self.tiers[i].drop("top").join(known, ["g", "block"])
            below = self._down(rows, i, names, dict(above.dtypes), fields, pick)
        return below

    @staticmethod
    def _down(rows: DataFrame, tier: int, names: list[str], kinds: dict[str, str], fields: str, pick) -> DataFrame:
        rows = rows.select("n", "items", "nodes", "above", "g", *names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    n, items, nodes, above = (b.column(j)[i].as_py() for j in range(4))
                    own = siblings(nodes, len(items), min(HEIGHT, depth_of(n) - HEIGHT * tier))
                    over = [(x["l"], x["r"]) for x in above]
                    rest = {c: b.column(5 + j)[i].as_py() for j, c in enumerate(names)}
                    g = b.column(4)[i].as_py()
                    if tier:
                        out = [{"g": g, "block": x["rank"], "above": [{"l": a, "r": z} for a, z in path + over], **rest} for x, path in zip(items, own, strict=True)]
                    else:
                        out = [pick(x, path + over, g, rest) for x, path in zip(items, own, strict=True)]
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

        flat = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
        if tier:
            schema = pa.schema([("g", pa.string()), ("block", pa.int64()), ("above", pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))), *[(c, flat[kinds[c]]) for c in names]])
            shape = "g string, block long, above array<struct<l:string,r:string>>" + "".join(f", {c} {kinds[c]}" for c in names)
        else:
            schema = pa.schema([(x.split()[0], flat[x.split()[1]]) for x in fields.split(", ")])
            shape = fields
        return rows.mapInArrow(released(run), shape)


def forest(leaves: DataFrame, more: list[str]) -> Forest:
    """Trees over leaves (g, n, rank, digest and `more`)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    tiers = [blocks(leaves, 0, more)]
    while SPAN ** len(tiers) < most:
        up = tiers[-1].where(F.col("n") > SPAN ** len(tiers)).select("g", "n", F.col("block").alias("rank"), F.col("top").alias("digest"))
        tiers.append(blocks(up, len(tiers), []))
    return Forest(tiers)


@dataclass
class Manifest:
    """`trees`: a tree for each group; `groups`: one tree over their roots, with the group's key as an item."""

    trees: Forest
    groups: Forest

    def root(self) -> DataFrame:
        return self.groups.roots().select("root")


def build(docs: DataFrame, columns: list[str], group: str, order: str, claimed: Column | None = None) -> Manifest:
    """The manifest of docs: a leaf is the digest of `columns`; leaves stand in the order of `order` within their group.

    Groups are ordered by UTF-8 bytes, the null one first; null keys come first, and rows of one key stand in the order
    of their digests. claimed: another digest of the row, kept beside the leaf for `proofs`. Rows may repeat; an empty
    table has a manifest without a root. Columns that aren't named aren't read.
    """
    ship(docs.sparkSession)
    leaf = digest([F.col(c) for c in columns])
    rows = docs.select(F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("g"), F.col(group).cast("string"))).alias("g"), F.col(order).alias("k"), leaf.alias("digest"), (leaf if claimed is None else claimed).alias("claimed"))
    trees = forest(staged(numbered(rows, "g", ["k", "digest"]), "leaves", tidy=True), ["k", "claimed"])
    # the groups' own tree: one group of all, in the order of their keys
    roots = trees.roots().select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("digest"))
    return Manifest(trees, forest(staged(numbered(roots, "g", ["name"]), "roots", tidy=True), ["name"]))


def save(manifest: Manifest, path: str) -> None:
    """Write the blocks of all tiers under a new folder, a row for each block, and how many tiers there are."""
    parts = {"trees": manifest.trees.tiers, "groups": manifest.groups.tiers}
    for name, tiers in parts.items():
        for i, t in enumerate(tiers):
            t.write.parquet(f"{path}/{name}-{i}")
    spark = manifest.trees.tiers[0].sparkSession
    spark.createDataFrame([tuple(map(len, parts.values()))], "trees int, groups int").coalesce(1).write.parquet(f"{path}/tiers")


def load(spark: SparkSession, path: str) -> Manifest:
    """The manifest that `save` wrote; proofs read its stored blocks."""
    ship(spark)
    n = spark.read.parquet(f"{path}/tiers").first()
    return Manifest(*(Forest([spark.read.parquet(f"{path}/{name}-{i}") for i in range(n[name])]) for name in ("trees", "groups")))


def proofs(manifest: Manifest, key: str, key_type: str = "long") -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of the manifest.

    proof_sha256: of the siblings on the way to the root, left to right, level by level; folded_root: what the claimed
    digest gives with these siblings. A row is verified if that is the root.
    """
    top = manifest.groups.roots().select("g", F.array().cast("array<struct<l:string,r:string>>").alias("above"), "root")

    def name_of(item: dict, path: list, g: str, rest: dict) -> dict:
        return {"g": item["name"], "subroot": item["digest"], "root": rest["root"], "packed": "\n".join(f"{a},{b}" for a, b in path)}

    over = manifest.groups.paths(top, "g string, subroot string, root string, packed string", name_of)
    unpacked = F.when(F.col("packed") == "", F.array().cast("array<struct<l:string,r:string>>")).otherwise(F.transform(F.split("packed", "\n"), lambda x: F.struct(F.split(x, ",")[0].alias("l"), F.split(x, ",")[1].alias("r"))))
    over = staged(over.select("g", "subroot", "root", unpacked.alias("above")), "group-paths", tidy=True)

    def prove(item: dict, path: list, g: str, rest: dict) -> dict:
        folded = fold(item["claimed"], path)
        proof = hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest()
        return {"k": item["k"], "leaf": item["digest"], "subroot": rest["subroot"], "root": rest["root"], "proof_sha256": proof, "folded_root": folded, "verified": folded == rest["root"]}

    fields = f"k {key_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return manifest.trees.paths(over, fields, prove).withColumnRenamed("k", key)
