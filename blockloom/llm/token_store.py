"""Token ids in seekable zstandard files (operator 2).

A file is a row of independent zstandard frames, each holding whole documents, then two skippable frames:

- document index: magic 0x184D2A50, length, then for each frame its least and its greatest document id (int64 each) and
  its number of documents (uint32);
- seek table, as in the public seekable format: magic 0x184D2A5E, length, then for each frame its compressed size, its
  decompressed size and the low 32 bits of the XXH64 of its content (uint32 each); footer: number of frames (uint32),
  descriptor byte 0x80 (checksums present), magic 0x8F92EAB1.

A frame's content: number of documents n (uint32), how many of these, the first ones, have no id (uint32), n document ids
(int64, 0 for none), n lengths (uint32), then all token ids (uint32, little-endian). A frame without any id has a least one
above its greatest. A reader takes the two trailing tables with two short reads, then decompresses only frames that may hold
the documents it wants, and checks the checksum of each.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.common import partitions, released, shared_dir, staged
from blockloom.llm.words import PLAIN, chunks, distinct

INDEX_MAGIC, SEEK_MAGIC, FOOT_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_IDS = 1 << 17
CACHE = 1_000_000
JOINED = 4096
ASCII_SPACE = " \t\n\v\f\r"


class Encoder:
    """Ids of whole texts by a byte-level tokenizer, each distinct segment encoded once.

    A segment is a run of white space with the run of other characters after it. No pre-token of a byte-level tokenizer
    ends inside such a segment and goes on in the next, so ids of the segments joined are ids of the text. A segment
    isn't ended after a non-ASCII white space, as such runs belong together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel units
        self.model = Tokenizer.from_file(path)
        words = self.model.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(words.values()) + 1, np.int64)
        for word, i in words.items():
            self.width[i] = len(word)  # byte-level: a character of a token stands for one byte
        self.known: dict[bytes, int] = {}
        self.ids, self.at = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.n = self.end = 0

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(data)
        plain = PLAIN[data]
        cut = np.zeros(n, bool)
        cut[1:] = plain[:-1] & ~plain[1:]
        if n and data.max() >= 0x80:
            one, two, three = np.roll(data, 1), np.roll(data, 2), np.roll(data, 3)
            cut &= ~((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
            cut &= ~((three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A)) & (one >= 0x80))
        cut[offsets[:-1][offsets[:-1] < n]] = True
        return np.flatnonzero(cut)

    def _learn(self, new: list[bytes]) -> None:
        """Segments that white space parts at both ends are encoded joined, as nothing merges across their edges; a
        token's number of bytes tells where each one's ids end. Others are encoded alone."""
        texts = [x.decode() for x in new]
        joined = [i for i, t in enumerate(texts) if t[0] in ASCII_SPACE and not t[-1].isspace()]
        alone = sorted(set(range(len(new))) - set(joined))
        batches = ["".join(texts[i] for i in joined[at : at + JOINED]) for at in range(0, len(joined), JOINED)]
        got = self.model.encode_batch_fast(batches + [texts[i] for i in alone], add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in got])
        order = joined + alone
        ends = np.cumsum(np.fromiter((len(new[i]) for i in order), np.int64, len(order)))
        reached = np.cumsum(self.width[flat])
        edges = np.searchsorted(reached, ends) + 1
        if not np.array_equal(reached[edges - 1], ends):
            raise ValueError("a token spans two segments")
        need, rows = self.end + len(flat), self.n + len(new) + 1
        if need > len(self.ids):
            self.ids = np.resize(self.ids, 2 * need)
        if rows > len(self.at):
            self.at = np.resize(self.at, 2 * rows)
        self.ids[self.end : need] = flat
        self.at[self.n] = self.end
        self.at[self.n + 1 : rows] = self.end + edges
        self.known.update(zip([new[i] for i in order], range(self.n, rows - 1), strict=True))
        self.n, self.end = rows - 1, need

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of a chunk."""
        starts = self._segments(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        where, back = distinct(data, starts, ends)
        if self.n > CACHE:
            self.known, self.n, self.end = {}, 0, 0
        raw = data.tobytes()
        segments = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        new = [x for x in segments if x not in self.known]
        if new:
            self._learn(list(dict.fromkeys(new)))
        slot = np.fromiter((self.known[x] for x in segments), np.int64, len(segments))[back]
        lo, size = self.at[slot], self.at[slot + 1] - self.at[slot]
        ends_ids = np.cumsum(size)
        ids = self.ids[np.repeat(lo - (ends_ids - size), size) + np.arange(ends_ids[-1])]
        total = np.concatenate(([0], ends_ids))
        edge = np.searchsorted(starts, offsets)
        return ids, total[edge[1:]] - total[edge[:-1]]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Writer:
    """Writes one file; put() takes documents in order, close() adds the trailing tables."""

    def __init__(self, out, frame_ids: int = FRAME_IDS):
        self.out, self.frame_ids = out, frame_ids
        self.codec = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.docs, self.rows, self.parts, self.held = [], [], [], 0
        self.seek, self.index = [], []

    def put(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Documents without an id come before the others."""
        self.docs.append(doc_id)
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= self.frame_ids:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        keys = np.array([x or 0 for x in self.docs], "<i8")
        none = sum(x is None for x in self.docs)
        body = struct.pack("<II", len(keys), none) + keys.tobytes() + np.array([len(x) for x in self.parts], "<u4").tobytes() + np.concatenate(self.parts).astype("<u4").tobytes()
        packed = self.codec.compress(body)
        self.out.write(packed)
        self.seek.append(struct.pack("<III", len(packed), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        named = keys[none:] if none < len(keys) else np.array([0, -1])
        self.index.append(struct.pack("<qqI", int(named[0]), int(named[-1]), len(keys)))
        self.docs, self.parts, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        index = b"".join(self.index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), 0x80, FOOT_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()


def frames(file) -> list[tuple[int, int, int, int, int, int]]:
    """(offset, packed size, size, checksum, least id, greatest id) of each frame, from the trailing tables."""
    end = file.size()
    file.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != FOOT_MAGIC or not flags & 0x80:
        raise ValueError("no seek table with checksums at the end of the file")
    tail = 9 + 12 * n + 8
    file.seek(end - tail - 20 * n - 8)
    raw = file.read(tail + 20 * n + 8)
    if struct.unpack_from("<I", raw)[0] != INDEX_MAGIC or struct.unpack_from("<I", raw, 8 + 20 * n)[0] != SEEK_MAGIC:
        raise ValueError("trailing tables are damaged")
    out, at = [], 0
    for i in range(n):
        lo, hi, _ = struct.unpack_from("<qqI", raw, 8 + 20 * i)
        packed, size, check = struct.unpack_from("<III", raw, 16 + 20 * n + 12 * i)
        out.append((at, packed, size, check, lo, hi))
        at += packed
    return out


def read_documents(file, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id or None, ids) in file order. With `wanted`, only frames whose id range meets it are decompressed."""
    want = None if wanted is None else np.unique(np.fromiter(wanted, np.int64))
    for at, packed, size, check, lo, hi in frames(file):
        if want is not None and np.searchsorted(want, lo) >= np.searchsorted(want, hi, "right"):
            continue
        file.seek(at)
        body = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size)
        if xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of the frame at {at} differs")
        n, none = struct.unpack_from("<II", body)
        keys = np.frombuffer(body, "<i8", n, 8)
        sizes = np.frombuffer(body, "<u4", n, 8 + 8 * n).astype(np.int64)
        ids, ends = np.frombuffer(body, "<u4", -1, 8 + 12 * n), np.cumsum(sizes)
        for i in range(n if want is None else 0):
            yield None if i < none else int(keys[i]), ids[ends[i] - sizes[i] : ends[i]]
        for i in np.flatnonzero(np.isin(keys, want)).tolist() if want is not None else ():
            if i >= none:
                yield int(keys[i]), ids[ends[i] - sizes[i] : ends[i]]


def _store(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_store(docs: DataFrame, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text", out: str | None = None) -> DataFrame:
    """Encode, write and list: one row (pid, file, lo, hi, n_docs, n_ids) for each file, in ascending key order by pid.

    Texts are dealt by ranges of key and text hash and sorted, so each task writes one file of its range, frame by frame,
    holding one frame at a time; lo and hi are its least and greatest id. A task's file name has its attempt's own id: a
    task that runs twice leaves a file that the list doesn't name. The list is staged, so files are written once. Null
    text is empty; every document ends with end_id. Null keys come first and are stored without an id. Rows of one key
    are stored each, in order of their texts' hashes. An empty table gives no files.
    """
    spark = docs.sparkSession
    home = out or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    _store(home)[0].create_dir(_store(home)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, n_docs, n_ids, name, ends_of = encoder(tokenizer), None, 0, 0, "", []
        tail = np.array([end_id], np.uint32)
        for b in batches:
            keys = b.column(0).to_pylist()
            ends_of += [x for x in keys if x is not None]
            ends_of = ends_of[:1] + ends_of[-1:]
            for lo, hi, data, offsets in chunks(b.column(1)):
                if writer is None:
                    fs, path = _store(home)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids.zst"
                    writer = Writer(fs.open_output_stream(f"{path}/{name}", compression=None))
                ids, sizes = coder.encode(data, offsets)
                ends = np.cumsum(sizes)
                for i in range(hi - lo):
                    writer.put(keys[lo + i], np.concatenate((ids[ends[i] - sizes[i] : ends[i]], tail)))
                n_docs, n_ids = n_docs + hi - lo, n_ids + len(ids) + hi - lo
        if writer is not None:
            writer.close()
            row = [TaskContext.get().partitionId(), f"{home}/{name}", *(ends_of[:1] or [None]), *(ends_of[-1:] or [None]), n_docs, n_ids]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if i == 1 else pa.int64()) for i, x in enumerate(row)], names=["pid", "file", "lo", "hi", "n_docs", "n_ids"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    parts = rows.repartitionByRange(partitions(spark), "k", "h").sortWithinPartitions("k", "h").select("k", "t")
    return staged(parts.mapInArrow(released(run), "pid long, file string, lo long, hi long, n_docs long, n_ids long"), "token-files")


def read_store(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of all documents of a written store, each read from its file and checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                fs, path = _store(uri)
                with fs.open_input_file(path) as file:
                    out: tuple[list, list, list, list] = ([], [], [], [])
                    for doc, ids in read_documents(file):
                        for x, v in zip(out, (doc, start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                            x.append(v)
                        start += len(ids)
                        if len(out[0]) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=[key, "start", "n_tokens", "ids_crc32"])
                            out = ([], [], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=[key, "start", "n_tokens", "ids_crc32"])

    w = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row a file: the running sum sees as many rows as there are files
    placed = files.select("pid", "file", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("start"))
    spread = placed.repartition(partitions(files.sparkSession), "file")
    return spread.mapInArrow(released(run), f"{key} long, start long, n_tokens long, ids_crc32 long")


def fetch(files: DataFrame, wanted: list[int]) -> DataFrame:
    """(doc_id, ids) of requested documents; only files and frames that may hold them are opened and decompressed."""
    want = sorted(set(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, lo, hi in zip(*(b.column(c).to_pylist() for c in ("file", "lo", "hi")), strict=True):
                if bisect_left(want, lo) == bisect_right(want, hi):
                    continue
                fs, path = _store(uri)
                with fs.open_input_file(path) as file:
                    for doc, ids in read_documents(file, want):
                        yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return files.where("lo is not null").select("file", "lo", "hi").mapInArrow(released(run), "doc_id long, ids array<long>")
