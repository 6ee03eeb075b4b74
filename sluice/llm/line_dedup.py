"""Removal of lines that many documents hold, by a sharded minimal perfect hash."""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import open_folder, put_file
from sluice.session import scratch_path, stage

#: code points of the shortest line that can go, documents that must hold it
MIN_CHARS, MIN_DOCS = 20, 3
#: fixed values: the white space at both ends of a line that does not count
WHITE = b" \t\n\x0b\x0c\r"
#: keys of a shard, at most on average; bytes of text, and lines, that probe the shards together
SHARD_KEYS, PROBE_BYTES, PROBE_LINES = 1 << 18, 48 << 20, 1 << 20
#: shards that a task holds in memory
CACHED = 8
#: cells of a level of the hash for each of its keys
SPACE = 2
NULL_ID = -(1 << 63)
#: fixed values: odd numbers that mix the bits of a key
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


def _cells(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    """The cell of each key in a level, from both halves of it."""
    x = hi + np.uint64(MIX[2] * (2 * level + 1) % (1 << 64))
    for half in (lo, np.zeros(1, np.uint64)):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
        x = (x ^ (x >> np.uint64(31))) + half
    return x % np.uint64(size)


class PerfectHash:
    """Numbers distinct keys 0 to n - 1 by levels of bits.

    In each level a key has a cell; a cell that only one key wants gets a set
    bit and that key, the others go on to the next level.  The number of a
    key is the count of set bits before its own.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(hi):
            size = -(-SPACE * len(hi) // 64) * 64
            cells = _cells(hi, lo, len(sizes), size)
            alone = np.bincount(cells.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = ~alone[cells]
            hi, lo = hi[left], lo[left]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def numbers(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The number of each key; of a key that was not given, -1 or the number of another one."""
        found = np.full(len(hi), -1, np.int64)
        left, start = np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            cells = _cells(hi[left], lo[left], level, size) + np.uint64(start)
            at, bit = (cells >> np.uint64(6)).astype(np.int64), cells & np.uint64(63)
            word = self.words[at]
            there = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[there]] = (self.before[at] + below)[there]
            left, start = left[~there], start + size
        return found


def packed(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, last: np.ndarray) -> bytes:
    """The file of a shard: the perfect hash, and by number fingerprint, count and largest id."""
    hash_ = PerfectHash.of(hi, lo)
    order = np.argsort(hash_.numbers(hi, lo))
    out = io.BytesIO()
    counts = np.minimum(n, (1 << 32) - 1).astype(np.uint32)
    np.savez(out, sizes=hash_.sizes, words=hash_.words, marks=lo[order], counts=counts[order], last=last[order])
    return out.getvalue()


class Shard:
    """A shard read back; its members carry checksums."""

    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as parts:
            self.hash = PerfectHash(parts["sizes"], parts["words"])
            self.marks, self.counts, self.last = parts["marks"], parts["counts"], parts["last"]

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and largest id of each key; the count of a key that is not there is 0."""
        if not len(self.marks):
            return np.zeros(len(hi), np.int64), np.full(len(hi), NULL_ID)
        at = self.hash.numbers(hi, lo)
        there = (at >= 0) & (self.marks[at] == lo)
        return np.where(there, self.counts[at], 0), np.where(there, self.last[at], NULL_ID)


def keys_of(text: bytes | None, min_chars: int = MIN_CHARS) -> tuple[int, list[int], bytes]:
    """The number of lines, the places of those long enough, and their 16-byte digests."""
    lines = (text or b"").split(b"\n")
    places, digests = [], []
    for i, line in enumerate(lines):
        key = line.strip(WHITE).lower()  # of bytes: A-Z only
        if len(key) < min_chars or not (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            continue
        places.append(i)
        digests.append(blake2b(key, digest_size=16).digest())
    return len(lines), places, b"".join(digests)


def _halves(digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _texts(docs: DataFrame, id_column: str) -> DataFrame:
    ids = F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID))
    return docs.select(ids.alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(hi, lo, n, last): digests of the lines in ``min_docs`` documents or more, their number, the largest id.

    The first exchange is by line and id together, the second meets counts
    already added up in the tasks, so a line of very many documents is no
    group of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, digests = [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    found = keys_of(text.as_py(), min_chars)[2]
                    mine = {found[i : i + 16] for i in range(0, len(found), 16)}
                    digests.extend(mine)
                    ids.append(np.full(len(mine), doc, np.int64))
                hi, lo = _halves(b"".join(digests))
                columns = [hi.view(np.int64), lo.view(np.int64), np.concatenate(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hi", "lo", "doc_id"])

    held = _texts(docs, id_column).mapInArrow(run, "hi long, lo long, doc_id long").distinct()
    found = held.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    return found.where(F.col("n") >= min_docs)


def build_index(lines: DataFrame, folder: str) -> tuple[int, dict[int, int]]:
    """Write (hi, lo, n, last) as shards; the bits of a shard's number and the shards' sizes in bytes.

    A shard is one file of about SHARD_KEYS keys or fewer, those whose first
    bits are its number, so its size does not grow with the table.
    """
    lines = stage(lines, "repeated-lines")
    bits = max(0, (-(-lines.count() // SHARD_KEYS) - 1).bit_length())
    shard = F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0).cast("long")

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["shard"].iloc[0])
        hi, lo = rows["hi"].to_numpy().view(np.uint64), rows["lo"].to_numpy().view(np.uint64)
        data = packed(hi, lo, rows["n"].to_numpy(), rows["last"].to_numpy())
        put_file(f"{folder}/{number:08x}.npz", [data])
        return pd.DataFrame({"shard": [number], "size": [len(data)]})

    written = lines.withColumn("shard", shard).groupBy("shard").applyInPandas(write, "shard long, size long")
    return bits, {r["shard"]: r["size"] for r in written.collect()}  # one row a shard


class Index:
    """The shards as a task sees them: read when probed, the last few kept."""

    def __init__(self, folder: str, bits: int, shards: dict[int, int]):
        self.folder, self.bits, self.shards = folder, bits, shards
        self.held: OrderedDict[int, Shard] = OrderedDict()

    def shard(self, number: int) -> Shard:
        if number in self.held:
            self.held.move_to_end(number)
            return self.held[number]
        fs, path = open_folder(f"{self.folder}/{number:08x}.npz")
        with fs.open_input_file(path) as file:
            data = file.read()
        if len(data) != self.shards[number]:
            raise OSError(f"shard {number} has {len(data)} bytes, not {self.shards[number]}")
        if len(self.held) >= CACHED:
            self.held.popitem(last=False)
        self.held[number] = Shard(data)
        return self.held[number]

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and largest id of each key, shard after shard."""
        counts, last = np.zeros(len(hi), np.int64), np.full(len(hi), NULL_ID)
        shards = (hi >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hi), np.int64)
        order = np.argsort(shards, kind="stable")
        numbers, starts = np.unique(shards[order], return_index=True)
        for number, mine in zip(numbers.tolist(), np.split(order, starts[1:])):
            if number in self.shards:
                counts[mine], last[mine] = self.shard(number).probe(hi[mine], lo[mine])
        return counts, last


def _rounds(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[tuple[list, list, list]]:
    """Ids, texts and keys of as many rows as may probe together; a longer text is a round of its own."""
    ids, texts, keys = [], [], []
    size = lines = 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            data = text.as_py() or b""
            ids.append(doc)
            texts.append(data)
            keys.append(keys_of(data, min_chars))
            size, lines = size + len(data), lines + len(keys[-1][1])
            if size >= PROBE_BYTES or lines >= PROBE_LINES:
                yield ids, texts, keys
                ids, texts, keys, size, lines = [], [], [], 0, 0
    if ids:
        yield ids, texts, keys


def deduplicated(docs: DataFrame, id_column: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and ``kept``, the text without the dropped lines.

    A line's key is the line without white space at its ends, A-Z in lower
    case.  Lines whose key has ``min_chars`` code points or more and is held
    by ``min_docs`` documents or more go, in all documents but the one with
    the largest id that holds it, where all of them stay.

    The digests of all lines are counted by document; those that can go are
    written as shards, each a minimal perfect hash that leads to compact
    arrays of fingerprints, counts and largest ids.  Every task hashes its
    own lines once more and probes the shards in turn, so no line is joined or
    carried to another task.  A shard keeps the other half of the 128-bit
    digest as fingerprint, by which lines that are not in it are told apart.

    Null and empty texts have one empty line.  Rows of one id are one
    document for the count; each is returned, and all of them keep the lines if it
    is the largest.  Null ids are one document, smaller than all others.  An
    empty table gives no rows.  Other columns are not read.
    """
    folder = scratch_path(docs.sparkSession, "line-index")
    bits, shards = build_index(repeated_lines(docs, id_column, min_chars, min_docs), folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, bits, shards)
        for ids, texts, keys in _rounds(batches, min_chars):
            hi, lo = _halves(b"".join(k[2] for k in keys))
            counts, last = index.probe(hi, lo)
            owners = np.repeat(np.array(ids, np.int64), [len(k[1]) for k in keys])
            gone = (counts >= min_docs) & (last != owners)
            at, dropped = 0, []
            for i, (_, places, _) in enumerate(keys):
                mine = np.flatnonzero(gone[at : at + len(places)])
                at += len(places)
                dropped.append(len(mine))
                if len(mine):
                    lines = texts[i].split(b"\n")
                    out = {places[j] for j in mine.tolist()}
                    texts[i] = b"\n".join([x for j, x in enumerate(lines) if j not in out])
            for first in range(0, len(ids), 1024):
                some = slice(first, first + 1024)
                columns = [
                    pa.array([None if d == NULL_ID else d for d in ids[some]], pa.int64()),
                    pa.array([k[0] for k in keys[some]], pa.int64()),
                    pa.array(dropped[some], pa.int64()),
                    pa.array(texts[some], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept"])

    return _texts(docs, id_column).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept string")
