"""Token ids in files: interleaved range asymmetric numeral coding with shared frequencies.

A file holds independent blocks one after the other.  Every number is little
endian.  A block: the header HEADER, then the places of its checkpoints, the
lane states at each of them, the ids of its documents and their token counts,
and the coded words.  Blocks end at document ends.  Frequencies of all ids are
counted over the whole corpus, scaled to 2**PRECISION and kept in a table
beside the files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import open_folder, put_file, slices, text_of
from sluice.llm.tokens import default_tokenizer, encoder
from sluice.session import scratch_path, stage

#: tokens after which a block ends at the next document end; lanes; steps between checkpoints
BLOCK, LANES, EVERY = 1 << 18, 512, 256
#: bytes after which a writer begins its next file
FILE_BYTES = 1 << 26
PRECISION, END_ID = 20, 0
#: fixed values: lower bound of a lane's state, bits of a word
LOW, WORD = 1 << 31, 32
MAGIC = b"RANSIDS1"
HEADER = struct.Struct("<8sIIIIIIII")  # magic, tokens, documents, lanes, every, checkpoints, words, crc of body, crc of ids


def scaled(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Frequencies that sum to 2**precision; ids that occur get at least 1."""
    total = int(counts.sum())
    size = 1 << precision
    freq = np.zeros(len(counts), dtype=np.int64)
    if total == 0:
        return freq
    there = counts > 0
    if there.sum() > size:
        raise ValueError("more ids than the precision can tell apart")
    freq[there] = np.maximum(1, (counts[there].astype(np.float64) * size / total).astype(np.int64))
    over = int(freq.sum()) - size
    order = np.argsort(-freq, kind="stable")
    while over > 0:  # taken from the most frequent, in proportion
        for s in order:
            take = min(over, int(freq[s]) // 8 if freq[s] > 8 else int(freq[s]) - 1)
            freq[s] -= take
            over -= take
            if over <= 0 or freq[s] <= 1:
                break
    freq[order[0]] -= over
    return freq


class Coder:
    """Encodes and decodes blocks of ids with one frequency table."""

    def __init__(self, freq: np.ndarray, precision: int = PRECISION):
        self.precision = np.uint64(precision)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.mask = np.uint64((1 << precision) - 1)
        self._symbol: np.ndarray | None = None

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = EVERY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, places, states): states[k] are the lanes' at step k * every, places[k] its first word."""
        f, c = self.freq[ids], self.start[ids]
        limit = f << np.uint64(LOW.bit_length() - 1 + WORD - int(self.precision))
        word, p, low = np.uint64(WORD), self.precision, np.uint64(0xFFFFFFFF)
        x = np.full(lanes, LOW, dtype=np.uint64)
        steps = -(-len(ids) // lanes)
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
        states: list[np.ndarray] = []
        for t in range(steps - 1, -1, -1):
            a, b = t * lanes, min((t + 1) * lanes, len(ids))
            y, ft = x[: b - a], f[a:b]
            full = y >= limit[a:b]
            out[t] = (y[full] & low).astype(np.uint32)
            y = np.where(full, y >> word, y)
            q = y // ft
            x[: b - a] = (q << p) + (y - q * ft) + c[a:b]
            if t % every == 0:
                states.append(x.copy())
        places = np.concatenate([[0], np.cumsum([len(w) for w in out])])[:steps:every].astype(np.uint32)
        words = np.concatenate(out) if out else np.empty(0, np.uint32)
        return words, places, np.array(states[::-1], dtype=np.uint64).reshape(-1, lanes)

    def decode(self, words: np.ndarray, state: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from a checkpoint on; ``words`` begin at its place."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        symbol, freq, start, mask, p = self._symbol, self.freq, self.start, self.mask, self.precision
        word, low = np.uint64(WORD), np.uint64(LOW)
        x, lanes, at = state.copy(), len(state), 0
        ids = np.empty(n, dtype=np.uint32)
        for a in range(0, n, lanes):
            b = min(a + lanes, n)
            y = x[: b - a]
            slot = y & mask
            s = symbol[slot]
            ids[a:b] = s
            y = freq[s] * (y >> p) + slot - start[s]
            short = np.flatnonzero(y < low)
            y[short] = (y[short] << word) | words[at : at + len(short)]
            at += len(short)
            x[: b - a] = y
        return ids

    def write(self, ids: np.ndarray, docs: np.ndarray, counts: np.ndarray, lanes: int = LANES, every: int = EVERY) -> bytes:
        """A block: ``docs`` are the document ids, ``counts`` their tokens, in order."""
        words, places, states = self.encode(ids, lanes, every)
        body = b"".join(x.tobytes() for x in (places.astype("<u4"), states.astype("<u8"), docs.astype("<i8"), counts.astype("<u4"), words.astype("<u4")))
        return HEADER.pack(MAGIC, len(ids), len(docs), lanes, every, len(places), len(words), zlib.crc32(body), zlib.crc32(ids.astype("<u4").tobytes())) + body

    def read(self, block: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents, token counts, ids); with ``first`` and ``last`` only the ids of that range.

        A range is decoded from the checkpoint before it.  Checksums of the
        body, and of all ids when all are read, are compared.
        """
        magic, n, n_docs, lanes, every, n_places, n_words, crc, ids_crc = HEADER.unpack_from(block)
        body = memoryview(block)[HEADER.size :]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        at = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(body, dtype=kind, count=count, offset=at)
            at += got.nbytes
            return got

        places, states = take("<u4", n_places), take("<u8", n_places * lanes).reshape(-1, lanes)
        docs, counts, words = take("<i8", n_docs), take("<u4", n_docs), take("<u4", n_words)
        last = n if last is None else min(last, n)
        if first >= last:
            return docs, counts, np.empty(0, np.uint32)
        k = first // (lanes * every)
        begin = k * lanes * every
        ids = self.decode(words[places[k] :], states[k], last - begin)[first - begin :]
        if first == 0 and last == n and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("wrong ids")
        return docs, counts, ids


NULL_ID = -(1 << 63)
_BLOCKS = "shard int, block int, docs binary, counts binary, ids binary"


def _id_blocks(docs: DataFrame, tokenizer: str, block: int, end_id: int, added_tokens: bool) -> DataFrame:
    """Runs of documents in ascending id order with their ids, 16 bits each where they fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = encoder(tokenizer, added_tokens).runs
        kind = id_kind(tokenizer)
        shard, number = TaskContext.get().partitionId(), 0
        names, sizes, parts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = [[shard], [number], [b"".join(names)], [b"".join(sizes)], [b"".join(parts)]]
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["shard", "block", "docs", "counts", "ids"])

        for batch in slices(batches, "text"):
            ids, counts = runs(batch.column("text"), end_id)
            ids, docs = ids.astype(kind), batch.column("doc_id").to_numpy().astype("<i8")
            ends = np.cumsum(counts)
            first = done = 0
            while first < len(docs):
                last = min(int(np.searchsorted(ends, done + block - held)) + 1, len(docs))
                end = int(ends[last - 1])
                names.append(docs[first:last].tobytes())
                sizes.append(counts[first:last].astype("<u4").tobytes())
                parts.append(ids[done:end].tobytes())
                held += end - done
                first, done = last, end
                if held >= block:
                    yield flush()
                    names, sizes, parts, held, number = [], [], [], 0, number + 1
        if names:
            yield flush()

    text = text_of()
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text.alias("text"))
    # the random number parts rows that share an id
    ranged = slim.withColumn("deal", F.rand(7)).repartitionByRange("doc_id", "deal").sortWithinPartitions("doc_id", "deal")
    return ranged.select("doc_id", "text").mapInArrow(run, _BLOCKS)


def id_kind(tokenizer: str) -> str:
    """The numpy type that holds all ids of a vocabulary."""
    return "<u2" if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, block: int = BLOCK, end_id: int = END_ID, added_tokens: bool = False) -> DataFrame:
    """Encode the texts into files below ``folder`` and return the table of their blocks.

    The blocks' table (shard, block, path, place, size, n_docs, n_tokens) and
    the frequencies are kept as tables in the folder too.  Ascending
    (shard, block) is ascending doc_id.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    kind = id_kind(path)
    n_ids = max(encoder(path).tokenizer.get_vocab_size(), end_id + 1)
    blocks = stage(_id_blocks(docs, path, block, end_id, added_tokens), "id-blocks")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, dtype=np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), dtype=kind), minlength=n_ids)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["id", "n"])

    counted = blocks.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counted.collect()  # one row for each id of the vocabulary at most
    counts = np.zeros(max([r["id"] for r in found], default=0) + 1, dtype=np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    freq = scaled(counts)
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, freq int").coalesce(1).write.parquet(f"{folder}/frequencies")
    shared = spark.sparkContext.broadcast(freq)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        data: list[bytes] = []
        rows: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            # a task that is run again meets the same blocks and replaces its files
            name = f"{folder}/ids/{rows[0][0]:06d}-{rows[0][1]:08d}.rans"
            put_file(name, data)
            columns = list(zip(*[(shard, number, name, *rest) for shard, number, *rest in rows]))
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["shard", "block", "path", "place", "size", "n_docs", "n_tokens"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                follows = rows and (rows[-1][0], rows[-1][1] + 1) == (row["shard"], row["block"])
                if rows and (size >= FILE_BYTES or not follows):
                    yield close()
                    data, rows, size = [], [], 0
                docs, sizes = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["counts"], "<u4")
                ids = np.frombuffer(row["ids"], kind).astype(np.uint32)
                data.append(coder.write(ids, docs, sizes))
                rows.append((row["shard"], row["block"], size, len(data[-1]), len(docs), len(ids)))
                size += len(data[-1])
        if rows:
            yield close()

    table = blocks.mapInArrow(write, "shard int, block int, path string, place long, size long, n_docs long, n_tokens long")
    table.write.parquet(f"{folder}/blocks")
    return spark.read.parquet(f"{folder}/blocks")


def read_ids(spark, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""
    freq_rows = spark.read.parquet(f"{folder}/frequencies").collect()  # one row for each id of the vocabulary at most
    freq = np.zeros(max([r["id"] for r in freq_rows], default=0) + 1, dtype=np.int64)
    for r in freq_rows:
        freq[r["id"]] = r["freq"]
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{folder}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row for each partition of the writer
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = stage(shards.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start")), "shards")
    inside = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.select("shard", "block", "path", "place", "size", F.coalesce(inside, F.lit(0)).alias("inside")).join(shards, "shard")
    placed = placed.select("path", "place", "size", (F.col("inside") + F.col("shard_start")).alias("start"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_folder(row["path"])
                with fs.open_input_file(path) as file:
                    data = file.read_at(row["size"], row["place"])
                docs, sizes, ids = coder.read(data)
                ends = np.cumsum(sizes, dtype=np.int64)
                starts = ends - sizes
                data = ids.astype("<u4").tobytes()
                parts = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                names = pa.array(docs, mask=docs == NULL_ID)
                columns = [names, pa.array(starts + row["start"]), pa.array(sizes.astype(np.int64)), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.replace(" long", "").replace(" binary", "").split(", "))

    # blocks are dealt out anew, as the table of a small writer is one split
    spread = placed.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path")
    return spread.mapInArrow(read, schema)


def round_trip(docs: DataFrame, tokenizer: str | None = None, added_tokens: bool = False) -> DataFrame:
    """Write and read back: doc_id, start, n_tokens, ids_crc32 of every row.

    A null text is empty: its only id is the end id.  Rows of one id follow
    each other in any order; null ids come first and stay null.
    """
    folder = scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, folder, tokenizer, added_tokens=added_tokens)
    return read_ids(docs.sparkSession, folder)
