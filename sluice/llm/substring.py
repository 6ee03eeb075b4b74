"""Removal of word sequences that also start earlier in the corpus."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import slices, text_of
from sluice.session import stage

#: words of a window
WINDOW = 20
#: cells of the sketch for each window, its rows, most bits of its map, bits of a segment
CELLS, ROWS, MAX_BITS, SEGMENT = 4, 2, 1 << 30, 22
#: windows that a task counts, and windows that it compares with each other, before it hands them on
COUNTED, CHUNK = 1_500_000, 700_000
NULL_ID = -(1 << 63)
#: fixed values: multipliers that mix the bits of a number
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def window_hashes(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The halves of a 128-bit hash of every run of ``window`` words joined by one blank.

    Each run is hashed as a whole: hashes that are rolled along modulo a
    power of two are equal for some texts whatever their base.
    """
    from xxhash import xxh3_128_digest

    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    data = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1))
    found = [xxh3_128_digest(data[a:b]) for a, b in zip(starts.tolist(), ends[window - 1 :].tolist())]
    halves = np.frombuffer(b"".join(found), dtype="<u8").reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def _rows_of(h: np.ndarray, g: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each window in each row of the sketch."""
    return [((h + np.uint64(r) * (g | np.uint64(1))) >> np.uint64(64 - bits)).astype(np.int64) for r in range(ROWS)]


def packed(cells: np.ndarray) -> bytes:
    """Rising numbers as the bytes of their gaps; 255 stands for 255 passed over."""
    gaps = np.diff(cells, prepend=-1) - 1
    jumps = gaps // 255
    out = np.full(len(cells) + int(jumps.sum()), 255, dtype=np.uint8)
    out[np.cumsum(jumps + 1) - 1] = gaps % 255
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, dtype=np.uint8)
    return np.cumsum(np.where(gaps == 255, 255, gaps.astype(np.int64) + 1))[gaps != 255] - 1


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    """(doc_id, crc, hashes) of every text that has a window."""
    for batch in slices(batches, "text", 1 << 20):
        for doc, crc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "crc", "text"))):
            h, g = window_hashes(text.encode().split(), window)
            if len(h):
                yield doc, crc, h, g


def repeat_map(slim: DataFrame, window: int = WINDOW, cells: int = CELLS, max_bits: int = MAX_BITS) -> tuple[list[list[bytes]], int]:
    """A bit for every cell of the merged count-min sketch that was hit twice or more, compressed.

    Tasks fill sketches of their windows and hand them on in segments, as gaps
    between the cells that were hit once and more often; a task for each
    segment adds them up.  Its size follows the bytes of the texts up to
    ``max_bits``: beyond that more windows are taken for repeated and are
    grouped exactly, and none is lost.
    """
    octets = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(16, min(int(octets // 6 * cells // ROWS).bit_length(), max_bits.bit_length() - 1 - (ROWS - 1).bit_length()))
    low = min(SEGMENT, bits)
    n_segments = 1 << (bits - low)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def hand_on() -> pa.RecordBatch:
            h, g = (np.concatenate(x) for x in zip(*held))
            held.clear()
            rows = []
            for r, at in enumerate(_rows_of(h, g, bits)):
                at, times = np.unique(at, return_counts=True)
                cuts = np.searchsorted(at, np.arange(n_segments + 1) << low)
                for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        part, often = at[a:b] - (s << low), times[a:b] > 1
                        rows.append((r * n_segments + s, packed(part[~often]), packed(part[often])))
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["segment", "once", "often"])

        for _, _, h, g in _windows(batches, window):
            held.append((h, g))
            n += len(h)
            if n >= COUNTED:
                yield hand_on()
                held, n = [], 0
        if held:
            yield hand_on()
        _give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by segment, so one segment's counts are held at a time."""
        now, counts = None, np.zeros(1 << low, dtype=np.uint8)

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(np.packbits(counts > 1, bitorder="little").tobytes(), 1)], pa.binary())], ["segment", "map"])

        for batch in batches:
            for segment, once, often in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "often"))):
                if segment != now:
                    if now is not None:
                        yield close()
                    now = segment
                    counts[:] = 0
                cells = unpacked(once)
                counts[cells] = np.minimum(counts[cells] + 1, 2)
                counts[unpacked(often)] = 2
        if now is not None:
            yield close()

    sketches = slim.select("doc_id", "crc", "text").mapInArrow(fill, "segment int, once binary, often binary")
    by = sketches.repartition(min(ROWS * n_segments, 4 * slim.sparkSession.sparkContext.defaultParallelism), "segment").sortWithinPartitions("segment")
    empty = zlib.compress(bytes((1 << low) // 8), 1)
    maps = [empty] * (ROWS * n_segments)
    for row in by.mapInArrow(add, "segment int, map binary").toLocalIterator():  # max_bits in all
        maps[row["segment"]] = bytes(row["map"])
    return [maps[r * n_segments : (r + 1) * n_segments] for r in range(ROWS)], bits


def _give_back() -> None:
    """Python workers wait for further tasks: what one freed goes back to the system."""
    pa.default_memory_pool().release_unused()


_opened: list = [None, []]


def _open(shared) -> list[np.ndarray]:
    """The map of a broadcast, opened once in a process; only the last one is held."""
    if _opened[0] != shared.value[1]:
        _opened[:] = [None, []]
        maps = [np.frombuffer(b"".join(map(zlib.decompress, row)), dtype=np.uint8) for row in shared.value[0]]
        _opened[:] = [shared.value[1], maps]
    return _opened[1]


def _estimated(maps: list[np.ndarray], h: np.ndarray, g: np.ndarray, bits: int) -> np.ndarray:
    often = np.ones(len(h), dtype=bool)
    for bit_map, at in zip(maps, _rows_of(h, g, bits)):
        often &= (bit_map[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return often


_FOUND = "h long, g int, doc_id long, at long, runs binary"


def _candidates(slim: DataFrame, maps: list[list[bytes]], bits: int, window: int) -> DataFrame:
    """Windows estimated repeated: the first of each kind in a task, and the places of the others.

    ``at`` is the start times 2**32 plus ``crc``, which tells rows of one id
    with different texts apart and is zero elsewhere.  A window met again within a task needs no comparison: such
    starts are given as ``runs`` of a document, pairs of first and end, under
    a key of their own.  So no kind has more rows than there are chunks of
    windows, however often it occurs.
    """
    shared = slim.sparkSession.sparkContext.broadcast((maps, uuid4().hex))

    def batches_of(h: np.ndarray, g: np.ndarray, doc: np.ndarray, at: np.ndarray, runs: list[bytes] | None) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(h), 50_000):
            p = slice(a, a + 50_000)
            blobs = pa.nulls(len(h[p]), pa.binary()) if runs is None else pa.array(runs[p], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[p].view(np.int64)), pa.array(g[p].astype(np.int32)), pa.array(doc[p]), pa.array(at[p]), blobs],
                ["h", "g", "doc_id", "at", "runs"],
            )

    def runs_of(doc: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Starts of each document and text as runs of following numbers."""
        crc, start = at & 0xFFFFFFFF, at >> 32
        order = np.lexsort((start, crc, doc))
        doc, crc, start = doc[order], crc[order], start[order]
        other = (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1])
        heads = np.flatnonzero(np.concatenate([[True], other | (start[1:] != start[:-1] + 1)]))
        ends = np.append(heads[1:], len(start))
        pairs = np.stack([start[heads], start[ends - 1] + 1], axis=1).astype("<i4")
        texts = np.flatnonzero(np.concatenate([[True], other]))
        cuts = np.append(np.searchsorted(heads, texts), len(heads)).tolist()
        blobs = [pairs[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        d, c = doc[texts], crc[texts]
        key = _mixed(d.view(np.uint64) ^ c.astype(np.uint64))
        return batches_of(key, np.full(len(d), -1), d, c, blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = _open(shared)
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            h, g, doc, at = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((at, doc, g, h))
            h, g, doc, at = h[order], g[order], doc[order], at[order]
            again = np.zeros(len(h), dtype=bool)
            again[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
            # rows alike in id and text have the same places: one of them is enough
            same = np.zeros(len(h), dtype=bool)
            same[1:] = again[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
            lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(h))))
            later = again & ((doc != doc[lead]) | (at != at[lead]))
            first = ~again
            yield from batches_of(h[first], g[first], doc[first], at[first], None)
            later &= ~same
            if later.any():
                yield from runs_of(doc[later], at[later])

        for doc, crc, h, g in _windows(batches, window):
            place = np.flatnonzero(_estimated(local, h, g, bits))
            if len(place):
                held.append((h[place], (g[place] >> np.uint64(33)).astype(np.int64), np.full(len(place), doc), (place << 32) | crc))
                n += len(place)
            if n >= CHUNK:
                yield from hand_on()
                held, n = [], 0
        if held:
            yield from hand_on()
        _give_back()

    return slim.select("doc_id", "crc", "text").mapInArrow(run, _FOUND)


def repeated_starts(slim: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, crc, starts, runs): starts of the windows that also start earlier, one by one and in runs."""
    maps, bits = repeat_map(slim, window)
    found = _candidates(slim, maps, bits, window)
    place = F.struct("doc_id", "at")
    kinds = Window.partitionBy("h", "g")
    later = found.withColumn("first", F.min(place).over(kinds)).where(F.col("runs").isNotNull() | (F.col("first") != place))
    starts = later.select(
        "doc_id",
        F.expr("at & 4294967295").alias("crc"),
        F.when(F.col("runs").isNull(), F.expr("cast(shiftright(at, 32) as int)")).alias("start"),
        "runs",
    )
    # a document's starts: no more than its words
    return starts.groupBy("doc_id", "crc").agg(F.collect_list("start").alias("starts"), F.collect_list("runs").alias("runs"))


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        packed = [zlib.compress(t.encode(), 4) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("crc"), pa.array(packed, pa.binary())], ["doc_id", "crc", "packed"])


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text of every row.

    A word goes if a window of ``window`` words that covers it has the word
    sequence of a window that starts earlier: in a smaller doc_id, or in the
    same one at an earlier word.  A null id comes before all others.  Rows
    that are alike in id and text are one document and get the same result;
    rows of one id with different texts are told apart and ordered by start,
    then by the crc of the text.  Windows are compared by 95 bits of hash.
    Null texts have no words.
    """
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_of().alias("text"))
    crc = F.crc32(F.encode("text", "UTF-8"))
    # ids that have rows with different texts: none in a sound corpus
    twins = slim.select("doc_id", crc.alias("c")).groupBy("doc_id").agg(F.min("c").alias("a"), F.max("c").alias("b"))
    twins = stage(twins.where("a <> b").select(F.col("doc_id").alias("_twin")), "twins")
    slim = slim.join(twins, F.col("doc_id") == F.col("_twin"), "left").select(
        "doc_id", F.when(F.col("_twin").isNotNull(), crc).otherwise(0).alias("crc"), "text"
    )
    starts = repeated_starts(slim, window).withColumnRenamed("doc_id", "_id")
    # texts cross the shuffle compressed
    whole = slim.mapInArrow(_pressed, "doc_id long, crc long, packed binary")
    joined = whole.join(starts, (F.col("doc_id") == F.col("_id")) & (whole["crc"] == starts["crc"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed", 1 << 21):
            kept, n_words, n_removed = [], [], []
            columns = (batch.column("packed").to_pylist(), batch.column("starts"), batch.column("runs"))
            for text, at, runs in zip(*columns):
                words = zlib.decompress(text).split()
                n = len(words)
                gone = 0
                if at.is_valid:
                    edges = np.zeros(n + 1, dtype=np.int64)
                    places = at.values.to_numpy()
                    np.add.at(edges, places, 1)
                    np.add.at(edges, places + window, -1)
                    for pairs in runs.as_py():
                        found = np.frombuffer(pairs, dtype="<i4").reshape(-1, 2)
                        np.add.at(edges, found[:, 0], 1)
                        np.add.at(edges, found[:, 1] - 1 + window, -1)
                    stay = np.cumsum(edges[:-1]) == 0
                    gone = n - int(stay.sum())
                    words = [words[i] for i in np.flatnonzero(stay)]
                kept.append(b" ".join(words).decode())
                n_words.append(n)
                n_removed.append(gone)
            ids = batch.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=ids == NULL_ID), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return joined.select("doc_id", "packed", "starts", "runs").mapInArrow(run, schema)
