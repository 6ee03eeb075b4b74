"""Best-fit packing of documents into token sequences by a grouping genetic algorithm."""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices, text_of
from sluice.llm.tokens import default_tokenizer, encoder
from sluice.session import stage

#: production parameters: tokens of a sequence, the id that ends a document
CAPACITY, END_ID = 1024, 2
#: documents of a block, islands of a block, solutions of an island, generations of an epoch
BLOCK, ISLANDS, POPULATION, GENERATIONS, EPOCHS = 4096, 2, 4, 6, 2
#: bins filled less than this after the first packing are opened again
LOOSE = 0.98
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal double, ids binary"


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, bytes]]:
    """(start, ids) of the pieces: all are full but the first, which has the rest."""
    n = len(ids) // 4
    first = (n - 1) % capacity + 1
    bounds = [0, *range(first, n + 1, capacity)]
    return [(a, ids[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Token pieces of every row, each with a random number that deals it into a block."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = encoder(path, added_tokens).runs
        deal = random.Random(TaskContext.get().partitionId()).random
        for batch in slices(batches, "text"):
            rows = []
            ids, sizes = runs(batch.column("text"), end_id)
            data, ends = ids.tobytes(), (np.cumsum(sizes) * 4).tolist()
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), [0, *ends], ends):
                for k, (start, part) in enumerate(cut(data[a:b], capacity)):
                    rows.append((doc, k, start, len(part) // 4, zlib.crc32(part), deal(), part if with_ids else None))
            columns = list(zip(*rows))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "deal", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return slim.mapInArrow(run, PIECES)


class Bins:
    """Open bins by free space; the best fit is found from a bit set of the spaces that occur."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0
        self.worth: tuple[int, float] | None = None

    def _file(self, b: int) -> None:
        space = self.free[b]
        self.by_space[space].append(b)
        self.spaces |= 1 << space

    def add_bin(self, items: list[int], free: int) -> None:
        self.items.append(items)
        self.free.append(free)
        self._file(len(self.items) - 1)

    def best_fit(self, item: int, length: int) -> None:
        fits = self.spaces >> length
        if not fits:
            self.add_bin([item], self.capacity - length)
            return
        space = length + (fits & -fits).bit_length() - 1
        b = self.by_space[space].pop()
        if not self.by_space[space]:
            self.spaces &= ~(1 << space)
        self.items[b].append(item)
        self.free[b] = space - length
        self._file(b)


def fitness(bins: Bins) -> tuple[int, float]:
    """Fewer bins first; of equally many, those with their free space in few bins."""
    if bins.worth is None:
        full = bins.capacity
        bins.worth = (-len(bins.items), sum([((full - f) / full) ** 2 for f in bins.free]))
    return bins.worth


def crossover(one: Bins, other: Bins, lengths: Sequence[int], rng: random.Random) -> Bins:
    """``one`` with whole well-filled bins of ``other`` injected.

    Bins of ``one`` that share a document with an injected bin are dissolved;
    their other documents are placed again, longest first, where they fit best.
    """
    order = sorted(range(len(other.items)), key=other.free.__getitem__)
    chosen = [b for b in order[: max(1, len(order) * 2 // 3)] if rng.random() < 0.4] or order[:1]
    taken = {i for b in chosen for i in other.items[b]}
    child = Bins(one.capacity)
    for b in chosen:
        child.add_bin(list(other.items[b]), other.free[b])
    homeless: list[int] = []
    for items, free in zip(one.items, one.free):
        if taken.isdisjoint(items):
            child.add_bin(list(items), free)
        else:
            homeless.extend(i for i in items if i not in taken)
    for i in sorted(homeless):  # lengths fall
        child.best_fit(i, lengths[i])
    return child


def mutate(bins: Bins, lengths: Sequence[int], rng: random.Random) -> Bins:
    """The emptiest bins and a few others are dissolved and their documents placed again."""
    order = sorted(range(len(bins.items)), key=bins.free.__getitem__)
    gone = set(order[-2:]) | {b for b in order if rng.random() < 0.05}
    child = Bins(bins.capacity)
    homeless: list[int] = []
    for b, (items, free) in enumerate(zip(bins.items, bins.free)):
        if b in gone:
            homeless.extend(items)
        else:
            child.add_bin(list(items), free)
    for i in sorted(homeless):  # lengths fall
        child.best_fit(i, lengths[i])
    return child


def evolve(lengths: Sequence[int], capacity: int, seed: int, elites: Sequence[Sequence[int]] = (), generations: int = GENERATIONS, population: int = POPULATION) -> list[int]:
    """The bin of each document in the best solution found; ``lengths`` fall.

    Begins with best fit on falling lengths, the ``elites`` of other islands
    and disturbed orders.  Ends early at the least number of bins that any
    packing could have.
    """
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)

    def placed(order: Sequence[int]) -> Bins:
        bins = Bins(capacity)
        for i in order:
            bins.best_fit(i, lengths[i])
        return bins

    def restored(bin_of: Sequence[int]) -> Bins:
        bins, members = Bins(capacity), {}
        for i, b in enumerate(bin_of):
            members.setdefault(b, []).append(i)
        for items in members.values():
            bins.add_bin(items, capacity - sum(lengths[i] for i in items))
        return bins

    pool = [restored(e) for e in elites] or [placed(range(len(lengths)))]
    best = max(pool, key=fitness)
    if len(best.items) > least:
        while len(pool) < population:
            noisy = sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + 0.2 * rng.random()))
            pool.append(placed(noisy))
        for _ in range(generations):
            pool.sort(key=fitness, reverse=True)
            best = pool[0]
            if len(best.items) <= least:
                break
            half = max(2, population // 2)
            children = [mutate(crossover(*rng.sample(pool[:half], 2), lengths, rng), lengths, rng) for _ in range(population - 1)]
            pool = [best, *children]
        best = max(pool, key=fitness)
    bin_of = [0] * len(lengths)
    for b, items in enumerate(best.items):
        for i in items:
            bin_of[i] = b
    return bin_of


ORDER = ["length", "doc_id", "piece", "start", "deal"]


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(ORDER, ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)


def _epoch(islands: DataFrame, elites: DataFrame | None, epoch: int, capacity: int) -> DataFrame:
    """One row per block and island: its best solution after an epoch."""
    schema = "block long, island int, n_bins int, filled double, bins binary"

    def run(key: tuple, pdf: pd.DataFrame, found: pd.DataFrame | None = None) -> pd.DataFrame:
        lengths = _ordered(pdf)["length"].tolist()
        given = [np.frombuffer(b, dtype="<i4").tolist() for b in ([] if found is None else found["bins"])]
        bin_of = np.array(evolve(lengths, capacity, hash((*map(int, key), epoch)), given), dtype="<i4")
        load = np.bincount(bin_of, weights=lengths) / capacity
        return pd.DataFrame([{"block": key[0], "island": key[1], "n_bins": len(load), "filled": float((load**2).sum()), "bins": bin_of.tobytes()}])

    by = islands.groupBy("block", "island")
    if elites is None:
        return by.applyInPandas(lambda key, pdf: run(key, pdf), schema)
    return by.cogroup(elites.groupBy("block", "island")).applyInPandas(run, schema)


def place(found: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Adds sequence_id and offset to rows with ORDER's columns: few sequences, none above capacity.

    Rows are dealt at random into blocks of about ``block``, so that no group
    grows with the data or with one document id.  Each block is packed by several
    islands; after an epoch each island's best solution moves to the next one
    as well.  Each block leaves its last bins part empty; bins under LOOSE are
    opened again and packed once more together.
    """
    def packed(rows: DataFrame, n_rows: int, name: str, base: int) -> DataFrame:
        n_blocks = max(1, -(-n_rows // block))
        # the deal is spread over [0, 1): its product with the number of blocks names one
        dealt = rows.withColumn("block", F.floor(F.col("deal") * n_blocks).cast("long") + F.lit(base))
        copies = dealt.select("block", *ORDER).withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
        elites = None
        for epoch in range(epochs):
            done = stage(_epoch(copies, elites, epoch, capacity), f"{name}-epoch")
            moved = done.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
            elites = done.unionByName(moved) if islands > 1 else done
        better = F.struct("n_bins", -F.col("filled"), "island")
        best = done.groupBy("block").agg(F.min_by("bins", better).alias("bins"))

        def lay(key: tuple, pdf: pd.DataFrame, winner: pd.DataFrame) -> pd.DataFrame:
            pdf = _ordered(pdf)
            pdf["bin"] = np.frombuffer(winner["bins"].iloc[0], dtype="<i4")
            ends = pdf.groupby("bin")["length"].cumsum()
            pdf["offset"] = ends - pdf["length"]
            pdf["fill"] = pdf.groupby("bin")["length"].transform("sum")
            # bins are 32 bits wide, the product is not
            pdf["sequence_id"] = (key[0] << 24) + pdf["bin"].astype("int64")
            return pdf.drop(columns=["bin"])

        kept = [f"{c} {t}" for c, t in dealt.dtypes]
        schema = ", ".join([*kept, "offset long", "fill long", "sequence_id long"])
        laid = dealt.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(lay, schema)
        return stage(laid.drop("block"), name)

    # a full piece is a sequence of its own
    whole = found.where(F.col("length") >= capacity).withColumns(
        {"offset": F.lit(0).cast("long"), "sequence_id": -1 - F.monotonically_increasing_id()}
    )
    found = found.where(F.col("length") < capacity)
    n = found.count()
    first = packed(found, n, "placed", 0)
    if n <= block:
        return first.drop("fill").unionByName(whole)
    loose = first.where(F.col("fill") < int(LOOSE * capacity))
    again = loose.select(*found.columns)
    second = packed(again, loose.count(), "placed-again", -(-n // block) + 1)
    return first.where(F.col("fill") >= int(LOOSE * capacity)).unionByName(second).drop("fill").unionByName(whole)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, added_tokens: bool = False) -> DataFrame:
    """One row per piece of every document: its place in a sequence of at most ``capacity`` tokens.

    A null text is empty: its only token is the end id.  Rows of one id are
    packed one by one; a null id stays null.  Columns: doc_id, piece, start,
    length, ids_crc32, sequence_id, offset.  An empty table gives no rows.
    """
    cuts = stage(pieces(docs, tokenizer, capacity, end_id, added_tokens=added_tokens).drop("ids"), "pieces")
    return place(cuts, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, added_tokens: bool = False) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), and the document of each run."""
    cuts = stage(pieces(docs, tokenizer, capacity, end_id, with_ids=True, added_tokens=added_tokens), "pieces")
    placed = place(cuts, capacity)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["ids"] = [np.frombuffer(b"".join(x), dtype="<u4").astype("i4") for x in pdf["ids"]]
            yield pdf

    run = F.struct("offset", "doc_id", "piece", "length", "ids")
    grouped = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    flat = grouped.select(
        "sequence_id",
        F.col("runs.ids").alias("ids"),
        F.transform("runs", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["offset"].alias("offset"), r["length"].alias("length"))).alias("parts"),
    )
    schema = "sequence_id long, ids array<int>, parts array<struct<doc_id:long,offset:long,length:long>>"
    return flat.mapInPandas(join, schema)
