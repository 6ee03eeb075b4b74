"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph; the graph is cut into
parts of like size with few edges between them; a small classifier learns from
a vector the parts of its neighbours.  It then assigns every vector to a part
and routes each query to its most probable parts, which are searched exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import stage

#: vectors that the graph and the classifier are fitted on, at most; its neighbours
SAMPLE, GRAPH_K = 8192, 10
#: rows of a part, most parts, share of the held-out neighbours that the searched parts must hold
PART_ROWS, MAX_PARTS, TARGET = 1000, 128, 0.96
#: rows of a part that are searched by one task; larger parts are split
BLOCK_ROWS = 1024
HIDDEN, ROUNDS, BATCH, SEED = 128, 30, 256, 11


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows of each row, by blocks of exact distances."""
    n = len(x)
    k = min(k, n - 1)
    squares = (x * x).sum(1)
    found = np.empty((n, k), dtype=np.int64)
    for a in range(0, n, 512):
        d = squares[None, :] - 2 * (x[a : a + 512] @ x.T)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        found[a : a + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, sweeps: int = 12) -> np.ndarray:
    """A part for each node of the graph, none above ``slack`` times the mean size.

    Begins with halves along main directions, then moves nodes to the part
    that holds most of their neighbours while sizes allow it.
    """
    part = np.zeros(len(x), dtype=np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, count = todo.pop()
        if count <= 1:
            part[rows] = first
            continue
        y = x[rows] - x[rows].mean(0)
        direction = np.linalg.eigh(y.T @ y)[1][:, -1]
        order = rows[np.argsort(y @ direction, kind="stable")]
        left = count // 2
        cut = len(order) * left // count
        todo += [(order[:cut], first, left), (order[cut:], first + left, count - left)]
    linked: list[list[int]] = [[] for _ in range(len(x))]
    for i, row in enumerate(graph.tolist()):
        linked[i].extend(row)
        for j in row:
            linked[j].append(i)
    size = np.bincount(part, minlength=parts).tolist()
    most, least = math.ceil(slack * len(x) / parts), math.floor(len(x) / parts / slack)
    now = part.tolist()
    rng = np.random.default_rng(SEED)
    for _ in range(sweeps):
        moved = 0
        for i in rng.permutation(len(x)).tolist():
            votes: dict[int, int] = {}
            for j in linked[i]:
                votes[now[j]] = votes.get(now[j], 0) + 1
            best = max(votes, key=lambda p: (votes[p], -p))
            own = now[i]
            if votes[best] > votes.get(own, 0) and size[best] < most and size[own] > least:
                now[i] = best
                size[best] += 1
                size[own] -= 1
                moved += 1
        if moved < len(x) // 500:
            break
    return np.array(now)


class Router:
    """A classifier with one hidden layer: probabilities of the parts for a vector."""

    def __init__(self, x: np.ndarray, targets: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(0), x.std() or 1.0
        y, n_parts = (x - self.mean) / self.scale, targets.shape[1]
        d = x.shape[1]
        w = [
            rng.normal(0, math.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, math.sqrt(2 / HIDDEN), (HIDDEN, n_parts)), np.zeros(n_parts),
        ]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(ROUNDS):
            order = rng.permutation(len(y))
            for a in range(0, len(y), BATCH):
                rows = order[a : a + BATCH]
                inner = np.maximum(y[rows] @ w[0] + w[1], 0)
                miss = (self._soft(inner @ w[2] + w[3]) - targets[rows]) / len(rows)
                back = (miss @ w[2].T) * (inner > 0)
                slopes = [y[rows].T @ back, back.sum(0), inner.T @ miss, miss.sum(0)]
                step += 1
                for i, g in enumerate(slopes):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - 3e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.w = w

    @staticmethod
    def _soft(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def parts(self, x: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each row, best first."""
        y = (x - self.mean) / self.scale
        out = np.maximum(y @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        return np.argsort(-out, axis=1, kind="stable")[:, :count]


def fit(x: np.ndarray, parts: int, target: float = TARGET) -> tuple[Router, int]:
    """Classifier from a sample, and how many parts to search for a query.

    Equal rows of the sample count once.  A tenth of it is held out: the parts
    searched are as many as hold the ``target`` share of its nearest rows in
    the rest.  Rows of the whole table are nearer to a query than those of the
    sample, so this errs to the safe side.
    """
    x = np.unique(x, axis=0)
    parts = max(1, min(parts, len(x) // 8))
    if parts == 1:
        return Router(x, np.ones((len(x), 1))), 1
    x = x[np.random.default_rng(SEED).permutation(len(x))]
    held, x = x[: len(x) // 10], x[len(x) // 10 :]
    graph = neighbour_graph(x, GRAPH_K)
    part = balanced_parts(x, graph, parts)
    targets = np.zeros((len(x), parts))
    own = np.arange(len(x))
    for column in [own, *graph.T]:
        np.add.at(targets, (own, part[column]), 1.0)
    router = Router(x, targets / targets.sum(1, keepdims=True))
    if not len(held):
        return router, parts
    place = np.argsort(router.parts(held, parts), axis=1)
    assigned = router.parts(x, 1)[:, 0]
    squares, k = (x * x).sum(1), min(GRAPH_K, len(x))
    seen = np.zeros(parts)
    for a in range(0, len(held), 512):
        near = np.argpartition(squares - 2 * (held[a : a + 512] @ x.T), k - 1, axis=1)[:, :k]
        ranks = np.take_along_axis(place[a : a + 512], assigned[near], axis=1)
        seen += np.bincount(ranks.ravel(), minlength=parts)
    covered = np.cumsum(seen) / seen.sum()
    return router, min(parts, int(np.searchsorted(covered, target)) + 1)


def usable(vector: Column) -> Column:
    """Not null or empty, no null, NaN or infinite component, not all zero."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.coalesce(
        (F.size(vector) > 0) & ~F.exists(vector, bad) & F.exists(vector, lambda v: v != 0), F.lit(False)
    )


def search(
    rows: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector: str = "embedding",
    target: float = TARGET, part_rows: int = PART_ROWS,
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score.

    Nearness is the Euclidean distance in double precision, ties go to the
    smaller id.  Rows with the query's own id are no candidates.  Unusable
    vectors, null ids and vectors of another length than the commonest take no part.
    Repeated candidates are each a row; of queries of one id the least vector
    counts.  No usable row gives no result.
    """
    spark = rows.sparkSession
    item = rows.schema[vector].dataType.elementType
    kind = "<f4" if isinstance(item, T.FloatType) else "<f8"
    take = lambda df: df.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")
    ).where(usable(F.col("v")) & F.col("id").isNotNull())
    valid, asked = take(rows), take(queries)
    stats = valid.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not stats:
        return spark.createDataFrame([], schema)
    dims, n_rows = stats[0]["d"], stats[0]["n"]
    valid, asked = (df.where(F.size("v") == dims) for df in (valid, asked))
    sample = valid.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toPandas()["v"]
    router, probes = fit(np.array(sample.tolist(), dtype=np.float64), min(MAX_PARTS, n_rows // part_rows), target)
    shared = spark.sparkContext.broadcast(router)

    def assign(count: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                parts = shared.value.parts(x.astype(np.float64), count)
                data = x.astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([r.tobytes() for r in data], pa.binary()), pa.array(list(parts.astype(np.int32)), pa.list_(pa.int32()))],
                    ["id", "x", "parts"],
                )

        return run

    out = "id long, x binary, parts array<int>"
    placed = valid.mapInArrow(assign(1), out).select("id", "x", F.element_at("parts", 1).alias("part"))
    placed = stage(placed, "parts")
    # no more rows than parts
    sizes = placed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes = stage(sizes, "part-sizes")
    dealt = placed.join(F.broadcast(sizes), "part").select(
        "part", F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("blocks")).cast("int").alias("block"), "id", "x"
    )
    once = asked.groupBy("id").agg(F.min("v").alias("v"))
    routed = once.mapInArrow(assign(probes), out).select("id", "x", F.explode("parts").alias("part"))
    sent = routed.join(F.broadcast(sizes), "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "x"
    )

    def nearest(block: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block) and len(wanted):
            ids = block["id"].to_numpy()
            x = np.frombuffer(b"".join(block["x"]), dtype=kind).reshape(-1, dims).astype(np.float64)
            for q, v in zip(wanted["id"], wanted["x"]):
                gap = x - np.frombuffer(v, dtype=kind).astype(np.float64)
                d = np.sqrt((gap * gap).sum(1))
                d[ids == q] = np.inf
                best = np.lexsort((ids, d))[: k + 1]
                best = best[d[best] < np.inf][:k]
                found.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": d[best]}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat(found) if found else empty

    near = dealt.groupBy("part", "block").cogroup(sent.groupBy("part", "block")).applyInPandas(
        nearest, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
