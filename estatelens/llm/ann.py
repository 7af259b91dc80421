"""Approximate nearest neighbours by learned partitions.

Fitted on a bounded sample (the ``SAMPLE`` rows with the smallest hash): its
neighbour graph is cut into balanced parts, and a small network learns, from a
vector, how its neighbours spread over the parts. Every row of the table is
indexed in its most probable part. A query goes to its most probable parts until
their probabilities add up to ``mass``, which is set so that sample rows kept
out of training find ``TARGET_RECALL`` of their neighbours; what the parts hold
is compared exactly in doubles. Parts are joined with their queries in blocks,
so a hot part is many tasks.

Defined results: vectors that can't be compared (see ``valid_vectors``) are
neither queries nor candidates; candidates are the rows with another vec_id;
rows repeated under one vec_id are one candidate for each distinct vector;
up to ``2 * MIN_PART`` rows make one part, which is then an exact search.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.common import scratch
from estatelens.llm.vectors import by_length, matrix, valid_vectors

K = 10
#: Rows of the sample that graph, network and mass are fitted on; one in five is held out.
SAMPLE = 4096
HELD_OUT = 5
TARGET_RECALL = 0.97
PARTS = 16
MIN_PART = 512
HIDDEN = 128
EPOCHS = 40
#: Rows and queries of one task.
BLOCK = 16_384
QUERY_BLOCK = 1024


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]


def neighbour_graph(x: np.ndarray, k: int = K) -> np.ndarray:
    """Positions of the k nearest other rows."""
    out = []
    for lo in range(0, len(x), 512):
        d = squared(x[lo:lo + 512], x)
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out.append(np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Parts of nearly equal size that keep neighbours together.

    Parts grow from far-apart rows along the graph; then rows move to the part
    of most of their neighbours, largest gain first, while it has room.
    """
    n, k = graph.shape
    room = int(np.ceil(1.05 * n / parts))
    links = [[] for _ in range(n)]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            links[i].append(j), links[j].append(i)
    part, size = np.full(n, -1), np.zeros(parts, dtype=int)
    fresh = iter(range(n))
    border = [[] for _ in range(parts)]
    while (part < 0).any():
        p = int(size.argmin())
        while border[p] and part[border[p][0]] >= 0:
            border[p].pop(0)
        i = border[p].pop(0) if border[p] else next(j for j in fresh if part[j] < 0)
        part[i], size[p] = p, size[p] + 1
        border[p] += [j for j in links[i] if part[j] < 0]
    src = np.repeat(np.arange(n), [len(x) for x in links])
    dst = np.concatenate([np.array(x, dtype=int) for x in links])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (src, part[dst]), 1)
        want = votes.argmax(axis=1)
        gain = votes[np.arange(n), want] - votes[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[want[i]] < room:
                size[part[i]] -= 1
                size[want[i]] += 1
                part[i] = want[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """One hidden layer and a softmax over the parts; Adam on soft targets."""

    def __init__(self, inputs: int, parts: int, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(inputs), 1.0
        self.p = [r.normal(0, (2 / inputs) ** 0.5, (inputs, HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN ** -0.5, (HIDDEN, parts)), np.zeros(parts)]

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = (x - self.mean) / self.scale
        h = np.maximum(0, x @ self.p[0] + self.p[1])
        z = h @ self.p[2] + self.p[3]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return x, h, e / e.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[2]

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> Router:
        self.mean, self.scale = x.mean(axis=0), float(x.std()) or 1.0
        r, m, v, t = np.random.default_rng(seed), [0 * p for p in self.p], [0 * p for p in self.p], 0
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for lo in range(0, len(x), 128):
                xb, yb = x[order[lo:lo + 128]], y[order[lo:lo + 128]]
                xn, h, q = self.hidden(xb)
                dz = (q - yb) / len(xb)
                dh = dz @ self.p[2].T * (h > 0)
                t += 1
                for i, g in enumerate([xn.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]):
                    g = g + 1e-4 * self.p[i]
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
                    self.p[i] = self.p[i] - 0.003 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
        return self


def probes(prob: np.ndarray, mass: float) -> np.ndarray:
    """Mask of the most probable parts whose probabilities reach ``mass``."""
    order = np.argsort(-prob, axis=1, kind="stable")
    ranked = np.take_along_axis(prob, order, axis=1)
    use = np.cumsum(ranked, axis=1) - ranked < mass
    out = np.zeros_like(use)
    np.put_along_axis(out, order, use, axis=1)
    return out


def fit(sample: np.ndarray, parts: int) -> tuple[Router, float]:
    """The router and the probability mass that a query has to cover."""
    sample = np.unique(sample, axis=0)
    sample = sample[np.random.default_rng(3).permutation(len(sample))]
    if parts < 2 or len(sample) < 2 * parts:
        return Router(sample.shape[1], 1), 1.0
    graph = neighbour_graph(sample)
    part = balanced_parts(graph, parts)
    y = np.zeros((len(sample), parts))
    np.add.at(y, (np.repeat(np.arange(len(sample)), graph.shape[1]), part[graph].ravel()), 1)
    np.add.at(y, (np.arange(len(sample)), part), 1)
    y /= y.sum(axis=1, keepdims=True)
    out = np.arange(len(sample)) % HELD_OUT == 0
    router = Router(sample.shape[1], parts).fit(sample[~out], y[~out])
    prob = router(sample)
    index = prob.argmax(axis=1)
    for mass in [*np.arange(0.5, 1.0, 0.02), 0.99, 0.999]:
        use = probes(prob[out], mass)
        if np.take_along_axis(use, index[graph[out]], axis=1).mean() >= TARGET_RECALL:
            return router, float(mass)
    return router, 2.0


def nearest(q: np.ndarray, q_id: np.ndarray, r: np.ndarray, r_id: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the query, position of the row and distance of the k nearest rows with another id.

    Products find all rows that could be among them, rounding allowed for;
    differences give the distances that order them, ties by id.
    """
    got = [[], [], []]
    for lo in range(0, len(q), 64):
        d = squared(q[lo:lo + 64], r)
        d[q_id[lo:lo + 64, None] == r_id[None, :]] = np.inf
        limit = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
        size = (q[lo:lo + 64] ** 2).sum(1) + (r * r).sum(1).max()
        for i, j in enumerate(d <= (limit + 1e-9 * size)[:, None]):
            j = np.nonzero(j & np.isfinite(d[i]))[0]
            e = np.sqrt(((q[lo + i] - r[j]) ** 2).sum(axis=1))
            best = np.lexsort((r_id[j], e))[:k]
            got[0] += [lo + i] * len(best)
            got[1].append(j[best]), got[2].append(e[best])
    return np.array(got[0], dtype=int), np.concatenate(got[1]), np.concatenate(got[2])


def search(vectors: DataFrame, every: int = 100, k: int = K, parts: int = PARTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row whose vec_id is divisible by ``every``."""
    rows = scratch(valid_vectors(vectors).filter("vec_id IS NOT NULL").distinct(), "ann")
    found = functools.reduce(DataFrame.unionByName, [_found(one, every, k, parts) for one in by_length(rows)])
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, every: int, k: int, parts: int) -> DataFrame:
    """query_id, vec_id, score: candidates among vectors of one length, the k nearest of every block of rows that a query meets."""
    n = rows.count()
    sample = [bytes(r.vec) for r in rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(SAMPLE).select("vec").collect()]
    router, mass = fit(matrix(sample), max(1, min(parts, n // MIN_PART))) if n else (Router(1, 1), 1.0)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prob = router(matrix(b.column(1)))
            ids = b.column(0).to_numpy()
            asks = np.nonzero(ids % every == 0)[0]
            who, part = np.nonzero(probes(prob[asks], mass))
            take = pa.array(np.concatenate((np.arange(len(ids)), asks[who])))
            part = np.concatenate((prob.argmax(axis=1), part))
            yield pa.RecordBatch.from_arrays([c.take(take) for c in b.columns] + [pa.array(part, pa.int32()), pa.array(np.arange(len(part)) >= len(ids))],
                                             ["vec_id", "vec", "part", "asks"])
    placed = scratch(rows.mapInArrow(index, "vec_id bigint, vec binary, part int, asks boolean"), "index")
    sizes = placed.groupBy("part").agg(F.ceil(F.count_if(~F.col("asks")) / BLOCK).cast("int").alias("blocks"),
                                       F.ceil(F.count_if("asks") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    placed = placed.join(F.broadcast(sizes), "part").filter("blocks > 0 AND query_blocks > 0")       # one row per part
    own = F.pmod(F.xxhash64("vec_id"), F.when(F.col("asks"), F.col("query_blocks")).otherwise(F.col("blocks"))).cast("int")
    meets = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("blocks")).otherwise(F.col("query_blocks")) - 1))
    placed = placed.select("part", "vec_id", "vec", "asks", own.alias("own"), meets.alias("other"))
    placed = placed.select("part", "vec_id", "vec", "asks", F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).alias("queries"),
                           F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).alias("block"))

    def compare(t: pa.Table) -> pa.Table:
        asks, ids, m = t["asks"].to_numpy(), t["vec_id"].to_numpy(), matrix(t["vec"])
        if not asks.any() or asks.all():
            return pa.table({"query_id": np.zeros(0, "i8"), "vec_id": np.zeros(0, "i8"), "score": np.zeros(0)})
        i, j, d = nearest(m[asks], ids[asks], m[~asks], ids[~asks], k)
        return pa.table({"query_id": ids[asks][i], "vec_id": ids[~asks][j], "score": d})
    return placed.groupBy("part", "queries", "block").applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
