"""Embedding near-duplicates as an exact metric range join.

Cosine >= c is Euclidean distance <= eps = sqrt(2 - 2 c) between unit vectors.
Pivots (farthest-first from a bounded sample) partition the vectors by nearest
pivot. A vector of cell i also goes to cell j > i if a partner could lie there:
by the triangle inequality d(x, p_j) - d(x, p_i) <= 2 eps, and, as the cells meet
in the plane between two pivots, (d(x, p_j)^2 - d(x, p_i)^2) / 2 d(p_i, p_j) <= eps.
Each cell joins its own vectors with each other and with its guests, apart from
all other cells, in pairs of blocks of at most about ``BLOCK`` rows, so a hot cell is
many tasks. A task returns counts per vector and a spanning forest of its
links, never the pairs, so its output is linear in its rows.

Equal vectors are one row with a number of copies. The join is exact: it loses
no link for any data. Data without clusters cannot be pruned by any metric bound
(all distances are alike); there the work is that of all block pairs.

Defined results: vectors that can't be compared (see ``valid_vectors``) have no
links and are their own component; rows that repeat a vector link with each
other; a null vec_id is never kept.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.common import scratch
from estatelens.llm.components import components
from estatelens.llm.vectors import by_length, matrix, unit, valid_vectors

MIN_COSINE = 0.9
#: Vectors that pivots are chosen from, and the most pivots (512 doubles each at 64 dimensions).
SAMPLE = 4096
MAX_PIVOTS = 256
#: A cell's own vectors on average, and the rows of one block.
CELL_ROWS = 8192
BLOCK = 4096
#: Rows of a block multiplied at once.
STRIPE = 256


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal of unit vectors."""
    chosen, far = [0], 2 - 2 * (sample @ sample[0])
    while len(chosen) < min(n, len(sample)):
        k = int(far.argmax())
        if far[k] <= 1e-12:
            break
        chosen.append(k)
        far = np.minimum(far, 2 - 2 * (sample @ sample[k]))
    return sample[chosen]


def reach(u: np.ndarray, pivots: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and a mask of the later cells that it visits."""
    d2 = np.maximum(0, 2 - 2 * (u @ pivots.T))
    between = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))
    home = d2.argmin(axis=1)
    own = d2[np.arange(len(u)), home][:, None]
    slack = 1e-6
    triangle = np.sqrt(d2) - np.sqrt(own) <= 2 * eps + slack
    plane = d2 - own <= (eps + slack) * 2 * between[home]
    return home, triangle & plane & (np.arange(len(pivots))[None, :] > home[:, None])


def join_forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs in ``label``, which holds the smallest position of each part found so far."""
    while True:
        while (up := label[label]) is not None and (up != label).any():
            label[:] = up
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return
        np.minimum.at(label, high, low)


def block_links(left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between unit vectors of two blocks (``right`` None: inside the left one).

    Returns, over left rows then right rows, the number of linked vectors and a
    forest label. Products in single precision propose, doubles decide.
    """
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    margin = 1e-5 + 4e-7 * left.shape[1]
    l32, o32 = left.astype("f4"), other.astype("f4").T
    count, label = np.zeros(len(copies), dtype="i8"), np.arange(len(copies))
    for lo in range(0, len(left), STRIPE):
        i, j = np.nonzero(l32[lo:lo + STRIPE] @ o32 >= min_cosine - margin)
        i += lo
        if right is None:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 65_536):
            a, b = i[at:at + 65_536], j[at:at + 65_536]
            exact = np.einsum("ij,ij->i", left[a], other[b]) >= min_cosine
            a, b = a[exact], b[exact] + shift
            np.add.at(count, a, copies[b])
            np.add.at(count, b, copies[a])
            join_forest(label, a, b)
    return count, label


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, block: int = BLOCK, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    valid = scratch(valid_vectors(vectors), "vectors")
    out = functools.reduce(DataFrame.unionByName, [_linked(one, min_cosine, block, cell_rows) for one in by_length(valid)])
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).groupBy("vec_id").count()
    used = valid.groupBy("vec_id").agg(F.count("*").alias("used"))
    rest = rest.join(used, rest.vec_id.eqNullSafe(used.vec_id), "left").select(rest.vec_id, (F.col("count") - F.coalesce("used", F.lit(0))).alias("left_out"))
    rest = rest.filter("left_out > 0").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                              F.explode(F.expr("array_repeat(0, CAST(left_out AS INT))"))).drop("col")
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _linked(valid: DataFrame, min_cosine: float, block: int, cell_rows: int) -> DataFrame:
    """vec_id, n_links, component_id of valid vectors of one length."""
    eps = math.sqrt(2 - 2 * min_cosine)
    points = scratch(valid.groupBy("vec").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
                     .withColumn("node", F.monotonically_increasing_id()), "points")
    n = points.count()
    sample = [r.vec for r in points.select("vec").orderBy(F.xxhash64("vec")).limit(SAMPLE).collect()]
    pivots = choose_pivots(unit(matrix(list(map(bytes, sample)))), min(MAX_PIVOTS, math.ceil(n / cell_rows))) if n else np.zeros((0, 1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, visits = reach(unit(matrix(b.column(0))), pivots, eps)
            row, cell = np.nonzero(visits)
            take = np.concatenate((np.arange(len(home)), row))
            guest = np.arange(len(take)) >= len(home)
            cols = [c.take(pa.array(take)) for c in b.columns]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate((home, cell)), pa.int32()), pa.array(guest)],
                                             ["vec", "copies", "node", "cell", "guest"])
    cells = scratch(points.select("vec", "copies", "node").mapInArrow(assign, "vec binary, copies bigint, node bigint, cell int, guest boolean"), "cells")
    sizes = (cells.groupBy("cell").agg(F.ceil(F.count_if(~F.col("guest")) / block).cast("int").alias("own"),
                                       F.ceil(F.count_if("guest") / block).cast("int").alias("guests")))
    rows = cells.join(F.broadcast(sizes), "cell")       # at most MAX_PIVOTS rows
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("own"))).cast("int"))
    none = "CAST(array() AS array<struct<i:int,j:int,with_guests:boolean,first:boolean>>)"
    made = lambda i, j, g, first: f"named_struct('i', {i}, 'j', {j}, 'with_guests', {g}, 'first', {first})"
    tasks = F.expr(f"""CASE WHEN guest THEN transform(sequence(0, own - 1), x -> {made('x', 'block', 'true', 'false')})
        ELSE concat(transform(sequence(block, own - 1), x -> {made('block', 'x', 'false', 'true')}),
                    CASE WHEN block > 0 THEN transform(sequence(0, block - 1), x -> {made('x', 'block', 'false', 'false')}) ELSE {none} END,
                    CASE WHEN guests > 0 THEN transform(sequence(0, guests - 1), x -> {made('block', 'x', 'true', 'true')}) ELSE {none} END) END""")
    rows = rows.filter(~F.col("guest") | (F.col("own") > 0)).select("cell", "vec", "copies", "node", F.explode(tasks).alias("t"))
    rows = rows.select("cell", "t.i", "t.j", "t.with_guests", "t.first", "vec", "copies", "node")

    def compare(t: pa.Table) -> pa.Table:
        first = t["first"].to_numpy()
        order = np.argsort(~first, kind="stable")
        t = t.take(pa.array(order))
        u, node, copies, k = unit(matrix(t["vec"])), t["node"].to_numpy(), t["copies"].to_numpy(), int(first.sum())
        same = t["i"][0].as_py() == t["j"][0].as_py() and not t["with_guests"][0].as_py()
        count, label = block_links(u[:k], None if same else u[k:], copies, min_cosine)
        linked = np.nonzero(count)[0]
        return pa.table({"a": node[linked], "b": node[label[linked]], "n": count[linked]})
    found = scratch(rows.groupBy("cell", "i", "j", "with_guests").applyInArrow(compare, "a bigint, b bigint, n bigint"), "found")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(found)
    points = points.select("vec", "vec_id", "copies", "node").join(groups, "node", "left").join(counts, "node", "left")
    points = scratch(points.select("vec", "vec_id", F.coalesce("component", "node").alias("component"),
                                   (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "grouped")
    least = points.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    points = scratch(points.join(least, "component").select("vec", "n_links", "component_id"), "labelled")
    return valid.join(points, "vec").select("vec_id", "n_links", "component_id")
