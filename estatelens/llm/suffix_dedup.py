"""Repeated byte strings, found by a suffix sort that compares by hashes.

Every string of ``length`` bytes that starts at two places of the corpus marks
its bytes. Such strings are windows, the first ``length`` bytes of a suffix.

1. Documents are packed into blocks. In a block, prefix polynomial hashes give
   the hash of any substring in one step. Each window is owned by the smallest
   hash among its substrings of ``GRAM`` bytes (the anchor); equal windows own
   equal anchors at equal distance. One row per anchor leaves the block: anchor
   hash, digest of the bytes under its windows (the context), place.
2. One exchange by anchor hash tells anchors that stand alone (nothing of theirs
   repeats: most rows end here), contexts that occur twice (all their windows
   repeat) and different contexts of one anchor (open).
3. The open contexts' bytes go to their anchor's task. There their windows are
   sorted as suffixes by mergesort: a comparison finds the common extension by
   binary search over equal prefix hashes, so it takes log2(length) steps. All
   neighbours of the sorted order are then compared byte by byte, which proves
   order and equality; after a collision the sort starts anew with another base.
   Neighbours that agree on the whole length repeat.
4. Marked intervals return to their block and are cut from each document.

Anchors that a thousandth of a sample of blocks shares are dealt out in
``SALTS`` slices, their contexts all open; open contexts of these and of anchors
with more than ``WIDE`` contexts are too many for one task and are told apart
by digests of single windows, each sent once per task, in packs dealt by digest. Every case is
exact; the sample only steers which way a row goes.

Memory: a block of ``BLOCK_BYTES`` or one longer text. Defined results: a null
text is empty; a text shorter than ``length`` keeps everything; of rows equal in
id and text each is a copy of the other.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.common import larger, prepare, scratch

LENGTH = 200
GRAM = 64
BLOCK_BYTES = 2_000_000
#: Window starts that are hashed at once.
SLICE = 1 << 21
PACK_BYTES = 1_000_000
WIDE = 256
SALTS = 64
#: Windows of very wide anchors that meet in one task.
SHARE_WINDOWS = 1_000_000
#: One block in so many is looked at for anchors that much of the corpus shares.
SAMPLE = 16
POSITION = np.uint64((1 << 22) - 1)


@functools.cache
def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 to the 64."""
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, "u8"), np.full(n, inverse, "u8")
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@functools.cache
def _bases(attempt: int) -> tuple[int, np.ndarray]:
    r = np.random.default_rng(attempt)
    return int(r.integers(1 << 62)) * 4 + 3, r.integers(1 << 63, size=256, dtype="u8") * np.uint64(2) + np.uint64(1)


class PrefixHash:
    """Hash of any substring of ``data`` from two prefix hashes."""

    def __init__(self, data: np.ndarray, attempt: int = 0):
        base, letters = _bases(attempt)
        size = 1 << max(16, int(len(data)).bit_length())
        up, self.down = powers(size, base)
        self.prefix = np.zeros(len(data) + 1, "u8")
        np.cumsum(letters[data] * up[:len(data)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]


def mixed(h: np.ndarray) -> np.ndarray:
    """The same values with all bits depending on all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every ``w`` consecutive values, by running minima inside blocks of ``w``."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, ~np.uint64(0))
    padded[:len(x)] = x
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def anchors(data: bytes, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window start, shape (distance to the anchor * 1024 + windows), anchor hash and context digest of every anchor."""
    d = np.frombuffer(data, "u1")
    begins = np.concatenate(([0], ends[:-1])).astype("i8")
    valid = np.zeros(len(d) + 1, "i4")                    # window starts whose window ends in the same text
    long = ends - begins >= length
    np.add.at(valid, begins[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    out = []
    for a in range(0, len(d), SLICE):
        part = d[a:a + SLICE + length - 1]
        if len(part) < length:
            break
        grams = mixed(PrefixHash(part)(np.arange(len(part) - gram + 1), gram))
        at = np.arange(len(grams), dtype="u8")
        owner = (sliding_min((grams & ~POSITION) | at, length - gram + 1) & POSITION).astype("i8")
        start = np.flatnonzero(valid[a:a + len(owner)])
        if not len(start):
            continue
        own = owner[start]
        first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)))
        n = np.diff(np.append(first, len(start)))
        lo = start[first] + a
        digest = [hashlib.blake2b(data[s:e], digest_size=8).digest() for s, e in zip(lo.tolist(), (lo + n + length - 1).tolist())]
        out.append((lo, (own[first] + a - lo) * 1024 + n, grams[own[first]].astype("i8"), np.frombuffer(b"".join(digest), "<i8")))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, "i8"),) * 4


def _agreement(h: PrefixHash, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How far the suffixes at ``a`` and ``b`` agree, at most ``length``: binary search over prefix hashes."""
    low, high = np.zeros(len(a), "i8"), np.full(len(a), length)
    for _ in range(int(length).bit_length()):
        half = (low + high + 1) // 2
        same = h(a, half) == h(b, half)
        low, high = np.where(same, half, low), np.where(same, high, half - 1)
    return low


def suffix_sort(data: np.ndarray, place: np.ndarray, kind: np.ndarray, length: int, attempt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``place`` by their first ``length`` bytes inside each of the ascending kinds, and which equal the one before."""
    h = PrefixHash(data, attempt)
    first = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, "i8")
    size = np.diff(np.append(first, len(kind)))
    begin, size = np.repeat(first, size), np.repeat(size, size)
    order = np.arange(len(place))
    width, widest = 1, int(size.max(initial=0))
    while width < widest:
        at = np.flatnonzero(size > width)                 # kinds that are one run already stay
        j = at - begin[at]
        run = j // width
        low = (run ^ 1) * width
        end = np.minimum(low + width, size[at])
        low = np.minimum(low, end)
        other = low.copy()
        left, mine = run % 2 == 0, place[order[at]]
        while True:                                       # rank in the neighbouring run
            busy = np.flatnonzero(low < end)
            if not len(busy):
                break
            half = (low[busy] + end[busy]) // 2
            theirs = place[order[begin[at[busy]] + half]]
            same = _agreement(h, mine[busy], theirs, length)
            rest = np.minimum(same, length - 1)
            x, y = data[mine[busy] + rest].astype("i2"), data[theirs + rest].astype("i2")
            before = np.where(same == length, ~left[busy], y < x)
            low[busy] = np.where(before, half + 1, low[busy])
            end[busy] = np.where(before, end[busy], half)
        new = order.copy()
        new[begin[at] + run // 2 * 2 * width + (j - run * width) + (low - other)] = order[at]
        order, width = new, 2 * width
    sorted_place = place[order]
    equal = np.zeros(len(place), bool)
    step = np.arange(length)
    pairs = np.flatnonzero(np.append(False, kind[1:] == kind[:-1])) if len(kind) else np.zeros(0, "i8")
    for k in range(0, len(pairs), 20_000):                # proof by the bytes themselves
        p = pairs[k:k + 20_000]
        x, y = data[sorted_place[p - 1][:, None] + step], data[sorted_place[p][:, None] + step]
        differ = x != y
        at = differ.argmax(axis=1)
        equal[p] = ~differ.any(axis=1)
        row = np.arange(len(p))
        if (x[row, at] > y[row, at]).any():
            return suffix_sort(data, place, kind, length, attempt + 1)
    return order, equal


def repeated_windows(contexts: list[bytes], group: np.ndarray, distance: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For the windows of all contexts, one after the other: whether another context of the same group holds the same bytes."""
    data = np.frombuffer(b"".join(contexts), "u1")
    begin = np.cumsum([0] + [len(c) for c in contexts[:-1]])
    which = np.repeat(np.arange(len(contexts)), windows)
    k = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    kind = group[which] * 2048 + distance[which] - k      # equal windows lie at equal distance before their anchor
    by_kind = np.argsort(kind, kind="stable")
    order, equal = suffix_sort(data, (begin[which] + k)[by_kind], kind[by_kind], length)
    out = np.zeros(len(which), bool)
    out[by_kind[order]] = equal | np.append(equal[1:], False)
    return out


def runs(flags: np.ndarray, owner: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """owner, first and last k of the runs of flagged windows of one context."""
    at = np.flatnonzero(flags)
    if not len(at):
        return (np.zeros(0, "i8"),) * 3
    new = np.append(True, (np.diff(at) != 1) | (owner[at][1:] != owner[at][:-1]))
    last = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return owner[at][new], k[at][new], k[at][last]


def _blocks(id_type: pa.DataType, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        pack = zstandard.ZstdCompressor(level=3)

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([ids], pa.list_(id_type)), pa.array([ends], pa.list_(pa.int64())),
                                               pa.array([pack.compress(b"".join(texts))], pa.binary())], ["block", "ids", "ends", "data"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = (t or "").encode()
                if texts and size + len(t) > block_bytes:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i), texts.append(t)
                size += len(t)
        if texts:
            yield block()
    return run


def _unpack(r: dict) -> tuple[bytes, np.ndarray]:
    return zstandard.ZstdDecompressor().decompress(r["data"]), np.array(r["ends"], "i8")


ANCHOR = "block bigint, lo bigint, shape bigint, gram bigint, context bigint"


def _anchors(blocks: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                found = anchors(*_unpack(r), length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), r["block"])), *map(pa.array, found)], ["block", "lo", "shape", "gram", "context"])
    return blocks.select("block", "ends", "data").mapInArrow(run, ANCHOR)


def _judged(blocks: DataFrame, length: int, gram: int, wide: int, sample: int) -> DataFrame:
    """block, lo, shape, gram, whole, open, wide of every anchor that has something to tell."""
    some = scratch(_anchors(blocks.filter(F.pmod(F.xxhash64("block"), F.lit(sample)) == 0), length, gram).groupBy("gram").count(), "sample")
    total = some.agg(F.sum("count")).first()[0] or 0
    shared = some.filter(F.col("count") > max(64, total / 1000)).select("gram", F.lit(True).alias("shared"))      # fewer than a thousand rows
    rows = _anchors(blocks, length, gram).join(F.broadcast(shared), "gram", "left")
    rows = rows.withColumn("slice", F.when(F.col("shared"), 1 + F.pmod(F.xxhash64("block", "lo"), F.lit(SALTS))).otherwise(0)).drop("shared")
    rows = rows.repartition("gram", "slice")              # one exchange and one sort serve both windows
    same = Window.partitionBy("gram", "slice", "context", "shape")
    rows = rows.withColumn("times", F.count(F.lit(1)).over(same.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = rows.withColumn("rank", F.row_number().over(same.orderBy("block")))
    rows = rows.withColumn("contexts", F.sum((F.col("rank") == 1).cast("int")).over(Window.partitionBy("gram", "slice")))
    rows = rows.select("block", "lo", "shape", "gram", (F.col("times") > 1).alias("whole"), ((F.col("rank") == 1) & ((F.col("contexts") > 1) | (F.col("slice") > 0))).alias("open"),
                       ((F.col("contexts") > wide) | (F.col("slice") > 0)).alias("wide"))
    return rows.filter("whole or open")


CONTEXT = "gram bigint, block bigint, lo bigint, shape bigint, whole boolean, wide boolean, bytes binary"


def _open_contexts(blocks: DataFrame, judged: DataFrame, length: int) -> DataFrame:
    """The bytes under the windows of every open anchor."""
    lists = judged.filter("open").groupBy("block").agg(F.collect_list(F.struct("gram", "lo", "shape", "whole", "wide")).alias("open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                data, _ = _unpack(r)
                for k in range(0, len(r["open"]), 20_000):
                    o = r["open"][k:k + 20_000]
                    cut = [data[x["lo"]:x["lo"] + x["shape"] % 1024 + length - 1] for x in o]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x["gram"] for x in o], pa.int64()), pa.array([r["block"]] * len(o), pa.int64()), pa.array([x["lo"] for x in o], pa.int64()),
                         pa.array([x["shape"] for x in o], pa.int64()), pa.array([x["whole"] for x in o]), pa.array([x["wide"] for x in o]), pa.array(cut, pa.binary())],
                        ["gram", "block", "lo", "shape", "whole", "wide", "bytes"])
    return blocks.select("block", "ends", "data").join(lists, "block").mapInArrow(run, CONTEXT)


SPAN = "block bigint, first bigint, last bigint"


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated stretches of the open contexts, by suffix sorts over packs of whole anchor groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None

        def pack() -> pa.RecordBatch:
            gram, block, lo, shape, whole, data = map(list, zip(*held))
            group = np.unique(np.array(gram), return_inverse=True)[1]
            n = np.array(shape) % 1024
            flags = repeated_windows(data, group, np.array(shape) // 1024, n, length)
            which = np.repeat(np.arange(len(n)), n)
            flags &= ~np.array(whole)[which]              # these are marked as a whole already
            c, first, last = runs(flags, which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n))
            lo = np.array(lo)[c]
            return pa.RecordBatch.from_arrays([pa.array(np.array(block)[c]), pa.array(lo + first), pa.array(lo + last + length)], ["block", "first", "last"])

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[0] != now and size >= PACK_BYTES:
                    yield pack()
                    held, size = [], 0
                now = row[0]
                held.append(row)
                size += len(row[-1])
        if held:
            yield pack()
    rows = contexts.filter("not wide").select("gram", "block", "lo", "shape", "whole", "bytes")
    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, SPAN)


PACK = "share int, high binary, low binary, many binary, block binary, place binary"
PACK_SCHEMA = pa.schema([("share", pa.int32())] + [(c, pa.binary()) for c in ("high", "low", "many", "block", "place")])


def _grouped(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the digests, and for each in that order the number of its group."""
    order = np.lexsort((low, high))
    h, l = high[order], low[order]
    return order, np.cumsum(np.append(True, (h[1:] != h[:-1]) | (l[1:] != l[:-1]))) - 1 if len(order) else order


def _stretches(block: np.ndarray, place: np.ndarray, length: int) -> pa.RecordBatch:
    """Windows as spans; neighbours become one."""
    order = np.lexsort((place, block))
    block, place = block[order], place[order]
    new = np.append(True, (block[1:] != block[:-1]) | (place[1:] != place[:-1] + 1)) if len(block) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(block))[:len(at)] - 1
    return pa.RecordBatch.from_arrays([pa.array(block[at]), pa.array(place[at]), pa.array(place[last] + length)], ["block", "first", "last"])


def _wide_spans(contexts: DataFrame, length: int, share_windows: int = SHARE_WINDOWS) -> DataFrame:
    """The same for anchors with very many contexts: equal windows by their digests.

    A task sorts the digests of all windows of a batch and sends each digest
    once, in packs dealt by digest; one that it saw twice is marked ``many`` and
    carries a place only where a single one is left to be judged. So a window
    that the whole corpus shares is one entry per batch.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in larger(batches, 4_000_000):
            rows = list(zip(*[b.column(c).to_pylist() for c in ("block", "lo", "shape", "whole", "bytes")]))
            n = np.array([r[2] % 1024 for r in rows], "i8")
            key = np.frombuffer(b"".join(hashlib.blake2b(r[4][k:k + length], digest_size=16).digest() for r, m in zip(rows, n.tolist()) for k in range(m)), "<u8").reshape(-1, 2)
            which = np.repeat(np.arange(len(n)), n)
            place = np.array([r[1] for r in rows], "i8")[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            block = np.where(np.array([r[3] for r in rows])[which], -1, np.array([r[0] for r in rows], "i8")[which])       # -1: marked as a whole already
            order, group = _grouped(key[:, 0], key[:, 1])
            many = np.bincount(group)[group] > 1
            seen = many & (block[order] >= 0)
            if seen.any():                                # equal windows in this batch: judged here
                yield _as_pack(-1, key[order[seen]], many[seen], block[order[seen]], place[order[seen]])
            first = np.append(True, group[1:] != group[:-1])
            key, many, block, place = key[order[first]], many[first], np.where(many[first], -1, block[order[first]]), place[order[first]]
            share = (key[:, 0] % np.uint64(shares)).astype("i8")
            by_share = np.argsort(share, kind="stable")
            for at in np.split(by_share, np.flatnonzero(np.diff(share[by_share])) + 1):
                yield _as_pack(int(share[at[0]]), key[at], many[at], block[at], place[at])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def result() -> pa.RecordBatch:
            high, low, many, block, place = (np.concatenate([np.frombuffer(r[c], kind) for r in held]) for c, kind in (("high", "<u8"), ("low", "<u8"), ("many", "u1"), ("block", "<i8"), ("place", "<i8")))
            order, group = _grouped(high, low)
            again = (np.bincount(group) + np.bincount(group, many[order]) > 1)[group] & (block[order] >= 0)
            return _stretches(block[order[again]], place[order[again]], length)

        for b in batches:
            for r in b.to_pylist():
                if r["share"] != now and held:
                    yield result()
                    held = []
                now = r["share"]
                if now < 0:
                    yield _stretches(np.frombuffer(r["block"], "<i8"), np.frombuffer(r["place"], "<i8"), length)
                else:
                    held.append(r)
        if held:
            yield result()

    wide = contexts.filter("wide").select("block", "lo", "shape", "whole", "bytes")
    shares = 1 + (wide.agg(F.sum(F.pmod("shape", F.lit(1024)))).first()[0] or 0) // share_windows
    packs = wide.mapInArrow(pack, PACK)
    # what a task has judged alone needs no meeting place
    return packs.repartition(F.when(F.col("share") >= 0, F.col("share")).otherwise(F.xxhash64("block", "place"))).sortWithinPartitions("share").mapInArrow(judge, SPAN)


def _as_pack(share: int, key: np.ndarray, many: np.ndarray, block: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    values = (key[:, 0], key[:, 1], many.astype("u1"), block, place)
    return pa.RecordBatch.from_arrays([pa.array([share], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in values]], schema=PACK_SCHEMA)


def _cut(id_type: pa.DataType, texts: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans"] + (["kept"] if texts else ["kept_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                data, ends = _unpack(r)
                d = np.frombuffer(data, "u1")
                depth = np.zeros(len(d) + 1, "i4")
                spans = r["spans"] or []
                np.add.at(depth, np.array([s["first"] for s in spans], "i8"), 1)
                np.add.at(depth, np.array([s["last"] for s in spans], "i8"), -1)
                gone = np.cumsum(depth[:-1]) > 0
                out = []
                for i, s, e in zip(r["ids"], [0, *ends[:-1].tolist()], ends.tolist()):
                    g = gone[s:e]
                    kept = d[s:e][~g].tobytes() if g.any() else data[s:e]
                    out.append((i, e - s, int(g.sum()), int((g[1:] & ~g[:-1]).sum() + g[:1].sum()), kept if texts else hashlib.sha256(kept).hexdigest()))
                kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary() if texts else pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = False, block_bytes: int = BLOCK_BYTES, wide: int = WIDE, sample: int = SAMPLE,
                   share_windows: int = SHARE_WINDOWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (with ``texts`` instead kept, the remaining bytes) of every row of ``docs`` (doc_id, text)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema["doc_id"].dataType
    sql, arrow = kind.simpleString(), to_arrow_type(kind)
    blocks = scratch(docs.select("doc_id", "text").mapInArrow(_blocks(arrow, block_bytes), f"block bigint, ids array<{sql}>, ends array<bigint>, data binary"), "blocks")
    prepare(spark, 4)                                     # rows are blocks from here on
    judged = scratch(_judged(blocks, length, gram, wide, sample), "anchors")
    contexts = scratch(_open_contexts(blocks, judged, length), "contexts")
    prepare(spark, 2_000)
    whole = judged.filter("whole").select("block", F.col("lo").alias("first"), (F.col("lo") + F.pmod("shape", F.lit(1024)) + (length - 1)).alias("last"))
    spans = scratch(whole.unionByName(_sorted_spans(contexts, length)).unionByName(_wide_spans(contexts, length, share_windows)), "spans")
    prepare(spark, 4)
    lists = spans.groupBy("block").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    end = "kept binary" if texts else "kept_sha256 string"
    return blocks.join(lists, "block", "left").select("block", "ids", "ends", "data", "spans").mapInArrow(_cut(arrow, texts), f"doc_id {sql}, n_bytes bigint, n_removed bigint, n_spans bigint, {end}")
