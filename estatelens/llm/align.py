"""Alignment of two tokenizers: which tokens of A and B cover the same bytes.

Per batch and keyed by document, ``pandas.merge_asof`` finds for every token's
start the token of the other side that covers it; both directions together are
all overlaps. An overlap whose two tokens end at one byte closes a group; the
tokens of a group link to each other, each A to each B.

How many documents hold an id pair linked is a corpus-wide count. A task adds
up the pairs of its documents, so one row per task and pair is shuffled, keyed
by the A id; totals and the highest count of each A id come from two windows
over that one exchange. They return to the task's documents, which are kept as
packed arrays of pair numbers, sorted behind them.

Memory: one batch of ``BATCH_BYTES`` of text or one longer text, and at most
``TABLE_PAIRS`` pairs a table; a task with more pairs starts a further table.

Defined results: a null or empty text, and one whose joined token bytes differ
from space + text, has no tokens: zeros and an empty digest. Rows that share an
id or are equal count as documents of their own. The strings of special tokens
are plain text.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.bpe import BatchEncoder, byte_table, plain_pieces, units
from estatelens.llm.common import larger, prepare, scratch

BATCH_BYTES = 700_000
#: Words in each side's table.
ENTRIES = 200_000
#: Distinct pairs in one table of a task.
TABLE_PAIRS = 1_000_000
#: Pairs in one row of a written table.
ROW_PAIRS = 20_000
#: A group of more links than this gives each distinct id pair once, with its multiplicity.
WIDE_GROUP = 1_024


class Flat:
    """Byte strings end to end."""

    def __init__(self, items: list[bytes]):
        self.length = np.array([len(x) for x in items], "i8")
        self.first = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(items), "u1")

    def take(self, rows: np.ndarray) -> np.ndarray:
        n = self.length[rows]
        shift = self.first[rows] - (np.cumsum(n) - n)
        return self.data[np.arange(int(n.sum())) + np.repeat(shift, n)]


class PieceBatches(BatchEncoder):
    """The same for a sentencepiece model. No piece has its space mark behind another character, so words merge on their own."""

    def __init__(self, model):
        self.model = model
        super().__init__(_NoPieces(), lead=True, entries=ENTRIES)
        marks = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in marks):
            raise ValueError("pieces of this model reach over spaces, so words do not merge on their own")

    def new_ids(self, keys: list[str]) -> list[list[int]]:
        return self.model.encode([k[2:] if k[:1] == "\t" else k for k in keys], num_threads=1)



class _NoPieces:
    """Stands where a piece encoder would; the model encodes whole units."""


@functools.cache
def byte_side(path: str, pattern: str) -> tuple[BatchEncoder, Flat]:
    """Encoder and token bytes of a byte-level file of the tokenizers library."""
    from tokenizers import Tokenizer

    back = {c: b for b, c in byte_table().items()}
    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(vocab.values()) + 1)
    for text, k in vocab.items():
        tokens[k] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
    return BatchEncoder(plain_pieces(path, pattern), lead=True, entries=ENTRIES), Flat(tokens)


@functools.cache
def piece_side(path: str) -> tuple[BatchEncoder, Flat]:
    """Encoder and token bytes of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    return PieceBatches(model), Flat([bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)])


@functools.cache
def decimals(n: int) -> Flat:
    """Every id below n before each of the four ends that the group text has."""
    return Flat([b"%d%s" % (k, end) for end in (b",", b"|", b";", b"") for k in range(n)])


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[_lasting(x)]


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all overlapping tokens. Starts ascend over the batch and every document's first tokens start together."""
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    covering = [pd.merge_asof(a, b, on="at", by="doc"), pd.merge_asof(b, a, on="at", by="doc")]
    pairs = np.concatenate([m["a"].to_numpy("i8") * (len(b) + 1) + m["b"].to_numpy("i8") for m in covering])
    pairs = distinct(pairs)
    return pairs // (len(b) + 1), pairs % (len(b) + 1)


def _lasting(values: np.ndarray) -> np.ndarray:
    """Whether each of ascending values is the last of its kind."""
    return np.append(values[1:] != values[:-1], True) if len(values) else np.zeros(0, bool)


def _linked(doc: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document, id pair (a << 32 | b) and multiplicity of the links; ``doc`` is the document of each group."""
    na, nb = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    begin_a, begin_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    wide = na * nb > WIDE_GROUP
    a_at = np.flatnonzero(~wide[group_a])
    times = nb[group_a[a_at]]                             # each A token meets all B tokens of its group
    g = np.repeat(group_a[a_at], times)
    step = np.arange(len(g)) - np.repeat(np.cumsum(times) - times, times)
    docs = [doc[g]]
    keys = [np.repeat(ids_a[a_at], times).astype("i8") << 32 | ids_b[begin_b[g] + step]]
    mult = [np.ones(len(g), "i8")]
    for k in np.flatnonzero(wide).tolist():
        ua, ca = np.unique(ids_a[begin_a[k]:begin_a[k] + na[k]], return_counts=True)
        ub, cb = np.unique(ids_b[begin_b[k]:begin_b[k] + nb[k]], return_counts=True)
        keys.append((ua.astype("i8")[:, None] << 32 | ub.astype("i8")).ravel())
        mult.append((ca[:, None] * cb).ravel())
        docs.append(np.full(len(keys[-1]), doc[k]))
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(mult)


def align_batch(texts: pa.Array, side_a: tuple[BatchEncoder, Flat], side_b: tuple[BatchEncoder, Flat]) -> dict:
    """Counts and digests per text, the ascending id pairs of the batch, and for each text its pair numbers with multiplicity."""
    n_docs = len(texts)
    raw = [b" " + t.encode() if t else b"" for t in texts.to_pylist()]
    size = np.array([len(r) for r in raw], "i8")
    good = size > 0
    ids, counts, lengths = [], [], []
    cut = units(texts, True)
    for encoder, table in (side_a, side_b):
        x, n = encoder.encode(cut)
        length = table.length[x]
        data, begin = table.take(x).tobytes(), np.concatenate(([0], np.cumsum(length)))
        to = np.cumsum(n)
        at, end = begin[to - n].tolist(), begin[to].tolist()
        good &= np.array([data[a:b] == r for a, b, r in zip(at, end, raw)], bool)
        ids.append(x), counts.append(n), lengths.append(length)
    kept = []
    for x, n, length in zip(ids, counts, lengths):
        doc = np.repeat(np.arange(n_docs), n)
        keep = good[doc]
        x, doc, length = x[keep].astype("i8"), doc[keep], length[keep]
        end = np.cumsum(length)                           # of the kept texts, end to end: the same scale on both sides
        kept.append((x, doc, end - length, end))
    (a, doc_a, start_a, end_a), (b, doc_b, start_b, end_b) = kept
    over_a, over_b = overlaps(doc_a, start_a, doc_b, start_b)
    closing = distinct(end_a[over_a][end_a[over_a] == end_b[over_b]])
    group_a, group_b = np.searchsorted(closing, end_a), np.searchsorted(closing, end_b)
    groups = len(closing)
    last_a = _lasting(group_a)
    doc = doc_a[last_a]                                   # the document of each group
    na, nb = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    n_links = np.bincount(doc, na * nb, n_docs).astype("i8")

    # group text: the A tokens of a group, then its B tokens
    top = max(len(side_a[1].length), len(side_b[1].length))
    before_a, before_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    rows = np.empty(len(a) + len(b), "i8")
    rows[np.arange(len(a)) + before_b[group_a]] = a + top * last_a
    final = _lasting(doc)                                 # the last group of a document
    end_kind = np.where(_lasting(group_b), np.where(final[group_b], 3, 2), 0)
    rows[np.arange(len(b)) + (before_a + na)[group_b]] = b + top * end_kind
    table = decimals(top)
    shown = table.take(rows).tobytes()
    tokens = np.bincount(doc_a, minlength=n_docs) + np.bincount(doc_b, minlength=n_docs)
    begin = np.concatenate(([0], np.cumsum(table.length[rows])))
    to = np.cumsum(tokens)
    digests = [hashlib.sha256(shown[s:e]).hexdigest() if n else "" for s, e, n in zip(begin[to - tokens].tolist(), begin[to].tolist(), tokens.tolist())]

    link_doc, key, mult = _linked(doc, a, b, group_a, group_b, groups)
    keys, code = np.unique(key, return_inverse=True)
    own, back = np.unique(link_doc * max(len(keys), 1) + code, return_inverse=True)
    mult = np.bincount(back, mult, len(own)).astype("i8")
    pair_doc, code = own // max(len(keys), 1), own % max(len(keys), 1)
    return {"n_a": np.bincount(doc_a, minlength=n_docs), "n_b": np.bincount(doc_b, minlength=n_docs), "n_groups": np.bincount(doc, minlength=n_docs), "n_links": n_links,
            "digest": digests, "n_pairs": np.bincount(pair_doc, minlength=n_docs), "keys": keys, "code": code.astype("<i4"), "mult": mult.astype("<i8"),
            "docs": np.bincount(code, minlength=len(keys))}


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: table: the task's pair table; a b docs: some of its pairs; the rest: one batch of documents.
PACKED = "`table` bigint, a array<int>, b array<int>, docs array<int>, doc_id array<{id}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digest array<string>, n_pairs array<bigint>, keys binary, code binary, mult binary"


def _id_type(docs: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _pack(side_a: tuple, side_b: tuple, id_type: pa.DataType, batch_bytes: int, table_pairs: int):
    schema = pa.schema([("table", pa.int64())] + [(c, pa.list_(pa.int32())) for c in ("a", "b", "docs")] + [("doc_id", pa.list_(id_type))]
                       + [(c, pa.list_(pa.int64())) for c in COUNTS] + [("digest", pa.list_(pa.string())), ("n_pairs", pa.list_(pa.int64()))]
                       + [(c, pa.binary()) for c in ("keys", "code", "mult")])

    def row(**values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = byte_side(*side_a), piece_side(*side_b)
        number = TaskContext.get().partitionId() << 24
        keys, docs = np.zeros(0, "i8"), np.zeros(0, "i8")

        def table() -> Iterator[pa.RecordBatch]:
            for k in range(0, len(keys), ROW_PAIRS):
                part = keys[k:k + ROW_PAIRS]
                yield row(table=number, a=part >> 32, b=part & 0xFFFFFFFF, docs=docs[k:k + ROW_PAIRS])

        for batch in larger(batches, batch_bytes):
            got = align_batch(batch.column(1), a, b)
            if len(keys) + len(got["keys"]) > table_pairs:
                yield from table()
                number, keys, docs = number + 1, np.zeros(0, "i8"), np.zeros(0, "i8")
            union, back = np.unique(np.concatenate((keys, got["keys"])), return_inverse=True)
            docs = np.bincount(back, np.concatenate((docs, got["docs"])), len(union)).astype("i8")
            keys = union
            yield row(table=number, doc_id=batch.column(0).to_pylist(), keys=got["keys"].astype("<i8").tobytes(), code=got["code"].tobytes(),
                      mult=got["mult"].tobytes(), **{c: got[c] for c in (*COUNTS, "digest", "n_pairs")})
        yield from table()
    return run


RESULT = (*COUNTS, "n_best", "count_sum", "groups_sha256")


def _score(id_type: pa.DataType):
    """Task over sorted rows: the totals of a table's pairs, then its batches of documents."""
    schema = pa.schema([("doc_id", id_type)] + [(c, pa.int64()) for c in RESULT[:-1]] + [("groups_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, known = None, [], None
        for b in batches:
            tables = b.column("table").to_numpy()
            is_total = b.column("place").to_numpy() == 0
            edges = np.flatnonzero(np.append(True, (tables[1:] != tables[:-1]) | (is_total[1:] != is_total[:-1]) | ~is_total[1:])) if len(tables) else []
            for s, e in zip(edges, [*edges[1:], len(tables)]):
                if tables[s] != now:
                    now, held, known = tables[s], [], None
                if is_total[s]:
                    held.append([b.column(c).slice(s, e - s).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")])
                    continue
                if known is None:
                    known = [np.concatenate(x) if held else np.zeros(0, "i8") for x in zip(*held)] or [np.zeros(0, "i8")] * 3
                    held = []
                d = {c: b.column(c)[int(s)].as_py() for c in ("doc_id", *COUNTS, "digest", "n_pairs", "keys", "code", "mult")}
                at = np.searchsorted(known[0], np.frombuffer(d["keys"], "<i8"))[np.frombuffer(d["code"], "<i4")]
                mult, n = np.frombuffer(d["mult"], "<i8"), np.array(d["n_pairs"])
                whose = np.repeat(np.arange(len(n)), n)
                total = np.zeros((2, len(n)), "i8")
                np.add.at(total[0], whose, mult * known[2][at])
                np.add.at(total[1], whose, mult * known[1][at])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([d["doc_id"], *[d[c] for c in COUNTS], *total, d["digest"]], schema)], schema=schema)
    return run


def align(docs: DataFrame, side_a: tuple[str, str], side_b: tuple[str], batch_bytes: int = BATCH_BYTES, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text).

    ``side_a``: path and pattern of a byte-level file; ``side_b``: path of a sentencepiece model.
    """
    spark = docs.sparkSession
    prepare(spark)
    sql, arrow = _id_type(docs)
    packed = scratch(docs.select("doc_id", "text").mapInArrow(_pack(side_a, side_b, arrow, batch_bytes, table_pairs), PACKED.format(id=sql)), "aligned")
    pairs = packed.filter("a is not null").select("table", F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).select("table", "p.a", "p.b", "p.docs")
    dealt = pairs.repartition("a")                        # one exchange serves both windows
    totals = dealt.withColumn("n", F.sum("docs").over(Window.partitionBy("a", "b"))).withColumn("most", F.max("n").over(Window.partitionBy("a")))
    totals = totals.select("table", F.lit(0).alias("place"), (F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    batches = packed.filter("a is null").select("table", F.lit(1).alias("place"), "doc_id", *COUNTS, "digest", "n_pairs", "keys", "code", "mult")
    both = totals.unionByName(batches, allowMissingColumns=True).repartition("table").sortWithinPartitions("table", "place", "pair")
    return both.mapInArrow(_score(arrow), f"doc_id {sql}, {', '.join(f'{c} bigint' for c in RESULT[:-1])}, groups_sha256 string")
