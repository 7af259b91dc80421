"""Language identification with a byte convolutional network.

Filters of width 2, 3 and 4 slide over the bytes of a fixed-length window, each
filter keeps its maximum, and a softmax turns these into languages. It is
trained in numpy on windows of a bounded number of labelled documents per
language and applied to all windows of every text, in batches.

As the input is one byte out of 256, a filter is a table lookup per position;
for prediction the tables of two neighbouring bytes are added up beforehand,
in 16-bit integers.

Defined results: null text and text without a letter get ``und`` and score 0,
as does every text if no row is labelled; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.common import prepare

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Labelled documents per language, and windows of each, that the network is trained on.
TRAIN_DOCS = 800
TRAIN_WINDOWS = 3
EPOCHS = 12
#: Windows in one step of a prediction.
BATCH = 512
UNKNOWN = "und"
#: A window is explained by a language that has this probability; ``accepted`` asks for this share of explained windows.
MIN_SCORE = 0.5
MIN_KNOWN = 0.5
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def windows(raw: bytes) -> np.ndarray:
    """All bytes of a text as rows of ``WINDOW`` bytes, the last one padded with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, dtype="u1")
    out[:len(raw)] = np.frombuffer(raw, "u1")
    return out.reshape(n, WINDOW)


class Network:
    """Convolution tables per width and offset, output weights, and the languages."""

    def __init__(self, langs: list[str], seed: int = 5):
        r = np.random.default_rng(seed)
        self.langs = langs
        self.tables = {w: r.normal(0, 0.3, (w, 256, FILTERS)).astype("f4") for w in WIDTHS}
        self.out = r.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype("f4")
        self.bias = np.zeros(len(langs), dtype="f4")

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter over the window, and its position."""
        best, where = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            z = sum(self.tables[w][j][x[:, j:j + n]] for j in range(w))
            at = z.argmax(axis=1)
            where.append(at), best.append(np.take_along_axis(z, at[:, None, :], axis=1)[:, 0])
        return np.concatenate(best, axis=1), np.concatenate(where, axis=1)

    def softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 64, seed: int = 9) -> Network:
        """Adam; each language weighs the same however many windows it has."""
        r = np.random.default_rng(seed)
        weight = (len(y) / (len(self.langs) * np.maximum(1, np.bincount(y, minlength=len(self.langs)))))[y]
        params = [*self.tables.values(), self.out, self.bias]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), batch):
                pick = order[lo:lo + batch]
                xb = x[pick]
                h, at = self.pooled(xb)
                d = self.softmax(h)
                d[np.arange(len(pick)), y[pick]] -= 1
                d = (d * weight[pick, None] / len(pick)).astype("f4")
                dh = d @ self.out.T
                grads = []
                rows, cols = np.arange(len(pick))[:, None], np.arange(FILTERS)[None, :]
                for k, w in enumerate(WIDTHS):
                    part = slice(k * FILTERS, (k + 1) * FILTERS)
                    g = np.zeros_like(self.tables[w])
                    for j in range(w):
                        np.add.at(g[j], (xb[rows, at[:, part] + j], cols), dh[:, part])
                    grads.append(g)
                grads += [h.T @ d, d.sum(axis=0)]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.99 * v[i] + 0.01 * g * g
                    params[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
        return self


class Predictor:
    """A trained network with tables for byte pairs in 16-bit integers."""

    def __init__(self, net: Network):
        self.net = net
        top = max(float(np.abs(net.tables[w]).max(axis=(1, 2)).sum()) for w in WIDTHS)
        self.unit = np.float32(32_000 / max(top, 1e-6))
        q = {w: np.round(net.tables[w] * self.unit).astype("i2") for w in WIDTHS}
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65_536, FILTERS)
        self.parts = {w: [pair(q[w][j], q[w][j + 1]) if j + 1 < w else q[w][j] for j in range(0, w, 2)] for w in WIDTHS}

    def pooled(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype("i4") * 256 + x[:, 1:]
        best = []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            z = None
            for k, table in enumerate(self.parts[w]):
                at = pairs[:, 2 * k:2 * k + n] if 2 * k + 1 < w else x[:, 2 * k:2 * k + n]
                got = table.take(at, axis=0)
                z = got if z is None else np.add(z, got, out=z)
            best.append(z.max(axis=1))
        return np.concatenate(best, axis=1).astype("f4") / self.unit

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language and score of each text (probabilities of its windows, weighted by their bytes), and the share of windows that some language explains."""
        langs = self.net.langs
        raw = [t.encode() if t and langs and LETTER.search(t) else b"" for t in texts]
        total = np.zeros((len(texts), max(1, len(langs))))
        known = np.zeros(len(texts))
        held: list[np.ndarray] = []
        owner: list[tuple[int, int]] = []

        def flush() -> None:
            if held:
                p = self.net.softmax(self.pooled(np.concatenate(held)))
                at = 0
                for i, n in owner:
                    total[i] += p[at:at + n].sum(axis=0)
                    known[i] += (p[at:at + n].max(axis=1) >= MIN_SCORE).sum()
                    at += n
                held.clear(), owner.clear()

        waiting = 0
        for i, b in enumerate(raw):
            if b:
                w = windows(b)
                tail = len(b) % WINDOW
                if tail and len(w) > 1:
                    w[-1] = np.frombuffer(b[-WINDOW:], "u1")        # a full last window that overlaps the one before
                for lo in range(0, len(w), BATCH):
                    held.append(w[lo:lo + BATCH]), owner.append((i, len(held[-1])))
                    waiting += len(held[-1])
                    if waiting >= BATCH:
                        flush()
                        waiting = 0
        flush()
        out, score, share = [], [], []
        for i, b in enumerate(raw):
            share.append(float(known[i] / max(1, -(-len(b) // WINDOW))))
            if not b:
                out.append(UNKNOWN), score.append(0.0)
            else:
                p = total[i] / total[i].sum()
                k = int(p.argmax())
                out.append(langs[k]), score.append(float(min(1.0, p[k])))
        return out, score, share


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Network:
    """Train on at most ``train_docs`` documents of each language that are not held out.

    Chosen by a hash of id and text; each gives up to ``TRAIN_WINDOWS`` windows
    at hashed places.
    """
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    # Twice as many as needed pass a threshold on the hash, so that the window sees a bounded number of rows at any size.
    counts = docs.filter(usable).groupBy("lang").agg((2.0 * train_docs / F.count("*")).alias("share"))
    counts = F.broadcast(counts)                # a row for each output of the network; the texts stay where they are
    # by id and text, so that very many rows that share an id (or null) do not pass the threshold together
    place = F.pmod(F.xxhash64(F.lit("place"), "doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    rows = docs.select("lang", "doc_id", "text").filter(usable).join(counts, "lang").filter((place < F.col("share")) & F.col("text").rlike(r"\p{L}"))
    raw = F.col("text").cast("binary")
    space = F.greatest(F.lit(1), F.octet_length("text") - WINDOW + 1)
    cut = [F.substring(raw, (F.pmod(F.xxhash64(F.lit(k), "doc_id"), space) + 1).cast("int"), F.lit(WINDOW)) for k in range(TRAIN_WINDOWS)]
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), F.array_distinct(F.array(*cut)).alias("cut"))
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "cut"))).filter(F.col("n") <= train_docs)
    got = few.select("lang", F.explode("cut").alias("w")).collect()         # train_docs * TRAIN_WINDOWS * WINDOW bytes a language
    langs = sorted({r.lang for r in got})
    if not got:
        return Network([])
    got.sort(key=lambda r: (r.lang, bytes(r.w)))
    x = np.concatenate([windows(bytes(r.w)) for r in got])
    return Network(langs).train(x, np.array([langs.index(r.lang) for r in got]))


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``known``; only the text is looked at."""
    prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "known")]
    docs = docs.select(*[docs[f.name] for f in kept])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double, known double"
    at = [f.name for f in kept].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Predictor(net)
        for b in batches:
            lang, score, known = p.texts(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(known, pa.float64())],
                                             [*b.schema.names, "lang_pred", "score", "known"])
    return docs.mapInArrow(run, schema)


def accepted() -> Column:
    """Documents most of whose windows are in some language that the network knows, be it one or several."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("known") >= MIN_KNOWN)
