"""Repeated byte strings against a plain dictionary of all windows."""
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelens.llm import queries, suffix_dedup


def plain(texts, length):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for k, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            seen.setdefault(r[p:p + length], []).append((k, p))
    gone = [np.zeros(len(r), bool) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                gone[k][p:p + length] = True
    out = []
    for r, g in zip(raw, gone):
        kept = np.frombuffer(r, "u1")[~g].tobytes()
        out.append((len(r), int(g.sum()), int(np.diff(g.astype(int), prepend=0).clip(0).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=30, max_size=200).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 12), st.integers(1, 5))
def test_suffix_sort(data, length, kinds):
    d = np.frombuffer(data, "u1")
    place = np.random.default_rng(len(data)).permutation(len(d) - length + 1)
    kind = np.sort(place % kinds)
    order, equal = suffix_dedup.suffix_sort(d, place, kind, length)
    assert sorted(order.tolist()) == list(range(len(place))) and (kind[order] == kind).all()
    words = [data[place[k]:place[k] + length] for k in order]
    for k in range(1, len(words)):
        if kind[k] == kind[k - 1]:
            assert words[k - 1] <= words[k] and equal[k] == (words[k] == words[k - 1])
        else:
            assert not equal[k]


def test_a_collision_starts_the_sort_anew(monkeypatch):
    real = suffix_dedup.PrefixHash.__call__
    tries = []

    def weak(self, start, length):
        h = real(self, start, length)
        return h if self.attempt else h & np.uint64(3)

    def init(self, data, attempt=0, real_init=suffix_dedup.PrefixHash.__init__):
        real_init(self, data, attempt)
        self.attempt = attempt
        tries.append(attempt)
    monkeypatch.setattr(suffix_dedup.PrefixHash, "__init__", init), monkeypatch.setattr(suffix_dedup.PrefixHash, "__call__", weak)
    d = np.random.default_rng(1).integers(0, 256, 400).astype("u1")
    place = np.arange(380)
    order, equal = suffix_dedup.suffix_sort(d, place, np.zeros(380, "i8"), 20)
    assert tries == [0, 1] and [bytes(d[p:p + 20]) for p in place[order]] == sorted(bytes(d[p:p + 20]) for p in place) and not equal.any()


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 300)
    r = random.Random(2)
    part = bytes(r.randrange(4) for _ in range(700))
    data = b"xyz" * 30 + part + b"q" * 77 + part[100:]
    lo, shape, gram, context = suffix_dedup.anchors(data, np.array([len(data)]), 50, 10)
    owner = {}
    for s, x, g in zip(lo.tolist(), shape.tolist(), gram.tolist()):
        for k in range(x % 1024):
            assert s + k not in owner
            owner[s + k] = (g, x // 1024 - k)
            assert 0 <= x // 1024 - k <= 40
    assert sorted(owner) == list(range(len(data) - 49))
    by = {}
    for p, o in owner.items():
        assert by.setdefault(data[p:p + 50], o) == o


def texts(seed, n=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 7))) for _ in range(400)]
    prose = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared = [prose(k) for k in (3, 8, 9, 10, 12, 30, 60)]
    out = [" ".join(x for x in (prose(r.randint(0, 25)), r.choice(shared), prose(r.randint(0, 25)), r.choice(shared) if r.random() < .4 else "") if x) for _ in range(n)]
    out += [out[3]] * 9 + [out[4][:-5]] * 3 + [None, "", "a" * 500, "ab" * 120, "aaa", prose(4000)]
    out[20] = out[20] + out[20]
    return out


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block_bytes": 300}), (3, {"wide": 2, "block_bytes": 2000}), (4, {"wide": 0}), (6, {"wide": 0, "share_windows": 500, "block_bytes": 700}), (5, {"sample": 1, "block_bytes": 900})])
def test_documents_equal_plain(spark, make_docs, seed, options):
    t = texts(seed)
    rows = [(k % 100 if k % 7 else None, x) for k, x in enumerate(t)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(make_docs(rows), length=40, gram=12, **options).collect())
    assert got == sorted((str(i), *p) for (i, _), p in zip(rows, plain(t, 40)))


def test_edge_rows_and_remaining_texts(spark, make_docs, edge_rows):
    want = plain([r[1] for r in edge_rows], 200)
    got = suffix_dedup.remove_repeats(make_docs(edge_rows), texts=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted((str(r[0]), *w) for r, w in zip(edge_rows, want))
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0


def test_query_equals_plain(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_suffix_dedup(spark, d).collect()}
    assert got == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows], 200))) and any(v[1] for v in got.values())
