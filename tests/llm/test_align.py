"""Alignment of two tokenizers against the libraries and plain loops."""
import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")

from estatelens.llm import align, bpe, queries  # noqa: E402

SIDE_A, SIDE_B = queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("piece_bpe_32k.model")[:1]
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(SIDE_A[0])
    t.encode_special_tokens = True
    back = {c: b for b, c in bpe.byte_table().items()}
    s = sentencepiece.SentencePieceProcessor(model_file=SIDE_B[0])
    return t, back, s


def tokens(text, t, back, s):
    """(id, bytes) of both sides by the libraries on whole texts, or nothing."""
    if not text:
        return [], []
    a = [(k, bytes(back[c] for c in t.id_to_token(k))) for k in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(k, bytes([int(s.id_to_piece(k)[3:5], 16)]) if s.is_byte(k) else s.id_to_piece(k).replace("▁", " ").encode()) for k in s.encode(text)]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def plain(texts):
    lib = libraries()
    docs, holds = [], Counter()
    for text in texts:
        a, b = tokens(text, *lib)
        groups, i, j, ga, gb, ea, eb = [], 0, 0, [], [], 0, 0
        while i < len(a) or j < len(b):
            if ea <= eb and i < len(a):
                ga.append(a[i][0])
                ea += len(a[i][1])
                i += 1
            else:
                gb.append(b[j][0])
                eb += len(b[j][1])
                j += 1
            if ea == eb and ga and gb:
                groups.append((ga, gb))
                ga, gb = [], []
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        holds.update(links.keys())
        docs.append((a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    out = []
    for a, b, groups, links in docs:
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if holds[p] == most[p[0]]),
                    sum(n * holds[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.one_of(st.sampled_from("ab \n\t'-=.1é 　▁<>"), st.characters(exclude_categories=["Cs"])), max_size=40)), max_size=6))
def test_batch_equals_the_libraries(texts):
    got = align.align_batch(pa.array(texts, pa.string()), align.byte_side(*SIDE_A), align.piece_side(*SIDE_B))
    want = plain(texts)
    assert [tuple(int(got[c][k]) for c in FIELDS[:4]) + (got["digest"][k],) for k in range(len(texts))] == [(*w[:4], w[6]) for w in want]


def test_small_tables_change_nothing():
    texts = pa.array(["one two  three", " lead", "x\ny z.", "one two", "a" * 50 + " b", "\t tab"], pa.string())
    small = align.PieceBatches(align.piece_side(*SIDE_B)[0].model)
    small.entries = 2
    ids, n = small(texts)
    assert ids.tolist() == [x for t in texts.to_pylist() for x in small.model.encode(t)]


def test_a_wide_group_gives_every_pair_once(monkeypatch):
    texts = ["=" * 300 + " word \n\n\n" + "ab" * 40, "ünïcödé " * 20]
    want = plain(texts)
    for limit in (0, 10 ** 9):
        monkeypatch.setattr(align, "WIDE_GROUP", limit)
        got = align.align_batch(pa.array(texts), align.byte_side(*SIDE_A), align.piece_side(*SIDE_B))
        assert got["n_links"].tolist() == [w[3] for w in want] and got["mult"].sum() == sum(w[3] for w in want)
        assert len(set(zip([0] * got["n_pairs"][0] + [1] * got["n_pairs"][1], got["code"].tolist()))) == len(got["code"])


@pytest.mark.parametrize("batch,pairs", [(2_000_000, 2_000_000), (200, 30)])
def test_documents_equal_plain(make_docs, edge_rows, batch, pairs):
    rows = [(i, t if t is None else t[:60_000]) for i, t, *_ in edge_rows] + [(20, "<|endoftext|> <s> </s> <unk>"), (21, "has ▁ mark"), (22, "x"), (23, " "), (24, "\n")]
    rows += [(30 + k, f"common words here and number {k} " + "again " * (k % 3)) for k in range(40)]
    got = sorted((r.doc_id if r.doc_id is not None else -1, *[r[c] for c in FIELDS]) for r in align.align(make_docs(rows), SIDE_A, SIDE_B, batch, pairs).collect())
    want = sorted((-1 if i is None else i, *w) for (i, _), w in zip(rows, plain([t for _, t in rows])))
    assert got == want


def test_no_documents(make_docs):
    assert align.align(make_docs([]), SIDE_A, SIDE_B).count() == 0


def test_query_equals_plain(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in FIELDS) for r in queries.op12_alignment(spark, d).collect()}
    assert got == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows])))
