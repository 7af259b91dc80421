import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")

import tiktoken  # noqa: E402

from estatelens.llm import bitplanes, bpe, queries  # noqa: E402
from estatelens.llm.common import scratch_path  # noqa: E402

RANKS, PATTERN = queries.tokenizer("byte_bpe_multi_50k.tiktoken")
JSON = queries.tokenizer("byte_bpe_50k.json")[0]


def tik():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def pack(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def brute_json(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab \n\t'-=.1é 　"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_encoders_equal_the_libraries(text):
    assert bpe.rank_encoder(RANKS, PATTERN)(text) == pack(tik().encode_ordinary(text))
    assert bpe.file_encoder(JSON, PATTERN)(text) == pack(brute_json(text))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.one_of(st.sampled_from("ab \n\t'-=.1é 　"), st.characters(exclude_categories=["Cs"])), max_size=30)), max_size=8),
       st.integers(1, 6))
def test_batches_equal_single_texts(texts, entries):
    import pyarrow as pa
    assert bpe.file_batches(JSON, PATTERN)(pa.array([*texts, "a<|endoftext|>b"], pa.string())) == [bpe.file_encoder(JSON, PATTERN)(t) for t in [*texts, "a<|endoftext|>b"]]
    for lead in (False, True):
        small = bpe.BatchEncoder(bpe.plain_pieces(JSON, PATTERN), lead=lead, entries=entries)
        for _ in range(2):
            ids, n = small(pa.array(texts, pa.string()))
            want = [brute_json(" " * lead + t) if t else [] for t in texts]
            assert ids.tolist() == [x for w in want for x in w] and n.tolist() == [len(w) for w in want]


@pytest.mark.parametrize("unit", ["a", "ab", " ", "=", "ha", "th", "\n", "-", "0", "é"])
def test_repeated_parts(unit):
    for n in range(1, 70):
        assert bpe.rank_encoder(RANKS, PATTERN)(unit * n) == pack(tik().encode_ordinary(unit * n))


def test_tables_that_start_anew_change_nothing():
    enc = bpe.PieceEncoder(PATTERN, bpe.rank_encoder(RANKS, PATTERN).encode_piece, entries=4)
    text = "one two three four five six, seven. eight\nnine ten one two three"
    assert enc(text) == enc(text) == pack(tik().encode_ordinary(text))


def test_tables_are_bounded_by_characters():
    enc = bpe.PieceEncoder(PATTERN, bpe.rank_encoder(RANKS, PATTERN).encode_piece, chars=300)
    for k in range(40):
        text = f"start line{k}\n" + "x" * 20 + f"{k}-no-space-in-here, then {'long' * 30}{k}"
        assert enc(text) == pack(tik().encode_ordinary(text))
        assert sum(map(len, enc.words)) == enc.word_chars <= 300 + len(text) and sum(map(len, enc.pieces)) == enc.piece_chars <= 300 + len(text)


def test_op1(make_docs, edge_rows):
    tokens = bpe.encode(make_docs(edge_rows), RANKS, PATTERN, offsets=True)
    got = bpe.decode(tokens, RANKS).select("doc_id", "ids", "decoded", "starts", "ends", *bpe.digests()).collect()
    want = sorted((str(i), tik().encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in edge_rows)
    rows = sorted((str(r.doc_id), np.frombuffer(bytes(r.ids), "<u4").tolist(), bytes(r.decoded)) for r in got)
    assert rows == want
    for r in got:
        assert r.n_tokens == len(r.ids) // 4 and r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()
        text, table = bytes(r.decoded).decode(), bpe.token_bytes(RANKS)
        for k, s, e in zip(np.frombuffer(bytes(r.ids), "<u4"), r.starts, r.ends):
            assert table.bytes_of(np.array([k])).tobytes() in text[s:e].encode()


def test_decode_handles_split_characters_and_unknown_ids(spark):
    ids = tik().encode_ordinary("\U0001f468‍\U0001f469 é")
    df = spark.createDataFrame([(1, bytearray(pack([*ids, 4_000_000]))), (2, None), (3, bytearray())], "doc_id long, ids binary")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()}
    assert got == {1: "\U0001f468‍\U0001f469 é".encode(), 2: b"", 3: b""}


@pytest.mark.parametrize("bits", [False, True])
def test_op3(spark, make_docs, edge_rows, bits):
    path = scratch_path(spark, "test")
    bitplanes.write(make_docs(edge_rows).repartition(3), path, JSON, PATTERN, chunk_ids=1000, bits=bits)
    rows = bitplanes.read(spark, path).collect()
    order = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, *_ in edge_rows), key=lambda i: (i is not None, i or 0))
    at, want = 0, {}
    for i, t, *_ in edge_rows:
        want.setdefault(i, []).append(pack([*brute_json(t or ""), 0]))
    for r in order:
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in [(len(b) // 4, zlib.crc32(b)) for b in want[r.doc_id]]
    index = spark.read.parquet(f"{path}/index").collect()
    assert all(len(r.plane_bytes) == (32 if bits else 4) and r.n_ids <= 1000 for r in index) and sum(r.n_ids for r in index) == at


def test_planes_and_crc_join():
    r = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = r.integers(0, 1 << 32, n, dtype="u4")
        for bits in (False, True):
            assert (bitplanes.join_planes(bitplanes.split_planes(ids, bits), n) == ids).all()
        raw = ids.tobytes()
        for cut in (0, 1, len(raw) // 2, len(raw)):
            assert bitplanes.join_crc(zlib.crc32(raw[:cut]), zlib.crc32(raw[cut:]), len(raw) - cut) == zlib.crc32(raw)


def test_empty_tables(spark, make_docs):
    assert bpe.decode(bpe.encode(make_docs([]), RANKS, PATTERN), RANKS).count() == 0
    path = scratch_path(spark, "test")
    bitplanes.write(make_docs([]), path, JSON, PATTERN)
    assert bitplanes.read(spark, path).count() == 0


def added_json(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "one two <|endoftext|> three, four<|endoftext|>\n", "<|endoftext", "a <|endoftext|"])
def test_added_tokens_of_the_file(text):
    assert bpe.file_encoder(JSON, PATTERN)(text) == pack(added_json(text))
    assert ("<|endoftext|>" in text) == (added_json(text) != brute_json(text))


def test_op3_added_tokens(spark, make_docs):
    path = scratch_path(spark, "test")
    texts = ["one <|endoftext|> two", "three"]
    bitplanes.write(make_docs(list(enumerate(texts))), path, JSON, PATTERN)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in bitplanes.read(spark, path).collect()}
    want = [pack([*added_json(t), 0]) for t in texts]
    assert got == {0: (0, len(want[0]) // 4, zlib.crc32(want[0])), 1: (len(want[0]) // 4, len(want[1]) // 4, zlib.crc32(want[1]))}
