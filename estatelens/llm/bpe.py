"""Byte-level BPE encoding and decoding with the tokenizers library.

``encode(docs)`` maps every whole text to its token ids; ``decode(tokens)``
maps ids back to bytes. Both run over Arrow batches inside Spark tasks and
never shuffle.

A text is cut into the pieces of the public pattern; each piece becomes the
characters of the byte table (every byte has one printable character) and is
merged by the tokenizers library. Pieces repeat very often, so a task keeps a
bounded table piece -> ids and calls the library for new pieces only. A single
space between two non-space characters always starts a new piece, so a text is
first cut there, which needs no regular expression for words seen before.

Defined results: a null or empty text has no tokens; an id outside the
vocabulary and a null id list decode to no bytes; offsets of a token that holds
only part of a character cover that whole character.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.common import prepare

#: Code points with the Unicode property White_Space (fixed values).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries a task keeps in each of its two tables before it starts them anew.
CACHE_ENTRIES = 400_000
#: Code points of all keys of such a table; texts without spaces have few, but very long ones.
CACHE_CHARS = 8_000_000
#: The encoder of a file of ranks shares its worker with the network and the fingerprints of the pipeline, so its tables are smaller by this.
RANK_SHARE = 4


@functools.cache
def byte_table() -> dict[int, str]:
    """Byte -> printable character: printable Latin-1 stays, the rest follows from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def older_half(table: dict) -> dict:
    """The entries that came first: frequent words turn up early, so these are the ones worth keeping."""
    return dict(itertools.islice(table.items(), len(table) // 2))


class PieceEncoder:
    """Whole text -> ids as little-endian unsigned 32-bit bytes, piece by piece."""

    def __init__(self, pattern: str, encode_piece: Callable[[str], list[int]], entries: int = CACHE_ENTRIES, chars: int = CACHE_CHARS):
        self.find = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")).findall
        self.encode_piece, self.entries, self.chars = encode_piece, entries, chars
        self.piece_chars = self.word_chars = 0
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes | bool] = {}     # text after a space -> ids with that space; False: not cut here

    def _ids(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            while self.pieces and (len(self.pieces) >= self.entries or self.piece_chars >= self.chars):
                self.pieces = older_half(self.pieces)
                self.piece_chars = sum(map(len, self.pieces))
            ids = self.encode_piece(piece)
            got = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
            self.piece_chars += len(piece)
        return got

    def whole(self, text: str) -> bytes:
        """Every piece of the text, without the cut at single spaces."""
        return b"".join(map(self._ids, self.find(text)))

    @staticmethod
    def _cut_here(part: str) -> bool:
        """Whether single spaces around this part begin pieces; str.isspace covers White_Space and four controls more."""
        return part != "" and not part[0].isspace() and not part[-1].isspace()

    def _add_words(self, parts: list[str]) -> None:
        while self.words and (len(self.words) >= self.entries or self.word_chars >= self.chars):
            self.words = older_half(self.words)
            self.word_chars = sum(map(len, self.words))
        for p in parts:
            if p not in self.words:
                self.word_chars += len(p)
                if p.isalpha():
                    self.words[p] = self._ids(" " + p)
                elif p[:-1].isalpha() and p[-1] in ".,;:!?":
                    self.words[p] = self._ids(" " + p[:-1]) + self._ids(p[-1])
                else:
                    self.words[p] = self._cut_here(p) and self.whole(" " + p)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = text.split(" ")
        if len(parts) == 1 or not self._cut_here(parts[0]):
            return self.whole(text)
        head = self.whole(parts[0])
        del parts[0]
        self._add_words(parts)
        try:
            return head + b"".join(map(self.words.__getitem__, parts))
        except TypeError:                            # white space beside a space
            return self.whole(text)


class Units(NamedTuple):
    """Texts cut into units: their distinct keys, the key of every unit, each text's first unit, whether a text is empty."""
    keys: list[str]
    which: np.ndarray
    begin: np.ndarray
    empty: np.ndarray


def units(texts: pa.Array, lead: bool) -> Units:
    """Cut at single spaces between characters that are no white space. A key is the word after its space, or behind a tab the unit as it is."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return Units([], np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, bool))
    split = pc.split_pattern(texts, " ")
    words = split.flatten().dictionary_encode()
    word = words.indices.to_numpy(zero_copy_only=False)
    names = words.dictionary
    begin = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)))).astype("i8")
    some = pc.not_equal(names, "")
    opens = pc.and_(some, pc.equal(pc.utf8_ltrim_whitespace(names), names)).to_numpy(zero_copy_only=False)
    closes = pc.and_(some, pc.equal(pc.utf8_rtrim_whitespace(names), names)).to_numpy(zero_copy_only=False)
    starts = np.empty(len(word), bool)                # parts that begin a unit
    starts[1:] = closes[word[:-1]] & opens[word[1:]]
    starts[begin[:-1]] = True
    at = np.flatnonzero(starts)
    size = np.diff(np.append(at, len(word)))
    own = size > 1                                    # units that are not one word after a space
    text_at = np.searchsorted(at, begin[:-1])
    own[text_at] |= ~opens[word[begin[:-1]]] if lead else True
    names = names.to_pylist()
    which = np.empty(len(at), "i8")
    plain = word[at[~own]]
    count = np.bincount(plain, minlength=len(names))
    used = np.flatnonzero(count)
    which[~own] = (np.cumsum(count > 0) - 1)[plain]
    keys = [names[k] for k in used.tolist()]
    more: dict[str, int] = {}
    first = np.zeros(len(at), bool)
    first[text_at] = not lead
    for k in np.flatnonzero(own).tolist():
        a = at[k]
        key = ("\t" if first[k] else "\t ") + " ".join([names[w] for w in word[a:a + size[k]].tolist()])
        which[k] = more.setdefault(key, len(keys) + len(more))
    return Units(keys + list(more), which, text_at, pc.equal(texts, "").to_numpy(zero_copy_only=False))


class BatchEncoder:
    """The ids of many texts at once, through one flat table of the ids of known words.

    Arrow cuts the texts at single spaces and numbers the words of the batch;
    each distinct word is looked up once and numpy copies the ids in order.
    Where white space stands beside such a space, the parts around it stay one
    unit. With ``lead`` every text is read as space + text.
    """

    def __init__(self, pieces: PieceEncoder, lead: bool = False, entries: int = 2 * CACHE_ENTRIES, chars: int = 2 * CACHE_CHARS):
        self.pieces, self.lead, self.entries, self.max_chars = pieces, lead, entries, chars
        self.slot: dict[str, int] = {}               # word after a space, or any unit behind a tab -> row of first and length
        self.mark: dict[str, list[int]] = {}
        self.chars = 0
        self.first, self.length, self.flat = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "<u4")

    def _halve(self) -> None:
        """Keep the words that came first; the frequent ones do."""
        while self.slot and (len(self.slot) >= self.entries or self.chars >= self.max_chars):
            keep = list(itertools.islice(self.slot, len(self.slot) // 2))
            self.slot = {w: k for k, w in enumerate(keep)}
            self.chars = sum(map(len, keep))
            self.first, self.length = self.first[:len(keep)], self.length[:len(keep)]
            self.flat = self.flat[:int(self.length.sum())]

    def _ids(self, key: str) -> list[int]:
        pieces = self.pieces
        if key.isalpha():
            return pieces.encode_piece(" " + key)
        if key[:-1].isalpha() and key[-1] in ".,;:!?":
            row = self.slot.get(key[:-1], -1)
            if 0 <= row < len(self.first):
                a = self.first[row]
                head = self.flat[a:a + self.length[row]].tolist()
            else:
                head = pieces.encode_piece(" " + key[:-1])
            end = self.mark.get(key[-1])
            if end is None:
                end = self.mark[key[-1]] = pieces.encode_piece(key[-1])
            return head + end
        return memoryview(pieces.whole(key[1:] if key[:1] == "\t" else " " + key)).cast("I").tolist()

    def new_ids(self, keys: list[str]) -> list[list[int]]:
        return [*map(self._ids, keys)]

    def rows(self, keys: list[str]) -> np.ndarray:
        """Rows of the keys; new ones are encoded and added."""
        self._halve()
        rows = np.array([*map(self.slot.get, keys, itertools.repeat(-1))], "i8")
        at = np.flatnonzero(rows < 0)
        if len(at):
            new = [keys[k] for k in at.tolist()]
            got = self.new_ids(new)
            n = np.array([*map(len, got)], "i8")
            rows[at] = len(self.slot) + np.arange(len(new))
            self.slot.update(zip(new, rows[at].tolist()))
            self.chars += sum(map(len, new))
            self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(n) - n))
            self.length = np.concatenate((self.length, n))
            self.flat = np.concatenate((self.flat, np.fromiter(itertools.chain.from_iterable(got), "<u4", int(n.sum()))))
        return rows

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each text has. A null or empty text has none."""
        return self.encode(units(texts, self.lead))

    def encode(self, cut: Units) -> tuple[np.ndarray, np.ndarray]:
        if not len(cut.begin):
            return np.zeros(0, "<u4"), np.zeros(0, "i8")
        row = self.rows(cut.keys)[cut.which]
        n = self.length[row]
        n[cut.begin[cut.empty]] = 0
        shift = self.first[row] - (np.cumsum(n) - n)
        ids = self.flat[np.arange(int(n.sum())) + np.repeat(shift, n)]
        return ids, np.add.reduceat(n, cut.begin)


def rank_merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens that joins to a token, by the rank of that token."""
    pairs = []
    for token, rank in ranks.items():
        splits = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        pairs += [(rank, ranks[a], ranks[b], a, b) for a, b in splits]
    pairs.sort()
    return [(a, b) for *_, a, b in pairs]


#: A part that comes again and begins a third time (aba|ba): only there can two joins to one token overlap.
OVERLAP = re.compile(r"(.)(.*?)\1\2\1", re.S)
#: Longer pieces are confirmed without looking for an overlap.
LONG_PIECE = 48


def _mapped(piece: str) -> str:
    """The bytes of the piece as characters of the byte table."""
    return piece.encode().decode("latin-1").translate(byte_table())


@functools.cache
def rank_encoder(path: str, pattern: str) -> PieceEncoder:
    """Encoder for a file of ranks: the tokenizers library merges each new piece.

    It numbers joins by pair, tiktoken by the joined token, leftmost first. The
    two can differ only where overlapping equal parts may join to one token in
    two ways; such a piece is confirmed with tiktoken, whose result holds.
    """
    import tiktoken
    from tokenizers import models

    ranks = read_ranks(path)
    chars = byte_table()
    text = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
    model = models.BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=[(text[a], text[b]) for a, b in rank_merges(ranks)],
                       ignore_merges=True, cache_capacity=0)
    confirm = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def encode_piece(piece: str) -> list[int]:
        mapped = _mapped(piece)
        if len(mapped) > LONG_PIECE or OVERLAP.search(mapped):
            return confirm(piece)
        return [x.id for x in model.tokenize(mapped)]
    return PieceEncoder(pattern, encode_piece, CACHE_ENTRIES // RANK_SHARE, CACHE_CHARS // RANK_SHARE)


def plain_pieces(path: str, pattern: str) -> PieceEncoder:
    """Pieces of a byte-level file of the tokenizers library; strings of added tokens are ordinary text."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    model._resize_cache(0)
    space = byte_table()[0x20]

    def encode_piece(piece: str) -> list[int]:
        word = piece[1:]
        return [x.id for x in model.tokenize(space + word if piece[0] == " " and word.isalpha() and word.isascii() else _mapped(piece))]
    return PieceEncoder(pattern, encode_piece)


@functools.cache
def file_encoder(path: str, pattern: str) -> Callable[[str | None], bytes]:
    """Encoder for a byte-level file of the tokenizers library; the strings of its added tokens are these tokens."""
    from tokenizers import Tokenizer

    tokenizer, pieces = Tokenizer.from_file(path), plain_pieces(path, pattern)
    added = tokenizer.get_added_tokens_decoder()
    if not added:
        return pieces
    ids = {t.content: struct.pack("<I", k) for k, t in added.items()}
    cut = re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")")
    plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())

    def encode(text: str | None) -> bytes:
        if not text or not cut.search(text):
            return pieces(text)
        if not plain:                                # tokens that take white space or need a word's end: the library's own step
            got = tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(got)}I", *got)
        return b"".join(ids[x] if k % 2 else pieces(x) for k, x in enumerate(cut.split(text)))
    return encode


@functools.cache
def file_batches(path: str, pattern: str) -> Callable[[pa.Array], list[bytes]]:
    """As ``file_encoder``, for an array of texts at once."""
    from tokenizers import Tokenizer

    batch = BatchEncoder(plain_pieces(path, pattern))
    added = [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]

    def encode(texts: pa.Array) -> list[bytes]:
        holds = functools.reduce(pc.or_, [pc.match_substring(texts, t) for t in added], pa.array(np.zeros(len(texts), bool)))
        ids, n = batch(pc.if_else(pc.fill_null(holds, False), None, texts))
        raw, end = ids.astype("<u4").tobytes(), (4 * np.cumsum(n)).tolist()
        out = [raw[a:b] for a, b in zip([0, *end], end)]
        for k in np.flatnonzero(pc.fill_null(holds, False).to_numpy(zero_copy_only=False)).tolist():
            out[k] = file_encoder(path, pattern)(texts[k].as_py())
        return out
    return encode


class TokenBytes:
    """The reversed byte table: the bytes of every id, end to end, with first byte and length."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, r in ranks.items():
            tokens[r] = t
        self.length = np.array([len(t) for t in tokens], dtype="i8")
        self.first = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), dtype="u1")

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """A character split over tokens comes together again, as only bytes are joined."""
        ids = ids[ids < len(self.length)]
        n = self.length[ids]
        shift = self.first[ids] - (np.cumsum(n) - n)
        return self.flat[np.arange(int(n.sum())) + np.repeat(shift, n)]


@functools.cache
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(read_ranks(path))


def char_offsets(ids: np.ndarray, tokens: TokenBytes) -> tuple[np.ndarray, np.ndarray, int]:
    """First and end code point of each token, and how many tokens begin or end inside a character."""
    if not len(ids):
        return np.zeros(0, "i8"), np.zeros(0, "i8"), 0
    raw = tokens.bytes_of(ids)
    ends = np.cumsum(tokens.length[ids])
    starts = np.concatenate(([0], ends[:-1]))
    first = (raw & 0xC0) != 0x80
    char = np.cumsum(first) - 1
    split = ~first[starts] | ~np.append(first, True)[ends]
    return char[starts], char[ends - 1] + 1, int(split.sum())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           offsets: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` (binary, little-endian unsigned 32 bit) for every row of ``docs``.

    With ``offsets`` also ``starts`` and ``ends`` (arrays of code points) and
    ``n_split`` (tokens that begin or end inside a character).
    """
    prepare(docs.sparkSession)
    cols = [docs[c] for c in keep]
    extra = ", starts array<bigint>, ends array<bigint>, n_split bigint" if offsets else ""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", ids binary" + extra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(ranks_path, pattern)
        table = token_bytes(ranks_path)
        for b in batches:
            ids = [enc(t) for t in b.column(len(keep)).to_pylist()]
            out = [*b.columns[:len(keep)], pa.array(ids, pa.binary())]
            names = [*keep, "ids"]
            if offsets:
                got = [char_offsets(np.frombuffer(x, "<u4"), table) for x in ids]
                out += [pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.int64())),
                        pa.array([g[2] for g in got], pa.int64())]
                names += ["starts", "ends", "n_split"]
            yield pa.RecordBatch.from_arrays(out, names)
    return docs.select(*cols, docs[text].alias("__text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary) to every row of ``tokens``."""
    names = tokens.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks_path)
        for b in batches:
            got = [table.bytes_of(np.frombuffer(x or b"", "<u4")).tobytes() for x in b.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], [*names, "decoded"])
    return tokens.mapInArrow(run, schema)


def digests() -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256 of a decoded frame."""
    return [(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]
