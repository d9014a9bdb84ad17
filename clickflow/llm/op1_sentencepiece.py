"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed here; from its pieces, scores and specs a
tokenizers pipeline is built: the normaliser's character map, white-space handling and
metaspace marker, a unigram model with the pieces' scores or a BPE model whose merges
follow from them, and byte fallback.  Batches are encoded by the library on the threads
that ``RAYON_NUM_THREADS`` allows.  White space only ever begins a piece in such
models (``split_at_marker`` is checked against the pieces), so each distinct word is
encoded once; the others get the whole text.

Parity: the sentencepiece library also normalises each text and encodes each distinct
word met, whatever its markers and the model's character map.  Pieces never reach over
words, so equal words in an equal normalised text make an equal text; only runs of unknown
characters do, so without byte fallback the normalised texts are encoded whole as well (in
stretches of about ``STRETCH`` characters that end with a word).
``n_parity_errors`` counts a document's words that differ; it is 1 where only the
normalised or the whole text does.  Decoding is checked per document: ``round_trip`` says
that the ids decode to the normalised text.

Nulls and edges: a null or empty text has no ids; null doc_ids, repeated rows and very
long texts are like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, types as T

from . import common

MARK = "▁"
#: Fixed values of the model file's format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: A normaliser spec that leaves a text as it is: no map, no marker in front, no white space removed.
#: Behind a model file's fields it takes the place of the file's own.
AS_IT_IS = b"\x1a\x08\x12\x00\x18\x00\x20\x00\x28\x01"
#: Characters of a normalised text that the sentencepiece library encodes at a time.
STRETCH = 1_000_000
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("n_parity_errors", T.LongType()),
    T.StructField("round_trip", T.BooleanType()), T.StructField("ids", T.BinaryType())])


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields; fixed-width ones as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """Pieces and specs of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        norm: dict = {}
        for number, value in fields(data):
            if number == 1:
                p = dict(fields(value))
                self.pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p.get(2, bytes(4)))[0], p.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                norm = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix_space = bool(trainer.get(24, 0))
        self.unk = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.charsmap = norm.get(2, b"")
        self.dummy_prefix, self.squeeze, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} has no counterpart")
        if self.suffix_space or not self.escape:
            raise ValueError("white space as a suffix or unescaped isn't supported")
        #: No piece has the marker after another character: a marker always starts a word.
        self.split_at_marker = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, t in self.pieces if t in (NORMAL, USER_DEFINED))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score first."""
        ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t in (NORMAL, USER_DEFINED)}
        out = []
        for p, i in ids.items():
            out += [(-self.pieces[i][1], i, ids[p[:k]], p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        return [(a, b) for *_, a, b in sorted(out)]


def build(data: bytes):
    """(model, tokenizer): the tokenizers pipeline of a model file."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    m = Model(data)
    # control pieces can't be typed: a space never occurs in normalised text
    named = [(p if t in (NORMAL, USER_DEFINED, BYTE, UNKNOWN) else f" {p}", s) for p, s, t in m.pieces]
    if m.kind == UNIGRAM:
        named = [(p if t != UNKNOWN else f" {p}", s) for (p, s), (_, _, t) in zip(named, m.pieces)]
        tok = Tokenizer(models.Unigram(named, unk_id=m.unk, byte_fallback=m.byte_fallback))
    else:
        tok = Tokenizer(models.BPE({p: i for i, (p, _) in enumerate(named)}, m.merges(), unk_token=named[m.unk][0],
                                   fuse_unk=True, byte_fallback=m.byte_fallback))
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps += [normalizers.Prepend(" ")]
    tok.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if m.split_at_marker:
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return m, tok


def stretches(text: str, words: list[str]) -> list[str]:
    """`text`, if long in parts of about STRETCH characters; `words` are its words."""
    if len(text) <= STRETCH:
        return [text]
    return ["".join(words[lo:hi]) for lo, hi in common.chunks(words, STRETCH)]


class Coder:
    """Encoder and decoder of one model file, with parity counts by word."""

    WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, path: str):
        import sentencepiece
        from tokenizers import normalizers

        with open(path, "rb") as f:
            data = f.read()
        self.model, self.tok = build(data)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.of_normalized = sentencepiece.SentencePieceProcessor(model_proto=data + AS_IT_IS)
        self.normalize = self.tok.normalizer.normalize_str
        self._plain = not self.model.charsmap and not self.model.squeeze and self.model.dummy_prefix
        _, self._inner = build(data)
        self._inner.normalizer = normalizers.Sequence([])
        self.bad: set[str] = set()
        self._cache = common.PieceCache(self._encode_words, 100_000_000)
        self._bytes = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else p.encode() for p, _, t in self.model.pieces]

    def normalized(self, text: str) -> str:
        if self._plain:
            return MARK + text.replace(" ", MARK) if text else ""
        return self.normalize(text)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        got = [e.ids for e in self._inner.encode_batch_fast(words, add_special_tokens=False)]
        want = self.of_normalized.encode(words, num_threads=1) if words else []
        self.bad = {*(w for w in self.bad if w in self._cache._ids), *(w for w, x, y in zip(words, got, want) if x != y)}
        return [common.packed(x) for x in got]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, int, str]]:
        """(ids, parity errors, normalised text) of each text."""
        norm = [self.normalized(t) if t else "" for t in texts]
        if not self.model.split_at_marker:
            got = [e.ids for e in self.tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
            want = self.reference.encode([t or "" for t in texts], num_threads=1)
            return [(common.packed(a), int(a != b), n) for a, b, n in zip(got, want, norm)]
        lists = [self.WORD.findall(n) for n in norm]
        ids = self._cache.load(lists)
        got = [b"".join([ids[w] for w in ws]) for ws in lists]
        bad = self.bad
        errors = [sum(w in bad for w in ws) if bad else 0 for ws in lists]
        differ = [x != n for x, n in zip(self.reference.normalize([t or "" for t in texts]), norm)]
        if not self.model.byte_fallback:
            differ = [d or x != i for d, x, i in zip(differ, self.whole(norm, lists), got)]
        return [(i, e or int(d), n) for i, e, d, n in zip(got, errors, differ, norm)]

    def whole(self, norm: list[str], lists: list[list[str]]) -> list[bytes]:
        """Ids of normalised texts by the sentencepiece library."""
        parts = [stretches(n, ws) for n, ws in zip(norm, lists)]
        got = iter(self.of_normalized.encode([x for p in parts for x in p], num_threads=1))
        return [b"".join([array("I", next(got)).tobytes() for _ in p]) for p in parts]

    def decode_normalized(self, ids: np.ndarray) -> str:
        table = self._bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; that of a normalised text when they came from one."""
        text = self.decode_normalized(ids).replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per document: ids (little-endian unsigned 32-bit), their count and
    crc32, parity errors, and whether they decode to the normalised text."""
    def per_batch(keys: list, texts: list) -> Iterator[tuple]:
        c = coder(model_path)
        for lo, hi in common.chunks(texts):
            got = c.encode(texts[lo:hi])
            same = [c.decode_normalized(np.frombuffer(ids, dtype="<u4")) == n for ids, _, n in got]
            yield (keys[lo:hi], [len(x) // 4 for x, _, _ in got], [zlib.crc32(x) for x, _, _ in got],
                   [e for _, e, _ in got], same, [x for x, _, _ in got])

    return common.map_texts(common.text_rows(docs), per_batch, SCHEMA)


def decode(df: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of a column of ids as `encode` gives them (null ids: null text)."""
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("text", T.StringType())])

    def per_batch(keys: list, values: list) -> Iterator[tuple]:
        c = coder(model_path)
        yield keys, [None if x is None else c.decode(np.frombuffer(x, dtype="<u4")) for x in values]

    return common.map_texts(df.select(key, ids), per_batch, schema)
