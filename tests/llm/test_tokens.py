"""Operators on token ids: SentencePiece codec (1), packing (4), Re-Pair files (6)."""

import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clickflow.llm import common, op1_sentencepiece as sp, op4_harmonic_packing as pack, op6_repair_ids as rp
from helpers import awkward_docs, empty_docs

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  two  spaces ", "a\nb\tc", "▁mark ▁▁", "été 漢字 😀 ẛ̣", "don't we'll 123", "x" * 300, "<s></s><unk><0x41>", "İ Σς ſ µ", " ́combining",
       "a\x1cb\x85c\x00d\x7f", "<|endoftext|> <|startoftext|>", "ends with space ", " line　sep"]


def whole_ids(texts):
    tok = Tokenizer.from_file(BPE)
    tok.encode_special_tokens = True
    return [e.ids for e in tok.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def test_words_give_the_ids_of_the_whole_text(spark):
    texts = ODD + [r.text or "" for r in common.table(spark, "/root/testdata/sf0.001", "documents").limit(150).collect()]
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in common.word_tokenizer(BPE).encode(texts)]
    assert got == whole_ids(texts)


WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\u017f]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\u017f\x09-\x0d\x20]+")


def test_pieces_of_many_texts_are_those_of_the_pattern():
    rnd = random.Random(5)
    for _ in range(400):
        texts = ["".join(rnd.choice("'''strevmld re \n\x0b12.!é\xdf\u017f\x00\x7f") for _ in range(rnd.randint(0, 25))) for _ in range(rnd.randint(0, 4))]
        got, upto = common.plain_pieces(texts)
        got, upto = got.to_pylist(), upto.tolist()
        assert [got[lo:hi] for lo, hi in zip([0, *upto], upto)] == [WORD.findall(t) for t in texts], texts


def test_each_distinct_piece_is_looked_up_once():
    tok, asked = common.WordTokenizer(BPE), []
    look, tok._pieces._places = tok._pieces._places, lambda pieces: asked.append(pieces) or look(pieces)
    texts = ["the cat isn't the dog", "", "the dog's 12 cats", "été 漢字 the"] * 50
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in tok.encode(texts)]
    assert got == whole_ids(texts)
    assert [sorted(x) for x in asked] == [sorted({w for t in texts[:3] for w in WORD.findall(t)})]


def test_a_full_table_of_pieces_stays_bounded_and_right():
    rnd, asked = random.Random(6), []

    def encode(pieces):
        asked.extend(pieces)
        return [ord(c) for p in pieces for c in p], [len(p) for p in pieces]

    table = common.IdTable(encode, limit=20_000)
    for _ in range(60):
        pieces = list({"".join(rnd.choices("abcdefgh", k=rnd.randint(0, 4))) for _ in range(40)})
        place = np.array([rnd.randrange(len(pieces)) for _ in range(rnd.choice([0, 1, 100]))], dtype=np.int64)
        ids, n = table.ids(pieces, place)
        assert ids.tolist() == [ord(c) for k in place for c in pieces[k]]
        assert n.tolist() == [len(pieces[k]) for k in place]
        assert len(table._slots) == len(table._to) - 1 < 20_000 / common.IdTable.ENTRY + 40
    assert len(asked) > len(set(asked))


# --- 1
def test_codec_on_odd_texts():
    c, ref = sp.coder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text, (ids, errors, norm) in zip(ODD, c.encode(ODD)):
        ids = np.frombuffer(ids, dtype="<u4")
        assert ids.tolist() == ref.encode(text) and errors == 0
        assert c.decode(ids) == ref.decode(ids.tolist()) and c.decode_normalized(ids) == norm
        assert c.tok.encode(text, add_special_tokens=False).ids == ids.tolist()


def unigram_model(fallback):
    """A small unigram model file, written field by field."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def sub(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    pieces = [("<unk>", 0.0, sp.UNKNOWN), ("<s>", 0.0, sp.CONTROL), ("</s>", 0.0, sp.CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, sp.BYTE) for b in range(256)] if fallback else []
    words = ["▁the", "▁", "▁a", "the", "t", "h", "e", "a", "n", "d", "an", "and", "▁and", "s", "▁▁", "<", ">"]
    pieces += [(w, -2.0 - 0.37 * i, sp.NORMAL) for i, w in enumerate(words)]
    body = b"".join(sub(1, sub(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + varint(t)) for p, s, t in pieces)
    trainer = b"\x18\x01" + (varint(35 << 3) + b"\x01" if fallback else b"")
    return body + sub(2, trainer) + sub(3, sub(1, b"identity") + b"\x18\x01\x20\x01\x28\x01")


@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_model(tmp_path, fallback):
    path = tmp_path / "u.model"
    path.write_bytes(unigram_model(fallback))
    ref, c = sentencepiece.SentencePieceProcessor(model_file=str(path)), sp.Coder(str(path))
    texts = ["the and thean", " the  the ", "<s>the</s>", "", "sand dane hat", "a▁b" if fallback else "a the"]
    for text, (ids, errors, _) in zip(texts, c.encode(texts)):
        ids = np.frombuffer(ids, dtype="<u4").tolist()
        assert ids == ref.encode(text) and errors == 0, text


class Recorder:
    """The sentencepiece library, and what it was asked."""

    def __init__(self, inner):
        self.inner, self.asked = inner, set()

    def encode(self, texts, **options):
        self.asked.update(texts)
        return self.inner.encode(texts, **options)


def test_parity_covers_every_word():
    c = sp.Coder(PIECES)
    c.of_normalized = Recorder(c.of_normalized)
    texts = ["  two  spaces ", "a b", " ", "mark▁▁in ▁"]
    got = c.encode(texts)
    assert all(errors == 0 for _, errors, _ in got)
    assert c.of_normalized.asked >= {w for _, _, n in got for w in c.WORD.findall(n)}
    # words with several markers, or without one, that come out otherwise are counted
    c = sp.Coder(PIECES)
    real = c._inner
    odd = {"▁▁▁two", "▁▁spaces", "▁"}

    class Other:
        def encode_batch_fast(self, words, **options):
            return real.encode_batch_fast([w + "!" if w in odd else w for w in words], **options)

    c._inner = Other()
    assert [errors for _, errors, _ in c.encode(["  two  spaces ", "two spaces"])] == [3, 0]


def test_parity_with_a_character_map(tmp_path):
    """A model with the library's own map: white space is squeezed, characters are replaced."""
    docs = [f"the river {i} runs under ½ the ﬁne bridge Ａ{i % 7} and on" for i in range(300)]
    sentencepiece.SentencePieceTrainer.train(sentence_iterator=iter(docs), model_prefix=str(tmp_path / "m"), vocab_size=60, minloglevel=2)
    c, ref = sp.Coder(str(tmp_path / "m.model")), sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "m.model"))
    assert c.model.charsmap
    texts = [*docs[:20], "  the   ﬁne\tbridge ", "", "Ａ Ｂ ½ zzz"]
    for text, (ids, errors, _) in zip(texts, c.encode(texts)):
        assert (errors == 0) == (np.frombuffer(ids, dtype="<u4").tolist() == ref.encode(text))
    # what the library makes of a text is compared, not taken from this module
    c.normalized = lambda text: "▁the"
    assert [errors for _, errors, _ in c.encode(["the", "the river"])] == [0, 1]


def test_whole_texts_are_compared_without_byte_fallback(tmp_path, monkeypatch):
    monkeypatch.setattr(sp, "STRETCH", 12)
    path = tmp_path / "u.model"
    path.write_bytes(unigram_model(False))
    c = sp.Coder(str(path))
    c.of_normalized = Recorder(c.of_normalized)
    c.model.split_at_marker = True  # as if no piece held two markers
    texts = ["the and the hand", "the"]
    assert [errors for _, errors, _ in c.encode(texts)] == [0, 0]
    assert c.of_normalized.asked >= {"▁the▁and▁the", "▁hand", "▁the"}
    c.whole = lambda norm, lists: [b""] * len(norm)
    assert [errors for _, errors, _ in c.encode(texts)] == [1, 1]


def test_codec_tables(spark):
    common.prepare(spark)
    docs = awkward_docs(spark)
    out = sp.encode(docs, PIECES)
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.round_trip and r.n_parity_errors == 0 for r in rows)
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (3, 4))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    texts = {r.doc_id: r.text for r in sp.decode(out.where("doc_id is not null"), PIECES).collect()}
    assert all(texts[r.doc_id] == (r.text or "") for r in docs.where("doc_id is not null").collect())
    assert sp.encode(empty_docs(spark), PIECES).count() == 0


# --- 4
def test_cuts():
    for n in range(0, 5000):
        c = pack.cuts(n)
        assert sum(c) == n and all(0 < x <= pack.CAPACITY for x in c)


def check_packing(docs, rows):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted([(i, zlib.crc32(np.array(x + [1], dtype="<u4").tobytes()), len(x) + 1) for (i, _), x in zip(texts, whole_ids([t for _, t in texts]))], key=str)
    sequences = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.02 * total
    return want


def test_packing(spark):
    common.prepare(spark)
    docs = awkward_docs(spark).where("doc_id is not null and doc_id <> 6")
    rows = pack.pack(docs, BPE).collect()
    want = check_packing(docs, rows)
    got = []
    for i in {r.doc_id for r in rows}:
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        ids = b"".join(p.ids for p in pieces)
        assert all(p.doc_tokens == len(ids) // 4 for p in pieces)
        got.append((i, zlib.crc32(ids), len(ids) // 4))
    assert sorted(got, key=str) == want
    every = awkward_docs(spark)
    assert sum(r.length for r in pack.pack(every, BPE).collect()) == sum(len(x) + 1 for x in whole_ids([r.text for r in every.collect()]))
    assert pack.pack(empty_docs(spark), BPE).count() == 0
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    check_packing(docs, pack.pack(docs, BPE).collect())


# --- 6
def test_grammar_round_trip():
    rnd = np.random.default_rng(2)
    for width in (1, 2, 5, 300):
        docs = [rnd.integers(0, width, rnd.integers(1, 400)).astype("<u4").tobytes() for _ in range(60)]
        row = rp.encode_block(docs, [None, *range(59)], 400)
        assert [x.tobytes() for _, _, x in rp.decode_block(row)] == docs
        assert [d for d, _, _ in rp.decode_block(row)][:3] == [None, 0, 1]
        for k in (0, 7, 59):
            ids = np.frombuffer(docs[k], dtype="<u4")
            assert rp.decode_document(row, k).tolist() == ids.tolist()
            lo = len(ids) // 3
            assert rp.decode_document(row, k, lo, 17).tolist() == ids[lo:lo + 17].tolist()
        if width < 5:
            assert len(row["symbols"]) // row["width"] < 0.6 * row["n_tokens"]


def test_files_are_read_back_in_order(spark):
    common.prepare(spark)
    docs = awkward_docs(spark)
    path = common.shared_path(spark, "test-repair")
    rp.write(docs, path, BPE, block_tokens=3000, shards=3)
    rows = sorted(rp.read(spark, path).collect(), key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys) and len(rows) == docs.count()
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    want = sorted([(r.doc_id, np.array(x + [2], dtype="<u4").tobytes()) for r, x in zip(docs.collect(), whole_ids([r.text for r in docs.collect()]))], key=str)
    assert sorted([(r.doc_id, bytes(r.ids)) for r in rows], key=str) == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    empty = common.shared_path(spark, "test-repair")
    rp.write(empty_docs(spark), empty, BPE)
    assert rp.read(spark, empty).count() == 0
