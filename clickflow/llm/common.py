"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import json
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickflow.session import checkpoint_root

#: Rows per Arrow batch handed to Python.  Texts can be long; a few hundred of them
#: keep a worker's batch, and the JVM's copy of it, small.  Only ever lowered, results do
#: not depend on it.
BATCH_ROWS = 300
#: Bytes of text that are Python strings at a time (one text at least).
PART_BYTES = 2_000_000


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and Arrow batch size of this session."""
    checkpoint_root(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_root(spark)}/clickflow-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: cuts the
    lineage, so neither a lost executor nor a second use computes it anew."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores added until no column of `df` is called so."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def text_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Only the key (as long) and the text; whatever else `docs` has is left out."""
    return docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))


def map_texts(df: DataFrame, per_batch: Callable[[list, list], Iterable[tuple]], schema: T.StructType) -> DataFrame:
    """`per_batch(keys, texts)` over (key, text) rows in Arrow batches.

    `per_batch` yields column tuples (lists or arrays) in the schema's order.
    """
    names = schema.fieldNames()
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 1):
            for cols in per_batch(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=arrow.field(i).type, from_pandas=False)
                     for i, c in enumerate(cols)], names=names)

    return df.mapInArrow(tidied(run), schema)


def filter_texts(docs: DataFrame, keep: Callable[[list], np.ndarray]) -> DataFrame:
    """Rows of `docs` whose `text` passes; `keep(texts)` gives a boolean array.
    All columns stay as they are and nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, "text"):
            yield b.filter(pa.array(np.asarray(keep(b.column("text").to_pylist()), dtype=bool)))

    return docs.mapInArrow(tidied(run), docs.schema)


def parts(batches: Iterable[pa.RecordBatch], column: int | str, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices whose texts (or bytes) take about `size` bytes
    (one row at least); nothing is copied, and batches without rows are left out."""
    for b in batches:
        if b.num_rows == 0:
            continue
        total = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            before = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, before + size, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def release() -> None:
    """Memory that a worker holds but doesn't use goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: it keeps its own ways


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, and `release` at the end of the task: workers live on between stages."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def chunks(texts: list, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of `texts` of about `chars` characters each (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > chars:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


class PieceCache:
    """Token ids of text pieces that the tokenizer treats independently.

    Ids are kept as little-endian unsigned 32-bit bytes, so a document's ids are
    one `bytes.join`.  `encode_many(pieces)` returns the ids of each piece as such
    bytes.  Beyond `limit` bytes the cache drops its newer half: memory stays bounded
    and the ids are the same.
    """

    #: Bytes of an entry beside its text and its ids.
    ENTRY = 190

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = 64_000_000):
        self._encode, self._limit, self._ids, self._size = encode_many, limit, {}, 0

    def load(self, lists: list[list[str]]) -> dict[str, bytes]:
        """Ids by piece for all pieces of `lists`."""
        if self._size > self._limit:
            # frequent pieces come early: the older half stays
            self._ids = dict(islice(self._ids.items(), len(self._ids) // 2))
            self._size //= 2
        ids = self._ids
        missing = list(set().union(*lists).difference(ids))
        for lo in range(0, len(missing), 20_000):
            part = missing[lo:lo + 20_000]
            got = self._encode(part)
            ids.update(zip(part, got))
            self._size += sum(map(len, part)) + sum(map(len, got)) + self.ENTRY * len(part)
        return ids


class IdTable:
    """Token ids of distinct pieces, one after another in an array.

    `encode_many(pieces)` returns the ids of all pieces in a row, and how many each has.
    Beyond `limit` bytes the table drops its newer half: memory stays bounded and the
    ids are the same.
    """

    #: Bytes of an entry beside its text and its ids: headers of a string and a number, its share of the dict and of the array.
    ENTRY = 160

    def __init__(self, encode_many: Callable[[list[str]], tuple[list[int], list[int]]], limit: int = 96_000_000):
        self._encode, self._limit, self._slots, self._size = encode_many, limit, {}, 0
        self._ids, self._to = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def ids(self, pieces: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces[place[0]], pieces[place[1]], ... in a row, how many each has);
        `pieces` are distinct."""
        slot = self._places(pieces)[place]
        n = self._to[slot + 1] - self._to[slot]
        to = np.cumsum(n)
        return self._ids[np.repeat(self._to[slot] - (to - n), n) + np.arange(n.sum())], n

    def _places(self, pieces: list[str]) -> np.ndarray:
        if self._size > self._limit:
            # frequent pieces come early: the older half stays
            half = len(self._slots) // 2
            self._slots = dict(islice(self._slots.items(), half))
            self._to = self._to[:half + 1].copy()
            self._ids = self._ids[:self._to[-1]].copy()
            self._size //= 2
        out = np.fromiter(map(self._slots.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            ids, counts = self._encode(new)
            out[missing] = np.arange(len(self._slots), len(self._slots) + len(new))
            self._slots.update(zip(new, out[missing].tolist()))
            self._ids = np.concatenate([self._ids, np.array(ids, dtype="<u4")])
            self._to = np.concatenate([self._to, self._to[-1] + np.cumsum(counts)])
            self._size += sum(map(len, new)) + 4 * len(ids) + self.ENTRY * len(new)
        return out


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_TOKENIZERS: dict = {}
#: The normaliser and the word pattern of the public word-level BPE file.
WORD_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: A character outside those for which lower(), NFC and the classes of WORD_PATTERN are
#: those of Python's str and re: ASCII but for the separators 1c-1f, and Latin letters.
NOT_PLAIN = re.compile("[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]")
WHITE = b"\t\n\x0b\x0c\r "
#: Class of each UTF-8 byte of a plain text in lower case: white space, letter, digit, other.
#: Beyond ASCII such a text has letters only.
KIND = bytes(0 if b in WHITE else 1 if b > 127 or chr(b).islower() else 2 if chr(b).isdigit() else 3 for b in range(256))


def is_plain(text: str) -> bool:
    if text.isascii():
        return not any(c in text for c in "\x1c\x1d\x1e\x1f")
    return not NOT_PLAIN.search(text)


def plain_pieces(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(what WORD_PATTERN finds in plain texts of lower case, one text after another;
    how many pieces there are up to each text's end)."""
    rows = [t.encode() for t in texts]
    data = b"\n".join(rows)
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = np.frombuffer(data.translate(KIND), dtype=np.uint8)
    # a piece begins where the class changes, and at each digit
    begin = kind == 2
    begin[:1] = True
    begin[1:] |= kind[1:] != kind[:-1]
    # an apostrophe that begins a piece takes the ending after it, which ends the piece
    mark = np.flatnonzero((raw == ord("'")) & begin)
    after = np.frombuffer(data + b"\n\n", dtype=np.uint8)
    first, second = after[mark + 1], after[mark + 2]
    size = np.where(np.isin(first, list(b"stmd")), 1, 0)
    for ending in (b"re", b"ve", b"ll"):
        size[(first == ending[0]) & (second == ending[1])] = 2
    mark, size = mark[size > 0], size[size > 0]
    begin[mark + 1] = False
    stop = mark + 1 + size
    begin[stop[stop < len(raw)]] = True
    solid = kind != 0
    begin &= solid
    text = data.translate(None, WHITE)
    offsets = np.r_[np.flatnonzero(begin[solid]), len(text)].astype(np.int32)
    pieces = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    ends = np.cumsum([len(r) + 1 for r in rows]) - 1
    return pieces.dictionary_encode(), np.searchsorted(np.flatnonzero(begin), ends)


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in own)
    return {b: 256 + i for i, b in enumerate(rest)}


class WordTokenizer:
    """The tokenizers library over whole texts, each distinct word encoded once.

    A tokenizer that drops white space before merging, as the word-level BPE file
    does, gives a text the ids of its pieces one after another; so the library's
    model merges each distinct piece once, and the pieces of many texts are cut and
    looked up together.  Texts with characters beyond Latin
    letters go through the whole library tokenizer word by word, and any other kind
    of tokenizer encodes each text as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [{}, {}]
        self.by_word = (norm.get("normalizers") == WORD_NORMALIZER and len(steps) == 2
                        and steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[0].get("behavior") == "Removed"
                        and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space")
                        and not spec.get("post_processor"))
        self._model, self._letters = self.tok.model, byte_letters()
        self._words, self._pieces = PieceCache(self.whole, 12_000_000), IdTable(self._of_pieces)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids by the library alone."""
        return [packed(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_pieces(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        merge, letters = self._model.tokenize, self._letters
        got = [merge(p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters)) for p in pieces]
        return [t.id for tokens in got for t in tokens], list(map(len, got))

    def _plain(self, texts: list[str]) -> list[bytes]:
        pieces, upto = plain_pieces([t.lower() for t in texts])
        ids, n = self._pieces.ids(pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy())
        ends = (4 * np.r_[0, np.cumsum(n)][upto]).tolist()
        data = ids.tobytes()
        return [data[lo:hi] for lo, hi in zip([0, *ends], ends)]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        lists = [t.replace("\n", " ").split(" ") for t in texts]
        ids = self._words.load(lists)
        return [b"".join(map(ids.__getitem__, x)) for x in lists]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none)."""
        if not self.by_word:
            return self.whole([t or "" for t in texts])
        out: list[bytes] = []
        for lo, hi in chunks(texts):
            part = [t or "" for t in texts[lo:hi]]
            plain = [is_plain(t) for t in part]
            easy = iter(self._plain([t for t, ok in zip(part, plain) if ok]))
            hard = iter(self._by_words([t for t, ok in zip(part, plain) if not ok]))
            out += [next(easy if ok else hard) for ok in plain]
        return out


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]
