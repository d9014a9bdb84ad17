"""Harmonic packing of token documents into sequences of a fixed capacity.

Piece lengths fall into reciprocal-capacity classes: class j holds lengths in
(C/(j+1), C/j], and a bin of class j takes exactly j pieces, so every worker fills
its bins without looking at the others and nothing is shuffled.  Documents may be
cut: full sequences first; a rest stays whole when it fills its class's share C/j
to within ``slack``, else its largest power of two is cut off and the remainder is
placed the same way.  Powers of two that divide C fill their bins without a gap.
At the end of a partition the pieces of bins that are not full are cut into powers
of two and placed in bins of a power of two in size, which need no padding.

Nulls and edges: a null text is an empty one (only its end id); null doc_ids pack
like others; repeated rows are packed once each; an empty table gives no rows; a very
long text is cut into as many pieces as it needs; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common

CAPACITY = 2048
#: Share of C/j that a whole rest may leave empty.
SLACK = 1 / 64
END_ID = 1
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType())])
#: Sequences of one partition are numbered from partition << SEQUENCE_BITS.
SEQUENCE_BITS = 36


def cuts(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of the pieces of a document of n ids, in order; their sum is n."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        share = capacity / (capacity // n)
        if share - n <= slack * share:
            return [*out, n]
        out.append(1 << (n.bit_length() - 1))
        n -= out[-1]
    return out


def powers(n: int) -> list[int]:
    """n as descending powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class Packer:
    """Bins of one worker.  A piece is (doc row, start, length)."""

    def __init__(self, capacity: int = CAPACITY, first: int = 0):
        self.capacity, self.next, self.open = capacity, first, {}

    def close(self, pieces: list[tuple]) -> list[tuple]:
        at, out = 0, []
        for p in pieces:
            out.append((*p, self.next, at))
            at += p[-1]
        self.next += 1
        return out

    def add(self, piece: tuple) -> list[tuple]:
        """Placed pieces (piece, sequence, offset) of the bin that this one fills, if any."""
        j = self.capacity // piece[-1]
        bin_ = self.open.setdefault(j, [])
        bin_.append(piece)
        return self.close(self.open.pop(j)) if len(bin_) == j else []

    def finish(self) -> list[tuple]:
        """What is left goes, in powers of two and descending, into full bins and
        then into one bin for each power of two in the rest."""
        left = []
        for *key, start, length in (p for b in self.open.values() for p in b):
            for n in powers(length):
                left.append((*key, start, n))
                start += n
        self.open, out = {}, []
        left.sort(key=lambda p: -p[-1])
        total = sum(p[-1] for p in left)
        at = 0
        for size in [self.capacity] * (total // self.capacity) + powers(total % self.capacity):
            end, got = at, 0
            while got < size:
                got += left[end][-1]
                end += 1
            out += self.close(left[at:end])
            at = end
        return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, slack: float = SLACK,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit).

    `capacity` is a power of two.  `sequence_id` numbers the sequences of each
    input partition; (sequence_id, offset) order the pieces without gaps.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    schema = to_arrow_schema(SCHEMA)
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = common.word_tokenizer(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << SEQUENCE_BITS)
        # a bin that is still open keeps its pieces' ids here; there is at most one
        # of each class, so this is bounded
        held: dict[tuple, bytes] = {}
        serial = 0

        def rows(placed: list[tuple]) -> tuple[list, ...]:
            out: tuple[list, ...] = tuple([] for _ in SCHEMA)
            for k, doc, n_doc, base, start, n, seq, off in placed:
                part = held[k, base][4 * (start - base):4 * (start - base + n)]
                for col, v in zip(out, (doc, start, n, zlib.crc32(part), n_doc, seq, off, part)):
                    col.append(v)
            for p in placed:
                left[p[0], p[3]] -= p[5]
                if not left[p[0], p[3]]:
                    del left[p[0], p[3]], held[p[0], p[3]]
            return out

        left: dict[tuple, int] = {}
        for b in common.parts(batches, 1):
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in common.chunks(texts):
                placed = []
                for doc, ids in zip(keys[lo:hi], tok.encode(texts[lo:hi])):
                    ids += end
                    n_doc, start, serial = len(ids) // 4, 0, serial + 1
                    for n in cuts(n_doc, capacity, slack):
                        held[serial, start] = ids[4 * start:4 * (start + n)]
                        left[serial, start] = n
                        placed += packer.add((serial, doc, n_doc, start, start, n))
                        start += n
                if placed:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows(placed), schema)], schema=schema)
        if placed := packer.finish():
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows(placed), schema)], schema=schema)

    return common.text_rows(docs).mapInArrow(common.tidied(run), SCHEMA)
