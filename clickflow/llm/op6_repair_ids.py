"""Token ids on disk under a Re-Pair grammar.

Documents are dealt by doc_id ranges, so files, and the documents in them, are in
ascending doc_id order.  Each block of up to ``block_tokens`` ids gets a grammar of its
own: round after round the frequent pairs of neighbouring ids become nonterminals.
A round replaces the pairs of at least a 64th of the
highest count that don't share an id as one's end and another's beginning, so that
occurrences can't overlap; rounds go on until no pair is frequent.  Pairs never cross a
document's end.

File format: a Parquet table with one row per block: rules as id pairs, the expansion
length of each rule, the documents' ids, token counts and symbol counts, and the
symbols, all little-endian.  A document is decoded alone from its symbols and the rules
(``decode_document``); a position inside it is found by summing expansion lengths.

Nulls and edges: a null text is an empty one (only its end id); null doc_ids come
first; rows with the same doc_id follow one another, ordered by the text's hash; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import common

END_ID = 2
BLOCK_TOKENS = 1 << 20
#: A pair must occur so often to become a rule; rounds go on until none does.
MIN_COUNT = 8
#: Share of a round's highest count that a pair needs to be replaced in it.
BAND = 64
FORMAT = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("vocabulary", T.LongType()),
    T.StructField("rules", T.BinaryType()), T.StructField("expansions", T.BinaryType()),
    T.StructField("doc_ids", T.BinaryType()), T.StructField("null_ids", T.IntegerType()),
    T.StructField("doc_tokens", T.BinaryType()), T.StructField("doc_symbols", T.BinaryType()),
    T.StructField("width", T.IntegerType()), T.StructField("symbols", T.BinaryType())])
DECODED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("shard", T.IntegerType()),
    T.StructField("block", T.IntegerType()), T.StructField("start_in_block", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("ids", T.BinaryType())])


def grouped(left: np.ndarray, right: np.ndarray, top: int, min_count: int, first_slot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs of ids below `top` that occur `min_count` times or more, as codes in order;
    how often; the slot of each given pair: `first_slot` and on, or 0 where it is rarer)."""
    bits, room = top.bit_length(), len(left).bit_length()
    pairs = left.astype(np.int64) << bits | right
    if 2 * bits + room < 64:  # a pair and its place in one number
        pairs = np.sort(pairs << room | np.arange(len(pairs)))
        by_pair, pairs = pairs & ((1 << room) - 1), pairs >> room
    else:
        by_pair = np.argsort(pairs)
        pairs = pairs[by_pair]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.r_[first, len(pairs)])
    often = count >= min_count
    slots = np.zeros(len(pairs), dtype=np.int64)
    found, n = pairs[first[often]], count[often]
    slots[by_pair[np.repeat(often, count)]] = np.repeat(np.arange(first_slot, first_slot + len(n)), n)
    return found >> bits << 32 | found & ((1 << bits) - 1), n, slots


def disjoint(codes: np.ndarray, counts: np.ndarray, least: int, room: int) -> np.ndarray:
    """Places of the most frequent pairs of at least `least` occurrences (at most `room`),
    none of which ends with an id that another begins with; in order of their codes."""
    often = np.flatnonzero(counts >= least)
    often = often[np.lexsort((codes[often], -counts[often]))]
    lefts, rights, taken = set(), set(), []
    of = codes[often]
    for k, a, b in zip(often.tolist(), (of >> 32).tolist(), (of & 0xFFFFFFFF).tolist()):
        if a in rights or b in lefts or (a == b and (a in lefts or a in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        taken.append(k)
        if len(taken) == room:
            break
    places = np.array(taken, dtype=np.int64)
    return places[np.argsort(codes[places])]


class PairIndex:
    """Places of codes in an array of distinct ones, by a hash table in an array."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        bits = max(10, int(8 * len(codes)).bit_length())
        self._shift = np.uint64(64 - bits)
        h = self._hash(codes)
        self._slots = np.full(1 << bits, -1, dtype=np.int32)
        self._slots[h] = np.arange(len(codes))
        # codes that lost their slot to another one are looked up in order, if their slot is crowded
        lost = np.flatnonzero(self._slots[h] != np.arange(len(codes)))
        self._lost = lost[np.argsort(codes[lost], kind="stable")]
        self._crowded = np.zeros(1 << bits, dtype=bool)
        self._crowded[h[lost]] = True

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).view(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in `codes` of those found, their places in the index)."""
        h = self._hash(codes)
        slot = self._slots[h]
        hit = (slot >= 0) & (self.codes[slot] == codes)
        if len(self._lost):
            again = np.flatnonzero(self._crowded[h] & ~hit)
            lost = self.codes[self._lost]
            place = np.minimum(np.searchsorted(lost, codes[again]), len(lost) - 1)
            found = lost[place] == codes[again]
            slot[again[found]] = self._lost[place[found]]
            hit[again[found]] = True
        at = np.flatnonzero(hit)
        return at, slot[at]


def grammar(ids: np.ndarray, ends: np.ndarray, vocabulary: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, symbols, ends): `ends` marks the last symbol of each document.

    Rule r stands for the pair rules[r] and is written as vocabulary + r.  Pairs are
    counted once, and each place keeps the slot of the pair that begins there (0: a rare
    one); a round then takes the replaced places out of the counts and adds the pairs
    that its nonterminals make.  A pair is only ever made by its younger symbol, so what
    is too rare when it is first counted stays so and has no slot.  Places are linked
    inside their document, with `none` beyond either end.
    """
    none = len(ids)
    seq = np.r_[ids.astype(np.int32), np.int32(-1)]
    after = np.arange(1, none + 2)
    after[:-1][ends] = after[-1] = none
    before = np.arange(-1, none)
    before[1:][ends] = before[0] = none
    alive = np.ones(none, dtype=bool)
    rules: list[np.ndarray] = []
    n_rules, room = 0, (1 << 31) - 1 - vocabulary

    slot = np.zeros(none + 1, dtype=np.int64)
    at = np.flatnonzero(~ends)
    codes, counts, slot[at] = grouped(seq[at], seq[at + 1], vocabulary, min_count, 1)
    codes, counts = np.r_[-1, codes], np.r_[0, counts]
    while (most := int(counts.max())) >= min_count:
        order = disjoint(codes, counts, max(min_count, most // BAND), room - n_rules)
        number = np.zeros(len(codes), dtype=np.int32)
        number[order] = vocabulary + n_rules + np.arange(len(order))
        at = np.flatnonzero((number > 0)[slot])
        left, right = codes[order] >> 32, codes[order] & 0xFFFFFFFF
        twins = np.zeros(len(codes), dtype=bool)
        twins[order[left == right]] = True
        k = np.flatnonzero(twins[slot[at]])
        if len(k):
            # of a run of one id every second pair stays
            of = at[k]
            same = np.r_[False, (after[of[:-1]] == of[1:]) & (slot[of[1:]] == slot[of[:-1]])]
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(of))))
            at = np.delete(at, k[(np.arange(len(of)) - head) % 2 == 1])
        second, prior = after[at], before[at]
        then = after[second]
        # pairs that go: the places, and their neighbours on either side, each once
        prior = prior[np.r_[True, prior[1:] != second[:-1]]]
        own = slot[at]
        counts -= np.bincount(np.concatenate([own, slot[second], slot[prior]]), minlength=len(counts))
        seq[at] = number[own]
        after[at], before[then] = then, at
        slot[second], alive[second] = 0, False
        # pairs that come: a nonterminal and what follows it, or what is before it
        slot[at] = 0
        come = np.concatenate([at[then != none], prior[prior != none]])
        rules.append(np.stack([left, right], axis=1))
        n_rules += len(order)
        more, n, slot[come] = grouped(seq[come], seq[after[come]], vocabulary + n_rules, min_count, len(codes))
        counts[0] = 0
        codes, counts = np.concatenate([codes, more]), np.concatenate([counts, n])
        if n_rules == room:
            break
    made = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    return made, seq[:-1][alive].astype(np.int64), (after[:-1] == none)[alive]


def pack_symbols(symbols: np.ndarray, width: int) -> bytes:
    """Little-endian symbols of `width` bytes (2 to 4)."""
    return symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpack_symbols(data: bytes, width: int) -> np.ndarray:
    if width != 3:
        return np.frombuffer(data, dtype=f"<u{width}")
    out = np.zeros((len(data) // 3, 4), dtype=np.uint8)
    out[:, :3] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def expansion_lengths(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """Number of ids that each rule stands for."""
    out = np.ones(vocabulary + len(rules), dtype=np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        out[vocabulary + r] = out[a] + out[b]
    return out[vocabulary:]


def expand(symbols: np.ndarray, rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """Ids of a stretch of symbols: nonterminals are replaced level by level, or, in a long
    stretch, each symbol by its whole expansion."""
    if len(symbols) > len(rules) + vocabulary // 4:
        whole: list[bytes] = []
        for a, b in rules.tolist():
            whole.append((whole[a - vocabulary] if a >= vocabulary else a.to_bytes(4, "little"))
                         + (whole[b - vocabulary] if b >= vocabulary else b.to_bytes(4, "little")))
        flat = np.concatenate([np.arange(vocabulary, dtype="<u4"), np.frombuffer(b"".join(whole), dtype="<u4")])
        size = np.ones(vocabulary + len(rules), dtype=np.int64)
        size[vocabulary:] = [len(x) // 4 for x in whole]
        n = size[symbols]
        to = np.cumsum(n)
        # the place of each id in `flat`: where its symbol's expansion begins there, and on
        return flat[np.repeat((np.cumsum(size) - size)[symbols] - (to - n), n) + np.arange(to[-1])]
    seq, rules = symbols.astype(np.int32), rules.astype(np.int32)
    while len(rules) and (big := seq >= vocabulary).any():
        n = np.where(big, 2, 1)
        out = np.repeat(seq, n)
        at = (np.cumsum(n) - n)[big]
        out[at], out[at + 1] = rules[seq[big] - vocabulary].T
        seq = out
    return seq.astype("<u4")


def encode_block(ids: list[bytes], doc_ids: list[int | None], vocabulary: int) -> dict:
    """One row of the file format."""
    n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    seq = np.frombuffer(b"".join(ids), dtype="<u4")
    ends = np.zeros(len(seq), dtype=bool)
    ends[np.cumsum(n) - 1] = True
    vocabulary = max(vocabulary, int(seq.max()) + 1)
    rules, symbols, ends = grammar(seq, ends, vocabulary)
    width = next(w for w in (2, 3, 4) if vocabulary + len(rules) <= 1 << 8 * w)
    return {"n_tokens": len(seq), "vocabulary": vocabulary, "rules": rules.astype("<u4").tobytes(),
            "expansions": expansion_lengths(rules, vocabulary).astype("<u4").tobytes(),
            "doc_ids": np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
            "null_ids": sum(x is None for x in doc_ids),  # they come first
            "doc_tokens": n.astype("<u4").tobytes(),
            "doc_symbols": np.diff(np.r_[0, np.flatnonzero(ends) + 1]).astype("<u4").tobytes(),
            "width": width, "symbols": pack_symbols(symbols, width)}


def decode_block(row: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the block, ids) of each document of a block."""
    rules = np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
    ids = expand(unpack_symbols(row["symbols"], row["width"]), rules, row["vocabulary"])
    docs, n = np.frombuffer(row["doc_ids"], dtype="<i8"), np.frombuffer(row["doc_tokens"], dtype="<u4").astype(np.int64)
    at = np.cumsum(n) - n
    for k, (doc, start, size) in enumerate(zip(docs.tolist(), at.tolist(), n.tolist())):
        yield None if k < row["null_ids"] else doc, start, ids[start:start + size]


def decode_document(row: dict, k: int, start: int = 0, length: int | None = None) -> np.ndarray:
    """Ids [start, start + length) of the k-th document of a block, from the symbols
    that hold them alone."""
    n = np.frombuffer(row["doc_symbols"], dtype="<u4").astype(np.int64)
    lo = int(n[:k].sum())
    symbols = unpack_symbols(row["symbols"], row["width"])[lo:lo + int(n[k])].astype(np.int64)
    rules = np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
    sizes = np.r_[np.ones(row["vocabulary"], dtype=np.int64), np.frombuffer(row["expansions"], dtype="<u4")][symbols]
    to = np.cumsum(sizes)
    stop = int(to[-1]) if length is None else min(int(to[-1]), start + length)
    a, b = int(np.searchsorted(to, start, side="right")), int(np.searchsorted(to, stop, side="left")) + 1
    skip = start - int(to[a - 1] if a else 0)
    return expand(symbols[a:b], rules, row["vocabulary"])[skip:skip + max(0, stop - start)]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
          block_tokens: int = BLOCK_TOKENS, shards: int | None = None) -> None:
    """Encode all texts and write the files below `path` (any folder Spark can write)."""
    spark = docs.sparkSession
    rows = common.text_rows(docs)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema, end = to_arrow_schema(FORMAT), np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, shard = common.word_tokenizer(tokenizer), TaskContext.get().partitionId()
        vocabulary = tok.tok.get_vocab_size()
        ids: list[bytes] = []
        keys: list = []
        block = size = 0

        def flush() -> pa.RecordBatch:
            row = encode_block(ids, keys, vocabulary) | {"shard": shard, "block": block}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in common.parts(batches, 1):
            texts = b.column(1).to_pylist()
            at = b.column(0).to_pylist()
            for lo, hi in common.chunks(texts):
                for key, got in zip(at[lo:hi], tok.encode(texts[lo:hi])):
                    ids.append(got + end)
                    keys.append(key)
                    size += len(ids[-1]) // 4
                    if size >= block_tokens:
                        yield flush()
                        ids, keys, block, size = [], [], block + 1, 0
        if ids:
            yield flush()

    rows.mapInArrow(common.tidied(run), FORMAT).write.parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """All documents of the files below `path`: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 and, unless left out, the ids (little-endian unsigned 32-bit)."""
    files = spark.read.schema(FORMAT).parquet(path)
    schema = to_arrow_schema(DECODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (b.slice(i, 1).to_pylist()[0] for b in batches for i in range(b.num_rows)):  # a block at a time
            got = [(d, row["shard"], row["block"], s, len(x), zlib.crc32(x), x.tobytes() if with_ids else None)
                   for d, s, x in decode_block(row)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)

    # ids before each block: a sum inside the shard, and the totals of the shards before
    blocks = files.select("shard", "block", "n_tokens")
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before_shard"))
    inside = blocks.select("shard", "block", (F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_tokens")).alias("before_block"))
    starts = inside.join(before, "shard").select("shard", "block", (F.col("before_shard") + F.col("before_block")).alias("before"))
    out = files.mapInArrow(common.tidied(run), DECODED).join(starts, ["shard", "block"])
    cols = ["doc_id", (F.col("before") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32"]
    return out.select(*cols, *(["ids"] if with_ids else []))
