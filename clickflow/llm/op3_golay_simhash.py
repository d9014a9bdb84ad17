"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits.  A segment with a
parity bit appended is a word of the extended Golay code's space; its keys are the
indices of all codewords within four bits: one, or six for the words farthest from the
code.  Two segments that differ in at most two bits always share a key (with even
parity they are 0 or 2 apart; a word two bits away from another stays within four bits
of one of its codewords).  Of four errors over three segments either some segment has
none and another two at most, or all three have one or two, and then two of them just
one, which leaves one half of each unchanged.  So buckets are made of a whole segment
with a key of another, and of halves of two segments with a key of the third: every pair
of fingerprints at distance 4 or less shares a bucket, and each bucket is told by some 30
bits or more, so chance meetings stay rare.

Copies are one fingerprint, which is in each of some hundred buckets once; so no bucket holds
more than about a hundredth of the rows.  Buckets with one member go at once.  In the others all members are first compared with the
most frequent one, and the links found make components.  Then only buckets that still
hold several components are searched, each pair of members of different components once
with one of them outside the bucket's largest component, so a large group of near
copies is never paired with itself.  Every link is verified by its Hamming distance.

Nulls and edges: a null or empty text, or one without words, has fingerprint zero and is
linked like any other; component_id is the least doc_id of the component (null only if
all its doc_ids are null); repeated rows each get a row; an empty table gives no
rows; other columns are ignored (and kept by ``keep_rows``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from . import common
from .components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: (lowest bit, width) of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fixed value: generator polynomial of the binary Golay code,
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
PRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])


def simhash(text: str | None, words: int = SHINGLE, seed: int = SEED, part: int = 50_000) -> int:
    """Unsigned 64-bit fingerprint of the word shingles of a text, repeats included."""
    import xxhash

    data = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return 0
    gaps = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
    if len(starts) > words:
        starts, ends = starts[:len(starts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(starts), part):
        h = np.array([digest(data[a:b], seed) for a, b in zip(starts[lo:lo + part].tolist(), ends[lo:lo + part].tolist())], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of the 23-bit words by their 11 low and 12 high bits, error patterns by
    syndrome): up to six even patterns of weight four or less for each syndrome of a
    word extended by its parity; -1 where there are fewer."""
    def rest(word: int) -> int:
        for k in range(22, 10, -1):
            if word >> k & 1:
                word ^= GOLAY << (k - 11)
        return word

    unit = [rest(1 << k) for k in range(23)]
    by_syndrome: dict[int, list[int]] = {}
    for n in (0, 2, 4):
        # patterns on 24 positions; the last is the parity bit, whose syndrome is 0 here
        for at in combinations(range(24), n):
            s = 0
            for k in at:
                s ^= unit[k] if k < 23 else 0
            by_syndrome.setdefault(s, []).append(sum(1 << k for k in at))
    patterns = np.full((2048, 6), -1, dtype=np.int64)
    for s, found in by_syndrome.items():
        least = min(bin(p).count("1") for p in found)
        # a word at distance 2 of a codeword has just that one within four bits
        keep = [p for p in found if bin(p).count("1") == least]
        patterns[s, :len(keep)] = keep
    low = np.array([0] * 2048, dtype=np.int64)
    high = np.array([0] * 4096, dtype=np.int64)
    for table, first, bits in ((low, 0, 11), (high, 11, 12)):
        for k in range(bits):
            table[1 << k:2 << k] = table[:1 << k] ^ unit[first + k]
    return np.concatenate([low, high]), patterns


def segment_keys(values: np.ndarray) -> np.ndarray:
    """Codeword indices (12 bits) near each 23-bit word: shape (n, 6), -1 where none."""
    syndrome, patterns = golay_tables()
    s = syndrome[values & 2047] ^ syndrome[2048 + (values >> 11)]
    found = patterns[s]
    # the code word's 12 high bits tell it; the parity bit is left out of them
    return np.where(found < 0, -1, ((values[:, None] ^ found) & 0x7FFFFF) >> 11)


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the buckets of each fingerprint (as unsigned 64-bit integers)."""
    segs = [((fps >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
    near = [segment_keys(s) for s in segs]
    n = len(fps)
    rows, keys = [], []

    def put(tag: int, parts: list[tuple[int, np.ndarray]]) -> None:
        key, ok = np.full((n, 1), tag, dtype=np.int64), np.ones((n, 1), dtype=bool)
        for bits, p in parts:
            ok = (ok[:, :, None] & (p >= 0)[:, None, :]).reshape(n, -1)
            key = ((key[:, :, None] << bits) | np.maximum(p, 0)[:, None, :]).reshape(n, -1)
        at = np.nonzero(ok)
        rows.append(at[0])
        keys.append(key[at])

    # each half of a segment, marked by which one it is
    halves = [np.stack([s & ((1 << w // 2) - 1), (s >> w // 2) | 1 << 12], axis=1) for s, (_, w) in zip(segs, SEGMENTS)]
    for tag, (i, j) in enumerate(permutations(range(3), 2), 1):
        put(tag, [(23, segs[i][:, None]), (12, near[j])])
    for tag, k in enumerate(range(3), 7):
        i, j = (x for x in range(3) if x != k)
        put(tag, [(13, halves[i]), (13, halves[j]), (12, near[k])])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of each row."""
    def per_batch(keys: list, texts: list) -> Iterator[tuple]:
        yield keys, np.array([simhash(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64)

    return common.map_texts(common.text_rows(docs), per_batch, PRINTS)


def with_keys(prints: DataFrame) -> DataFrame:
    """Rows of (fp, n) repeated for each bucket key."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "fp", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(2)]
                row, key = bucket_keys(cols[0].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(c[row]) for c in cols)], names=schema.fieldNames())

    return prints.select("fp", "n").mapInArrow(run, schema)


def linked(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, comp) of each distinct fingerprint of `prints` (fp, n): `comp` is the least
    fingerprint that links of at most `max_bits` differing bits lead to."""
    if max_bits > 4:
        raise ValueError("the buckets are complete up to 4 differing bits")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits
    # one shuffle of all keys; only buckets with several members go on
    several = F.count("*").over(Window.partitionBy("key"))
    rows = common.written(with_keys(prints).withColumn("members", several).where("members > 1").drop("members"), "golay-rows")
    hubs = common.written(rows.groupBy("key").agg(F.max_by("fp", "n").alias("hub")), "golay-hubs")
    stars = rows.join(hubs, "key").where((F.col("fp") != F.col("hub")) & near("fp", "hub")).select("fp", "hub").distinct()
    first = common.written(components(stars, "fp", "hub", "fp", "comp"), "golay-first")
    rows = rows.join(first, "fp", "left").select("key", "fp", F.coalesce("comp", "fp").alias("comp"))
    rows = common.written(rows, "golay-comps")
    # buckets that still hold several components
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rows = common.written(rows.join(common.written(mixed, "golay-mixed"), "key"), "golay-open")
    sizes = rows.groupBy("key", "comp").count()
    largest = common.written(sizes.groupBy("key").agg(F.max_by("comp", "count").alias("largest")), "golay-largest")
    rest = rows.join(largest, "key").where("comp <> largest").select("key", F.col("fp").alias("fp_a"), F.col("comp").alias("comp_a"))
    rest = common.written(rest, "golay-rest")
    pairs = rows.join(rest, "key").where((F.col("comp") != F.col("comp_a")) & near("fp", "fp_a"))
    links = pairs.select(F.least("comp", "comp_a").alias("a"), F.greatest("comp", "comp_a").alias("b")).distinct()
    second = common.written(components(links, "a", "b", "comp", "root"), "golay-second")
    now = prints.select("fp").join(first, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp"))
    return now.join(second, "comp", "left").select("fp", F.coalesce("root", "comp").alias("comp"))


def grouped(docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id (least doc_id of the
    component), component (its least fingerprint)."""
    prints = common.written(fingerprints(docs, words, seed), "simhash")
    each = common.written(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id")), "simhash-distinct")
    comp = common.written(linked(each.select("fp", "n"), max_bits), "simhash-components")
    ids = each.join(comp, "fp").select("fp", "comp", "least_id")
    least = common.written(ids.groupBy("comp").agg(F.min("least_id").alias("component_id")), "simhash-least")
    of_print = common.written(ids.join(least, "comp").select("fp", F.col("comp").alias("component"), "component_id"), "simhash-ids")
    return prints.join(of_print, "fp")


def groups(docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    return grouped(docs, words, max_bits, seed).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_rows(docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, that of the least doc_id (null last; then of the least
    fingerprint, then any of equal rows), with all its columns."""
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")
    best = grouped(docs, words, max_bits).groupBy("component").agg(F.min(rank).alias("best"))
    best = common.written(best.select("best.doc_id", "best.fp"), "simhash-keep")
    ident, mark, turn = (common.fresh_name(docs, x) for x in ("kept_id", "kept_fp", "kept_turn"))
    schema = T.StructType([*docs.schema, T.StructField(mark, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches, "text"):
            fp = np.array([simhash(t, words) for t in b.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=schema.fieldNames())

    rows = docs.mapInArrow(common.tidied(run), schema).withColumn(ident, F.col("doc_id").cast("long"))
    best = best.select(F.col("doc_id").alias(ident + "_"), F.col("fp").alias(mark + "_"))
    kept = rows.join(best, rows[ident].eqNullSafe(best[ident + "_"]) & (rows[mark] == best[mark + "_"]), "left_semi")
    first = Window.partitionBy(ident, mark).orderBy(F.lit(1))
    return kept.withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1).select(*docs.columns)
