"""Repeated runs of lines, found by winnowing over line hashes.

Lines with a word are hashed (white space runs count as one space).  A window is a run of
lines with ``MIN_WORDS`` words that has fewer without its last line, or without its first
one.  The line of least hash in a window (the first of equal ones) is its fingerprint;
neighbouring windows mostly share it, and a text stores one row for each line selected so,
with the windows that selected it.  Equal windows select the same line, so a run of lines
that two places share, if it has MIN_WORDS words, has a fingerprint that both have stored:
nothing is missed.

1. Fingerprints whose hash is stored once in the corpus are dropped.
2. What is left is verified by the 128-bit hash of whole windows.  A window that occurs
   again is matched with its first place only (least doc_id, then position), so there are
   as many matches as places, not pairs of places.
3. Matches extend both ways by joining up: each line that continues a shared run is in a
   further window of that run, one that ends with it on the right or begins with it on the
   left, and that window occurs earlier too.  The union of a text's matched windows is
   thus the union of its maximal shared runs, against all earlier places at once.
4. A line goes if a matched window holds it; where the first place is in the same text,
   only from the end of that first window on, which so is kept.

Only texts that lose lines meet their spans: a bitmap of fixed size (``BITMAP_BITS``, by
a hash of the text) tells which texts may have any, the others pass by unshuffled.  Joins
are sort-merge joins at every size, whose skewed keys Spark splits.

Nulls and edges: a null text stays null, an empty one empty; lines without words are never
matched and stay; null doc_ids come last in the order; rows with equal doc_id and text
are one document, and get the same result; an empty table gives no rows; other columns are kept by
``keep_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common

MIN_WORDS = 50
LONGEST = (1 << 63) - 1
#: Size of the bitmap that tells texts without spans (4 MB).
BITMAP_BITS = 1 << 25
WINDOW = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                       T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])
PLACES = T.StructType([
    T.StructField("line_hash", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("text_hash", T.LongType()),
    T.StructField("windows", T.ArrayType(WINDOW))])


def hashed_lines(text: str) -> tuple[list[int], list[bytes], np.ndarray]:
    """(numbers of the lines with a word, their 128-bit hashes, their word counts)."""
    import xxhash

    at, digests, sizes = [], [], []
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        words = line.split()
        if words:
            at.append(i)
            digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
            sizes.append(len(words))
    return at, digests, np.array(sizes, dtype=np.int64)


def windows(sizes: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(start, end) of the windows, in order: the shortest from each line on, and the
    shortest up to each line."""
    total = np.r_[0, np.cumsum(sizes)]
    ends = np.searchsorted(total, total[:-1] + min_words, side="left")
    starts = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    n = len(sizes)
    return sorted({(a, e) for a, e in enumerate(ends.tolist()) if e <= n} | {(a, e) for e, a in enumerate(starts.tolist(), 1) if a >= 0})


def selected(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """(hash of a selected line, [(start, end, hash) of the windows that selected it])."""
    import xxhash

    _, digests, sizes = hashed_lines(text)
    if sizes.sum() < min_words:
        return
    raw = b"".join(digests)
    keys = np.frombuffer(raw, dtype="<i8")[::2].tolist()
    by_line: dict[int, list] = {}
    for a, e in windows(sizes, min_words):
        least = keys.index(min(keys[a:e]), a)
        by_line.setdefault(least, []).append((a, e, xxhash.xxh3_128_digest(raw[16 * a:16 * e])))
    for line, found in by_line.items():
        yield keys[line], found


def all_places(docs: DataFrame, min_words: int) -> DataFrame:
    """PLACES: a row for each selected line of each text."""
    rows = common.text_rows(docs).where(F.col("text").isNotNull()).select(
        F.coalesce("doc_id", F.lit(LONGEST)).alias("doc"), "text", F.xxhash64("text").alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches, 1):
            docs_, texts, hashes = (b.column(i).to_pylist() for i in range(3))
            got = [(key, d, x, found) for d, t, x in zip(docs_, texts, hashes) for key, found in selected(t, min_words)]
            if not got:
                continue
            flat = [w for r in got for w in r[3]]
            halves = np.frombuffer(b"".join(w[2] for w in flat), dtype="<i8")
            whole = pa.StructArray.from_arrays(
                [pa.array([w[0] for w in flat], pa.int32()), pa.array([w[1] for w in flat], pa.int32()), pa.array(halves[::2]), pa.array(halves[1::2])],
                names=WINDOW.fieldNames())
            offsets = np.cumsum([0, *(len(r[3]) for r in got)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in got], pa.int64()) for i in range(3)),
                                              pa.ListArray.from_arrays(pa.array(offsets), whole)], names=PLACES.fieldNames())

    return rows.mapInArrow(common.tidied(run), PLACES)


def repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, text_hash, spans): the runs (lo, hi; in lines with words, hi exclusive)
    to delete from each document that has any."""
    found = common.written(all_places(docs, min_words), "winnow")
    again = found.groupBy("line_hash").agg(F.count("*").alias("n")).where("n > 1").select("line_hash")
    kept = found.join(again.hint("merge"), "line_hash").select("doc", "text_hash", F.inline("windows"))
    kept = common.written(kept, "winnow-windows")
    place = ["doc", "text_hash", "start", "end"]
    first = kept.groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = first.select("h1", "h2", *(F.col(f"f.{c}").alias(f"f_{c}") for c in place))
    same_text = (F.col("doc") == F.col("f_doc")) & (F.col("text_hash") == F.col("f_text_hash"))
    later = kept.join(first.hint("merge"), ["h1", "h2"]).where(~(same_text & (F.col("start") == F.col("f_start"))))
    # an earlier window of the same text keeps its own lines
    lo = F.when(same_text, F.greatest("start", "f_end")).otherwise(F.col("start"))
    spans = later.select("doc", "text_hash", lo.alias("lo"), F.col("end").alias("hi")).where("lo < hi")
    return spans.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # spans of one document


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the lines of the runs."""
    lines = text.split("\n")
    at = [i for i, x in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")) if x.split()]
    drop = np.zeros(len(lines), dtype=bool)
    for lo, hi in spans:
        drop[at[lo:hi]] = True
    return "\n".join(x for x, gone in zip(lines, drop.tolist()) if not gone)


def bitmap(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bytes whose bit (hash modulo bits) is set for each hash: `bits` / 8 bytes, whatever the rows."""
    at = F.pmod(F.col(column), F.lit(bits))
    one = F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 32) AS INT))")  # bits is a multiple of 32
    words = hashes.groupBy(F.floor(at / 32).cast("int").alias("word")).agg(F.bit_or(one).alias("mask")).toPandas()
    out = np.zeros(bits // 32, dtype="<u4")
    out[words["word"].to_numpy(dtype=np.int64)] = words["mask"].to_numpy(dtype=np.int64)
    return out.view(np.uint8)


def keep_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with the repeated runs cut out of `text`; no row goes."""
    spans = common.written(repeated(docs, min_words), "winnow-spans")
    marked = bitmap(spans, "text_hash", BITMAP_BITS)
    ident, mark, held = (common.fresh_name(docs, x) for x in ("cut_id", "cut_text", "cut_spans"))
    names = list(docs.columns)
    at = names.index("text")
    rows = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))

    def routed(may_have: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bit = b.column(len(names)).to_numpy(zero_copy_only=False).astype(np.int64) % BITMAP_BITS
                hit = (marked[bit >> 3] >> (bit & 7) & 1).astype(bool)
                out = b.filter(pa.array(hit if may_have else ~hit))
                yield out if may_have else pa.RecordBatch.from_arrays(out.columns[:-1], names=names)
        return common.tidied(run)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches, at):
            texts, cuts = b.column(at).to_pylist(), b.column(len(names)).to_pylist()
            new = [without(t, [(s["lo"], s["hi"]) for s in c]) if c and t else t for t, c in zip(texts, cuts)]
            cols = list(b.columns[:-1])
            cols[at] = pa.array(new, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    passed = rows.mapInArrow(routed(False), docs.schema)
    spans = spans.select(F.col("doc").alias(ident), F.col("text_hash").alias(mark), F.col("spans").alias(held))
    some = rows.mapInArrow(routed(True), rows.schema).withColumn(ident, F.coalesce(F.col("doc_id").cast("long"), F.lit(LONGEST)))
    some = some.join(spans.hint("merge"), [ident, mark], "left").select(*names, held)
    return passed.unionByName(some.mapInArrow(common.tidied(cut), docs.schema))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, text without its repeated runs, n_removed_lines."""
    lines = F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0).otherwise(F.size(F.split("text", "\n", -1)))
    out = keep_rows(common.text_rows(docs).withColumn("n_lines", lines), min_words)
    return out.select("doc_id", "text", (F.col("n_lines") - lines).cast("long").alias("n_removed_lines"))
