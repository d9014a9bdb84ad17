"""Fill-in-middle transformation: cut ranks found in an indexable skip list.

A text is a sequence of units, the matches of a unit pattern from left to right (a
single code point by default; words, lines ... by another pattern).  The bottom lane of
the skip list has one node a unit; each higher lane has the nodes whose tower is tall
enough (a hash of the position decides, one node in ``FAN`` on average).  Every lane keeps
with each node how far the next node of that lane is: in units (unit width) and in code
points (code-point width).  A cut after `r` units is found by going down from the top
lane, adding widths while they do not pass `r`; the code points added on the way are the
exact place in the text.

Two cuts part a text into prefix, middle and suffix, and a document id's SHA-256 decides
cuts and form, so a retried task gives the same output:

* plain: the text as it is (empty, holding a sentinel, or drawn so);
* psm:   <P>prefix<S>suffix<M>middle;
* spm:   <S>suffix<P>prefix<M>middle.

As no transformed text holds a sentinel, the first sentinel of each kind in the output is
the one that was put there, and ``restored`` rebuilds the exact text from output and form.

Nulls and edges: a null text is an empty one, and plain; a null doc_id is drawn by the
hash of ``1:`` alone; repeated rows are transformed alike and all returned; other columns
stay behind; an empty table gives no rows.  Texts are handled one after the other, so a
worker holds one text's lanes (a few bytes a unit) beside the batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import common

P, S, M = "<P>", "<S>", "<M>"
#: One node in so many goes up a lane, on average.
FAN = 16
CODE_POINT = r"(?s:.)"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType(), False), T.StructField("form", T.StringType(), False),
    T.StructField("prefix_units", T.LongType()), T.StructField("middle_units", T.LongType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType(), False)])


def heights(n: int) -> np.ndarray:
    """Lanes that the node of each position reaches (1: the bottom lane alone)."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    out = np.ones(n, dtype=np.int8)
    mask = np.uint64(FAN - 1)
    up = (x & mask) == 0
    while up.any():
        out[up] += 1
        x >>= np.uint64(FAN.bit_length() - 1)
        up &= (x & mask) == 0
        up &= x != 0
    return out


class Lane:
    """Nodes of one lane: places in the lane below, and widths to the next node."""

    __slots__ = ("below", "units", "chars")

    def __init__(self, below: np.ndarray, units: np.ndarray, chars: np.ndarray):
        self.below, self.units, self.chars = below, units, chars


class SkipList:
    """Units of given code-point widths; ``place(rank)`` is the number of code points of
    the first `rank` units.  The head node of every lane stands before the first unit."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        # node i of the bottom lane stands before unit i; its widths are that unit's
        self.lanes = [Lane(np.arange(self.n), np.ones(self.n, dtype=np.int64), np.asarray(widths, dtype=np.int64))]
        tall, height = heights(self.n), 2
        while self.n and len(self.lanes[-1].units) > FAN:
            low = self.lanes[-1]
            up = tall >= height
            up[0] = True  # the head
            at = np.flatnonzero(up)
            if len(at) == len(low.units):
                break
            self.lanes.append(Lane(at, np.add.reduceat(low.units, at), np.add.reduceat(low.chars, at)))
            tall, height = tall[at], height + 1

    def place(self, rank: int) -> int:
        if not 0 <= rank <= self.n:
            raise IndexError(f"rank {rank} of {self.n} units")
        units = chars = node = 0
        for lane in reversed(self.lanes):
            wide, far, end = lane.units, lane.chars, len(lane.units)
            while node < end and units + wide[node] <= rank:
                units += int(wide[node])
                chars += int(far[node])
                node += 1
            if units == rank:
                break
            # the rank lies within this node's width: go on in the lane below, at the same node
            node = int(lane.below[node])
        return chars


def unit_widths(text: str, unit: re.Pattern) -> np.ndarray:
    """Code points of each unit.  Code points between two matches count to the unit
    before them (to the first one at the start of a text), so that widths add up."""
    if unit.pattern == CODE_POINT:
        return np.ones(len(text), dtype=np.int64)
    starts = [m.start() for m in unit.finditer(text) if m.end() > m.start()]
    if not starts:
        return np.array([len(text)] if text else [], dtype=np.int64)
    starts[0] = 0
    return np.diff(np.array([*starts, len(text)], dtype=np.int64))


def draws(doc_id: int | None, seed: int = 1) -> tuple[int, int, int, int]:
    """h1 to h4: the first four 8-digit groups of the SHA-256 of `seed:doc_id`."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def transformed(doc_id: int | None, text: str | None, unit: re.Pattern, seed: int = 1,
                plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple:
    """A row of OUT."""
    text = text or ""
    h1, h2, h3, h4 = draws(doc_id, seed)
    widths = unit_widths(text, unit)
    n = len(widths)
    if not text or P in text or S in text or M in text or h3 % 100 >= 100 - plain_percent:
        return doc_id, n, "plain", None, None, None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    units = SkipList(widths)
    a, b = units.place(low), units.place(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        form, out = "spm", f"{S}{suffix}{P}{prefix}{M}{middle}"
    else:
        form, out = "psm", f"{P}{prefix}{S}{suffix}{M}{middle}"
    return doc_id, n, form, low, high - low, a, b - a, out


def transform(docs: DataFrame, unit: str = CODE_POINT, seed: int = 1, plain_percent: int = PLAIN_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Per document: doc_id, n (units), form, the lengths of prefix and middle in units and
    code points (null if plain), and output, the transformed text.  No shuffle."""
    def per_batch(ids: list, texts: list) -> Iterator[tuple]:
        pattern = re.compile(unit)
        for lo, hi in common.chunks(texts):
            rows = [transformed(i, t, pattern, seed, plain_percent, spm_percent) for i, t in zip(ids[lo:hi], texts[lo:hi])]
            yield tuple(list(c) for c in zip(*rows))

    return common.map_texts(common.text_rows(docs), per_batch, OUT)


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that `output` and `form` came from."""
    out, kind = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = (F.instr(out, x) for x in (P, S, M))
    w = F.lit(len(P))

    def part(lo: Column, hi: Column) -> Column:
        return F.substr(out, lo, hi - lo)

    end = F.char_length(out) + 1
    # prefix, middle, suffix by form; marks are found by their first place
    psm = F.concat(part(p + w, s), part(m + w, end), part(s + w, m))
    spm = F.concat(part(p + w, m), part(m + w, end), part(s + w, p))
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(out)


def digests(docs: DataFrame) -> DataFrame:
    """The transformation by code points, with SHA-256 digests of output and restored text."""
    out = transform(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


#: The digests, stated in DuckDB SQL.
SQL = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '{P}') OR contains(text, '{S}') OR contains(text, '{M}') OR h3 % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
              WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (
  SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{P}' || p || '{S}' || s || '{M}' || m
                        ELSE '{S}' || s || '{P}' || p || '{M}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o"""
