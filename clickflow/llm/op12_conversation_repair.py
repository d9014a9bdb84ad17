"""Conversation structure repair by secondary-sorted streaming.

Rows are repartitioned by conversation and sorted by turn inside the partitions, so a task
reads each conversation as one stream of rows, however many Arrow batches it takes.  A
dynamic program over the role grammar ``(s?(ua)+)?`` goes along: its state (a cost and a
tie rank for each of four grammar states) is carried from batch to batch, and for each row
it leaves four bytes of backpointers.  At the end of a conversation the backpointers are
followed back and the rows are replayed with their edits.  Backpointers and rows beyond
``SPILL_BYTES`` lie in an unnamed temporary file of the task (like a sort's spill: nobody
else reads it, and a retried task writes its own), so memory does not grow with the length
of a conversation, but for its audit, one letter an edit.

Edits of a row are Keep, Rerole (to the user or assistant that the grammar wants next) and
Delete, and user or assistant turns without text may be Inserted anywhere.  Blank rows and
rows whose role and text the conversation had before must go; an undeleted truncated row
costs extra.  Of the cheapest edits, those whose letters (D, I, K, R) are least in ASCII
order are taken.  Ties are decided without keeping the letters: two paths that reach a
row in different states end in that row's letter, so neither is a prefix of the other and
their order never changes as both grow; the program carries it as a rank.

The grammar states are: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3
after an assistant turn; 0 and 3 may end.  Two insertions in a row are the most that can
help, and a state that costs more than the cheapest by ``slack`` can't be on a cheapest
path (any state can do what another does for that price), so states are few and steps are
looked up in a table that fills as it goes.

Skew: a conversation's digest runs over its whole repaired text in order, so one task must
read a conversation; it does so as a stream.  Repeats are found before, by a window over
the same partitioning, whose sort spills.

Nulls and edges: a null role or text is one space; null turns come first; rows with equal
turns follow by role and text; null conv_ids form one conversation; a conversation whose
rows were all dropped has an empty audit; an empty table gives no rows; other columns
stay behind.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\v\f\r"
#: Bytes of rows, and of backpointers, that a conversation holds in memory.
SPILL_BYTES = 8 << 20
OK, BLANK, DUPLICATE, TRUNCATED, DROPPED = range(5)
LETTERS = "DKR"
#: State after inserting one or two turns; only steps that lead to another state.
INSERTED = {0: (0, 2, 3), 1: (1, 2, 3), 2: (2, 3), 3: (3, 2)}
NEXT_ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
NONE = 255


@dataclass(frozen=True)
class Costs:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1

    @property
    def slack(self) -> int:
        return 2 * self.insert + self.delete + self.rerole + self.truncated


def kept_state(state: int, initial: str) -> int | None:
    """State after a turn whose role has this initial; None where the grammar forbids it."""
    if initial == "s":
        return 1 if state == 0 else None
    if initial == "a":
        return 3 if state == 2 else None
    return 2 if initial == "u" and state != 2 else None


class Steps:
    """The program's steps, each computed once.

    A state of the program holds for each grammar state (cost above the least, rank) or
    None; `step` gives (least cost added, next state, backpointers): a byte for each
    grammar state, 9 * state before + 3 * insertions + letter, or NONE.
    """

    START = ((0, 0), None, None, None)

    def __init__(self, costs: Costs):
        self.costs, self._known = costs, {}

    def step(self, state: tuple, initial: str, fault: int) -> tuple:
        key = (state, initial, fault)
        if key not in self._known:
            self._known[key] = self._step(*key)
        return self._known[key]

    def _step(self, state: tuple, initial: str, fault: int) -> tuple:
        c = self.costs
        must_go, extra = fault in (BLANK, DUPLICATE), c.truncated if fault == TRUNCATED else 0
        best: list = [None] * 4
        for p, now in enumerate(state):
            if now is None:
                continue
            for k, at in enumerate(INSERTED[p]):
                ways = [("D", at, c.delete)]
                if not must_go:
                    kept = kept_state(at, initial)
                    if kept is not None:
                        ways.append(("K", kept, extra))
                    ways.append(("R", 3 if at == 2 else 2, c.rerole + extra))
                for letter, q, price in ways:
                    # cost first, then the ASCII order of the whole path
                    way = (now[0] + k * c.insert + price, now[1], "I" * k + letter, 9 * p + 3 * k + LETTERS.index(letter))
                    if best[q] is None or way < best[q]:
                        best[q] = way
        least = min(w[0] for w in best if w)
        best = [w if w and w[0] <= least + c.slack else None for w in best]
        order = sorted((w[1], w[2], q) for q, w in enumerate(best) if w)
        rank = {q: i for i, (_, _, q) in enumerate(order)}
        after = tuple((w[0] - least, rank[q]) if w else None for q, w in enumerate(best))
        return least, after, bytes(w[3] if w else NONE for w in best)

    def end(self, state: tuple) -> tuple[int, int, int]:
        """(cost added, state, turns inserted at the end) of the best way to stop."""
        stops = {0: 0, 1: 2, 2: 1, 3: 0}
        cost, _, p = min((s[0] + stops[p] * self.costs.insert, s[1], p) for p, s in enumerate(state) if s)
        return cost, p, stops[p]


def spill_file():
    dirs = [d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)]
    return tempfile.TemporaryFile(dir=dirs[0] if dirs else None)


class Spool:
    """Bytes written in order; beyond `limit` they go to an unnamed file."""

    def __init__(self, limit: int):
        self._limit, self._file, self._tail, self._flushed = limit, None, bytearray(), 0

    def __len__(self) -> int:
        return self._flushed + len(self._tail)

    def write(self, data: bytes) -> None:
        self._tail += data
        if len(self._tail) > self._limit:
            if self._file is None:
                self._file = spill_file()
            self._file.seek(0, os.SEEK_END)
            self._file.write(self._tail)
            self._flushed += len(self._tail)
            self._tail = bytearray()

    def read(self, at: int, size: int) -> bytes:
        end, out = min(at + size, len(self)), b""
        if at < self._flushed:
            self._file.seek(at)
            out = self._file.read(min(end, self._flushed) - at)
        return out + bytes(self._tail[max(at - self._flushed, 0):max(end - self._flushed, 0)])

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


class Conversation:
    """One conversation as its rows come in."""

    def __init__(self, conv_id: int | None, steps: Steps, spill_bytes: int = SPILL_BYTES):
        self.conv_id, self._steps = conv_id, steps
        self._state, self._cost, self._last = Steps.START, 0, None
        self._back, self._rows = Spool(spill_bytes), Spool(spill_bytes)
        self.faults, self.illegal = [0] * 5, 0
        self._low = self._high = None
        self._turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if fault == DROPPED:
            return
        if turn is not None and turn != self._high:
            self._low, self._high = turn if self._low is None else self._low, turn
            self._turns += 1
        initial = role[:1]
        if self._last is not None and self._last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self._last = initial
        self.faults[fault] += 1
        added, self._state, back = self._steps.step(self._state, initial, fault)
        self._cost += added
        self._back.write(back)
        a, b = role.encode(), text.encode()
        self._rows.write(len(a).to_bytes(4, "little") + len(b).to_bytes(4, "little") + a + b)

    @property
    def gaps(self) -> int:
        return 0 if self._low is None else self._high - self._low + 1 - self._turns

    def _edits(self) -> tuple[int, bytes, int]:
        """(cost, a byte of 3 * insertions + letter for each row, insertions at the end)."""
        added, state, last = self._steps.end(self._state)
        size, block = len(self._back), 1 << 20
        out, at = bytearray(size // 4), size
        while at:
            lo = max(at - block, 0)
            part = self._back.read(lo, at - lo)
            for i in range(len(part) - 4, -1, -4):
                state, out[(lo + i) // 4] = divmod(part[i + state], 9)
            at = lo
        return self._cost + added, bytes(out), last

    def _stored(self) -> Iterator[tuple[str, str]]:
        at, size, buffer, lo = 0, len(self._rows), b"", 0
        while at < size:
            if at + 8 > lo + len(buffer):
                buffer, lo = self._rows.read(at, 1 << 20), at
            a, b = (int.from_bytes(buffer[at - lo + k:at - lo + k + 4], "little") for k in (0, 4))
            if at + 8 + a + b > lo + len(buffer):
                buffer, lo = self._rows.read(at, max(1 << 20, 8 + a + b)), at
            start = at - lo + 8
            yield buffer[start:start + a].decode(), buffer[start + a:start + a + b].decode()
            at += 8 + a + b

    def repaired(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of every turn after the repair, in order, after `finish`."""
        state = 0
        for code, (role, text) in zip(self.codes, self._stored()):
            k, letter = divmod(code, 3)
            for _ in range(k):
                yield "I", NEXT_ROLE[state], ""
                state = kept_state(state, NEXT_ROLE[state][0])
            if LETTERS[letter] == "D":
                continue
            if LETTERS[letter] == "R":
                role = NEXT_ROLE[state]
            yield LETTERS[letter], role, text
            state = kept_state(state, role[:1])
        for _ in range(self.last):
            yield "I", NEXT_ROLE[state], ""
            state = kept_state(state, NEXT_ROLE[state][0])

    def finish(self) -> None:
        self.cost, self.codes, self.last = self._edits()

    @property
    def audit(self) -> str:
        known = ["I" * (c // 3) + LETTERS[c % 3] for c in range(9)]
        return "".join(map(known.__getitem__, self.codes)) + "I" * self.last

    def digest(self) -> str:
        sha, gap = hashlib.sha256(), b""
        for _, role, text in self.repaired():
            sha.update(gap + role.encode() + b":" + text.encode())
            gap = b"\n"
        return sha.hexdigest()

    def close(self) -> None:
        self._back.close()
        self._rows.close()


def damage(conversations: DataFrame) -> DataFrame:
    """Faults planted by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.  Rows
    (conv_id, turn, role, text, dropped); a dropped row stays as a mark of its conversation."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             shown("role").alias("role"), shown("text").alias("text"),
                             F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(20)).alias("kind"))
    d = d.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    gone = F.col("kind") == 0
    return d.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"),
                    F.when(gone, " ").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(gone, " ").when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"), gone.alias("dropped"))


def streamed(turns: DataFrame) -> DataFrame:
    """Rows with their first fault, by conversation and in order within each.

    `turns` has conv_id, turn, role, text and, where rows were dropped, ``dropped``.
    One shuffle; the window that numbers equal rows uses its partitioning."""
    from pyspark.sql import Window

    dropped = F.col("dropped") if "dropped" in turns.columns else F.lit(False)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), dropped.alias("dropped"))
    rows = rows.repartition("conv_id")
    equal = Window.partitionBy("conv_id", "role", "text").orderBy("dropped", F.col("turn").asc_nulls_first())
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(F.col("dropped"), DROPPED).when(end == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    rows = rows.withColumn("nth", F.row_number().over(equal)).withColumn("fault", fault)
    rows = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    # pandas has no null longs: each goes with a flag
    return rows.select(F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
                       F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"), "role", "text", "fault")


def conversations_of(frames: Iterator[pd.DataFrame], costs: Costs, spill_bytes: int) -> Iterator[Conversation]:
    """Finished conversations of a sorted stream of rows, one at a time."""
    now, key, steps = None, None, Steps(costs)
    for f in frames:
        for conv, no_conv, turn, no_turn, role, text, fault in zip(*(f[c].tolist() for c in f.columns)):
            if now is None or (conv, no_conv) != key:
                if now is not None:
                    now.finish()
                    yield now
                    now.close()
                key, now = (conv, no_conv), Conversation(None if no_conv else conv, steps, spill_bytes)
            now.add(None if no_turn else turn, role, text, fault)
    if now is not None:
        now.finish()
        yield now
        now.close()


AUDIT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "audit string, repaired_sha256 string")
TURNS = "conv_id long, position long, edit string, role string, text string"


def frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    out["conv_id"] = pd.array([r[0] for r in rows], dtype="Int64")
    return out


def audits(turns: DataFrame, costs: Costs = Costs(), spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation: faults found, the cheapest repair and the digest of its result."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list = []
        for c in conversations_of(frames, costs, spill_bytes):
            out.append((c.conv_id, min(c.gaps, (1 << 63) - 1), c.faults[BLANK], c.faults[DUPLICATE], c.faults[TRUNCATED], c.illegal,
                        c.cost, c.audit, c.digest()))
            if len(out) >= 1000 or len(c.codes) > 100_000:
                yield frame(out, AUDIT)
                out = []
        if out:
            yield frame(out, AUDIT)

    return streamed(turns).mapInPandas(run, AUDIT)


def repair(turns: DataFrame, costs: Costs = Costs(), spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """The repaired turns: conv_id, position (from 0), edit (K, R or I), role and text."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for c in conversations_of(frames, costs, spill_bytes):
            for i, row in enumerate(c.repaired()):
                out.append((c.conv_id, i, *row))
                size += len(row[2])
                if len(out) >= 1000 or size > 4_000_000:
                    yield frame(out, TURNS)
                    out, size = [], 0
        if out:
            yield frame(out, TURNS)

    return streamed(turns).mapInPandas(run, TURNS)


#: The audits of the damaged conversations, stated in DuckDB SQL: CRC-32 bit by bit, and the program as a
#: fold over a conversation's turns that keeps the letters and the text of each state's best path.
SQL = """WITH raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)), lambda a, b:
           list_reduce(range(8), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(a, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc WHERE kind <> 0),
placed AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
faulty AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM counted),
whole AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list({'paths': NULL::STRUCT(c BIGINT, s VARCHAR, q INTEGER, r VARCHAR)[], 'u': left(role, 1), 'go': fault IN ('blank', 'duplicate'),
               'x': CAST(fault = 'truncated' AS BIGINT), 'role': role, 'text': text} ORDER BY i) AS turns
  FROM faulty GROUP BY conv_id),
walked AS (
  SELECT * EXCLUDE turns, list_reduce(turns, lambda a, b: {'paths': list_filter(list_transform(range(4), lambda w: list_min(list_filter(
    flatten(list_transform(
      flatten(list_transform(a.paths, lambda p: [p,
        {'c': p.c + 2, 's': p.s || 'I', 'q': CASE p.q WHEN 2 THEN 3 ELSE 2 END,
         'r': coalesce(p.r || chr(10), '') || CASE p.q WHEN 2 THEN 'assistant:' ELSE 'user:' END},
        {'c': p.c + 4, 's': p.s || 'II', 'q': CASE p.q WHEN 2 THEN 2 ELSE 3 END,
         'r': coalesce(p.r || chr(10), '') || CASE p.q WHEN 2 THEN 'assistant:' || chr(10) || 'user:' ELSE 'user:' || chr(10) || 'assistant:' END}])),
      lambda p: [{'c': p.c + 3, 's': p.s || 'D', 'q': p.q, 'r': p.r},
        {'c': p.c + b.x, 's': p.s || 'K', 'q': CASE WHEN b.go THEN -1 WHEN b.u = 's' AND p.q = 0 THEN 1 WHEN b.u = 'u' AND p.q <> 2 THEN 2
          WHEN b.u = 'a' AND p.q = 2 THEN 3 ELSE -1 END, 'r': coalesce(p.r || chr(10), '') || b.role || ':' || b.text},
        {'c': p.c + 2 + b.x, 's': p.s || 'R', 'q': CASE WHEN b.go THEN -1 WHEN p.q = 2 THEN 3 ELSE 2 END,
         'r': coalesce(p.r || chr(10), '') || CASE p.q WHEN 2 THEN 'assistant:' ELSE 'user:' END || b.text}])),
    lambda z: z.q = w))), lambda z: z IS NOT NULL), 'u': b.u, 'go': b.go, 'x': b.x, 'role': b.role, 'text': b.text},
    {'paths': [{'c': 0, 's': '', 'q': 0, 'r': NULL}]::STRUCT(c BIGINT, s VARCHAR, q INTEGER, r VARCHAR)[], 'u': '', 'go': false, 'x': 0::BIGINT, 'role': '', 'text': ''}).paths AS paths
  FROM whole),
ended AS (
  SELECT * EXCLUDE paths, list_min(list_transform(paths, lambda p: CASE p.q
    WHEN 1 THEN {'c': p.c + 4, 's': p.s || 'II', 'q': 3, 'r': p.r || chr(10) || 'user:' || chr(10) || 'assistant:'}
    WHEN 2 THEN {'c': p.c + 2, 's': p.s || 'I', 'q': 3, 'r': p.r || chr(10) || 'assistant:'} ELSE p END)) AS best FROM walked)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.s, '') AS audit, sha256(coalesce(best.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""
