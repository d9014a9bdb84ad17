"""Conversation repair against an independent recursion, an exhaustive search, and spills."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import duckdb

from clickflow.llm import common, op12_conversation_repair as op

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        if k == 1:
            text = ""
        elif k == 2:
            text = re.sub("[.!?]", "", text)
        elif k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        if not last:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("ok" if last[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """(cost, audit, repaired turns) by recursion from the front, with the letters kept."""
    @functools.cache
    def go(i, done):
        # done: the last one or two initials are enough to know what may follow
        best = []
        if i == len(rows) and done in ("", "a"):
            best.append((0, "", ()))
        for role in ("user", "assistant"):
            if (role[0] == "u" and done != "u") or (role[0] == "a" and done == "u"):
                if (i, done) not in inserting or inserting[i, done] < 2:
                    inserting[i, done] = inserting.get((i, done), 0) + 1
                    c, a, t = go_after_insert(i, role[0], 1)
                    best.append((c + 2, "I" + a, ((role, ""), *t)))
                    inserting[i, done] -= 1
        if i < len(rows):
            best += take(i, done, lambda j, d: go(j, d))
        return min(best, key=lambda b: b[:2]) if best else (10 ** 9, "", ())

    def go_after_insert(i, done, depth):
        best = []
        if i == len(rows) and done == "a":
            best.append((0, "", ()))
        if depth < 4:
            role = "assistant" if done == "u" else "user"
            c, a, t = go_after_insert(i, role[0], depth + 1)
            best.append((c + 2, "I" + a, ((role, ""), *t)))
        if i < len(rows):
            best += take(i, done, lambda j, d: go(j, d))
        return min(best, key=lambda b: b[:2]) if best else (10 ** 9, "", ())

    def fits(done, initial):
        return (initial == "s" and done == "") or (initial == "u" and done != "u") or (initial == "a" and done == "u")

    def take(i, done, rest):
        _, _, role, text = rows[i]
        extra, out = int(kinds[i] == "truncated"), []
        c, a, t = rest(i + 1, done)
        out.append((c + 3, "D" + a, t))
        if kinds[i] in ("ok", "truncated"):
            if role[:1] in ("s", "u", "a") and fits(done, role[0]):
                c, a, t = rest(i + 1, role[0])
                out.append((c + extra, "K" + a, ((role, text), *t)))
            for new in ("user", "assistant"):
                if fits(done, new[0]):
                    c, a, t = rest(i + 1, new[0])
                    out.append((c + 2 + extra, "R" + a, ((new, text), *t)))
        return out

    inserting: dict = {}
    return go(0, "")


def expected(rows):
    """Result rows of op12 by conversation id for raw `rows`."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(damaged([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        kinds = faults(mine)
        turns = {r[1] for r in mine if r[1] is not None}
        initials = [r[2][:1] for r in mine]
        cost, audit, repaired = cheapest(mine, kinds)
        assert GRAMMAR.fullmatch("".join(r[0] for r, _ in repaired))
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df, **kw):
    rows = op.audits(op.damage(df), **kw).collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_tiny_conversations_by_exhaustive_search():
    """Every edit script of up to n + 4 letters, held against the program."""
    texts = {"ok": "fine.", "truncated": "cut", "blank": " "}
    steps = op.Steps(op.Costs())
    for n in range(4):
        for roles in itertools.product("sua", repeat=n):
            for kinds in itertools.product(("ok", "truncated", "blank"), repeat=n) if n < 3 else [("ok",) * n]:
                best = []

                def scripts(i, so_far, cost, letters, left):
                    if i == n and GRAMMAR.fullmatch(so_far):
                        best.append((cost, letters))
                    if left == 0:
                        return
                    for r in "ua":
                        scripts(i, so_far + r, cost + 2, letters + "I", left - 1)
                    if i < n:
                        scripts(i + 1, so_far, cost + 3, letters + "D", left - 1)
                        if kinds[i] != "blank":
                            extra = int(kinds[i] == "truncated")
                            scripts(i + 1, so_far + roles[i], cost + extra, letters + "K", left - 1)
                            for r in "ua":
                                scripts(i + 1, so_far + r, cost + 2 + extra, letters + "R", left - 1)

                scripts(0, "", 0, "", n + 2)
                c = op.Conversation(1, steps)
                for i, (r, k) in enumerate(zip(roles, kinds)):
                    c.add(i, r, texts[k] + ("" if k == "blank" else str(i)), {"ok": op.OK, "truncated": op.TRUNCATED, "blank": op.BLANK}[k])
                c.finish()
                assert (c.cost, c.audit) == min(best)


def random_rows(seed, convs):
    rnd = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rnd.randint(1, 9)):
            role = rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rnd.choice(["Yes.", "No!", "why", "  ", "", None, "the same. ", "a b c?\n", "x.y", f"turn {turn}."])
            rows.append((rnd.choice([conv, conv, conv, conv + 1]), rnd.choice([turn, turn, turn, turn * 3, None]), role, text))
    return rows


def test_random_conversations_against_recursion(spark):
    common.prepare(spark)
    rows = random_rows(3, 150) + [(None, 1, "user", "no id."), (None, None, "assistant", "none"), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == expected(rows)


def test_whole_table_against_recursion(spark):
    df = common.table(spark, SF, "conversations")
    rows = [tuple(r) for r in df.collect()]
    assert got(df) == expected(rows)


def test_empty_tables_and_clashing_columns(spark):
    common.prepare(spark)
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    rows = [(7, 2, "user", "hi."), (7, 2, "user", "hi."), (7, 3, "assistant", "yes.")]
    df = spark.createDataFrame([(*r, True, "x", 1) for r in rows], SCHEMA + ", dropped boolean, conv string, fault int")
    assert got(df) == expected(rows)


def test_giant_conversation_spills_and_crosses_batches(spark):
    common.prepare(spark)
    rnd = random.Random(9)
    rows = [(1, i, rnd.choice(["user", "assistant", "user", "assistant", "system"]), rnd.choice([f"turn {i}.", f"turn {i}", "again.", " "]))
            for i in range(6000)] + [(2, 0, "user", "Hello?")]
    df = spark.createDataFrame(rows, SCHEMA)
    small = got(df, spill_bytes=1000)
    assert small == got(df)
    c = small[1]
    # every row has one letter, and the repaired turns give the digest
    assert c[6].replace("I", "").__len__() == len(damaged([r for r in rows if r[0] == 1]))
    turns = sorted((r for r in op.repair(op.damage(df), spill_bytes=1000).collect() if r.conv_id == 1), key=lambda r: r.position)
    assert [r.position for r in turns] == list(range(len(turns)))
    assert GRAMMAR.fullmatch("".join(r.role[0] for r in turns)) and {r.edit for r in turns} <= set("KRI")
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest() == c[7]


def test_spool_reads_what_was_written():
    s = op.Spool(10)
    data = bytes(range(97))
    for i in range(0, 97, 7):
        s.write(data[i:i + 7])
    assert len(s) == 97 and all(s.read(a, n) == data[a:a + n] for a in (0, 5, 60, 90, 96) for n in (1, 9, 50, 200))
    s.close()


def test_long_texts(spark):
    common.prepare(spark)
    long = "word " * 400_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (1, 2, "user", long), (1, 3, "user", " " * 1_000_000)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_sql_statement_of_odd_rows():
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    assert con.execute(op.SQL).fetchall() == []
    rows = random_rows(5, 200) + [(None, 1, "user", "no id."), (None, None, "assistant", "none"), (None, None, None, None), (-3, -7, "s", "é!")]
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: tuple(r[1:]) for r in con.execute(op.SQL).fetchall()} == expected(rows)
