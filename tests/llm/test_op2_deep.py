"""Pages that are very deep, wide or long, and hosts where only the wrapper can tell the article."""

import random
import time

import pytest

from clickflow.llm import common, op2_wrapper_html as op
from helpers import sentence


def texts(spark, pages):
    common.prepare(spark)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in op.extract(df).collect()}


def test_deep_wide_and_long_pages(spark):
    nested = "<div>" * 50_000 + "deep words" + "</div>" * 50_000
    sides = "".join(f"<h2>t{i}</h2><p>p{i}</p>" for i in range(25_000))
    open_only = "<p>one" + "<div>x" * 20_000 + "</span>" * 20_000 + "</p>" * 20_000
    long = "<article><p>" + "many words &amp; more " * 100_000 + "</p></article>"
    pages = [(1, "http://a.example/1", f"<html><body><article>{nested}<p>after</p></article></body></html>"),
             (2, "http://b.example/1", f"<html><body><article>{sides}</article></body></html>"),
             (3, "http://b.example/2", f"<html><body><article><p>first</p>{sides}</article></body></html>"),
             (4, "http://c.example/1", open_only), (5, "http://d.example/1", long)]
    began = time.time()
    got = texts(spark, pages)
    assert time.time() - began < 120
    assert got[1] == "deep words\n\nafter"
    assert got[2] == "\n\n".join(f"t{i}\n\np{i}" for i in range(25_000)) and got[3] == "first\n\n" + got[2]
    assert got[4].count("x") >= 19_000 and got[5] == ("many words & more " * 100_000).strip()


def test_hidden_and_boilerplate_beyond_the_depth_bound(spark):
    down = "<div>" * 400
    html = f"<article>{down}<p>kept</p><div hidden>not shown</div><div class='newsletter'>sign up</div>tail{'</div>' * 400}</article>"
    assert texts(spark, [(1, "http://a.example/", html)])[1] == "kept\n\ntail"


def test_alignments_agree():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.choice("abcde") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        pairs = op.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(pairs) == best[-1][-1]
    a = ["h", "p"] * 3000
    b = ["x", *a[:2000], "y", "z", *a[2000:]]
    pairs = op.aligned(a, b)
    assert len(pairs) > 5900 and all(a[i] == b[j] for i, j in pairs)


def table_alignment(a, b):
    """A longest common subsequence from the whole table; of equal ones that without a's symbol."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def test_alignments_of_any_length_are_longest():
    rnd = random.Random(4)
    for n, m in [(1, 7), (30, 40), (90, 20), (700, 600), (40, 9_000)]:
        for symbols in ("ab", "abcdefghijkl"):
            # different ends, so nothing is settled before the table
            a, b = (["<", *(rnd.choice(symbols) for _ in range(k)), ">"][i:][:k + 1] for i, k in enumerate((n, m)))
            assert op.aligned(a, b) == table_alignment(a, b)
    a, b = ([x + str(i % 7) for i in range(25_000) for x in "hp"[k:] + "x"] for k in (0, 1))
    began = time.time()
    pairs = op.aligned(a, b[1:])
    assert len(pairs) == len(b) - 1 and all(a[i] == (b[1:])[j] for i, j in pairs[::1000]) and time.time() - began < 60


def plain_host(k, n, rnd):
    """Pages without article elements or telling names; what is the article only shows across pages."""
    names = ["q%s" % "abcdefgh"[i] for i in rnd.sample(range(8), 5)]
    menu = "".join(f"<li><a href='/{i}'>{sentence(10 * k + i, 2)}</a></li>" for i in range(6))
    notice, foot = sentence(500 + k, 30), sentence(600 + k, 25)
    for i in range(n):
        body = [sentence(1000 * (k + 1) + 10 * i + j, rnd.randint(12, 40)) for j in range(rnd.randint(2, 6))]
        title = sentence(9000 * (k + 1) + i, 5)
        html = (f"<html><body><div class='{names[0]}'><ul>{menu}</ul></div><div class='{names[1]}'><p>{notice}</p></div>"
                f"<div class='{names[2]}'><h1>{title}</h1>{''.join(f'<p>{x}</p>' for x in body)}</div>"
                f"<div class='{names[3]}'><ul>{''.join(f'<li><a href=x>{sentence(70000 + 50 * k + 7 * i + j, 4)}</a></li>' for j in range(4))}</ul></div>"
                f"<div class='{names[4]}'><p>{foot}</p></div></body></html>")
        yield f"http://h{k}.example/{i}", html, "\n\n".join([title, *body])


def test_only_the_wrapper_tells_the_article(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [x for k in range(4) for x in plain_host(k, 12, rnd)]
    got = texts(spark, [(i, url, html) for i, (url, html, _) in enumerate(rows)])
    assert [got[i] for i in range(len(rows))] == [want for _, _, want in rows]
    # without the wrapper and its slots, a page alone does not give its text
    alone = [op.main_text(op.parse(html), None, {}) for _, html, _ in rows]
    assert sum(a == want for a, (_, _, want) in zip(alone, rows)) == 0
