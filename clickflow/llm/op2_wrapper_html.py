"""Main text of web pages by wrappers inferred per host.

A page's tokens form a tree of block elements and text slots (inline tags are
transparent, scripts, styles and comments are skipped).  Equal neighbours are folded into
one repeated element.  The wrapper of a host is a union-free regular expression over
such trees, held as a tree itself: the distinct folded trees of the host are aligned
one after another, unmatched elements on either side become optional, and a single
element that meets a repeated one becomes repeated.  Each page is then aligned with its
host's wrapper, which tells the slot of each text.

Over all pages of a host each slot gets its page count, characters, link characters and
whether its text never varies.  Slots under boilerplate elements or names, of
constant text, or of link text are dropped (under ``article`` or ``main`` where the host
has varying text there; its ``h1`` and a page's only texts there stay); of the others those
under ``article`` or ``main`` are the main text, or where a page has none, those in the container with the most
text over the host.

Distinct trees are counted before they meet (so a host with a third of all pages costs
its few distinct trees) and are merged in ``SALTS`` parts and then together.

Nulls and edges: a null or empty html gives the empty text; a null url is a host of its
own; html without tags is all text; a repeated page gets the same result; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common

SALTS = 16
#: Elements nested deeper have no node of their own, so walks are never deeper.
MAX_DEPTH = 150
#: Pages of different html on which a slot must have the same text to count as constant, and the share of
#: link characters from which it is a menu.
CONSTANT_PAGES, LINK_SHARE = 3, 0.5
RESULT = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes", "svg", "math", "object", "canvas"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: Elements that an opening tag of these closes if open.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
BLOCK_CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
                  "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}
#: Elements that these keep an implied close from reaching beyond.
SCOPES = {"ul": "li", "ol": "li", "table": "tr td th", "dl": "dt dd"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "fieldset", "figure-nav"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in class, id or role that mark what is not the article.
BOILERPLATE_NAMES = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent",
    "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "sidebar", "side", "widget", "menu", "nav", "navbar", "navigation",
    "breadcrumb", "breadcrumbs", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist",
    "reply", "replies", "respond", "discussion", "disqus", "footer", "masthead", "topbar", "toolbar", "login", "signin", "signup", "subscribe",
    "subscription", "newsletter", "copyright", "pagination", "pager", "search", "skip", "contentinfo", "complementary", "search-form"}


class Node:
    """An element, or a text slot (symbol ``#``)."""

    __slots__ = ("symbol", "kids", "text", "link", "hidden")

    def __init__(self, symbol: str):
        self.symbol, self.kids, self.text, self.link, self.hidden = symbol, [], "", 0, False


def symbol_of(tag: str, attributes: str) -> tuple[str, bool]:
    """Tag with its class, id and role words (digits left out); whether it is hidden."""
    words, hidden = [], False
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            words += re.findall(r"[a-z]+(?:[-_][a-z]+)*", value)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
    return ".".join([tag, *sorted(set(words))]), hidden


def parse(html: str | None) -> Node:
    """Tree of block elements and text slots of a page."""
    root = Node("")
    stack: list[tuple[str, Node]] = [("", root)]
    unseen: list[int] = []  # places in the stack, beyond MAX_DEPTH, of elements whose texts go
    opened: Counter = Counter()
    parts: list[str] = []
    state = {"link": 0, "in_link": 0}

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                leaf = Node("#")
                leaf.text, leaf.link = text, min(state["link"], len(text))
                # elements beyond MAX_DEPTH have no nodes of their own: their texts are the last one's, in page order
                leaf.hidden = bool(unseen)
                stack[min(len(stack), MAX_DEPTH) - 1][1].kids.append(leaf)
        state["link"] = 0

    def close(names: set[str], scope: str = "") -> None:
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                opened.subtract(t for t, _ in stack[k:])
                del stack[k:]
                while unseen and unseen[-1] >= k:
                    unseen.pop()
                state["in_link"] = 0
                return
            if scope and stack[k][0] in SCOPES and scope in SCOPES[stack[k][0]].split():
                return

    def add(piece: str) -> None:
        parts.append(piece)
        if state["in_link"]:
            state["link"] += len(" ".join(piece.split()))

    html, at = html or "", 0
    while m := TAG.search(html, at):
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ending, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW:
            if not ending and not attributes.rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in INLINE:
            if tag == "a":
                state["in_link"] = 0 if ending else 1
            continue
        if tag in ("br", "wbr", "img"):
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        if ending:
            close({tag}, tag if tag in CLOSES else "")
            continue
        if tag in VOID:
            continue
        if tag in BLOCK_CLOSES_P:
            close({"p"})
        if tag in CLOSES:
            close(CLOSES[tag] - {"p"} if tag != "p" else {"p"}, tag)
        symbol, hidden = symbol_of(tag, attributes)
        node = Node(symbol)
        node.hidden = hidden
        if len(stack) < MAX_DEPTH:
            stack[-1][1].kids.append(node)
        elif hidden or boilerplate((symbol,)):
            unseen.append(len(stack))
        stack.append((tag, node))
        opened[tag] += 1
    if at < len(html):
        add(html[at:])
    flush()
    return root


# A folded tree and a wrapper have the same form:
# [symbol, repeated, optional, [children]]

def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence of two symbol lists: their common
    beginning and end, and a longest one between them.

    ``best[i][j]``, the length from (i, j) on, is one more than ``best[i][j + 1]`` or the
    same, so a row is a number with one bit a column (the last column's lowest, a bit
    cleared where it grows) and follows from the row below by one addition.  Of n rows
    about every square root of n-th is kept, and the rows between are made again on
    the way back, so long lists are aligned as short ones are.
    """
    lo, n, m = 0, len(a), len(b)
    while lo < n and lo < m and a[lo] == b[lo]:
        lo += 1
    while n > lo and m > lo and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    out = [(i, i) for i in range(lo)]
    if n > lo and m > lo:
        places: dict[str, list[int]] = {}
        for j in range(lo, m):
            places.setdefault(b[j], []).append(m - 1 - j)
        full = (1 << (m - lo)) - 1

        @lru_cache(500)
        def mask(symbol: str) -> int:
            bits = bytearray((m - lo + 7) // 8)
            for k in places.get(symbol, ()):
                bits[k >> 3] |= 1 << (k & 7)
            return int.from_bytes(bits, "little")

        def above(row: int, symbol: str) -> int:
            use = row & mask(symbol)
            return ((row + use) | (row - use)) & full

        step = isqrt(n - lo) + 1
        row, kept = full, {n: full}
        for i in range(n - 1, lo - 1, -1):
            row = above(row, a[i])
            if (i - lo) % step == 0:
                kept[i] = row
        j, left = lo, m - lo - kept[lo].bit_count()
        for first in range(lo, n, step):
            last = min(first + step, n)
            rows = [kept[last]]
            for i in range(last - 1, first, -1):
                rows.append(above(rows[-1], a[i]))
            for i in range(first, last):
                if j == m or not left:
                    break
                # of equal lengths the one without a[i]
                below = rows[last - 1 - i]
                without = m - j - (below & ((1 << (m - j)) - 1)).bit_count()
                while j < m and a[i] != b[j] and without < left:
                    without -= 1 - (below >> (m - 1 - j) & 1)
                    j += 1
                if j < m and a[i] == b[j]:
                    out.append((i, j))
                    j, left = j + 1, left - 1
    return out + [(n + k, m + k) for k in range(len(a) - n)]


def merge_kids(a: list, b: list, optional: bool = True) -> list:
    """Union-free alignment of two child lists; unmatched children become optional."""
    spare = lambda x: [x[0], x[1], True if optional else x[2], x[3]]
    out, i, j = [], 0, 0
    for p, q in [*aligned([x[0] for x in a], [x[0] for x in b]), (len(a), len(b))]:
        out += [spare(x) for x in a[i:p]] + [spare(x) for x in b[j:q]]
        if p < len(a) and q < len(b):
            out.append(merge(a[p], b[q]))
        i, j = p + 1, q + 1
    return out


def merge(a: list, b: list) -> list:
    return [a[0], a[1] or b[1], a[2] or b[2], a[3] if a[3] == b[3] else merge_kids(a[3], b[3])]


def fold(node: Node) -> list:
    """The folded tree: neighbours with the same symbol are one repeated element."""
    kids: list = []
    for k in node.kids:
        f = fold(k)
        if kids and kids[-1][0] == f[0]:
            kids[-1] = merge(kids[-1], f)
            kids[-1][1] = True
        else:
            kids.append(f)
    return [node.symbol, False, False, kids]


def slots(node: Node, wrapper: list | None, path: str = "", inside: tuple = ()) -> Iterator[tuple[str, tuple, Node, bool]]:
    """(slot, symbols above, text, hidden) of each text of a page in order; a slot is the
    path of child numbers in the wrapper, or of symbols where the wrapper has none."""
    runs: list[list[Node]] = []
    for k in node.kids:
        if runs and runs[-1][0].symbol == k.symbol:
            runs[-1].append(k)
        else:
            runs.append([k])
    into: list = [None] * len(runs)
    if wrapper is not None:
        for i, j in aligned([r[0].symbol for r in runs], [x[0] for x in wrapper[3]]):
            into[i] = j
    for run, j in zip(runs, into):
        step = f"{path}/{j}" if j is not None else f"{path}/{run[0].symbol}"
        for k in run:
            if k.symbol == "#":
                yield step, inside, k, k.hidden
            else:
                sub = (*inside, k.symbol)
                for s, above, leaf, hidden in slots(k, wrapper[3][j] if j is not None else None, step, sub):
                    yield s, above, leaf, hidden or k.hidden


def names_of(symbol: str) -> set[str]:
    words = symbol.split(".")[1:]
    return {*words, *(p for w in words for p in re.split("[-_]", w))}


@lru_cache(10_000)
def boilerplate(above: tuple) -> bool:
    """Whether an element above a text marks it as something other than the article."""
    in_article = False
    for symbol in above:
        tag = symbol.split(".")[0]
        if tag in BOILERPLATE_TAGS or (tag != "body" and names_of(symbol) & BOILERPLATE_NAMES):
            return True
        if tag in ("article", "main"):
            in_article = True
        # a header is the page's, or holds the article's title beside other things
        if tag == "header" and not (in_article and above[-1].split(".")[0] in HEADINGS):
            return True
    return False


@lru_cache(10_000)
def in_article(above: tuple) -> bool:
    return any(s.split(".")[0] in ("article", "main") or "main" in names_of(s) for s in above)


def container(slot: str, above: tuple) -> str:
    """Slot path of the element that holds a text's block (a paragraph's parent)."""
    up = 2 if above and above[-1].split(".")[0] in HEADINGS | {"p", "li", "pre", "blockquote", "td"} else 1
    return slot.rsplit("/", up)[0]


def main_text(page: Node, wrapper: list | None, roles: dict) -> str:
    """Texts of a page in its content slots."""
    dropped, main = set(roles.get("dropped", ())), roles.get("main", "")
    seen = [(slot, above, leaf) for slot, above, leaf, hidden in slots(page, wrapper) if not hidden and not boilerplate(above)]
    left = [x for x in seen if x[0] not in dropped]
    # dropped slots never empty an article
    got = [x for x in left if in_article(x[1])] or [x for x in seen if in_article(x[1])]
    if not got:
        # the host's main container, with a title beside it
        beside = main.rsplit("/", 1)[0]
        got = [x for x in left if x[0].startswith(main + "/") or (x[0].startswith(beside + "/") and x[1] and x[1][-1].split(".")[0] == "h1")]
        if not any(x[0].startswith(main + "/") for x in got):
            got = [x for x in left if 2 * x[2].link < len(x[2].text)]
    return "\n\n".join(leaf.text for _, _, leaf in got)


def host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit("\x00"))


TREE = T.StructType([T.StructField("host", T.StringType()), T.StructField("tree", T.StringType())])
SLOT = T.StructType([T.StructField("host", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("container", T.StringType()),
                     T.StructField("article", T.BooleanType()), T.StructField("title", T.BooleanType()), T.StructField("low", T.StringType()), T.StructField("high", T.StringType()),
                     T.StructField("contents", T.ArrayType(T.LongType())), T.StructField("chars", T.LongType()), T.StructField("link", T.LongType())])
ROLES = T.StructType([T.StructField("host", T.StringType()), T.StructField("roles", T.StringType())])


def fold_all(f: pd.DataFrame) -> pd.DataFrame:
    """One wrapper of a group's distinct trees."""
    whole = None
    for t in sorted(f.tree):
        whole = json.loads(t) if whole is None else merge(whole, json.loads(t))
    return pd.DataFrame({"host": [f.host.iloc[0]], "tree": [json.dumps(whole, ensure_ascii=False)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, tree): the wrapper of each host of `pages` (host, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict = {}
            for h, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[h, json.dumps(fold(parse(html)), ensure_ascii=False)] = True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in seen]), pa.array([t for _, t in seen])], names=["host", "tree"])

    trees = pages.select("host", "html").mapInArrow(run, TREE).distinct()
    part = trees.withColumn("salt", F.pmod(F.xxhash64("tree"), F.lit(SALTS)))
    some = part.groupBy("host", "salt").applyInPandas(fold_all, TREE)
    return common.written(some.groupBy("host").applyInPandas(fold_all, TREE), "wrappers")


def loaded(cache: dict, value: str | None):
    if value is None:
        return None
    if value not in cache:
        if len(cache) > 500:
            cache.clear()
        cache[value] = json.loads(value)
    return cache[value]


def roles(pages: DataFrame) -> DataFrame:
    """(host, roles): dropped slots and the main container, from all pages of a host
    (columns host, html, tree)."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in batches:
            rows: dict = {}
            for h, html, tree in zip(*(b.column(i).to_pylist() for i in range(3))):
                content = xxhash.xxh64_intdigest((html or "").encode("utf-8", "surrogatepass")) - (1 << 63)
                for slot, above, leaf, hidden in slots(parse(html), loaded(cache, tree)):
                    if hidden or boilerplate(above):
                        continue
                    t = xxhash.xxh128_hexdigest(leaf.text.encode("utf-8", "surrogatepass"))
                    r = rows.setdefault((h, slot, container(slot, above), in_article(above), in_article(above) and above[-1].split(".")[0] == "h1"),
                                        [t, t, [], 0, 0])
                    r[0], r[1], r[3], r[4] = min(r[0], t), max(r[1], t), r[3] + len(leaf.text), r[4] + leaf.link
                    # as many different pages as it takes
                    if len(r[2]) < CONSTANT_PAGES and content not in r[2]:
                        r[2].append(content)
            if rows:
                cols = list(zip(*((*k, *v) for k, v in rows.items())))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=SLOT.fieldNames())

    stats = pages.select("host", "html", "tree").mapInArrow(run, SLOT).groupBy("host", "slot").agg(
        F.min("container").alias("container"), F.max("article").alias("article"), F.max("title").alias("title"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.size(F.array_distinct(F.flatten(F.collect_list("contents")))).alias("pages"), F.sum("chars").alias("chars"), F.sum("link").alias("link"))

    def decide(f: pd.DataFrame) -> pd.DataFrame:
        same = f.low == f.high
        constant = same & (f.pages >= CONSTANT_PAGES)
        links = f.link >= LINK_SHARE * f.chars
        # copies of one page alone tell nothing, nor do articles without varying text
        varied = bool((f.article & ~f.title & ~same & ~links).any())
        gone = (constant & ~f.article & (not same.all())) | (links & ~f.article) | ((constant | links) & f.article & ~f.title & varied)
        left = f[~gone & (f.link < LINK_SHARE * f.chars)]
        by = left.groupby("container").chars.sum()
        main = sorted(by[by == by.max()].index)[0] if len(by) else ""
        return pd.DataFrame({"host": [f.host.iloc[0]], "roles": [json.dumps({"dropped": sorted(f.slot[gone]), "main": main}, ensure_ascii=False)]})

    # a host's slots are those of its wrapper
    return common.written(stats.groupBy("host").applyInPandas(decide, ROLES), "wrapper-roles")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).withColumn("host", host())
    tree = wrappers(rows)
    of_host = tree.join(roles(rows.join(tree, "host")), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in batches:
            texts = [main_text(parse(html), loaded(cache, t), loaded(cache, r) or {}) for html, t, r in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=RESULT.fieldNames())

    return rows.join(of_host, "host").select("page_id", "url", "html", "tree", "roles").mapInArrow(run, RESULT)
