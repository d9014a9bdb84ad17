from clickflow.llm import common, op2_wrapper_html as op
from helpers import sentence


def page(i, body, extra=""):
    return f"""<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var x="</p><p>no</p>";</script></head><body>
<header><a href="/">Site</a></header><ul class="main-menu"><li><a href=1>Home</a><li><a href=2>News {i}</a></ul>
<div id=wrap><div class="content"><h1>Title {i} &amp; co</h1><div>We use cookies. Accept</div>{body}{extra}<!-- <p>gone</p> --></div>
<div class="right-col"><p>Latest {i}</p><ul><li><a href=x>story {i}</a></li><li><a href=y>story {i + 1}</a></li></ul></div>
<section class="comments"><article><p>I agree {i} with all of this, really I do</p></article></section></div>
<form><label>Mail</label><input></form><div>Copyright 2020</div></body></html>"""


def paragraphs(i, n):
    return [f"{sentence(10 * i + k, 20)} <with> \"quotes\" é" for k in range(n)]


def html_of(p):
    return "<p>" + p.replace("&", "&amp;").replace("<", "&lt;").replace(" é", "\n  <b>&eacute;</b>")


def test_wrapped_hosts(spark):
    common.prepare(spark)
    rows, want = [], {}
    for i in range(12):
        ps = paragraphs(i, 2 + i % 3)
        extra = f"<blockquote><p>quote {i}</p></blockquote>" if i % 2 else ""
        rows.append((i, f"http://a.example/{i}", page(i, "".join(map(html_of, ps)), extra), 1))
        want[i] = "\n\n".join([f"Title {i} & co", *ps, *([f"quote {i}"] if extra else [])])
    for i in range(20, 26):
        ps = paragraphs(i, 3)
        rows.append((i, f"https://b.example:8080/{i}", "<body><nav><a href=1>x</a></nav><article><h1>Head</h1>" + "".join(f"{html_of(p)}</p>" for p in ps)
                     + "<div class='ad-box'>Buy</div></article><aside>more</aside><footer>f</footer>", 1))
        want[i] = "\n\n".join(["Head", *ps])
    for i in range(30, 34):  # copies of one page alone
        rows.append((i, f"http://f.example/{i}", "<div><h1>same</h1><p>words of the copy</p></div>", 1))
        want[i] = "same\n\nwords of the copy"
    rows += [(90, None, None, 1), (91, None, "", 1), (92, "u", "just text\n here", 1), (93, "http://c.example/", "<p>one<br>two<p>three</p>", None),
             (93, "http://c.example/", "<p>one<br>two<p>three</p>", None), (None, "http://d.example", "<div><p>no id", 1), (94, "http://e.example", "<p title='a > b'>x &lt; y</p><p", 1)]
    want |= {90: "", 91: "", 92: "just text here", 93: "one two\n\nthree", None: "no id"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = op.extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id == 94:
            assert r.text.startswith("x < y")
        else:
            assert r.text == want[r.page_id], r.page_id
    assert op.extract(df.where("page_id > 1000")).count() == 0


def test_alignment_makes_optional_and_repeated_elements():
    a = op.fold(op.parse("<div><p>x</p><p>y</p></div>"))
    b = op.fold(op.parse("<div><h1>t</h1><p>x</p></div>"))
    div = op.merge(a, b)[3][0]
    assert [(k[0], k[1], k[2]) for k in div[3]] == [("h1", False, True), ("p", True, False)]


def test_whole_table(spark):
    got = op.extract(common.table(spark, "/root/testdata/sf0.01", "pages")).collect()
    assert len(got) == 250 and all(r.text and "<" not in r.text.split("\n\n")[0][:1] for r in got)
    html = {r.page_id: r.html for r in common.table(spark, "/root/testdata/sf0.01", "pages").collect()}
    import html as h
    import re
    for r in got:
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1])
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in blocks if x)
