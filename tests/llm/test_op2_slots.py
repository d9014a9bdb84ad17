from clickflow.llm import common, op2_wrapper_html as op
from helpers import sentence


def texts(spark, rows):
    common.prepare(spark)
    df = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id long, url string, html string, host int")
    return [(r.page_id, r.text) for r in op.extract(df).collect()]


def test_long_openings_and_copies_are_not_constant(spark):
    opening = sentence(3, 60)  # over 200 characters
    rows = [(i, f"http://a.example/{i}", f"<body><div class=body><h1>Title {i}</h1><p>{opening} then {i}</p></div><div class=foot><p>Same foot</p></div>") for i in range(5)]
    # three copies of the one page that has a quote
    rows += [(9, "http://a.example/9", "<body><div class=body><h1>Title 9</h1><p>text of nine</p><blockquote>its quote</blockquote></div>"
              "<div class=foot><p>Same foot</p></div>")] * 3
    want = [(i, f"Title {i}\n\n{opening} then {i}") for i in range(5)] + [(9, "Title 9\n\ntext of nine\n\nits quote")] * 3
    assert sorted(texts(spark, rows)) == want


def test_slots_inside_an_article_are_judged(spark):
    rows = [(i, f"http://b.example/{i}", f"<article><h1>One title</h1><p>{sentence(i, 30)}</p><div class=zq>Buy this now</div><p>{sentence(50 + i, 30)}</p>"
             f"<ul class=xy><li><a href=1>next {i}</a><li><a href=2>last {i}</a></ul></article>") for i in range(6)]
    rows.append((7, "http://b.example/7", "<article><div class=zq>Buy this now</div></article>"))
    want = [(i, f"One title\n\n{sentence(i, 30)}\n\n{sentence(50 + i, 30)}") for i in range(6)] + [(7, "Buy this now")]
    assert sorted(texts(spark, rows)) == want
    # articles without varying text
    same = [(i, f"http://c.example/{i}", f"<article><p>always the same</p></article><!-- {i} -->") for i in range(4)]
    assert {t for _, t in texts(spark, same)} == {"always the same"}
