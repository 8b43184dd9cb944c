"""Operator 8: hand-made pages, an independent reading of the given pages, edge cases."""

import html
import re

import pytest

from aerolake.llm import html_text as h
from aerolake.llm import html_training
from aerolake.llm.common import prepare

PROSE = "The court of the town held that no toll was due on boats that were built before the great storm of that year."

CASES = [
    (None, ""), ("", ""), ("<", None), ("no markup " * 20, None),
    ("<article>A &amp; B &lt;c&gt; &#233;&nbsp;x</article>", "A & B <c> é x"),
    ("<article><p>a\n  b<br>c</p><p>d<br><br>e</p></article>", "a b c\n\nd\n\ne"),
    ("<article><p>one<script>var a='</p>';</script> two<!-- x --><style>p{}</style></p></article>", "one two"),
    ("<article><p title='a>b' class=\"x\">quoted</p><p hidden>no</p><p style='display: none'>no</p></article>", "quoted"),
    ("<article><p>un<b>closed <p>next</b> one<div>inner</article><footer>f", "unclosed\n\nnext one\n\ninner"),
    ("<body><nav><ul><li><a>x</a></ul></nav><article>t<aside>a</aside>u</article></body>", "t\n\nu"),
    ("<article><p>kept</p><section id='comments'><p>no</p></section><form>no</form></article>", "kept"),
    ("<div class='sidebar'><p>no</p></div><article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
    ("<nav>only</nav><footer>this</footer>", ""),
    ("<article><p>" + "w " * 50_000 + "</p></article>", ("w " * 50_000).strip()),
    ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<article><p>a</p></b></div></p><p>b", "a\n\nb"),
    ("<article><script>never closed <p>x</p>", ""),
    ("<article><p a=\"unclosed>x</p><p>y</p></article>", None),
    # formulas and what stands in for media are inline text; form fields are none, and cut no sentence
    ("<article><p>we see <math><mi>x</mi><mo>=</mo><msup><mn>2</mn><mi>n</mi></msup><annotation>x=2^n</annotation></math> holds.</p></article>",
     "we see x=2n holds."),
    ("<article><p>the <video><source src=a>film of it</video> and <iframe>no</iframe>the <select><option>no</select>rest</p></article>",
     "the film of it and the rest"),
    # sections of an article whose names may be those of something else
    (f"<article><h1>T</h1><p>{PROSE}</p><section id='discussion'><h2>Discussion</h2><p>{PROSE}</p></section>"
     f"<div class='legal-history'><p>{PROSE}</p></div><div class='related'><p><a>{PROSE}</a></p></div><div class='ad'>{PROSE}</div></article>",
     "\n\n".join(["T", PROSE, "Discussion", PROSE, PROSE])),
    (f"<article><p>{PROSE}</p></article><section id='discussion'><p>{PROSE}</p></section>", PROSE),
]


def test_cases():
    for page, expected in CASES:
        text = h.main_text(page)
        assert expected is None or text == expected, page


def test_tree_learns_its_table():
    x, y = h.labelled_rows(html_training.PAGES)
    assert len(y) < 200
    wrong = sum(p != t for p, t in zip(h.DecisionTree(x, y).predict(x.tolist()), y))
    assert wrong <= 0.02 * len(y)


def test_left_out_pages():
    pages = html_training.PAGES
    right = total = 0
    for i in range(len(pages)):
        tree = h.DecisionTree(*h.labelled_rows(pages[:i] + pages[i + 1:]))
        x, y = h.labelled_rows(pages[i:i + 1])
        right += sum(p == t for p, t in zip(tree.predict(x.tolist()), y))
        total += len(y)
    assert right >= 0.85 * total


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_on_given_pages(spark, sf):
    """The article element of these pages, cut at its block tags, read apart."""
    from aerolake.llm import queries

    sf_dir = f"/root/testdata/{sf}"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    out = queries.op8_html_text(spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split())
                 for x in re.split(r"</?(?:p|h1|br|li|ul)[^>]*>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_frame(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, p, "u") for i, (p, _) in enumerate(CASES)] + [(0, None, None)],
                               "page_id long, html string, words string")
    out = h.extract_text(df)
    assert out.columns == ["page_id", "words", "text"] and out.count() == len(CASES) + 1
    assert out.where("text is null").count() == 0
    assert h.extract_text(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        h.extract_text(df, text_col="words")
