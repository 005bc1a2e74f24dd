"""Main text of pages: markup repairs, things beside the article, templates of a host, odd input."""

import random
import re
from html import unescape

import pytest

from caselight.llm import wrappers
from caselight.llm.wrappers import Page, main_text, match_trees, shape_of, slots
from tests.llm.conftest import rows

SCHEMA = "page_id long, url string, html string"
WORDS = "aben bora cilu dena esti fora gamu hino ilta jeru kalo lumi".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(n)) + "."


def alone(html):
    return main_text(*shape_of(Page(html)), set())


def extracted(spark, pages):
    df = spark.createDataFrame(pages, SCHEMA).repartition(3)
    return {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}


@pytest.mark.parametrize("html, text", [
    ("", ""), ("   ", ""), ("plain words", "plain words"), ("<article></article>", ""),
    ("<article><p>one<p>two</article>", "one\ntwo"),
    ("<article><h1> A &amp; B </h1>\n<p>x&nbsp;y<br>z&#x41;&copy;&am &ampq</p></article>", "A & B\nx y zA©&am &q"),
    ("<article>in<b>li</b>ne <i>text</i><div>block</div>tail</article>", "inline text\nblock\ntail"),
    ("<article><p>a<script>var p='</p><p>no';</script>b</p><style>p{}</style><!-- <p>no --></article>", "ab"),
    ("<article><ul><li>one<li>two <ul><li>in</ul></ul>after</article>", "one\ntwo\nin\nafter"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<article><p title='a > b'>x</p><img alt=\"<p>no</p>\"><p>y", "x\ny"),
    ("<article><p>1 < 2 & 3 > 2</p></article>", "1 < 2 & 3 > 2"),
    ("<article><p>kept</p><p class=\"x>lost</p><p>more</p></article>", "kept\nlost\nmore"),
    ("<p>cut sh<b", "cut sh"), ("<article>a</div></span>b</article>", "ab"),
    ("<head><title>no</title><body><nav>no</nav><p>yes</p><footer>no</footer>", "yes"),
    ("<body><header><h1>site</h1></header><article><header><h1>title</h1></header><p>text</p></article>", "title\ntext"),
    ("<article><p>a</p><aside>no</aside><form><p>no</p></form><div class='share-buttons'>no</div><p hidden>no</p><p>b</p></article>",
     "a\nb"),
    ("<div id=cookie-notice>no</div><div class='leftSidebar'>no</div><main><p>yes</p></main><section class=comments>"
     "<article class=comment><p>no</p></article></section>", "yes"),
    ("<div class='with-sidebar'><div class=header>no</div><h1>t</h1><div class=body><p>a long enough text</p></div></div>",
     "t\na long enough text"),
    ("<div role=navigation>no</div><div role=main><p>a</p><ul><li><a href=x>m</a><li><a href=y>n</a></ul></div>", "a"),
])
def test_markup(html, text):
    assert alone(html) == text


def test_deep_and_hostile_pages():
    assert alone("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert alone("<article>" + "<a \"" * 20000) == ""
    assert alone("<article>" + "<p>x<ul><li>y</ul>" * 2000).count("\n") == 3999
    assert len(alone("<article><p>" + "word " * 400_000)) == 5 * 400_000 - 1


def test_tree_matching_is_simple_and_in_order():
    a = [("r", -1, 0, 0), ("x", 0, 0, 0), ("y", 0, 0, 0), ("z", 2, 0, 0)]
    b = [("r", -1, 0, 0), ("y", 0, 0, 0), ("z", 1, 0, 0), ("x", 0, 0, 0)]
    assert match_trees(a, b) == {0: 0, 2: 1, 3: 2}  # x is crossed by the larger match
    assert match_trees(a, [("q", -1, 0, 0)]) == {}
    assert slots(a, b) == ["0", "0/x", "1", "2"]


def site(rng, k, article, *, marked):
    """A page of a made-up site without helpful names: menu, notice and footer are plain divs that repeat."""
    body = "".join(f"<p>{line}</p>" for line in article)
    extra = f"<div class=q{k}><p>{sentence(rng, 2)}</p></div>" if k % 3 == 0 else ""
    frame = f"<article class=z>{body}</article>" if marked else f"<div class=z>{body}</div>"
    return (f"<html><body><div class=u><p>Home of the made up site</p><p>All about words</p></div>{extra}"
            f"<div class=v>{frame}<p>Thank you for reading these pages of ours</p></div>"
            f"<div class=w><p>Written by nobody, owned by all, 1999 to 2024</p></div></body></html>")


@pytest.mark.parametrize("marked", [True, False])
def test_template_of_a_host_goes(spark, marked):
    rng = random.Random(7)
    articles = {i: [sentence(rng, rng.randrange(8, 30)) for _ in range(rng.randrange(3, 7))] for i in range(30)}
    promise = "This line stands in every article of the site."
    pages = [(i, f"http://one.example.com/{i}", site(rng, i, [*a, promise], marked=marked)) for i, a in articles.items()]
    found = extracted(spark, pages)
    assert all(found[i] == "\n".join(a) for i, a in articles.items())


def test_copies_of_an_article_are_no_template(spark):
    rng = random.Random(8)
    lines = [sentence(rng, 20), sentence(rng, 5), sentence(rng, 4)]
    copies = [(i, "http://two.example.com/a", site(rng, 1, lines, marked=True)) for i in range(40)]
    others = [(100 + i, "http://two.example.com/b", site(rng, 1, [sentence(rng, 12)], marked=True)) for i in range(3)]
    found = extracted(spark, copies + others)
    assert all(found[i] == "\n".join(lines) for i in range(40))


def test_both_joins_agree(spark, monkeypatch):
    rng = random.Random(9)
    pages = [(i, f"http://h{i % 3}.example.com/", site(rng, i, [sentence(rng, 9), "Always here."], marked=i % 2 == 0))
             for i in range(60)]
    small = extracted(spark, pages)
    monkeypatch.setattr(wrappers, "BROADCAST_ROWS", -1)
    assert extracted(spark, pages) == small and any("Always" not in text for text in small.values())


def test_odd_rows(spark):
    pages = [(1, None, None), (1, "no address", ""), (None, "http://x/", "<p>a"), (None, "http://x/", "<p>a")]
    df = spark.createDataFrame([(*p, 1, "s") for p in pages], SCHEMA + ", text int, host string")
    assert rows(wrappers.extract(df), "page_id", "url", "text", "n_chars") == sorted(
        [(1, None, "", 0), (1, "no address", "", 0), (None, "http://x/", "a", 1), (None, "http://x/", "a", 1)], key=repr)
    assert wrappers.extract(df.limit(0)).collect() == []


def test_given_pages(spark, sf):
    """Every page of the smallest table against a reading of its one article."""
    found = {r["page_id"]: r for r in wrappers.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search("<article>(.*?)</article>", page["html"], re.S).group(1)
        lines = [" ".join(unescape(re.sub("<[^>]*>", " " if "<br>" in part else "", part)).split())
                 for part in re.split("</?(?:p|h1)>", inner)]
        text = "\n".join(line for line in lines if line)
        assert found[page["page_id"]]["text"] == text and found[page["page_id"]]["n_chars"] == len(text)


def test_template_of_pages_that_share_no_shape(spark):
    """A text that stands once in each of many shapes is template as soon as the slot has it on enough pages."""
    rng = random.Random(8)
    bodies = [[sentence(rng, 12), sentence(rng, 9)] for _ in range(8)]
    pages = [(k, "http://own.example/", f"<body><article class=z><p>{a}</p><p>{b}</p><div class=w><p>Read on at our own site</p></div>"
                                        f"<div class=q{'abcdefgh'[k]}><p>{sentence(rng, 3)}</p></div></article>")
             for k, (a, b) in enumerate(bodies)]
    assert len({str(shape_of(Page(html))[0]) for _, _, html in pages}) == 8
    found = extracted(spark, pages)
    assert all("Read on" not in found[k] and found[k].startswith("\n".join(body)) for k, body in enumerate(bodies))
    few = extracted(spark, pages[:4])
    assert all("Read on at our own site" in few[k] for k in range(4))
