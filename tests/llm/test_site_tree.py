"""Main text of pages: reading of tags, the tree of a site, and what pages declare."""

import html
import random
import re

import pytest

from tabloom.llm import QUERIES, site_tree

SHAPE = "page_id long, url string, html string, text string, n_chars int, site int, kept int"


def texts(spark, pages, **options):
    rows = [(i, u, h, "t", 1, 2, 3) for i, u, h in pages]
    found = site_tree.extract(spark.createDataFrame(rows, SHAPE).repartition(3), **options)
    assert found.columns == ["page_id", "url", "text"]
    return {r.page_id: r.text for r in found.collect()}


def blocks(page):
    return [t for _, kind, t in site_tree.Page(page).blocks if kind != site_tree.OTHER]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", []),
        ("plain  text\n&amp; more &lt;b&gt; &#233;&nbsp;x", ["plain text & more <b> é x"]),
        ("<p>a<b>b</b>c<br>d <p>e<div>f</div>g", ["abc d", "e", "f", "g"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<dl><dt>a<dd>b<dt>c</dl><table><tr><td>d<td>e<tr><th>f</table>", list("abcdef")),
        ("<table><tr><td><p>a</div>b</td></tr></table>c", ["ab", "c"]),
        ("<h1>a<h2>b</h1>c", ["a", "b", "c"]),
        ("a < b <3 <!-- x > y --> c <!doctype z> d <?php e ?> f", ["a < b <3 c d f"]),
        ("a<!-- never closed <p>b", ["a"]),
        ("a<!-->b<!--->c", ["abc"]),
        ('<script>var t="</p><p>";</script>x<style>p{}</style><SCRIPT>y</script >z', ["xz"]),
        ("<title>t</title>x<script>never closed", ["x"]),
        ('<p title="a > b" data-x=\'c > d\'>e</p>', ["e"]),
        ('<p>a<a href="x>never closed <p>b', ["a"]),
        ("<p>cut &am", ["cut &am"]),
        ("<p>cut <b", ["cut"]),
        ("</p></div>a</p>b", ["ab"]),
        ("<article><header><h1>T</h1></header><p>a<aside>b</aside><footer>c</footer></article>", ["T", "a"]),
        ("<header>x</header><p>a <button>go</button>b<span class='ad box'>c</span>d", ["a bd"]),
        ("<form><p>f</p><main><p>a</p></main></form><nav>n</nav>", ["a"]),
        ("<div class='comments'><article>c</article></div><article class=comment>d</article>e", ["e"]),
        ("<body class='has-sidebar'><div id=page-2-header>h</div><div class='no-ads'>a</div>", ["a"]),
        ("<div class='ad-unit'>x</div><div class='shadow'>a</div><div class=SideBar>y</div>", ["a"]),
        ("<div class='sideBar'>x</div><div class='cookieNotice'>y</div><div class='reader'>a</div>", ["a"]),
        ("<form>a<textarea>b</textarea><select><option>c</select></form>d<input value=e>", ["d"]),
    ],
)
def test_blocks(page, expected):
    assert blocks(page) == expected


def test_reading_takes_time_in_proportion():
    for piece in ("<a ", '<a b="', "<!--", "<div>", "</div>", "<p class=x>", "a<", "<li>", "<td>", "&amp", "<b><p>"):
        site_tree.Page(piece * 40_000)


def words(rng, n=30):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def site(rng, name, n, first, at=lambda body, box: f"<div class=k1>{box}</div><div class=k2>{body}</div>"):
    """Pages without any telling name: a box that is one of three texts, and a body."""
    boxes = [words(rng, 8) for _ in range(3)]
    out, expected = [], {}
    for k in range(first, first + n):
        body = [words(rng) for _ in range(rng.randint(1, 6))]
        inner = "".join(f"<p>{t}</p>" for t in body)
        out.append((k, f"https://{name}/{k}", f"<html><body>{at(inner, rng.choice(boxes))}</body></html>"))
        expected[k] = "\n\n".join(body)
    return out, expected


def test_tree_finds_the_furniture_of_a_site(spark):
    rng = random.Random(2)
    large, first = site(rng, "a.example.com", 400, 0)
    # On another host the same names mean the opposite.
    other, second = site(rng, "b.example.com", 400, 1000, lambda body, box: f"<div class=k1>{body}</div><div class=k2><p>{box}</p></div>")
    # A host with few pages is judged by the tree of all.
    small, third = site(rng, "c.example.com", 3, 2000, lambda body, box: f"<div class=k9>{body}</div><div class=k1>{box}</div>")
    assert texts(spark, [*large, *other]) == {**first, **second}
    assert texts(spark, [*large, *small]) == {**first, **third}
    everything = texts(spark, large, threshold=0.0)
    assert all(first[k] in everything[k] and first[k] != everything[k] for k in first)


def test_copies_of_an_article_stay(spark):
    page = "<nav>menu</nav><article><h1>Title</h1><p>The same article.</p></article><div class=x>the same box</div>"
    found = texts(spark, [(i, "https://copies.example.com/x", page) for i in range(300)])
    assert set(found.values()) == {"Title\n\nThe same article."}


def test_odd_rows(spark):
    rows = [
        (1, None, "<article>a</article>"),
        (2, "no host", "<article>a</article>"),
        (3, "http://x.example.com", None),
        (4, "http://x.example.com", ""),
        (5, "http://x.example.com", "<nav>only a menu</nav>"),
        (6, "HTTP://u:p@X.example.com:80/y?z", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000),
        (7, "http://x.example.com", "<article><p>" + "long " * 500_000),
    ]
    found = texts(spark, rows)
    assert found == {1: "a", 2: "a", 3: "", 4: "", 5: "", 6: "deep", 7: ("long " * 500_000).strip()}
    assert site_tree.host("HTTP://u:p@X.example.com:80/y?z") == "x.example.com"
    twice = site_tree.extract(spark.createDataFrame([(1, "u", "<p>a</p>")] * 3 + [(None, "u", "b")], "page_id long, url string, html string"))
    assert sorted(r.text for r in twice.collect()) == ["a", "a", "a", "b"]


def test_nothing(spark):
    assert texts(spark, []) == {}


def test_query_gives_the_articles(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = QUERIES["op11_main_text"](spark, sf_dir)
    assert found.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = re.split("</?(?:h1|p)>", inner.replace("<br>", " "))
        plain = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in parts]
        assert r.text == "\n\n".join(x for x in plain if x) and r.n_chars == len(r.text)
