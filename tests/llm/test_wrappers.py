import html
import re

from ordermill.llm import wrappers
from ordermill.llm.queries import QUERIES

PAGE = (
    '<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="wrap"><div class="cookie-notice">We use</div><main><article><h1>T</h1>'
    '<p>A &amp;amp; b<br>c <i>d</i>e<p>x&nbsp; y</p><div class="ad-slot">buy</div><ul><li>one<li>two</ul><table><tr><td>1<td>2</table>'
    '<section id="comments"><p>first!</p></section><script>var t="</p>";</script></article></main><aside>side</aside></div><form><input>go</form><!-- <p>no</p> --><footer>f</footer></body>'
)


def test_article_of_a_page():
    assert wrappers.main_text(PAGE, {}) == "T\nA &amp; b c de\nx y\none\ntwo\n1\n2"
    assert wrappers.main_text("plain &lt;3 <p>hi\n  there", {}) == "plain <3\nhi there"
    assert wrappers.main_text("", {}) == wrappers.main_text("<nav>menu</nav>", {}) == ""
    assert wrappers.main_text('<body><div class="menu">m</div><div class="content"><p>a</p><div class="comments">c</div></div></body>', {}) == "a"


def test_streams_fold_and_align():
    fold = lambda page: wrappers.as_expression(wrappers.page_pattern(page))
    assert fold("<ul><li>a</li><li>b</li><li><b>c</b></li></ul>") == "(<ul> (<li> (#)? (<b> # </b>)? </li>)+ </ul>)"
    a, b = wrappers.page_pattern("<div>x</div><p>y</p>"), wrappers.page_pattern("<div>x</div><nav>m</nav><p>y</p><p>z</p>")
    both = wrappers.align(a, b)
    assert wrappers.as_expression(both) == "(<div> # </div>) (<nav> # </nav>)? (<p> # </p>)+"
    assert wrappers.align(both, a) == both == wrappers.align(both, b)


def plain(page):
    """The article of the given tables' pages, which have one flat layout."""
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_all_given_pages(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op8_html"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        page = pages[r["page_id"]]
        assert r["url"] == page["url"] and r["text"] == plain(page["html"]) and r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    rows = [(1, "http://h.example/a", PAGE), (1, "http://h.example/a", PAGE), (2, "http://h.example/b", None), (3, None, "<p>x"), (4, "", ""), (None, "no url", "<b>q"), (5, "http://h.example/c", "<article>" + "<p>é</p>" * 30_000)]
    df = spark.createDataFrame([(*r, "e", "f") for r in rows], "page_id long, url string, html string, host string, wrapper string")
    got = sorted(((r["page_id"] or 0, r["n_chars"], r["text"][:3]) for r in wrappers.extract(df).collect()))
    one = len(wrappers.main_text(PAGE, {}))
    assert got == [(0, 1, "q"), (1, one, "T\nA"), (1, one, "T\nA"), (2, 0, ""), (3, 1, "x"), (4, 0, ""), (5, 59_999, "é\né")]
    assert wrappers.extract(df.limit(0)).count() == 0


def test_broken_markup_ends():
    for page in ("<p", "<!-- x", "<script>a", "<a href='x>y", "</p></p>", "<div " + "a=" * 20_000, "<" * 20_000, "<b>" * 3000 + "t"):
        wrappers.main_text(page, {})
