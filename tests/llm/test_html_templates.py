import html as H
import random
import re
from collections import Counter

import pytest
import pyarrow.parquet as pq

from dirbook.llm.html_templates import _substring_hashes, host_of, main_text, parse, without


def text(source):
    return "\n".join(parse(source).texts)


@pytest.mark.parametrize("source, want", [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a<p>b<br>c<b>d</b>e", "a\nb\ncde"),
    ("<title>t</title><article><h1>x &amp;amp; y</h1><p>1 &lt; 2 &copy &am</article>after", "x &amp; y\n1 < 2 © &am"),
    ('<script>var t="</p>";</script><style>p{}</style><p>ok<!-- <p>no --></p>', "ok"),
    ('<div class="ad">no</div><div id="site-footer">no</div><div class="adorable">yes</div>', "yes"),
    ("<nav><ul><li>m</ul></nav><main><p>1</p><aside>s</aside><ol><li>a<li>b</ol><form>f</form></main><div class='comments'><p>c</div>", "1\na\nb"),
    ("<article><p>a < b & c <1> 3</p></div></section><p>d</article><footer>f", "a < b & c <1> 3\nd"),
    ("<article><p>1<div class=comment-list><p>no<p>no</div>2</article>", "1\n2"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<p title='a > b'>x<p data-x=\"1", "x"),
    ("<p>x<a title=5\">y</a> z<p class='un>closed q' id=\"r>s\">t", "xy z\nt"),
    ("<p>" * 3000 + "deep" + "<div>" * 3000 + "er", "deep\ner"),
    ("<textarea><p>no</textarea><p>yes<script>", "yes"),
])
def test_blocks(source, want):
    assert text(source) == want


def test_hosts():
    assert [host_of(x) for x in ("http://A.b/c", None, "", "x", "http://[")] == ["a.b", "", "", "", ""]


PAGES = "page_id long, url string, html string, host int"


def test_subtrees_that_recur_on_a_host_go(spark):
    box, quote = "<div><b>Read  our\nother sites</b> now</div>", "<p>a passage that all articles quote</p>"
    rows = [(i, f"http://a.b/{i}", f"<body><section><p>text {i}</p>{quote}</section>{box}<p>end", 1) for i in range(8)]
    rows += [(20 + i, f"http://c.d/{i}", f"<body><p>text {i}</p>{box}", 1) for i in range(3)]
    rows += [(40, None, None, 1), (40, None, "", 1), (None, "http://c.d/", "<article><p>x</p></article>" + box, 1)]
    got = sorted((-1 if r["page_id"] is None else r["page_id"], r["text"], r["n_chars"]) for r in main_text(spark.createDataFrame(rows, PAGES)).collect())
    want = [(i, f"text {i}\na passage that all articles quote\nend") for i in range(8)] + [(20 + i, f"text {i}\nRead our other sites now") for i in range(3)]
    want += [(40, ""), (40, ""), (-1, "x")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_generated_pages(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    for r in pq.read_table(path).to_pylist():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        want = [" ".join(H.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:h1|p|br)>", article)]
        assert text(r["html"]) == "\n".join(x for x in want if x)


@pytest.mark.parametrize("source, want", [
    ('<body class="with-sidebar"><p>a</p><div class=sidebar>no</div>', "a"),
    ('<article class="post comments-open"><p>a</p></article>', "a"),
    ('<div class="has-header menu-closed search-enabled"><p>a</div>', "a"),
    ('<div class="page search"><p>a<main>b b</main></div><div class=comments>no', "b b"),
    ('<main>b b</main><div class=comments><article>no</article></div>', "b b"),
    ('<html class=menu><body id=search><article id=comments>a</article>', "a"),
    ('<div><p>the page itself</p></div><article>card</article><article>card 2</article>', "the page itself\ncard\ncard 2"),
    ('<div>no</div><main><article>a</article><article>b</article></main>', "a\nb"),
])
def test_names_do_not_hide_the_page(source, want):
    assert text(source) == want


def test_templates_do_not_depend_on_the_share_of_a_host(spark):
    box, note = "<div class=x1>a box of this section</div>", "<ul><li>Imprint <li><a>Contact</a></ul>"
    rows = [(i, f"http://a.b/{i}", f"<p>text {i}</p><p>more {i % 7}" + f"<p>own {i}" * (i % 3) + "<p>a quoted passage" + f"<p>end {i}" * (i % 4) + (box if i < 9 else "") + note, 1) for i in range(120)]
    rows += [(200 + i, "http://a.b/copy", "<div><p>a page under many addresses</p></div>", 1) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "\n".join([f"text {i}", f"more {i % 7}", *[f"own {i}"] * (i % 3), "a quoted passage", *[f"end {i}"] * (i % 4)]) for i in range(120)} | {200 + i: "a page under many addresses" for i in range(8)}


def test_deep_pages_take_linear_time():
    """A megabyte of nested elements, with names and stray end tags, and what a template takes from it."""
    n = 60_000
    deep = parse("<body>" + "<div class=a><i>x</i>" * n + "</b>" * n + "</body>")
    assert len(deep.texts) == n and len(deep.parents) == n and parse('<div class="site-footer">x' * n).texts == []
    half = n // 2
    assert without(deep, {deep.hashes[half]}) == deep.texts[:half]


def test_equal_subtrees_have_equal_hashes():
    page = parse("<body><div><section>a <b>b</b>\n</section></div><div><section>a  <b>b</b> </section></div><div>a</div></body>")
    hashes = dict(zip(range(5), page.hashes))
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and len(set(hashes.values())) == 3


def test_main_text_equals_brute_force(spark):
    """Templates counted in plain Python over generated sites, and pages with templates out of reach for comparison."""
    rng = random.Random(9)
    rows = []
    for i in range(120):
        host = f"h{i % 3}.example"
        parts = ["<div><p>box %d</p></div>" % rng.randint(0, 8) for _ in range(3)]
        rows.append((i if i % 17 else None, f"http://{host}/{i}", "<body>" + "".join(parts) + f"<div><p>story {i}</p></div></body>", "x"))
    rows += rows[:4] + [(500, None, None, "x"), (501, "http://h0.example/e", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in main_text(df, many=5, many_texts=10**6).collect())
    seen = {}
    for p, u, h, _ in rows:
        seen.setdefault((host_of(u), h or ""), set()).update(x for x in parse(h or "").hashes)
    counts = Counter((host, x) for (host, _), hashes in seen.items() for x in hashes)
    want = Counter()
    for p, u, h, _ in rows:
        page = parse(h or "")
        text = "\n".join(t for t, node in zip(page.texts, page.inside) if counts[host_of(u), page.hashes[node]] < 5)
        want[p, u, text, len(text)] += 1
    assert got == want
    whole = {(r["page_id"], r["url"]): r["text"] for r in main_text(df, many=10**6, many_texts=10**6).collect()}
    assert sum(whole[p, u] != t for p, u, t, _ in got) > 100  # templates do the work here


def test_what_holds_the_text_is_never_hidden():
    """A form around the whole page, with a marked article in it or without."""
    for source in (
        '<form id="aspnetForm"><nav>a b</nav><article><p>Whole story</p></article><div class="footer">c</div></form>',
        '<form action="/"><div><p>Whole story</p></div></form>',
    ):
        assert "Whole story" in parse(source).texts, source
    assert parse('<article><p>Story</p><form><label>Mail</label> Sign up for all of our many letters</form></article>').texts == ["Story"]
    assert parse('<article><p>Story</p><div class="comments"><p>Longer than the story by far, but from readers</p></div></article>').texts == ["Story"]


def test_subtree_hashes_have_no_colliding_family():
    word = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    both = word + word.translate(str.maketrans("ab", "ba"))
    a, b, c = _substring_hashes(both + word, [0, 2048, 4096], [2048, 4096, 6144])
    assert a != b and a == c and a & 1
