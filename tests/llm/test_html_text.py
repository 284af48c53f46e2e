import html
import random
import re
from functools import cache

import pytest

from tessera.llm import html_text

from .cases import table


def texts(source):
    return [x.text for x, _ in html_text.blocks(html_text.parse(source))[0]]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>One &#233;&nbsp;x<p>Two<br>lines", ["One é x", "Two lines"]),
        ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("a < b <b>c</b>", ["a < b c"]),
        ('<p title="x>y">d</p><!-- <p>no --><script>var a="<p>z</p>";</script>e', ["d", "e"]),
        ("<style>p{}</style><noscript>n</noscript><p>x</p><script>never ends", ["x"]),
        ("<!-- open <p>gone", []),
        ("<nav>menu</nav><header>h</header><main><p>m</p><aside>s</aside></main><footer>f</footer>", ["m"]),
        ('<div class="side-bar sidebar">s</div><div id="cookie-notice">c</div><div class="content">t</div>', ["t"]),
        ('<article class="post comments-open"><p>whole text</p></article>', ["whole text"]),
        ('<div class="with-sidebar content"><p>whole text</p></div><p>more</p>', ["whole text", "more"]),
        ('<article><p>a</p><div class="related-work">b</div><table class="share-price-table"><td>c</table><p id="section-5-search-and-rescue">d</p><label>e</label></article>', ["a", "b", "c", "d", "e"]),
        ("<main><h1>Head</h1></main><p>a long paragraph beside it</p>", ["Head", "a long paragraph beside it"]),
        ('<div class="comments">all that there is</div><p>x</p>', ["all that there is", "x"]),
        ('<div class="top-menu">m</div><div class="cookieNotice">c</div><p>some text</p>', ["some text"]),
        ('<article><header><h1>T</h1></header><p>x and more</p><section class="comments"><p>r</p></section></article><p>after</p>', ["T", "x and more"]),
        ("<p><b>one<br><p>two</b> three", ["one", "two three"]),
        ('<form>q<input value="z"><button>go</button></form><p hidden>h</p><p>v</p>', ["v"]),
        ("<DIV>Mixed<SPAN> Case</SPAN></DIV>", ["Mixed Case"]),
        ('<p class="un"quoted">a</p><p class=\'b">c\'>d</p>', ["a", "d"]),
    ],
)
def test_blocks(source, want):
    assert texts(source) == want


def trees(rng, n):
    label = rng.choice("ab")
    kids = []
    while n > 1:
        size = rng.randint(1, n - 1)
        kids.append(trees(rng, size))
        n -= size
    return (label, tuple(kids))


def node(tree):
    out = html_text.Node(tree[0])
    out.kids = [node(k) for k in tree[1]]
    return out


@cache
def most(a, b):
    """Simple tree matching by its definition."""
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + most(x, y))
    return 1 + best[-1][-1]


@pytest.mark.parametrize("cells", [1 << 22, 3])
def test_simple_tree_matching(cells, monkeypatch):
    """The score is that of the definition, and the slots that a page gets are those of a matching with so many nodes."""
    monkeypatch.setattr(html_text, "CELLS", cells)
    rng = random.Random(8)
    for _ in range(300):
        a, b = trees(rng, rng.randint(1, 30)), trees(rng, rng.randint(1, 30))
        m, page, pivot = html_text.Matcher(), node(a), node(b)
        m.number(page)
        m.number(pivot)
        html_text.number_slots(pivot)
        assert m.score(page.shape, pivot.shape) == most(a, b)
        if a[0] != b[0]:
            continue
        m.align(page, pivot)
        todo, pairs, at = [(page, None)], 0, {}
        walk = [pivot]
        while walk:
            x = walk.pop()
            at[x.key] = x
            walk += x.kids
        while todo:
            x, above = todo.pop()
            if x.key in at:
                pairs += 1
                assert at[x.key].label == x.label and (above is None or at[x.key] in at[above].kids)
            slots = [k.key for k in x.kids if k.key in at]
            assert slots == sorted(set(slots))
            todo += [(k, x.key) for k in x.kids]
        assert pairs == most(a, b)


def test_long_lists_of_children():
    """A block more at the front does not shift the slots of thousands behind it."""
    pivot = html_text.parse("<div>" + "".join(f"<p>p{i}</p><ul><li>l{i}</ul>" for i in range(2500)) + "</div>")
    page = html_text.parse("<div><table><tr><td>new</table>" + "".join(f"<p>p{i}</p><ul><li>l{i}</ul>" + "<h2>x</h2>" * (i % 900 == 0) for i in range(2500)) + "</div>")
    m = html_text.Matcher()
    m.number(pivot)
    m.number(page)
    html_text.number_slots(pivot)
    m.align(page, pivot)
    slot = {x.text: x.key for x, _ in html_text.blocks(pivot)[0]}
    got = [(x.text, x.key) for x, _ in html_text.blocks(page)[0]]
    assert sum(slot.get(t) == k for t, k in got) >= 4990


def test_whole_table(spark, sf):
    got = {r.page_id: r for r in html_text.main_texts(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    rows = table(sf, "pages")
    assert len(got) == len(rows)
    for i, url, source in rows:
        article = source[source.index("<article>") : source.index("</article>")]
        want = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", t)).split()) for t in re.split(r"<h1>|</h1>|<p>|</p>", article)]
        assert got[i].text == "\n".join(w for w in want if w) and got[i].url == url and got[i].n_chars == len(got[i].text)


def test_constant_slots_are_template(spark, monkeypatch):
    rows = [(i, f"https://a.example/{i}", f"<div><p>Read this note first</p><p>own text {i}</p><p>{'shared words' if i % 2 else 'more ' + str(i)}</p></div>") for i in range(30)]
    rows += [(100, "https://b.example/1", "<p>Read this note first</p>"), (101, None, None), (102, "no host", ""), (103, "https://a.example/1", rows[1][2]), (103, "https://a.example/1", rows[1][2])]
    df = spark.createDataFrame([(*r, "e", "e", "e", "e") for r in rows], "page_id long, url string, html string, body string, host string, part string, pivot string")
    got = html_text.main_texts(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[2] == "own text 2\nmore 2" and by[1] == by[103] == "own text 1\nshared words" and by[100] == "Read this note first" and by[101] == by[102] == ""
    for name, value in (("BROADCAST_CHARS", 0), ("BROADCAST_TEXTS", 0), ("HOST_PAGES", 7)):
        monkeypatch.setattr(html_text, name, value)
    assert sorted(map(tuple, html_text.main_texts(df).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_content_of_unmarked_pages(spark):
    """Pages without article or main element: menus, adverts and footers whose texts and class names differ on each page go, for two layouts of one host and beside an error page."""
    rng = random.Random(6)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    rows, want = [(0, "https://a.example/", "<p>Error 404</p>")], {}
    for i in range(1, 61):
        head, paras = say(4), [say(rng.randint(12, 60)) for _ in range(rng.randint(2, 9))]
        menu = "".join(f"<li><a href=/{k}>{say(1)}</a>" for k in range(rng.randint(3, 7)))
        body = f"<h1>{head}</h1>" + "".join(f"<p>{p}</p>" for p in paras)
        if i % 2:
            page = f'<div class="q{i}"><ul>{menu}</ul></div><div class="z{i}">{say(9)}</div><div class="m{i}">{body}</div><div>Our address: {say(3)}</div><div>All rights reserved</div>'
        else:
            page = f'<table><tr><td><ul>{menu}</ul><td><div class="t{i}"><p>Please log in to vote</p>{body}</div><td>{say(6)}</table>'
        rows.append((i, f"https://a.example/{i}", f"<html><body>{page}</body></html>"))
        want[i] = "\n".join([head, *paras])
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Error 404"
    assert {i: got[i] for i in want} == want


def test_very_long_page(spark):
    page = "<article>" + "".join(f"<p>p{i}</p>" for i in range(20_000)) + "</article>"
    rows = [(k, "https://a.example/x", page.replace("p7<", f"q{k}<")) for k in range(4)]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"q{r.page_id}" for r in got)  # all other slots are the same on each page


def test_empty(spark):
    assert html_text.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
