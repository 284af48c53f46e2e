import re
from collections import Counter, defaultdict

from tessera.llm import site_lines

from .cases import empty, odd, odd_rows, plain, table


def brute(rows, ratio, least):
    word = lambda x: re.search(r"[^\x20\x09-\x0D]", x)
    pages, lines = Counter(), defaultdict(Counter)
    for _, text, site in rows:
        pages[site] += 1
        lines[site].update({x for x in (text or "").split("\n") if word(x)})
    out = []
    for i, text, site in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if not (word(x) and lines[site][x] >= least and lines[site][x] > ratio * pages[site])]
        out.append((i, site, sum(1 for x in own if word(x)), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r[0], r[1], r[3]) for r in table(sf, "documents")]
    assert plain(site_lines.drop_repeated_lines(docs, min_pages=2)) == brute(rows, site_lines.RATIO, 2)
    got = plain(site_lines.drop_repeated_lines(docs, ratio=0.1, min_pages=3))
    assert got == brute(rows, 0.1, 3) and any(r[3] for r in got)


def test_odd_rows(spark):
    rows = [(r[0], r[1], r[3]) for r in odd_rows()]
    want = brute(rows, 0.01, 2)
    assert plain(site_lines.drop_repeated_lines(odd(spark), ratio=0.01, min_pages=2)) == want
    old, site_lines.BROADCAST_ROWS = site_lines.BROADCAST_ROWS, -1
    try:
        assert plain(site_lines.drop_repeated_lines(odd(spark), ratio=0.01, min_pages=2)) == want
    finally:
        site_lines.BROADCAST_ROWS = old


def test_pages_by_host(spark, sf):
    """What stands between tags is a line, and a host's lines count over its pages."""
    odd_pages = [(1, "https://A.example/x", "<p>same<p>own 1"), (2, "http://a.example:80/y", "<p>same<p>own 2\nsame"), (3, "https://a.example", "<b>same</b>"), (4, None, "<p>same"), (5, "no host", None), (None, "", ""), (3, "https://a.example", "<b>same</b>")]
    brute_pages = lambda rows: brute([(i, re.sub(r"<[^>]*>", "\n", t or ""), (m[1].lower() if (m := re.match(r"[a-z]+://([^/?#:]*)", u or "")) else "")) for i, u, t in rows], site_lines.RATIO, site_lines.MIN_PAGES)
    df = spark.createDataFrame([(*r, "x", "y") for r in odd_pages], "page_id long, url string, html string, host string, text string")
    assert plain(site_lines.drop_site_lines(df)) == brute_pages(odd_pages)
    got = plain(site_lines.drop_site_lines(spark.read.parquet(f"{sf}/pages.parquet")))
    assert got == brute_pages(table(sf, "pages")) and any(r[3] for r in got)


def test_empty(spark):
    assert site_lines.drop_site_lines(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert site_lines.drop_repeated_lines(empty(spark)).count() == 0
