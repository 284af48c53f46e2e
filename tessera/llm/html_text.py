"""Main text of web pages by wrapper induction (operator 4)."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, saved

#: A slot's text is template if it stands on this share of the pages that have the slot, and on so many at least.
CONSTANT_SHARE = 0.9
MIN_PAGES = 3
#: Each host has so many pages at most that others are aligned with; a page takes the one that it matches best.
PIVOTS = 3
#: The content element of a host's pages holds this share of their text, and two blocks a page.
CONTENT_SHARE = 0.6
#: Pivot pages are broadcast up to so many characters in all, templates up to so many texts.
BROADCAST_CHARS = 30_000_000
BROADCAST_TEXTS = 200_000
#: A host with more pages is split into parts of about so many for joins.
HOST_PAGES = 10_000
#: Child lists with a larger product of lengths are matched by halves, in memory that grows with their sum.
CELLS = 1 << 22

BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template xmp iframe noembed noframes".split())
#: Elements that are never main text.
ASIDE = set("head title script style noscript template iframe object svg math canvas audio video nav menu header footer aside form button select option textarea dialog".split())
#: Names of classes, ids and roles that mark what is not the article: one of the first kind, alone or joined to others of either kind.
ASIDE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
PLAIN_WORDS = set("area bar block bottom box button buttons container content first group inner item items last left links list main outer page panel primary region right secondary section side site slot text top unit wrap wrapper".split())
#: An element of the first kind ends an open element of the second, up to the nearest of the third.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
P_SCOPE = set("article aside body blockquote button caption dd details dialog div dt fieldset figure footer form header html li main nav object section table td th".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""", re.S)
_MARK = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    """A block element of the page, or a run of text between block elements (``#text``).

    ``hard`` and ``soft``: not main text by element, or by the name of a class.
    """

    __slots__ = ("h1", "hard", "key", "kids", "label", "main", "shape", "soft", "text")

    def __init__(self, label: str, hard: bool = False, soft: bool = False, main: bool = False):
        self.label, self.hard, self.soft, self.main = label, hard, soft, main
        self.kids: list[Node] = []
        self.text, self.h1 = "", label == "h1"
        self.shape = self.key = -1


def marks_aside(value: str) -> bool:
    """Whether a class, id or role says that its element is not the article: ``cookie-notice`` and ``top-menu`` do, ``with-sidebar`` and ``related-work`` don't."""
    for name in value.split():
        words = {w.lower() for w in _WORDS.findall(name)}
        if words & ASIDE_WORDS and words <= ASIDE_WORDS | PLAIN_WORDS:
            return True
    return False


def parse(source: str) -> Node:
    """The block elements of a page as a tree, as browsers read unclosed and stray tags; a text run is a child without children."""
    root = Node("#root")
    stack: list[tuple[str, Node]] = [("#root", root)]  # inline elements stand on the node around them
    run: list[str] = []

    def end_run() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                top = stack[-1][1]
                leaf = Node("#text", top.hard, top.soft, top.main)
                leaf.text, leaf.h1 = text, top.h1
                top.kids.append(leaf)

    def pop_to(k: int) -> None:
        end_run()
        del stack[k:]

    at, n = 0, len(source)
    while at < n:
        m = _TAG.search(source, at)
        if m is None:
            run.append(source[at:])
            break
        if m.start() > at:
            run.append(source[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name, rest = name.lower(), m[3] or ""
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    if name in BLOCK or stack[k][1] is not stack[k - 1][1]:
                        pop_to(k)
                    else:
                        del stack[k]
                    break
                if stack[k][0] in P_SCOPE and name not in BLOCK:
                    break
            else:
                if name in BLOCK:
                    end_run()
            continue
        if name == "br":
            run.append(" ")
            continue
        block = name in BLOCK
        if block:
            end_run()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in P_SCOPE:
                    break
            if name in ENDS:
                ended, scope = ENDS[name]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ended:
                        pop_to(k)
                    elif stack[k][0] in scope:
                        break
        around = stack[-1][1]
        marks = {k.lower(): v.strip("\"'") for k, v in _MARK.findall(rest)} if rest else {}
        is_main = name in ("article", "main") or marks.get("role", "").lower() == "main" or marks.get("itemprop", "").lower() == "articlebody"
        hard = name in ASIDE or bool(rest and _HIDDEN.search(rest))
        soft = any(marks_aside(v) for v in marks.values()) and not (is_main and not around.main) and name not in ("html", "body")
        if name == "header" and around.main:  # the head of the article itself
            hard = soft = False
        if name in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
            at = end.end()
            continue
        if name in VOID or rest.endswith("/") and not block:
            continue
        if block or hard and not around.hard or soft and not around.soft:
            end_run()
            node = Node(name, around.hard or hard, around.soft or soft, around.main or is_main)
            around.kids.append(node)
            stack.append((name, node))
        else:
            stack.append((name, around))
    end_run()
    return root


class Matcher:
    """Simple tree matching: the most nodes that an ordered matching of two trees pairs, from like-labelled roots down.

    Trees of one shape are known by one number, so that a pair of shapes is
    matched once however often it occurs.
    """

    def __init__(self):
        self.shapes: dict[tuple, int] = {}
        self.sizes: list[int] = []
        self.labels: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, int], int] = {}

    def number(self, tree: Node) -> None:
        """Gives each node the number of its shape."""
        order, todo = [], [tree]
        while todo:
            x = todo.pop()
            order.append(x)
            todo += x.kids
        for x in reversed(order):
            kids = tuple(k.shape for k in x.kids)
            shape = self.shapes.setdefault((x.label, kids), len(self.sizes))
            if shape == len(self.sizes):
                self.sizes.append(1 + sum(self.sizes[k] for k in kids))
                self.labels.append(x.label)
                self.kids.append(kids)
            x.shape = shape

    def score(self, a: int, b: int) -> int:
        """Nodes matched between a tree of shape ``a`` and one of shape ``b``."""
        todo = [(a, b)]
        while todo:
            a, b = todo[-1]
            if (a, b) in self.known:
                todo.pop()
            elif self.labels[a] != self.labels[b]:
                self.known[a, b] = 0
            elif a == b:
                self.known[a, b] = self.sizes[a]
            else:
                x, y, at_ends = self._trimmed(self.kids[a], self.kids[b])
                wanted = [p for p in {(i, j) for i in set(x) for j in set(y)} if p not in self.known]
                if wanted:
                    todo += wanted
                else:
                    self.known[a, b] = 1 + at_ends + int(self._scores(x, y)[-1])
        return self.known[a, b]

    def _trimmed(self, x: tuple, y: tuple) -> tuple[tuple, tuple, int]:
        """Lists of shapes without equal beginnings and ends, which a best matching always pairs, and the nodes of these."""
        k = 0
        while k < len(x) and k < len(y) and x[k] == y[k]:
            k += 1
        e = 0
        while e < len(x) - k and e < len(y) - k and x[-1 - e] == y[-1 - e]:
            e += 1
        return x[k : len(x) - e], y[k : len(y) - e], sum(self.sizes[i] for i in x[:k] + x[len(x) - e :])

    def _weights(self, x: tuple, y: tuple) -> dict[int, np.ndarray]:
        names = sorted(set(y))
        at = np.searchsorted(names, y)
        return {i: np.array([self.known[i, j] for j in names], np.int64)[at] for i in set(x)}

    def _scores(self, x: tuple, y: tuple, rows: list | None = None) -> np.ndarray:
        """Best totals of all of ``x`` with the first 0, 1, ... of ``y``; ``rows`` gets those of each beginning of ``x``."""
        row = np.zeros(len(y) + 1, np.int64)
        weights = self._weights(x, y) if x and y else {}
        if rows is not None:
            rows.append(row)
        for i in x:
            if len(y):
                row = np.maximum.accumulate(np.concatenate([[0], np.maximum(row[1:], row[:-1] + weights[i])]))
            if rows is not None:
                rows.append(row)
        return row

    def pairs(self, x: tuple, y: tuple, x0: int = 0, y0: int = 0) -> list[tuple[int, int]]:
        """The places that a best ordered matching of two lists of shapes pairs; all pairs of shapes have been scored."""
        k = 0
        while k < len(x) and k < len(y) and x[k] == y[k]:
            k += 1
        out = [(x0 + i, y0 + i) for i in range(k)]
        x, y, x0, y0 = x[k:], y[k:], x0 + k, y0 + k
        while x and y and x[-1] == y[-1]:
            x, y = x[:-1], y[:-1]
            out.append((x0 + len(x), y0 + len(y)))
        if not x or not y:
            return out
        if len(x) == 1:
            best = max(range(len(y)), key=lambda j: self.known[x[0], y[j]])
            return out + [(x0, y0 + best)] * (self.known[x[0], y[best]] > 0)
        if len(x) * len(y) > CELLS:
            half = len(x) // 2
            total = self._scores(x[:half], y) + self._scores(x[half:][::-1], y[::-1])[::-1]
            cut = int(total.argmax())
            return out + self.pairs(x[:half], y[:cut], x0, y0) + self.pairs(x[half:], y[cut:], x0 + half, y0 + cut)
        rows: list[np.ndarray] = []
        self._scores(x, y, rows)
        i, j = len(x), len(y)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((x0 + i, y0 + j))
        return out

    def align(self, page: Node, pivot: Node) -> None:
        """Gives matched nodes of ``page`` the keys of the pivot's (``number_slots``), others a key of their own by what stands above them and their label."""
        page.key = pivot.key
        todo: list[tuple[Node, Node | None]] = [(page, pivot)]
        while todo:
            a, b = todo.pop()
            found = {}
            if b is not None:
                x, y = tuple(k.shape for k in a.kids), tuple(k.shape for k in b.kids)
                for i in set(x):
                    for j in set(y):
                        self.score(i, j)
                found = dict(self.pairs(x, y))
            for i, k in enumerate(a.kids):
                other = b.kids[found[i]] if i in found else None
                k.key = other.key if other else xxhash.xxh64_intdigest(f"{a.key} {k.label}") >> 1 | 1 << 62
                todo.append((k, other))


def number_slots(pivot: Node) -> None:
    """Gives each node of a pivot page its slot, in page order."""
    todo, k = [pivot], 0
    while todo:
        node = todo.pop()
        node.key, k = k, k + 1
        todo += reversed(node.kids)


def blocks(page: Node) -> tuple[list[tuple[Node, list[int]]], bool]:
    """The text runs that may be main text, in page order, each with the keys of the elements around it; and whether an article or main element marks them.

    An article or main element with no more than a heading marks nothing. What
    the name of a class sets aside comes back where over nine tenths of an
    unmarked page's text would go.
    """
    found, todo = [], [(page, [])]
    while todo:
        x, path = todo.pop()
        if x.text and not x.hard:
            found.append((x, path))
        if x.kids:
            path = [*path, x.key]
            todo += [(k, path) for k in reversed(x.kids)]
    chars = lambda xs: sum(len(x.text) for x, _ in xs)
    plain = [x for x in found if not x[0].soft]
    inner = [x for x in plain if x[0].main]
    if any(not x.h1 for x, _ in inner):
        return inner, True
    return plain if 10 * chars(plain) >= chars(found) else found, False


def _hosts(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> tuple[DataFrame, DataFrame]:
    """Pages with their host and a part of it, and (host, n_parts) of the hosts that have several."""
    host = F.coalesce(F.lower(F.expr(f"try_parse_url(`{url_col}`, 'HOST')")), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    large = saved(rows.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > HOST_PAGES).select("host", F.ceil(F.col("n") / HOST_PAGES).cast("int").alias("n_parts")), "large-hosts")
    marked = rows.join(broadcast_if_small(large, large.count(), BROADCAST_TEXTS), "host", "left")
    return marked.withColumn("part", F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.coalesce("n_parts", F.lit(1))).cast("int")).drop("n_parts"), large


def _to_pages(side: DataFrame, rows: DataFrame, large: DataFrame, size: int, limit: int, on: list[str]) -> DataFrame:
    """``rows`` left-joined with ``side``, by broadcast within ``limit``, else with one copy of a host's rows for each of its parts."""
    if size <= limit:
        return rows.join(F.broadcast(side), on, "left")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("n_parts", F.lit(1)) - 1)).alias("part")
    return rows.join(side.join(large, "host", "left").select(*side.columns, parts), [*on, "part"], "left")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per row of ``pages``.

    Up to ``PIVOTS`` pages of each host with ``MIN_PAGES`` pages and more are its
    pivots. Every page is parsed and aligned, by simple tree matching, with the
    pivot that it matches best, which gives its elements and text runs slots
    that are the same on all pages of the host with that layout; what the pivot
    lacks gets a slot by its place. Then the host's distinct pages decide:

    * a text that a slot has on nearly all pages with the slot is template;
    * of the elements whose varying text is ``CONTENT_SHARE`` of all, the
      innermost is the content element. Runs outside it are dropped, but for
      ``h1``, where the page itself does not mark its article.

    What never is the article goes before: elements such as menus, forms and
    footers by their kind, others by the name of a class or id. On hosts with
    fewer pages that is all.

    Counts are combined before they are shuffled; a host with a third of all
    pages is joined in parts of ``HOST_PAGES``. A null or empty html gives an
    empty text; urls without a host are one host; repeated rows keep their own
    results and count once; long pages are whole; an empty table gives no rows.
    """
    rows, large = _hosts(pages, id_col, url_col, html_col)
    some = rows.where("html <> ''").groupBy("host", F.pmod(F.xxhash64("html", F.lit(1)), F.lit(PIVOTS)).alias("k")).agg(F.min_by("html", F.xxhash64("html")).alias("pivot"), F.count("*").alias("n"))
    pivots = saved(some.groupBy("host").agg(F.array_sort(F.collect_list("pivot")).alias("pivots"), F.sum("n").alias("n")).where(F.col("n") >= MIN_PAGES).drop("n"), "pivots")
    chars = pivots.agg(F.coalesce(F.sum(F.aggregate("pivots", F.lit(0), lambda s, p: s + F.length(p))), F.lit(0))).first()[0]
    joined = _to_pages(pivots, rows, large, chars, BROADCAST_CHARS, ["host"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[Node]] = {}
        matcher = Matcher()
        for b in batches:
            kinds, marked, keys, names, tags, texts, paths, bodies = [], [], [], [], [], [], [], []
            for h, source, around in zip(b.column("host").to_pylist(), b.column("html"), b.column("pivots"), strict=True):
                page = parse(source.as_py())
                kind = -1
                if around.is_valid:
                    if len(matcher.known) > 500_000 or len(known) > 256:
                        matcher, known = Matcher(), {}
                    if h not in known:
                        known[h] = [parse(p) for p in around.as_py()]
                        for p in known[h]:
                            matcher.number(p)
                            number_slots(p)
                    matcher.number(page)
                    kind = max(range(len(known[h])), key=lambda k: matcher.score(page.shape, known[h][k].shape))
                    matcher.align(page, known[h][kind])
                found, is_marked = blocks(page)
                kinds.append(kind)
                marked.append(is_marked)
                keys.append([x.key for x, _ in found])
                paths.append([p for _, p in found] if kind >= 0 and not is_marked else [])
                tags.append([x.h1 for x, _ in found])
                texts.append([x.text for x, _ in found])
                names.append([xxhash.xxh64_intdigest(x.text, 1) - (1 << 63) for x, _ in found])
                bodies.append(xxhash.xxh64_intdigest("\n".join(texts[-1]), 2) - (1 << 63))
            columns = [pa.array(kinds, pa.int32()), pa.array(bodies, pa.int64()), pa.array(marked), pa.array(keys, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.int64())), pa.array(tags, pa.list_(pa.bool_())), pa.array(texts, pa.list_(pa.string())), pa.array(paths, pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "url", "host", "part")), *columns], ["page_id", "url", "host", "part", "pivot", "body", "marked", "keys", "names", "h1", "texts", "paths"])

    id_type = dict(rows.dtypes)["page_id"]
    schema = f"page_id {id_type}, url string, host string, part int, pivot int, body long, marked boolean, keys array<long>, names array<long>, h1 array<boolean>, texts array<string>, paths array<array<long>>"
    parsed = saved(joined.select("page_id", "url", "host", "part", "html", "pivots").mapInArrow(of, schema), "page-blocks")
    return _content(parsed, large)


def _content(parsed: DataFrame, large: DataFrame) -> DataFrame:
    layout = ["host", "pivot"]
    distinct = saved(parsed.where("pivot >= 0").select(*layout, "body", "marked", "keys", "names", "paths", F.transform("texts", F.length).alias("sizes")).dropDuplicates([*layout, "body"]), "distinct-pages")
    seen = distinct.select(*layout, F.explode(F.array_distinct(F.arrays_zip("keys", "names"))).alias("x"))
    counts = seen.groupBy(*layout, "x.keys", "x.names").agg(F.count("*").alias("n"))
    often = counts.groupBy(*layout, "keys").agg(F.max(F.struct("n", "names")).alias("most"), F.sum("n").alias("n"))
    constant = saved(often.where((F.col("most.n") >= MIN_PAGES) & (F.col("most.n") >= CONSTANT_SHARE * F.col("n"))).groupBy(*layout).agg(F.collect_list(F.struct("keys", F.col("most.names").alias("names"))).alias("template")), "page-template")
    n = constant.agg(F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]

    in_template = lambda x: F.coalesce(F.array_contains(F.col("template"), F.struct(x["keys"].alias("keys"), x["names"].alias("names"))), F.lit(False))
    own = distinct.where("not marked").join(broadcast_if_small(constant, n, BROADCAST_TEXTS), layout, "left")
    own = own.select(*layout, F.explode(F.filter(F.arrays_zip("keys", "names", "paths", "sizes"), lambda x: ~in_template(x))).alias("x"))
    sums = own.select(*layout, F.col("x.sizes").alias("chars"), F.posexplode("x.paths").alias("depth", "slot")).groupBy(*layout, "slot").agg(F.sum("chars").alias("chars"), F.count("*").alias("blocks"), F.max("depth").alias("depth"))
    whole = sums.where("slot = 0").select(*layout, F.col("chars").alias("all_chars"))
    n_pages = distinct.where("not marked").groupBy(*layout).agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= MIN_PAGES)
    inner = sums.join(whole, layout).join(n_pages, layout).where((F.col("chars") >= CONTENT_SHARE * F.col("all_chars")) & (F.col("blocks") >= 2 * F.col("n_pages")))
    inner = inner.groupBy(*layout).agg(F.max_by("slot", "depth").alias("content_slot"))

    found = saved(constant.join(inner, layout, "full"), "wrappers")
    rows = _to_pages(found, parsed, large, n + found.count(), BROADCAST_TEXTS, layout)
    # a page that has no such element, an error page for instance, is not cut to it
    rows = rows.withColumn("content_slot", F.when(F.exists("paths", lambda p: F.array_contains(p, F.col("content_slot"))), F.col("content_slot")))
    inside = lambda x: F.col("marked") | F.col("content_slot").isNull() | x["h1"] | F.array_contains(x["paths"], F.col("content_slot"))
    kept = F.filter(F.arrays_zip("keys", "names", "h1", "texts", "paths"), lambda x: ~in_template(x) & F.coalesce(inside(x), F.lit(True)))
    texts = F.when(F.col("template").isNull() & F.col("content_slot").isNull(), F.col("texts")).otherwise(F.transform(kept, lambda x: x["texts"]))
    return rows.select("page_id", "url", F.array_join(texts, "\n").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
