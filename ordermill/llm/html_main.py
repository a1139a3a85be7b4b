"""Main text of web pages from per-host site style trees.

Pass 1 parses every page into style nodes (the path of tags with their class
and id from the root) and merges the pages of a host by path: for each
branch under the body it counts, over distinct pages, how often
each presentation (sequence of child tags) and each content (text) occurs.
A branch whose content is the same on most pages has a high content entropy
over pages and a low presentation entropy, so a low importance.  A mark (a
tag, role, class or id that says menu, header, footer, sidebar, notice,
advert, form or comments) lowers it by ``MARKED``, a place outside the
page's article or main element by ``OUTSIDE``.  Pass 2 parses the pages
again and leaves out low-importance branches, and in the others the texts
that are of low importance at their place.

Only hashes of branches are shuffled, never page text; copies of a page count
once.  The branches found unimportant are few per host (they need a path that
several pages share) and join the pages by host.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import staged

LEAST_PAGES = 4             # distinct pages that must share a path before it is judged
LEAST_IMPORTANCE = 0.4
PRESENTATION = 0.2          # weight of presentation against content
MARKED, OUTSIDE = 0.5, 0.2  # what a mark, and a place outside the article, take off a branch's importance

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+|[^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# HTML element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title".split())                # text up to the end tag, or the end of the page
# What a reader does not see as text, skipped as a whole; without an end tag of its own only the tag goes.
SKIPPED = set("noscript iframe canvas audio video select datalist template svg object".split())
NESTING = set("template svg object".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var wbr "
             "math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder semantics".split())
CLOSES_P = set("address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
               "h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
NOISE_TAGS = set("nav footer aside form button dialog menu".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment "
    "comments consent cookie cookies disclaimer disqus footer header menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promos promotion related replies respond share sharing sidebar social sponsor "
    "sponsored subscribe toolbar topbar widget widgets "
    # compounds are names of their own: a part of a name says nothing
    "ad-banner ad-slot ad-container cookie-banner cookie-notice cookie-bar main-menu main-nav nav-bar nav-menu "
    "page-footer page-header related-posts share-bar share-buttons side-bar site-footer site-header site-nav "
    "social-links social-share top-bar".split())
SAME_LEVEL = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"},
              "tr": {"table", "tbody", "thead"}, "option": {"select"}}


def _end_of(source: str, tag: str, at: int) -> int | None:
    """Where the element that was opened before ``at`` ends; None when it is never
    closed (a second start tag of an element that cannot hold itself comes first)."""
    depth = 1
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I).finditer(source, at):
        if not m[1]:
            if tag not in NESTING:
                return None
            depth += not m[0].endswith("/>")
        else:
            depth -= 1
            if not depth:
                return m.end()
    return None


def _code(*parts) -> int:
    import xxhash
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


class Node:
    __slots__ = ("tag", "path", "inside", "judged", "marks", "marked", "own", "children")

    def __init__(self, tag, path, inside, judged, marks, marked, own):
        self.tag, self.path, self.inside, self.judged, self.marks = tag, path, inside, judged, marks
        self.marked, self.own = marked, own         # by its own mark; a branch of its own, or part of the one above
        self.children = []


def _is_noise(tag, attrs, inside):
    if tag in NOISE_TAGS or (tag == "header" and not inside):
        return True
    for name, a, b, c in ATTRIBUTE.findall(attrs) if attrs else ():
        value = (a or b or c).lower()
        if name.lower() == "role":
            if value in NOISE_ROLES:
                return True
        elif tag not in ("html", "body", "main") and not NOISE_WORDS.isdisjoint(value.split()):
            return True
    return False


class Page:
    """Text blocks of a page in order, and its branches.

    A block is (text, inside an article or main element, paths of the
    branches above it, and those of them with a mark)."""

    def __init__(self, source: str):
        self.blocks, self.nodes = [], []
        root = Node("", 0, False, (), (), False, True)
        stack, buffer = [root], []

        def flush():
            if buffer:
                text = " ".join("".join(buffer).split())
                buffer.clear()
                if text:
                    top = next(n for n in reversed(stack) if n.own)
                    self.blocks.append((text, top.inside, top.judged, top.marks))

        def close_to(depth):
            flush()
            del stack[depth:]

        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            if not m:
                self._text(source[at:], stack, buffer)
                break
            if m.start() > at:
                self._text(source[at: m.start()], stack, buffer)
            at = m.end()
            if not m[2]:
                continue
            tag, attrs = m[2].lower(), m[3]
            if m[1]:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if depth and tag in INLINE:
                    if all(n.tag in INLINE for n in stack[depth:]):
                        if any(n.own for n in stack[depth:]):
                            flush()
                        del stack[depth:]
                elif depth:
                    close_to(depth)
                elif tag not in INLINE:
                    flush()
                continue
            if tag in RAW:
                if not attrs.rstrip().endswith("/"):
                    stop = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                    at = stop.end() if stop else end
                continue
            if tag in SKIPPED:
                if not attrs.rstrip().endswith("/"):
                    at = _end_of(source, tag, at) or at
                continue
            if tag == "br" or tag == "wbr":
                buffer.append(" " if tag == "br" else "")
                continue
            if tag in ("html", "head", "body"):              # a head holds nothing but raw, skipped and void elements
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag not in INLINE:
                flush()
                if tag in CLOSES_P:
                    depth = next((i for i in range(len(stack) - 1, 0, -1)
                                  if stack[i].tag == "p" or stack[i].tag not in INLINE), 0)
                    if depth and stack[depth].tag == "p":
                        del stack[depth:]
                if tag in SAME_LEVEL:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == tag:
                            del stack[i:]
                            break
                        if stack[i].tag in SAME_LEVEL[tag]:
                            break
            up = stack[-1]
            inline = tag in INLINE
            marked = bool((attrs or not inline) and not (inline and up.tag in INLINE) and _is_noise(tag, attrs, up.inside))
            if inline and not marked:
                stack.append(Node(tag, up.path, up.inside, up.judged, up.marks, False, False))
                continue
            if inline:
                flush()
            style = tag + "".join(sorted((a or b or c) for n, a, b, c in ATTRIBUTE.findall(attrs))) if attrs else tag
            path = _code(up.path, style)
            if not inline:
                up.children.append(tag)
            inside = up.inside or tag in ("article", "main") or 'role="main"' in attrs
            node = Node(tag, path, inside, (*up.judged, path), (*up.marks, path) if marked else up.marks, marked, True)
            self.nodes.append(node)
            stack.append(node)
        close_to(1)

    @staticmethod
    def _text(raw, stack, buffer):
        buffer.append(html.unescape(raw) if "&" in raw else raw)

    def unmarked(self):
        return [b for b in self.blocks if not b[3]]

    def text(self, unimportant=None, saved=frozenset(), stale=frozenset()):
        """Text without the ``unimportant`` branches, marked branches not among the ``saved``,
        and the ``stale`` texts.  ``unimportant`` None: the host has no tree; then marked
        branches go, and what is outside the article or main element if that is the longer."""
        if unimportant is None:
            blocks = self.unmarked()
            main = [b for b in blocks if b[1]]
            inner = sum(len(b[0]) for b in main)
            return " ".join(b[0] for b in (main if 2 * inner >= sum(len(b[0]) for b in blocks) else blocks))
        return " ".join(b[0] for b in self.blocks if unimportant.isdisjoint(b[2]) and saved.issuperset(b[3])
                        and not (stale and b[2] and b[2][-1] ^ _code("text", b[0]) in stale))


def host(url) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "").split("/")[0].split("?")[0].split("#")[0].lower()


_STATS = ["host", "page", "path", "feature", "kind"]
TEXT, STYLE, MARK, FAR = range(4)       # kinds of rows; MARK: the branch is marked, FAR: it is outside the article


def _branches(batches):
    """Distinct (host, page content, path, feature, kind) rows."""
    for batch in batches:
        urls, pages = batch.column("_url").to_pylist(), batch.column("_html").to_pylist()
        for lo in range(0, len(pages), 256):
            rows = set()
            for url, source in zip(urls[lo: lo + 256], pages[lo: lo + 256]):
                page, name = Page(source), host(url)
                if not page.blocks:
                    continue
                # chrome may change from copy to copy of a page
                own = _code(" ".join(b[0] for b in page.unmarked() or page.blocks))
                article = any(b[1] for b in page.blocks)
                live, near = set(), set()
                for text, inside, judged, _ in page.blocks:
                    code = _code("text", text)
                    rows.update((name, own, path, code, TEXT) for path in judged)
                    live.update(judged)
                    if inside:
                        near.update(judged)
                for n in page.nodes:
                    if n.path in live:
                        rows.add((name, own, n.path, _code("style", *dict.fromkeys(n.children)), STYLE))
                        if n.marked:
                            rows.add((name, 0, n.path, 0, MARK))
                        if article and n.path not in near:
                            rows.add((name, 0, n.path, 0, FAR))
            cols = list(zip(*rows)) or [[]] * 5
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=_STATS)


def style_tree(pages: DataFrame, url_col="url", html_col="html") -> DataFrame:
    """host, path, pages (distinct), marked, importance of every branch that several pages
    share, and ``stale``: codes of its texts that are of low importance there."""
    rows = pages.select(F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    rows = rows.mapInArrow(_branches, "host string, page long, path long, feature long, kind int").distinct()
    counts = rows.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"))
    # every page with a branch has one or more presentations of it
    counts = staged(counts.unionByName(
        rows.where(F.col("kind") == STYLE).groupBy("host", "path").agg(F.countDistinct("page").alias("n"))
        .select("host", "path", F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("feature"), "n")), "branches")
    pages_of = (counts.where(f"kind = -1 and n >= {LEAST_PAGES}").select("host", "path", F.col("n").alias("pages")))
    # a feature on n of m pages: its entropy over pages is log n / log m, its importance the rest;
    # a presentation with share p of the pages adds p log(1/p) / log m
    n, m, kind = F.col("n").cast("double"), F.col("pages").cast("double"), F.col("kind")
    text = 1 - F.log(n) / F.log(m)
    code = F.col("path").bitwiseXOR(F.col("feature"))
    parts = (counts.where("kind >= 0").join(pages_of, ["host", "path"])
             .groupBy("host", "path", "pages")
             .agg(F.avg(F.when(kind == TEXT, text)).alias("text"),
                  F.sum(F.when(kind == STYLE, n / m * F.log(m / n) / F.log(m))).alias("style"),
                  F.max(kind == MARK).alias("marked"), F.max(kind == FAR).alias("far"),
                  *[F.collect_set(F.when((kind == TEXT) & (n >= LEAST_PAGES) & (text < LEAST_IMPORTANCE) & where, code))
                    .alias(name) for name, where in (("some", F.lit(True)), ("most", n * 2 > m))]))
    # inside an unmarked article a text is stale only on most pages
    parts = parts.withColumn("stale", F.when(F.col("marked") | F.col("far"), F.col("some")).otherwise(F.col("most")))
    return parts.select("host", "path", "pages", "marked", "stale", (
        PRESENTATION * F.least(F.lit(1.0), F.coalesce("style", F.lit(0.0)))
        + (1 - PRESENTATION) * F.coalesce("text", F.lit(1.0))
        - MARKED * F.col("marked").cast("int") - OUTSIDE * F.col("far").cast("int")).alias("importance"))


_SETS = ["_paths", "_saved", "_stale"]


def _extract(batches):
    for batch in batches:
        sets = zip(*(batch.column(n).to_pylist() for n in _SETS))
        texts = [Page(s).text(None if u is None else frozenset(u), frozenset(k or ()), frozenset(c or ()))
                 for s, (u, k, c) in zip(batch.column("_html").to_pylist(), sets)]
        keep = [i for i, n in enumerate(batch.schema.names) if n not in ("_html", *_SETS)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=[batch.schema.names[i] for i in keep] + ["text", "n_chars"])


def main_text(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null html gives empty text; a null url is a host of its own name (empty).
    Repeated rows are extracted alike and count once in the tree.  Hosts with
    fewer than ``LEAST_PAGES`` distinct pages are judged by marks, and by the
    article or main element where that holds most of the text."""
    low = F.col("importance") < LEAST_IMPORTANCE
    noise = (style_tree(pages, url_col, html_col)
             .groupBy("host").agg(F.collect_set(F.when(low, F.col("path"))).alias("_paths"),
                                  F.collect_set(F.when(~low & F.col("marked"), F.col("path"))).alias("_saved"),
                                  F.array_distinct(F.flatten(F.collect_list(F.when(~low, F.col("stale"))))).alias("_stale")))
    noise = staged(noise, "style-tree")          # small, so its size is known when the join is planned
    url = F.coalesce(F.col(url_col), F.lit(""))
    name = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("_html"), name.alias("_host"))
    return (rows.join(noise, rows["_host"] == noise["host"], "left").select("page_id", "url", "_html", *_SETS)
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
