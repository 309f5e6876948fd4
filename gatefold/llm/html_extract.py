"""Main text of web pages by consensus paths per host.

Every page scores its containers and names them by a generalised path of tags and classes. Spark
adds the scores up per host and path; the path with the most votes wins. A second pass over the
pages extracts the text below the winning path of their host, or below the page's own best container
where the path does not occur. A path names five levels and up to three classes each, numbers as ``#``:
unlike containers of one path are voted on, and extracted, together.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import picked, stored_copy, utf8

# Fixed values of HTML: elements without content, raw-text elements, and blocks that end a line.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# Fixed values of HTML: an opening tag closes the open elements of its row, up to the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
CLOSES_P = BLOCKS - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot",
                     "caption", "legend", "option", "optgroup", "figcaption", "summary"}
# Elements that never hold the article.
NEVER = frozenset(
    "nav footer aside form script style noscript template iframe object svg canvas button select "
    "textarea input head title menu dialog noembed noframes xmp audio video map label datalist".split()
)
CONTAINERS = frozenset("article main section div td body center blockquote".split())
# Words of a class or id that mark page furniture.
NOISE = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored banner promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside widget footer "
    "masthead topbar toolbar pagination pager comment comments commentlist disqus respond replies reply "
    "discussion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations "
    "teaser teasers trending popular outbrain taboola skip hidden copyright legal form search "
    "announcement disclaimer paywall feedback rating ratings toc".split()
)
# Those that also name the layout of a wrapper around the article; the first three only as a whole class or id.
WHOLE = frozenset("hidden side form".split())
LAYOUT = WHOLE | frozenset(
    "nav navbar navigation menu menubar sidebar widget footer masthead topbar toolbar banner search modal "
    "overlay skip toc".split()
)
# Kinds of furniture: layout can hold the article, matter such as ads hardly, readers' comments only within
# an article or main of its own, hidden never.
LAYOUT_KIND, MATTER, READERS, HARD = 1, 2, 3, 4
# Words of what readers wrote, and words that make such a name tell a state of the page instead.
READER_WORDS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
STATE_WORDS = frozenset("open closed enabled disabled allowed has no with without on off".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar toolbar dialog alert alertdialog "
    "form".split()
)
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SPACE = re.compile(r"\s+")
_PATH_DEPTH = 5
_LINE = "\n"


class Node:
    """An element: tag, parent, generalised label, its kind of furniture and whether it is taken as such."""

    __slots__ = ("tag", "parent", "label", "kind", "hard", "noise", "heading", "order", "block", "box",
                 "article", "main", "inside", "cut")

    def __init__(self, tag, parent, label, kind, order):
        self.tag, self.parent, self.label, self.kind, self.order = tag, parent, label, kind, order
        self.hard = kind == HARD or (parent is not None and parent.hard)
        self.noise, self.heading = False, False
        # nearest elements of a sort, the node included, so that nothing has to climb for them
        self.block = self if tag in BLOCKS or parent is None else parent.block
        self.box = self if tag in CONTAINERS else parent.box if parent is not None else None
        self.article = self if tag == "article" else parent.article if parent is not None else None
        self.main = self if tag == "main" else parent.main if parent is not None else None
        # within an article or main, and below a page header, which _join finds
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.cut = False

    def path(self) -> str:
        labels, node = [], self
        while node is not None and len(labels) < _PATH_DEPTH:
            labels.append(node.label)
            node = node.parent
        return ">".join(reversed(labels))


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _kind_of(names: list[str]) -> int:
    """Kind of furniture that class names and an id stand for, 0 for none."""
    kind = 0
    for name in names:
        words = [w.lower() for w in _WORDS.findall(name)]
        for w in words:
            if w in READER_WORDS and not STATE_WORDS.intersection(words):
                kind = READERS
            elif w in NOISE and (w not in WHOLE or w == name.lower()):
                kind = max(kind, LAYOUT_KIND if w in LAYOUT else MATTER)
    return kind


def _describe(tag: str, attrs: str) -> tuple[str, int]:
    """Label ``tag.class`` with numbers generalised, and the kind of furniture the element may be."""
    by_tag = LAYOUT_KIND if tag == "form" else HARD if tag in NEVER else 0
    if not attrs or attrs == "/":
        return tag, by_tag
    a = _attributes(attrs)
    classes = a.get("class", "").split()
    label = tag + "".join(f".{re.sub(r'[0-9]+', '#', c.lower())}" for c in sorted(classes)[:3])
    if (
        by_tag == HARD
        or "hidden" in a
        or a.get("aria-hidden", "").lower() == "true"
        or a.get("role", "").lower() in NOISE_ROLES
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I)
    ):
        return label, HARD
    if tag not in ("body", "html", "article", "main"):
        return label, max(by_tag, _kind_of([*classes, a.get("id", "")]))
    if tag == "article" and any(
        w.lower() in {"comment", "comments", "reply", "ad", "teaser", "related"} for c in classes
        for w in _WORDS.findall(c)
    ):
        return label, MATTER
    return label, 0


class Page:
    """Blocks of text in page order, each with the element that holds it."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, Node, int]] = []
        self.nodes: list[Node] = []
        self._pieces: list[tuple[list[tuple[str, Node, int]], Node]] = []
        self._parse(source)
        self._settle()

    def _open(self, tag, parent, attrs) -> Node:
        node = Node(tag, parent, *_describe(tag, attrs), len(self.nodes))
        self.nodes.append(node)
        return node

    def _settle(self) -> None:
        """Decide what is furniture, now that the whole page is known, and put the blocks together.

        Layout that holds most of the text is none. No layout covers an article or main, matter no main,
        nor the only articles there are; if nothing is left, only hidden and never-article elements and
        readers' comments are furniture.
        """
        held = [0] * len(self.nodes)
        matter = [False] * len(self.nodes)
        for node in self.nodes:
            above = node.parent is not None and node.tag != "main" and matter[node.parent.order]
            matter[node.order] = node.kind in (MATTER, READERS) or above
        for pieces, _ in self._pieces:
            for value, node, links in pieces:
                if not matter[node.order]:
                    held[node.order] += max(0, len(value.strip()) - 2 * links)
        for node in reversed(self.nodes[1:]):
            held[node.parent.order] += held[node.order]

        def decide(article_in_matter: bool, soft: bool) -> None:
            taken = [0] * len(self.nodes)
            for node in self.nodes:
                kind = node.kind
                if kind < READERS and not soft or kind == LAYOUT_KIND and 2 * held[node.order] > held[0]:
                    kind = 0
                above = taken[node.parent.order] if node.parent is not None else 0
                if above == LAYOUT_KIND and node.tag in ("article", "main") or above in (MATTER, READERS) and (
                    node.tag == "main" or node.tag == "article" and article_in_matter
                ):
                    above = 0
                taken[node.order] = HARD if node.hard else max(kind, above)
                node.noise = taken[node.order] > 0

        decide(False, True)
        if not any(n.tag in ("article", "main") and not n.noise for n in self.nodes):
            decide(True, True)
        self._join()
        if not self.containers():
            decide(True, False)
            self._join()

    def _join(self) -> None:
        """Lines of text outside furniture, and the elements with a heading."""
        self.blocks = []
        for node in self.nodes:
            node.heading = node.tag in ("h1", "h2") and not node.noise
        for node in reversed(self.nodes[1:]):
            node.parent.heading = node.parent.heading or node.heading
        for node in self.nodes:
            page_header = node.tag == "header" and not (node.heading and node.inside)
            node.cut = page_header or (node.parent is not None and node.parent.cut)
        for pieces, holder in self._pieces:
            shown = [p for p in pieces if not p[1].noise]
            line = _SPACE.sub(" ", "".join(p[0] for p in shown)).strip()
            if line:
                self.blocks.append((line, holder, sum(p[2] for p in shown)))

    def _parse(self, source: str) -> None:
        root = Node("html", None, "html", 0, 0)
        self.nodes.append(root)
        stack, text = [root], []
        # places in the stack by tag, and of all blocks, so that no tag has to search it
        places: dict[str, list[int]] = {"html": [0]}
        blocks = [0]

        def last(tag: str) -> int:
            found = places.get(tag)
            return found[-1] if found else -1

        def push(node: Node):
            places.setdefault(node.tag, []).append(len(stack))
            if node.tag in BLOCKS:
                blocks.append(len(stack))
            stack.append(node)

        def flush():
            nonlocal text
            if text:
                self._pieces.append((text, stack[-1].block))
                text = []

        def pop(depth: int):
            for node in stack[depth:]:
                places[node.tag].pop()
                if node.tag in BLOCKS:
                    blocks.pop()
            del stack[depth:]

        def inside_link() -> bool:
            return last("a") >= 0

        def add(raw: str):
            if not raw or stack[-1].hard:
                return
            value = html.unescape(raw) if "&" in raw else raw
            text.append((value, stack[-1], len(value.strip()) if inside_link() else 0))

        at, size = 0, len(source)
        while at < size:
            m = _MARKUP.search(source, at)
            if m is None:
                add(source[at:])
                break
            add(source[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag = tag.lower()
            ending = m["end"] if m["tag"] else m["end2"]
            attrs = (m["attrs"] if m["tag"] else m["attrs2"]) or ""
            block = tag in BLOCKS
            if ending:
                if tag == "br":
                    add(" ")
                elif last(tag) >= 0:
                    if block:
                        flush()
                    depth = last(tag)
                    if blocks[-1] > depth and not block:
                        continue  # a stray inline end tag does not close blocks
                    if depth:
                        pop(depth)
                elif block:
                    flush()
                continue
            if tag == "br" or tag == "wbr":
                if tag == "br":
                    add(" ")
                continue
            if block:
                flush()
                if tag in CLOSES_P and stack[blocks[-1]].tag == "p":
                    pop(blocks[-1])
                if tag in CLOSES:
                    closed, limits = CLOSES[tag]
                    depth = max(map(last, closed))
                    if depth > max(map(last, limits)):
                        pop(depth)
            if tag in VOID:
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                at = close.end() if close else size
                continue
            if tag == "a" and last("a") > blocks[-1]:
                pop(last("a"))
            if tag == "html" or tag == "body" and last("body") >= 0:
                continue
            if tag == "body" and last("head") >= 0:
                pop(last("head"))
            if not attrs.rstrip().endswith("/") or tag not in ("svg", "path"):
                push(self._open(tag, stack[-1], attrs))
        flush()

    @staticmethod
    def usable(node: Node) -> bool:
        """Is the block's text outside furniture and outside page headers?

        A ``header`` element counts as article text only inside the container and with a heading.
        """
        return not node.noise and not node.cut

    def containers(self) -> list[tuple[Node, float]]:
        """Containers with their scores: text outside links in full for the nearest container,
        half for the next one up, so that the tightest element around the article wins, which is then
        lifted to the element that holds the whole article. Where no text is in a container, the page
        is one."""
        scores: dict[int, float] = {}
        whole = 0.0
        for line, node, links in self.blocks:
            if not self.usable(node):
                continue
            value = float(max(0, len(line) - 2 * links))
            if not value:
                continue
            whole += value
            share, near = 1.0, node.box
            while near is not None and share > 0.2:
                scores[near.order] = scores.get(near.order, 0.0) + share * value
                share /= 2
                near = near.parent.box if near.parent is not None else None
        if not scores and whole:
            scores[0] = whole
        lifted = self._lifted()
        merged: dict[int, float] = {}
        for order, value in scores.items():
            node = lifted[order]
            merged[node.order] = merged.get(node.order, 0.0) + value
        return [(self.nodes[o], v) for o, v in merged.items()]

    def _lifted(self) -> list[Node]:
        """For every element the one that holds its whole article: the article around it, else main, else
        the highest container that it is a part of.

        A container is a part of the next one up if that one has a heading where it has none, or a fifth
        more text outside links, and if most of what is added is no links. The body is such a whole only
        if a heading stands in it directly.
        """
        plain, linked = [0] * len(self.nodes), [0] * len(self.nodes)
        for line, node, links in self.blocks:
            if self.usable(node):
                plain[node.order] += max(0, len(line) - links)
                linked[node.order] += links
        for node in reversed(self.nodes[1:]):
            plain[node.parent.order] += plain[node.order]
            linked[node.parent.order] += linked[node.order]
        titled = {n.parent.order for n in self.nodes if n.tag in ("h1", "h2") and self.usable(n)}
        whole: list[Node] = []
        for node in self.nodes:
            above = node.parent.box if node.parent is not None else None
            if node.article is not None or node.main is not None or node.box is not node or above is None:
                whole.append(node.article or node.main or node)
                continue
            more = plain[above.order] - plain[node.order]
            part = above.heading and not node.heading or 5 * more >= plain[node.order]
            part = part and more > 2 * (linked[above.order] - linked[node.order])
            whole.append(whole[above.order] if part and (above.tag != "body" or above.order in titled) else node)
        return whole

    def votes(self) -> dict[str, float]:
        """Best score per generalised path, of all containers."""
        best: dict[str, float] = {}
        for node, value in self.containers():
            path = node.path()
            best[path] = max(best.get(path, 0.0), value)
        return best

    def text(self, path: str | None) -> tuple[str, bool]:
        """Text below the elements with ``path``; below the best container where it is absent."""
        scored = self.containers()
        if not scored:
            return "", False
        tops = [node for node, _ in scored if node.path() == path] if path else []
        hit = bool(tops)
        if not hit:
            tops = [max(scored, key=lambda x: (x[1], -x[0].order))[0]]
        wanted = {node.order for node in tops}
        below = [False] * len(self.nodes)
        for node in self.nodes:
            below[node.order] = node.order in wanted or (node.parent is not None and below[node.parent.order])
        lines = [line for line, node, _ in self.blocks if below[node.order] and self.usable(node)]
        return _LINE.join(lines), hit


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _rows(pages: DataFrame, page_id: str, url: str, html_column: str) -> DataFrame:
    rows = picked(pages, page_id=page_id, url=url, html=html_column)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    return rows.withColumn("host", host)


def path_votes(pages: DataFrame) -> DataFrame:
    """(host, path, score, pages): votes of all pages, summed per host and path."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, sources = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            found: dict[tuple[str, str], list] = {}
            for i, host in enumerate(hosts):
                votes = Page(utf8(sources[i].as_py())).votes()
                total = sum(votes.values())
                for path, value in votes.items():
                    cell = found.setdefault((host, path), [0.0, 0])
                    cell[0] += round(value / total, 6)
                    cell[1] += 1
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in found], pa.string()),
                        pa.array([k[1] for k in found], pa.string()),
                        pa.array([v[0] for v in found.values()], pa.float64()),
                        pa.array([v[1] for v in found.values()], pa.int64()),
                    ],
                    names=["host", "path", "score", "pages"],
                )

    partial = pages.select("host", "html").mapInArrow(
        vote, "host string, path string, score double, pages long"
    )
    return partial.groupBy("host", "path").agg(
        F.round(F.sum("score"), 4).alias("score"), F.sum("pages").alias("pages")
    )


def consensus_paths(votes: DataFrame) -> DataFrame:
    """(host, path): the path with the highest summed score, ties by more pages, then by name."""
    order = Window.partitionBy("host").orderBy(F.desc("score"), F.desc("pages"), "path")
    return (
        votes.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("host", "path")
    )


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars, host, path, by_consensus`` for every page.

    Null or empty html and pages without text give an empty text. A null or unusual url has
    the empty host, whose pages vote together. Repeated rows vote and are returned each. Hosts are
    voted on with map-side sums, and the winners (one row per host) are stored before the join, so
    Spark knows their size when it chooses how to join; the pages are only scanned.
    """
    rows = _rows(pages, page_id, url, html_column)
    winners = stored_copy(consensus_paths(path_votes(rows)), "html-paths").select(
        F.col("host").alias("voted_host"), "path"
    )
    joined = rows.join(winners, F.col("host") == F.col("voted_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, paths = batch.column(2).cast(pa.binary()), batch.column(4).to_pylist()
            texts, hits = [], []
            for i in range(batch.num_rows):
                text, hit = Page(utf8(sources[i].as_py())).text(paths[i])
                texts.append(text)
                hits.append(hit)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()), batch.column(3),
                    batch.column(4), pa.array(hits, pa.bool_()),
                ],
                names=["page_id", "url", "text", "n_chars", "host", "path", "by_consensus"],
            )

    return joined.select("page_id", "url", "html", "host", "path").mapInArrow(
        run,
        "page_id long, url string, text string, n_chars long, host string, path string, "
        "by_consensus boolean",
    )
