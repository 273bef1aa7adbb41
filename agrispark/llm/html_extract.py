"""Main text of web pages by a tree-structured graphical model over the DOM.

Block elements of a page are nodes with two states, boilerplate and content. A node's own features (tag, hints in
class, id and role, text length, link share, sentence marks) give its unary potential; a 2 x 2 potential joins each
node to its parent, one for each kind of region that the node stands in: that of the nearest hint at or above it. So
the state of a comment list or a sidebar carries down to paragraphs that look like an article's. Sum-product messages up and down the tree yield the exact marginal of every node, and the text
blocks of nodes with a content marginal of a half or more are the page's text. All potentials are smoothed counts
over labelled pages: those of a bounded sample that mark their article themselves.

Edge cases: null or empty html gives the empty text; unclosed, unmatched and overlapping tags are repaired the way
browsers do for paragraphs, list items and table cells; very long pages are parsed in one linear
pass, deep or broken nesting, unclosed comments and quotes included; without
labelled pages the prior counts alone decide; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import mapped, table

#: At most so many pages, those of the smallest hash of their id, train the potentials.
MOST_LABELLED = 2_000

TAG = re.compile(
    r"""<(?:!--|!\[CDATA\[|[!?][^>]*+>)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.VERBOSE,
)
COMMENT_END = re.compile(r"--!?>")
#: Attributes of elements that browsers don't show.
UNSEEN = re.compile(r"""(?:^|[\s"'])hidden(?=[\s=/]|$)|\bstyle\s*=\s*(?:"[^"]*?display\s*:\s*none|'[^']*?display\s*:\s*none)""", re.IGNORECASE)
LOOSE = re.compile(r"<(?:!--|!\[CDATA\[|[!?][^>]*+>)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>()()()")
#: Tags whose quotes close nowhere on the page, after which quotes no longer hide a ``>``.
MOST_LOOSE = 16
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
SPLIT_NAME = re.compile(r"[^a-z]+")
#: Elements by how they are parsed (fixed values).
RAW = frozenset("script style textarea title iframe".split())
#: Text is left out while one of these is open.
HIDDEN = frozenset("noscript template svg object canvas select button datalist label video audio annotation annotation-xml".split())
#: Blocks that end an open button, select or svg.
ENDS = frozenset("article main section aside nav header footer table form h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody
    td tfoot th thead tr ul""".split()
)
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
BAD_TAGS = frozenset("nav footer aside form header menu dialog".split())
GOOD_TAGS = frozenset("article main".split())
#: Words in names of classes, ids and roles that speak for boilerplate or for content (fixed values).
BAD_WORDS = frozenset(
    """ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie
    cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notices pager pagination popup promo promoted recommended related respond search share sharing sidebar signup
    skip social sponsor sponsored subscribe subscription tags toolbar widget reply replies reader""".split()
)
GOOD_WORDS = frozenset("article body content entry main post story text".split())
#: Words for boilerplate that say nothing beside one for content: a story's header is part of it.
WEAK_WORDS = frozenset("header footer reader tags copyright banner masthead".split())
#: Words for which elements within a line are left out as well.
INLINE_WORDS = frozenset("ad ads advert advertisement advertising promo promoted share sharing social sponsor sponsored".split())


class Page:
    """Nodes (parents before children) and text blocks ``(node, text, linked characters)`` in page order."""

    def __init__(self) -> None:
        self.parent, self.tag, self.hint = [-1], ["#root"], ["none"]
        self.blocks: list[tuple[int, str, int]] = []


def words_of_names(attributes: str) -> set[str]:
    words: set[str] = set()
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            words.update(SPLIT_NAME.split((m[1] or m[2] or m[3] or "").lower()))
    return words


def hint_of(tag: str, attributes: str) -> str:
    words = words_of_names(attributes)
    bad, good = words & BAD_WORDS, words & GOOD_WORDS
    if tag in BAD_TAGS or bad and (bad - WEAK_WORDS or not good):
        return "bad"
    return "none" if bad else "good" if tag in GOOD_TAGS or good else "none"


def unseen(attributes: str) -> bool:
    return bool(attributes) and UNSEEN.search(attributes) is not None


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("#root", 0)]
    depths: dict[str, list[int]] = {}  # of the open elements of each name
    links = 0
    pieces: list[str] = []
    linked = 0
    cover = 0  # depth of the outermost hidden element, 0 for none
    last_end = source.rfind(">")
    ends: dict[str, int] = {}

    def closed_later(name: str) -> bool:
        """Whether a closing tag follows; a name is searched for once."""
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(rf"</{name}\b", source, re.IGNORECASE)), default=-1)
        return ends[name] >= at

    def after(name: str) -> int:
        """Where the next closing tag ends."""
        found = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(source, at) if closed_later(name) else None
        return found.end() if found else len(source)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            page.blocks.append((stack[-1][1], text, linked))
        pieces.clear()
        linked = 0

    def push(name: str, node: int) -> None:
        depths.setdefault(name, []).append(len(stack))
        stack.append((name, node))

    def top(names) -> int:
        """Depth of the innermost open element of these names, 0 for none."""
        return max((depths[x][-1] for x in names if depths.get(x)), default=0)

    def close_to(depth: int) -> None:
        nonlocal links, cover
        if any(name in BLOCK for name, _ in stack[depth : cover or None]):
            flush()
        if cover >= depth:
            cover = 0
        for name, _ in stack[depth:]:
            depths[name].pop()
            links -= name == "a"
        del stack[depth:]

    def close_open(names: str, until: tuple[str, ...]) -> None:
        depth = top(names.split())
        if depth > top(until):
            close_to(depth)

    at, loose = 0, 0
    # nothing is looked for behind the last ``>``, where every ``<`` would be followed to the end in vain
    while at <= last_end and (m := (TAG if loose < MOST_LOOSE else LOOSE).search(source, at, last_end + 1)) is not None:
        if m.start() > at and not cover:
            run = html.unescape(source[at : m.start()])
            pieces.append(run)
            linked += len(run) if links else 0
        at = m.end()
        if m[0] in ("<!--", "<![CDATA["):
            comment = m[0] == "<!--"
            if comment and (early := next((e for e in (">", "->") if source.startswith(e, at)), None)):
                at += len(early)  # an empty comment may end at once
                continue
            mark = "-->" if comment else "]]>"
            if mark not in ends:
                ends[mark] = max(source.rfind(x) for x in (("-->", "--!>") if comment else (mark,)))
            if ends[mark] < at:
                at = source.index(">", at) + 1 if at <= last_end else len(source)
            else:
                at = COMMENT_END.search(source, at).end() if comment else source.index(mark, at) + 3
            continue
        if m[5]:
            loose += 1
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            depth = top((name,))
            if depth and (name in BLOCK or depth > top(("td", "th", "li", "article", "body"))):
                close_to(depth)
        elif name in RAW:
            if name != "iframe" or not (m[3] or m[6] or "").rstrip().endswith("/") and closed_later(name):
                at = after(name)
            pieces.append(" ")
        elif name in HIDDEN:
            pieces.append(" ")
            slash = name == "svg" and (m[3] or m[6] or "").rstrip().endswith("/")
            if not slash and closed_later(name):
                if name == "button":
                    close_open("button", ())
                push(name, stack[-1][1])
                cover = cover or len(stack) - 1
        elif name in VOID:
            if name == "hr" and not cover:
                flush()
            else:
                pieces.append(" " if name == "br" else "")
        else:
            attributes = m[3] or m[6] or ""
            if name in ENDS and cover and stack[cover][0] in ("button", "select", "svg"):
                close_to(cover)
            if cover or unseen(attributes) and closed_later(name):
                if not cover:
                    if name in BLOCK:
                        flush()
                    cover = len(stack)
                push(name, stack[-1][1])
                links += name == "a"
            elif name in BLOCK:
                close_open("p", ("table", "td", "th", "li", "blockquote", "article", "section", "div", "button"))
                if name in CLOSES:
                    close_open(*CLOSES[name])
                flush()
                page.parent.append(stack[-1][1])
                page.tag.append(name)
                page.hint.append(hint_of(name, attributes))
                push(name, len(page.parent) - 1)
            elif not attributes.rstrip().endswith("/"):
                if words_of_names(attributes) & INLINE_WORDS and closed_later(name):
                    pieces.append(" ")
                    cover = len(stack)
                push(name, stack[-1][1])
                links += name == "a"
    if at < len(source) and not cover:
        pieces.append(html.unescape(source[at:]))
    close_to(1)
    flush()
    return page


def features(page: Page) -> list[tuple[str, ...]]:
    """The discrete features of each node."""
    n = len(page.parent)
    own, text, linked, marks = [0] * n, [0] * n, [0] * n, [0] * n
    for node, block, in_links in page.blocks:
        own[node] += len(block)
        text[node] += len(block)
        linked[node] += in_links
        marks[node] += sum(map(block.count, (". ", ", ", "! ", "? "))) + (block[-1] in ".!?:")
    for v in range(n - 1, 0, -1):
        p = page.parent[v]
        text[p] += text[v]
        linked[p] += linked[v]
    return [
        (
            f"tag {page.tag[v]}", f"hint {page.hint[v]}", f"own {min(9, own[v].bit_length())}",
            f"links {round(4 * min(1.0, linked[v] / text[v])) if text[v] else -1}", f"marks {min(3, marks[v])}",
        )
        for v in range(n)
    ]


def regions(page: Page) -> list[str]:
    """For each node the nearest hint at or above it."""
    out = ["none"]
    for v in range(1, len(page.parent)):
        out.append(page.hint[v] if page.hint[v] != "none" else out[page.parent[v]])
    return out


def labels(page: Page) -> list[int] | None:
    """Content states of a page that marks one article itself; None when it doesn't."""
    articles = [v for v, t in enumerate(page.tag) if t in GOOD_TAGS]
    if len(articles) != 1:
        return None
    states = [0] * len(page.parent)
    for v in range(1, len(page.parent)):
        inside = v == articles[0] or states[page.parent[v]] == 1
        states[v] = int(inside and page.hint[v] != "bad")
    return states


class Potentials:
    """Log potentials: of features by state, of child state by parent state and the child's region, with prior counts for the hints."""

    def __init__(self, counts: Counter) -> None:
        self.table: dict[str, tuple[float, float]] = {}
        seen = Counter({("hint bad", 0): 40, ("hint bad", 1): 0.5, ("hint good", 1): 8, ("hint good", 0): 2})
        edges = Counter({(r, *k): c for r in ("good", "none") for k, c in {(0, 0): 8.0, (0, 1): 2.0, (1, 0): 1.0, (1, 1): 20.0}.items()})
        edges |= Counter({("bad", 0, 0): 20.0, ("bad", 0, 1): 0.001, ("bad", 1, 0): 20.0, ("bad", 1, 1): 0.001})
        for key, c in counts.items():
            if key[0] == "edge":
                edges[key[1:]] += c
            else:
                seen[key] += c
        kinds: dict[str, set[str]] = {}
        for name, _ in seen:
            kinds.setdefault(name.split(" ")[0], set()).add(name)
        for names in kinds.values():
            total = [sum(seen[name, y] + 0.5 for name in names) for y in (0, 1)]
            for name in names:
                self.table[name] = tuple(math.log((seen[name, y] + 0.5) / total[y]) for y in (0, 1))
        self.edge = {r: [[math.log(edges[r, x, y] / (edges[r, x, 0] + edges[r, x, 1])) for y in (0, 1)] for x in (0, 1)] for r in ("good", "none", "bad")}


def _add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(page: Page, potentials: Potentials) -> list[float]:
    """Content marginal of each node by sum-product: one pass up, one down. The root is boilerplate."""
    n, parent = len(page.parent), page.parent
    edges = [potentials.edge[r] for r in regions(page)]
    unary = []
    for names in features(page):
        found = [potentials.table.get(x, (0.0, 0.0)) for x in names]
        unary.append([sum(f[0] for f in found), sum(f[1] for f in found)])
    unary[0][1] -= 20.0
    up = [list(u) for u in unary]
    sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
    for v in range(n - 1, 0, -1):
        b, edge = up[v], edges[v]
        sent[v] = tuple(_add(edge[x][0] + b[0], edge[x][1] + b[1]) for x in (0, 1))
        up[parent[v]][0] += sent[v][0]
        up[parent[v]][1] += sent[v][1]
    whole = [list(up[0])] + [[0.0, 0.0]] * (n - 1)
    for v in range(1, n):
        p, edge = whole[parent[v]], edges[v]
        rest = (p[0] - sent[v][0], p[1] - sent[v][1])
        whole[v] = [up[v][y] + _add(edge[0][y] + rest[0], edge[1][y] + rest[1]) for y in (0, 1)]
    return [1 / (1 + math.exp(min(700.0, b[0] - b[1]))) for b in whole]


def main_text(source: str | None, potentials: Potentials) -> str:
    if not source:
        return ""
    page = parse(source)
    share = marginals(page, potentials)
    return "\n\n".join(text for node, text, _ in page.blocks if share[node] >= 0.5)


def trained(pages: DataFrame, most: int = MOST_LABELLED, id_col: str = "page_id", html_col: str = "html") -> Potentials:
    """Potentials from the labelled pages among ``most`` pages; the counts are summed by key in Spark."""
    numbered = pages.where(F.col(html_col).isNotNull()).select(F.xxhash64(F.col(id_col).isNull(), id_col).alias("_id"), F.col(html_col).alias("html"))
    first = numbered.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(most)
    chosen = numbered.join(F.broadcast(first), "_id", "left_semi").dropDuplicates(["_id"])  # ``most`` numbers

    def run(batch: pa.RecordBatch):
        counts: Counter = Counter()
        for source in batch.column(0).to_pylist():
            page = parse(source)
            states = labels(page)
            if states is not None:
                where = regions(page)
                for v, names in enumerate(features(page)):
                    counts.update((name, states[v]) for name in names)
                    if v:
                        counts["edge", where[v], states[page.parent[v]], states[v]] += 1
        keys = ["|".join(map(str, k)) for k in counts]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["k", "c"])

    summed = mapped(chosen.select("html"), run, "k string, c bigint").groupBy("k").agg(F.sum("c").alias("c")).collect()
    counts: Counter = Counter()
    for r in summed:
        name, *states = r["k"].rsplit("|", 3 if r["k"].startswith("edge|") else 1)
        counts[(name, *(int(x) if x.isdigit() else x for x in states))] = r["c"]
    return Potentials(counts)


def extracted(pages: DataFrame, potentials: Potentials, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the html."""
    shared = pages.sparkSession.sparkContext.broadcast(potentials)
    others = [c for c in pages.columns if c not in (html_col, "text")]
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in others)

    def run(batch: pa.RecordBatch):
        texts = [main_text(x, shared.value) for x in batch.column(len(others)).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string())], names=[*others, "text"])

    return mapped(pages.select(*others, html_col), run, f"{kinds}{', ' if kinds else ''}text string", 200)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = extracted(pages.select("page_id", "url", "html"), trained(pages))
    return out.withColumn("n_chars", F.length("text").cast("long"))
