"""Main text of web pages by consensus of each host: pages vote on container paths, winning paths extract all its pages."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.llm import common
from factorspark.session import materialize

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>"']|\Z)""", re.IGNORECASE)
DIGITS = re.compile(r"\d+")

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("html body div article main section center td th tr table tbody thead tfoot figure details dialog hgroup "
                       "header footer nav aside form fieldset menu noscript template".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote address hr figcaption caption summary legend "
                                "option optgroup".split())
DROPPED = frozenset("nav header footer aside form menu noscript template button select svg math canvas object audio video iframe dialog "
                    "script style textarea title head datalist fieldset label input map".split())
ENDS_PARAGRAPH = BLOCKS - {"option", "optgroup", "legend", "summary", "caption"}
# Words of class and id names, and roles, that mark what is not the article.
MARKS = re.compile(
    r"(?:^|[-_])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|promotion|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"footer|header|masthead|comments?|commentlist|disqus|replies|respond|cookies?|consent|notice|notices|banner|popup|modal|newsletter|"
    r"subscribe|signup|share|sharing|social|related|widget|pagination|pager|skip-?link|toolbar|login|search)(?:$|[-_])")
NOT_MARKS = re.compile(r"^(?:no|has|with|without|is)[-_]")
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
ALWAYS_KEPT = frozenset("html body article main".split())
# Words of class and id names that say that the article may lie inside although a mark stands beside them.
WRAPS = re.compile(r"(?:^|[-_])(?:content|post|article|main|page|entry|story|body|text|layout|wrapper|wrap|site|container|single|blog|template|theme|free|with|open)(?:$|[-_])")
#: A weak mark (one beside such a word, or a form) drops what holds less than this share of the page's unlinked text.
WEAK_SHARE = 0.5
#: Any other mark drops what leaves at least this share outside.
LEFT_SHARE = 0.02
DROP, WEAK, STRONG = 1, 2, 3


@dataclass
class Block:
    container: int
    text: str
    linked: int


@dataclass
class Page:
    """Containers with the numbers of their paths and their parents, and the blocks of text in page order. The number of a path is
    a hash of its last step and its parent's number, so that deep nesting costs no text."""

    paths: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def path_number(parent: int, step: str) -> int:
    """A signed 64-bit number."""
    n = xxhash.xxh64_intdigest(step, seed=parent & (1 << 64) - 1)
    return n - (1 << 64) if n >> 63 else n


def path_of(steps: str) -> int:
    """The number of a path written as ``html>body>div.a.b``."""
    n = 0
    for step in steps.split(">"):
        n = path_number(n, step)
    return n


def _attributes(attrs: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) if v else "" for k, v in ATTRIBUTE.findall(attrs)} if attrs else {}


def _verdict(tag: str, at: dict[str, str]) -> int:
    """DROP for what is never part of an article, WEAK or STRONG for what its name or role marks, else 0."""
    if tag in DROPPED and tag != "form":
        return DROP
    if at and tag not in ALWAYS_KEPT:
        if "hidden" in at or at.get("aria-hidden", "").lower() == "true" or "display:none" in at.get("style", "").replace(" ", "").lower():
            return DROP
        names = (at.get("class", "") + " " + at.get("id", "")).lower().split()
        marked = any(MARKS.search(x) and not NOT_MARKS.match(x) for x in names)
        if marked or at.get("role", "").lower() in MARKED_ROLES:
            return WEAK if any(WRAPS.search(x) for x in names) else STRONG
    return WEAK if tag == "form" else 0


def _kept_marks(parents: list[int], weak: list[bool], marks: list[int], blocks: list[Block]) -> list[bool]:
    """Which marked containers stay: those that hold too much of the page's text to be what their mark says, and lie in none that goes."""
    held = [0] * len(parents)
    total = 0
    for b, m in zip(blocks, marks, strict=True):
        free = len(b.text) - b.linked
        total += free
        while m >= 0:
            held[m] += free
            m = parents[m]
    stay: list[bool] = []
    for up, soft, n in zip(parents, weak, held, strict=True):  # outer ones come first
        much = n >= WEAK_SHARE * total if soft else total - n < LEFT_SHARE * total
        stay.append(much and n > 0 and (up < 0 or stay[up]))
    return stay


def parse(source: str | None) -> Page:
    """The containers and text blocks of a page; what menus, notices, adverts, forms and the like hold is left out.

    A class, id or role only marks a container: it stays where it holds so much of the page's text that it must be around the
    article (see ``_kept_marks``), as does a form around the whole page.

    Broken markup is read on: a missing end tag is closed by the next block or an outer end tag, an end tag without a start
    is ignored, unclosed comments and scripts last to the end.
    """
    page = Page([path_number(0, "html")], [-1])
    if not source:
        return page
    stack: list[tuple[str, int, bool, int]] = [("", 0, False, -1)]  # tag, container, dropped, innermost mark
    mark_parents: list[int] = []
    weak: list[bool] = []
    marks: list[int] = []  # of each block
    buffer: list[str] = []
    linked = 0
    links = 0
    pos, n = 0, len(source)

    def flush():
        nonlocal linked
        text = " ".join("".join(buffer).split())
        if text:
            page.blocks.append(Block(stack[-1][1], text, min(linked, len(text))))
            marks.append(stack[-1][3])
        buffer.clear()
        linked = 0

    def close_to(depth: int):
        nonlocal links
        for tag, *_ in stack[depth:]:
            links -= tag == "a"
        del stack[depth:]

    def add(raw: str):
        nonlocal linked
        if raw and not stack[-1][2]:
            text = html.unescape(raw) if "&" in raw else raw
            buffer.append(text)
            if links:
                linked += len(text)

    while pos < n:
        lt = source.find("<", pos)
        if lt < 0:
            add(source[pos:])
            break
        m = TOKEN.match(source, lt)
        if m is None:  # a bare "<"
            add(source[pos:lt + 1])
            pos = lt + 1
            continue
        add(source[pos:lt])
        pos = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == tag), 0)
            if depth:
                if any(t in BLOCKS for t, *_ in stack[depth:]):
                    flush()
                close_to(depth)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            flush()
            if tag in ENDS_PARAGRAPH:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] == "p":
                        close_to(d)
                        break
                    if stack[d][0] in CONTAINERS:
                        break
            if tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
                        "tr": ("tr", "td", "th"), "option": ("option",)}[tag]
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] in same:
                        close_to(d)
                        break
                    if stack[d][0] in ("ul", "ol", "dl", "table", "select") or stack[d][0] in CONTAINERS - {"tbody", "thead", "tfoot"}:
                        break
        attrs = _attributes(m["attrs"])
        dropped, mark = stack[-1][2:]
        if not dropped and (verdict := _verdict(tag, attrs)):
            if verdict == DROP or tag not in BLOCKS:  # what stands inside a line is not around the article
                dropped = True
            elif tag not in VOID:
                mark_parents.append(mark)
                weak.append(verdict == WEAK)
                mark = len(weak) - 1
        if tag in VOID or m["attrs"].rstrip().endswith("/") and tag in ("svg", "path", "circle", "rect"):
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(source, pos)
            pos = close.end() if close else n
            continue
        at = stack[-1][1]
        if tag in CONTAINERS and not dropped and tag not in ("html",):
            names = sorted({DIGITS.sub("#", x) for x in attrs.get("class", "").split()})
            page.paths.append(path_number(page.paths[at], ".".join([tag, *names])))
            page.parents.append(at)
            at = len(page.paths) - 1
        links += tag == "a"
        stack.append((tag, at, dropped, mark))
    flush()
    if weak:
        stay = _kept_marks(mark_parents, weak, marks, page.blocks)
        page.blocks = [b for b, m in zip(page.blocks, marks, strict=True) if m < 0 or stay[m]]
    return page


def container_scores(page: Page, fade: float = 0.75) -> list[float]:
    """For each container the characters of its blocks, links counted against, those of inner containers faded by level."""
    score = [0.0] * len(page.paths)
    for b in page.blocks:
        value, at = max(0.0, len(b.text) - 2.0 * b.linked), b.container
        while at >= 0 and value > 0.01:
            score[at] += value
            value *= fade
            at = page.parents[at]
    return score


def candidates(page: Page, fade: float = 0.75) -> dict[int, float]:
    """Container paths with the scores they compete with.

    A path of several containers competes as the innermost container around all of them: what lies in them isn't faded by
    the levels between, and the headline, lead and text around them belong to it.
    """
    score = container_scores(page, fade)
    depth = [0] * len(page.paths)
    by_path: dict[int, list[int]] = {}
    for i, (p, up) in enumerate(zip(page.paths, page.parents, strict=True)):
        depth[i] = depth[up] + 1 if up >= 0 else 0
        if score[i] > 0:
            by_path.setdefault(p, []).append(i)
    out: dict[int, float] = {}
    for p, found in by_path.items():
        top, value = found[0], score[found[0]]
        for i in found[1:]:
            while depth[top] > depth[i]:
                top = page.parents[top]
            while depth[i] > depth[top]:
                i = page.parents[i]
            while top != i:
                top, i = page.parents[top], page.parents[i]
        if len(found) > 1:
            value = score[top] + sum(score[i] * (1 - fade ** (depth[i] - depth[top])) for i in found)
        out[page.paths[top]] = max(out.get(page.paths[top], 0.0), value)
    return out


def best_paths(page: Page) -> list[tuple[int, int]]:
    """The page's container paths, best first, with votes of up to 1000, their shares of the best score."""
    top = sorted((-s, p) for p, s in candidates(page).items())
    return [(p, n) for s, p in top if (n := round(1000 * s / top[0][0]))]


def text_of(page: Page, path: int | None, usual: float = 0.0, share: float = 0.1) -> str:
    """The blocks within containers of that path; of the page's own best container where it has none.

    Also of its own best one where the path holds less than ``share`` of that one's score and that one no less than ``usual``,
    the score that the path has on the host's pages: a side list may outweigh a short article, but not a main text elsewhere.
    """
    if path is None or path not in page.paths:
        own = best_paths(page)
        if not own:
            return ""
        path = own[0][0]
    else:
        found = candidates(page)
        best = min(((-s, p) for p, s in found.items()), default=(0.0, path))
        held = sum(s for p, s in zip(page.paths, container_scores(page), strict=True) if p == path)
        if max(held, found.get(path, 0.0)) < share * -best[0] and -best[0] >= usual:
            path = best[1]
    inside = [False] * len(page.paths)
    for i, (p, up) in enumerate(zip(page.paths, page.parents, strict=True)):
        inside[i] = p == path or up >= 0 and inside[up]
    return "\n\n".join(b.text for b in page.blocks if inside[b.container])


def host_of(url: Column) -> Column:
    """The host of a URL, lower case, without user and port; empty for null or a text that has none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``host, path, usual``: the container path with the most votes of each host's pages, of equals the smallest number (see ``path_number``), and
    its mean score on the pages that vote for it."""
    def vote(b):
        sums: dict[tuple[str, int], list[int]] = {}
        for h, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            page = parse(s)
            scores = candidates(page)
            for p, v in best_paths(page):
                x = sums.setdefault((h, p), [0, 0, 0])
                x[0] += v
                x[1] += round(scores[p])
                x[2] += 1
        return {"host": [h for h, _ in sums], "path": [p for _, p in sums], **{k: [x[i] for x in sums.values()] for i, k in enumerate(("votes", "score", "n"))}}

    votes = common.map_batches(pages.select(host_of(F.col(url)).alias("host"), source), vote, "host string, path long, votes long, score long, n long")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), (F.sum("score") / F.sum("n")).alias("usual"))
    best = summed.groupBy("host").agg(F.min_by(F.struct("path", "usual"), F.struct(-F.col("votes"), F.col("path"))).alias("best"))
    return best.select("host", "best.path", "best.usual")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` for each row.

    Pages are read twice: first each votes, with the scores of its containers, for generalised tag and class paths of its
    host; then the winning path extracts every page of the host. Winners are one row for each host, so the second pass
    shuffles pages only where that table is too large to send out. A page without the winning path, or with its main text
    elsewhere, takes its own best container; a null, empty or textless page has an empty text. Repeated rows give repeated results, null keys keep
    their rows, pages without a host vote as one host, an empty table gives no rows. Pages of any length and depth are read whole, in
    time and memory that grow with their length. Other columns of ``pages``, whatever their names, are not read.
    """
    winners = materialize(host_paths(pages, url, source), "host_paths")
    joined = pages.select(key, url, source, host_of(F.col(url)).alias("_host")).join(
        winners.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("usual").alias("_usual")), "_host", "left")

    def extract(b):
        texts = [text_of(parse(s), p, u or 0.0) for s, p, u in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        return {key: b.column(0), url: b.column(1), "text": texts, "n_chars": list(map(len, texts))}

    return common.map_batches(joined.select(key, url, source, "_path", "_usual"), extract,
                              f"{key} {pages.schema[key].dataType.simpleString()}, {url} string, text string, n_chars long")
