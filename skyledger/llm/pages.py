"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

A page becomes a tree of block elements whose leaves are runs of text. Boosted
trees give every node the log odds that its subtree holds main text, from subtree
density, attribute tokens, depth and sibling statistics. Decoding then finds the
most likely choice in which a node is kept only with all its ancestors, so no
text survives inside a part that is out.

No page is labelled. The trees are trained on at most ``SAMPLE`` pages: as they
are, where an ``article`` or ``main`` element marks the text, and laid out anew
with their own text in layouts with menus, sidebars, notices, adverts, forms and
comments, with and without telling names.

Defined cases: a null or empty page, and one whose text is all out, give an empty
text; unclosed elements end with their parent; an unclosed comment, script, style,
textarea or title runs to the end; an unclosed button, select, svg or other hidden
element ends where the next block starts or ends; text of formulas stays; blocks are joined as they stand, none is dropped as a repetition;
repeated rows are treated one by one; a null ``url`` or ``page_id`` is carried
along; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import boosting
from skyledger.llm.common import parts

#: Pages the trees are trained on at most, about, and new layouts of each.
SAMPLE, LAYOUTS = 300, 4

# Elements by what they mean for the text.
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main "
    "header footer nav aside blockquote pre figure figcaption form fieldset address details summary hr menu dialog "
    "center hgroup search".split()
)
#: Their content is text up to the end tag, whatever it looks like.
RAW = frozenset("script style textarea title".split())
HIDDEN = frozenset("noscript template svg select iframe object canvas button audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
POSITIVE = frozenset(("article", "main"))
NEGATIVE = frozenset("nav aside footer header form menu dialog search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GOOD = frozenset("article content post entry story body text main prose".split())
BAD = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments reply replies respond disqus "
    "discussion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended promo promoted promotion sponsor sponsored sidebar aside widget footer "
    "header menu nav navigation navbar toolbar pager pagination login search copyright legal disclaimer masthead alert "
    "topbar complementary contentinfo dialog form".split()
)
#: What ends an open element of the kind when it starts.
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
}
TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[!?][^>]*(?:>|\Z))", re.S)
#: Tags of hidden elements; comments and raw text are passed over.
HIDING = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(RAW))})(?=[\s/>])[^>]*(?<!/)>.*?(?:</\1|\Z)"
    rf"|<(/?)({'|'.join(sorted(HIDDEN))})(?=[\s/>])([^>]*)>",
    re.I | re.S,
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LETTERS = re.compile("[A-Z]?[a-z]+|[A-Z]+")
STOPS = re.compile("[.,;:!?]")
FEATURES = 36


def hidden_ends(source: str) -> dict[int, int]:
    """Place of the end tag of each hidden element that has one, by the place of its start tag."""
    opened: dict[str, list[int]] = {tag: [] for tag in HIDDEN}
    ends = {}
    for found in HIDING.finditer(source):
        if found[3] is None:
            continue
        places = opened[found[3].lower()]
        if not found[2]:
            if not found[4].endswith("/"):
                places.append(found.start())
        elif places:
            ends[places.pop()] = found.start()
    return ends


class Page:
    """Block tree of a page: parallel lists in page order; ``text`` is None for elements."""

    def __init__(self, source: str):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.names: list[frozenset[str]] = []
        self.text: list[str | None] = []
        self.linked: list[int] = []
        self.end: list[int] = []
        self.read(source)

    def add(self, parent: int, tag: str, names: frozenset[str], text: str | None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1

    def read(self, source: str) -> None:
        none: frozenset[str] = frozenset()
        stack = [self.add(-1, "#page", none, None)]
        held: list[str] = []
        links: list[str] = []
        in_link, at, find = False, 0, TAG.search
        lowered: str | None = None
        ends: dict[int, int] | None = None
        # In a hidden element: where it ends (-1 if it has no end tag), and the blocks open inside.
        hidden: int | None = None
        inside: list[str] = []

        def flush() -> None:
            if held:
                text = " ".join(html.unescape("".join(held)).split())
                held.clear()
                if text:
                    inside = len(" ".join(html.unescape("".join(links)).split()))
                    self.add(stack[-1], "#text", none, text, min(inside, len(text)))
            links.clear()

        while True:
            found = find(source, at)
            piece = source[at : found.start()] if found else source[at:]
            if piece and hidden is None:
                held.append(piece)
                if in_link:
                    links.append(piece)
            if not found:
                break
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if hidden is not None and found.start() >= hidden >= 0:
                hidden = None
            if hidden is not None and not (tag in RAW and not found[1]):
                if hidden < 0:
                    if tag not in BLOCKS and (found[1] or tag not in HIDDEN):
                        continue
                elif tag not in BLOCKS or tag == "hr":
                    continue
                elif not found[1]:
                    inside.append(tag)
                    continue
                elif tag in inside:
                    while inside.pop() != tag:
                        pass
                    continue
                elif all(self.tag[i] != tag for i in stack):
                    continue
                hidden = None
            if found[1]:
                if tag == "a":
                    in_link = False
                elif tag in BLOCKS:
                    flush()
                    for depth in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[depth]] == tag:
                            del stack[depth:]
                            break
                continue
            if tag in HIDDEN:
                if not found[3].endswith("/"):
                    if ends is None:
                        ends = hidden_ends(source)
                    hidden = ends.get(found.start(), -1)
                    inside.clear()
                continue
            if tag in RAW or tag == "head":
                if found[3].endswith("/"):
                    continue
                # The head ends at the latest where the body starts.
                if lowered is None:
                    lowered = source.lower()
                if tag == "head":
                    ends = [e for e in (lowered.find("</head", at), lowered.find("<body", at)) if e >= 0]
                    at = min(ends) if ends else at
                    continue
                end = lowered.find(f"</{tag}", at)
                at = len(source) if end < 0 else end
                continue
            if tag == "a":
                in_link = True
            elif tag == "br":
                held.append(" ")
            elif tag in BLOCKS:
                flush()
                if tag != "hr":
                    if self.tag[stack[-1]] == "p":
                        stack.pop()
                    if tag in CLOSES:
                        closed, until = CLOSES[tag]
                        for depth in range(len(stack) - 1, 0, -1):
                            if self.tag[stack[depth]] in until:
                                break
                            if self.tag[stack[depth]] in closed:
                                del stack[depth:]
                    names = none
                    if found[3]:
                        values = " ".join(a or b or c for a, b, c in NAMED.findall(found[3]))
                        names = frozenset(w.lower() for w in LETTERS.findall(values))
                    stack.append(self.add(stack[-1], tag, names, None))
                    in_link = False
        flush()

    def features(self) -> np.ndarray:
        """One row per node; see the module's description."""
        n = len(self.tag)
        parent, tag = self.parent, self.tag
        chars, linked, stops, words, tags, blocks, longest, items = ([0.0] * n for _ in range(8))
        start, depth, above = [0.0] * n, [0] * n, [(0, 0, 0, 0, 0)] * n
        passed = 0.0
        children: list[list[int]] = [[] for _ in range(n)]
        out = np.zeros((n, FEATURES), np.float32)
        for i in range(n):
            up = parent[i]
            good = bad = 0
            if up >= 0:
                children[up].append(i)
                depth[i] = depth[up] + 1
                positive, negative, good_up, bad_up, nearest = above[up]
                kind = tag[i]
                own_positive = kind in POSITIVE
                own_negative = kind in NEGATIVE and not (kind == "header" and positive)
                good, bad = bool(self.names[i] & GOOD), bool(self.names[i] & BAD)
                if own_negative or bad:
                    nearest = -1
                elif own_positive or good:
                    nearest = 1
                above[i] = (positive or own_positive, negative or own_negative, good_up or good, bad_up or bad, nearest)
                out[i, 12:16] = own_positive, own_negative, good, bad
            start[i] = passed
            text = self.text[i]
            if text is not None:
                size = float(len(text))
                passed += size
                chars[i], linked[i] = size, float(self.linked[i])
                stops[i], words[i] = float(len(STOPS.findall(text))), text.count(" ") + 1.0
                blocks[i], longest[i] = 1.0, size
                out[i, 0] = 1
                out[i, 8] = text[-1] in ".!?"
            else:
                tags[i] = 1.0
                items[i] = float(tag[i] in ("li", "td", "th", "dt"))
        for i in range(n - 1, 0, -1):
            up = parent[i]
            for column in (chars, linked, stops, words, tags, blocks, items):
                column[up] += column[i]
            longest[up] = max(longest[up], longest[i])
        total = max(1.0, passed)
        a = np.array([chars, linked, stops, words, tags, blocks, longest, items, start, depth], np.float32)
        chars_, linked_, stops_, words_, tags_, blocks_, longest_, items_, start_, depth_ = a
        up = np.maximum(np.array(parent), 0)
        out[:, 1] = np.minimum(depth_, 20)
        out[:, 2] = np.log1p(chars_)
        out[:, 3] = np.log1p(tags_)
        out[:, 4] = chars_ / (tags_ + 1)
        out[:, 5] = linked_ / np.maximum(chars_, 1)
        out[:, 6] = stops_ / np.maximum(words_, 1)
        out[:, 7] = chars_ / np.maximum(words_, 1)
        out[:, 9] = chars_ / total
        out[:, 10] = start_ / total
        out[:, 11] = (start_ + chars_) / total
        out[:, 16:21] = np.array(above, np.float32)
        holder = up[:]
        for j, kinds in enumerate((("p", "blockquote", "pre"), HEADINGS, ("li", "dt", "dd"), ("td", "th"))):
            is_kind = np.array([t in kinds for t in tag], np.float32)
            out[:, 21 + j] = np.maximum(is_kind, out[:, 0] * is_kind[holder])
        out[:, 25] = np.log1p(longest_)
        out[:, 26] = chars_ / np.maximum(blocks_, 1)
        out[:, 27] = items_ / np.maximum(tags_, 1)
        out[:, 28] = out[holder, 5]
        out[:, 29] = out[holder, 9]
        for group in children:
            if len(group) > 1:
                g = np.array(group)
                size = chars_[g]
                out[g, 30] = np.log(len(g))
                out[g, 31] = np.arange(len(g)) / (len(g) - 1)
                out[g[1:], 32] = np.log1p(size[:-1])
                out[g[:-1], 33] = np.log1p(size[1:])
                out[g, 34] = size / max(1.0, float(size.mean()))
                out[g, 35] = out[g, 21].mean()
        return out

    def marked(self) -> list[bool] | None:
        """Which text runs the page's own markup calls main; None if it calls none so."""
        state, found = [0] * len(self.tag), False
        for i in range(1, len(self.tag)):
            now = state[self.parent[i]]
            tag = self.tag[i]
            if (tag in NEGATIVE and not (tag == "header" and now == 1)) or self.names[i] & BAD:
                now = -1
            elif tag in POSITIVE and now == 0:
                now = 1
            state[i] = now
            found |= now == 1 and self.text[i] is not None
        return [s == 1 for s in state] if found else None

    def targets(self, kept: list[bool]) -> np.ndarray:
        """Label of every node: whether a kept text run is in its subtree."""
        label = np.array([bool(k) and t is not None for k, t in zip(kept, self.text)])
        for i in range(len(label) - 1, 0, -1):
            if label[i]:
                label[self.parent[i]] = True
        return label

    def decoded(self, odds: np.ndarray) -> str:
        """Kept blocks, from the labelling of greatest likelihood in which ancestors of kept nodes are kept."""
        n = len(self.tag)
        yes = -np.logaddexp(0, -odds)
        no = -np.logaddexp(0, odds)
        gain = (yes - no).tolist()  # over being out
        for i in range(n - 1, 0, -1):
            if gain[i] > 0:
                gain[self.parent[i]] += gain[i]
        keep = [False] * n
        keep[0] = True
        for i in range(1, n):
            keep[i] = keep[self.parent[i]] and gain[i] > 0
        return "\n".join(t for t, k in zip(self.text, keep) if k and t is not None)


def laid_out(main: list[tuple[str, str]], other: list[str], seed: int) -> tuple[str, set[int]]:
    """A page with these main blocks (tag, text) in a drawn layout, and the places of its main texts.

    Other parts take their words from ``other`` and from the main blocks of the
    same page, so that prose alone does not tell them apart.
    """
    draw = random.Random(seed)
    safe = html.escape
    prose = [text for _, text in main if len(text) > 60] or [text for _, text in main]
    words = " ".join(other + prose).split() or ["more"]
    places: set[int] = set()
    parts: list[str] = []
    count = 0

    def put(tag: str, text: str, is_main: bool = False) -> None:
        nonlocal count
        if text.strip():
            parts.append(f"<{tag}>{safe(text)}" + (f"</{tag}>" if draw.random() < 0.9 else ""))
            if is_main:
                places.add(count)
            count += 1

    def some(least: int, most: int) -> str:
        size = draw.randint(least, most)
        at = draw.randrange(max(1, len(words) - size))
        return " ".join(words[at : at + size])

    def menu() -> None:
        nonlocal count
        parts.append("<ul>")
        for _ in range(draw.randint(3, 9)):
            parts.append(f'<li><a href="/x">{safe(some(1, 3))}</a></li>')
            count += 1
        parts.append("</ul>")

    def lines(tag: str, many: int, long: bool) -> None:
        for _ in range(many):
            put(tag, some(15, 60) if long else some(3, 12))

    def part(kind: str) -> None:
        nonlocal count
        tags = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
        names = {
            "menu": "nav menu navigation breadcrumb navbar pagination",
            "header": "header masthead topbar banner",
            "footer": "footer copyright legal contentinfo",
            "sidebar": "sidebar related widget recommended complementary",
            "notice": "cookie-notice consent notice alert gdpr popup disclaimer",
            "ad": "ad ads advert sponsored promo banner",
            "form": "form newsletter subscribe login search signup",
            "comments": "comments comment-list replies discussion respond",
            "share": "share social sharing",
        }[kind].split()
        tag = tags.get(kind, draw.choice(["div", "section"]))
        told = tag in tags.values() and draw.random() < 0.7
        tag = tag if told else draw.choice(["div", "section"])
        name = f' {draw.choice(["class", "id"])}="{draw.choice(names)}"' if not told or draw.random() < 0.5 else ""
        parts.append(f"<{tag}{name}>")
        if kind == "menu":
            menu()
        elif kind == "comments":
            put("h3", some(1, 3))
            for _ in range(draw.randint(1, 4)):
                parts.append(draw.choice(['<div class="comment">', "<li>", "<div>"]))
                put("p", some(8, 60))
                parts.append("</div>")
        elif kind == "sidebar":
            put("h3", some(1, 4))
            menu() if draw.random() < 0.6 else lines("p", draw.randint(1, 3), True)
        elif kind == "form":
            parts.append(f"<label>{safe(some(1, 4))}</label><input><button>{safe(some(1, 2))}</button>")
            count += 1
        elif kind == "share":
            menu()
        elif kind == "header":
            put("p", some(2, 8))
            menu() if draw.random() < 0.5 else None
        else:
            lines(draw.choice(["p", "div"]), draw.randint(1, 2), draw.random() < 0.4)
        parts.append(f"</{tag}>")

    for kind in draw.sample(["header", "menu", "notice", "ad", "form"], draw.randint(1, 4)):
        part(kind)
    tag, name = draw.choice(
        [("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' id="post-body"'), ("div", ' class="entry"'),
         ("div", ""), ("section", ""), ("div", f' class="{"".join(filter(str.isalpha, draw.choice(words)))}"')]
    )
    around = draw.choice(["", "", "<div>", '<div class="wrap">'])
    parts.append(f"{around}<{tag}{name}>")
    for place, (block, text) in enumerate(main):
        put(block, text, True)
        if place and draw.random() < 0.06:
            part(draw.choice(["ad", "share", "sidebar", "form", "notice"]))
    if draw.random() < 0.3:
        part(draw.choice(["comments", "share", "sidebar"]))
    parts.append(f"</{tag}>" + ("</div>" if around else ""))
    for kind in draw.sample(["comments", "sidebar", "footer", "ad", "form", "menu", "notice"], draw.randint(1, 5)):
        part(kind)
    return f"<html><body>{''.join(parts)}</body></html>", places


def examples(source: str, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Node features and labels of a page and of its new layouts, if its markup tells the main text."""
    page = Page(source)
    kept = page.marked()
    if kept is None:
        return
    yield page.features(), page.targets(kept)
    main, other = [], []
    for i, text in enumerate(page.text):
        if text is not None:
            tag = page.tag[page.parent[i]]
            (main.append((tag if tag in HEADINGS or tag == "li" else "p", text)) if kept[i] else other.append(text))
    for k in range(LAYOUTS):
        made, places = laid_out(main, other, seed * LAYOUTS + k)
        new = Page(made)
        runs = [i for i, text in enumerate(new.text) if text is not None]
        chosen = [False] * len(new.text)
        for place, i in enumerate(runs):
            chosen[i] = place in places
        yield new.features(), new.targets(chosen)


def fit(pages: DataFrame, sample: int = SAMPLE) -> boosting.Trees | None:
    """Trees trained on a bounded sample of pages; None if no page's markup tells its main text."""
    chance = min(1.0, sample / max(1, pages.count()))
    drawn = pages.where(F.pmod(F.xxhash64("page_id", F.lit(2)), F.lit(1 << 40)) < int(chance * (1 << 40)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, seed in zip(batch.column("html"), batch.column("seed").to_pylist()):
                for x, y in examples(source.as_py() or "", seed):
                    yield pa.record_batch(
                        [pa.array([seed]), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                        names=["seed", "x", "y"],
                    )

    seed = F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30)).alias("seed")
    made = drawn.select("html", seed).mapInArrow(rows, "seed long, x binary, y binary").collect()
    made.sort(key=lambda row: (row.seed, bytes(row.x)))
    if not made:
        return None
    x = np.concatenate([np.frombuffer(row.x, np.float32).reshape(-1, FEATURES) for row in made])
    y = np.concatenate([np.frombuffer(row.y, bool) for row in made]).astype(float)
    return boosting.fit(x, y)


def texts(sources: list[str], trees: boosting.Trees | None) -> list[str]:
    pages = [Page(source) for source in sources]
    if trees is None:
        # Without a model the markup decides alone: what it names as other parts is out.
        out = []
        for page in pages:
            kept = page.marked() or [t is not None for t in page.text]
            out.append(page.decoded(np.where(page.targets(kept), 1.0, -1.0)))
        return out
    rows = [page.features() for page in pages]
    odds = trees.predict(np.concatenate(rows)) if rows else np.zeros(0)
    ends = np.cumsum([len(r) for r in rows])[:-1] if rows else []
    return [page.decoded(part) for page, part in zip(pages, np.split(odds, ends))]


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of every page, in one pass without a shuffle."""
    trees = fit(pages, sample)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 200):
            found = texts([source or "" for source in part.column("html").to_pylist()], trees)
            yield pa.record_batch(
                [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long"
    )
