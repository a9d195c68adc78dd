"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level elements. A linear classifier
over a block's own features (containing elements, class and id words, link
share, length, sentence ends) gives the cost of calling it content and of
calling it boilerplate; these are the capacities to the two terminals. Blocks
next to each other, and blocks that follow each other under one parent, are
tied by smoothness edges that are weaker the further apart they stand in the
tree. A boilerplate word in a class or id, or a form, weighs less the more of
the page's prose it surrounds. The minimum cut is the labelling of least total cost.

Blocks whose own preference outweighs all their edges are on that side in every
minimum cut; max-flow runs over what remains.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from itertools import takewhile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of HTML by their role.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol option p pre search section select summary table tbody td tfoot "
    "th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
#: Their content is no text of the page.
SILENT = frozenset(
    "audio canvas datalist head iframe map math noembed noframes noscript object script style "
    "svg template textarea title video".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: An opening tag of the key closes an open element of the value.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: An open p ends where one of these begins.
ENDS_P = BLOCK - {"body", "button", "html", "option", "select", "td", "th", "tr"}
SCOPE = frozenset("ul ol dl table select body html".split())

BOILERPLATE_TAGS = frozenset(
    "nav footer header aside form menu button select fieldset dialog search label".split()
)
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements banner banners breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies copyright disqus dropdown footer gdpr "
    "header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "pagination pager popup promo promoted promotion recommended related reply replies respond "
    "search share sharing sidebar signup skip skyscraper social sponsor sponsored subscribe "
    "toolbar topbar widget widgets".split()
)
#: Of these, what names what readers wrote.
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
CONTENT_WORDS = frozenset(
    "article articlebody body content entry entrycontent main maincontent post postbody "
    "postcontent story text".split()
)
BOILERPLATE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
#: A name and its value, one after the other, so that nothing is looked for inside a value.
ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
NAME_WORD = re.compile(r"[a-z]+")
#: What follows one of these in a name is a state of the element, not what it is.
STATE_WORDS = frozenset("has no not with without".split())
SENTENCE = re.compile(r"[.!?…](?:[\"'”’»)\]]*)(?:\s|$)")


class Element:
    __slots__ = (
        "tag", "parent", "depth", "home", "open_p", "silent", "link", "good", "bad", "soft", "core",
        "talk",
    )

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.home = self if tag in BLOCK or not parent else parent.home
        scope = tag in SCOPE or not parent
        self.open_p = self if tag == "p" else None if scope else parent.open_p
        self.silent = tag in SILENT or bool(parent and parent.silent)
        self.link = tag == "a" or bool(parent and parent.link)
        self.good = bool(parent and parent.good)
        self.bad = bool(parent and parent.bad)
        #: The innermost element around it that only its name or a form marks, and the
        #: innermost article or main.
        self.soft = parent.soft if parent else None
        self.core = parent.core if parent else None
        words: set[str] = set()
        values: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
            values.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
        if values.get("hidden", "until-found") != "until-found":
            self.silent = True
        role = values.get("role", "").strip()
        self.bad = self.bad or role in BOILERPLATE_ROLES
        words |= {"main"} if role in ("main", "article") else set()
        for name in ("class", "id") if tag not in ("body", "html") else ():
            for token in values.get(name, "").split():
                named = NAME_WORD.findall(token)
                words.update(takewhile(lambda w: w not in STATE_WORDS, named))
        # A page's header is boilerplate, the header of an article is its heading.
        named_bad = bool(words & BOILERPLATE_WORDS)
        if tag in BOILERPLATE_TAGS - {"form"} and not (tag == "header" and self.good):
            self.bad = True
        if tag == "form" or named_bad:
            self.soft = self
        #: Whether its own name is one of readers' comments.
        self.talk = bool(words & COMMENT_WORDS)
        if tag in CONTENT_TAGS or (words & CONTENT_WORDS and not named_bad):
            self.good = True
        if tag in CONTENT_TAGS and not named_bad:
            self.core = self


class Block:
    __slots__ = ("element", "parts", "link_chars", "chars")

    def __init__(self, element: Element):
        self.element, self.parts, self.link_chars, self.chars = element, [], 0, 0

    def add(self, text: str, element: Element) -> None:
        self.parts.append(text)
        n = len(text.strip())
        self.chars += n
        self.link_chars += n * element.link

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def blocks_of(page: str) -> list[tuple[Block, str]]:
    """The page's blocks of text in order, each with its text."""
    at = root = Element("html", None, "")
    block, out = Block(root), []
    open_: Counter = Counter()

    def flush(e: Element) -> None:
        nonlocal block
        if block.chars:
            out.append((block, block.text()))
        block = Block(e.home)

    def close(e: Element) -> None:
        """Close ``e`` and all that is open within it."""
        nonlocal at
        while at is not e.parent:
            open_[at.tag] -= 1
            at = at.parent

    def nearest(tags: set[str] | frozenset, until: frozenset) -> Element | None:
        """The nearest open element of ``tags``, unless ``until`` stands before it."""
        if not any(open_[tag] for tag in tags):
            return None
        e = at
        while e.parent and e.tag not in tags:
            if e.tag in until:
                return None
            e = e.parent
        return e if e.parent else None

    position, end = 0, len(page)
    while position < end:
        m = TAG.search(page, position)
        stop = m.start() if m else end
        if stop > position and not at.silent:
            block.add(entities.unescape(page[position:stop]), at)
        if not m:
            break
        position = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name in VOID:
                block.parts.append(" " if name == "br" else "")
                continue
            if found := nearest({name}, frozenset() if name in BLOCK else BLOCK):
                close(found)
            if name in BLOCK:
                flush(at)
            continue
        attributes = m[3] or m[6] or ""
        if name in VOID:
            if name == "hr":
                flush(at)
            elif name == "br":
                block.parts.append(" ")
            continue
        if name in ENDS_P and at.open_p:
            close(at.open_p)
        if name in CLOSES and (found := nearest(CLOSES[name], SCOPE)):
            close(found)
        if name == "body" and (found := nearest({"head"}, frozenset())):
            close(found)
        if name in RAW:
            tail = re.compile(f"</{name}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, position)
            if name in BLOCK:
                flush(at)
            position = tail.end() if tail else end
            continue
        at = Element(name, at, attributes)
        open_[name] += 1
        if name in BLOCK:
            flush(at)
    flush(at)
    return [(b, text) for b, text in out if text]


#: Classifier weights, for content. The sum's sign is the preferred label, its size the cost.
WEIGHTS = {
    "bias": 1.0, "good": 2.5, "unmarked": -2.5, "bad": -12.0, "heading": 1.0, "item": -0.5,
    "per_ten_words": 0.5, "sentence": 1.0, "links": -4.0,
}
#: Smoothness between neighbours in the page and under one parent.
ADJACENT, SIBLING = 0.5, 0.25
UNIT = 1000


#: Prose is a block of so many words, with a sentence's end and few links.
PROSE_WORDS, PROSE_LINKS = 20, 0.3
#: A name or a form counts less if it marks so many words of prose, and counts in full if the
#: prose that nothing marks is at least this share of both.
RELIEF_WORDS, RELIEF_SHARE = 50, 0.25


def outer_mark(e: Element) -> Element | None:
    """The next element around ``e`` that only its name or a form marks."""
    return e.parent.soft if e.parent else None


def soft_marks(found: list[tuple[Block, str]]) -> list[Element]:
    """The elements around blocks that only their names or a form mark, outer ones first."""
    seen: set[int] = set()
    out = []
    for b, _ in found:
        inward, e = [], b.element.soft
        while e is not None and id(e) not in seen:
            seen.add(id(e))
            inward.append(e)
            e = outer_mark(e)
        out += reversed(inward)
    return out


def mark_weights(found: list[tuple[Block, str]]) -> dict[int, float]:
    """By id of a softly marked element, the share of the weight that its text has to bear.

    A mark around most of a page's prose names a wrapper, not boilerplate. The one
    with the most prose of its own is taken first, that in an article or main
    counting more and that within further marks less; what it frees is what the
    next is compared with. A mark beside an article or main that says something is
    never a wrapper, and one that names comments only if there is a main in it.
    """
    clean, told, own, bonus = 0, False, Counter(), Counter()
    main: set[int] = set()
    for b, text in found:
        e, words = b.element, text.count(" ") + 1
        if e.bad:
            continue
        ends = bool(SENTENCE.search(text))
        inside = bool(e.soft and e.core and e.core.depth > e.soft.depth)
        if inside and e.core.tag == "main":
            main.add(id(e.soft))
        told = told or bool(ends and e.core and not e.soft)
        if words < PROSE_WORDS or b.link_chars > PROSE_LINKS * b.chars or not ends:
            continue
        if not e.soft:
            clean += words
            continue
        own[id(e.soft)] += words
        bonus[id(e.soft)] += 2 * words * inside
    order = soft_marks(found)
    for e in reversed(order):  # a main within further marks is in the outer ones too
        if id(e) in main and (around := outer_mark(e)):
            main.add(id(around))
    kept: dict[int, float] = {}
    for _ in order:
        full: dict[int, int] = {}
        best, most = None, 0.0
        for e in order:
            around = outer_mark(e)
            full[id(e)] = (full[id(around)] if around else 0) + (kept.get(id(e), 1.0) == 1.0)
            # Only what has much more prose than what is free can be freed.
            if own[id(e)] < RELIEF_WORDS or own[id(e)] * RELIEF_SHARE <= clean * (1 - RELIEF_SHARE):
                continue
            if (told and not e.core) or (e.talk and id(e) not in main) or id(e) in kept:
                continue
            claim = (own[id(e)] + bonus[id(e)]) / 8 ** min(full[id(e)], 100)
            if claim > most:
                best, most = e, claim
        if best is None:
            break
        share = clean / (clean + own[id(best)])
        told = told or bonus[id(best)] > 0
        clean += round(own[id(best)] * (1 - share / RELIEF_SHARE))
        e = best
        while e is not None:
            kept[id(e)] = min(kept.get(id(e), 1.0), share / RELIEF_SHARE)
            e = outer_mark(e)
    weights: dict[int, float] = {}
    for e in order:
        around = outer_mark(e)
        weights[id(e)] = max(kept.get(id(e), 1.0), weights[id(around)] if around else 0.0)
    return weights


def preference(block: Block, text: str, marked: bool, weights: dict[int, float]) -> float:
    """How much rather the block is content than boilerplate.

    ``marked``: some part of the page is marked as its content. ``weights``: of the
    soft marks around it, by the innermost.
    """
    e, w = block.element, WEIGHTS
    words = text.count(" ") + 1
    score = w["bias"] + w["per_ten_words"] * min(words, 60) / 10
    bad = weights[id(e.soft)] if e.soft else 0.0
    score += w["bad"] * max(e.bad, bad) + (w["good"] if e.good else w["unmarked"] * marked)
    score += w["heading"] * (e.tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
    score += w["item"] * (e.tag in ("li", "option", "td", "th"))
    score += w["sentence"] * bool(SENTENCE.search(text))
    return score + w["links"] * (block.link_chars / block.chars)


def tree_distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(prefer: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of least cost: |prefer[i]| against its sign, w for an edge that is cut.

    Ties go to False.
    """
    n = len(prefer)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    label: list[bool | None] = [None] * n
    pull = list(prefer)
    open_ = [sum(d.values()) for d in near]
    ready = [i for i in range(n) if abs(pull[i]) >= open_[i]]
    while ready:  # a settled block's edges become part of its neighbours' preference
        i = ready.pop()
        if label[i] is not None:
            continue
        label[i] = pull[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                pull[j] += w if label[i] else -w
                open_[j] -= w
                if abs(pull[j]) >= open_[j]:
                    ready.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _max_flow(rest, pull, near), strict=True):
            label[i] = side
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], pull: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut (shortest augmenting paths)."""
    source, sink = -1, -2
    left: dict[int, dict[int, int]] = {source: {}, sink: {}}
    inside = set(nodes)
    for i in nodes:
        left[i] = {j: w for j, w in near[i].items() if j in inside}
    for i in nodes:
        a, b = (source, i) if pull[i] > 0 else (i, sink)
        left[a][b] = abs(pull[i])
        left[b].setdefault(a, 0)

    def levels() -> dict[int, int]:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in left[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        return level

    while sink in (level := levels()):
        todo = {u: list(vs) for u, vs in left.items()}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                steps = list(zip(path[:-1], path[1:], strict=True))
                flow = min(left[a][b] for a, b in steps)
                for a, b in steps:
                    left[a][b] -= flow
                    left[b][a] = left[b].get(a, 0) + flow
                cut = next(k for k, (a, b) in enumerate(steps) if left[a][b] == 0)
                path = path[: cut + 1]
                continue
            while todo[u] and not (
                left[u][todo[u][-1]] > 0 and level.get(todo[u][-1]) == level[u] + 1
            ):
                todo[u].pop()
            if todo[u]:
                path.append(todo[u][-1])
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()
    return [i in level for i in nodes]


def main_text(page: str) -> str:
    """The blocks labelled content, two line feeds between them; empty if there are none."""
    found = blocks_of(page)
    weights = mark_weights(found)
    held = (b.element for b, _ in found)
    marked = any(e.good and not e.bad and (not e.soft or weights[id(e.soft)] < 1) for e in held)
    prefer = [round(UNIT * preference(b, text, marked, weights)) for b, text in found]
    edges: list[tuple[int, int, int]] = []
    last: dict[int, int] = {}
    for i, (b, _) in enumerate(found):
        if i:
            apart = tree_distance(found[i - 1][0].element, b.element)
            edges.append((i - 1, i, round(UNIT * ADJACENT / max(1, apart))))
        parent = id(b.element.parent)
        if parent in last:
            edges.append((last[parent], i, round(UNIT * SIBLING)))
        last[parent] = i
    labels = min_cut(prefer, edges)
    return "\n\n".join(text for (_, text), content in zip(found, labels, strict=True) if content)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null or empty page, and one without content, has an empty text. Rows are
    taken one by one, so repeated rows give repeated results; null ids and urls
    stay null.
    """

    def texts(batches):
        for pdf in batches:
            out = [main_text(h) if h else "" for h in pdf["html"]]
            yield pd.DataFrame(
                {
                    "page_id": pdf["page_id"].astype("Int64"),
                    "url": pdf["url"],
                    "text": out,
                    "n_chars": [len(t) for t in out],
                }
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
    )
    return rows.mapInPandas(texts, "page_id long, url string, text string, n_chars long")
