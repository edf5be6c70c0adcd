"""Main text of web pages: boosted trees rate DOM nodes, a pass over the tree settles them without contradictions."""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import per_text, pick

#: Pages whose blocks the training layouts are filled with at most: a sample by id hash.
SAMPLED_PAGES = 300
LAYOUTS = 900

# --- fixed values: HTML element classes and common attribute words ----------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template iframe object svg math head title select option textarea button canvas "
             "audio video datalist input".split())
RAW = set("script style textarea title noscript iframe".split())
#: What leaves a head open; anything else ends it.
IN_HEAD = set("base link meta title noscript style script template".split())
#: Elements of SVG and MathML that hold HTML again.
HOSTS = {"foreignobject", "annotation-xml", "desc"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var wbr br img".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
               "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
TOKENS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc tabs tab links pager pagination skip toolbar sitemap",
    "frame": "header masthead head top topbar footer foot bottom copyright legal colophon site logo brand",
    "side": "sidebar side aside rail widget widgets related recommended more popular trending tags archive",
    "advert": "ad ads adv advert advertisement adbox banner promo promotion sponsor sponsored commercial affiliate outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay message warning paywall disclaimer",
    "comment": "comment comments reply replies respond discussion disqus feedback review reviews reader readers thread",
    "form": "form search login signup signin subscribe subscription newsletter register input contact poll survey",
    "share": "share sharing social follow facebook twitter tools print email author byline meta date",
    "content": "article content main post entry story body text page page-content prose column single blog news",
}
LANDMARKS = ("article", "main", "nav", "header", "footer", "aside", "form", "section", "div", "p", "li", "ul", "table",
             "blockquote", "pre", "body", "dl", "td")
# -----------------------------------------------------------------------------------------------

GROUP = {word: i for i, words in enumerate(TOKENS.values()) for word in words.split()}
HASHED = 24
NAME = re.compile(r"[a-zA-Z][^\t\n\f\r />]*")
ATTRIBUTE = re.compile(r"[\t\n\f\r /]*(=?[^\t\n\f\r />=]*)")
EQUALS = re.compile(r"[\t\n\f\r ]*=[\t\n\f\r ]*")
UNQUOTED = re.compile(r"[^\t\n\f\r >]*")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\t\n\f\r />])", re.I) for tag in RAW}
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(slots=True)
class Node:
    tag: str
    attributes: dict
    parent: int
    depth: int
    #: Children's indices and pieces of own text, in page order.
    inside: list = field(default_factory=list)


def tokens(page: str):
    """(text, tag, end, attributes, own_end) in page order: text, with tag None, or a start or end tag.

    One pass by the states of an HTML tokenizer: quotes count in attribute values only, a comment ends at ``-->``,
    ``--!>`` or at once, what scripts and the like hold is no markup, and a tag that the page ends in is none. Apart from
    browsers, a quote that nothing closes ends at the next ``>``, so that the rest of the page is not lost."""
    at, size, last = 0, len(page), {q: page.rfind(q) for q in "\"'"}
    while at < size:
        low = page.find("<", at)
        if low < 0:
            yield page[at:], None, False, {}, False
            return
        if low > at:
            yield page[at:low], None, False, {}, False
        following = page[low + 1:low + 2]
        end = following == "/"
        name = NAME.match(page, low + 1 + end)
        if name is None:
            if page.startswith("<!--", low):
                if page.startswith((">", "->"), low + 4):
                    at = page.find(">", low + 4) + 1
                else:
                    close = COMMENT_END.search(page, low + 4)
                    at = close.end() if close else size
            elif following in ("!", "?") or end and low + 2 < size:
                at = page.find(">", low + 1) + 1 or size
            else:
                yield "<", None, False, {}, False
                at = low + 1
            continue
        attributes, own_end, at = {}, False, name.end()
        while at < size and page[at] != ">":
            key = ATTRIBUTE.match(page, at)
            at = key.end()
            own_end = page[at - 1] == "/"
            if not key[1]:
                continue  # at the end of the tag or of the page
            equals, value = EQUALS.match(page, at), ""
            if equals:
                at = equals.end()
                quote = page[at:at + 1]
                if quote in last and quote:
                    close = page.find(quote, at + 1) if last[quote] > at else page.find(">", at)
                    close = size if close < 0 else close
                    value, at = page[at + 1:close], close + (last[quote] > at)
                else:
                    bare = UNQUOTED.match(page, at)
                    value, at = bare[0], bare.end()
            attributes.setdefault(key[1].lower(), value)
        if at >= size:
            return  # the page ends in the tag
        at += 1
        tag = name[0].lower()
        yield "", tag, end, attributes, own_end
        if not end and tag in RAW and not own_end:
            close = RAW_END[tag].search(page, at)
            at = page.find(">", close.end()) + 1 or size if close else size


def parse(page: str) -> list[Node]:
    """Block-level elements in page order; inline elements dissolve into their block, unseen ones vanish with all that is
    in them.

    Text in links is kept apart as ('a', text)."""
    nodes = [Node("html", {}, -1, 0)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements: tag, block it belongs to
    links = 0
    hidden = None  # where in the stack the outermost unseen element is
    for piece, tag, end, attributes, own_end in tokens(page):
        if tag is None:
            if hidden is not None:
                if stack[hidden][0] != "head" or len(stack) > hidden + 1 or not piece.strip():
                    continue
                del stack[hidden:]
                hidden = None
            text = entities.unescape(piece) if "&" in piece else piece
            nodes[stack[-1][1]].inside.append(("a", text) if links else text)
            continue
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    links -= sum(t == "a" for t, _ in stack[i:hidden])
                    del stack[i:]
                    if hidden is not None and i <= hidden:
                        hidden = None
                    break
                if stack[i][0] == "template" or stack[i][0] == "button" and tag == "p":
                    break  # what is open around these does not end in them
            else:
                if tag in ("p", "br") and hidden is None:
                    nodes[stack[-1][1]].inside.append(" ")
            continue
        if hidden is not None:
            root = stack[hidden][0]
            if (root == "head" and len(stack) == hidden + 1 and tag not in IN_HEAD or root == tag and tag in ("option", "button", "select")
                    or root in ("svg", "math") and tag in CLOSES_P and not any(t in HOSTS for t, _ in stack[hidden:])):
                del stack[hidden:]  # ends without an end tag
                hidden = None
        if tag in RAW:
            continue
        if tag in VOID:
            if hidden is None:
                nodes[stack[-1][1]].inside.append(" ")
            continue
        if hidden is not None or tag in UNSEEN:
            if hidden is None:
                nodes[stack[-1][1]].inside.append(" ")
                hidden = len(stack)
            stack.append((tag, stack[-1][1]))
            if own_end and any(t in ("svg", "math") for t, _ in stack[hidden:]):
                stack.pop()  # only these have elements that end where they begin
                hidden = hidden if len(stack) > hidden else None
            continue
        if tag in ("html", "body") and len(stack) == 1 and tag == "html":
            nodes[0].attributes = attributes
            continue
        if tag in CLOSES_P:
            _close(stack, {"p"}, {"article", "section", "div", "td", "li", "table"})
        elif tag in CLOSED_BY:
            _close(stack, CLOSED_BY[tag], SCOPES.get(tag, set()))
        links = sum(t == "a" for t, _ in stack) if links else 0
        owner = stack[-1][1]
        if tag in INLINE:
            links += tag == "a"
            stack.append((tag, owner))
        else:
            nodes.append(Node(tag, attributes, owner, nodes[owner].depth + 1))
            nodes[owner].inside.append(len(nodes) - 1)
            stack.append((tag, len(nodes) - 1))
    return nodes


def _close(stack: list, tags: set, scope: set) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in tags:
            del stack[i:]
            return
        if stack[i][0] in scope:
            return


def block_texts(node: Node) -> list[tuple[int | None, str]]:
    """(child, '') or (None, text) in page order; white space in a text is one space."""
    out, own = [], []
    for x in [*node.inside, None]:
        if isinstance(x, int) or x is None:
            if own and (text := " ".join("".join(own).split())):
                out.append((None, text))
            own = []
            if x is not None:
                out.append((x, ""))
        else:
            own.append(x if isinstance(x, str) else x[1])
    return out


NUMBERS = ("depth", "text", "own_text", "links", "nodes", "density", "words", "signs", "capital", "position", "siblings", "same",
           "next_to", "of_parent", "parent_links", "of_page", "after", "hidden")
WIDTH = len(NUMBERS) + 3 * len(TOKENS) + 2 * len(LANDMARKS) + HASHED


def described(nodes: list[Node]) -> np.ndarray:
    """A row per node: subtree and sibling measures, attribute words of the node, its parent and all above, tags."""
    n = len(nodes)
    own, linked, words, signs = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    capital = np.zeros(n)
    tag, group, above = np.full(n, -1), np.zeros((n, len(TOKENS))), np.zeros((n, len(TOKENS)))
    hashed, hidden = np.zeros((n, HASHED)), np.zeros(n)
    within = np.zeros((n, len(LANDMARKS)))
    parent = np.array([x.parent for x in nodes])
    depth = np.array([x.depth for x in nodes])
    position, siblings, same = np.zeros(n), np.ones(n), np.ones(n)
    for i, x in enumerate(nodes):
        children = []
        for y in x.inside:
            if isinstance(y, int):
                children.append(y)
                continue
            text = y if isinstance(y, str) else y[1]
            size = len(text.strip())
            if size:
                own[i] += size
                linked[i] += 0 if isinstance(y, str) else size
                words[i] += text.count(" ") + 1
                signs[i] += text.count(".") + text.count(",")
                capital[i] += text[:1].isupper()
        for k, y in enumerate(children):
            position[y], siblings[y] = k, len(children)
        if len(children) > 1:
            kinds = Counter(nodes[y].tag for y in children)
            for y in children:
                same[y] = kinds[nodes[y].tag]
        if x.tag in LANDMARKS:
            tag[i] = LANDMARKS.index(x.tag)
        if x.attributes:
            value = " ".join(x.attributes.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label"))
            for word in WORDS.findall(value):
                word = word.lower()
                g = GROUP.get(word, GROUP.get(word.rstrip("s")))
                if g is not None:
                    group[i, g] = 1
                hashed[i, sum(word.encode()) * 31 % HASHED] = 1
            hidden[i] = "hidden" in x.attributes or "none" in x.attributes.get("style", "").replace(" ", "").partition("display:")[2][:4]
        if x.parent >= 0:
            above[i] = np.maximum(above[x.parent], group[x.parent])
            within[i] = within[x.parent]
            if tag[x.parent] >= 0:
                within[i, tag[x.parent]] = 1
    text, links, inside = own.copy(), linked.copy(), np.ones(n)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        text[p] += text[i]
        links[p] += links[i]
        inside[p] += inside[i]
    share = links / np.maximum(text, 1)
    up = np.maximum(parent, 0)
    tags = np.zeros((n, len(LANDMARKS)))
    tags[np.arange(n)[tag >= 0], tag[tag >= 0]] = 1
    before = np.concatenate([[0], np.cumsum(own)[:-1]]) / max(own.sum(), 1)
    numbers = np.stack([depth, np.log1p(text), np.log1p(own), share, np.log1p(inside), np.log1p(text / inside), np.log1p(words),
                        signs / np.maximum(words, 1), capital, position, siblings, same, np.log1p(text[up] - text) / np.maximum(siblings, 1),
                        text / np.maximum(text[up], 1), share[up], text / max(text[0], 1), before, hidden], 1)
    return np.hstack([numbers, group, group[up], above, tags, within, hashed])


class Boosted:
    """Gradient-boosted trees for a yes or no, of one depth, split at quantiles."""

    def __init__(self, depth: int = 4, trees: int = 80, rate: float = 0.25, bins: int = 24) -> None:
        self.depth, self.trees, self.rate, self.bins = depth, trees, rate, bins
        self.feature, self.above, self.leaf, self.start = [], [], [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        n, width = x.shape
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        binned = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)]  # bin b: edge b-1 < value <= edge b
        total = np.full(n, self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-total))
            slope, bend = y - p, p * (1 - p)
            feature, above = np.zeros(2 ** self.depth - 1, int), np.full(2 ** self.depth - 1, np.inf)
            at = np.zeros(n, int)
            for level in range(self.depth):
                first, count = 2 ** level - 1, 2 ** level
                local, best = at - first, np.full(count, 1e-6)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = len(e) + 1
                    key = local * b + binned[f]
                    g = np.bincount(key, slope, count * b).reshape(count, b).cumsum(1)
                    h = np.bincount(key, bend, count * b).reshape(count, b).cumsum(1)
                    all_g, all_h = g[:, -1:], h[:, -1:]
                    gain = g ** 2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g ** 2 / (all_h + 1)
                    gain = gain[:, :-1]
                    cut = gain.argmax(1)
                    value = gain[np.arange(count), cut]
                    better = value > best
                    best = np.where(better, value, best)
                    feature[first:first + count][better] = f
                    above[first:first + count][better] = e[cut[better]]
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] > above[at])
            leaf = at - (2 ** self.depth - 1)
            g, h = (np.bincount(leaf, v, 2 ** self.depth) for v in (slope, bend))
            value = self.rate * g / (h + 1)
            total = total + value[leaf]
            self.feature.append(feature)
            self.above.append(above)
            self.leaf.append(value)
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, every = np.full(len(x), self.start), np.arange(len(x))
        for feature, above, leaf in zip(self.feature, self.above, self.leaf):
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[every, feature[at]] > above[at])
            out += leaf[at - (2 ** self.depth - 1)]
        return out


def rated(pages: list[list[Node]], trees: Boosted) -> list[np.ndarray]:
    """Log odds of each page's nodes."""
    odds = trees.log_odds(np.vstack([described(nodes) for nodes in pages]))
    return np.split(odds, np.cumsum([len(nodes) for nodes in pages])[:-1])


def settled(nodes: list[Node], log_odds: np.ndarray) -> np.ndarray:
    """Which nodes are main text, at the best sum of log odds such that below a dropped node all is dropped."""
    gain = np.clip(log_odds, -8, 8).tolist()
    best = gain[:]
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[nodes[i].parent] += best[i]
    kept = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        kept[i] = best[i] > 0 and (x.parent < 0 or kept[x.parent])
    return kept


def text_of(nodes: list[Node], kept: np.ndarray) -> str:
    """Texts of the kept nodes in page order, a line each."""
    out, open_ = [], [iter(block_texts(nodes[0]))] if kept[0] else []
    while open_:
        for child, text in open_[-1]:
            if child is None:
                out.append(text)
            elif kept[child]:
                open_.append(iter(block_texts(nodes[child])))
                break
        else:
            open_.pop()
    return "\n".join(out)


# --- training pages ----------------------------------------------------------------------------

class Layouts:
    """Pages built from blocks of the sampled ones, in many layouts, with the truth marked in ``gold``."""

    def __init__(self, paragraphs: list[str], snippets: list[str], seed: int = 5) -> None:
        self.rng = random.Random(seed)
        self.paragraphs, self.snippets = paragraphs or ["Text, and more text."], snippets or ["Home"]

    def el(self, tag: str, inside: str, gold: int | None = None, words: str = "", **more: str) -> str:
        marks = {**({self.rng.choice(["class", "class", "id"]): words} if words else {}), **more}
        if gold is not None:
            marks["gold"] = str(gold)
        return f"<{tag}{''.join(f' {k}="{entities.escape(v)}"' for k, v in marks.items())}>{inside}</{tag}>"

    def words(self, *groups: str) -> str:
        """A class name around a word of the groups, or none."""
        if self.rng.random() < 0.35:
            return ""
        word = self.rng.choice(TOKENS[self.rng.choice(groups)].split())
        more = self.rng.choice(["", "", "", "-box", "-area", "-wrap", "_1", " clearfix", "-list", " block", "-section"])
        return word + more

    def snippet(self) -> str:
        return entities.escape(self.rng.choice(self.snippets))

    def paragraph(self) -> str:
        text = entities.escape(self.rng.choice(self.paragraphs if self.rng.random() < 0.85 else self.snippets))
        if self.rng.random() < 0.15:
            words = text.split()
            k = self.rng.randrange(len(words))
            words[k] = f"<a href='/x'>{words[k]}</a>" if self.rng.random() < 0.5 else f"<b>{words[k]}</b>"
            text = " ".join(words)
        return text

    def menu(self) -> str:
        items = "".join(self.el("li", f"<a href='/{i}'>{self.snippet()}</a>", 0) for i in range(self.rng.randint(2, 9)))
        tag = self.rng.choice(["nav", "nav", "div", "div"])
        return self.el(tag, self.el("ul", items, 0), 0, self.words("menu") if tag == "div" else self.rng.choice(["", "menu"]))

    def plain(self, group: str, tags: list[str], long: float) -> str:
        tag = self.rng.choice(tags)
        parts = []
        for _ in range(self.rng.randint(1, 4)):
            body = self.paragraph() if self.rng.random() < long else self.snippet()
            if self.rng.random() < 0.3:
                body = f"<a href='#'>{body}</a>"
            parts.append(self.el(self.rng.choice(["p", "div", "p", "li"]), body, 0) if self.rng.random() < 0.7 else body)
        name = self.words(group)
        if tag in ("div", "section", "p", "ul"):
            name = name or self.rng.choice(TOKENS[group].split())
        if tag == "p":
            parts = [self.snippet()]
        return self.el(tag, "".join(parts), 0, name)

    def form(self) -> str:
        """Labels, fields and words of advice, loose or in blocks, the form itself often without a telling name."""
        parts = [self.snippet() if self.rng.random() < 0.7 else self.paragraph()]
        for _ in range(self.rng.randint(0, 3)):
            parts.append(self.rng.choice(["<input type=text>", "<input>", "<br>", self.el("label", self.snippet()), self.el("p", self.snippet(), 0),
                                          "<button>x</button>"]))
        return self.el("form", "".join(parts), 0, self.words("form") if self.rng.random() < 0.5 else "")

    def junk(self) -> str:
        kind = self.rng.choice(["advert", "notice", "comment", "form", "form", "side", "share", "menu", "frame"])
        return {"advert": lambda: self.plain("advert", ["div", "aside", "section", "p"], 0.6),
                "notice": lambda: self.plain("notice", ["div", "section", "aside"], 0.6),
                "comment": lambda: self.plain("comment", ["div", "section", "ul", "article"], 0.8),
                "form": self.form,
                "side": lambda: self.plain("side", ["aside", "div", "section"], 0.5),
                "share": lambda: self.plain("share", ["div", "ul"], 0.1), "menu": self.menu,
                "frame": lambda: self.plain("frame", ["footer", "header"], 0.4)}[kind]()

    def page(self) -> str:
        rng, blocks = self.rng, []
        title = self.el("h1", self.snippet(), 1) if rng.random() < 0.85 else ""
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.8:
                blocks.append(self.el("p", self.paragraph(), 1))
            elif kind < 0.86:
                blocks.append(self.el(rng.choice(["h2", "h3"]), self.snippet(), 1))
            elif kind < 0.92:
                tag = rng.choice(["ul", "ol"])
                blocks.append(self.el(tag, "".join(self.el("li", self.paragraph() if rng.random() < 0.4 else self.snippet(), 1) for _ in range(rng.randint(1, 5))), 1))
            elif kind < 0.95:
                blocks.append(self.el("blockquote", self.el("p", self.paragraph(), 1), 1))
            elif kind < 0.97:
                blocks.append(self.el("pre", self.paragraph(), 1))
            else:
                blocks.append(self.el("table", "".join(self.el("tr", self.el("td", self.snippet(), 1) * 2, 1) for _ in range(3)), 1))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            blocks.insert(rng.randrange(len(blocks) + 1), self.junk())
        if rng.random() < 0.2:
            blocks.append(self.plain("comment", ["div", "section"], 0.8))
        inside = title + "".join(blocks)
        tag = rng.choice(["article", "article", "article", "main", "div", "div", "section"])
        if tag in ("div", "section"):
            body = self.el(tag, inside, 1, rng.choice(TOKENS["content"].split()) if rng.random() < 0.85 else "")
        else:
            body = self.el(tag, inside, 1, self.words("content") if rng.random() < 0.3 else "")
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            body = self.el(rng.choice(["div", "main", "div", "section"]), (self.junk() if rng.random() < 0.4 else "") + body
                           + (self.junk() if rng.random() < 0.4 else ""), 1, rng.choice(["", "wrap", "container", "row", "content", "page", "main"]))
        top = [self.junk() for _ in range(rng.randint(0, 2))]
        end = [self.junk() for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.6:
            top.insert(0, self.menu())
        if rng.random() < 0.4:
            top.insert(0, self.plain("frame", ["header"], 0.2))
        if rng.random() < 0.6:
            end.append(self.plain("frame", ["footer", "footer", "div"], 0.4))
        return f"<html><head><title>x</title></head><body>{''.join(top)}{body}{''.join(end)}</body></html>"


def marked_up(nodes: list[Node]) -> np.ndarray | None:
    """Truth from the page's own markup, where it has just one article (or else one main): that element, what is
    above it, and what is in it outside menus, asides, forms, footers and the like."""
    for tag in ("article", "main"):
        found = [i for i, x in enumerate(nodes) if x.tag == tag]
        if found:
            break
    if len(found) != 1:
        return None
    yes, at = np.zeros(len(nodes), bool), found[0]
    for i in range(at + 1, len(nodes)):
        x = nodes[i]
        words = {w.lower() for w in WORDS.findall(f"{x.attributes.get('class', '')} {x.attributes.get('id', '')}")}
        yes[i] = (yes[x.parent] or x.parent == at) and x.tag not in ("nav", "aside", "form", "footer", "header") and not any(
            w in GROUP and list(TOKENS)[GROUP[w]] not in ("content", "frame") for w in words)
    while at >= 0:
        yes[at] = True
        at = nodes[at].parent
    return yes


def fit_pages(pages: list[str], layouts: int = LAYOUTS) -> Boosted:
    """Trees from ``pages`` as far as their markup tells the truth, and from layouts that hold their blocks, where a
    node without a mark is what its children are."""
    paragraphs, snippets, rows, truth = [], [], [], []
    for page in pages:
        nodes = parse(page)
        yes = marked_up(nodes)
        if yes is not None:
            rows.append(described(nodes))
            truth.append(yes)
        for node in nodes:
            for child, text in block_texts(node):
                if child is None:
                    (paragraphs if text.count(" ") >= 7 else snippets).append(text)
    made = Layouts(sorted(set(paragraphs)), sorted(set(snippets)))
    for _ in range(layouts):
        nodes = parse(made.page())
        gold = [x.attributes.get("gold") for x in nodes]
        yes = np.array([g == "1" for g in gold])
        for i in range(len(nodes) - 1, 0, -1):
            if gold[nodes[i].parent] is None and yes[i]:
                yes[nodes[i].parent] = True
        rows.append(described(nodes))
        truth.append(yes)
    return Boosted().fit(np.vstack(rows), np.concatenate(truth).astype(float))


def fit(pages: DataFrame, limit: int = SAMPLED_PAGES, id_col: str = "page_id", html_col: str = "html") -> Boosted:
    """Trees for a table of pages, from a sample of about ``limit`` of them, chosen by the hash of id and page.

    Null pages are left out, equal pages count once, and ids may be null or repeated: the same table gives the same trees
    whatever the order of its rows. An empty table gives the trees of built layouts alone."""
    held = pick(pages, id=id_col, html=html_col).where("html is not null")
    n, scale = held.count(), 1 << 40
    if n > limit:
        held = held.where(F.pmod(F.xxhash64("id", "html"), F.lit(scale)) < int(limit * scale / n))
    rows = held.dropDuplicates(["html"]).collect()  # equal pages teach what one does
    rows.sort(key=lambda r: (str(r["id"]), r["html"]))
    return fit_pages([r["html"] for r in rows])


def extract(pages: DataFrame, model: Boosted, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and text, n_chars (code points): the main text of each whole page.

    Null and empty pages, and pages without main text, give the empty text. The page alone decides, so equal
    pages give equal texts. Unclosed and misnested elements close where a browser would close them, roughly."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def work():
        trees = held.value

        def run(texts):
            parsed = [parse(t.as_py()) for t in texts]
            out = [text_of(nodes, settled(nodes, odds)) for nodes, odds in zip(parsed, rated(parsed, trees))]
            return out, [len(t) for t in out]
        return run

    return per_text(pages, work, {"text": "string", "n_chars": "long"}, html_col, keep)
