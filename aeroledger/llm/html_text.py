"""Main text of web pages by tree scoring.

A page becomes a tree of elements.  Elements that are never part of an article (menus, footers, forms, adverts and the
like, told by tag, role or the words of class and id) are cut out.  Words of class and id, and a form, only suggest it: such
an element stays when the page's only article or main element is in it, or more than half of the page's text outside links
(which a discussion, told by a name that begins with such a word, may well have and is cut all the same), and all of them
stay when nothing is left without them.  Every paragraph then passes points to its ancestors:
1, one per comma and up to 3 for its length, in full to the parent, half to its parent and ever less above.  A container's
points are discounted by the share of its text that lies in links.  The best container is kept, with siblings that
score at least a fifth of it, are plain paragraphs, headings and lists with few links, or hold paragraphs with few links.
Further up, siblings of its ancestors join it where they score at least that fifth and hold few links: an article may be
cut over several wrappers.  Lists and sections that are mostly links go, but not
within an article or main element (its sources stay), and tables only where all of their text is linked.

Within a block white space becomes one space; blocks are trimmed and joined by line feeds in page order.  Null or empty
html, or a page without text, gives an empty text.  A comment that is never closed swallows the rest of the page.  Pages are independent of each other; copies give equal texts.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import whole_text

# Fixed values of HTML: elements without content, with text that is not shown, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas audio video datalist".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary
    table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption li dd dt legend summary figcaption".split())
SAME_LEVEL = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"),
              "tbody": ("tbody", "thead", "tr", "td", "th"), "option": ("option",)}
HOLDS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",),
         "tbody": ("table",), "option": ("select",)}

APART_TAGS = frozenset("nav footer aside button select textarea input dialog menu search".split())
APART_ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog form menu menubar".split())
APART_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments
    commentlist consent cookie cookies disclaimer discussion disqus footer footnav gdpr login masthead menu modal nav navbar
    navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended
    related replies reply respond responses share sharing sidebar signup skyscraper social sponsor sponsored subscribe
    subscription syndication teaser toolbar widget widgets""".split())
TALK_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
HEADER_WORDS = frozenset("header topbar top".split())
PARAGRAPHS = frozenset("p pre blockquote td dd li figcaption".split())
PLAIN = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table figure".split())
MAIN_TAGS = frozenset("article main".split())
MAIN_BONUS = 25.0
REACH = 64  # ancestors that a paragraph passes points to; the last gets 1/192


class Node:
    __slots__ = ("tag", "parent", "depth", "children", "apart", "soft", "talk", "main", "mains", "score", "letters", "linked")

    def __init__(self, tag: str, parent: "Node | None", apart: bool = False, main: bool = False, soft: bool = False,
                 talk: bool = False):
        self.tag, self.parent, self.apart, self.main, self.soft, self.talk = tag, parent, apart or soft, main, soft and not apart, talk
        self.depth = parent.depth + 1 if parent else 0
        self.mains = 0
        self.children: list[Node | str] = []
        self.score, self.letters, self.linked = 0.0, 0, 0


def is_apart(tag: str, attrs: dict[str, str]) -> bool:
    role = (attrs.get("role") or "").lower()
    if tag in APART_TAGS or role in APART_ROLES - {"form"} or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    return bool(re.search(r"(display\s*:\s*none|visibility\s*:\s*hidden)", attrs.get("style") or "", re.I))


def seems_apart(tag: str, attrs: dict[str, str], inside_main: bool) -> tuple[bool, bool]:
    """Whether form or names suggest boilerplate, and whether a name begins with a word of discussions."""
    if tag in ("html", "body") or tag in MAIN_TAGS:
        return False, False
    names = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{attrs.get('class') or ''} {attrs.get('id') or ''}").lower()
    words = set(re.split(r"[^a-z]+", names))
    soft = tag == "form" or (attrs.get("role") or "").lower() == "form" or bool(words & APART_WORDS)
    soft = soft or (not inside_main and (tag == "header" or bool(words & HEADER_WORDS)))
    return soft, bool(words & TALK_WORDS) and any(re.split(r"[^a-z]+", n)[0] in TALK_WORDS for n in names.split())


class TreeBuilder(HTMLParser):
    """Elements and texts, with the end tags that HTML lets authors leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.open: dict[str, list[Node]] = {}  # open elements of each tag; "" has all that start a block

    def leave_for(self, node: Node) -> None:
        """End open elements until ``node`` is the innermost."""
        while self.at is not node:
            self.open[self.at.tag].pop()
            if self.at.tag in BLOCKS:
                self.open[""].pop()
            self.at = self.at.parent

    def innermost(self, tags: tuple[str, ...]) -> Node:
        """The innermost open element of ``tags``, else the root."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), key=lambda n: n.depth, default=self.root)

    def close_to(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        """End the innermost open element of ``tags``, if no element of ``stop`` lies between."""
        node = self.innermost(tags)
        if node.depth > self.innermost(stop).depth:
            self.leave_for(node.parent)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and (tag == "html" or any(isinstance(c, Node) and c.tag == "body" for c in self.root.children)):
            return
        if tag in ENDS_P:
            self.close_to(("p",), ("td", "th", "table", "button", "li"))
        if tag in SAME_LEVEL:
            for _ in range(3):
                before = self.at
                self.close_to(SAME_LEVEL[tag], HOLDS[tag])
                if self.at is before:
                    break
        if tag[0] == "h" and tag[1:].isdigit() and self.at.tag[0] == "h" and self.at.tag[1:].isdigit():
            self.leave_for(self.at.parent)
        if tag == "body":
            self.leave_for(self.root)
        if tag in VOID:
            self.at.children.append(Node(tag, self.at))
            return
        values, inside = dict(attrs), self.at.main
        main = tag in MAIN_TAGS or (values.get("role") or "").lower() in ("main", "article")
        soft, talk = seems_apart(tag, values, inside)
        node = Node(tag, self.at, tag in UNSEEN or is_apart(tag, values), main or inside, soft, talk)
        self.at.children.append(node)
        self.at = node
        self.open.setdefault(tag, []).append(node)
        if tag in BLOCKS:
            self.open.setdefault("", []).append(node)

    def handle_endtag(self, tag):
        if tag in ("html", "body", "br"):
            return
        if tag == "p":
            self.close_to(("p",), ("td", "th", "table", "button"))
            return
        node = self.innermost((tag,))
        if node is not self.root and (tag in BLOCKS or node.depth > self.innermost(("",)).depth):
            self.leave_for(node.parent)

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    if builder.rawdata.startswith("<!--"):  # a comment that never ends swallows the rest
        builder.rawdata = ""
    builder.close()
    return builder.root


def in_order(root: Node) -> list[Node]:
    """All kept elements, parents before children, without recursion."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.apart)
    return out


def release(root: Node, everything: bool = False) -> None:
    """Take back the cut of elements that only seem boilerplate, where the article or most of the text is in them."""
    def below(node: Node) -> list[Node]:
        return [c for c in node.children if isinstance(c, Node) and (c.soft or not c.apart)]

    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(below(node))
    if everything:
        for node in nodes:
            node.apart = False
        return
    if not any(node.soft for node in nodes):
        return
    for node in reversed(nodes):
        node.mains = int(node.main and not (node.parent and node.parent.main)) + sum(c.mains for c in below(node))
        node.letters = 0 if node.tag == "a" else (sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
                                                 + sum(c.letters for c in below(node)))
    shown = any(node.main for node in in_order(root))
    stack = [root]
    while stack:
        node = stack.pop()
        if node.apart:
            if not ((node.mains and not shown) or (2 * node.letters > root.letters and not node.talk)):
                continue
            node.apart = False
            shown = shown or any(n.main for n in in_order(node))
        stack.extend(below(node))


def measure(nodes: list[Node]) -> None:
    """Letters of each element's text and of the links in it."""
    for node in reversed(nodes):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        kids = [c for c in node.children if isinstance(c, Node) and not c.apart]
        node.letters = own + sum(k.letters for k in kids)
        node.linked = node.letters if node.tag == "a" else sum(k.linked for k in kids)


def link_density(node: Node) -> float:
    return node.linked / node.letters if node.letters else 0.0


def text_of(node: Node) -> str:
    return " ".join(blocks(node))


def score(nodes: list[Node]) -> dict[int, Node]:
    """Let paragraphs, and text that stands directly in a container, pass points upwards; returns the scored elements."""
    scored: dict[int, Node] = {}
    for node in nodes:
        inner = [c for c in node.children if isinstance(c, Node) and c.tag in BLOCKS and not c.apart]
        if node.tag in PARAGRAPHS and not inner:
            text, start = text_of(node), node.parent
        elif node.tag in BLOCKS and node.tag not in PARAGRAPHS:
            text, start = " ".join(" ".join(c.split()) for c in node.children if isinstance(c, str)).strip(), node
        else:
            continue
        if not text or start is None:
            continue
        points = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - link_density(node))
        share, up = 1.0, start
        level = 0
        while up is not None and level < REACH:
            up.score += points * share
            scored[id(up)] = up
            level += 1
            share = 0.5 if level == 1 else 1 / (level * 3)
            up = up.parent
    return scored


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below ``node`` in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            run.append(item)
        elif item is None:
            flush()
        elif item.apart:
            if item.tag in BLOCKS:
                flush()
        else:
            if item.tag == "br":
                run.append(" ")
            if item.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()
    return out


def links_only(node: Node) -> bool:
    if node.main:
        return False
    return (node.tag in ("ul", "ol", "div", "section") and link_density(node) > 0.5) or (
        node.tag == "table" and 0 < node.letters == node.linked)


def kept_parts(root: Node) -> list[Node]:
    """The best container, or its siblings with it, in page order."""
    nodes = in_order(root)
    measure(nodes)
    for node in nodes:
        if node.parent is not None and links_only(node):
            node.apart = True
    nodes = in_order(root)
    measure(nodes)
    scored = score(nodes)
    if not scored:
        return []

    def value(node: Node) -> float:
        own = node.tag in MAIN_TAGS or (node.main and not (node.parent and node.parent.main))
        return (node.score + MAIN_BONUS * own) * (1 - link_density(node))

    best = max(scored.values(), key=value)  # ties: the one met first
    up = best
    while up is not None:  # a part of an article stands for the article
        if up.main and not (up.parent and up.parent.main):
            best = up
        up = up.parent
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    least = max(1.0, 0.2 * value(best))

    def stays(node) -> bool:
        if node is best:
            return True
        if not isinstance(node, Node) or node.apart or not node.letters:
            return False
        if best.main:
            return node.main and value(node) >= least
        return value(node) >= least or ((node.tag in PLAIN or node.score > 0) and link_density(node) < 0.25)

    parts = [c for c in best.parent.children if stays(c)]
    if best.main:
        return parts
    up = best.parent
    while up.parent is not None and up.tag != "body":
        kin = [c for c in up.parent.children if c is up or (
            isinstance(c, Node) and not c.apart and value(c) >= least and link_density(c) < 0.25)]
        at = next(i for i, c in enumerate(kin) if c is up)
        parts = kin[:at] + parts + kin[at + 1:]
        up = up.parent
    return parts


def main_text(html: str) -> str:
    if not html or not html.strip():
        return ""
    root = parse(html)
    release(root)
    text = "\n".join(b for part in kept_parts(root) for b in blocks(part))
    if not text:
        root = parse(html)
        release(root, everything=True)
        text = "\n".join(b for part in kept_parts(root) for b in blocks(part))
    return text


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Per page: key, text, n_chars, and the columns of ``pages`` but the html and what is called text or n_chars."""
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.select(*keep, whole_text(html).alias("html__")).mapInArrow(run, schema)
