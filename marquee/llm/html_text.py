"""Main text of HTML pages by tree scoring.

A page is read tag by tag into a tree of containers and blocks. Each block passes points for its length and its commas
to its container and, halved, to the container above; a container's points are discounted by its link density. The best
container is kept together with those of its siblings that score like content, and their blocks in page order are the
text. Elements that are never the article hold no points and no text. A part whose class, id or role speaks against it, and
a form, is only marked: it hands no points to the containers around it, and its own count PENALTY times. It stays out of
the text unless what is outside scores too little to be an article (ENOUGH) and the best container lies in it, so a
page-wide form or a layout that is named after its sidebar loses nothing but its fields.

Markup is read in one pass with states for tag, attribute name and value. What can't be a tag is text: a `<` without a
letter behind it, or without any `>` up to the end of the page. A quote inside an unquoted value belongs to it, a quote that
is never closed is part of the attribute. End tags of elements that are not open are ignored; an element that is never
closed ends with the one around it. Time grows with the length of the page, whatever its nesting.

Null and empty pages give an empty text, and so do pages without a block. Repeated rows get the same text. Pages of any
length are read whole. Columns of the input stay; `text` and `n_chars` replace columns of the same name.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "nav header footer aside button select option fieldset label legend datalist output dialog menu svg math canvas object "
    "audio video head".split()
) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
    .split()
)
# Elements whose attributes are those of the whole page or text.
WHOLE = frozenset("html body article main".split())
CONTAINERS = frozenset("article blockquote body center details div html main section table tbody td th tr".split())
INSIDE_ARTICLE = frozenset("article main section".split())
SELF_CLOSED_BY = {"p": BLOCKS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
                  "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "tr": frozenset({"tr"}),
                  "option": frozenset({"option"})}

# What class, id or role says of a part that is not the article.
UNWANTED = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|breadcrumbs?|comments?|commentlist|disqus|replies|respond|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|"
    r"nav|navbar|navigation|menus?|sidebars?|side|aside|widgets?|related|recommend\w*|share|sharing|social|"
    r"footer|header|masthead|pager|pagination|toolbar|search|complementary|contentinfo|dialog|hidden|skip)(?![a-z])",
)
# A class name that begins like this says what a layout has or lacks, not what the part is.
LAYOUT = re.compile(r"(?:has|no|with|without|not|non|layout|supports|js)-")
OWN_HEADER = re.compile(r"(?:post|entry|article|story|content|section|news|blog)-header(?![a-z])")
ARTICLE_HEADER = frozenset({"header", "masthead"})

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
BETWEEN = re.compile(r"[\s/]*+")
ATTRIBUTE = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?)?"""
)
SPACES = re.compile(r"\s+")

BREAK = "\n"

COMMA = re.compile("[,،、，]")
LENGTH_STEP, MOST_LENGTH_POINTS = 100, 3
SIBLING_SHARE = 0.2
LEAST_SIBLING_TEXT, MOST_LINKS = 80, 0.25
PENALTY, ENOUGH = 0.25, 10.0
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SENTENCE_END = re.compile(r"[.!?:;…。！？؟।][\"'”’»)\]]*\s*$")


class Node:
    """A container: its parts in page order are blocks (text, characters in links) and containers; headings has the
    places of the blocks that are headings. A marked one speaks against itself, a covered one is inside such a part."""

    __slots__ = ("name", "parent", "parts", "headings", "points", "chars", "linked", "marked", "covered", "held")

    def __init__(self, name: str, parent: Node | None, marked: bool = False):
        self.name, self.parent, self.parts, self.headings = name, parent, [], set()
        self.points, self.chars, self.linked = 0.0, 0, 0
        self.marked, self.covered, self.held = marked, marked or parent is not None and parent.covered, not marked

    def score(self) -> float:
        return self.points * (1 - self.linked / self.chars) if self.chars else 0.0

    def blocks(self) -> Iterator[str]:
        waiting = [iter(self.parts)]
        while waiting:
            part = next(waiting[-1], None)
            if part is None:
                waiting.pop()
            elif isinstance(part, Node):
                if part.held:
                    waiting.append(iter(part.parts))
            else:
                yield part[0]


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or "true" in attributes.get("aria-hidden", "")
        or bool(re.search(r"display\s*:\s*none", attributes.get("style", "")))
    )


def _marked(attributes: dict[str, str], in_article: bool) -> bool:
    """Whether class, id or role say that the part is not the article."""
    for key in ("class", "id", "role"):
        for token in attributes.get(key, "").split():
            token = re.sub(r"([a-z])([A-Z])", r"\1-\2", token).replace("_", "-").lower()
            if LAYOUT.match(token):
                continue
            words = set(UNWANTED.findall(token))
            if in_article or OWN_HEADER.search(token):
                words -= ARTICLE_HEADER
            if words:
                return True
    return False


def _attributes(page: str, at: int) -> tuple[dict[str, str], int, bool]:
    """The attributes from a place inside a tag, where the tag ends, and whether it closes itself."""
    found: dict[str, str] = {}
    while True:
        between = BETWEEN.match(page, at)
        at = between.end()
        if at >= len(page):
            return found, at, False
        if page[at] == ">":
            return found, at + 1, between[0].endswith("/")
        part = ATTRIBUTE.match(page, at)
        found.setdefault(part[1].lower(), part[2] or part[3] or part[4] or "")
        at = part.end()


def parse(page: str) -> Node:
    root = node = Node("html", None)
    opened: list[tuple[str, Node, bool]] = []  # element, container around it, whether it is dropped
    open_blocks: list[int] = []  # where in `opened` the block elements are
    times = Counter()  # how often each element is open
    dropped = 0
    pieces: list[tuple[str, bool]] = []

    def flush(heading: bool = False) -> None:
        nonlocal pieces
        if pieces:
            text = SPACES.sub(" ", html.unescape("".join(p for p, _ in pieces))).strip()
            if text:
                linked = len(SPACES.sub(" ", html.unescape("".join(p for p, in_link in pieces if in_link))).strip())
                if heading:
                    node.headings.add(len(node.parts))
                node.parts.append((text, min(linked, len(text))))
            pieces = []

    def close(count: int) -> None:
        nonlocal node, dropped
        for _ in range(count):
            name, around, was_dropped = opened.pop()
            if name in BLOCKS:
                open_blocks.pop()
                if not dropped:
                    flush(name in HEADINGS)
            dropped -= was_dropped
            times[name] -= 1
            node = around

    def open_tag(name: str, attributes: dict[str, str], closed: bool) -> None:
        nonlocal node, dropped
        while opened and name in SELF_CLOSED_BY.get(opened[-1][0], ()):
            close(1)
        if name == "br":
            # One line break is white space, two end the block.
            if not dropped:
                last = next((p for p, _ in reversed(pieces) if p is BREAK or not p.isspace()), None)
                flush() if last is BREAK else pieces.append((BREAK, False))
            return
        if name in BLOCKS:
            # An open paragraph ends at the next block, whatever inline elements are still open in it.
            if open_blocks and opened[open_blocks[-1]][0] == "p":
                close(len(opened) - open_blocks[-1])
            if not dropped:
                flush()
        if name in RAW or name in VOID or closed:
            return
        in_article = any(times[n] for n in INSIDE_ARTICLE)
        out = name in DROPPED and not (name == "header" and in_article) or _hidden(attributes)
        marked = name == "form" or name not in WHOLE and _marked(attributes, in_article)
        if marked and name not in BLOCKS:
            out = True
        if name in BLOCKS:
            open_blocks.append(len(opened))
        opened.append((name, node, out))
        times[name] += 1
        if out:
            dropped += 1
        elif not dropped and (marked or name in CONTAINERS):
            node = Node(name, node, marked)
            node.parent.parts.append(node)

    at, text_from, last = 0, 0, page.rfind(">")

    def text_to(end: int) -> None:
        if not dropped and end > text_from:
            pieces.append((page[text_from:end], times["a"] > 0))

    while True:
        at = page.find("<", at)
        if at < 0 or at > last:
            break
        following = page[at + 1 : at + 2]
        if following in ("!", "?"):
            text_to(at)
            end = page.find("-->", at + 2) if page.startswith("<!--", at) else page.find(">", at)
            if end < 0:
                text_from = len(page)
                break
            at = text_from = end + (3 if page.startswith("<!--", at) else 1)
            continue
        ending = following == "/"
        found = TAG_NAME.match(page, at + 1 + ending)
        if not found:
            at += 1
            continue
        text_to(at)
        name = found[0].lower()
        attributes, at, closed = _attributes(page, found.end())
        text_from = at
        if ending:
            if times[name]:
                close(next(k for k, (n, _, _) in enumerate(reversed(opened), 1) if n == name))
            continue
        open_tag(name, attributes, closed)
        if name in RAW and not closed:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            at = text_from = end.end() if end else len(page)
    text_to(len(page))
    if not dropped:
        flush()
    return root


def _score(root: Node) -> list[Node]:
    """Points of all containers; the containers, parents first."""
    nodes, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        nodes.append(node)
        waiting += [p for p in reversed(node.parts) if isinstance(p, Node)]
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, Node):
                if not part.marked:
                    node.chars += part.chars
                    node.linked += part.linked
                continue
            text, linked = part
            node.chars += len(text)
            node.linked += linked
            points = 1 + len(COMMA.findall(text)) + min(len(text) // LENGTH_STEP, MOST_LENGTH_POINTS)
            points *= 1 - linked / len(text)
            node.points += points
            if node.parent and not node.marked:
                node.parent.points += points / 2
    return nodes


def _with_neighbours(around: Node, chosen: list[bool]) -> list[bool]:
    """The chosen parts, with parts without links next to them that end a sentence, and headings before any of them."""

    def plain(part: Node | tuple[str, int]) -> bool:
        if isinstance(part, Node):
            return part.held and not part.linked and any(SENTENCE_END.search(b) for b in part.blocks())
        return not part[1] and bool(SENTENCE_END.search(part[0]))

    def heading(k: int) -> bool:
        part = around.parts[k]
        if isinstance(part, Node):
            return part.held and not part.linked and bool(part.headings)
        return not part[1] and k in around.headings

    found = list(chosen)
    for k in range(1, len(found)):
        found[k] = found[k] or found[k - 1] and plain(around.parts[k])
    follows = False
    for k in reversed(range(len(found))):
        beside = k + 1 < len(found) and found[k + 1]
        found[k] = found[k] or follows and heading(k) or beside and plain(around.parts[k])
        follows = follows or found[k]
    return found


def _best(nodes: list[Node]) -> tuple[Node, bool]:
    """The best container, and whether it is an article among others or the whole of one."""

    def first(among: list[Node]) -> Node:
        return max(among, key=lambda n: (n.score(), n.chars))

    def articles(among: list[Node]) -> list[Node]:
        return [n for n in among if n.name in ("article", "main") and n.chars]

    outside = [n for n in nodes if not n.covered]
    named = articles(outside)
    best = first(named or outside)
    if best.score() < ENOUGH and (covered := [n for n in nodes if n.covered and n.chars]):
        inside = first(covered)
        around = {id(n) for n in _up(inside)}
        known = articles([n for n in covered if id(n) in around or any(x is inside for x in _up(n))])
        if (inside.score() >= ENOUGH or known) and PENALTY * inside.score() > best.score():
            named, best = known, first(known or [inside])
            for node in _up(best):
                node.held = True
    return best, bool(named)


def _up(node: Node | None) -> Iterator[Node]:
    while node:
        yield node
        node = node.parent


def main_text(page: str | None) -> str:
    root = parse(page or "")
    nodes = _score(root)
    best, articles = _best(nodes)
    while best.parent and best.parent.name in INSIDE_ARTICLE and best.parent.chars:
        best = best.parent
    kept = [best]
    if best.parent:
        least = max(10.0, SIBLING_SHARE * best.score())
        chosen = []
        for part in best.parent.parts:
            if part is best:
                chosen.append(True)
            elif isinstance(part, Node) and not part.held:
                chosen.append(False)
            elif isinstance(part, Node):
                alike = part.name == best.name if best.name == "article" else True
                chosen.append(alike and part.score() >= least and part.linked <= MOST_LINKS * part.chars)
            else:
                chosen.append(best.name != "article" and len(part[0]) >= LEAST_SIBLING_TEXT and part[1] <= MOST_LINKS * len(part[0]))
        if not articles:
            chosen = _with_neighbours(best.parent, chosen)
        kept = [part for part, held in zip(best.parent.parts, chosen, strict=True) if held]
    blocks = [b for k in kept for b in (k.blocks() if isinstance(k, Node) else [k[0]])]
    return "\n".join(blocks)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """The columns of the pages but the markup, with text and n_chars."""
    kept = [c for c in pages.columns if c not in (page, "text", "n_chars")]
    schema = T.StructType(
        [*(pages.schema[c] for c in kept), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch[page]]
            arrays = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*kept, "text", "n_chars"],
            )

    return pages.select(*kept, page).mapInArrow(run, schema)
