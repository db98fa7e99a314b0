"""Extraction of the main text: a plain scorer over a parsed tree, pages whose marks mislead, malformed markup."""

import random
import time
from html.parser import HTMLParser

import pytest

from marquee.llm import html_text

PARAGRAPH = "Paragraph {}, with commas, and words, to be long enough for any score that counts."
PARAGRAPHS = "".join(f"<p>{PARAGRAPH.format(k)}</p>" for k in range(6))
TEXT = "\n".join(PARAGRAPH.format(k) for k in range(6))
HEADED = f"Title\n{TEXT}"
TALK = "<p>Nice, really, good, so good, yes, I say.</p>" * 50


class Tree(HTMLParser):
    """Well-formed pages of div, section, td, p, h2 and a as nested lists: [name, marked, children]; text is a pair."""

    def __init__(self, page):
        super().__init__()
        self.root = ["html", False, []]
        self.path = [self.root]
        self.in_link = 0
        self.feed(page)

    def handle_starttag(self, name, attrs):
        if name == "a":
            self.in_link += 1
            return
        made = [name, dict(attrs).get("class") == "sidebar", []]
        self.path[-1][2].append(made)
        self.path.append(made)

    def handle_endtag(self, name):
        if name == "a":
            self.in_link -= 1
        else:
            self.path.pop()

    def handle_data(self, data):
        self.path[-1][2].append((data, self.in_link))


def block_of(paragraph):
    text = " ".join("".join(t for t, _ in paragraph[2]).split())
    return text, len(" ".join("".join(t for t, link in paragraph[2] if link).split()))


def containers(node, path=()):
    yield node, path
    for child in node[2]:
        if isinstance(child, list) and child[0] not in ("p", "h2"):
            yield from containers(child, (*path, node))


def plain_scores(root):
    """(score, characters) of every container outside marked ones, by going through all blocks for each."""
    blocks = []
    for node, path in containers(root):
        for child in node[2]:
            if isinstance(child, list) and child[0] in ("p", "h2"):
                text, linked = block_of(child)
                if text:
                    blocks.append((node, [*path, node], text, linked))
    found = {}
    for node, path in containers(root):
        if any(n[1] for n in (*path, node)):
            continue
        inside = [b for b in blocks if any(n is node for n in b[1]) and not any(n[1] for n in b[1])]
        points = 0.0
        for own, above, text, linked in inside:
            share = 1 if own is node else 0.5 if above[-2] is node else 0
            points += share * (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - linked / len(text))
        chars = sum(len(b[2]) for b in inside)
        found[id(node)] = (points * (1 - sum(b[3] for b in inside) / chars) if chars else 0.0, chars)
    return found


def random_page(rng, depth=0):
    parts = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.35 and depth < 4:
            name = rng.choice(["div", "section"])
            mark = rng.choice(["", "", "", ' class="sidebar"'])
            parts.append(f"<{name}{mark}>{random_page(rng, depth + 1)}</{name}>")
        else:
            words = " ".join(rng.choices(["one", "two,", "three", "a", "longer word,"], k=rng.randint(1, 60)))
            link = rng.choice(["", "", f'<a href="x">{words[:10]}</a> '])
            parts.append(f"<p>{link}{words}</p>")
    return "".join(parts)


def test_the_best_container_is_that_of_a_plain_scorer():
    rng = random.Random(4)
    tried = 0
    for _ in range(300):
        page = random_page(rng)
        scores = plain_scores(Tree(page).root)
        best = max(scores.values())
        root = html_text.parse(page)
        nodes = html_text._score(root)
        got = sorted(((n.score(), n.chars) for n in nodes if not n.covered), reverse=True)
        assert [(round(s, 6), c) for s, c in got] == sorted(((round(s, 6), c) for s, c in scores.values()), reverse=True)
        chosen, _ = html_text._best(nodes)
        if best[0] >= html_text.ENOUGH:
            tried += 1
            assert not chosen.covered and (round(chosen.score(), 6), chosen.chars) == (round(best[0], 6), best[1])
            assert not any(not n.held and n.parent is None for n in nodes)
    assert tried > 100


@pytest.mark.parametrize(
    "page",
    [
        f'<body><div class="content has-sidebar"><h1>Title</h1>{PARAGRAPHS}</div></body>',
        f'<body><div id="sidebar-right"><h1>Title</h1>{PARAGRAPHS}</div></body>',
        f'<body><div id="page" class="no-comments"><h1>Title</h1>{PARAGRAPHS}</div></body>',
        f'<form action=x><input name=q><div><h1>Title</h1>{PARAGRAPHS}</div><button>Go</button><label>Name</label></form>',
        f'<form><article><h1>Title</h1>{PARAGRAPHS}</article><select><option>One</option></select></form>',
        f'<div class="widget"><article><h1>Title</h1>{PARAGRAPHS}<div class="ad">Buy</div></article></div><p>Skip.</p>',
        f'<article><div class="post-header"><h1>Title</h1></div>{PARAGRAPHS}</article>',
        f'<article><div class="header"><h1>Title</h1></div>{PARAGRAPHS}<div class="advert">Buy</div>'
        f'<section class="comments">{TALK}</section></article>',
        f'<div><h1>Title</h1>{PARAGRAPHS}</div><div class="comments">{TALK}</div>',
        f'<div><h1>Title</h1>{PARAGRAPHS}</div><div class="comments"><article>{TALK}</article></div>',
        f'<div class="post"><div class="entry-header"><h1>Title</h1></div>{PARAGRAPHS}</div>',
    ],
)
def test_marks_do_not_drop_the_article(page):
    assert html_text.main_text(page) == HEADED


def test_pages_without_an_article():
    assert html_text.main_text("<article><p>One <b") == "One <b"
    assert html_text.main_text('<nav><a href=x>a</a></nav><div class="cookie-notice"><p>We use cookies.</p></div>') == ""
    assert html_text.main_text("<form><p>Your name</p><input></form>") == ""
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<div></div>") == ""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p data-x=it's>One, two.</p><p title='a>b'>Three's</p>", "One, two.\nThree's"),
        ("<p data-x=it's>One</p><p data-y=that's>Two</p>", "One\nTwo"),
        ("<p>See <a href=http://x/>this</a> now</p>", "See this now"),
        ('<p class="a"id=b/>One</p><p / >Two', "One\nTwo"),
        ("<P>One &lt; two &amp; &#233;</P>\n<p>5 < 6 and 7 <8</p>", "One < two & é\n5 < 6 and 7 <8"),
        ("<p>One<p>Two</div></b></span></p>Three", "One\nTwo\nThree"),
        ("<p>One <b>bold", "One bold"),
        ("<p>One <!-- never closed <p>Two</p>", "One"),
        ("<p title=\"never closed>One</p><p>Two</p>", "One\nTwo"),
        ("<script>if (a < b) '</p>'</script ><p>One</p><style>p{}</style>", "One"),
        ("<p hidden>One</p><p style='display: none'>Two</p><p aria-hidden=true>x</p><p>Three</p>", "Three"),
    ],
)
def test_markup_of_any_spelling(page, text):
    assert html_text.main_text(f"<article>{page}</article>") == text


@pytest.mark.parametrize(
    "piece",
    ["<a ", '<a href="', "<p x='", "<!--", "<", "</a", "<a b=", "<br> ", "<a>", "<div>", "<i>x", "<p><i>", "&amp", "<form>", "</b>",
     '<div class="sidebar">', "<table><tr><td>"],
)
def test_time_grows_with_the_page(piece):
    begun = time.process_time()
    html_text.main_text(piece * (400_000 // len(piece)) + "<i>" * 4000 + "</b>" * 4000 + "end")
    assert time.process_time() - begun < 6


def test_extra_columns_and_repeated_rows(spark):
    rows = [(1, "u", f"<div>{PARAGRAPHS}</div>", "old", 3), (1, "u", f"<div>{PARAGRAPHS}</div>", "old", 3), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = html_text.extract(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)], key=repr)
    assert html_text.extract(frame.limit(0)).collect() == []
