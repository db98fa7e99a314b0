"""A page's tags in plain Python, for Arrow tasks that cut many texts out of it; reads a page as `markup` does.

A token is (name, head, text). Tags, elements and attributes mean what they mean in `markup`; an element is found by one
walk that stops at its end tag.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from marquee.functions import markup, text

Token = tuple[str, str, str]
Match = Callable[[Token], bool]

_COMMENT = re.compile(r"<!--.*?-->", re.DOTALL)
_TAG = re.compile(r"<(?=/?[A-Za-z])")
_NAME = re.compile(markup.NAME, re.ASCII)
_HEAD = re.compile(markup.HEAD.removeprefix(r"\A"), re.ASCII)
_SPACE = re.compile(r"\s+", re.ASCII)


# Tags whose quotes stand in pairs around values end at their first closing bracket.
_PAIRED = re.compile(rf"""{markup.NAME}(?:\s+[\w:-]+\s*=\s*(?:"[^"]*"|'[^']*'))*[\s/]*""", re.ASCII)


@lru_cache(8192)
def _plain(near: str) -> str | None:
    """Name of a tag that surely ends at its first closing bracket, given all before that; None if it may go on."""
    if ('"' in near or "'" in near) and not _PAIRED.fullmatch(near):
        return None
    return _NAME.match(near).group().lower()


def tokens(body: str | None) -> list[Token]:
    """The tags of a page."""
    found = []
    for piece in _TAG.split(_COMMENT.sub("", body or ""))[1:]:
        near, bracket, rest = piece.partition(">")
        name = _plain(near) if len(near) < 256 else None  # pages repeat their short tags
        if name is None:
            whole = _HEAD.match(piece)
            head = whole.group() if whole else ""
            found.append((_NAME.match(head).group().lower() if head else "", head, piece[len(head) :]))
        elif bracket:
            found.append((name, near + ">", rest))
        else:
            found.append(("", "", piece))
    return found


@lru_cache(64)
def _attribute(name: str) -> re.Pattern:
    return re.compile(markup.attribute_pattern(name).removeprefix(r"\A"), re.ASCII)


def value_in(head: str, name: str) -> str:
    """Raw value of an attribute in a tag; '' if absent."""
    found = _attribute(name).match(head)
    value = found.group(2) if found else ""
    return value[1:-1] if value[:1] in ('"', "'") else value


@lru_cache(4096)
def _classes(head: str) -> frozenset[str]:
    return frozenset(_SPACE.split(value_in(head, "class")))


def tag(name: str | None = None, cls: str | None = None, attr: tuple[str, str] | None = None) -> Match:
    """Whether a token is an opening tag of a name, with class tokens, or with an attribute that matches a pattern."""
    # A plain search for a class spares most tags the pattern.
    classes = (cls or "").split()
    first = classes[0] if classes else ""
    value = re.compile(attr[1], re.ASCII) if attr else None

    def rest(token: Token) -> bool:
        own, head, _ = token
        if not name and own.startswith("/") or classes and not _classes(head).issuperset(classes):
            return False
        return attr is None or attr[0] in head.lower() and value.fullmatch(value_in(head, attr[0])) is not None

    if name and not classes and attr is None:
        return lambda token: token[0] == name
    if name:
        return lambda token: token[0] == name and first in token[1] and rest(token)
    if attr and not classes:
        return lambda token: attr[0] in token[1].lower() and rest(token)
    return lambda token: first in token[1] and rest(token)


def blocks(page: list[Token], opening: Match) -> list[list[Token]]:
    """Parts that each start at an opening tag and run to the next one."""
    starts = [at for at, token in enumerate(page) if opening(token)]
    return [page[at:end] for at, end in zip(starts, [*starts[1:], len(page)])]


def element(page: list[Token], opening: Match) -> list[Token]:
    """Tokens of the first matching element, without its end tag; empty if it is absent or never closed."""
    for at, token in enumerate(page):
        if opening(token):
            own, end, depth = token[0], "/" + token[0], 1
            for to in range(at + 1, len(page)):
                name = page[to][0]
                if name == own:
                    depth += 1
                elif name == end:
                    depth -= 1
                    if not depth:
                        return page[at:to]
            return []
    return []


def words(part: list[Token]) -> str:
    """Text of some tokens, every run trimmed; character references are left."""
    return "".join([token[2].strip(text.WHITESPACE) for token in part])


def attribute(page: list[Token], opening: Match, name: str) -> str:
    """Raw value of an attribute of the first matching tag; '' if absent."""
    return next((value_in(token[1], name) for token in page if opening(token)), "")
