"""HTML as Catalyst functions: pages as arrays of tags, elements by depth, field text, character references.

A page is split once into tokens, one for each tag: its name in lower case (`/name` for an end tag), the rest of the tag,
and the text up to the next tag. Elements are found by a fold that counts tags of their own name up and down, so no
pattern is made per row. Comments are dropped. Attribute values may stand in any quotes or none, names in any case. A
`<` inside an attribute value is read as text unless a letter follows it.
"""

from __future__ import annotations

import html.entities
import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions import text

_NAMED = html.entities.html5
# References that browsers accept without a semicolon, longest first so the longest name wins.
_BARE = sorted((k for k in _NAMED if not k.endswith(";")), key=len, reverse=True)
_COMMON = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": "\xa0", "Tab;": "\t", "NewLine;": "\n"}
# Names of the older, small set: looked up in a map. All others sit in one text, a name and its
# characters per line, which is slower to search but far lighter in a query plan.
_FREQUENT = {f"{name};": chr(code) for name, code in html.entities.name2codepoint.items()}
_TABLE = "\n" + "".join(f"{name}\t{chars}\n" for name, chars in _NAMED.items() if name not in _COMMON)
# Code points 128 to 159 are read as the Windows character of that byte.
_WINDOWS = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)]


Match = Callable[[Column], Column]

_VALUE = r"""("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
NAME = r"/?[A-Za-z][\w-]*+"
HEAD = rf"""\A{NAME}(?:[\s/]*+[^\s=>/]++(?:\s*+=\s*+{_VALUE})?+)*+[^>]*+>"""


def tokens(body: Column) -> Column:
    """The tags of a page as an array of (name, head, text)."""
    bare = F.regexp_replace(text.text_or_empty(body), r"(?s)<!--.*?-->", "")
    pieces = F.split(bare, r"<(?=/?[A-Za-z])")

    def token(piece: Column) -> Column:
        def cut(head: Column) -> Column:
            return F.struct(
                F.lower(F.regexp_extract(head, rf"\A{NAME}", 0)).alias("name"),
                head.alias("head"),
                F.substr(piece, F.char_length(head) + 1).alias("text"),
            )

        def head(near: Column) -> Column:
            # Only a tag with quotes can go on behind its first closing bracket.
            quoted = F.contains(near, F.lit('"')) | F.contains(near, F.lit("'"))
            plain = F.when(near == piece, "").otherwise(F.concat(near, F.lit(">")))
            return F.when(quoted, F.regexp_extract(piece, HEAD, 0)).otherwise(plain)

        return text.once(text.once(F.substring_index(piece, ">", 1), head), cut)

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), token)


def attribute_pattern(name: str) -> str:
    """A tag up to the value of an attribute, group 2. Other attributes' values are passed over whole."""
    other = rf"""[\s/]*+(?!(?i:{name})\s*+=)[^\s=>/]++(?:\s*+=\s*+{_VALUE})?+"""
    return rf"\A{NAME}(?:{other})*+[\s/]*+(?i:{name})\s*+=\s*+{_VALUE}"


def value_in(head: Column, name: str) -> Column:
    """Raw value of an attribute in a tag; '' if absent."""
    found = F.regexp_extract(head, attribute_pattern(name), 2)
    return text.once(found, lambda v: F.when(F.rlike(v, F.lit("\\A[\"']")), F.substr(v, F.lit(2), F.char_length(v) - 2)).otherwise(v))


def tag(name: str | None = None, cls: str | None = None, attr: tuple[str, str] | None = None) -> Match:
    """Whether a token is an opening tag of a name, with class tokens, or with an attribute that matches a pattern."""

    def match(token: Column) -> Column:
        tests = []
        if name:
            tests.append(token["name"] == name)
        for each in (cls or "").split():  # a plain search spares most tags the pattern
            tests.append(F.contains(token["head"], F.lit(each)))
        if not name:
            tests.append(~token["name"].startswith("/"))
        for each in (cls or "").split():
            tests.append(F.array_contains(F.split(value_in(token["head"], "class"), r"\s+"), each))
        if attr:
            tests.append(F.contains(F.lower(token["head"]), F.lit(attr[0])))
            tests.append(F.rlike(value_in(token["head"], attr[0]), F.lit(rf"\A(?:{attr[1]})\z")))
        return reduce(Column.__and__, tests)

    return match


def blocks(page: Column, opening: Match) -> Column:
    """Parts of a token array that each start at an opening tag and run to the next one."""

    def parts(whole: Column) -> Column:
        def cut(found: Column) -> Column:
            end = lambda k: F.coalesce(F.get(found, k + 1), F.size(whole))
            return F.transform(found, lambda at, k: F.slice(whole, at + 1, end(k) - at))

        return text.once(F.array_compact(F.transform(whole, lambda t, k: F.when(opening(t), k))), cut)

    return text.once(page, parts)


def _length(names: Column, own: Column, end: Column) -> Column:
    """How many names come up to the end tag of an open element, that one included; 0 if there is none."""
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))

    def step(state: Column, name: Column) -> Column:
        depth = F.when(name == own, 1).when(name == end, -1).otherwise(0)
        return F.when(state["depth"] == 0, state).otherwise(
            F.struct((state["depth"] + depth).alias("depth"), (state["n"] + 1).alias("n"))
        )

    counted = F.aggregate(names, start, step, lambda s: F.when(s["depth"] == 0, s["n"]).otherwise(0))

    def near(found: Column) -> Column:
        # Most elements hold none of their own name and end at the next end tag.
        first, again = found["first"], found["again"]
        return F.when((first == 0) | (again == 0) | (again > first), first).otherwise(counted)

    both = F.struct(
        F.array_position(names, end).cast("int").alias("first"), F.array_position(names, own).cast("int").alias("again")
    )
    return text.once(both, near)


def element(page: Column, opening: Match) -> Column:
    """Tokens of the first matching element, without its end tag; empty if it is absent or never closed."""

    def found(part: Column) -> Column:
        def cut(at: Column) -> Column:
            def closed(rest: Column) -> Column:
                own = F.get(part, at - 1)["name"]
                return text.once(own, lambda name: text.once(F.concat(F.lit("/"), name), lambda end: _length(rest, name, end)))

            rest = F.slice(part["name"], at + 1, F.size(part))
            return F.when(at > 0, F.slice(part, at, text.once(rest, closed))).otherwise(F.slice(part, 1, 0))

        place = F.array_position(F.transform(part, opening), F.lit(True)).cast("int")
        return text.once(place, cut)

    return text.once(page, found)


def words(part: Column) -> Column:
    """Text of some tokens, every run trimmed; character references are left."""
    return F.array_join(F.transform(part, lambda t: text.strip(t["text"])), "")


def attribute(page: Column, opening: Match, name: str) -> Column:
    """Raw value of an attribute of the first matching tag; '' if absent."""
    found = F.get(F.filter(page, opening), F.lit(0))
    return text.text_or_empty(text.once(found, lambda t: value_in(t["head"], name)))


def _code_point(digits: Column, base: int) -> Column:
    number = F.conv(digits, base, 10).try_cast("long")
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    raw = F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0"))
    windows = F.get(F.array(*[F.lit(c) for c in _WINDOWS]), (number - 128).cast("int"))
    return F.when(number.between(128, 159), windows).otherwise(F.coalesce(F.decode(raw, "UTF-32"), F.lit("�")))


def _named(name: Column) -> Column:
    """Characters of a reference name, NULL if there is no such name."""
    line = F.concat(F.lit("\n"), name, F.lit("\t"))
    at = F.instr(F.lit(_TABLE), line)
    rest = F.substr(F.lit(_TABLE), at + F.char_length(line))
    return F.when((name != "") & (at > 0), F.substring_index(rest, "\n", 1))


def _decode_piece(piece: Column) -> Column:
    """A piece that followed an ampersand, its leading character reference decoded."""
    numeric = r"\A#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?"
    decimal = F.regexp_extract(piece, numeric, 1)
    hexadecimal = F.regexp_extract(piece, numeric, 2)
    rest = F.regexp_replace(piece, numeric, "")
    whole_name = F.regexp_extract(piece, r"\A([A-Za-z][A-Za-z0-9]*;)", 1)
    bare_name = F.regexp_extract(piece, r"\A(" + "|".join(_BARE) + ")", 1)
    out = F.when(~F.rlike(piece, F.lit(r"\A[#A-Za-z]")), F.concat(F.lit("&"), piece))
    for name, char in _COMMON.items():
        out = out.when(piece.startswith(name), F.concat(F.lit(char), F.substr(piece, F.lit(len(name) + 1))))
    out = out.when(decimal != "", F.concat(_code_point(decimal, 10), rest))
    out = out.when(hexadecimal != "", F.concat(_code_point(hexadecimal, 16), rest))
    frequent = F.from_json(F.lit(json.dumps(_FREQUENT)), "map<string,string>")
    decoded = F.coalesce(
        F.concat(F.try_element_at(frequent, whole_name), F.substr(piece, F.char_length(whole_name) + 1)),
        F.concat(_named(whole_name), F.substr(piece, F.char_length(whole_name) + 1)),
        F.concat(_named(bare_name), F.substr(piece, F.char_length(bare_name) + 1)),
        F.concat(F.lit("&"), piece),
    )
    return out.otherwise(decoded)


def unescape(c: Column) -> Column:
    """Character references decoded once, as a browser would."""

    def decode(t: Column) -> Column:
        pieces = F.split(t, "&")
        decoded = F.transform(F.slice(pieces, 2, F.size(pieces)), _decode_piece)
        whole = F.concat(F.get(pieces, F.lit(0)), F.array_join(decoded, ""))
        return F.when(F.contains(t, F.lit("&")), whole).otherwise(t)

    return text.once(c, decode)


def escape(c: Column) -> Column:
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))
