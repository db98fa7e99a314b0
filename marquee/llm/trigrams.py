"""Boolean trigram queries of a pattern: a conjunction of segments, each a list of alternative trigram sets."""

from __future__ import annotations

import itertools
from re import _parser as parser
from re._constants import BRANCH, IN, LITERAL, MAX_REPEAT, SUBPATTERN

MOST_STRINGS = 64
MOST_LETTERS = 5


def _product(heads: set[str], tails: set[str]) -> set[str]:
    return {a + b for a, b in itertools.product(heads, tails)}


def _walk(nodes) -> tuple[set[str] | None, list[set[str]]]:
    """(exact strings or None, required segments) of a sequence of parsed nodes."""
    current: set[str] = {""}
    segments: list[set[str]] = []
    exact = True
    for kind, value in nodes:
        strings: set[str] | None = None
        if kind is LITERAL:
            strings = {chr(value).lower()}
        elif kind is IN and all(k is LITERAL for k, _ in value):
            letters = {chr(x).lower() for _, x in value}
            strings = letters if len(letters) <= MOST_LETTERS else None
        elif kind is SUBPATTERN:
            strings, inner = _walk(value[3])
            if strings is None:
                segments += inner
        elif kind is BRANCH:
            walked = [_walk(branch) for branch in value[1]]
            if all(w[0] is not None for w in walked):
                strings = set().union(*(w[0] for w in walked))
        elif kind is MAX_REPEAT:
            low, high, body = value
            inner_strings, _ = _walk(body)
            if inner_strings is not None and high <= 4 and body[0][0] is not IN:
                strings, power = set(), {""}
                for n in range(high + 1):
                    if n >= low:
                        strings |= power
                    power = _product(power, inner_strings)
        if strings is not None and len(current) * len(strings) <= MOST_STRINGS:
            current = _product(current, strings)
        else:
            segments.append(current)
            current, exact = strings if strings is not None else {""}, False
    if exact:
        return current, []
    return None, [*segments, current]


def query(pattern: str) -> list[list[set[str]]]:
    """Segments that a match must all hold; of a segment, all trigrams of one alternative. Empty: no mandatory trigram.

    Trigrams are of the lower-cased text, so a pattern in either case and one in a fixed case ask the same index. A
    segment with an alternative shorter than three characters asks for nothing and is left out.
    """
    strings, segments = _walk(parser.parse(pattern))
    found = []
    for alternatives in segments if strings is None else [strings]:
        sets = [{s[i : i + 3] for i in range(len(s) - 2)} for s in sorted(alternatives)]
        if sets and all(sets):
            found.append(sets)
    return found
