"""String columns: trimming, capping, placeholders, name candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import fixed

# Every character that str.strip() removes, so results do not depend on the engine's idea of a blank.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use(c)` with `c` evaluated a single time, however often `use` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITESPACE))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def filled(c: Column) -> Column:
    """True when a text is neither missing nor empty."""
    return F.coalesce(c != "", F.lit(False))


def first_filled(*cols: Column) -> Column:
    """First text that is neither missing nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def mentions(c: Column, phrase: str) -> Column:
    return F.contains(F.lower(text_or_empty(c)), F.lit(phrase))


def cap(c: Column, limit: int = fixed.DESCRIPTION_CHARS) -> Column:
    """Texts over `limit` characters are cut, right-trimmed and marked with an ellipsis."""
    cut = F.concat(rstrip(F.substring(c, 1, limit)), F.lit(fixed.ELLIPSIS))
    return F.when(F.char_length(c) > limit, cut).otherwise(c)


def truncate_body(c: Column, limit: int = fixed.BODY_CHARS) -> Column:
    """What is shown of a fetched body: over `limit` characters it is cut and says so."""
    mark = F.lit(fixed.TRUNCATION_MARK.format(n=limit))
    return F.when(F.char_length(c) > limit, F.concat(F.substring(c, 1, limit), mark)).otherwise(c)


def is_placeholder(c: Column) -> Column:
    """True for an unconfirmed value written as *(...)*."""
    t = strip(text_or_empty(c))
    return t.startswith("*(") & t.endswith(")*")


def unwrap_placeholder(c: Column) -> Column:
    t = strip(text_or_empty(c))
    inner = strip(F.substr(t, F.lit(3), F.char_length(t) - 4))
    return F.when(is_placeholder(c), inner).otherwise(t)


def is_challenge_page(c: Column) -> Column:
    body = F.lower(text_or_empty(c))
    found = F.lit(False)
    for marker in fixed.CHALLENGE_MARKERS:
        found = found | F.contains(body, F.lit(marker))
    return found


def venue_key(address: Column, venue: Column) -> Column:
    """Key of the weekly venue cap: the address, else the venue up to its first comma."""
    by_name = F.lower(strip(F.split_part(text_or_empty(venue), F.lit(","), F.lit(1))))
    return F.when(filled(address), F.lower(strip(address))).otherwise(by_name)


def series_prefix(title: Column) -> Column:
    """Lower-cased text before the first separator that leaves a prefix, else NULL."""
    options = []
    for sep in fixed.SERIES_SEPARATORS:
        at = F.instr(title, sep)
        prefix = strip(F.substr(title, F.lit(1), at - 1))
        options.append(F.when((at > 0) & (prefix != ""), F.lower(prefix)))
    return F.coalesce(*options)


def headliner_names(title: Column) -> Column:
    """Names to look up for a title, most specific first: the title, then the head of each side of a colon."""
    t = strip(title)
    colon = F.instr(t, ":")
    before = strip(F.substr(t, F.lit(1), colon - 1))
    after = strip(F.substr(t, colon + 1))
    sides = F.when(colon > 0, F.array(before, after)).otherwise(F.array(t))
    heads = F.transform(sides, lambda s: strip(F.get(F.split(s, fixed.ACT_SEPARATORS, 2), F.lit(0))))
    return F.array_distinct(F.concat(F.array(t), F.filter(heads, lambda h: h != "")))


def failure_note(raw: Column) -> Column:
    """'name (reason)' becomes 'name unavailable this week (reason)'."""
    t = strip(raw)
    at = F.instr(t, "(")
    named = F.concat(
        strip(F.substr(t, F.lit(1), at - 1)), F.lit(" unavailable this week ("), F.substr(t, at + 1)
    )
    return F.when(at > 0, named).otherwise(F.concat(t, F.lit(" unavailable this week")))
