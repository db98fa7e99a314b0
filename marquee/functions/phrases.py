"""Whether a lexicon is small enough to be sent to where the words are."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Terms that are broadcast; a larger lexicon is joined by term instead.
MOST_TERMS = 20_000


def fits(lexicon: DataFrame, most: int = MOST_TERMS) -> bool:
    """Whether a lexicon has at most so many rows; it is read no further."""
    return lexicon.limit(most + 1).count() <= most
