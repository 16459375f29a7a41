"""Text expressions: tokens, stop words, scrubbing, search and highlighting."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.vocabulary import STOP_WORDS

REGEX_SPECIALS = set(".*+?^${}()|[]\\/-&#~")


def tokens(text: Column) -> Column:
    """Lower-case ``text`` and split it at single whitespace characters.

    Matches ``ml.feature.Tokenizer``: inner and leading empty tokens are kept,
    trailing ones are dropped, the empty text is one empty token and a text of only
    whitespace has none. Null counts as the empty text.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    body = F.regexp_replace(lowered, r"\s+$", "")
    return (
        F.when(lowered == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, r"\s"))
    )


def is_kept_word(token: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """True for a (lower-case) token that is not a stop word."""
    words = sorted(set(stop_words))
    return ~token.isin(words) if words else F.lit(True)


def scrub(text: Column) -> Column:
    """Delete every character but ASCII letters, digits and whitespace."""
    return F.regexp_replace(text, r"[^a-zA-Z0-9\s]", "")


def quote_pattern(term: str) -> str:
    """``term`` as a regular expression that matches just itself."""
    return "".join("\\" + ch if ch in REGEX_SPECIALS else ch for ch in term)


def contains_ci(text: Column, term: str, regex: bool = False) -> Column:
    """Case-insensitive containment; the term is literal unless ``regex`` is set."""
    if regex:
        return text.rlike("(?iu)" + term)
    return F.lower(text).contains(F.lower(F.lit(term)))


def highlight(text: Column, term: str | None, regex: bool = False) -> Column:
    """Wrap each case-insensitive match of ``term`` in ``<em>``."""
    if not term:
        return text
    pattern = term if regex else quote_pattern(term)
    return F.regexp_replace(text, f"(?iu)({pattern})", "<em>$1</em>")
