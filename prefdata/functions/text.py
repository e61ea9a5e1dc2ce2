"""Text columns. A missing text is the empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions import fixed


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Text without white space at both ends, for the whole Unicode set."""
    return F.btrim(text_or_empty(c), F.lit(fixed.WHITE_SPACE))


def char_count(c: Column | str) -> Column:
    return F.length(text_or_empty(c)).cast("bigint")


def word_count(c: Column | str) -> Column:
    """Number of runs between white space."""
    # Splitting at a plain blank needs no regular expression, and the look ahead keeps
    # the search for other white space to one cheap test per printable character.
    other = f"(?![!-~ ])[{fixed.WHITE_SPACE_CLASS}]"
    pieces = F.split(F.regexp_replace(text_or_empty(c), other, " "), " ")
    return F.size(F.array_remove(pieces, "")).cast("bigint")


def has_digit(c: Column | str) -> Column:
    return text_or_empty(c).rlike(r"\p{Nd}")


def preview(c: Column | str, k: int) -> Column:
    """First ``k`` characters on one line."""
    return F.replace(F.left(text_or_empty(c), F.lit(k)), F.lit("\n"), F.lit(" "))


def word_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(text_or_empty(c), F.lit(fixed.WORD_PATTERN), F.lit(0))


def number_mentions(c: Column | str) -> Column:
    # Every alternative starts with a digit: one look ahead saves trying them all.
    pattern = r"(?=\p{Nd})(?:" + fixed.NUMBER_PATTERN + ")"
    return F.regexp_count(text_or_empty(c), F.lit(pattern))


def mentions_any(c: Column | str, keywords: list[str]) -> Column:
    """True where one of the keywords stands as a whole word, in any case."""
    word = r"[\p{L}\p{N}_]"
    quoted = [r"\Q" + k.replace(r"\E", r"\E\\E\Q") + r"\E" for k in keywords]
    # What stands before a keyword is looked at only where the keyword was found.
    found = "|".join(f"{k}(?<!{word}{k})" for k in quoted)
    return text_or_empty(c).rlike(f"(?iu)(?:{found})(?!{word})")
