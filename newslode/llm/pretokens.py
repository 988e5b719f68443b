"""Splitting a text into the words that byte-level vocabularies merge within."""

from __future__ import annotations

import re
from collections.abc import Callable

#: The splitting pattern for which a faster equal form is known (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, numbers and white space up to U+024F.
LETTER, NUMBER, BLANK = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"


def words_of(pattern: str) -> Callable[[str], list[str]]:
    """A function from a text to its words by the pattern; texts without characters beyond U+024F take a byte-table form of it."""
    import regex

    general = regex.compile(pattern).findall
    if pattern != BYTE_LEVEL:
        return general
    beyond = re.compile("[^\x00-ɏ]").search
    latin = re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+").findall
    return lambda text: general(text) if beyond(text) else latin(text)
