"""Character classes derived by rule from the Unicode database."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache


def _ranges(accept) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for point in range(sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF or not accept(chr(point)):
            continue
        if spans and spans[-1][1] == point - 1:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return [(a, b) for a, b in spans]


def _class(spans) -> str:
    one = r"\x{%x}"
    return "".join(one % a if a == b else (one + "-" + one) % (a, b) for a, b in spans)


@lru_cache(maxsize=None)
def whitespace() -> str:
    """Every white-space character, as a plain string for trimming."""
    return "".join(chr(c) for a, b in _ranges(str.isspace) for c in range(a, b + 1))


@lru_cache(maxsize=None)
def whitespace_class() -> str:
    return _class(_ranges(str.isspace))


@lru_cache(maxsize=None)
def digit_class() -> str:
    """Decimal digits plus the digits (superscript, circled, ...) that are not decimal."""
    extra = _ranges(lambda c: c.isdigit() and unicodedata.category(c) != "Nd")
    return r"\p{Nd}" + _class(extra)


@lru_cache(maxsize=None)
def delimiter_lookalike_class() -> str:
    """Characters that turn into a URL delimiter under NFKC; illegal in an authority."""
    return _class(_ranges(
        lambda c: unicodedata.decomposition(c)
        and set(unicodedata.normalize("NFKC", c)) & set("/?#@:")))
