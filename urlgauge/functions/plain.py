"""Features of plain URLs, found for many rows at once in one Arrow function.

A URL is plain if, once trimmed, it is printable ASCII without spaces, with a host, no brackets in its authority and no port
of more than four digits. The parts of all others are left to the expressions of `features`, which say the same of plain ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..plans import workers
from . import hosts

STEP = 1 << 20  # bytes at once, but at least a text
ROWS = 4096     # texts at once
_SPACES = "".join(c for c in map(chr, range(128)) if c.isspace())
_FLOATS = {"digit_ratio", "mass", "homoglyph_char_ratio"}
_CODES = np.arange(256)


def _marks(characters: str) -> np.ndarray:
    return np.isin(_CODES, [ord(c) for c in characters])


_LOWER = np.where((_CODES >= ord("A")) & (_CODES <= ord("Z")), _CODES + 32, _CODES).astype(np.uint8)
_DIGIT = _marks("0123456789")
_LETTER = (_LOWER >= ord("a")) & (_LOWER <= ord("z"))
_PLAIN = (_CODES > 0x20) & (_CODES < 0x7F)
_SPECIAL = ~(_DIGIT | _LETTER | _marks("./:-"))[:128]
_BEYOND_SCHEME = ~(_DIGIT | _LETTER | _marks("+.-"))
_ALIKE = _marks(K.LOOKALIKE_CHARS + K.LOOKALIKE_CHARS.upper())
_BRANDS = "|".join(K.BRAND_TOKENS)


def _spans(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, each: int = 1) -> pa.Array:
    """Texts of the given spans, `each` spans in a row as one text."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
    offsets = np.concatenate([[0], ends[each - 1::each]])
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters[at])])


def _next(places: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """The first of the sorted `places` from `at` on."""
    return np.append(places, none)[np.searchsorted(places, at)]


def _last(places: np.ndarray, before: np.ndarray, back: int = 1) -> np.ndarray:
    """The last of the sorted `places` before `before`, or one further back; -1 where there is none."""
    return np.append(np.full(back, -1), places)[np.searchsorted(places, before)]


def _in(texts: pa.Array, values: list[str]) -> np.ndarray:
    return pc.is_in(texts, value_set=pa.array(values, texts.type)).to_numpy(zero_copy_only=False)


def _chunk(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, pa.Array]:
    """Values of some texts, which of them go beyond ASCII, and their hosts. Where `plain` is 0, only counts hold."""
    size, count = len(data), len(offsets) - 1
    starts, ends = offsets[:-1], offsets[1:]
    lengths = ends - starts
    b = np.append(data, np.zeros(4, np.uint8))  # looking ahead stays inside
    low = np.append(_LOWER[data], np.uint8(ord(" ")))
    found = np.bincount(np.repeat(np.arange(count) * 128, lengths) + (data & 127), minlength=count * 128).reshape(-1, 128)
    known = np.arange(found.max(initial=0) + 1)
    known = known * np.log2(np.maximum(known, 1))

    def where(condition):
        return np.flatnonzero(condition)

    def inside(table, left, right):
        sums = np.zeros(size + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return sums[right] - sums[left]

    colons, dots = where(data == ord(":")), where(data == ord("."))
    doubles = where((data == ord("/")) & (b[1:size + 1] == ord("/")))
    seps = colons[(b[colons + 1] == ord("/")) & (b[colons + 2] == ord("/"))]
    sep = _next(seps, starts, size)
    split = sep + 3 <= ends
    named = split & (sep > starts) & _LETTER[b[starts]] & (inside(_BEYOND_SCHEME, starts, np.where(split, sep, starts)) == 0)
    https = named & (sep - starts == 5)
    for i, c in enumerate(b"https"):
        https &= _LOWER[b[np.minimum(starts + i, size)]] == c
    rest = np.where(named, sep + 3, starts)
    marks, hashes = where((data == ord("?")) | (data == ord("#"))), where(data == ord("#"))
    stop = np.minimum(_next(np.sort(np.concatenate([marks, where(data == ord("/"))])), rest, size), ends)
    path = np.minimum(_next(marks, stop, size), ends) - stop
    asked = _next(where(data == ord("?")), starts, size)
    fragment = np.minimum(_next(hashes, starts, size), ends)
    user = _last(where(data == ord("@")), stop)
    host = np.where(user >= rest, user + 1, rest)
    colon = np.minimum(_next(colons, host, size), stop)
    host_size, port = colon - host, np.maximum(stop - colon - 1, 0)
    broken = where(~_PLAIN[data])
    plain = ((host_size > 0) & (_next(broken, starts, size) >= ends) & (inside(_marks("[]"), rest, stop) == 0)
             & (port <= 4) & (inside(_DIGIT, stop - port, stop) == port))

    points, host_digits = inside(_marks("."), host, colon), inside(_DIGIT, host, colon)
    last, second = _last(dots, colon), _last(dots, colon, 2)
    domain = np.where(second >= host, second + 1, host)
    suffix = np.where(last >= host, last + 1, colon)
    maybe = where(plain & (points == 3) & (points + host_digits == host_size))
    ip = np.zeros(count, bool)
    if len(maybe):
        ip[maybe] = pc.match_substring_regex(_spans(low, host[maybe], host_size[maybe]), hosts.IPV4_PATTERN).to_numpy(zero_copy_only=False)
    coded = where((low[:size] == ord("x")) & (b[1:size + 1] | 32 == ord("n")) & (b[2:size + 2] == ord("-")) & (b[3:size + 3] == ord("-")))
    first = np.minimum(_next(dots, domain, size), colon)
    # The host before its domain, a space and the path.
    triple = np.stack([host, np.full(count, size), stop], 1).ravel(), np.stack([domain - host, np.ones(count, np.int64), path], 1).ravel()
    brand = pc.match_substring_regex(_spans(low, *triple, 3), _BRANDS).to_numpy(zero_copy_only=False)
    brand &= ~_in(_spans(low, domain, first - domain), K.BRAND_TOKENS)
    digits = found[:, _DIGIT[:128]].sum(axis=1)
    bare = host_size - points
    beyond = _next(where(data >= 128), starts, size) < ends
    return {
        "plain": plain, "url_length": lengths, "hostname_length": host_size, "path_length": path,
        "query_length": np.where(asked < fragment, fragment - asked - 1, 0),
        "digit_count": digits, "digit_ratio": digits / np.maximum(lengths, 1),
        "special_char_count": found[:, _SPECIAL].sum(axis=1),
        "hyphen_count": found[:, ord("-")], "dot_count": found[:, ord(".")], "slash_count": found[:, ord("/")],
        "mass": known[found].sum(axis=1), "has_ip_address": ip,
        "subdomain_count": np.where(ip, 0, np.maximum(points - 1, 0)),
        "hostname_hyphen_count": inside(_marks("-"), host, colon), "hostname_digit_count": host_digits,
        "is_known_shortener": _in(_spans(low, domain, colon - domain), K.SHORTENER_DOMAINS),
        "has_punycode": _next(coded, host, size) + 4 <= colon,
        "homoglyph_char_ratio": np.where(bare == 0, 0.0, inside(_ALIKE, host, colon) / np.maximum(bare, 1)),
        "percent_encoded_count": found[:, ord("%")], "brand_token_in_subdomain_or_path": brand,
        "tld_length": colon - suffix, "is_suspicious_tld": _in(_spans(low, suffix, colon - suffix), K.SUSPICIOUS_TLDS),
        "uses_https": https, "has_at_symbol": found[:, ord("@")] > 0, "has_port": port > 0,
        "has_double_slash_redirect": _next(doubles, np.where(split, sep + 3, starts), size) + 2 <= ends,
    }, beyond, _spans(low, host, np.maximum(host_size, 0))


def measure(texts: pa.Array, foreign: pa.Array | None = None) -> pa.Array:
    """A struct per text in ASCII: `plain`, the features, with `mass`, the sum of c * log2 c over its characters' counts c,
    in place of the entropy. If it isn't plain, only counts of characters hold; for texts beyond ASCII nothing does, and
    `mass` is null. With `foreign`, names to spell or null, there are also `host` and `spelled`."""
    given = pc.ascii_trim(texts.cast(pa.large_string()), characters=_SPACES)
    _, offsets, data = given.buffers()
    ends = np.frombuffer(offsets, np.int64, len(given) + 1, given.offset * 8) if len(given) else np.zeros(1, np.int64)
    letters = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    parts, start = [], 0
    while start < len(given):
        stop = max(start + 1, min(start + ROWS, int(np.searchsorted(ends, ends[start] + STEP, "right")) - 1))
        parts.append(_chunk(letters[ends[start]:ends[stop]], ends[start:stop + 1] - ends[start]))
        start = stop
    beyond = np.concatenate([p[1] for p in parts] or [np.zeros(0, bool)]) | np.asarray(given.is_null())
    columns = [pa.array(np.concatenate([p[0][n] for p in parts] or [[]]).astype(np.float64 if n in _FLOATS else np.int32),
                        mask=beyond if n == "mass" else None) for n in NAMES]
    if foreign is None:
        return pa.StructArray.from_arrays(columns, NAMES)
    found = pa.concat_arrays([p[2] for p in parts]) if parts else pa.array([], pa.large_string())
    return pa.StructArray.from_arrays([*columns, found.cast(pa.string()), hosts.spelled(foreign)], [*NAMES, "host", "spelled"])


NAMES = ["plain", *("mass" if n == "entropy" else n for n in K.FEATURES)]


def _alone(texts: pa.Array) -> pa.Array:
    return measure(texts)


def _with_hosts(texts: pa.Array, foreign: pa.Array) -> pa.Array:
    return measure(texts, foreign)


def measured(df: DataFrame, url: str, foreign: str | None = None) -> Column:
    """`measure` as a column of `df`. Not deterministic to the optimizer only: else it copies the function, and with it all
    expressions on its results, into each other."""
    workers.ship(df.sparkSession)
    kinds = ", ".join(f"{n} {'double' if n in _FLOATS else 'int'}" for n in NAMES)
    if foreign:
        return F.arrow_udf(_with_hosts, kinds + ", host string, spelled string").asNondeterministic()(F.col(url), F.col(foreign))
    return F.arrow_udf(_alone, kinds).asNondeterministic()(F.col(url))
