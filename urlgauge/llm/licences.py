"""Licence scans: Aho-Corasick over phrases and tags, shunting-yard over licence expressions.

Texts are read as words: runs of letters and digits (A-Z lower-cased; a non-ASCII character counts as
one), joined by single spaces. One automaton finds, in one pass,
 - base phrases, which give a label and are counted with their places (overlapping ones too),
 - notice phrases, which name a licence with its version, and
 - identifier tags. What follows a tag on its line, up to a character that can't belong to an
   expression, is parsed as a licence expression: `with` binds tighter than `and`, that tighter
   than `or`; brackets group. Operands are identifiers of the published list (`KNOWN`, or a set of the caller's),
   `LicenseRef-` names, and exceptions after `with`; the expression ends before any other word, so prose after
   a tag names no licence. A broken expression gives no label.

An expression is evaluated to the licences that it names, to those that every choice needs, or to
whether a set of accepted licences satisfies it; each takes one pass, however many choices there are. Labels
are all licences named; `required` and `permitted` say of each expression found what the other two
evaluations give. The score is the strongest evidence: 1 for a valid tag, 0.9 for a notice, 0.6 for a
base phrase alone, 0 for none.

A null or empty text has no words and no labels. Repeated rows and null ids get the same result as any.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices, as normalised words, and the licence that each names.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
NOTICES |= {
    "mit license permission is hereby granted": "mit",
    "licensed under the isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "simplified bsd license": "bsd-2-clause",
    "new bsd license": "bsd-3-clause",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "boost software license version 1 0": "bsl-1.0",
    "eclipse public license v 2 0": "epl-2.0",
    "eclipse public license version 2 0": "epl-2.0",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3.0",
    "gnu affero general public license version 3": "agpl-3.0",
    "creative commons attribution 4 0 international": "cc-by-4.0",
    "creative commons attribution sharealike 4 0 international": "cc-by-sa-4.0",
    "cc0 1 0 universal": "cc0-1.0",
    "do what the fuck you want to public license": "wtfpl",
    "sil open font license version 1 1": "ofl-1.1",
    "python software foundation license version 2": "psf-2.0",
}
# Common identifiers of the published licence list, lower-cased, and its exceptions. GNU licences
# and some others have the endings -only and -or-later as well.
KNOWN = set("""
    0bsd afl-3.0 agpl-1.0 agpl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 beerware blessing
    blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1
    bzip2-1.0.6 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0
    cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl
    ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap fsful ftl gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-3.0 hpnd
    icu ijg imagemagick ipl-1.0 isc json lgpl-2.0 lgpl-2.1 lgpl-3.0 libpng libpng-2.0 libtiff lppl-1.3c mit mit-0 mit-cmu
    mit-modern-variant mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa nist-pd nposl-3.0 odbl-1.0 odc-by-1.0 ofl-1.0
    ofl-1.1 openssl osl-3.0 php-3.0 php-3.01 pddl-1.0 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sleepycat sspl-1.0
    tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zend-2.0 zlib zpl-2.1""".split())
EXCEPTIONS = set("""
    autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0
    font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 gnu-javamail-exception libtool-exception linux-syscall-note
    llvm-exception openjdk-assembly-exception-1.0 openvpn-openssl-exception qt-gpl-exception-1.0 qt-lgpl-exception-1.1
    swift-exception u-boot-exception-2.0 universal-foss-exception-1.0 wxwindows-exception-3.1""".split())
ENDING = re.compile(r"(?:-only|-or-later|\+)$")
TAGS = ("spdx license identifier",)
TAG = re.compile(r"spdx[-_ ]license[-_ ]identifier[ \t]*[:=]?[ \t]*", re.I)
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+\-]+")
NEXT = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+\-]+)")
BINDS = {"or": 1, "and": 2, "with": 3}

_FOLD = bytearray(b" " * 256)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _FOLD[_b] = _b
for _b in range(65, 91):
    _FOLD[_b] = _b + 32
_FOLD = bytes(_FOLD)


def postfix(expression: str) -> list[str]:
    """Shunting-yard: tokens in postfix order. Raises ValueError for anything malformed."""
    out, stack, operand = [], [], True  # operand: one is expected next
    for token in TOKEN.findall(expression):
        low = token.lower()
        if low in BINDS:
            if operand:
                raise ValueError("operator without an operand")
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif token == "(":
            if not operand:
                raise ValueError("bracket after an operand")
            stack.append(token)
        elif token == ")":
            if operand:
                raise ValueError("empty bracket")
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError("unmatched bracket")
            stack.pop()
        else:
            if not operand:
                raise ValueError("two operands in a row")
            out.append(low)
            operand = False
    if operand:
        raise ValueError("it ends without an operand")
    while stack:
        if stack[-1] == "(":
            raise ValueError("unmatched bracket")
        out.append(stack.pop())
    return out


def evaluate(expression: str, leaf, join):
    """The value of an expression: `leaf(licence)` of its operands, `join(operator, left, right)` above them.

    `a with b` is the one licence `a with b`. Raises ValueError for a malformed expression."""
    stack = []  # (name, None) of a licence on its own, (None, value) of anything joined

    def value(entry):
        return leaf(entry[0]) if entry[0] is not None else entry[1]

    for token in postfix(expression):
        if token not in BINDS:
            stack.append((token, None))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if left[0] is None or right[0] is None:
                raise ValueError("with joins a licence and an exception")
            stack.append((f"{left[0]} with {right[0]}", None))
        else:
            stack.append((None, join(token, value(left), value(right))))
    return value(stack[0])


def licences(expression: str) -> set[str]:
    """All licences that an expression names."""
    names: set[str] = set()
    evaluate(expression, names.add, lambda *_: None)
    return names


def required(expression: str) -> frozenset[str]:
    """The licences that apply whichever alternatives are chosen."""
    def join(operator, a, b):
        if len(a) < len(b):
            a, b = b, a
        if operator != "and":
            return a & b
        a |= b  # the smaller into the larger: long expressions are not copied at each operator
        return a

    return frozenset(evaluate(expression, lambda name: {name}, join))


def permitted(expression: str, accepted: set[str]) -> bool:
    """Whether some choice among the alternatives needs accepted licences only."""
    return evaluate(expression, accepted.__contains__,
                    lambda operator, a, b: (a and b) if operator == "and" else (a or b))


def names_licence(word: str, known: set[str] = KNOWN) -> bool:
    low = word.lower().rstrip(".")
    return low in known or ENDING.sub("", low) in known or low.startswith("licenseref-")


def expressions(text: str, known: set[str] = KNOWN) -> list[str]:
    """What follows the tags of a text: the longest beginning of the line's expression that parses, of known operands."""
    found = []
    for tag in TAG.finditer(text):
        # Prose may follow a tag on its line, so take words as long as operands and operators alternate.
        end, operand, depth, excepted = None, True, 0, False
        w = NEXT.match(text, tag.end())
        while w:
            low = w.group(1).lower()
            if low in BINDS:
                if operand:
                    break
                operand, excepted = True, low == "with"
            elif low == "(":
                if not operand:
                    break
                depth += 1
            elif low == ")":
                if operand or not depth:
                    break
                depth -= 1
            else:
                if not operand or not (low.rstrip(".") in EXCEPTIONS if excepted else names_licence(low, known)):
                    break
                operand, excepted = False, False
            if not operand and not depth:
                end = w.end()
            w = NEXT.match(text, w.end())
        if end:
            found.append(text[tag.end():end].strip().rstrip("."))
    return found


def automaton():
    """Phrases between spaces; the value says what was found."""
    a = ahocorasick.Automaton()
    wanted: dict[str, list] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            wanted.setdefault(f" {phrase} ", []).append((kind, label))
    for phrase, values in wanted.items():
        a.add_word(phrase, (len(phrase), values))
    a.make_automaton()
    return a


def scan(text: str | None, a) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions)."""
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    joined = " " + b" ".join(words).decode("utf-8", "replace") + " "
    places, base, labels, score, tagged = [], set(), set(), 0.0, False
    for end, (length, values) in a.iter(joined):
        for kind, label in values:
            if kind == "base":
                places.append(end - length + 1)
                base.add(label)
                score = max(score, 0.6)
            elif kind == "notice":
                labels.add(label)
                score = max(score, 0.9)
            else:
                tagged = True
    named = []
    for expression in expressions(text) if tagged else ():
        try:
            labels |= licences(expression)
        except ValueError:
            continue
        named.append(expression)
        score = 1.0
    at = [joined.count(" ", 0, p) for p in (min(places), max(places))] if places else [None, None]
    return (len(words), len(places), *at, ",".join(sorted(base)), ",".join(sorted(base | labels)), score, named)


SCHEMA = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, score double, expressions array<string>, required array<string>, permitted array<boolean>")


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   accepted: set[str] | None = None) -> DataFrame:
    """One row per document: doc_id and the columns of SCHEMA. `expressions` are the valid ones found. For each,
    `required` has the licences that apply whichever alternatives are chosen (sorted, joined by commas), and
    `permitted` whether the licences `accepted` (lower-cased names) suffice; null without such a set."""
    ship(docs.sparkSession)
    def run(batches):
        a = automaton()
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), *[pa.list_(pa.string())] * 2, pa.list_(pa.bool_())]
        names = ["doc_id", *(c.split()[0] for c in SCHEMA.split(", "))]
        for batch in batches:
            rows = []
            for t in batch.column(1):
                found = scan(t.as_py(), a)
                always = [",".join(sorted(required(e))) for e in found[-1]]
                rows.append((*found, always, None if accepted is None else [permitted(e, accepted) for e in found[-1]]))
            columns = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id bigint, {SCHEMA}")
