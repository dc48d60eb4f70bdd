"""License scans: one Aho-Corasick automaton finds notice phrases over the words of a text, another
finds identifier tags in the raw text; a shunting-yard parser evaluates the and/or/with expression
behind each tag.

Null or empty text: no words, no places, no labels, score 0. Overlapping and repeated places all
count. An expression ends at the line end or at the first token that the grammar cannot take, so a
very long line costs no more than its valid start; an operator without a right side is dropped.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from centroidal.llm.frames import as_bytes, map_batches, scan_words

# --- fixed values: base phrases and labels of the contract ---
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# --- fixed values: notice phrases of well-known licences ---
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "gnu general public license": "gpl",
    "gnu free documentation license": "gfdl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "sil open font license": "ofl",
    "the unlicense": "unlicense",
    "without warranty of any kind": "no-warranty",
    "provided as is": "no-warranty",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "released into the public domain": "public-domain",
}

# --- fixed values: identifier tags, and identifiers with how much they restrict reuse ---
TAGS = ("spdx-license-identifier:", "license:", "licence:", "licensed under")
RESTRICTS = {
    "mit": 0, "apache-2.0": 0, "bsd-2-clause": 0, "bsd-3-clause": 0, "isc": 0, "zlib": 0, "0bsd": 0,
    "unlicense": 0, "cc0-1.0": 0, "cc-by-4.0": 0, "bsl-1.0": 0,
    "mpl-2.0": 1, "epl-2.0": 1, "lgpl-2.1": 1, "lgpl-2.1-only": 1, "lgpl-2.1-or-later": 1,
    "lgpl-3.0": 1, "lgpl-3.0-only": 1, "lgpl-3.0-or-later": 1, "cc-by-sa-4.0": 1,
    "gpl-2.0": 2, "gpl-2.0-only": 2, "gpl-2.0-or-later": 2, "gpl-3.0": 2, "gpl-3.0-only": 2,
    "gpl-3.0-or-later": 2, "agpl-3.0": 2, "agpl-3.0-only": 2, "agpl-3.0-or-later": 2,
    "cc-by-nc-4.0": 3, "cc-by-nd-4.0": 3,
    "mit-0": 0, "bsd-4-clause": 0, "artistic-2.0": 0, "ecl-2.0": 0, "postgresql": 0, "python-2.0": 0, "psf-2.0": 0, "wtfpl": 0, "ncsa": 0,
    "openssl": 0, "x11": 0, "hpnd": 0, "afl-3.0": 0, "ms-pl": 0, "upl-1.0": 0, "apache-1.1": 0, "cc-by-3.0": 0, "cc-by-2.0": 0, "pddl-1.0": 0,
    "ofl-1.1": 1, "cddl-1.0": 1, "cddl-1.1": 1, "epl-1.0": 1, "mpl-1.1": 1, "lgpl-2.0": 1, "lgpl-2.0-only": 1, "lgpl-2.0-or-later": 1,
    "cc-by-sa-3.0": 1, "odbl-1.0": 1, "ms-rl": 1,
    "gpl-1.0": 2, "gpl-1.0-only": 2, "gpl-1.0-or-later": 2, "eupl-1.2": 2, "osl-3.0": 2, "agpl-1.0": 2, "cecill-2.1": 2,
    "cc-by-nc-3.0": 3, "cc-by-nc-sa-4.0": 3, "cc-by-nc-nd-4.0": 3, "sspl-1.0": 3, "busl-1.1": 3,
}
UNKNOWN_RESTRICTS = 3
GRADES = ("permissive", "weak-copyleft", "copyleft", "restricted")

#: Evidence weights, joined as 1 - product(1 - w).
W_EXPRESSION, W_BASE, W_NOTICE = 0.95, 0.6, 0.5

SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expressions array<string>, grade string")
_TYPES = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
          ("expressions", pa.list_(pa.string())), ("grade", pa.string())]


@cache
def phrase_automaton() -> ahocorasick.Automaton:
    """Phrases with a blank on both sides, so that only whole words match."""
    auto = ahocorasick.Automaton()
    found: dict[str, list] = {}
    for phrase, label in NOTICES.items():
        found.setdefault(phrase, []).append((label, False))
    for phrase, label in BASE_PHRASES.items():
        found.setdefault(phrase, []).append((label, True))
    for phrase, labels in found.items():
        auto.add_word(f" {phrase} ", (phrase.count(" ") + 1, tuple(labels)))
    auto.make_automaton()
    return auto


@cache
def tag_automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for tag in TAGS:
        auto.add_word(tag, tag)
    auto.make_automaton()
    return auto


def identifier(word: str) -> str:
    """An identifier as it is graded: a plus sign behind a version means that one or any later."""
    plain = word.rstrip("+")
    return word if plain == word else f"{plain}-or-later" if f"{plain}-or-later" in RESTRICTS else plain


_TOKEN = re.compile(r"[ \t]*(?:(\()|(\))|([a-z0-9][a-z0-9.+-]*))", re.IGNORECASE)
_RANK = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str, start: int = 0) -> tuple[list[str], list[str]] | None:
    """The longest licence expression at ``start``: (its identifiers, its postfix form), or None.

    Shunting-yard: ``with`` binds before ``and`` before ``or``; all group from the left. Scanning
    stops at the first token out of place; what is open then is closed, a dangling operator dropped.
    """
    end = text.find("\n", start)
    end = len(text) if end < 0 else end
    out: list[str] = []
    stack: list[str] = []
    ids: list[str] = []
    want = True
    while m := _TOKEN.match(text, start, end):
        open_, close, word = m.groups()
        word = word and word.lower().rstrip(".")
        if open_ and want:
            stack.append("(")
        elif close and not want and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif word in _RANK and not want:
            while stack and _RANK.get(stack[-1], 0) >= _RANK[word]:
                out.append(stack.pop())
            stack.append(word)
            want = True
        elif word and word not in _RANK and want:
            word = identifier(word)
            out.append(word)
            ids.append(word)
            want = False
        else:
            break
        start = m.end()
    while want and stack:  # a dangling operator, or brackets opened with nothing in them
        if stack.pop() in _RANK:
            want = False
    out += [x for x in reversed(stack) if x != "("]
    return (ids, out) if ids else None


def restricts(postfix: list[str]) -> int:
    """Evaluate a postfix expression: ``or`` lets the user take the freer side, ``and`` binds to the
    stricter one, an exception (``with``) takes one grade off a copyleft licence."""
    stack: list[int] = []
    for x in postfix:
        if x not in _RANK:
            stack.append(RESTRICTS.get(x, UNKNOWN_RESTRICTS))
            continue
        b, a = stack.pop(), stack.pop()
        stack.append(min(a, b) if x == "or" else max(a, b) if x == "and" else a - 1 if a in (1, 2) else a)
    return stack[0]


def scan(text: bytes | None) -> tuple:
    """One text's row, in the order of ``SCHEMA``."""
    words = scan_words(text or b"")
    joined = f" {b' '.join(words).decode('latin-1')} "
    n_base, first, last = 0, None, None
    base: set[str] = set()
    labels: set[str] = set()
    doubt = 1.0
    seen, at = 0, -1  # at: words that ended up to the place seen
    for end, (n, found) in phrase_automaton().iter(joined):
        at += joined.count(" ", seen, end + 1)
        seen = end + 1
        for label, is_base in found:
            if is_base:
                word = at - n
                n_base += 1
                first = word if first is None else min(first, word)
                last = word if last is None else max(last, word)
                base.add(label)
            if label not in labels:
                doubt *= 1 - (W_BASE if is_base else W_NOTICE)
            labels.add(label)
    raw = (text or b"").lower().decode("latin-1")
    expressions: dict[str, int] = {}
    for end, tag in tag_automaton().iter(raw):
        parsed = parse_expression(raw, end + 1)
        if not parsed or (not tag.startswith("spdx") and parsed[0][0] not in RESTRICTS):
            continue
        ids, postfix = parsed
        expressions.setdefault(" ".join(postfix), restricts(postfix))
        exceptions = {postfix[i - 1] for i, x in enumerate(postfix) if x == "with"}
        labels.update(x for x in ids if x not in exceptions)
    if expressions:
        doubt *= 1 - W_EXPRESSION
    grade = GRADES[max(expressions.values())] if expressions else None
    return (len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - doubt,
            sorted(expressions), grade)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence places, labels, parsed expressions and score of every whole text.

    Returns ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score,
    expressions, grade``; one row per input row, other columns are left out.
    """
    kept = docs.select(id_col, text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = list(zip(*map(scan, as_bytes(b.column(1)))))
        return pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(col, kind) for col, (_, kind) in zip(rows, _TYPES))],
            names=[id_col, *(n for n, _ in _TYPES)])

    return map_batches(kept, batch, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, {SCHEMA}")
