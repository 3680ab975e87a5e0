"""License scan: Aho-Corasick over the words of a text, shunting-yard over tag expressions.

A text is reduced to its words (runs of digits, a-z after lower-casing A-Z, and characters
beyond ASCII), joined by single spaces.  One automaton holds all notice phrases and the
identifier tag, each with a space at both ends, so every match is a match of whole words;
overlapping matches are all reported.  Where the tag matches, the expression behind each tag is
taken from the original text and evaluated.  It ends where the grammar ends (prose, punctuation, the next
tag) and at the line's end; behind a tag that ends its line it is read from the next line, unless prose goes on
there.  A word of prose behind an operator ("MIT or later") can't be told from an identifier.  ``or`` binds weakest, then ``and``, then
``with``; parentheses group.  An expression yields the identifiers it names and a
restriction level: ``or`` lets the reader choose (the lower level), ``and`` binds them to
both (the higher), ``with`` takes one level off.

Score: the strongest evidence in the text: 1.0 a tag with a well-formed expression, 0.8 a base phrase,
0.6 another phrase, 0.3 a tag whose expression can't be parsed, 0.0 none.

Defined results: a null or empty text has no words and no labels (empty strings, null
positions, score 0); repeated rows give repeated results; extra columns are ignored; an expression
that can't be parsed, or that a line's end cuts off behind an operator or within brackets, yields no labels.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from .common import map_texts

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Further phrases of common notices.
MORE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
_WORD, _GAP = rb"[0-9a-z\x80-\xff]", rb"[^0-9a-z\x80-\xff]+"
TAG_MARK = re.compile(rb"(?<!" + _WORD + rb")spdx" + _GAP + rb"license" + _GAP + rb"identifier(?!" + _WORD + rb")[ \t]*[:=]?[ \t]*", re.I)
LINE = re.compile(rb"[^\r\n]*")
NEXT_LINE = re.compile(rb"\r?\n[ \t*#;/!-]*")  # with what opens a line of a comment
CLOSER = re.compile(r"\s*(\*/|-->|#}|%>).*$")
SPACE = re.compile(r"\s*")
OPERAND = re.compile(r"[0-9a-z][0-9a-z.+:-]*", re.I | re.A)
RESTRICTION = {"agpl": 3, "gpl": 3, "lgpl": 2, "mpl": 2, "epl": 2, "cc-by-nc": 3, "cc-by-sa": 2}
BINDS = {"or": 1, "and": 2, "with": 3}

#: Word characters stay, A-Z become a-z, everything else a space.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def restriction(identifier: str) -> int:
    """Level of one identifier: 1 (permissive) unless a listed family's name begins it."""
    return max((level for family, level in RESTRICTION.items() if identifier.startswith(family)), default=1)


def evaluate(expression: str) -> tuple[list[str], int] | None:
    """(identifiers in lower case, restriction level) of an expression; None if it is malformed."""
    tokens = re.findall(r"[()]|[^\s()]+", expression.lower())
    output: list[str] = []
    stack: list[str] = []
    operand = True  # what must come next
    for t in tokens:
        if t == "(":
            if not operand:
                return None
            stack.append(t)
        elif t == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif t in BINDS:
            if operand:
                return None
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[t]:
                output.append(stack.pop())
            stack.append(t)
            operand = True
        else:
            if not operand or not re.fullmatch(r"[0-9a-z][0-9a-z.+:-]*", t):
                return None
            output.append(t)
            operand = False
    if operand or "(" in stack:
        return None
    output += reversed(stack)
    values: list[tuple[set[str], int]] = []
    for t in output:
        if t in BINDS:
            (right, b), (left, a) = values.pop(), values.pop()
            level = min(a, b) if t == "or" else max(a, b) if t == "and" else max(1, a - 1)
            values.append((left | right, level))
        else:
            values.append(({t}, restriction(t)))
    names, level = values[0]
    return sorted(names), level


def leading_expression(line: str, cut_off: bool = True) -> str | None:
    """The longest well-formed expression at the beginning of ``line``; None if there is none.

    cut_off: the line's end is an end of line, so an operator or an open bracket there means that a part is missing.
    """
    at, good, depth, operand = 0, 0, 0, True
    while True:
        at = SPACE.match(line, at).end()
        if at == len(line):
            if cut_off and (operand or depth):
                return None
            break
        if line[at] in "()":
            if operand != (line[at] == "("):
                break
            depth += 1 if operand else -1
            if depth < 0:
                break
            at += 1
        else:
            m = OPERAND.match(line, at)
            after = line[m.end() : m.end() + 1] if m else ""
            if not m or after in ("_", "/", "@") or after > "\x7f":
                break
            name = m[0].rstrip(".:-")
            binds = name.lower() in BINDS
            if operand == binds:
                break
            operand, at = binds, at + len(name)
            if not operand and not depth:
                good = at
            if len(name) < len(m[0]):
                break  # punctuation
            continue
        if not operand and not depth:
            good = at
    return line[:good].strip() or None


def tag_expressions(text: bytes):
    """What each tag of a text says: (the expression, or what stands in its place, its value or None)."""
    marks = list(TAG_MARK.finditer(text))
    for i, m in enumerate(marks):
        stop = marks[i + 1].start() if i + 1 < len(marks) else len(text)

        def line_at(start: int, stop: int = stop) -> tuple[str, bool]:
            end = LINE.match(text, start, stop).end()
            whole = text[start:end].decode("utf-8", "replace")
            said = CLOSER.sub("", whole)
            return said.strip(), end < stop or stop == len(text) or said != whole

        said, cut_off = line_at(m.end())
        found = leading_expression(said, cut_off)
        more = NEXT_LINE.match(text, m.end(), stop)
        if not said and more:
            below, cut_off = line_at(more.end())
            found = leading_expression(below, cut_off)
            rest = below[len(found) :].lstrip() if found else ""
            found = None if rest[:1] == "_" or rest[:1].isalnum() else found
        yield (found, evaluate(found)) if found else (said, None)


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in {**BASE_PHRASES, **MORE_PHRASES, TAG: ""}.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def scan_text(auto, text: bytes) -> tuple:
    """n_words, starts of base places, base labels, all labels, expressions, score of one text."""
    words = text.translate(WORD_TABLE).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, base, more, expressions, score = [], set(), set(), [], 0.0
    for end, (phrase, label) in auto.iter(line):
        if phrase in BASE_PHRASES:
            starts.append(line.count(" ", 0, end - len(phrase) - 1))
            base.add(label)
            score = max(score, 0.8)
        elif label:
            more.add(label)
            score = max(score, 0.6)
        elif not expressions:  # one look at the original text reads all its tags
            for said, value in tag_expressions(text):
                expressions.append((said, value[0] if value else [], value[1] if value else None))
                more.update(value[0] if value else ())
                score = max(score, 1.0 if value else 0.3)
    return len(words), starts, sorted(base), sorted(base | more), expressions, score


SCHEMA = (
    "doc_id long, n_words long, starts array<long>, base_labels array<string>, labels array<string>, "
    "expressions array<struct<text:string,identifiers:array<string>,restriction:int>>, score double"
)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, starts (word positions of base phrases), base_labels, labels, expressions, score."""

    def make(columns, texts):
        auto = automaton()
        rows = [scan_text(auto, t) for t in texts]
        n, starts, base, labels, said, score = map(list, zip(*rows, strict=True))
        said = [[{"text": t, "identifiers": i, "restriction": r} for t, i, r in x] for x in said]
        return [columns[0], n, starts, base, labels, said, score]

    return map_texts(docs, [id_col], text_col, make, SCHEMA)
