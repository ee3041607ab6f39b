"""Licence scan: Aho-Corasick over words, shunting-yard over tag expressions."""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from spanfeat.llm.common import text_rows

# Phrases of the base, and further notice phrases with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")


@lru_cache(maxsize=1)
def _automaton():
    machine = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        machine.add_word(f" {phrase} ", (phrase, len(phrase) + 2))
    machine.make_automaton()
    return machine


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: ids and the operators AND, OR, WITH (binding tightest) in postfix order.

    Reads as far as the text is a valid expression; None if it does not begin with one.
    """
    rank = {"OR": 1, "AND": 2, "WITH": 3}
    out, ops, want, depth = [], [], True, 0
    best = None  # length of the output and operators left where the text was last complete
    for token in _TOKEN.findall(expression):
        op = token.upper()
        if token == "(":
            if not want:
                break
            ops.append(token)
            depth += 1
        elif token == ")":
            if want or not depth:
                break
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
            depth -= 1
        elif op in rank:
            if want:
                break
            while ops and ops[-1] != "(" and rank[ops[-1]] >= rank[op]:
                out.append(ops.pop())
            ops.append(op)
            want = True
            continue
        else:
            if not want:
                break
            out.append(token)
            want = False
        if not want and not depth:
            best = (len(out), ops[::-1])  # three operators at most
    return None if best is None else out[: best[0]] + best[1]


class _Part:
    """Evaluated part of an expression: its kind, its operands as texts, and the ids in it."""

    __slots__ = ("kind", "operands", "ids")

    def __init__(self, kind: str, operands: set[str], ids: set[str]):
        self.kind, self.operands, self.ids = kind, operands, ids

    def text(self, outer: str | None = None) -> str:
        made = (" | " if self.kind == "OR" else " & ").join(sorted(self.operands))
        return f"({made})" if outer not in (None, self.kind) and len(self.operands) > 1 else made


def evaluate(postfix: list[str]) -> tuple[str, set[str]]:
    """Normal text of an expression, and its ids.

    AND (``&``) and OR (``|``) are flattened, their operands sorted and made distinct, in
    lower case; nothing is multiplied out, so the text is no longer than the expression.
    WITH keeps a licence and its exception as one id.
    """
    stack: list[_Part] = []
    for token in postfix:
        if token in ("AND", "OR"):
            b, a = stack.pop(), stack.pop()
            sides = []
            for part in (a, b):
                if part.kind == token or len(part.operands) == 1:
                    sides.append(part.operands)
                else:
                    sides.append({part.text(token)})
            big, small = sorted(sides, key=len, reverse=True)
            big |= small
            ids, more = (a.ids, b.ids) if len(a.ids) >= len(b.ids) else (b.ids, a.ids)
            ids |= more
            stack.append(_Part(token, big, ids))
        elif token == "WITH":
            b, a = stack.pop(), stack.pop()
            exception = b.text("WITH")
            ids = {f"{i}-with-{exception}" for i in a.ids}
            whole = f"{a.text('WITH')}-with-{exception}"
            stack.append(_Part("WITH", {whole}, ids))
        else:
            name = token.lower()
            stack.append(_Part("ID", {name}, {name}))
    return stack[-1].text(), stack[-1].ids


def _after_tags(data: bytes, last_words: list[int]) -> list[str]:
    """What follows each identifier tag on its line; a tag is known by the number of its last word.

    A colon, an equals sign, blanks and quotes may stand between tag and expression.
    """
    wanted, out = set(last_words), []
    for k, m in enumerate(_WORDS.finditer(data.lower())):
        if k in wanted:
            line = re.split(rb"[\r\n]", data[m.end() :], maxsplit=1)[0]
            out.append(line.decode("utf-8", "replace").lstrip(" \t:=\"'"))
    return out


def scan(text: str | None) -> dict:
    """All places of phrases and tags in one text."""
    data = (text or "").encode()
    words = _WORDS.findall(data.lower())
    base_at, base, labels, others, tags = [], set(), set(), 0, []
    if words:
        line = (b" " + b" ".join(words) + b" ").decode("utf-8")
        starts = None
        for end, (phrase, size) in _automaton().iter(line):
            if starts is None:  # where each word's leading blank stands
                starts = [m.start() for m in re.finditer(" ", line)]
            at = bisect_left(starts, end - size + 1)
            if phrase in BASE:
                base_at.append(at)
                base.add(BASE[phrase])
            elif phrase in NOTICES:
                others += 1
                labels.add(NOTICES[phrase])
            else:
                tags.append(at + TAG.count(" "))
    choices = []
    for follows in _after_tags(data, tags) if tags else ():
        postfix = to_postfix(follows)
        if postfix:
            normal, ids = evaluate(postfix)
            choices.append(normal)
            labels |= ids
    return {
        "n_words": len(words), "n_base": len(base_at),
        "first": min(base_at, default=None), "last": max(base_at, default=None),
        "base": base, "labels": labels | base, "evidence": len(base_at) + others + 2 * len(choices),
        "choices": choices,
    }


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence evidence per document.

    Base places are runs of consecutive words equal to a base phrase; ``labels`` adds other
    notices and the ids of every identifier tag, whose expression ``choices`` gives in normal
    form. Tags are found by the automaton as well; the expression is read from there.
    ``score`` is 1 - 0.5 ** evidence (a tag counts twice). Null text counts as empty: no
    words, null places, empty labels, score 0. Rows repeat as given; extra columns are ignored.
    """

    def one(doc_id, text):
        s = scan(text)
        yield (
            doc_id, s["n_words"], s["n_base"], s["first"], s["last"], ",".join(sorted(s["base"])),
            ",".join(sorted(s["labels"])), 1 - 0.5 ** min(s["evidence"], 1000), s["choices"],
        )

    return text_rows(
        docs, one, ["doc_id", "text"],
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, choices array<string>",
    )
