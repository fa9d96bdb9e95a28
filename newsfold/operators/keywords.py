"""Keyword search: words, quoted phrases, leading minus and ``or``, over ``search_text``."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = re.compile(r'"([^"]*)"?|([^\s"!&|()]+)')
_OR = re.compile(r"or(?![\w-])[\s\S]\s*\S", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Term:
    """Words that must stand next to each other, or must not when ``negated``."""

    words: tuple[str, ...]
    negated: bool = False

    def over(self, search_text: Column) -> Column:
        found = F.contains(search_text, F.lit(f" {' '.join(self.words)} "))
        return ~found if self.negated else found


def read_keywords(query: str) -> list[list[Term]]:
    """Alternatives of required terms. Stray punctuation yields no term; no term at all, no alternative."""
    groups: list[list[Term]] = [[]]
    at, wants_value, negated = 0, True, False
    while at < len(query):
        if query[at].isspace() or (wants_value and query[at] in "!&|()"):
            at += 1
        elif wants_value and query[at] == "-":
            at, negated = at + 1, not negated
        elif wants_value:
            value = _VALUE.match(query, at)
            words = tuple(_WORD.findall(value[0].lower()))
            if words:
                groups[-1].append(Term(words, negated))
            at, wants_value, negated = value.end(), False, False
        elif _OR.match(query, at):
            groups.append([])
            at, wants_value = at + 2, True
        else:
            wants_value = True
    return [group for group in groups if group]


def keyword_filter(query: str, search_text: Column) -> Column:
    """Predicate over ``search_text``; false for a query without any word."""
    groups = read_keywords(query)
    conjunctions = [reduce(lambda a, b: a & b, [term.over(search_text) for term in group]) for group in groups]
    return reduce(lambda a, b: a | b, conjunctions, F.lit(False)) if conjunctions else F.lit(False)
