"""Headings inside blocks of text, found by one automaton over all aliases of sections.

The automaton (a trie of the aliases with failure links) reads a block once and tells whether any alias
stands in it at all; most blocks end there. Of the others, the ends of lines and of parts between pipes are
read by the same automaton, and the longest alias that fits its place wins, of equal lengths the one that
is listed first.
"""

from __future__ import annotations

import re
from itertools import product

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from folioforge.functions import vocab

#: kind: leading, inline, trailing or null; heading: its section; before and after: what is left of the text, not
#: normalised yet; named: the section that the whole text names, if it is a heading and nothing else.
FOUND = StructType([StructField(c, StringType()) for c in ("kind", "heading", "before", "after", "named")])
_TAIL = re.compile(r"[:\-–|]+\Z")
_SHOUTED = re.compile(r"[A-Z][A-Z \n/&-]{2,}\Z")
_MARK = re.compile("^([" + "".join(map(re.escape, vocab.BULLETS)) + "]) ?", re.MULTILINE)


class Aliases:
    """Section names by alias, and where aliases stand in a text. Texts are normalised: blanks and newlines are their only white space."""

    def __init__(self, names: dict[str, str]):
        import ahocorasick

        self.names = names
        self.order = {a: i for i, a in enumerate(sorted(names, key=len, reverse=True))}
        self.automaton = ahocorasick.Automaton()
        for alias in names:
            # "and" may be written as an ampersand, wherever it stands
            parts = alias.split("and")
            for joints in product(("and", "&"), repeat=len(parts) - 1):
                form = "".join(x for pair in zip(parts, (*joints, ""), strict=True) for x in pair)
                self.automaton.add_word(form, form if form in names else None)
        self.automaton.make_automaton()
        self.reach = max(map(len, names)) + 1

    @staticmethod
    def key(t: str) -> str:
        """Comparison form of a text as a heading."""
        return " ".join(_TAIL.sub("", t).lower().split())

    def named(self, key: str) -> str | None:
        return self.names.get(key) or self.names.get(key.replace("&", "and"))

    def any(self, t: str) -> bool:
        return next(self.automaton.iter(" ".join(t.lower().split())), None) is not None

    def starting(self, key: str) -> list[str]:
        """Aliases before the first blank or a later one, best first."""
        hits = [(a, end) for end, a in self.automaton.iter(key[: self.reach]) if a is not None and end + 1 == len(a) and key[end + 1 : end + 2] == " "]
        return sorted((a for a, _ in hits), key=self.order.__getitem__)

    def ending(self, key: str) -> list[str]:
        """Aliases after a blank up to the end, best first."""
        tail = key[-self.reach :]
        hits = [a for end, a in self.automaton.iter(tail) if a is not None and end + 1 == len(tail) and tail[: -len(a)].endswith(" ")]
        return sorted(hits, key=self.order.__getitem__)

    def leading(self, t: str) -> tuple[str, str] | None:
        """(section, rest) of a heading at the start: a first line that is one, or begins with one and goes on."""
        first, _, rest = t.partition("\n")
        key = self.key(first)
        if (name := self.named(key)) is not None:
            return name, rest
        for alias in self.starting(key):
            if after := first[len(alias) :].lstrip(" |:-–"):
                return self.names[alias], after + ("\n" + rest if rest else "")
        return None

    def part(self, p: str) -> tuple[str, str, str] | None:
        """(section, before, after) of a part that is, begins or ends with a heading."""
        p = _MARK.sub(r"\1 ", p).strip(" \n")
        key = self.key(p)
        if (name := self.named(key)) is not None:
            return name, "", ""
        at_start, at_end = self.starting(key)[:1], self.ending(key)[:1]
        if not at_start and not at_end:
            return None
        words = p.split()
        alias = min(at_start + at_end, key=self.order.__getitem__)
        n = len(alias.split())
        return (self.names[alias], "", " ".join(words[n:])) if [alias] == at_start else (self.names[alias], " ".join(words[:-n]), "")

    def inline(self, t: str) -> tuple[str, str, str] | None:
        """(section, before, after) of the first part between pipes that has a heading."""
        parts = [p.strip(" \n") for p in t.split("|")]
        if len(parts) < 2:
            return None
        for i, p in enumerate(parts):
            if (hit := self.part(p)) is not None:
                before, after = [*parts[:i], hit[1]], [hit[2], *parts[i + 1 :]]
                return hit[0], " | ".join(filter(None, before)), " | ".join(filter(None, after))
        return None

    def trailing(self, t: str) -> tuple[str, str] | None:
        """(section, rest) of a heading at the end: a last line in capitals or before a colon, or an alias in capitals."""
        lines = [x for line in t.split("\n") if (x := line.strip(" "))]
        if not lines:
            return None
        last = lines[-1]
        if (_SHOUTED.match(last) or last.endswith(":")) and (name := self.named(self.key(last))) is not None:
            return name, "\n".join(lines[:-1])
        for alias in self.ending(t[-self.reach :].lower()):
            if t.endswith(" " + alias.upper()):
                return self.names[alias], t[: -len(alias)]
        return None

    def find(self, t: str) -> tuple[str | None, ...]:
        if not t or not self.any(t):
            return None, None, None, None, None
        named = self.named(self.key(t))
        if (lead := self.leading(t)) is not None:
            return "leading", lead[0], "", lead[1], named
        if (hit := self.inline(t)) is not None:
            return "inline", *hit, named
        if (end := self.trailing(t)) is not None:
            return "trailing", end[0], end[1], "", named
        return None, None, None, None, named


_known: list[Aliases] = []


@F.pandas_udf(FOUND)
def _found(t: pd.Series) -> pd.DataFrame:
    if not _known:
        _known.append(Aliases(vocab.SECTION_ALIASES))
    return pd.DataFrame(list(map(_known[0].find, t)), columns=FOUND.names)


def found(t: Column) -> Column:
    """What stands in a normalised text, as a struct FOUND."""
    return _found(t)
