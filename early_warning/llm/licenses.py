"""License scans: fuzzy search for short notices.

A text is reduced to its lower-cased words joined by single spaces. A notice of length n may occur with up to
k = n // ERROR_CHARS edits (none in very short notices). It is split into k + 1 pieces; by the pigeonhole
principle an occurrence holds at least one piece unchanged, so the pieces, found by one Aho-Corasick pass, are
seeds that locate every candidate. The regex library's bounded-error matching then verifies each candidate at
word bounds and reports its span and edits. A notice's versions (its words of digits) allow no edits: they are what tells
it from the notice of another version.

Edge cases: null and empty texts have no words, no spans and score 0; overlapping occurrences of a notice are all
reported if they are exact, and the best of those that overlap, the earliest if tied, if not; repeated rows have equal
results; very long texts are searched whole; an empty table gives an empty result; extra columns of any name are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, each, scan_texts, sorted_list

#: Notices whose exact places are counted as base places.
BASE_NOTICES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Further notices of the method.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "licensed under the apache license"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by", "creative commons attribution 4 0 international"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("all-rights-reserved", "all rights reserved"),
)
#: One edit is allowed for so many characters of a notice.
ERROR_CHARS = 10
#: Notices shorter than this allow none: one edit would turn them into other notices.
LEAST_FUZZY_CHARS = 16
#: The version in a notice.
VERSION = regex.compile(r"\b(\d+(?: \d+)*)\b")


def max_edits(phrase: str) -> int:
    return 0 if len(phrase) < LEAST_FUZZY_CHARS else len(phrase) // ERROR_CHARS


def pieces(phrase: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of edits + 1 pieces of about equal length."""
    cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Notice:
    def __init__(self, label: str, phrase: str, base: bool):
        self.label, self.phrase, self.base, self.edits = label, phrase, base, max_edits(phrase)
        word = regex.escape(phrase, literal_spaces=True)
        self.exact = regex.compile(rf"(?<![^ ]){word}(?![^ ])")
        self.fuzzy = regex.compile(rf"(?b)(?<![^ ]){self._edited()}(?![^ ])") if self.edits else None

    def near(self, text: str, a: int, b: int) -> list[tuple[tuple[int, int], int]]:
        """((start, end), edits) of the occurrences that begin at the word of ``a`` to that of ``b``, the best first.

        Every word start is tried by itself: a search allows no insertion where it begins.
        """
        # out to the next word bounds, so that the bounds of the window are no false word bounds
        end = text.find(" ", min(len(text), b + len(self.phrase) + self.edits))
        end, at, found = len(text) if end < 0 else end, text.rfind(" ", 0, a) + 1, []
        while at <= b:
            m = self.fuzzy.match(text, at, end)
            if m and sum(m.fuzzy_counts) <= self.edits:
                found.append((m.span(), sum(m.fuzzy_counts)))
            at = text.find(" ", at) + 1 or b + 1
        return sorted(found, key=lambda f: (f[1], f[0]))

    def _edited(self) -> str:
        """A pattern of edits in the names only, without digits in place of them: versions stand as they are."""
        out = []
        for i, part in enumerate(VERSION.split(self.phrase)):
            if i % 2:
                out.append(f"(?<![0-9]){part}(?![0-9])")
            elif part:
                change = ":[^0-9]" if VERSION.search(self.phrase) else ""
                out.append(f"(?:{regex.escape(part, literal_spaces=True)}){{e<={self.edits}{change}}}")
        return "".join(out)


class Scanner:
    """Finds all notices in one text."""

    def __init__(self, base: Sequence[tuple], more: Sequence[tuple]):
        self.notices = [Notice(*x, True) for x in base] + [Notice(*x, False) for x in more]
        self.seeds = ahocorasick.Automaton()
        owners: dict[str, list] = {}
        for notice in self.notices:
            for at, piece in pieces(notice.phrase, notice.edits):
                owners.setdefault(piece, []).append((notice, at))
        for piece, own in owners.items():
            self.seeds.add_word(piece, (len(piece), own))
        self.seeds.make_automaton()

    def candidates(self, text: str) -> dict[Notice, list[tuple[int, int]]]:
        """Per notice the merged (from, to) starts at which an occurrence may begin."""
        found: dict[Notice, list[tuple[int, int]]] = {}
        for end, (size, own) in self.seeds.iter(text):
            for notice, at in own:
                start = end + 1 - size - at
                a, b = max(0, start - notice.edits), start + notice.edits
                spans = found.setdefault(notice, [])
                # seeds come by their end, so starts are nearly in order
                if spans and a <= spans[-1][1] and b >= spans[-1][0]:
                    spans[-1] = (min(a, spans[-1][0]), max(b, spans[-1][1]))
                elif b >= 0:
                    spans.append((a, b))
        return found

    def spans(self, text: str) -> list[tuple[Notice, int, int, int]]:
        """(notice, start, end, edits) of the verified occurrences."""
        out = []
        for notice, starts in self.candidates(text).items():
            taken = set()
            for a, b in starts:
                size = len(notice.phrase)
                exact = [m.span() for m in notice.exact.finditer(text, a, min(len(text), b + size + 1), overlapped=True)]
                if notice.fuzzy:
                    for key, edits in notice.near(text, a, b):
                        if not any(key[0] < y and x < key[1] for x, y in [*taken, *exact]):
                            taken.add(key)
                            out.append((notice, *key, edits))
                for key in exact:
                    if key not in taken:
                        taken.add(key)
                        out.append((notice, *key, 0))
        return out


@lru_cache(maxsize=4)
def scanner(base: tuple, more: tuple) -> Scanner:
    return Scanner(base, more)


def _rows(base: tuple, more: tuple):
    def make():
        find = scanner(base, more)

        def row(text):
            words = alnum_words(text)
            line = b" ".join(words).decode("utf-8")
            spans = sorted(find.spans(line), key=lambda s: (s[1], s[2], s[0].label)) if words else []
            first = [line.count(" ", 0, s[1]) for s in spans]
            return (len(words), [s[0].label for s in spans], [s[0].base and not s[3] for s in spans], first,
                    [f + 1 + line.count(" ", s[1], s[2]) for f, s in zip(first, spans)], [s[3] for s in spans],
                    [line[s[1]:s[2]] for s in spans],
                    max((1.0 - s[3] / len(s[0].phrase) for s in spans), default=0.0))

        return each(row)

    return make


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                  base: tuple = BASE_NOTICES, more: tuple = NOTICES) -> DataFrame:
    """``keep``, n_words, ``score`` and the found ``spans``.

    A span has the label, whether it is an exact place of a base notice, its first word, the word after its
    last, its edits and the words as they stand. The score is the best similarity, 1 - edits / length.
    """
    out = [("n_words", "long"), ("_label", "array<string>"), ("_base", "array<boolean>"), ("_first", "array<long>"),
           ("_end", "array<long>"), ("_edits", "array<int>"), ("_found", "array<string>"), ("score", "double")]
    kept = [f"k{i}" for i in range(len(keep))]
    plain = docs.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), F.col(text_col).alias("t__"))
    return scan_texts(plain, kept, ["t__"], _rows(base, more), out).select(
        *(F.col(k).alias(c) for k, c in zip(kept, keep)), "n_words", "score",
        F.arrays_zip(F.col("_label").alias("label"), F.col("_base").alias("base"), F.col("_first").alias("first_word"),
                     F.col("_end").alias("end_word"), F.col("_edits").alias("edits"), F.col("_found").alias("found"))
        .alias("spans"))


def license_digest(found: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts, places and label lists from the spans."""
    base = F.filter("spans", lambda s: s.base)
    return found.select(
        *keep, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s.first_word)).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s.first_word)).alias("last_word"),
        sorted_list(F.transform(base, lambda s: s.label)).alias("base_labels"),
        sorted_list(F.transform("spans", lambda s: s.label)).alias("labels"),
        "score", F.size("spans").cast("long").alias("n_spans"))
