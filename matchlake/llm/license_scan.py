"""Fuzzy search for short licence notices in whole texts.

A notice with at most k edits, cut into k + 1 pieces, has one piece without an edit. Exact hits
of the pieces name the places worth a look; there the regex library matches the whole notice
with bounded errors, and what it accepts is reported with its span and its number of edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: phrases of the base search and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices of the method's own, as words, with label and edits allowed. The short base phrase is
#: not in it: one edit of it names another licence.
NOTICES = [
    ("under the mit license", "mit", 2),
    ("apache license version 2", "apache-2", 2),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("creative commons attribution", "cc-by", 2),
    ("released into the public domain", "public-domain", 3),
    ("boost software license", "bsl", 2),
]
HITS = (
    "n_words long, hits array<struct<label string, base boolean, word long, words int, "
    "edits int, closeness double, found string>>"
)
_HIT = pa.struct(
    [
        ("label", pa.string()),
        ("base", pa.bool_()),
        ("word", pa.int64()),
        ("words", pa.int32()),
        ("edits", pa.int32()),
        ("closeness", pa.float64()),
        ("found", pa.string()),
    ]
)
#: A-Z become a-z, digits, a-z and all bytes of other characters stay, the rest are spaces.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def word_line(text: str | None) -> bytes:
    """The words of a whole text, one space around each."""
    words = (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()
    return b" " + b" ".join(words) + b" " if words else b" "


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    edits: int
    base: bool

    @cached_property
    def pieces(self) -> list[tuple[int, bytes]]:
        """The phrase in edits + 1 pieces of about one length, with their offsets."""
        data, count = self.phrase.encode(), self.edits + 1
        cuts = [len(data) * i // count for i in range(count + 1)]
        return [(a, data[a:b]) for a, b in zip(cuts, cuts[1:])]

    @cached_property
    def exact(self):
        return regex.compile(rb"(?<=\ )" + regex.escape(self.phrase.encode()) + rb"(?=\ )")

    @cached_property
    def fuzzy(self):
        body = regex.escape(self.phrase.encode()) + b"){1<=e<=%d}" % self.edits
        return regex.compile(rb"(?b)(?<=\ )(?:" + body + rb"(?=\ )")

    def windows(self, line: bytes) -> list[tuple[int, int]]:
        """Stretches around exact piece hits that hold every match, overlapping ones as one."""
        size, slack, found = len(self.phrase), self.edits + 1, []
        for offset, piece in self.pieces:
            at = line.find(piece)
            while at >= 0:
                found.append((max(0, at - offset - slack), at - offset + size + slack))
                at = line.find(piece, at + 1)
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    def matches(self, line: bytes) -> Iterator[tuple[int, int, int]]:
        """Spans (start, end, edits): places without an edit first, edited ones between them."""
        for a, b in self.windows(line):
            b, taken = min(b, len(line)), a
            exact = [m.span() for m in self.exact.finditer(line, a, b, overlapped=True)]
            yield from ((s, e, 0) for s, e in exact)
            if not self.edits:
                continue
            for s, e in [*exact, (b, b)]:
                yield from self.edited(line, taken, min(len(line), s + 1))
                taken = max(taken, e)

    def edited(self, line: bytes, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        """The closest edited place from a to b, then the closest on either side of it, and so on.

        The best match comes first, wherever it stands; what lies before it is searched again.
        """
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            m = self.fuzzy.search(line, a, b) if a < b else None
            if m is None:
                continue
            if not m.group().startswith(b" ") and not m.group().endswith(b" "):
                yield m.start(), m.end(), sum(m.fuzzy_counts)
            # A word's space ends one place and begins another.
            open_ += [(max(a, m.end()), b), (a, min(b - 1, m.start()))]


def notices() -> list[Notice]:
    exact = [Notice(p, label, 0, True) for p, label in BASE.items()]
    edited = {p: n for p, _, n in NOTICES}
    # A base phrase that has a fuzzy form is searched once; its unedited places are the base.
    exact = [Notice(n.phrase, n.label, edited.get(n.phrase, 0), True) for n in exact]
    return exact + [Notice(p, label, k, False) for p, label, k in NOTICES if p not in BASE]


def scan(text: str | None, searched: list[Notice]) -> tuple[int, list[dict]]:
    """Number of words of a whole text, and its hits in order of place."""
    line = word_line(text)
    found = []
    for notice in searched:
        for start, end, edits in notice.matches(line):
            found.append((start, end, edits, notice))
    found.sort(key=lambda hit: (hit[0], hit[1], hit[3].phrase))
    hits, word, seen = [], 0, 1
    for start, end, edits, notice in found:
        word += line.count(b" ", seen, start)
        seen = max(seen, start)
        hits.append(
            {
                "label": notice.label,
                "base": notice.base and edits == 0,
                "word": word,
                "words": line.count(b" ", start, end) + 1,
                "edits": edits,
                "closeness": 1.0 - edits / len(notice.phrase),
                "found": line[start:end].decode("utf-8", "replace"),
            }
        )
    return max(0, line.count(b" ") - 1), hits


def licences(text: Column) -> Column:
    """Struct of the number of words and the licence notices found in a whole text.

    ``word`` is a hit's first word, counted from 0, ``words`` how many it covers, ``base``
    whether it is a base phrase word for word. Null and empty text have no words and no hits;
    equal texts have equal hits; adjacent and repeated notices are hits each.
    """

    @F.arrow_udf(HITS)
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searched = notices()
        for part in parts:
            made = [scan(x, searched) for x in part.to_pylist()]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([n for n, _ in made], pa.int64()),
                    pa.array([h for _, h in made], pa.list_(_HIT)),
                ],
                names=["n_words", "hits"],
            )

    return find(text)
