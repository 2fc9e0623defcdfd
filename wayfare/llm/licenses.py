"""License notices in texts: exact phrases, and short notices with a bounded number of slips.

A text is lower-cased (A-Z) and cut into words, runs of ASCII letters, digits and non-ASCII characters; the words
joined by single spaces are what is searched, so line breaks, comment marks and punctuation do not matter.

Phrases must stand word for word. Notices may differ by up to ``len // CHARACTERS_PER_SLIP`` insertions, deletions
and substitutions, at least one, and must begin and end with a word. Of k + 1 pieces of a notice, k slips leave one
untouched. All pieces of all notices are looked up in one pass of an automaton; each piece found leaves few runs of words
around it that could be the notice, and the regex library verifies those with at most k errors. Of runs that overlap,
the one of fewest slips is reported, then the leftmost.

The work is a projection: no shuffle, one text in memory at a time beyond its Arrow batch.

Defined results: a null or empty text has no words and no spans; empty label lists are empty strings and the score is 0;
repeated rows get equal results; texts of any length are searched whole; rows without an id are handled like others. The
result is one struct column under a name that must not be one of the frame's, so extra columns pass untouched.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import pairwise

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases that must stand as they are, and notices that may have slips, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc", "licensed under a creative commons attribution"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "licensed under cc by sa 4 0"),
)
#: one slip is allowed for so many characters of a notice
CHARACTERS_PER_SLIP = 16

SPANS = "array<struct<label: string, notice: string, first_word: long, last_word: long, start: long, stop: long, slips: int>>"
RESULT = (
    "struct<n_words: long, n_base: long, first_word: long, last_word: long, base_labels: string, labels: string, "
    f"score: double, spans: {SPANS}>"
)

# lower case for A-Z, a space for all that parts words; bytes of other characters stay
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal(text: bytes) -> tuple[str, int]:
    """The words of a text joined by spaces, and their number."""
    words = text.translate(_NORMAL).split()
    return b" ".join(words).decode(), len(words)


@dataclass(frozen=True)
class Found:
    """A notice in a normal text, from ``at`` to ``end``."""

    notice: int
    at: int
    end: int
    slips: int


class NoticeSearch:
    """Automaton over the pieces of all notices and the phrases."""

    def __init__(self, notices: Sequence[tuple[str, str]], phrases: Mapping[str, str], per_slip: int = CHARACTERS_PER_SLIP):
        if any(normal(text.encode())[0] != text or not text for text in [*phrases, *(n for _, n in notices)]):
            raise ValueError("phrases and notices must be words in lower case, joined by single spaces")
        self.notices, self.phrases = list(notices), dict(phrases)
        self.slips = [max(1, len(text) // per_slip) for _, text in notices]
        self._patterns = [
            [regex.compile(f"(?:{regex.escape(text)}){{e<={slips}}}") for slips in range(most + 1)]
            for (_, text), most in zip(self.notices, self.slips)
        ]
        wanted: dict[str, list[tuple[int, int]]] = {phrase: [] for phrase in phrases}
        for number, (_, text) in enumerate(self.notices):
            for start, piece in pieces(text, self.slips[number] + 1):
                wanted.setdefault(piece, []).append((number, start))
        self._automaton = ahocorasick.Automaton()
        for piece, uses in wanted.items():
            self._automaton.add_word(piece, (piece, len(piece), uses, piece in phrases))
        self._automaton.make_automaton()

    def __call__(self, text: str) -> tuple[list[tuple[str, int]], list[Found]]:
        """Phrases and where they stand, and spans of the notices, in the order of the notices."""
        exact: list[tuple[str, int]] = []
        starts: dict[int, set[int]] = {}
        for last, (piece, size, uses, is_phrase) in self._automaton.iter(text):
            at = last + 1 - size
            if is_phrase and _starts_word(text, at) and _ends_word(text, last + 1):
                exact.append((piece, at))
            for number, offset in uses:
                # slips before the piece move the start of the notice by as many characters at most
                slips = self.slips[number]
                near = range(max(0, at - offset - slips), min(len(text), at - offset + slips + 1))
                starts.setdefault(number, set()).update(near)
        found = [one for number in sorted(starts) for one in self._verified(text, number, starts[number])]
        return exact, found

    def _verified(self, text: str, number: int, starts: set[int]) -> list[Found]:
        """Runs of words that the notice matches, those of fewest slips first, none over another."""
        size, most = len(self.notices[number][1]), self.slips[number]
        near = []
        for at in sorted(starts):
            if _starts_word(text, at):
                for end in range(at + size - most, min(len(text), at + size + most) + 1):
                    if end > at and _ends_word(text, end):
                        if (slips := self._slips(number, text, at, end)) is not None:
                            near.append((slips, at, end))
        chosen: list[Found] = []
        taken: list[tuple[int, int]] = []
        for slips, at, end in sorted(near):
            place = bisect_right(taken, (at, end))
            if (place == 0 or taken[place - 1][1] <= at) and (place == len(taken) or taken[place][0] >= end):
                taken.insert(place, (at, end))
                chosen.append(Found(number, at, end, slips))
        return sorted(chosen, key=lambda one: one.at)

    def _slips(self, number: int, text: str, at: int, end: int) -> int | None:
        widest = self._patterns[number][-1].fullmatch(text, at, end)
        if widest is None:
            return None
        # that match need not have the fewest errors
        patterns = self._patterns[number][: sum(widest.fuzzy_counts)]
        return next((n for n, p in enumerate(patterns) if p.fullmatch(text, at, end)), sum(widest.fuzzy_counts))


def _starts_word(text: str, at: int) -> bool:
    return text[at] != " " and (at == 0 or text[at - 1] == " ")


def _ends_word(text: str, end: int) -> bool:
    return text[end - 1] != " " and (end == len(text) or text[end] == " ")


def pieces(text: str, count: int) -> list[tuple[int, str]]:
    """A text cut into so many pieces of about equal length, with where each starts."""
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in pairwise(cuts)]


def scan(search: NoticeSearch, text: bytes) -> tuple:
    """One row of ``RESULT``."""
    joined, n_words = normal(text)
    exact, found = search(joined)
    if not exact and not found:
        return n_words, 0, None, None, "", "", 0.0, []
    starts = [0, *(i + 1 for i, c in enumerate(joined) if c == " ")]
    word = lambda at: bisect_right(starts, at) - 1
    places = [word(at) for _, at in exact]
    base = {search.phrases[phrase] for phrase, _ in exact}
    spans = []
    if found:
        edges = [match.span() for match in _WORD.finditer(text.decode())]
        for one in found:
            label, notice = search.notices[one.notice]
            first, last = word(one.at), word(one.end - 1)
            spans.append((label, notice, first, last, edges[first][0], edges[last][1], one.slips))
    labels = base | {span[0] for span in spans}
    score = 1.0 if base else max(1 - one.slips / len(search.notices[one.notice][1]) for one in found)
    first, last = (min(places), max(places)) if places else (None, None)
    return n_words, len(exact), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def scanned(
    df: DataFrame,
    text_col: str = "text",
    name: str = "licenses",
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """The rows with ``name``, a struct of word count, base places, labels, score and spans (see ``RESULT``).

    Spans give the label, the notice, its first and last word, its code points from ``start`` up to ``stop`` in the
    text as it was, and the number of slips.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    notices, phrases = tuple(notices), dict(phrases)

    @F.arrow_udf(RESULT)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = NoticeSearch(notices, phrases)
        span_type = pa.list_(
            pa.struct(
                [("label", pa.string()), ("notice", pa.string())]
                + [(n, pa.int64()) for n in ("first_word", "last_word", "start", "stop")]
                + [("slips", pa.int32())]
            )
        )
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span_type]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        parts = [f.name for f in span_type.value_type]
        for batch in texts:
            rows = [scan(search, text or b"") for text in batch.to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            columns[-1] = [[dict(zip(parts, span)) for span in spans] for spans in columns[-1]]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return df.withColumn(name, find(F.col(text_col).cast("binary")))
