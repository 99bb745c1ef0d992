"""License scans: fuzzy search for short notices.

A text becomes its words (ASCII lower-cased runs of letters, digits and non-ASCII
characters) joined by single spaces. Base places are exact runs of a base
phrase's words. Fuzzy matches: a notice that may differ by ``e`` edits is split
into ``e + 1`` parts, one of which any match must hold unchanged (pigeonhole).
All parts of all notices are found in one pass of an Aho-Corasick automaton; around
each hit by itself the ``regex`` library matches the whole notice with at most ``e``
errors and so reports span and edits. Notices and errors are fixed, so a task's
state is bounded; texts are taken one at a time, whole.

Defined results: a null or empty text has no words, null positions, empty labels
and score 0; repeated rows are scanned each by itself; the score is the best place's, so
equally good places give one score; overlapping places of the
same phrase all count; of overlapping fuzzy matches those with the
fewest edits are reported (of one notice the leftmost of these), and also a longer
one around them; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices (words only), their label and how many edits they allow.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0", 4),
    ("released under the mit license", "mit", 3),
    ("distributed under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under the gnu general public license version 3", "gpl-3.0", 4),
    ("licensed under the gnu general public license version 2", "gpl-2.0", 4),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("gnu general public license", "gpl", 3),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0", 2),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0", 2),
    ("licensed under cc by 4 0", "cc-by-4.0", 2),
    ("creative commons attribution", "cc-by", 3),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 6),
    ("mozilla public license version 2 0", "mpl-2.0", 3),
    ("eclipse public license", "epl", 2),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5),
    ("all rights reserved", "all-rights-reserved", 1),
)

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_TO_GAP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SPANS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
         "base array<struct<label:string,word:bigint>>, "
         "fuzzy array<struct<label:string,start:bigint,end:bigint,edits:int,matched:string>>")


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8; only A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_TO_GAP).split()


def split_parts(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` consecutive parts ``(offset, part)`` that make up the notice."""
    n, k = len(notice), edits + 1
    cuts = [round(i * n / k) for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class NoticeSearch:
    """Seed automaton and bounded-error patterns of a set of notices."""

    def __init__(self, notices=NOTICES):
        self.notices = notices
        self.patterns = [regex.compile(r"(?b)(?<![^ ])(?:%s){e<=%d}(?![^ ])" % (regex.escape(n), e)) for n, _, e in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, e) in enumerate(notices):
            for at, part in split_parts(n, e):
                seeds.setdefault(part, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for part, where in seeds.items():
            self.automaton.add_word(part, (len(part), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[str, int, int, int, str]]:
        """``(label, start, end, edits, matched)`` over normalised text."""
        windows: dict[int, set[tuple[int, int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for i, at in where:
                notice, _, e = self.notices[i]
                start = last + 1 - size - at
                windows.setdefault(i, set()).add((max(0, start - e), min(len(text), start + len(notice) + e)))
        found = {}
        for i, own in windows.items():
            label = self.notices[i][1]
            for edits, a, b, matched in self._places(i, text, own):
                key = (label, a, b)
                if key not in found or edits < found[key][0]:
                    found[key] = (edits, matched)
        # a span that another notice explains with fewer edits is not this notice's;
        # a shorter one inside it explains only a part
        return sorted((label, a, b, n, m) for (label, a, b), (n, m) in found.items()
                      if not any(c < b and a < d and k < n and not (a <= c and d <= b and d - c < b - a)
                                 for (_, c, d), (k, _) in found.items()))

    def _best(self, i: int, text: str, a: int, b: int) -> tuple | None:
        """The best place of a notice within ``[a, b)``, whole words only."""
        notice, _, e = self.notices[i]
        if b < len(text) and text[b] != " ":
            b = text.rfind(" ", a, b)                # the pattern takes b for the end of a word
        if b - a < len(notice) - e or not (m := self.patterns[i].search(text, a, b)):
            return None
        return sum(m.fuzzy_counts), m.start(), m.end(), m.group(), a, b

    def _places(self, i: int, text: str, windows: set[tuple[int, int]]) -> list[tuple[int, int, int, str]]:
        """Places of a notice, fewest edits first, that don't overlap. Where a window's
        best place overlaps one taken before, what is left of the window is searched."""
        heap = [x for a, b in windows if (x := self._best(i, text, a, b))]
        heapify(heap)
        taken: list[tuple[int, int]] = []
        out = []
        while heap:
            edits, start, end, matched, a, b = heappop(heap)
            at = bisect_right(taken, (start, end))
            hit = next((t for t in taken[max(0, at - 1):at + 1] if t[0] < end and start < t[1]), None)
            if hit is None:
                taken.insert(at, (start, end))
                out.append((edits, start, end, matched))
                hit = start, end
            for rest in ((a, hit[0] - 1), (hit[1] + 1, b)):
                if rest[1] > rest[0] and (x := self._best(i, text, *rest)):
                    heappush(heap, x)
        return out


def base_places(joined: bytes, phrase: bytes) -> list[int]:
    """Byte positions in ``b" w1 w2 ... "`` where the phrase's words stand."""
    out, at, needle = [], -1, b" " + phrase + b" "
    while (at := joined.find(needle, at + 1)) >= 0:
        out.append(at)
    return out


def scan_licenses(docs: DataFrame, notices=NOTICES) -> DataFrame:
    """One row per document (``SPANS``): base places by word, and fuzzy notices with
    their word span (end exclusive), number of edits and matched words."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = NoticeSearch(notices)
        schema = None
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(value.as_py())
                joined = b" " + b" ".join(words) + b" "
                base = sorted((joined.count(b" ", 0, at), label) for phrase, label in BASE_PHRASES.items()
                              for at in base_places(joined, phrase.encode()))
                text = joined[1:-1].decode("utf-8", "surrogatepass")
                fuzzy = search.find(text)
                gaps = [i for i, c in enumerate(text) if c == " "] if fuzzy else []
                rows.append({
                    "doc_id": doc, "n_words": len(words), "n_base": len(base),
                    "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
                    "base": [{"label": b, "word": w} for w, b in base],
                    "fuzzy": [{"label": b, "start": bisect_right(gaps, s), "end": bisect_right(gaps, e - 1) + 1,
                               "edits": n, "matched": m} for b, s, e, n, m in fuzzy]})
            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(scan, SPANS)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
    ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
    ("fuzzy", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("edits", pa.int32()), ("matched", pa.string())]))),
])


def license_summary(spans: DataFrame) -> DataFrame:
    """Labels and score per document. The score is 1 for an exact base place or
    notice, less by a tenth for each edit of the best fuzzy match, and 0 without any."""
    names = lambda col: F.array_join(F.array_sort(F.array_distinct(col)), ",")
    best = F.array_max(F.transform("fuzzy", lambda x: F.lit(1.0) - x["edits"] / F.lit(10.0)))
    return spans.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        names(F.col("base.label")).alias("base_labels"),
        names(F.concat(F.col("base.label"), F.col("fuzzy.label"))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))
