"""Substring dedup by relative Lempel-Ziv parsing: words inside a run of ``WINDOW``
words that an earlier document has go.

:mod:`quill.llm.repeats` brings the stretches of texts that share an anchor
together. In document order, each stretch is parsed against all reference stretches
of earlier documents, which are indexed by their ``WINDOW``-word runs: at each place
the parser takes the longest factor it finds there and moves on to the windows that
straddle the factor's end (a greedy parse alone would miss repeats across a
boundary), or by one word if no sufficiently long factor starts there. Factors of
``WINDOW`` words or more are duplicate spans. The stretch then joins the reference.

Matches never cross texts; a very long text is looked at in pieces that overlap by a
window. A document that has the run itself does not count, nor
does one with the same or a null id.

Defined results: a null or empty text has no words and loses none; repeated rows
(same id) keep their words unless a smaller id has them; rows with a null id keep
all words and are nobody's reference; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.repeats import Plan, covered, find_repeats, pack_place, text_tag, unpack_place

WINDOW = 13
PLAN = Plan(window=WINDOW, gram=5, words=True, ordered=True)
_WORD = 8                                               # bytes of a word's hash


class Reference:
    """Stretches of words indexed by every run of ``window`` words."""

    def __init__(self, window: int):
        self.size = window * _WORD
        self.runs: dict[bytes, tuple[bytes, int]] = {}

    def add(self, block: bytes) -> None:
        for a in range(0, len(block) - self.size + 1, _WORD):
            self.runs.setdefault(block[a:a + self.size], (block, a))

    def factors(self, block: bytes) -> Iterator[tuple[int, int]]:
        """``(first word, words)`` of the factors that are long enough."""
        a, size = 0, self.size
        while a + size <= len(block):
            hit = self.runs.get(block[a:a + size])
            if not hit:
                a += _WORD
                continue
            source, b = hit
            n = size
            while (a + n < len(block) and b + n < len(source)
                   and block[a + n:a + n + _WORD] == source[b + n:b + n + _WORD]):
                n += _WORD
            yield a // _WORD, n // _WORD
            a += n - size + _WORD                       # windows over the factor's end come next


def resolve(stretches: Iterator[tuple], plan: Plan = PLAN) -> Iterator[tuple[int, int]]:
    """Resolver: parses each stretch against those of smaller rows with its key."""
    for _, group in groupby(stretches, key=lambda s: s[0]):
        known = Reference(plan.window)
        for row, same_row in groupby(group, key=lambda s: s[1]):
            fresh = []
            for _, _, place, _, units in same_row:
                tag, start, _ = (int(x) for x in unpack_place(np.int64(place)))
                for first, words in known.factors(units):
                    yield row, int(pack_place(tag, np.int64(start + first), np.int64(words - plan.window + 1)))
                fresh.append(units)
            for units in fresh:
                known.add(units)


DEDUPED = "doc_id long, n_words long, spans array<struct<start:bigint,end:bigint>>, kept string"


def remove_repeats(docs: DataFrame, plan: Plan = PLAN) -> DataFrame:
    """One row per document (``DEDUPED``): removed word spans and the words kept,
    joined by single spaces."""
    own = docs.select(F.col("doc_id").cast("long").alias("row"), "text")
    marked = own.join(find_repeats(own, plan, lambda s: resolve(s, plan)), "row", "left").select("row", "text", "places")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("kept", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, places in zip(*batch.columns):
                words = (text.as_py() or "").encode().split()
                spans = []
                if places.is_valid:
                    _, values = next(plan.texts(pa.array([text.as_py()], pa.large_string())))
                    gone = covered(places.values.to_numpy(), text_tag(values), len(words), plan.window)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    spans = [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                    words_kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    words_kept = words
                rows.append({"doc_id": doc.as_py(), "n_words": len(words), "spans": spans,
                             "kept": b" ".join(words_kept).decode()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return marked.mapInArrow(cut, DEDUPED)


def repeat_summary(deduped: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return deduped.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
