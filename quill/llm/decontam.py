"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become tokens (ASCII lower-cased runs of letters,
digits and non-ASCII characters, so punctuation does not matter). A document and an
item that share a run of ``SEED`` tokens are a candidate pair. Around its seeds the
pair is tiled: the longest common runs that touch no marked token are marked, found
by Karp-Rabin hashes of a run length that shrinks step by step down to
``LEAST_TILE``, so reordered passages are covered piece by piece. The pair is a leak
when the tiles cover at least ``COVERAGE`` of the item's tokens, or when one tile is
a verbatim run of ``LONG_RUN`` tokens or more, however long the item. An item of
fewer than ``SEED`` tokens has no seed: it leaks where all its tokens stand in order.

The benchmark is taken in blocks of at most ``BLOCK_BYTES`` of text, each small
enough to send to every task whatever the benchmark's size; documents are scanned
once per block, whole and never shuffled.

Defined results: null or empty texts on either side, and texts without tokens, give no
pair; repeated documents or items give a pair each; ties between tiles go to the
first place in the item, then in the document; a very long text is tiled around its
seeds only, all of them; an empty table gives no rows; other columns are not read
(``drop_leaks`` returns them unchanged).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.text import LOWER, PUNCT, ngram_hashes, text_slices, word_hashes, word_spans

SEED = 5
LEAST_TILE = 3
FIRST_RUN = 24
COVERAGE = 0.6
#: a run of so many tokens is no chance match
LONG_RUN = 24
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22

_PRIME = (1 << 61) - 1
_BASE = 1_000_003

LEAKS = ("doc_id long, item_id long, n_tiles int, tiled_tokens int, item_tokens int, coverage double, "
         "first_token long, last_token long")


def token_hashes(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, hashes, bounds)`` per slice; row ``i`` has the token hashes
    ``hashes[bounds[i]:bounds[i + 1]]``."""
    for row, buf, offs in text_slices(column):
        buf = LOWER[buf]
        starts, ends, first = word_spans(buf, offs, PUNCT)
        yield row, word_hashes(buf, starts, ends), first


def rolling_hashes(tokens: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Karp-Rabin: ``(hash, start)`` of each run of ``length`` free tokens."""
    top = pow(_BASE, length - 1, _PRIME)
    h = run = 0
    for i, (token, ok) in enumerate(zip(tokens, free)):
        if not ok:
            h = run = 0
            continue
        if run == length:
            h = (h - tokens[i - length] * top) % _PRIME
            run -= 1
        h = (h * _BASE + token) % _PRIME
        run += 1
        if run == length:
            yield h, i - length + 1


def string_tiles(item: list[int], text: list[int], least: int = LEAST_TILE,
                 first_run: int = FIRST_RUN) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(item start, text start, length)`` of the tiles.

    Runs of ``length`` tokens are looked up by hash and compared, then extended. A
    match twice as long as the run length sends the search up to that length; else
    the matches are marked longest first and the run length halves."""
    free_item, free_text, tiles = [True] * len(item), [True] * len(text), []
    length = max(least, min(first_run, len(item)))
    while True:
        at = defaultdict(list)
        for h, i in rolling_hashes(item, free_item, length):
            at[h].append(i)
        matches, longest = [], 0
        for h, t in rolling_hashes(text, free_text, length):
            for i in at.get(h, ()):
                n = 0
                while (i + n < len(item) and t + n < len(text) and free_item[i + n] and free_text[t + n]
                       and item[i + n] == text[t + n]):
                    n += 1
                if n >= length:
                    matches.append((n, i, t))
                    longest = max(longest, n)
        if longest >= 2 * length:
            length = longest
            continue
        for n, i, t in sorted(matches, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_item[i:i + n]) and all(free_text[t:t + n]):
                tiles.append((i, t, n))
                free_item[i:i + n] = [False] * n
                free_text[t:t + n] = [False] * n
        if length == least:
            return tiles
        length = max(least, length // 2)


class Items:
    """One block of benchmark items with an index of their seeds."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.tokens = [], []
        short: dict[int, list[tuple[int, int]]] = {}    # by number of tokens: (hash, id)
        for row, h, bounds in token_hashes(pa.array(texts, pa.large_string())):
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if b - a >= SEED:
                    self.ids.append(ids[row + i])
                    self.tokens.append(h[a:b])
                elif b > a:
                    short.setdefault(int(b - a), []).append((int(ngram_hashes(h[a:b], int(b - a))[0]), ids[row + i]))
        self.short = {}
        for n, known in short.items():
            known.sort(key=lambda x: (x[0], -1 if x[1] is None else x[1]))
            self.short[n] = np.array([k for k, _ in known], np.uint64), [i for _, i in known]
        seeds = [ngram_hashes(t, SEED) for t in self.tokens]
        seed = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        order = np.argsort(seed, kind="stable")
        self.seed, self.item = seed[order], item[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.seed >> np.uint64(64 - _FILTER_BITS)] = True

    def seeds_of(self, tokens: np.ndarray) -> np.ndarray:
        """Positions whose ``SEED`` tokens some item has, all rows of a slice at once."""
        h = ngram_hashes(tokens, SEED)
        maybe = np.flatnonzero(self.filter[h >> np.uint64(64 - _FILTER_BITS)])
        if not len(maybe):
            return maybe, h[maybe]
        found = np.searchsorted(self.seed, h[maybe])
        found[found == len(self.seed)] = 0
        maybe = maybe[self.seed[found] == h[maybe]]
        return maybe, h[maybe]

    def short_leaks(self, tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
        """``(row, item id, tiles, ...)`` for items too short for a seed, all rows of a
        slice at once."""
        for n, (known, ids) in sorted(self.short.items()):
            h = ngram_hashes(tokens, n)
            at = np.flatnonzero(np.isin(h, known))
            doc = np.searchsorted(bounds, at, "right") - 1
            whole = at + n <= bounds[doc + 1]
            at, doc = at[whole], doc[whole]
            order = np.lexsort((at, h[at], doc))
            at, doc = at[order], doc[order]
            new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(h[at], prepend=np.uint64(0)) != 0))
            for a, b in zip(new, [*new[1:], len(at)]):
                i, j = np.searchsorted(known, h[at[a]], "left"), np.searchsorted(known, h[at[a]], "right")
                start = int(at[a] - bounds[doc[a]])
                for item in ids[i:j]:
                    yield int(doc[a]), item, 1, n, n, 1.0, start, start + n - 1

    def leaks(self, tokens: np.ndarray, at: np.ndarray, h: np.ndarray, coverage: float):
        """Leaks in one document, given the positions and hashes of its seeds."""
        near = defaultdict(list)
        lo, hi = np.searchsorted(self.seed, h, "left"), np.searchsorted(self.seed, h, "right")
        for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
            for i in dict.fromkeys(self.item[a:b].tolist()):
                near[i].append(p)
        for i, places in sorted(near.items()):
            item = self.tokens[i]
            # every passage of the item lies within an item's length of some seed;
            # a token that equals none parts the stretches
            text, where, end = [], [], 0
            for p in places:
                a, b = max(end, p - len(item)), min(len(tokens), p + SEED + len(item))
                if a >= b:
                    continue
                if a > end and text:
                    text.append(-1)
                    where.append(-1)
                text += tokens[a:b].tolist()
                where += range(a, b)
                end = b
            tiles = string_tiles([t % _PRIME for t in item.tolist()],
                                 [t % _PRIME if t >= 0 else -1 for t in text])
            tiled = sum(n for _, _, n in tiles)
            if tiled >= coverage * len(item) or max((n for _, _, n in tiles), default=0) >= LONG_RUN:
                yield (self.ids[i], len(tiles), tiled, len(item), tiled / len(item),
                       min(where[t] for _, t, _ in tiles), max(where[t + n - 1] for _, t, n in tiles))


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list[int], list[str]]]:
    """Items in blocks of bounded size; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("length(text) > 0")
    for item, text in rows.orderBy("item_id", "text").toLocalIterator():
        if size and size + len(text) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text)
    if ids:
        yield ids, texts


def _leaks_of(items: Items, column, coverage: float) -> Iterator[tuple]:
    """``(row, item id, tiles, ...)`` of every leak in a text column."""
    for row, tokens, bounds in token_hashes(column):
        for doc, *leak in items.short_leaks(tokens, bounds):
            yield (row + doc, *leak)
        at, h = items.seeds_of(tokens)
        doc = np.searchsorted(bounds, at, "right") - 1
        whole = at + SEED <= bounds[doc + 1]                    # not over a row's end
        at, h, doc = at[whole], h[whole], doc[whole]
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for p, q in zip([0, *cuts], [*cuts, len(doc)]):
            if q > p:
                a, b = bounds[doc[p]], bounds[doc[p] + 1]
                for leak in items.leaks(tokens[a:b], at[p:q] - a, h[p:q], coverage):
                    yield (row + int(doc[p]), *leak)


def _scan(docs: DataFrame, block, coverage: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_tiles", pa.int32()),
                        ("tiled_tokens", pa.int32()), ("item_tokens", pa.int32()), ("coverage", pa.float64()),
                        ("first_token", pa.int64()), ("last_token", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        for batch in batches:
            ids = batch.column(0)
            rows = [(ids[row].as_py(), *leak) for row, *leak in _leaks_of(items, batch.column(1), coverage)]
            cols = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, LEAKS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per (document, item) pair whose tiles cover enough of the item
    or hold a long run."""
    parts = [_scan(docs, block, coverage) for block in item_blocks(benchmark)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], LEAKS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks no item."""
    at = docs.columns.index("text")
    for block in item_blocks(benchmark):
        docs = _keep_clean(docs, block, at, coverage)
    return docs


def _keep_clean(docs: DataFrame, block, at: int, coverage: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for row, *_ in _leaks_of(items, batch.column(at), coverage):
                clean[row] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
