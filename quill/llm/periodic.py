"""Periodic runs: stretches of words that repeat with a short period.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are identical) that no neighbouring word extends with that period; those of at least
``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods are reported.

Method: block convolution. At each dyadic scale ``B`` a text is cut into blocks of
``B`` words, words being numbered. The sum of squared differences between a block and
the text at distance ``d`` is zero exactly where the block occurs again; it is got for
all ``B <= d < 2B`` at once from a number-theoretic transform (NTT) of twice the
block's length, modulo as many primes as its largest possible value needs, so that it
is exact. Distances with zero mismatch are seeds: chains of neighbouring blocks with
one distance are extended word by word to both sides. A run of period ``q`` and four
periods holds a whole block of the scale ``B <= q < 2B`` together with its copy at
distance ``q``, so none is missed; a stretch found at several multiples of its period
keeps the least. Blocks with a word that does not occur again at such a distance can't
have a copy and skip the transform.

One scan, no shuffle. Words are told apart by 64-bit hashes within a text (two words of
one text collide with probability 2^-64). A task holds one slice of a batch, or one
text where a text is longer; work is n log^2 n in the words of a text.

Defined results: a null or empty text, or one of blanks, has no words and no runs;
repeated rows and rows with a null id are each searched by themselves; ties for the
greatest run go to the smallest start, then period; very long texts are searched whole;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.text import SPACE, text_slices, word_hashes, word_spans

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: NTT primes with a primitive root; the first has roots of order up to 2^27
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
#: numbers transformed in one go (bounds a task's memory)
TABLE = 1 << 20

RUNS = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string"
_RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                   ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                   ("kept", pa.string())])


def _roots(n: int, prime: int, generator: int, inverse: bool) -> list[np.ndarray]:
    """Per stage (half = 1, 2, ... n/2) the powers of a root of order ``2 * half``."""
    out, half = [], 1
    while half < n:
        root = pow(generator, (prime - 1) // (2 * half), prime)
        if inverse:
            root = pow(root, -1, prime)
        w = np.ones(half, np.uint64)
        size = 1
        while size < half:                              # doubling: w[size:2 size] = w[:size] * root^size
            w[size:2 * size] = w[:size] * np.uint64(pow(root, size, prime)) % np.uint64(prime)
            size *= 2
        out.append(w)
        half *= 2
    return out


class Transform:
    """NTT of columns of length ``n`` (a power of two) modulo one prime."""

    def __init__(self, n: int, prime: int, generator: int):
        self.n, self.prime = n, np.uint64(prime)
        self.ahead = _roots(n, prime, generator, False)
        self.back = _roots(n, prime, generator, True)
        self.shrink = np.uint64(pow(n, -1, prime))

    def _less(self, x: np.ndarray) -> np.ndarray:
        """``x`` below ``2 * prime`` reduced: an unsigned difference below 0 is huge."""
        return np.minimum(x, x - self.prime)

    def forward(self, a: np.ndarray) -> np.ndarray:
        """Natural order in, bit-reversed out; ``a`` is ``(n, columns)``."""
        columns = a.shape[1]
        for w in reversed(self.ahead):
            x = a.reshape(-1, 2, len(w), columns)
            u, v = x[:, 0], x[:, 1]
            a = np.empty_like(x)
            a[:, 0] = self._less(u + v)
            a[:, 1] = (u + (self.prime - v)) * w[:, None] % self.prime
        return a.reshape(self.n, columns)

    def inverse(self, a: np.ndarray) -> np.ndarray:
        """Bit-reversed order in, natural out."""
        columns = a.shape[1]
        for w in self.back:
            x = a.reshape(-1, 2, len(w), columns)
            u, t = x[:, 0], x[:, 1] * w[:, None] % self.prime
            a = np.empty_like(x)
            a[:, 0] = self._less(u + t)
            a[:, 1] = self._less(u + (self.prime - t))
        return a.reshape(self.n, columns) * self.shrink % self.prime


def _primes_for(bound: int) -> tuple:
    """The fewest primes whose product exceeds ``bound``."""
    product, used = 1, []
    for prime in PRIMES:
        used.append(prime)
        product *= prime[0]
        if product > bound:
            return tuple(used)
    raise OverflowError("a text too long for exact convolution")


def occurrences(ids: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(block start, distance)`` of every zero-mismatch occurrence of the blocks
    ``ids[s:s + size]`` at a distance of ``size`` to ``2 * size - 1``. Places past the
    end of ``ids`` count as equal to its last word: callers cut them off."""
    n, found = 2 * size, []
    width = max(1, TABLE // n)
    within, last = np.arange(size), len(ids) - 1
    for a in range(0, len(blocks), width):
        s = blocks[a:a + width]
        own = ids[s[None, :] + within[:, None]].astype(np.uint64)                   # (size, columns)
        window = ids[np.minimum(s[None, :] + size + np.arange(n - 1)[:, None], last)].astype(np.uint64)
        zero = None
        top = int(max(own.max(), window.max()))
        for prime, generator in _primes_for(size * top * top):
            p = np.uint64(prime)
            move = Transform(n, prime, generator)
            left = np.zeros((n, len(s)), np.uint64)
            left[(-within) % n] = own % p
            right = np.zeros_like(left)
            right[:n - 1] = window % p
            cross = move.inverse(move.forward(left) * move.forward(right) % p)[:size]
            squares = (own % p) ** np.uint64(2) % p
            acc = np.zeros((n, len(s)), np.uint64)
            np.cumsum((window % p) ** np.uint64(2) % p, axis=0, out=acc[1:])
            mismatch = (squares.sum(axis=0) + acc[size:] - acc[:size] + (p - cross) * np.uint64(2)) % p
            zero = mismatch == 0 if zero is None else zero & (mismatch == 0)
        j, column = np.nonzero(zero)
        found.append((s[column], size + j))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return tuple(np.concatenate(c) for c in zip(*found))


def _equal_ahead(ids: np.ndarray, at: np.ndarray, d: np.ndarray, room: np.ndarray, sign: int) -> np.ndarray:
    """How many words from ``at`` on (to the left if ``sign`` is -1) equal the word
    ``d`` further on, at most ``room``."""
    total = np.zeros(len(at), np.int64)
    active, width = np.flatnonzero(room > 0), 16
    while len(active):
        done = []
        step = np.arange(width)
        for a in range(0, len(active), max(1, TABLE // width)):
            k = active[a:a + max(1, TABLE // width)]
            left = room[k] - total[k]
            i = (at[k] + sign * total[k])[:, None] + sign * np.minimum(step, left[:, None] - 1)
            differ = (ids[i] != ids[i + d[k][:, None]]) | (step >= left[:, None])
            n = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            total[k] += n
            done.append(k[n == width])
        active = np.concatenate(done)
        active = active[total[active] < room[active]]
        width = min(2 * width, TABLE)
    return total


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(start, length, period)`` of the runs of all texts, by start and period.
    ``ids`` holds the texts' words one after another, numbered from 1 within each
    text; text ``i`` has ``ids[bounds[i]:bounds[i + 1]]``."""
    size_of = np.diff(bounds)
    n = len(ids)
    start, end, period = (np.zeros(0, np.int64) for _ in range(3))
    none = (start, start, start)
    if not n or size_of.max() < LEAST_WORDS:
        return none
    text = np.repeat(np.arange(len(size_of)), size_of)
    # places sorted by text, word and place: finds a word's next place from a given one on
    key = (text * (int(ids.max()) + 1) + ids) * (n + 1)
    placed = np.sort(key + np.arange(n))
    last_place = placed[np.searchsorted(placed, key + n, "right") - 1] - key
    spare = last_place - np.arange(n)                   # to the word's last place in its text
    size = 1
    while 4 * size <= size_of.max():
        own = np.flatnonzero(size_of >= max(LEAST_PERIODS * size, LEAST_WORDS))
        count = size_of[own] // size - 1                # a block and a copy must fit
        first = np.repeat(bounds[own], count)
        blocks = first + (np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)) * size
        stop = np.repeat(bounds[own + 1], count)
        words = np.arange(size)
        for k in {0, size - 1}:                         # cheap look at two words, then at all
            nxt = placed[np.minimum(np.searchsorted(placed, key[blocks + k] + blocks + k + size), n - 1)] - key[blocks + k]
            fits = (spare[blocks + k] >= size) & (nxt < blocks + k + 2 * size)
            blocks, stop = blocks[fits], stop[fits]
        if size > 2 and len(blocks):
            low = np.empty(len(blocks), bool)
            for a in range(0, len(blocks), max(1, TABLE // size)):
                part = blocks[a:a + max(1, TABLE // size)]
                low[a:a + len(part)] = spare[part[:, None] + words].min(axis=1) >= size
            blocks, stop = blocks[low], stop[low]
        s, d = occurrences(ids, blocks, size)
        fits = s + d + size <= stop[np.searchsorted(blocks, s)]
        s, d = s[fits], d[fits]
        if len(start):                                  # inside a known stretch: a multiple of its period
            reach = np.zeros(n + 1, np.int64)
            np.maximum.at(reach, start, end)
            new = s + d + size > np.maximum.accumulate(reach)[s]
            s, d = s[new], d[new]
        if len(s):
            order = np.lexsort((s, d))
            s, d = s[order], d[order]
            begins = np.ones(len(s), bool)
            begins[1:] = (d[1:] != d[:-1]) | (s[1:] - s[:-1] != size)
            begins[1:] |= text[s[1:]] != text[s[:-1]]
            a, q = s[begins], d[begins]
            b = s[np.append(np.flatnonzero(begins)[1:] - 1, len(s) - 1)] + size
            a = a - _equal_ahead(ids, a - 1, q, a - bounds[text[a]], -1)
            b = b + _equal_ahead(ids, b, q, bounds[text[a] + 1] - b - q, 1)
            start, end, period = (np.concatenate(c) for c in ((start, a), (end, b + q), (period, q)))
        size *= 2
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep &= end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, length, period = start[keep], (end - start)[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def number_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words numbered from 1 within each text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), np.int64)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    rank = np.cumsum(new)
    before = np.concatenate([[0], rank])[bounds[:-1]]   # distinct words of earlier texts
    out = np.empty(len(h), np.int64)
    out[order] = rank - before[t]
    return out


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document (``RUNS``): its runs by start and period, and the words
    kept when of each run only its first period stays, joined by single spaces."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, texts = batch.column(0).to_pylist(), batch.column(1)
            for row, buf, offs in text_slices(texts):
                starts, ends, bounds = word_spans(buf, offs, SPACE)
                ids = number_words(word_hashes(buf, starts, ends), bounds)
                run = find_runs(ids, bounds)
                cut = np.searchsorted(run[0], bounds)
                raw, rows = buf.tobytes(), []
                for i in range(len(bounds) - 1):
                    words = raw[offs[i]:offs[i + 1]].split()
                    own = [{"start": s - int(bounds[i]), "length": m, "period": q}
                           for s, m, q in zip(*(c[cut[i]:cut[i + 1]].tolist() for c in run))]
                    if own:
                        step = np.zeros(len(words) + 1, np.int64)
                        for r in own:
                            step[r["start"] + r["period"]] += 1
                            step[r["start"] + r["length"]] -= 1
                        words = [w for w, gone in zip(words, np.cumsum(step[:-1]).tolist()) if not gone]
                    rows.append({"doc_id": doc[row + i], "n_words": int(bounds[i + 1] - bounds[i]), "runs": own,
                                 "kept": b" ".join(words).decode()})
                yield pa.RecordBatch.from_pylist(rows, schema=_RUNS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, RUNS)


def run_summary(found: DataFrame) -> DataFrame:
    """Number of runs, the greatest one, and digests of all runs and of the words kept."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
                    F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
                    F.floor(F.lit(1000) * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where one document in ten, by a checksum of its id, repeats
    one of its own stretches of words to its end. A document without words or id
    stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def planted(words: Column, g: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(words, i.cast("int"))), " ")

    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.floor(h / 10).alias("_g"),
                         F.when(chosen, words).alias("_words"))
    return marked.select("doc_id", F.when(F.col("_words").isNotNull(), planted(F.col("_words"), F.col("_g")))
                         .otherwise(F.col("text")).alias("text"))
