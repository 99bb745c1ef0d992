"""Suffix-array dedup: bytes inside a long string that starts anywhere else go.

:mod:`quill.llm.repeats` brings the stretches that may share a window of ``WINDOW``
bytes together. There a suffix array is built in two stages: only suffixes smaller
than their successors are sorted directly; scanning the buckets of first bytes from
the least up then induces the place of every other suffix from its successor's.
Neighbours in the array whose common prefix reaches ``WINDOW`` bytes are repeats.
Only suffixes that start a window in question, and those their places are induced
from, enter the array.

Matches never cross texts; overlapping ones count, also within one text. A very long text
is looked at in pieces that overlap by a window, so it is whole to every match.

Defined results: a null or empty text has no bytes and no spans; repeated rows lose
every byte that a window covers, each of them; an empty table gives no rows; rows
with a null id take part like any other; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.repeats import Plan, covered, find_repeats, pack_place, text_tag, unpack_place
from quill.llm.text import BYTE_VALUE

WINDOW = 400
PLAN = Plan(window=WINDOW, gram=200, words=False, ordered=False)
#: bytes of whole key groups that share one suffix array
ARRAY_BYTES = 1 << 19


def _next_true(flag: np.ndarray) -> np.ndarray:
    """Index of the first true entry at or after each place (length if none)."""
    at = np.where(flag, np.arange(len(flag)), len(flag))
    return np.minimum.accumulate(at[::-1])[::-1]


def suffix_order(blocks: list[bytes], wanted: np.ndarray, depth: int) -> tuple[bytes, list[int]]:
    """The blocks put together, and the ``wanted`` positions in the order of their
    suffixes (each ends with its block; at least ``depth`` bytes are compared)."""
    data = b"".join(blocks)
    d = np.frombuffer(data, np.uint8).astype(np.int16)
    end = np.cumsum([len(b) for b in blocks])
    last = np.zeros(len(d), bool)
    last[end - 1] = True
    # a suffix is smaller than its successor if the first unequal next byte is larger;
    # the one-byte suffix at a block's end is larger than the empty one after it
    step = np.zeros(len(d), np.int16)
    step[:-1] = np.sign(d[1:] - d[:-1])
    step[last] = -1
    smaller = step[_next_true(step != 0)] > 0
    # larger suffixes need their successors, up to the next smaller one or the end
    stop = _next_true(smaller | last)
    reach = np.zeros(len(d) + 1, np.int64)
    np.add.at(reach, np.flatnonzero(wanted), 1)
    np.add.at(reach, stop[wanted] + 1, -1)
    need = np.cumsum(reach[:-1]) > 0

    block_end = np.repeat(end, [len(b) for b in blocks])
    direct = np.flatnonzero(need & smaller)
    until = np.minimum(direct + depth, block_end[direct])
    keyed = sorted(zip([data[a:b] for a, b in zip(direct.tolist(), until.tolist())], direct.tolist()))
    small = [[] for _ in range(256)]
    for key, i in keyed:
        small[key[0]].append(i)
    del keyed

    large = [[] for _ in range(256)]
    for i in np.flatnonzero(need & last).tolist():      # after the empty suffixes
        large[data[i]].append(i)
    induced = need & ~smaller & ~last
    before = np.zeros(len(d), bool)
    before[1:] = induced[:-1]
    induces = before.tolist()
    order = []
    for c in range(256):
        bucket = large[c]
        for i in bucket:                                # grows while it is scanned
            if induces[i]:
                large[data[i - 1]].append(i - 1)
        for i in small[c]:
            if induces[i]:
                large[data[i - 1]].append(i - 1)
        order += bucket
        order += small[c]
    mine = wanted.tolist()
    return data, [i for i in order if mine[i]]


def repeated_starts(blocks: list[bytes], wanted: np.ndarray, window: int) -> np.ndarray:
    """Which wanted positions begin a window that begins at another one too."""
    data, order = suffix_order(blocks, wanted, window)
    again = np.zeros(len(wanted), bool)
    prior, prior_text = -1, None
    for i in order:
        text = data[i:i + window]
        if text == prior_text:
            again[i] = again[prior] = True
        prior, prior_text = i, text
    return again


def resolve(stretches: Iterator[tuple], plan: Plan = PLAN) -> Iterator[tuple[int, int]]:
    """Resolver: repeated windows among the stretches of each key."""
    def settle(held):
        blocks = [s[4] for s in held]
        starts = np.cumsum([0, *map(len, blocks)])
        wanted = np.zeros(starts[-1], bool)
        for a, (_, _, place, _, _) in zip(starts, held):
            wanted[a:a + (place & 0xFFF)] = True
        again = repeated_starts(blocks, wanted, plan.window)
        for a, (_, row, place, many, _) in zip(starts, held):
            tag, start, n = (int(x) for x in unpack_place(np.int64(place)))
            if many:                                    # known to be a repeat as a whole
                continue
            hit = np.flatnonzero(again[a:a + n])
            if len(hit):
                cut = np.flatnonzero(np.diff(hit) > 1) + 1
                for run in np.split(hit, cut):
                    yield row, int(pack_place(tag, np.int64(start + run[0]), np.int64(len(run))))

    held, size, group = [], 0, None
    for s in stretches:
        if size >= ARRAY_BYTES and s[0] != group:
            yield from settle(held)
            held, size = [], 0
        group = s[0]
        held.append(s)
        size += len(s[4])
    if held:
        yield from settle(held)


DEDUPED = "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"


def remove_repeats(docs: DataFrame, plan: Plan = PLAN) -> DataFrame:
    """One row per document (``DEDUPED``): removed byte spans and the bytes kept."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      F.xxhash64("doc_id", "text").alias("row"))
    marked = own.join(find_repeats(own, plan, lambda s: resolve(s, plan)), "row", "left").select("doc_id", "text", "places")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, places in zip(*batch.columns):
                data = (text.as_py() or "").encode()
                spans, kept = [], data
                if places.is_valid:
                    buf = np.frombuffer(data, np.uint8)
                    gone = covered(places.values.to_numpy(), text_tag(BYTE_VALUE[buf]), len(buf), plan.window)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    spans = [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                    kept = buf[~gone].tobytes()
                rows.append({"doc_id": doc.as_py(), "n_bytes": len(data), "spans": spans, "kept": kept})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return marked.mapInArrow(cut, DEDUPED)


def repeat_summary(deduped: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return deduped.select("doc_id", "n_bytes", removed.alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
