"""Where windows of a fixed length occur twice: the exchange that the exact
substring operators share.

A unit is a byte or a word, a window ``window`` consecutive units of one text. Every
window has an anchor: the ``gram``-unit run inside it with the least hash (leftmost
on ties), so equal windows have equal anchors at equal places. Consecutive windows
with the same anchor form a run. A run is known by its anchor (``key``) and by its
whole content (``body``); equal windows lie in runs with equal keys, so

* runs equal in key and body are repeats as a whole: counted, never compared;
* runs equal in key alone may share some windows: their texts' stretches (one per
  distinct content) meet in a task and a *resolver* compares them.

Tasks first aggregate what they have read, so a passage that a third of all rows
share crosses the network once per task, not once per row.

A key with more than ``GROUP`` distinct stretches, such as a passage shorter than the window
with another continuation in every text, would bring them all to one resolver.
It is settled window by window instead: each window is a run of its own, known by its
anchor and by its whole content, and dealt by both, so that windows meet only
their equals; tasks aggregate equal ones first.

Identity of keys and bodies is by 64-bit hashes each. Texts of one row id are told apart
by 15 bits of a hash of theirs: two different texts under one id take each other's
places with probability 2^-15.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.io import written
from quill.llm.text import BYTE_VALUE, SPACE, U64, mix, powers, range_hash, text_slices, word_hashes, word_spans

#: units of a text that are looked at in one go (bounds a task's memory)
PIECE = 1 << 19
#: runs a task gathers before it hands them on
FLUSH_RUNS = 1 << 19
#: distinct stretches of one key that a resolver gets together at most
GROUP = 256
_POS_BITS = U64(21)

# a place packs 16 bits of the text's hash (to tell rows with the same id apart),
# 36 bits of start and 12 bits of the number of windows
_N_BITS, _AT_BITS = 12, 36


def pack_place(tag: int, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return ((tag << (_N_BITS + _AT_BITS)) | (start << _N_BITS) | n).astype(np.int64)


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(tag, start, number of windows)``"""
    return (place >> (_N_BITS + _AT_BITS)) & 0x7FFF, (place >> _N_BITS) & ((1 << _AT_BITS) - 1), place & ((1 << _N_BITS) - 1)


@dataclass(frozen=True)
class Plan:
    """``words``: units are words, else bytes. ``ordered``: a window counts only in
    rows with a larger id than some other row that has it; else any second place,
    the same row included, makes it a repeat."""
    window: int
    gram: int
    words: bool
    ordered: bool

    def unit_values(self, column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first row, 64-bit value per unit, bounds)`` per slice of a column."""
        for row, buf, offs in text_slices(column):
            if self.words:
                starts, ends, first = word_spans(buf, offs, SPACE)
                yield row, word_hashes(buf, starts, ends), first
            else:
                yield row, BYTE_VALUE[buf], offs

    def texts(self, column) -> Iterator[tuple[int, np.ndarray]]:
        for row, values, bounds in self.unit_values(column):
            for i in range(len(bounds) - 1):
                yield row + i, values[bounds[i]:bounds[i + 1]]


def prefix(values: np.ndarray) -> np.ndarray:
    pw, _ = powers(len(values) + 1)
    acc = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw[:len(values)], out=acc[1:])
    return acc


def text_tag(values: np.ndarray) -> int:
    """15 bits that tell texts of the same row id apart."""
    if not len(values):
        return 0
    return int(mix(np.array([values.sum(dtype=np.uint64) + U64(len(values))]))[0] >> U64(49))


def sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` consecutive values."""
    n = len(v)
    rows = -(-n // w)
    full = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = v
    blocks = full.reshape(rows, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - w + 1], before[w - 1:n])


def runs_of(values: np.ndarray, window: int, gram: int):
    """``(key, body, start, n)`` of every run of windows of one text."""
    out = []
    for a in range(0, len(values) - window + 1, PIECE):
        part = values[a:a + PIECE + window - 1]
        acc = prefix(part)
        i = np.arange(len(part) - gram + 1)
        grams = range_hash(acc, i, i + gram)
        pos = sliding_least((grams >> _POS_BITS << _POS_BITS) | i.astype(np.uint64), window - gram + 1)
        pos &= (U64(1) << _POS_BITS) - U64(1)
        start = np.concatenate([[0], np.flatnonzero(np.diff(pos)) + 1])
        n = np.diff(np.append(start, len(pos)))
        out.append((grams[pos[start].astype(np.int64)], range_hash(acc, start, start + n + window - 1), start + a, n))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return out[0] if len(out) == 1 else tuple(np.concatenate(c) for c in zip(*out))


def _first_of(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in columns sorted together."""
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = False
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _settle(plan: Plan, key, body, row, place, many):
    """Sorts runs by content and says which are repeats and which stand for the rest.

    Returns ``(order, first, repeat, stands)``: the sort order, where each content
    begins in it and, both in that order, the runs that are repeats as a whole and
    those that other tasks still need to see."""
    order = np.lexsort((place, row, body, key))
    key, body, row, many = key[order], body[order], row[order], many[order]
    first = _first_of(key, body)
    size = np.diff(np.append(first, len(key)))
    if plan.ordered:
        least = np.repeat(row[first], size)
        return order, first, row > least, row == least
    several = np.repeat((size > 1) | np.maximum.reduceat(many, first), size)
    stands = np.zeros(len(key), bool)
    stands[first] = True
    return order, first, several, stands


_EXCHANGE = "bucket long, mark boolean, keys binary, bodies binary, rows binary, places binary, many binary"
_FOUND = "row long, place long, key long, parts int, many boolean"


def _exchange_batch(rows) -> pa.RecordBatch:
    names = ["bucket", "mark", "keys", "bodies", "rows", "places", "many"]
    types = [pa.int64(), pa.bool_(), *[pa.binary()] * 5]
    cols = list(zip(*rows)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _hand_on(plan: Plan, n_buckets: int, parts) -> pa.RecordBatch:
    """A task's runs ``(key, body, row, place, many)``, aggregated, as one row per bucket."""
    key, body, row, place, many = (np.concatenate(c) for c in zip(*parts))
    order, first, repeat, stands = _settle(plan, key, body, row, place, many)
    key, body, row, place, many = (c[order] for c in (key, body, row, place, many))
    out = []
    if repeat.any():
        out.append((int(key[0] >> U64(1)) % n_buckets, True, b"", b"", row[repeat].tobytes(),
                    place[repeat].tobytes(), b""))
    if not plan.ordered:
        many = repeat
    key, body, row, place, many = (c[stands] for c in (key, body, row, place, many))
    bucket = (mix(key) % U64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    key, body, row, place, many, bucket = (c[order] for c in (key, body, row, place, many, bucket))
    cuts = np.append(_first_of(bucket), len(bucket))
    out += [(int(bucket[a]), False, key[a:b].tobytes(), body[a:b].tobytes(), row[a:b].tobytes(),
             place[a:b].tobytes(), many[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    return _exchange_batch(out)


def _in_flushes(plan: Plan, n_buckets: int, runs: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    parts, size = [], 0
    for run in runs:
        parts.append(run)
        size += len(run[0])
        if size >= FLUSH_RUNS:
            yield _hand_on(plan, n_buckets, parts)
            parts, size = [], 0
    if size:
        yield _hand_on(plan, n_buckets, parts)


def _gather(plan: Plan, n_buckets: int):
    """Scan: every text's runs, aggregated per task, as one row per bucket of keys."""
    def runs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, values in plan.texts(batch.column(1)):
                if len(values) < plan.window:
                    continue
                key, body, start, n = runs_of(values, plan.window, plan.gram)
                yield (key, body, np.full(len(key), ids[i], np.int64), pack_place(text_tag(values), start, n),
                       np.zeros(len(key), bool))

    return lambda batches: _in_flushes(plan, n_buckets, runs(batches))


def _gather_windows(plan: Plan, n_buckets: int):
    """Joined rows (row, text, edges): every window of the stretches of crowded keys as
    a run of its own."""
    def windows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, edges = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for i, values in plan.texts(batch.column(1)):
                tag = text_tag(values)
                for e in edges[i].as_py():
                    own, start, n = _place(e["place"])
                    if own != tag or e["parts"] == 1:
                        continue
                    at = np.arange(n)
                    body = range_hash(prefix(values[start:start + n + plan.window - 1]), at, at + plan.window)
                    key = mix(U64(e["key"] & 0xFFFFFFFFFFFFFFFF) ^ body)
                    yield (key, body, np.full(n, ids[i], np.int64), pack_place(tag, start + at, np.ones(n, np.int64)),
                           np.full(n, e["many"]))

    return lambda batches: _in_flushes(plan, n_buckets, windows(batches))


def _meet(plan: Plan):
    """One bucket of keys: whole repeats, and stretches that need a resolver."""
    def found(row, place, key, parts, many) -> pa.RecordBatch:
        n = len(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), pa.array(place, pa.int64()),
             pa.array(np.zeros(n, np.int64) if key is None else key.view(np.int64), pa.int64()),
             pa.array(np.zeros(n, np.int32) if parts is None else parts, pa.int32()),
             pa.array(np.zeros(n, bool) if many is None else many, pa.bool_())],
            ["row", "place", "key", "parts", "many"])

    def settled(cols) -> Iterator[pa.RecordBatch]:
        key, body, row, place, many = (np.concatenate(c) for c in cols)
        order, first, repeat, stands = _settle(plan, key, body, row, place, many)
        key, body, row, place = key[order], body[order], row[order], place[order]
        yield found(row[repeat], place[repeat], None, None, None)
        by_key = _first_of(key)
        size = np.diff(np.append(by_key, len(key)))
        contents = np.add.reduceat(np.isin(np.arange(len(key)), first, assume_unique=True).astype(np.int64), by_key)
        needs = contents > 1
        if plan.ordered:
            needs &= np.minimum.reduceat(row, by_key) < np.maximum.reduceat(row, by_key)
        pick = np.repeat(needs, size) & stands
        parts = np.repeat(np.where(contents > GROUP, 2, 1), size).astype(np.int32)
        several = repeat if not plan.ordered else np.zeros(len(key), bool)
        yield found(row[pick], place[pick], key[pick], parts[pick], several[pick])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols, bucket = [[], [], [], [], []], None
        for batch in batches:
            for r in (x for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
                if r["mark"]:
                    yield found(np.frombuffer(r["rows"], np.int64), np.frombuffer(r["places"], np.int64), None, None, None)
                    continue
                if r["bucket"] != bucket and cols[0]:   # buckets come one after another
                    yield from settled(cols)
                    cols = [[], [], [], [], []]
                bucket = r["bucket"]
                for c, name, kind in zip(cols, ("keys", "bodies", "rows", "places", "many"),
                                         (np.uint64, np.uint64, np.int64, np.int64, bool)):
                    c.append(np.frombuffer(r[name], kind))
        if cols[0]:
            yield from settled(cols)

    return meet


_STRETCH = "key long, row long, place long, many boolean, units binary"


def _cut_stretches(plan: Plan):
    """Joined rows (row, text, edges): the units of every stretch a resolver needs."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, edges = batch.column(0), batch.column(2)
            raw = None if plan.words else batch.column(1)
            out = []
            for i, values in plan.texts(batch.column(1)):
                tag = text_tag(values)
                data = None if plan.words else raw[i].as_py().encode()
                for e in edges[i].as_py():
                    own, start, n = _place(e["place"])
                    if own != tag or e["parts"] > 1:
                        continue
                    end = start + n + plan.window - 1
                    units = values[start:end].tobytes() if plan.words else data[start:end]
                    out.append((e["key"], row[i].as_py(), e["place"], e["many"], units))
            cols = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["key", "row", "place", "many", "units"])

    return cut


def _place(place: int) -> tuple[int, int, int]:
    return (place >> (_N_BITS + _AT_BITS)) & 0x7FFF, (place >> _N_BITS) & ((1 << _AT_BITS) - 1), place & ((1 << _N_BITS) - 1)


#: A resolver gets the stretches of some keys, ``(key, row, place, many, units)`` with
#: equal keys next to each other and rows ascending, and yields ``(row, place)`` of
#: repeated windows.
Resolver = Callable[[Iterator[tuple]], Iterator[tuple[int, int]]]


def _resolve(resolver: Resolver):
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stretches():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def out(rows, places):
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(places, pa.int64())], ["row", "place"])

        rows, places = [], []
        for row, place in resolver(stretches()):
            rows.append(row)
            places.append(place)
            if len(rows) == 100_000:
                yield out(rows, places)
                rows, places = [], []
        yield out(rows, places)

    return resolve


def find_repeats(texts: DataFrame, plan: Plan, resolver: Resolver) -> DataFrame:
    """``row`` and ``places``, the list of packed places of all repeated windows of
    that row, for the rows of ``texts`` (columns ``row`` long and ``text``) that have
    any. Rows with a null ``row`` take no part."""
    spark = texts.sparkSession
    n_buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.select("row", "text").where("row is not null and text != ''")
    found = written(texts.mapInArrow(_gather(plan, n_buckets), _EXCHANGE)
                    .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet(plan), _FOUND))
    edges = found.where("parts > 0").groupBy("row").agg(
        F.collect_list(F.struct("key", "place", "parts", "many")).alias("edges"))
    joined = texts.join(edges, "row").select("row", "text", "edges")
    few, many = (joined.where(f"exists(edges, e -> e.parts = {n})") for n in (1, 2))
    stretches = (few.mapInArrow(_cut_stretches(plan), _STRETCH)
                 .repartition("key").sortWithinPartitions("key", "row", "place"))
    resolved = stretches.mapInArrow(_resolve(resolver), "row long, place long")
    # of windows that are runs of their own none is left for a resolver; a task sends one
    # message to each of the shuffle's partitions
    counted = (many.mapInArrow(_gather_windows(plan, n_buckets // 8), _EXCHANGE).repartition("bucket")
               .sortWithinPartitions("bucket").mapInArrow(_meet(plan), _FOUND))
    marks = found.where("parts = 0").unionAll(counted.where("parts = 0")).select("row", "place").unionAll(resolved)
    return marks.groupBy("row").agg(F.collect_list("place").alias("places"))


def covered(places, tag: int, n_units: int, window: int) -> np.ndarray:
    """Which units of a text lie in a repeated window."""
    step = np.zeros(n_units + 1, np.int64)
    own, start, n = unpack_place(np.asarray(places, np.int64))
    mine = own == tag
    np.add.at(step, start[mine], 1)
    np.add.at(step, start[mine] + n[mine] + window - 1, -1)
    return np.cumsum(step[:-1]) > 0
