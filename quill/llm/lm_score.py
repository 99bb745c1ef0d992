"""Language-model scoring by cross-entropy difference.

Two interpolated bigram models of words (ASCII lower-cased, split at white space)
share one vocabulary: the background model counts every document, the target model
those that are marked as target. A document's score is its mean loss per word under
the target model less that under the background model: the lower, the more it reads
like the target.

Every word and every bigram of all documents is in the models, at any size. Documents
are gathered into chunks of about ``CHUNK_BYTES`` of text. A chunk sends the counts of
its distinct words and bigrams, sorted by hash, to ``buckets`` of the hash range, whose
number grows with the text; a bucket adds up what all chunks sent and returns to each
chunk the sums of the keys it sent. A chunk is then scored from its texts and these
sums. So a task holds one chunk or one bucket, no one holds the whole models, and a
word in every document reaches its bucket once per chunk.

Defined results: a null or empty text has no words, losses and score 0; repeated
rows count and are scored each by itself; without target documents the target model
is uniform; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.io import written
from quill.llm.text import LOWER, SPACE, ngram_hashes, text_slices, word_hashes, word_spans

#: text of a chunk; a longer text is a chunk by itself
CHUNK_BYTES = 8 << 20
#: text whose keys a bucket gets: the parts sent are chunks times buckets, so
#: smaller ones would make too many of them
BUCKET_BYTES = 16 << 20
#: weight of the bigram estimate against the unigram one
BIGRAM_WEIGHT = 0.6

_ROWS = "chunk long, at long, doc_id long, counted boolean, scored boolean, text string, n_bytes long"
_KEYS = "bucket long, chunk long, keys binary, background binary, target binary"
_SUMS = "_chunk long, bucket long, background binary, target binary, n_words long, n long, n_target long"
SCORED = "doc_id long, n_words long, target_loss double, background_loss double"


def words_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a text column and, per row, the index of its first word (one
    more entry than rows). Hashes of words are even, those of bigrams odd."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, buf, offs in text_slices(column):
        buf = LOWER[buf]
        starts, ends, first = word_spans(buf, offs, SPACE)
        hashes.append(word_hashes(buf, starts, ends) & ~np.uint64(1))
        counts.append(np.diff(first))
    return np.concatenate(hashes), np.cumsum(np.concatenate(counts))


def rows_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def pairs_of(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bigrams within rows and where their second words stand."""
    at = np.flatnonzero(row[1:] == row[:-1]) + 1
    return ngram_hashes(h, 2)[at - 1] | np.uint64(1), at


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, which compress well where numbers are small."""
    raw = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    planes = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, an equal part of the hash range, begins in sorted keys."""
    edges = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


@dataclass
class Models:
    """What the models are trained on: documents and the ``doc_id`` of target ones."""
    docs: DataFrame
    target_ids: DataFrame


def train_models(docs: DataFrame, target_ids: DataFrame) -> Models:
    """Counts over every document; ``target_ids`` has the ``doc_id`` of target ones.
    Counting and scoring are one plan, so that the texts are dealt out once."""
    return Models(docs, target_ids.select(F.col("doc_id").cast("long").alias("_target")).where("_target is not null").distinct())


def chunked(docs: DataFrame) -> DataFrame:
    """``_ROWS``: each row with its chunk and its place there."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk, size, at = TaskContext.get().partitionId() << 32, 0, 0, 0
        for batch in batches:
            text = batch.column(3)
            n_bytes = [0 if x is None else x for x in pc.binary_length(text).to_pylist()]
            place = []
            for n in n_bytes:
                if at and size + n > CHUNK_BYTES:
                    chunk, size, at = chunk + 1, 0, 0
                place.append((own + chunk, at))
                size, at = size + n, at + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in place], pa.int64()), pa.array([a for _, a in place], pa.int64()),
                 *batch.columns[:3], text, pa.array(n_bytes, pa.int64())],
                ["chunk", "at", "doc_id", "counted", "scored", "text", "n_bytes"])

    return written(docs.mapInArrow(deal, _ROWS))


def score(docs: DataFrame, models: Models) -> DataFrame:
    """``SCORED`` and ``score``, the difference of the losses, of every document."""
    def marked(frame, counted, scored):
        return frame.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(counted).alias("counted"),
                            F.lit(scored).alias("scored"), F.col("text"))

    both = marked(docs, True, True) if docs is models.docs else \
        marked(models.docs, True, False).unionAll(marked(docs, False, True))
    rows = chunked(both)
    buckets = (rows.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET_BYTES + 1
    # the ids grow with the corpus: one plan at every size, never a broadcast
    targets = rows.where("counted").select("doc_id", "chunk", "at").join(
        models.target_ids.hint("merge"), F.col("doc_id") == F.col("_target")).select(F.col("chunk").alias("_chunk"), F.col("at").alias("_at"))

    def send(own: pa.Table, marks: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.Table.from_batches([], KEYS)
        h, first = words_of(own["text"])
        row = rows_of(first)
        pair, second = pairs_of(h, row)
        counted = own["counted"].to_numpy().astype(np.float64)
        target = np.isin(own["at"].to_numpy(), marks["_at"].to_numpy()) * counted
        where = np.concatenate([row, row[second]])
        keys, at = np.unique(np.concatenate([h, pair]), return_inverse=True)
        n, t = (np.bincount(at, w[where], len(keys)).astype(np.uint64) for w in (counted, target))
        cut = bucket_bounds(keys, buckets)
        step = keys.copy()
        step[1:] -= keys[:-1]
        # the first key of a part stands as it is
        begins = cut[:-1][cut[:-1] < len(keys)]
        step[begins] = keys[begins]
        parts = list(zip(cut[:-1], cut[1:]))
        return pa.Table.from_arrays(
            [pa.array(range(buckets), pa.int64()), pa.array([own["chunk"][0].as_py()] * buckets, pa.int64()),
             *(pa.array([packed(x[a:b]) for a, b in parts], pa.binary()) for x in (step, n, t))], schema=KEYS)

    def add(own: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in own["keys"]]
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([unpacked(x.as_py()) for x in own[name]]).astype(np.float64), len(keys))
                .astype(np.int64) for name in ("background", "target")]
        word = (keys & np.uint64(1)) == 0
        # every chunk hears from every bucket, and so learns the totals
        totals = [int((word & (sums[0] > 0)).sum()), int(sums[0][word].sum()), int(sums[1][word].sum())]
        ends = np.cumsum([len(p) for p in parts])
        back = [[packed(s[at[e - len(p):e]]) for p, e in zip(parts, ends)] for s in sums]
        n = own.num_rows
        return pa.Table.from_arrays(
            [own["chunk"], own["bucket"], pa.array(back[0], pa.binary()), pa.array(back[1], pa.binary()),
             *(pa.array([x] * n, pa.int64()) for x in totals)], schema=SUMS)

    def losses(own: pa.Table, sums: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.Table.from_batches([], SCORES)
        sums = sums.sort_by("bucket")
        size = sum(sums["n_words"].to_pylist()) + 1
        total = np.array([sum(sums["n_target"].to_pylist()), sum(sums["n"].to_pylist())], np.float64)
        h, first = words_of(own["text"])
        row = rows_of(first)
        pair, second = pairs_of(h, row)
        keys, at = np.unique(np.concatenate([h, pair]), return_inverse=True)
        counts = np.stack([np.concatenate([unpacked(x.as_py()) for x in sums[name]])
                           for name in ("target", "background")], axis=1).astype(np.float64)
        assert len(counts) == len(keys)
        of_word = counts[at[:len(h)]]
        p = (of_word + 1.0) / (total + size)
        p[second] = BIGRAM_WEIGHT * counts[at[len(h):]] / np.maximum(of_word[second - 1], 1.0) \
            + (1 - BIGRAM_WEIGHT) * p[second]
        n = np.diff(first)
        loss = [np.bincount(row, -np.log(p[:, i]), len(n)) / np.maximum(n, 1) for i in range(2)]
        out = pa.Table.from_arrays([own["doc_id"], pa.array(n), pa.array(loss[0]), pa.array(loss[1])], schema=SCORES)
        return out.filter(own["scored"])

    keys = rows.groupBy("chunk").cogroup(targets.groupBy("_chunk")).applyInArrow(send, _KEYS)
    sums = keys.groupBy("bucket").applyInArrow(add, _SUMS)
    scored = rows.groupBy("chunk").cogroup(sums.groupBy("_chunk")).applyInArrow(losses, SCORED)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))


KEYS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()),
                  ("background", pa.binary()), ("target", pa.binary())])
SUMS = pa.schema([("_chunk", pa.int64()), ("bucket", pa.int64()), ("background", pa.binary()), ("target", pa.binary()),
                  ("n_words", pa.int64()), ("n", pa.int64()), ("n_target", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                    ("target_loss", pa.float64()), ("background_loss", pa.float64())])
