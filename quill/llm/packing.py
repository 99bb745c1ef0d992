"""Packing: best-fit decreasing of token ids into fixed windows.

A document's ids (the tokenizer's, then the end id) are cut into full windows of
``WINDOW`` ids and one shorter rest. Full windows are sequences of their own. The
rests are dealt by hash into groups of about ``GROUP_PIECES``; each group is one
task's work: longest first, every rest goes into the open window with the least
room that still holds it, found by a segment tree over remaining capacity. A group
of that size leaves about one part-filled window, so groups cost almost no padding
and no step sees more than one group at once.

Only lengths and checksums are shuffled, never ids. Ids are computed per distinct
chunk between white space: the tokenizer's normaliser and splitter never look
across white space, so chunk ids put together are the text's ids.

Defined results: a null or empty text has just the end id; repeated rows are packed
each by itself; ties in length go by document id, start and checksum; an empty
table gives no rows; other columns are not read. Task retries give equal rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.io import written

WINDOW = 2048
END_ID = 1
GROUP_PIECES = 4096
#: distinct chunks a task remembers before it starts afresh (bounds its memory)
CACHE_CHUNKS = 600_000
#: characters of text that are encoded in one go
SLICE_CHARS = 1 << 20

_END = "\n"                              # no chunk holds white space
_CONTROL_GAPS = "\x1c\x1d\x1e\x1f"      # white space for str.split, not for the tokenizer
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_GAPS = re.compile(r"[ \t\n\r]+")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _Numbers(dict):
    """Numbers chunks in the order they are first asked for."""

    def __init__(self):
        super().__init__({_END: 0})
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.fresh.append(chunk)
        return n


class ChunkEncoder:
    """Ids of whole texts by way of remembered ids of white-space chunks.

    A chunk of letters is one unit of the tokenizer's splitter, and so is a tail of
    punctuation after it; such chunks are put together from letters and tail, and
    many letter chunks are encoded in one call, cut at the ids that end a word. Lower
    case Latin-1 letters are what the normaliser and the splitter leave as they are, so
    a copy of the tokenizer without these steps does for them."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.flat = np.array([END_ID], np.uint32)
        # per chunk: where its one or two units lie in flat, and how many ids they have
        self.start, self.size = np.array([[0, 0]]), np.array([[1, 0]])

    def _letters(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and where each ends."""
        whole = self.plain.encode_batch_fast([" ".join(chunks)], add_special_tokens=False)[0]   # no offsets
        ids = np.array(whole.ids, np.uint32)
        return ids, np.flatnonzero(self.ends_word[ids]) + 1

    def _others(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        return np.array([i for ids in each for i in ids], np.uint32), np.cumsum([len(ids) for ids in each])

    def _learn(self) -> None:
        numbers, fresh, base, latin = self.numbers, self.numbers.fresh, len(self.size), _LATIN.fullmatch
        # parallel lists: numbers of letter chunks and their letters, and so on
        letters_n, letters, others_n, others, lower_n, lower, tailed_n, stems, tails = ([] for _ in range(9))
        for n, chunk in enumerate(fresh, base):     # grows by the parts of other chunks
            if latin(chunk):
                low = chunk.lower()
                if low == chunk:
                    letters_n.append(n)
                    letters.append(chunk)
                else:
                    lower_n.append(n)
                    lower.append(numbers[low])
                continue
            stem = chunk.rstrip(punctuation)
            if stem != chunk and latin(stem):
                tailed_n.append(n)
                stems.append(numbers[stem])
                tails.append(numbers[chunk[len(stem):]])
            else:
                others_n.append(n)
                others.append(chunk)
        self.start = np.concatenate([self.start, np.zeros((len(fresh), 2), np.int64)])
        self.size = np.concatenate([self.size, np.zeros((len(fresh), 2), np.int64)])
        for n, chunks, encode in ((letters_n, letters, self._letters), (others_n, others, self._others)):
            if n:
                ids, ends = encode(chunks)
                self.start[n, 0] = len(self.flat) + np.append(0, ends[:-1])
                self.size[n, 0] = np.diff(ends, prepend=0)
                self.flat = np.concatenate([self.flat, ids])
        self.start[lower_n], self.size[lower_n] = self.start[lower], self.size[lower]
        for column, part in ((0, stems), (1, tails)):
            self.start[tailed_n, column] = self.start[part, 0]
            self.size[tailed_n, column] = self.size[part, 0]
        fresh.clear()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        if len(self.numbers) > CACHE_CHUNKS:
            self._forget()
        chunks: list[str] = []
        bounds = [0]
        for text in texts:
            if any(c in text for c in _CONTROL_GAPS):
                chunks += filter(None, _GAPS.split(text))
            else:
                chunks += text.split()
            chunks.append(_END)
            bounds.append(len(chunks))
        number = np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))
        if self.numbers.fresh:
            self._learn()
        size = self.size[number].ravel()
        before = np.cumsum(size) - size
        ids = self.flat[np.repeat(self.start[number].ravel() - before, size) + np.arange(size.sum())]
        return np.split(ids, np.append(before[::2], len(ids))[bounds[1:-1]])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch in runs of about ``SLICE_CHARS``; nulls are empty."""
    ids, texts, size = [], [], 0
    for doc, text in zip(*batch.columns):
        ids.append(doc.as_py())
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= SLICE_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def token_pieces(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Each document cut into full windows and one rest (``PIECES``)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer_path)
        for batch in batches:
            rows = []
            for docs_of, texts in _slices(batch):
                for doc, ids in zip(docs_of, encoder.encode(texts)):
                    for a in range(0, len(ids), WINDOW):
                        piece = ids[a:a + WINDOW].astype("<u4", copy=False)
                        rows.append((doc, a, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(cut, PIECES)


class RoomTree:
    """Segment tree over remaining capacity: leaf ``c`` counts the open windows with
    ``c`` ids of room, an inner node those below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that some open window has."""
        i, count = need + self.size, self.count
        if count[i]:
            return need
        while i > 1:
            if not i & 1 and count[i + 1]:      # a right neighbour holds larger rooms only
                i += 1
                while i < self.size:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int = WINDOW) -> list[tuple[int, int]]:
    """``(window, offset)`` for each of the lengths, which come longest first."""
    tree, open_by_room, used = RoomTree(capacity), [[] for _ in range(capacity + 1)], 0
    out = []
    for n in lengths:
        room = tree.tightest(n)
        if room is None:
            window, room, used = used, capacity, used + 1
        else:
            window = open_by_room[room].pop()
            tree.add(room, -1)
        out.append((window, capacity - room))
        if room > n:
            open_by_room[room - n].append(window)
            tree.add(room - n, 1)
    return out


def pack(pieces: DataFrame, n_groups: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. A sequence id holds the group in its
    upper and the window in its lower 32 bits."""
    def fit(key, group):
        t = group.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        placed = best_fit_decreasing(t["length"].to_pylist())
        first = key[0].as_py() << 32
        return t.drop_columns(["_group"]).append_column(
            "sequence_id", pa.array([first + w for w, _ in placed], pa.int64())).append_column(
            "offset", pa.array([o for _, o in placed], pa.int64()))

    # the row's place in the written table spreads equal rows as well
    group = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(n_groups))
    return pieces.withColumn("_group", group).groupBy("_group").applyInArrow(
        fit, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece of every document, with its place in a sequence."""
    pieces = written(token_pieces(docs, tokenizer_path))
    return pack(pieces, max(1, pieces.count() // GROUP_PIECES))
