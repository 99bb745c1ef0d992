"""Language ID by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes. In each, one gated
recurrent layer reads forwards and one backwards; at every position both states
together give a probability per language, so every byte of every text is labelled. A
document's probability is the mean over all its positions.

The network is trained in numpy by backpropagation through time (whole segments) with
Adam on the cross-entropy at every position. It learns from at most ``DOCS_PER_LANG``
documents a language, by hash order over all labelled documents, and at most
``SEGMENTS_PER_DOC`` segments of each, spread evenly over the whole text; this sample is
the one bounded part. Labels come from ``lang`` of documents whose ``crc32(doc_id as
text) mod 3`` is not 1.

Scoring is one scan without a shuffle; the parameters (some 10 kB) travel with the tasks.
A task holds the states of ``BATCH`` segments at a time, however long a text is.

Defined results: ``und`` with score 0 for a text that is null, empty or without any
letter, and for every text when there is nothing to learn from; with one language to
learn, every other text gets that one; ties go to the first language by name; repeated
rows are predicted each by itself; rows with a null id are not held out, and nothing is
learned from them; an empty table gives no rows; other columns are not read, ``lang``
only for learning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.text import text_slices

SEGMENT = 64
BATCH = 2048
HIDDEN = 8
DOCS_PER_LANG = 256
SEGMENTS_PER_DOC = 8
EPOCHS = 6
MINIBATCH = 256
RATE = 0.03
#: byte value that stands for no byte, where a segment ends early
PAD = 256
UNDECIDED = "und"

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def _sigmoid(x: np.ndarray) -> None:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


@dataclass
class Network:
    """Per direction ``inputs`` (257 x 3H: what each byte adds to update gate, reset gate
    and candidate), ``mix`` (3H x H: what the state adds) and ``inner`` (the candidate's
    bias inside the reset); ``out`` (languages x 2H) and ``bias``. States are columns."""
    langs: list[str]
    params: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return len(self.params["inner0"])

    @classmethod
    def fresh(cls, langs: list[str], hidden: int = HIDDEN, seed: int = 7, kind=np.float32) -> Network:
        rng, h = np.random.default_rng(seed), hidden
        params = {"out": rng.normal(0, 0.3, (len(langs), 2 * h)), "bias": np.zeros(len(langs))}
        for way in "01":
            params["inputs" + way] = rng.normal(0, 0.5, (257, 3 * h))
            params["inputs" + way][:, :h] += 0.5        # starts with a memory of a few bytes
            params["mix" + way] = rng.normal(0, 0.3, (3 * h, h))
            params["inner" + way] = np.zeros(h)
        return cls(langs, {k: v.astype(kind) for k, v in params.items()})

    def states(self, x: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """``(steps, hidden, segments)`` for segments ``x`` (steps x segments); with
        ``keep``, also what the way back needs. A position without a byte leaves the
        state alone."""
        h = self.hidden
        inputs, mix, inner = (self.params[k + way] for k in ("inputs", "mix", "inner"))
        state = np.zeros((h, x.shape[1]), mix.dtype)
        out = np.empty((len(x), h, x.shape[1]), mix.dtype)
        pad = x == PAD
        padded = pad.any(axis=1)
        for t in range(len(x)) if way == "0" else range(len(x) - 1, -1, -1):
            given = np.ascontiguousarray(np.take(inputs, x[t], axis=0).T)
            mixed = mix @ state
            gate, rec = mixed[:2 * h], mixed[2 * h:]
            gate += given[:2 * h]
            _sigmoid(gate)
            update, reset = gate[:h], gate[h:]
            if padded[t]:
                update[:, pad[t]] = 1
            rec += inner[:, None]
            new = rec * reset
            new += given[2 * h:]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((t, state, update, reset, rec, new))
            state = state - new
            state *= update
            state += new
            out[t] = state
        return out

    def position_scores(self, x: np.ndarray, keep=(None, None)) -> tuple[np.ndarray, np.ndarray]:
        """States of both directions, and probabilities ``(steps, languages, segments)``."""
        both = np.concatenate([self.states(x, "0", keep[0]), self.states(x, "1", keep[1])], axis=1)
        z = self.params["out"] @ both
        z += self.params["bias"][:, None]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return both, z

    def gradient(self, x: np.ndarray, lang: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions with a byte, and its gradient."""
        p, h, keep = self.params, self.hidden, ([], [])
        both, prob = self.position_scores(x, keep)
        real = x != PAD
        n = max(int(real.sum()), 1)
        column = np.arange(x.shape[1])
        loss = -np.log(np.maximum(prob[:, lang, column], 1e-30))[real].sum() / n
        dz = prob.copy()
        dz[:, lang, column] -= 1
        dz *= (real / dz.dtype.type(n))[:, None, :]
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["out"] = (dz @ both.transpose(0, 2, 1)).sum(axis=0)
        grad["bias"] = dz.sum(axis=(0, 2))
        dboth = p["out"].T @ dz
        for way, dout, steps in (("0", dboth[:, :h], keep[0]), ("1", dboth[:, h:], keep[1])):
            mix = p["mix" + way]
            carry, given = np.zeros_like(dout[0]), np.empty((len(x), 3 * h, x.shape[1]), dout.dtype)
            for t, state, update, reset, rec, new in reversed(steps):
                d = dout[t] + carry
                dnew = d * (1 - update) * (1 - new * new)
                dupdate = d * (state - new) * update * (1 - update)
                dupdate[:, ~real[t]] = 0                # the gate is fixed there
                dreset = dnew * rec * reset * (1 - reset)
                given[t] = np.concatenate([dupdate, dreset, dnew])
                dmixed = np.concatenate([dupdate, dreset, dnew * reset])
                carry = d * update + mix.T @ dmixed
                grad["mix" + way] += dmixed @ state.T
                grad["inner" + way] += dmixed[2 * h:].sum(axis=1)
            order = np.argsort(x, axis=None, kind="stable")     # sums per byte value
            value, first = np.unique(x.ravel()[order], return_index=True)
            by_place = given.transpose(0, 2, 1).reshape(-1, 3 * h)[order]
            grad["inputs" + way][value] = np.add.reduceat(by_place, first, axis=0)
        return float(loss), grad


def segment_starts(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each segment of each text begins, and its text."""
    count = -(-np.diff(offs) // SEGMENT)
    text = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return offs[text] + nth * SEGMENT, text


def segment_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Segments as columns (``SEGMENT`` x segments), ``PAD`` after their text's end."""
    at = starts + np.arange(SEGMENT)[:, None]
    return np.where(at < ends, buf[np.minimum(at, len(buf) - 1)].astype(np.int64), PAD)


def fit(langs: list[str], x: np.ndarray, lang: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Network trained on segments ``x`` (columns) of languages ``lang`` (numbers)."""
    net, rng = Network.fresh(langs, seed=seed), np.random.default_rng(seed)
    m1, m2 = ({k: np.zeros_like(v) for k, v in net.params.items()} for _ in range(2))
    # languages count alike, however many segments they have
    per = [np.flatnonzero(lang == i) for i in range(len(langs))]
    most, step = max(map(len, per)), 0
    steps = epochs * (-(-most * len(langs) // MINIBATCH))
    for _ in range(epochs):
        order = rng.permutation(np.concatenate([np.resize(rng.permutation(i), most) for i in per]))
        for a in range(0, len(order), MINIBATCH):
            part = order[a:a + MINIBATCH]
            _, grad = net.gradient(x[:, part], lang[part])
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-12))
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                net.params[k] -= (rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def learning_sample(docs: DataFrame) -> list[tuple[str, bytes]]:
    """``(lang, bytes of one segment)`` of the bounded sample."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).where(
        "doc_id is not null and lang is not null").where(~held_out() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    # a hash bar that some more than enough documents pass, then exactly the least hashes
    place = F.xxhash64("doc_id", "text")
    bar = F.lit(0.0)
    for lang, n in counts.items():
        share = min(1.0, (DOCS_PER_LANG + 10 * DOCS_PER_LANG ** 0.5) / n)
        bar = F.when(F.col("lang") == lang, F.lit(2.0 * share - 1.0)).otherwise(bar)
    chosen = labelled.withColumn("place", place).where(F.col("place") / F.lit(2.0 ** 63) <= bar)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lang, at in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                n = -(-len(raw) // SEGMENT)
                pick = sorted({i * n // SEGMENTS_PER_DOC for i in range(SEGMENTS_PER_DOC)})
                rows.append({"lang": lang, "place": at, "parts": [raw[i * SEGMENT:(i + 1) * SEGMENT] for i in pick]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("lang", pa.string()), ("place", pa.int64()), ("parts", pa.list_(pa.binary()))]))

    rows = chosen.select("text", "lang", "place").mapInArrow(cut, "lang string, place long, parts array<binary>").collect()
    taken: dict[str, int] = {}
    out = []
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"], r["parts"])):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= DOCS_PER_LANG:
            out += [(r["lang"], bytes(b)) for b in r["parts"]]
    return out


def train(docs: DataFrame, epochs: int = EPOCHS) -> Network | None:
    """Network learned from the labelled documents that are not held out; None when
    there are none."""
    sample = learning_sample(docs)
    if not sample:
        return None
    langs = sorted({lang for lang, _ in sample})
    x = np.full((SEGMENT, len(sample)), PAD, np.int64)
    for i, (_, raw) in enumerate(sample):
        x[:len(raw), i] = np.frombuffer(raw, np.uint8)
    number = {lang: i for i, lang in enumerate(langs)}
    return fit(langs, x, np.array([number[lang] for lang, _ in sample]), epochs)


def document_scores(net: Network, column) -> Iterator[tuple[int, np.ndarray]]:
    """``(first row, mean probability per row and language)`` per slice of a column;
    rows without bytes get 0."""
    for row, buf, offs in text_slices(column):
        total = np.zeros((len(offs) - 1, len(net.langs)))
        starts, text = segment_starts(offs)
        for a in range(0, len(starts), BATCH):          # a very long text goes through in pieces
            own = text[a:a + BATCH]
            x = segment_bytes(buf, starts[a:a + BATCH], offs[own + 1])
            prob = net.position_scores(x)[1]
            prob *= (x != PAD)[:, None, :]
            np.add.at(total, own, prob.sum(axis=0).T)
        yield row, total / np.maximum(np.diff(offs), 1)[:, None]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``PREDICTED`` for every document."""
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text",
                         has_letter.alias("decidable"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, score = np.zeros(n, np.int64), np.zeros(n)
            decidable = batch.column(3).to_numpy(zero_copy_only=False).astype(bool) & (net is not None)
            if decidable.any():
                for row, mean in document_scores(net, batch.column(2)):
                    best[row:row + len(mean)] = mean.argmax(axis=1)
                    score[row:row + len(mean)] = mean.max(axis=1)
            names = [net.langs[b] if d else UNDECIDED for b, d in zip(best.tolist(), decidable.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()),
                                              pa.array(np.where(decidable, np.clip(score, 0, 1), 0.0))],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return chosen.mapInArrow(label, PREDICTED)
