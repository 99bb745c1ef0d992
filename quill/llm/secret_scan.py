"""Secret scans: base patterns plus formats learned by grammar inference.

The values that the base patterns find are the labelled credentials (label: the
kind); ``plain`` is the label of ordinary tokens, one of each document without a base
span. For each label a prefix tree of distinct values is folded into a probabilistic
automaton by merging states whose end and next-character frequencies agree within a
Hoeffding bound (red-blue order). The bound is wide for few examples, so an automaton
of a handful of values is close to a table of character frequencies; one of a single value
allows its own characters only.

Every token of every text, ``CANDIDATE_BYTES`` bytes or longer, is then scored by its mean
log-likelihood per character. A token that no base span touches becomes a span of kind
``format`` when some format finds it at least as likely as the least likely hundredth of
the values held out from its training (every other value; with a single one, that; with
fewer than 100, an estimate from their mean and spread where that is lower), it is as long as that format's shortest value, and ordinary tokens' automaton finds it
less likely. Tokens of a batch go through the automata side by side.

The learning sample is the only bounded part: at most ``SAMPLE`` values a label, by hash
order over all documents' values, and ``SAMPLE_CHARS`` characters in all; a value longer than
``VALUE_CHARS`` does not teach. Scans and scores read every whole text.

Defined results: a null or empty text has no spans; repeated rows are scanned each
by itself; a label without any value has no automaton, so without labelled values
there are only base spans; ties go to the first kind by name; a token of any length is one
candidate; positions are code points, end exclusive; other columns are not read
(``redact_secrets`` returns them unchanged).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.io import written
from quill.llm.text import mix, text_slices, word_hashes, word_spans

#: Base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "format")

SAMPLE = 600
SAMPLE_CHARS = 40_000
VALUE_CHARS = 1024
ALPHA = 0.05
CANDIDATE_BYTES = 6
PLAIN = "plain"

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_IS_HEX = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
#: bytes that are in no candidate token
_NO_TOKEN = np.array([not re.match(rb"[A-Za-z0-9+/_=-]", bytes([c])) for c in range(256)])


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, str, str]]:
    """``(start, rank, end, kind, value)`` of the base patterns; ``raw`` is the
    text's UTF-8, on which cheap searches rule most texts out."""
    out = []
    low = raw.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end(), "assign", m.group(2)) for m in ASSIGN.finditer(text)
                if len(m.group(2)) >= LEAST["assign"]]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end(), "access", m.group()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST["access"]]
    if b"x" * LEAST["hex"] in raw.translate(_IS_HEX):
        out += [(m.start(), 2, m.end(), "hex", m.group()) for m in HEX.finditer(text)
                if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


class Automaton:
    """Deterministic probabilistic automaton inferred from example strings."""

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.seen, self.ends = [0], [0]
        self.next: list[dict[str, int]] = [{}]
        self.times: list[dict[str, int]] = [{}]
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        for value in values:
            self._insert(value)
        self._merge()

    def _insert(self, value: str) -> None:
        s = 0
        self.seen[0] += 1
        for c in value:
            if c not in self.next[s]:
                self.next[s][c] = len(self.seen)
                for column, empty in ((self.seen, 0), (self.ends, 0), (self.next, {}), (self.times, {})):
                    column.append(empty)
            self.times[s][c] = self.times[s].get(c, 0) + 1
            s = self.next[s][c]
            self.seen[s] += 1
        self.ends[s] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.width * (n1 ** -0.5 + n2 ** -0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.seen[a], self.seen[b]
            if self._differ(self.ends[a], na, self.ends[b], nb):
                return False
            for c in self.times[a].keys() | self.times[b].keys():
                if self._differ(self.times[a].get(c, 0), na, self.times[b].get(c, 0), nb):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to the automaton at ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, n in self.times[b].items():
                self.times[a][c] = self.times[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge(self) -> None:
        red = [0]
        while True:
            known = set(red)
            blue = sorted((s, r, c) for r in red for c, s in self.next[r].items() if s not in known)
            if not blue:
                return
            state, parent, c = max(blue, key=lambda x: (self.seen[x[0]], -x[0]))
            for r in red:
                if self._compatible(r, state):
                    self.next[parent][c] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)

    def score(self, value: str) -> float:
        """Mean log-likelihood per character, the end included."""
        s, total = 0, 0.0
        for c in value:
            n = self.seen[s]
            total += math.log((self.times[s].get(c, 0) + 0.01) / (n + 1))
            s = self.next[s].get(c, s)
        total += math.log((self.ends[s] + 0.01) / (self.seen[s] + 1))
        return total / (len(value) + 1)


def infer_formats(labelled: dict[str, list[str]]) -> dict[str, tuple[Automaton, float, int]]:
    """Per label: automaton of every other value, least score and least length a
    candidate needs, taken from the values in between."""
    out = {}
    for kind, values in sorted(labelled.items()):
        if not values:
            continue
        train, held = values[::2], values[1::2] or values
        machine = Automaton(train)
        scores = sorted(machine.score(v) for v in held)
        least = scores[len(scores) // 100]
        if 1 < len(values) and len(scores) < 100:
            # no hundredth to be seen yet: where it would lie if scores were normal, with a
            # spread that few values underrate
            spread = float(np.std([machine.score(v) for v in values], ddof=1)) * (1 + 4 / len(scores))
            least = min(least, sum(scores) / len(scores) - 2.33 * spread)
        out[kind] = (machine, least, min(map(len, values)))
    return out


class Scorer:
    """The automata as tables, to score many tokens side by side."""

    def __init__(self, formats: dict[str, tuple[Automaton, float, int]]):
        self.kinds = [k for k in sorted(formats) if k != PLAIN]
        self.least = np.array([formats[k][1] for k in self.kinds])
        self.size = np.array([formats[k][2] for k in self.kinds], np.int64)
        self.tables = [self._table(formats[k][0]) for k in self.kinds]
        self.plain = self._table(formats[PLAIN][0]) if PLAIN in formats else None

    @staticmethod
    def _table(machine: Automaton):
        """Next state and log-likelihood per state and byte, and of ending there. A byte
        that a state doesn't know leaves the state as it is."""
        n = len(machine.seen)
        seen = np.maximum(np.array(machine.seen, float), 1.0)
        step = np.repeat(np.arange(n, dtype=np.int32)[:, None], 256, axis=1)
        gain = np.repeat(np.log(0.01 / (seen + 1))[:, None], 256, axis=1)
        for s in range(n):
            for c, to in machine.next[s].items():
                if ord(c) < 256:
                    step[s, ord(c)] = to
                    gain[s, ord(c)] = math.log((machine.times[s].get(c, 0) + 0.01) / (seen[s] + 1))
        return step.ravel(), gain.ravel(), np.log((np.array(machine.ends, float) + 0.01) / (seen + 1))

    @staticmethod
    def _scores(table, buf: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Mean log-likelihood per character, the end included; longest tokens first."""
        step, gain, end = table
        state, total = np.zeros(len(starts), np.int32), np.zeros(len(starts))
        for k in range(int(length[0]) if len(length) else 0):
            m = np.searchsorted(-length, -k, "left")        # tokens with more than k bytes
            at = state[:m].astype(np.int64) * 256 + buf[starts[:m] + k]
            total[:m] += gain[at]
            state[:m] = step[at]
        return (total + end[state]) / (length + 1)

    def margins(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token the best margin over a format's least score (-inf if it is shorter
        than all of them), and whether it is a find."""
        order = np.argsort(starts - ends, kind="stable")
        s, length = starts[order], (ends - starts)[order]
        plain = self._scores(self.plain, buf, s, length) if self.plain else np.full(len(s), -np.inf)
        best, found = np.full(len(s), -np.inf), np.zeros(len(s), bool)
        for table, least, size in zip(self.tables, self.least, self.size):
            score = self._scores(table, buf, s, length)
            margin = np.where(length >= size, score - least, -np.inf)
            found |= (margin >= 0) & (score > plain)
            best = np.maximum(best, margin)
        out, hit = np.empty(len(s)), np.empty(len(s), bool)
        out[order], hit[order] = best, found
        return out, hit


def candidate_tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all tokens that are long enough."""
    starts, ends, first = word_spans(buf, offs, _NO_TOKEN)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    long = ends - starts >= CANDIDATE_BYTES
    return starts[long], ends[long], row[long]


def labelled_values(docs: DataFrame, sample: int = SAMPLE) -> dict[str, list[str]]:
    """At most ``sample`` distinct base values of each kind, and as many ordinary tokens,
    by hash order."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = [], []
            for first, buf, offs in text_slices(batch.column(0)):
                starts, ends, row = candidate_tokens(buf, offs)
                hashes = mix(word_hashes(buf, starts, ends)) if len(starts) else np.zeros(0, np.uint64)
                order = np.lexsort((hashes, row))
                least = order[np.flatnonzero(np.diff(row[order], prepend=-1))]      # one token of each text
                plain = dict(zip(row[least].tolist(), zip(starts[least].tolist(), ends[least].tolist())))
                data = buf.tobytes()
                for i in range(len(offs) - 1):
                    raw = data[offs[i]:offs[i + 1]]
                    own = base_spans(raw.decode(), raw)
                    for _, _, _, kind, value in own:
                        kinds.append(kind)
                        values.append(value)
                    if not own and i in plain:
                        a, b = plain[i]
                        kinds.append(PLAIN)
                        values.append(data[a:b].decode())
            short = [len(v) <= VALUE_CHARS for v in values]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, ok in zip(kinds, short) if ok], pa.string()),
                                              pa.array([v for v, ok in zip(values, short) if ok], pa.string())],
                                             ["kind", "value"])

    found = written(docs.select("text").mapInArrow(find, "kind string, value string").distinct())   # one scan for all kinds
    per_kind = None
    for kind in (*LEAST, PLAIN):
        top = found.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(sample)
        per_kind = top if per_kind is None else per_kind.unionAll(top)
    out: dict[str, list[str]] = {}
    for r in per_kind.collect():
        out.setdefault(r.kind, []).append(r.value)
    for kind, values in out.items():
        values.sort(key=lambda x: hashlib.md5(x.encode()).digest())
        total = np.cumsum([len(v) for v in values])
        out[kind] = values[:max(1, int(np.searchsorted(total, SAMPLE_CHARS, "right")))]
    return out


def column_spans(column, scorer: Scorer | None) -> Iterator[tuple[str, list[tuple[int, int, int, str]], float | None]]:
    """Per text of a column: the text, ``(start, rank, end, kind)`` of base and learned spans,
    and the best margin of any candidate over its format's least score."""
    for _, buf, offs in text_slices(column):
        finds: dict[int, list[tuple[int, int]]] = {}
        best = np.full(len(offs) - 1, -np.inf)
        if scorer is not None and scorer.kinds:
            starts, ends, row = candidate_tokens(buf, offs)
            margin, hit = scorer.margins(buf, starts, ends)
            np.maximum.at(best, row, margin)
            for i, a, b in zip(row[hit].tolist(), starts[hit].tolist(), ends[hit].tolist()):
                finds.setdefault(i, []).append((a - int(offs[i]), b - int(offs[i])))
        data = buf.tobytes()
        for i in range(len(offs) - 1):
            raw = data[offs[i]:offs[i + 1]]
            text = raw.decode()
            spans = [(s, r, e, k) for s, r, e, k, _ in base_spans(text, raw)]
            taken = [(s, e) for s, _, e, _ in spans]
            at = chars = 0
            for a, b in finds.get(i, ()):
                chars += len(raw[at:a].decode())            # bytes to code points
                at, s, e = a, chars, chars + b - a
                if not any(x < e and s < y for x, y in taken):
                    spans.append((s, 3, e, "format"))
            yield text, sorted(spans), float(best[i]) if np.isfinite(best[i]) else None


def all_spans(text: str, formats) -> tuple[list[tuple[int, int, int, str]], float | None]:
    """Spans and best margin of one text."""
    (_, spans, best), = column_spans(pa.array([text], pa.large_string()), Scorer(formats) if formats else None)
    return spans, best


SPANS = "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>, best_margin double"


def scan_secrets(docs: DataFrame, formats=None) -> DataFrame:
    """One row per document (``SPANS``), spans by start and kind."""
    formats = infer_formats(labelled_values(docs)) if formats is None else formats
    schema = pa.schema([("doc_id", pa.int64()),
                        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                                      ("end", pa.int64())]))),
                        ("best_margin", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(formats)
        for batch in batches:
            rows = []
            for doc, (_, spans, best) in zip(batch.column(0).to_pylist(), column_spans(batch.column(1), scorer)):
                rows.append({"doc_id": doc, "best_margin": best,
                             "spans": [{"kind": k, "start": s, "end": e} for s, _, e, k in spans]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, SPANS)


def secret_summary(scanned: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != "format")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"),
                          F.sha2(joined(base), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"), "best_margin")


def redact_secrets(docs: DataFrame, formats=None, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark`` and
    ``n_chars``, where there is such a column, counted anew for changed texts."""
    formats = infer_formats(labelled_values(docs)) if formats is None else formats
    at = docs.columns.index("text")
    n_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(formats)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            sizes = batch.column(n_at).to_pylist() if n_at is not None else None
            for i, (text, spans, _) in enumerate(column_spans(batch.column(at), scorer)):
                if not spans:
                    continue
                out, end = [], 0
                for s, _, e, _ in spans:
                    if s >= end:
                        out += [text[end:s], mark]
                    end = max(end, e)
                texts[i] = "".join(out) + text[end:]
                if sizes is not None:
                    sizes[i] = len(texts[i])
            cols = list(batch.columns)
            cols[at] = pa.array(texts, cols[at].type)
            if sizes is not None:
                cols[n_at] = pa.array(sizes, cols[n_at].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(redact, docs.schema)
