"""MinHash near-dedup with sequential Bayesian verification.

A document's set is its distinct ``k``-word shingles; documents whose Jaccard
similarity is at least ``LEAST`` / 100 are linked, links make components. Equal word
sequences are one class and compared once.

1. One scan gives each class a signature of ``HASHES`` minimum hashes. ``BANDS`` bands
   of them are bucket keys: a pair at the threshold shares a bucket with probability
   1 - (1 - 0.8^4)^32, all but 5 in 10^8.
2. Verification compares signatures in batches of ``STEP``: after each batch a pair is
   pruned when the posterior probability that its similarity reaches the threshold,
   given the matches so far and a uniform prior, is below ``MISS``.
3. Survivors are verified exactly on full shingle sets (``array_intersect``).

No bucket is expanded into all its pairs. First each member meets only its bucket's
least member, and of the survivors each class verifies its best, then those still
across two components. What is left are buckets with several components. There a
class can have a link to another component only if enough of its shingles occur in
other components at all; that is counted exactly. The classes that pass and share
buckets form families, and a family is compared block by block: a task holds two
blocks of ``BLOCK`` classes, takes the pairs that share a bucket and lie in two
components through steps 2 and 3, and hands on links only. So no link between
different texts that share a bucket is lost.

Defined results: null, empty or blank texts have no shingles and link with nothing;
a text of fewer than ``k`` words has one shingle, all its words; repeated rows are
linked (equal texts); rows with a null id are in no component and are kept, but
``drop_near_duplicates`` decides by row and keeps one of a component, whatever the
ids; an empty table gives no rows; other columns are not read
(``drop_near_duplicates`` returns them unchanged).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.llm.components import components, relabel
from quill.llm.io import written
from quill.llm.text import LOWER, SPACE, mix, ngram_hashes, powers, text_slices, word_hashes, word_spans

LEAST = 80
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
MISS = 1e-6
#: a signature keeps one byte per hash; unequal minima agree in it by chance
CHANCE = 1 / 256
#: classes of a family that a task compares with as many others
BLOCK = 256

_rng = np.random.default_rng(8128)
_MULTIPLY = _rng.integers(1, 2 ** 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 2 ** 63, HASHES, dtype=np.uint64)
_SECOND = np.uint64(0xA0761D6478BD642F)

_SCANNED = "doc_id long, n_shingles long, node binary, signature binary, bands array<long>"


def row_polynomials(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each row's whole sequence of values."""
    pw, ip = powers(len(values) + 1)
    acc = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw[:len(values)], out=acc[1:])
    return mix((acc[first[1:]] - acc[first[:-1]]) * ip[first[:-1]] + np.diff(first).astype(np.uint64))


def shingles(column, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, shingle hashes, bounds, class hashes)`` per slice; a row's
    shingles may repeat, its class hash covers its whole word sequence."""
    for row, buf, offs in text_slices(column):
        buf = LOWER[buf]
        starts, ends, first = word_spans(buf, offs, SPACE)
        h = word_hashes(buf, starts, ends)
        whole = row_polynomials(h, first)
        node = np.stack([whole, row_polynomials(mix(h + _SECOND), first)], axis=1)
        n = np.diff(first)
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        bounds = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(bounds[-1], np.uint64)
        grams = ngram_hashes(h, k)
        long = np.repeat(n >= k, count)
        at = np.repeat(first[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
        out[long] = grams[at[long]]
        short = (n > 0) & (n < k)
        out[bounds[:-1][short]] = whole[short]
        yield row, out, bounds, node


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minimum hashes (rows x ``HASHES``, 32 bits) of non-empty rows."""
    out = np.empty((len(bounds) - 1, HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat((values * _MULTIPLY[i] + _ADD[i]) >> np.uint64(32), bounds[:-1])
    return out


def _scan(k: int):
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["doc_id", "n_shingles", "node", "signature", "bands"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, values, bounds, node in shingles(batch.column(1), k):
                full = np.diff(bounds) > 0
                cut = np.append(bounds[:-1][full], bounds[-1])
                sig = signatures(values, cut) if full.any() else np.zeros((0, HASHES), np.uint32)
                wide = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
                keys = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
                for j in range(ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, j])
                keys = keys.view(np.int64)
                low = (sig & 0xFF).astype(np.uint8)
                cols, s = [[], [], [], [], []], 0
                for i in range(len(full)):
                    a, b = bounds[i], bounds[i + 1]
                    if full[i]:
                        values_of = (len(np.unique(values[a:b])), node[i].tobytes(), low[s].tobytes(), keys[s])
                        s += 1
                    else:
                        values_of = (0, None, None, None)
                    for c, v in zip(cols[1:], values_of):
                        c.append(v)
                cols[0] = ids[row:row + len(full)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c
                                                  for c, t in zip(cols, types)], names)

    return scan


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For each number of compared hashes ``STEP``, ``2 STEP``...: the fewest matches
    with which the posterior of similarity >= threshold is still ``miss`` or more."""
    p = threshold + (1 - threshold) * CHANCE
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 1):       # uniform prior: a Beta(m + 1, n - m + 1) posterior
            total += math.comb(n + 1, m) * p ** m * (1 - p) ** (n + 1 - m)
            if total >= miss:
                out.append(m)
                break
    return out


def survivors(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequential test of row pairs of two signature matrices: the rows that no batch
    of hashes rules out, and their matches."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for j, bar in enumerate(least_matches(LEAST / 100)):
        part = slice(j * STEP, (j + 1) * STEP)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= bar]
    return alive, matches[alive]


def matrix(column, kind, width: int) -> np.ndarray:
    """Equally long binary values as the rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, signatures) that survive, with their matches."""
    for batch in batches:
        alive, matches = survivors(*(matrix(batch.column(i), np.uint8, HASHES) for i in (2, 3)))
        keep = pa.array(alive)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep),
                                          pa.array(matches, pa.int32())], ["a", "b", "matches"])


def _compare_blocks(key, group):
    """Links among the classes of two blocks (or of one with itself)."""
    group = group.combine_chunks()
    column = lambda name: group[name].chunk(0) if group.num_rows else group[name]
    nodes, labels = column("node").to_pylist(), column("label").to_pylist()
    block = column("block").to_numpy()
    signature = matrix(column("signature"), np.uint8, HASHES)
    bands = column("bands").values.to_numpy().reshape(-1, BANDS)
    sets = [x.values.to_numpy() for x in column("shingles")]
    number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    label = np.array([number[x] for x in labels])
    left = np.flatnonzero(block == key[1].as_py())
    right = np.flatnonzero(block == key[2].as_py())
    shared = np.zeros((len(left), len(right)), bool)
    for j in range(BANDS):
        shared |= bands[left, j][:, None] == bands[right, j][None, :]
    shared &= label[left][:, None] != label[right][None, :]
    x, y = np.nonzero(shared)
    x, y = left[x], right[y]
    if key[1] == key[2]:
        x, y = x[x < y], y[x < y]
    size = np.array([len(s) for s in sets])
    near = 100 * np.minimum(size[x], size[y]) >= LEAST * np.maximum(size[x], size[y])
    x, y = x[near], y[near]
    alive, _ = survivors(signature[x], signature[y])
    out = []
    for a, b in zip(x[alive].tolist(), y[alive].tolist()):
        common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if 100 * common >= LEAST * (size[a] + size[b] - common):
            out.append((nodes[a], nodes[b]))
    return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})


def several_labels(rows: DataFrame) -> DataFrame:
    """The rows (band, node, label) of bands with two labels or more."""
    mixed = rows.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y")
    return rows.join(mixed.select("band"), "band")


class NearDuplicates:
    """The steps over one table; ``docs`` needs ``doc_id`` and ``text``."""

    def __init__(self, docs: DataFrame, k: int):
        self.docs, self.k = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), k
        self.scanned = written(self.docs.mapInArrow(_scan(k), _SCANNED))
        usable = self.scanned.where("node is not null and doc_id is not null")
        self.classes = written(usable.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands")))

    def members(self) -> DataFrame:
        """``(band, least, node)`` of buckets with two classes or more."""
        all_ = self.classes.select("node", F.explode("bands").alias("band"))
        buckets = all_.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least != most")
        return all_.join(buckets.select("band", "least"), "band").select("band", "least", "node")

    def surviving(self, pairs: DataFrame) -> DataFrame:
        """Candidate pairs (a, b) that the sequential test does not prune."""
        sig = self.classes.select("node", "signature", "n")
        a = sig.select(F.col("node").alias("a"), F.col("signature").alias("sa"), F.col("n").alias("na"))
        b = sig.select(F.col("node").alias("b"), F.col("signature").alias("sb"), F.col("n").alias("nb"))
        near = pairs.join(a, "a").join(b, "b").where(f"100 * least(na, nb) >= {LEAST} * greatest(na, nb)")
        return near.select("a", "b", "sa", "sb").mapInArrow(_prune, "a binary, b binary, matches int")

    def shingle_sets(self, nodes: DataFrame) -> DataFrame:
        """``(node, n, shingles)``: the full sets of the given classes."""
        k = self.k

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                want = batch.column(0).to_pylist()
                for row, values, bounds, node in shingles(batch.column(1), k):
                    # rows that only share the id of the wanted class are not it
                    own = [(want[row + i], np.unique(values[a:b]).view(np.int64))
                           for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if node[i].tobytes() == want[row + i]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in own], pa.binary()), pa.array([len(o[1]) for o in own], pa.int64()),
                         pa.array([o[1] for o in own], pa.list_(pa.int64()))], ["node", "n", "shingles"])

        rows = self.docs.join(self.classes.select("node", "doc_id").join(nodes, "node"), "doc_id").select("node", "text")
        return rows.mapInArrow(sets, "node binary, n long, shingles array<long>")

    @staticmethod
    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the threshold."""
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        common = F.size(F.array_intersect("x", "y")).cast("long")
        union = F.size("x") + F.size("y") - common
        return pairs.join(b, "b").join(a, "a").where(100 * common >= LEAST * union).select("a", "b").distinct()

    def across(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs that lie in two components, as far as is known."""
        la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        return pairs.join(la, "a", "left").join(lb, "b", "left").where(
            "coalesce(la, a) != coalesce(lb, b)").select("a", "b")

    def open_classes(self, members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """``(band, node, label)``: buckets with several components, as far as their
        classes can still have a link to another one."""
        labelled = members.select("band", "node").join(labels, "node", "left").select(
            "band", "node", F.coalesce("label", "node").alias("label"))
        open_ = written(several_labels(labelled))
        own = open_.select("node", "label").distinct().join(sets, "node")
        spread = own.select("node", "label", "n", F.explode("shingles").alias("s"))
        foreign = spread.groupBy("s").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("s")
        # common >= LEAST / (100 + LEAST) of both sizes together, and the least partner has LEAST / 100 of one's own
        least_n = open_.join(own.select("node", "n"), "node").groupBy("band").agg(F.min("n").alias("m"))
        partner = open_.join(least_n, "band").groupBy("node").agg(F.min("m").alias("m"))
        able = spread.join(foreign, "s").groupBy("node", "n").agg(F.count("*").alias("c")).join(partner, "node").where(
            f"{100 + LEAST} * c >= {LEAST} * (n + greatest(m, {LEAST} * n / 100))").select("node")
        return written(several_labels(open_.join(able, "node")))

    def links_across(self, members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between the components of a bucket, compared in blocks."""
        open_ = self.open_classes(members, labels, sets)
        least = open_.groupBy("band").agg(F.min("node").alias("a"))
        family = components(open_.join(least, "band").where("a != node").select("a", F.col("node").alias("b")).distinct())
        family = family.select("node", F.col("label").alias("family"))
        blocks = family.groupBy("family").agg((F.count("*") / BLOCK + 1).cast("int").alias("blocks"))
        rows = (open_.select("node", "label").distinct().join(family, "node").join(blocks, "family")
                .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .join(sets.select("node", "shingles").dropDuplicates(["node"]), "node")
                .join(self.classes.select("node", "signature", "bands"), "node"))
        return (rows.groupBy("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
                .applyInArrow(_compare_blocks, "a binary, b binary"))

    def labels(self) -> DataFrame:
        """``(node, label)`` of the classes that have a link."""
        members = written(self.members())
        stars = written(self.surviving(members.where("least != node").select(
            F.col("least").alias("a"), F.col("node").alias("b")).distinct()))
        sets = written(self.shingle_sets(members.select("node").distinct()))
        best = stars.groupBy("b").agg(F.max(F.struct("matches", "a")).alias("m")).select("m.a", "b")
        labels = components(self.verified(best, sets))
        labels = self.joined(labels, self.verified(self.across(stars, labels), sets))
        return self.joined(labels, self.links_across(members, labels, sets))

    @staticmethod
    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        """``labels`` after components that ``links`` connect became one."""
        la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        named = links.join(la, "a", "left").join(lb, "b", "left").select(
            F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a != b")
        merged = components(written(named))
        known = labels.unionAll(merged.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
        return written(relabel(known, merged))

    def result(self) -> DataFrame:
        """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
        labels = self.labels()
        named = self.classes.select("node", "doc_id").join(labels, "node", "left").select(
            "node", "doc_id", F.coalesce("label", "node").alias("label"))
        least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        by_node = named.join(least, "label").select("node", "component_id")
        rows = self.scanned.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
        rows = rows.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        return rows.select("doc_id", "n_shingles", "component_id",
                           F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """Component of every document under ``k``-word shingles."""
    return NearDuplicates(docs, k).result()


def _with_node(docs: DataFrame, k: int) -> DataFrame:
    """``docs`` and ``_near_node``, the class of each row's text; rows without words go."""
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [node[i].tobytes() if bounds[i + 1] > bounds[i] else None
                     for _, _, bounds, node in shingles(batch.column(at), k) for i in range(len(node))]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())],
                                             [*batch.schema.names, "_near_node"])
            yield out.filter(out.column(out.num_columns - 1).is_valid())

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField("_near_node", T.BinaryType())]))


def drop_near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row of each component, all columns: the least id's (rows without an id come last), of
    rows that repeat id and words the one with the least hash. Rows without words stay."""
    keys = ["_near_node", "_near_id"]
    # rows without an id get one by their text, above the usual ids
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(F.lit(2 ** 62 - 1)) + F.lit(2 ** 62))
    found = NearDuplicates(docs.select(doc_id.alias("doc_id"), "text"), k)
    least = (found.classes.select("node", "doc_id").join(found.labels(), "node", "left")
             .groupBy(F.coalesce("label", "node").alias("label")).agg(F.min(F.struct("doc_id", "node")).alias("m"))
             .select(F.col("m.node").alias(keys[0]), F.col("m.doc_id").alias(keys[1])))
    rows = _with_node(docs, k).withColumn(keys[1], doc_id)
    # a row per component: one plan at every size, never a broadcast
    kept = rows.join(least.hint("merge"), keys).groupBy(*keys).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_near_row")).select("_near_row.*")
    blank = docs.where("text is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    return kept.unionAll(blank)
