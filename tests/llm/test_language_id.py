"""Language ID: gradient, position labels and documents against plain versions."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quill.llm import language_id as L, queries
from .cases import HARD

SF = "/root/testdata/sf0.01"


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    net = L.Network.fresh(["a", "b", "c"], hidden=3, kind=np.float64)
    x, lang = rng.integers(0, 4, (6, 5)), rng.integers(0, 3, 5)
    x[4:, 1], x[2:, 3] = L.PAD, L.PAD
    _, grad = net.gradient(x, lang)
    for name, v in net.params.items():
        for i in list(np.ndindex(v[:4].shape)):
            old = v[i]
            v[i] = old + 1e-6
            up = net.gradient(x, lang)[0]
            v[i] = old - 1e-6
            down = net.gradient(x, lang)[0]
            v[i] = old
            assert abs((up - down) / 2e-6 - grad[name][i]) < 1e-7, (name, i)


def plain_scores(net, raw: bytes):
    """Probabilities at each position of one segment, unit by unit."""
    p, h = net.params, net.hidden
    sig = lambda v: 1 / (1 + math.exp(-v))
    sides = []
    for way in "01":
        state, out = [0.0] * h, []
        for b in (raw if way == "0" else raw[::-1]):
            given = p["inputs" + way][b]
            mix = [[sum(p["mix" + way][k * h + u][v] * state[v] for v in range(h)) for u in range(h)] for k in range(3)]
            update = [sig(given[u] + mix[0][u]) for u in range(h)]
            reset = [sig(given[h + u] + mix[1][u]) for u in range(h)]
            new = [math.tanh(given[2 * h + u] + reset[u] * (mix[2][u] + p["inner" + way][u])) for u in range(h)]
            state = [update[u] * state[u] + (1 - update[u]) * new[u] for u in range(h)]
            out.append(state)
        sides.append(out if way == "0" else out[::-1])
    rows = []
    for f, b in zip(*sides):
        z = [math.exp(sum(w * s for w, s in zip(p["out"][k], f + b)) + p["bias"][k]) for k in range(len(net.langs))]
        rows.append([v / sum(z) for v in z])
    return rows


def test_positions_and_documents():
    net = L.Network.fresh(["x", "y"], hidden=4, seed=3)
    for v in net.params.values():
        v += np.float32(0.1)
    texts = ["", "short", None, "wörld " * 30, "a" * 64, "b" * 65]
    (row, mean), = L.document_scores(net, pa.array(texts))
    assert row == 0 and mean.shape == (6, 2)
    for text, got in zip(texts, mean):
        raw = (text or "").encode()
        want = [r for a in range(0, len(raw), L.SEGMENT) for r in plain_scores(net, raw[a:a + L.SEGMENT])]
        assert np.allclose(got, np.mean(want, axis=0) if want else 0, atol=1e-5)


def test_documents_do_not_depend_on_their_neighbours(monkeypatch):
    net = L.Network.fresh(["x", "y"], seed=3)
    texts = [f"text {i} " * (i * 7 % 40) for i in range(50)]
    (_, together), = L.document_scores(net, pa.array(texts))
    monkeypatch.setattr(L, "BATCH", 3)
    (_, small), = L.document_scores(net, pa.array(texts))
    alone = np.concatenate([next(L.document_scores(net, pa.array([t])))[1] for t in texts])
    assert np.allclose(together, small, atol=1e-6) and np.allclose(together, alone, atol=1e-6)


@pytest.fixture(scope="module")
def predicted(spark):
    return {r.doc_id: r for r in queries.op11_language_id(spark, SF).collect()}


def test_held_out_accuracy(spark, predicted):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(predicted) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert {d.doc_id for d in held} == {i for i, r in predicted.items() if r.held_out}
    assert all(0 <= r.score <= 1 for r in predicted.values())
    long = [d for d in held if len(d.text) >= 100]
    assert len(long) > 250
    assert sum(predicted[d.doc_id].lang_pred == d.lang for d in long) / len(long) > 0.98
    assert sum(predicted[d.doc_id].lang_pred == d.lang for d in held) / len(held) > 0.97


def test_sample_uses_only_allowed_labels(spark, docs_of):
    rows = [(i, f"text number {i} {'q' if zlib.crc32(str(i).encode()) % 3 == 1 else 'z'}") for i in range(90)]
    sample = L.learning_sample(docs_of([*rows, (None, "no id"), (500, None), (501, "123 456")]))
    assert len(sample) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(90))
    assert all(b.endswith(b"z") for _, b in sample)


def test_sample_is_bounded_and_spread(spark, docs_of, monkeypatch):
    monkeypatch.setattr(L, "DOCS_PER_LANG", 5)
    sample = L.learning_sample(docs_of([(i, f"{i} " + "word " * 2000 + "end") for i in range(100)]))
    assert len(sample) == 5 * L.SEGMENTS_PER_DOC


def test_hard_rows(spark, hard, clashing, empty):
    net = L.Network.fresh(["aa", "bb"], seed=1)
    rows = L.predict(hard, net).collect()
    assert len(rows) == len(HARD)
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("aa", "bb") and 0.5 <= r.score <= 1
        else:
            assert r.held_out is False
    assert sorted(map(str, L.predict(clashing, net).collect())) == sorted(map(str, rows))
    assert L.predict(empty, net).count() == 0
    assert L.train(empty) is None
    assert {r.lang_pred for r in L.predict(hard, None).collect()} == {"und"}


def test_one_language(spark, docs_of):
    docs = docs_of([(i, f"only words here {i}") for i in range(20)])
    net = L.train(docs)
    assert net.langs == ["en"]
    assert {r.lang_pred for r in L.predict(docs, net).collect()} == {"en"}
