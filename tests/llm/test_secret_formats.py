"""Learned formats: few and short values, every token a candidate, tables as automata."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quill.llm import secret_scan as S

ORDINARY = "themselves yesterday morning remembered carefully between another thousand walking children"


def labelled(n, make, seed=1):
    rng = random.Random(seed)
    return [make(rng) for _ in range(n)]


def digits_and_dashes(rng):
    return "-".join("".join(rng.choice("0123456789") for _ in range(3)) for _ in range(3))


def test_five_values_are_enough():
    formats = S.infer_formats({"assign": labelled(5, digits_and_dashes), "plain": ORDINARY.split()})
    assert set(formats) == {"assign", "plain"} and formats["assign"][2] == 11
    other = digits_and_dashes(random.Random(99))
    text = f"{ORDINARY} {other} {ORDINARY}"
    spans, best = S.all_spans(text, formats)
    assert spans == [(len(ORDINARY) + 1, 3, len(ORDINARY) + 12, "format")] and best >= 0


def test_one_value_allows_its_own_characters_only():
    formats = S.infer_formats({"assign": ["kH7+q=2z"]})
    assert S.all_spans("say kH7+q=2z and kH7+q=2y z2=q+7Hk kH7+q=2", formats)[0] == [(4, 3, 12, "format"), (26, 3, 34, "format")]
    assert S.infer_formats({"assign": []}) == {} and S.all_spans("kH7+q=2z", {}) == ([], None)


def test_short_values_and_tokens_without_digits_or_letters():
    """Six characters, letters only: no gate of length or kind of character."""
    rng = random.Random(3)
    word = lambda r: "".join(r.choice("QXZJKV") for _ in range(6))
    formats = S.infer_formats({"assign": [word(rng) for _ in range(40)], "plain": ORDINARY.split()})
    assert S.all_spans(f"a {word(rng)} b", formats)[0] == [(2, 3, 8, "format")]
    assert S.all_spans(ORDINARY, formats)[0] == []


def test_ordinary_tokens_win_over_a_loose_format():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["the", "an", "re", "in", "on", "at", "er"]) for _ in range(rng.randint(3, 6)))
    formats = S.infer_formats({"assign": [word()[:5] + str(rng.randrange(10 ** 6, 10 ** 7)) for _ in range(30)], "plain": [word() for _ in range(200)]})
    assert S.all_spans(" ".join(word() for _ in range(100)), formats)[0] == []
    assert S.all_spans(f"say {word()[:5]}7302918 so", formats)[0] == [(4, 3, 16, "format")]


@pytest.mark.parametrize("seed", range(3))
def test_tables_score_like_the_automaton(seed):
    rng = random.Random(seed)
    token = lambda: "".join(rng.choice("abcXYZ019+/_=-") for _ in range(rng.randint(6, 30)))
    formats = S.infer_formats({"x": [token() for _ in range(60)], "y": [token()[:8] for _ in range(30)], "plain": [token() for _ in range(30)]})
    tokens = [token() for _ in range(50)] + ["q" * 500]
    buf = np.frombuffer(" ".join(tokens).encode(), np.uint8)
    starts, ends, _ = S.candidate_tokens(buf, np.array([0, len(buf)]))
    margin, hit = S.Scorer(formats).margins(buf, starts, ends)
    for t, m, h in zip(tokens, margin, hit):
        own = {k: machine.score(t) - least for k, (machine, least, size) in formats.items() if len(t) >= size and k != "plain"}
        assert math.isclose(max(own.values(), default=-math.inf), m, abs_tol=1e-9)
        plain = formats["plain"][0].score(t)
        assert h == any(v >= 0 and v + formats[k][1] > plain for k, v in own.items())


def test_positions_are_code_points_and_base_spans_stay():
    formats = S.infer_formats({"assign": ["0123456789"] * 4})
    text = "é漢 0123456789 password=0123456789 ü 0123456789"
    spans, _ = S.all_spans(text, formats)
    assert [(text[s:e], k) for s, _, e, k in spans] == [("0123456789", "format"), ("password=0123456789", "assign"), ("0123456789", "format")]


def test_learning_from_documents(spark, docs_of):
    """Few labelled values in the corpus; null, empty and long texts beside them."""
    rng = random.Random(5)
    rows = [(i, f"{ORDINARY} password: {digits_and_dashes(rng)} {ORDINARY}") for i in range(5)]
    hidden = digits_and_dashes(rng)
    rows += [(100 + i, f"{ORDINARY.split()[i % 10]} number {i}{i}") for i in range(20)] + [(200, f"x {hidden} y"), (201, None), (202, ""), (203, "z" * 3000)]
    values = S.labelled_values(docs_of(rows))
    assert len(values["assign"]) == 5 and len(values["plain"]) > 5 and all(len(v) <= S.VALUE_CHARS for v in values["plain"])
    got = {r.doc_id: r for r in S.secret_summary(S.scan_secrets(docs_of(rows))).collect()}
    assert got[200].spans == "format:2:13" and got[200].n_assign == 0
    assert all(got[i].spans.startswith("assign:") and "format" not in got[i].spans for i in range(5))
    assert all(got[100 + i].spans == "" for i in range(20)) and got[201].spans == got[202].spans == got[203].spans == ""


def test_formats_are_learned_on_the_small_tables(spark):
    """At sf0.01 there are eleven values of a kind: formats are learned from them."""
    formats = S.infer_formats(S.labelled_values(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    assert {"assign", "hex", "plain"} <= set(formats)
    rng = random.Random(1)
    key = "".join(rng.choice("0123456789abcdef") for _ in range(40)).upper()
    assert S.all_spans(f"see {key.lower()} here", {"hex": formats["hex"], "plain": formats["plain"]})[0][0][3] == "hex"


def test_redaction_masks_learned_spans(docs_of):
    formats = S.infer_formats({"assign": ["0123456789"] * 4})
    got = S.redact_secrets(docs_of([(1, "ü 0123456789 end"), (2, None), (3, "clean")]), formats)
    assert {r.doc_id: r.text for r in got.collect()} == {1: "ü [secret] end", 2: None, 3: "clean"}


def test_no_token_of_any_text_is_left_out():
    texts = ["", "short", "abcdef", "é" * 10, "x" * 200_000]
    (buf, offs), = [(b, o) for _, b, o in S.text_slices(pa.array(texts))]
    starts, ends, row = S.candidate_tokens(buf, offs)
    assert list(zip(row.tolist(), (ends - starts).tolist())) == [(2, 6), (4, 200_000)]
