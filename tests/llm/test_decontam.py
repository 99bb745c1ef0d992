"""String tiling and leaks, whole, reordered and partial."""

import random

import pytest

from quill.llm import decontam
from quill.llm.decontam import string_tiles


def words(rng, n):
    return [f"t{rng.randrange(10 ** 6)}" for _ in range(n)]


@pytest.fixture(scope="module")
def items():
    rng = random.Random(2)
    return {i: words(rng, n) for i, n in enumerate((40, 25, 60, 12, 4))}


def test_tiles_are_greedy_and_disjoint():
    item, text = [1, 2, 3, 4, 5, 6, 7, 8], [5, 6, 7, 8, 9, 1, 2, 3, 4, 9, 1, 2, 3]
    tiles = string_tiles(item, text, least=3)
    assert sorted(tiles) == [(0, 5, 4), (4, 0, 4)]
    assert string_tiles([1, 2, 3], [3, 2, 1], least=3) == []
    assert string_tiles([1, 1, 1, 1, 1, 1], [1] * 6, least=3) == [(0, 0, 6)]


def test_leaks(spark, docs_of, items):
    rng = random.Random(4)
    pad = lambda n: " ".join(words(rng, n))
    whole = {i: ", ".join(w) for i, w in items.items()}
    moved = " ".join(items[0][20:] + words(rng, 10) + items[0][:20])
    half = " ".join(items[2][:20])
    docs = docs_of([
        (1, f"{pad(300)} {whole[0].upper()} {pad(5)}"), (2, f"{pad(30)} {moved}"), (3, f"{half} {pad(50)}"),
        (4, f"{whole[1]}. {pad(20)} {whole[3]}"), (5, pad(400)), (6, whole[4] + " " + pad(9)), (7, None)])
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    found = decontam.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 0), (2, 0), (4, 1), (4, 3), (6, 4)}  # item 4 is short: whole
    assert {r.n_tiles for r in found if r.doc_id == 2} == {2} and all(r.coverage == 1 for r in found)
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == [3, 5, 7]


def test_long_passage_of_a_longer_item_is_a_leak(spark, docs_of):
    rng = random.Random(9)
    item, pad = words(rng, 200), words(rng, 80)
    docs = docs_of([(1, " ".join(pad[:40] + item[50:160] + pad[40:])), (2, " ".join(pad + item[10:34])),
                    (3, " ".join(pad + item[10:33])), (4, " ".join(pad))])
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id: r.tiled_tokens for r in decontam.find_leaks(docs, bench).collect()} == {1: 110, 2: 24}
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == [3, 4]


def test_blocks_change_nothing(spark, docs_of, items, monkeypatch):
    rows = [(i, "so it goes " + " ".join(w)) for i, w in items.items()]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    want = sorted(map(str, decontam.find_leaks(docs_of(rows), bench).collect()))
    blocks = lambda b: decontam_blocks(b, 100)
    decontam_blocks = decontam.item_blocks
    assert len(list(blocks(bench))) > 2
    monkeypatch.setattr(decontam, "item_blocks", blocks)
    assert sorted(map(str, decontam.find_leaks(docs_of(rows), bench).collect())) == want


def test_short_items_by_their_whole_sequence(spark, docs_of):
    bench = spark.createDataFrame([(1, "blue whale"), (2, "Yes!"), (3, "one two three four"), (4, "..."), (5, "blue whale"), (None, "yes")],
                                  "item_id long, text string")
    docs = docs_of([(1, "A blue, WHALE and a blue whale"), (2, "whale blue"), (3, "yes or no"), (4, "two three four one two three"),
                    (5, "zero one two three four five"), (6, None), (7, "blue"), (8, "end with one two three"), (9, "four at the start yes")])
    got = {(r.doc_id, r.item_id, r.n_tiles, r.tiled_tokens, r.item_tokens, r.first_token, r.last_token) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == {(1, 1, 1, 2, 2, 1, 2), (1, 5, 1, 2, 2, 1, 2), (3, 2, 1, 1, 1, 0, 0), (3, None, 1, 1, 1, 0, 0),
                   (5, 3, 1, 4, 4, 1, 4), (9, 2, 1, 1, 1, 4, 4), (9, None, 1, 1, 1, 4, 4)}
    kept = decontam.drop_leaks(docs, bench.where("item_id in (1, 3)"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7, 8, 9]
