"""What the bounded match leaves on the disks: one written result, nothing of its steps."""

import contextlib
from pathlib import Path

from quill.operators import similarity as SM
from quill.plans import catalogue as C
from quill.sources import scratch

SF = "/root/testdata/sf0.001"
V = "id long, term string, w_norm double"
LEFT = [(1, "a", 0.6), (1, "b", 0.8), (2, "b", 1.0), (3, "c", 1.0), (4, "b", 1.0), (5, "z", 1.0), (6, "a", 0.0)]
RIGHT = [(1, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "b", 1.0), (7, "b", 1.0), (8, "y", 1.0)]


def kept(spark):
    return list(scratch._made.get(spark.sparkContext.applicationId, []))


def test_a_match_keeps_its_result_only(spark):
    left, right = (scratch.written(spark.createDataFrame(rows, V)) for rows in (LEFT, RIGHT))
    before = kept(spark)
    got = SM.best_match_bounded(left, right)
    new = [p for p in kept(spark) if p not in before]
    assert len(new) == 1 and set(before) <= set(kept(spark))
    scratch.drop(left, right)                           # the result reads neither
    assert sorted((r.id_1, r.best, round(r.cos, 9)) for r in got.collect()) == [(1, 2, 1.0), (2, 3, 1.0), (4, 3, 1.0)]


def test_steps_of_the_match_release_their_shuffle_files(spark, monkeypatch):
    entered = []

    @contextlib.contextmanager
    def released(where, real=scratch.files_released):
        with real(spark, every=0.5):
            entered.append(where)
            yield

    monkeypatch.setattr(C, "files_released", lambda s: released("vectors"))
    monkeypatch.setattr(SM, "files_released", lambda s: released("match"))
    before = kept(spark)
    accuracy = C.title_match_accuracy(spark, SF).collect()
    assert entered == ["vectors", "match"] and len(accuracy) == 1 and 0 <= accuracy[0].value <= 100
    assert len([p for p in kept(spark) if p not in before]) == 1


def test_dropped_intermediates_go_and_others_stay(spark):
    one, other = (scratch.written(spark.range(n)) for n in (3, 4))
    path = Path(kept(spark)[-2].removeprefix("file:"))
    plain = spark.range(5)
    assert path.is_dir()
    scratch.drop(one, plain)
    assert not path.exists() and str(path) not in [p.removeprefix("file:") for p in kept(spark)]
    scratch.drop(one)                                   # twice is no fault
    assert other.count() == 4 and plain.count() == 5
