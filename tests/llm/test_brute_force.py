"""Queries and operators against plain versions of their contracts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quill.llm import near_dup, packing, quality, queries, rlz_dedup, secret_scan, suffix_dedup
from quill.llm.repeats import Plan

SF = "/root/testdata/sf0.001"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# ------------------------------------------------------------------ plain versions
def near_components(texts, k):
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    head = {d: d for d in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def without_repeats(units_of, window, ordered):
    """Kept units per id, and spans, when repeated windows are marked one by one."""
    seen = defaultdict(list)
    for d, u in units_of.items():
        for i in range(len(u) - window + 1):
            seen[bytes(u[i:i + window]) if isinstance(u, bytes) else tuple(u[i:i + window])].append(d)
    out = {}
    for d, u in units_of.items():
        gone = [False] * len(u)
        for i in range(len(u) - window + 1):
            places = seen[bytes(u[i:i + window]) if isinstance(u, bytes) else tuple(u[i:i + window])]
            if min(places) < d if ordered else len(places) > 1:
                gone[i:i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = ([x for x, g in zip(u, gone) if not g], spans)
    return out


# ------------------------------------------------------------------ the given documents
def test_license_base(spark, texts):
    got = by_id(queries.op1_license_scan(spark, SF))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for d, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(ASCII_LOWER))
        at = sorted((i, b) for p, b in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        r = got[d]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({b for _, b in at})))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_near_duplicates(spark, texts):
    got = by_id(queries.op2_near_duplicates(spark, SF))
    assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == near_components(texts, 4)


def test_suffix_dedup(spark, texts):
    got = by_id(queries.op3_suffix_dedup(spark, SF))
    for d, (kept, spans) in without_repeats({d: t.encode() for d, t in texts.items()}, 400, False).items():
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(texts[d].encode()), len(texts[d].encode()) - len(kept), spans)
        assert r.kept_sha256 == hashlib.sha256(bytes(kept)).hexdigest()


def test_substring_dedup(spark, texts):
    got = by_id(queries.op9_substring_dedup(spark, SF))
    for d, (kept, _) in without_repeats({d: t.encode().split() for d, t in texts.items()}, 13, True).items():
        assert got[d].n_removed == got[d].n_words - len(kept)
        assert got[d].kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_secret_base(spark, texts):
    got = by_id(queries.op5_secret_scan(spark, SF))
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for d, t in texts.items():
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        n = Counter(k for *_, k in spans)
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == (n["assign"], n["access"], n["hex"])
        assert got[d].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(got[d].spans.split(","))


def test_packing(spark, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    rows = queries.op6_packing(spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for d, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(r.length for r in rows) > 0.95 * 2048 * (len(sequences) - 1)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op10_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(r.predicted == (r.score >= 0.3) and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    toxic = [r for r in rows if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in toxic) > 0.85 * len(toxic)
    assert sum(r.predicted for r in rows) - sum(r.predicted for r in toxic) < 0.04 * len(rows)


def test_toxicity_sample_is_bounded_by_rows(spark, docs_of):
    """A chosen id brings one row to the driver, however often it repeats."""
    from quill.llm import toxicity
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = docs_of([(i, f"word{i} text") for i in ids] + [(ids[0], f"copy {n}") for n in range(300)] + [(ids[1], "same")] * 50)
    labels = spark.createDataFrame([(i, int(i in ids[:2])) for i in ids], "doc_id long, toxic int")
    p, u, _ = toxicity.training_rows(docs, labels)
    assert (len(p), len(u)) == (2, len(ids))


def test_language_model_prefers_labelled_good(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    score = {r.doc_id: r.score for r in queries.op8_lm_scoring(spark, SF).collect()}
    good = [score[d] for d, q in labels.items() if q == 1]
    bad = [score[d] for d, q in labels.items() if q == 0]
    assert np.median(good) < np.median(bad)


# ------------------------------------------------------------------ planted cases
def random_words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_near_duplicates_chains_and_copies(spark, docs_of):
    """A hot group of edited copies, chains, exact copies and short texts."""
    rng = random.Random(5)
    base, rows, i = random_words(rng, 60), [], 0
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i := i + 1, " ".join(w)))
    chain = random_words(rng, 120)
    for step in range(25):
        chain = list(chain)
        chain[step * 4] = f"c{step}"
        rows.append((i := i + 1, " ".join(chain)))
    rows += [((i := i + 1), "a B c") for _ in range(30)] + [((i := i + 1), "A b\tC"), ((i := i + 1), "a b")]
    rng.shuffle(rows)
    for k in (4, 5):
        got = by_id(near_dup.near_duplicates(docs_of(rows), k))
        assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == near_components(dict(rows), k)
    kept = near_dup.drop_near_duplicates(docs_of(rows), 5)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in got.items() if r.kept)


def test_near_duplicates_drop_by_row(spark, docs_of):
    """Repeated rows, null ids and ids that two texts share: one row of each component stays."""
    rng = random.Random(12)
    one, two, three, four = (" ".join(random_words(rng, 30)) for _ in range(4))
    rows = [(1, one)] * 20 + [(2, one.upper()), (2, two), (None, one), (None, three), (None, three),
                              (3, four), (3, four + " \t"), (4, ""), (4, " "), (None, None)]
    kept = [(r.doc_id, r.text) for r in near_dup.drop_near_duplicates(docs_of(rows), 5).collect()]
    with_words = [(d, t and t.strip()) for d, t in kept if (t or "").strip()]
    assert sorted(with_words, key=str) == sorted([(1, one), (2, two), (None, three), (3, four)], key=str)
    assert sorted(((d, t) for d, t in kept if not (t or "").strip()), key=str) == [(4, " "), (4, ""), (None, None)]


def test_posterior_bars():
    bars = near_dup.least_matches(0.8)
    assert bars == sorted(bars) and len(bars) == near_dup.HASHES // near_dup.STEP
    assert all(b < 0.8 * n for b, n in zip(bars, range(16, 129, 16)))


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats_small_windows(spark, docs_of, monkeypatch, group):
    """Byte and word repeats with short windows, whole and split key groups."""
    import quill.llm.repeats as repeats
    monkeypatch.setattr(repeats, "GROUP", group)
    rng = random.Random(group)
    passage = random_words(rng, 30, 50)
    rows = []
    for i in range(60):
        w = random_words(rng, rng.randrange(0, 40), 12)
        if i % 3:
            a = rng.randrange(0, 20)
            w[len(w) // 2:len(w) // 2] = passage[a:a + rng.randrange(4, 30)]
        rows.append((i, " ".join(w)))
    rows += [(60, "ab" * 40), (61, "a" * 100), (62, rows[1][1]), (63, rows[1][1]), (64, "")]
    docs, given = docs_of(rows, 5), dict(rows)
    plan = Plan(window=20, gram=9, words=False, ordered=False)
    monkeypatch.setattr(suffix_dedup, "resolve", lambda s, p=plan, f=suffix_dedup.resolve: f(s, p))
    want = without_repeats({d: t.encode() for d, t in given.items()}, 20, False)
    for d, r in by_id(suffix_dedup.remove_repeats(docs, plan)).items():
        assert bytes(r.kept) == bytes(want[d][0]) and len(r.spans) == want[d][1]
    plan = Plan(window=4, gram=2, words=True, ordered=True)
    monkeypatch.setattr(rlz_dedup, "resolve", lambda s, p=plan, f=rlz_dedup.resolve: f(s, p))
    want = without_repeats({d: t.encode().split() for d, t in given.items()}, 4, True)
    for d, r in by_id(rlz_dedup.remove_repeats(docs, plan)).items():
        assert r.kept.encode().split() == want[d][0]


def test_suffix_order_is_sorted():
    rng = random.Random(3)
    for _ in range(50):
        blocks = [bytes(rng.choice(b"ab\xff\x00") for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 6))]
        ends = np.repeat(np.cumsum([len(b) for b in blocks]), [len(b) for b in blocks])
        wanted = np.array([rng.random() < 0.5 for _ in range(len(ends))])
        data, order = suffix_dedup.suffix_order(blocks, wanted, 100)
        assert sorted(order) == np.flatnonzero(wanted).tolist()
        suffixes = [data[i:ends[i]] for i in order]
        assert suffixes == sorted(suffixes)


def test_best_fit_decreasing():
    rng = random.Random(9)
    lengths = sorted((rng.randrange(1, 101) for _ in range(500)), reverse=True)
    room, placed = [], packing.best_fit_decreasing(lengths, 100)
    for n, (window, offset) in zip(lengths, placed):
        fits = [r for r in room if r >= n]
        if window == len(room):
            assert not fits and offset == 0
            room.append(100)
        assert room[window] == (min(fits) if fits else 100) and offset == 100 - room[window]
        room[window] -= n


def test_chunk_ids_equal_text_ids():
    from tokenizers import Tokenizer
    path = queries.tokenizer_file()
    tokenizer, encoder = Tokenizer.from_file(path), packing.ChunkEncoder(path)
    odd = ["", "İstanbul, İİ ΣΑΣ. a\x1cb c\x85d e", "it's don't I'LL we've 'tis", "<|endoftext|> a<|startoftext|>b",
           "éa café. ́x", "12a3b!! ?!,, ...a.,", "ñ..., ÑAÑ; ß ẞ. ﬁ ﬁ,", "日本語 テスト。 mixed日本,",
           "a​b x y z　w", " \n\t", "emoji😀, 😀.", "Foo, foo FOO. foo,, Foo"]
    for text, ids in zip(odd, encoder.encode(odd)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], text


def test_automaton_learns_a_format():
    rng = random.Random(1)
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    formats = secret_scan.infer_formats({"access": [key() for _ in range(600)]})
    machine, least, size = formats["access"]
    assert size == 20 and sum(machine.score(key()) >= least for _ in range(200)) > 180
    assert machine.score("thhesehesh2thandblean") < least
    text = f"plain words and {key()[:4]}x {key().lower()} end"
    assert secret_scan.all_spans(text, formats)[0] == []


def test_redaction(docs_of):
    secret = "password=0123456789abcdef0123456789"
    rows = {1: f"é {secret} tail", 2: "clean token text", 3: None}
    got = by_id(secret_scan.redact_secrets(docs_of(list(rows.items())), formats={}))
    assert got[1].text == "é [secret] tail" and got[1].n_chars == len(got[1].text)
    assert got[2].text == rows[2] and got[3].text is None


def test_quality_filter_keeps_rows(docs_of):
    good = "the people of the town walked to the market and bought a loaf of bread with the last of their coins"
    rows = [(1, good + " today"), (2, "short"), (3, "# $ % " * 30), (4, (good + "\n") * 6), (None, good + " again")]
    kept = quality.quality_filter(docs_of(rows))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1]
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()


def test_fuzzy_notices(docs_of):
    from quill.llm import license as lic
    rows = {1: "x y Licensd under the Apache Licence, Version 2.0 z", 2: "Released under the MIT License.",
            3: "licensed and under cover", 4: "All rihgts reserved", 5: "a mit\nlicense b MIT-license"}
    spans = by_id(lic.scan_licenses(docs_of(list(rows.items()))))
    assert [(f.label, f.start, f.end, f.edits) for f in spans[1].fuzzy] == [("apache-2.0", 2, 10, 2)]
    assert spans[3].fuzzy == [] and spans[4].fuzzy == []          # a swap is two edits, one is allowed
    got = by_id(lic.license_summary(lic.scan_licenses(docs_of(list(rows.items())))))
    assert (got[1].n_base, got[1].labels, got[1].score) == (0, "apache-2.0", 0.8)
    assert (got[2].n_base, got[2].labels, got[2].score) == (1, "mit", 1.0)
    assert (got[5].n_base, got[5].first_word, got[5].last_word) == (2, 1, 4)
    assert got[3].labels == "" and got[3].score == 0


def test_fuzzy_notices_next_to_better_ones():
    from quill.llm.license import NoticeSearch
    find = NoticeSearch().find
    edited, exact = "released under the mitt license", "released under the mit license"
    for parts in ([edited, exact], [exact, edited], [edited, edited, exact, edited], ["x", exact, "licence", edited, "y"]):
        text, want, at = " ".join(parts), [], 0
        for p in parts:
            if p in (edited, exact):
                want.append(("mit", at, at + len(p), int(p == edited), p))
            at += len(p) + 1
        assert find(text) == want
    gpl = "licensed under the gnu genral public license versin 3 or licensed under the gnu general public license version 2"
    assert {(r[0], r[3]) for r in find(gpl)} == {("gpl-3.0", 2), ("gpl", 1), ("gpl-2.0", 0), ("gpl", 0)}
    assert find(exact + "abcdef") == [] and find("x" + exact) == [("mit", 0, len(exact) + 1, 1, "x" + exact)]


def test_seed_parts_make_up_the_notice():
    from quill.llm.license import NOTICES, split_parts
    for notice, _, edits in NOTICES:
        parts = split_parts(notice, edits)
        assert "".join(p for _, p in parts) == notice and len(parts) == edits + 1
        assert all(notice[a:a + len(p)] == p for a, p in parts)


def test_language_models_against_plain_counts(spark, docs_of):
    from math import log

    from quill.llm import lm_score
    rng = random.Random(6)
    rows = [(i, " ".join(random_words(rng, rng.randrange(0, 40), 15)).upper()) for i in range(40)] + [(40, None)]
    target = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "doc_id long")
    docs = docs_of(rows)
    got = by_id(lm_score.score(docs, lm_score.train_models(docs, target)))
    words = {i: (t or "").lower().split() for i, t in rows}
    size = len({w for ws in words.values() for w in ws}) + 1

    def loss(ids, own):
        one, two = Counter(), Counter()
        for i in ids:
            one.update(words[i])
            two.update(zip(words[i], words[i][1:]))
        n, out = sum(one.values()), 0.0
        for j, w in enumerate(own):
            p = (one[w] + 1) / (n + size)
            if j:
                p = 0.6 * two[own[j - 1], w] / max(1, one[own[j - 1]]) + 0.4 * p
            out -= log(p)
        return out / max(1, len(own))

    for i, own in words.items():
        want = (loss(range(0, 40, 3), own), loss(words, own))
        assert got[i].n_words == len(own)
        assert (got[i].target_loss, got[i].background_loss) == pytest.approx(want)
        assert got[i].score == pytest.approx(want[0] - want[1])


def test_language_models_keep_rare_words(spark, docs_of, monkeypatch):
    """In a corpus of 600,000 words, a word and a bigram seen twice still count, over many chunks and buckets."""
    from math import log

    from quill.llm import lm_score
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 300_000)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 100_000)
    rows = [(i, "the cat sat " * 1_000) for i in range(200)] + [(200, "rare bird"), (201, "rare bird"), (202, "bird rare")]
    docs, n, size = docs_of(rows), 600_006, 5 + 1
    models = lm_score.train_models(docs, spark.createDataFrame([(200,)], "doc_id long"))
    first = {"rare": 3, "bird": 3}
    want = {w: -(log((first[a] + 1) / (n + size)) + log(0.6 * both / 3 + 0.4 * (first[b] + 1) / (n + size))) / 2
            for w, a, b, both in ((201, "rare", "bird", 2), (202, "bird", "rare", 1))}
    got = by_id(lm_score.score(docs, models))
    assert got[201].background_loss == pytest.approx(want[201]) and got[202].background_loss == pytest.approx(want[202])
    assert got[201].target_loss == pytest.approx(-(log(2 / (2 + size)) + log(0.6 + 0.4 * 2 / (2 + size))) / 2)
    other = by_id(lm_score.score(docs_of([(1, "rare bird"), (2, "unseen")]), models))
    assert other[1].background_loss == pytest.approx(want[201])
    assert other[2].background_loss == pytest.approx(-log(1 / (n + size)))


def test_pu_risk_steps_back_when_negative():
    from quill.llm.toxicity import Classifier
    fitted = Classifier._slopes(np.array([0.2, 0.2, 0.9, 0.9]), 2, 2, 0.1)
    assert fitted[:2] == pytest.approx(-0.05) and (fitted[2:] > 0).all()
    over = Classifier._slopes(np.array([0.999, 0.999, 0.01, 0.01]), 2, 2, 0.5)
    assert (over[:2] > 0).all() and (over[2:] < 0).all()
