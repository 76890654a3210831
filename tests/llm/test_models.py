import math
import random
import zlib

import numpy as np
import pytest

from sparkcurate.llm import quality_crf, toxicity_gru

S = "doc_id long, text string, lang string, score double"
rng = random.Random(2)


def prose(n):
    return "\n".join(" ".join(rng.choice("alder birch cedar maple linden willow".split()) for _ in range(12)).capitalize() + "." for _ in range(n))


def junk(n):
    return "\n".join(" ".join(rng.choice(["BUY!!", "NOW!!", "CHEAP!!"]) for _ in range(12)) for _ in range(n))


def quality_docs():
    rows = [(k, prose(rng.randrange(1, 6)), 1) if k % 3 else (k, prose(1) + "\n" + junk(rng.randrange(2, 6)), 0) for k in range(240)]
    return rows + [(1_000, None, None), (1_001, "", None), (None, "x", None), (1_002, "word " * 60_000, None), (5, "twice", None)]


def test_quality_on_held_out_rows(spark):
    rows = quality_docs()
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows], S)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if q is not None] + [(7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    field = quality_crf.fit_quality(docs, labels)
    got = quality_crf.score_quality(docs, field).collect()
    assert len(got) == len(rows)
    held = {i for i, _, q in rows if q is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r.predicted == dict((i, q) for i, _, q in rows if q is not None)[r.doc_id] for r in got if r.doc_id in held]
    assert len(right) > 20 and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality_crf.score_quality(docs.limit(0), field).collect() == []
    none = quality_crf.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality_crf.score_quality(docs, none).collect()} == {0.5}


def test_marginals_are_those_of_all_labellings():
    random_ = np.random.default_rng(4)
    field = quality_crf.Field(np.zeros(1), random_.normal(size=(2, 2)))
    lengths = np.array([3, 1, 4])
    score = random_.normal(size=(8, 2))
    good, pairs, z = field.passes(score, lengths)
    start, all_pairs, all_z = 0, np.zeros((2, 2)), 0.0
    for n in lengths:
        total, each = 0.0, np.zeros(n)
        own_pairs = np.zeros((2, 2))
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(score[start + k, y[k]] for k in range(n)) + sum(field.trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            each += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                own_pairs[a, b] += w
        assert np.allclose(good[start : start + n], each / total)
        all_pairs += own_pairs / total
        all_z += np.log(total)
        start += n
    assert np.allclose(pairs, all_pairs) and np.isclose(z, all_z)


def test_document_scores_weigh_all_labellings():
    random_ = np.random.default_rng(11)
    field = quality_crf.Field(random_.normal(size=3 * quality_crf.OWN + 1), random_.normal(size=(2, 2)), 4.0, -2.0)
    texts = [b"", b"One line.", b"Two lines\nBUY!! NOW!!", b"a b c\n\nd | e | f\nBUY BUY BUY\nlast one, here."]
    for text, score in zip(texts, quality_crf.doc_scores(field, texts), strict=True):
        x, length, _ = quality_crf.line_features([text])
        n, total, good = len(x), 0.0, np.zeros(len(x))
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = math.exp(sum(float(x[k] @ field.weights) for k in range(n) if y[k]) + sum(field.trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            good += w * np.array(y)
        weight = np.maximum(length, 1)
        share = float((good / total * weight).sum() / weight.sum())
        assert math.isclose(score, 1 / (1 + math.exp(-field.slope * share - field.offset)), rel_tol=1e-9)


@pytest.mark.parametrize("run", [1, 7, 40, 1_000])
def test_long_texts_go_in_runs(monkeypatch, run):
    random_ = np.random.default_rng(run)
    field = quality_crf.Field(random_.normal(size=3 * quality_crf.OWN + 1), random_.normal(size=(2, 2)), 3.0, -1.0)
    texts = [("\n".join(prose(1) if random_.random() < 0.5 else junk(1) for _ in range(60))).encode(), b"\n" * 80, b"one line of words " * 30, b"a\n" * 50, b"\n\nx\n" + b"y" * 300]
    whole = field.score(*quality_crf.line_features(texts))
    monkeypatch.setattr(quality_crf, "RUN_BYTES", run)
    assert np.allclose(quality_crf.doc_scores(field, texts), whole)


def test_samples_are_bounded(spark):
    docs = spark.createDataFrame([(k % 20, "w" * (10 if k % 3 else 5_000), "x") for k in range(400)], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(3, None), (None, 1)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    sample = quality_crf.labelled(docs, labels, "doc_id", "text", "quality", F.col("id") != 4, {1: 30, 0: 30}, F.length("text"), 200)
    rows = sample.collect()
    assert sum(len(r.text) for r in rows) <= 200 and len(rows) == 20 and all(r.id != 4 and r.label == r.id % 2 for r in rows)


@pytest.mark.parametrize("op, column, modulus, value", [(quality_crf.op6, "quality", 5, 0), (toxicity_gru.op2, "toxic", 4, 2)])
def test_held_out_rows(spark, op, column, modulus, value):
    got = op(spark, "/root/testdata/sf0.001")
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r[column] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    rows = got.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == value) and r.predicted == (r.score >= 0.3) for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(right) > 0.85


def test_lines_see_their_neighbours():
    x, length, n = quality_crf.line_features([b"one line\nTWO!!", b"", b"a a a"])
    assert n.tolist() == [2, 1, 1] and length.tolist() == [8, 5, 0, 5]
    own = quality_crf.OWN
    assert np.allclose(x[0, 2 * own : 3 * own], x[1, :own]) and np.allclose(x[1, own : 2 * own], x[0, :own])
    assert not x[0, own : 2 * own].any() and not x[1, 2 * own : 3 * own].any()
    assert np.isclose(x[3, 8], 2 / 3)


BAD = "dolt nitwit oaf".split()


def toxic_docs():
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(300):
        w = [rng.choice(words) for _ in range(rng.randrange(5, 150))]
        if k % 4 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(BAD)
        rows.append((k, " ".join(w), int(k % 4 == 0)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_docs()
    more = [(1_000, None), (1_001, ""), (None, "w1"), (1_002, "w1 " * 40_000 + "nitwit oaf dolt " * 3 + "w2 " * 100), (5, "twice")]
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows] + [(i, t, "en", 0.5) for i, t in more], S)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    net = toxicity_gru.fit_toxicity(docs, labels)
    got = toxicity_gru.score_toxicity(docs, net).collect()
    assert len(got) == len(rows) + len(more)
    held = {i: y for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r.predicted == held[r.doc_id] for r in got if r.doc_id in held]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert next(r.predicted for r in got if r.doc_id == 1_002) == 1
    assert toxicity_gru.score_toxicity(docs.limit(0), net).collect() == []
    assert toxicity_gru.fit_toxicity(docs, labels.limit(0)) is None
    assert {r.score for r in toxicity_gru.score_toxicity(docs, None).collect()} == {0.0}


def test_gradients():
    net = toxicity_gru.Network({"a": 0, "b": 1}, np.array([0.5, -1.0]), np.zeros(toxicity_gru.CHAR_BUCKETS))
    random_ = np.random.default_rng(1)
    gates = {way: random_.normal(size=(4, 3 * toxicity_gru.HIDDEN)) for way in "fb"}
    for name in net.p:
        net.p[name] = net.p[name].astype(np.float64)
    ids, mask = random_.integers(0, 4, (6, 3)), np.ones((6, 3))
    mask[4:, 1] = 0
    target = np.array([1.0, 0.0, 1.0])

    def loss():
        p = 1 / (1 + np.exp(-net.run(gates, ids, mask).astype(np.float64)))
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    g, d_gates = net.slopes(gates, ids, mask, target)
    for values, slope in [(net.p[k], g[k]) for k in ("uf", "ub", "attend", "pick", "out")] + [(gates[w], d_gates[w]) for w in "fb"]:
        at = tuple(random_.integers(0, n) for n in values.shape)
        old = values[at]
        values[at] = old + 1e-2
        up = loss()
        values[at] = old - 1e-2
        down = loss()
        values[at] = old
        assert abs((up - down) / 2e-2 - slope[at]) < 2e-3


def slow_score(net, text):
    """The network's definition, a word at a time, for each window by itself."""
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    words = toxicity_gru.words_of(text)
    starts = [0]
    while starts[-1] + toxicity_gru.WINDOW < len(words):
        starts.append(starts[-1] + toxicity_gru.STRIDE)
    best = -math.inf
    size = toxicity_gru.HIDDEN
    for start in starts:
        own = words[start : start + toxicity_gru.WINDOW]
        inputs = []
        for w in own:
            data = f"\x02{w}\x03".encode()
            grams = [toxicity_gru.trigrams([w])[0][k] for k in range(len(data) - 2)]
            row = net.vocabulary.get(w)
            x = list(net.p["word"][row]) if row is not None else [0.0] * toxicity_gru.WORD_DIM
            x.append(net.word_odds[row] if row is not None else 0.0)
            x += [sum(net.p["char"][g][d] for g in grams) / len(grams) for d in range(toxicity_gru.CHAR_DIM)]
            odds = [net.char_odds[g] for g in grams]
            inputs.append([*x, sum(odds) / len(odds), max(odds)])
        states = [[0.0] * (2 * size) for _ in own]
        for way, shift in (("f", 0), ("b", size)):
            h = [0.0] * size
            for t in range(len(own)) if way == "f" else range(len(own) - 1, -1, -1):
                g = [sum(a * net.p[f"x{way}"][d][j] for d, a in enumerate(inputs[t])) + net.p[f"b{way}"][j] for j in range(3 * size)]
                k = [sum(h[d] * net.p[f"u{way}"][d][j] for d in range(size)) for j in range(3 * size)]
                z, r = ([sigmoid(g[p + j] + k[p + j]) for j in range(size)] for p in (0, size))
                new = [math.tanh(g[2 * size + j] + r[j] * k[2 * size + j]) for j in range(size)]
                h = [(1 - z[j]) * h[j] + z[j] * new[j] for j in range(size)]
                states[t][shift : shift + size] = h
        if own:
            pull = []
            for st_ in states:
                hid = [math.tanh(sum(st_[d] * net.p["attend"][d][j] for d in range(2 * size)) + net.p["attend0"][j]) for j in range(toxicity_gru.ATTENTION)]
                pull.append(math.exp(sum(a * b for a, b in zip(hid, net.p["pick"], strict=True))))
            pooled = [sum(p * st_[d] for p, st_ in zip(pull, states, strict=True)) / sum(pull) for d in range(2 * size)]
        else:
            pooled = [0.0] * (2 * size)
        best = max(best, sum(a * b for a, b in zip(pooled, net.p["out"], strict=True)) + net.p["out0"][0])
    return sigmoid(best)


def test_scores_are_those_of_all_windows(monkeypatch):
    random_ = np.random.default_rng(6)
    odds = random_.normal(size=2)
    net = toxicity_gru.Network({"alder": 0, "oaf": 1}, odds, random_.normal(size=toxicity_gru.CHAR_BUCKETS))
    for name in net.p:
        net.p[name] = random_.normal(size=net.p[name].shape).astype(np.float32) * 0.4
    texts = ["", "oaf", "Alder é wörd " * 9, " ".join(f"w{k}" for k in range(48)), " ".join(f"x{k % 19}" for k in range(49)), " ".join(f"y{k % 23} oaf" for k in range(80))]
    slow = [slow_score(net, t) for t in texts]
    assert np.allclose(toxicity_gru.Scorer(net).score(texts), slow, atol=1e-5)
    monkeypatch.setattr(toxicity_gru, "TOGETHER", 2)
    monkeypatch.setattr(toxicity_gru, "pieces", lambda text, f=toxicity_gru.pieces: f(text, 2))
    assert np.allclose(toxicity_gru.Scorer(net).score(texts), slow, atol=1e-5)


def test_pieces_have_the_texts_windows():
    for n in (0, 1, 47, 48, 49, 72, 73, 96, 97, 500):
        words = [f"w{k}" for k in range(n)]
        _, start = toxicity_gru.windows(np.array([n]))
        expected = [words[s : s + toxicity_gru.WINDOW] for s in start.tolist()]
        got = []
        for part in toxicity_gru.pieces(" ".join(words), 2):
            _, own = toxicity_gru.windows(np.array([len(part)]))
            got += [part[s : s + toxicity_gru.WINDOW] for s in own.tolist()]
        assert got == expected


def test_a_passage_is_found_wherever_it_stands(spark):
    rows = toxic_docs()
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows], S)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    scorer = toxicity_gru.Scorer(toxicity_gru.fit_toxicity(docs, labels))
    clean = [f"w{k * 7 % 200}" for k in range(300)]
    passage = "nitwit w3 dolt w5 oaf w9 w11 nitwit w20 w21 w22 oaf".split()
    scores = scorer.score([" ".join(clean[:k] + passage + clean[k:]) for k in range(0, 120)])
    assert (scores >= toxicity_gru.THRESHOLD).all() and scorer.score([" ".join(clean)])[0] < toxicity_gru.THRESHOLD


def test_windows_cover_all_words():
    doc, start = toxicity_gru.windows(np.array([0, 1, 48, 49, 500]))
    for d, n in enumerate([0, 1, 48, 49, 500]):
        own = start[doc == d]
        seen = {w for s in own for w in range(s, min(n, s + toxicity_gru.WINDOW))}
        assert seen == set(range(n)) and len(own) >= 1
