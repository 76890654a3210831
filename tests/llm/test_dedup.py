import hashlib
import random
import re
import sys
import threading

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.streaming.readwriter import DataStreamWriter

from sparkcurate.llm import exact_dedup, ngram_join, shared, suffix_dedup

S = "doc_id long, text string, lang string, source string, n_chars long, __key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "clash") for i, t in rows], S)


def normal(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


ODD = [(5, "a  b"), (3, "a\t\nb"), (9, None), (8, ""), (7, " "), (None, "a b"), (2, "x" * 300_000), (2, "x" * 300_000), (4, "é 😀"), (6, " a b")]


@pytest.mark.parametrize("bits", [256, 8])
def test_exact(spark, bits):
    got = exact_dedup.exact_dedup(docs(spark, ODD), digest_bits=bits).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(normal(t), []).append(i)
    sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    for ids in sha.values():
        assert sum(r.kept for r in got if sha[r.text_sha256] == ids) == 1


def test_exact_drops_rows(spark, tmp_path):
    docs(spark, ODD).write.parquet(f"{tmp_path}/d")
    kept = exact_dedup.drop_repeats(spark.read.parquet(f"{tmp_path}/d"))
    assert kept.columns == [x.split()[0] for x in S.split(", ")]
    assert sorted(normal(r.text) for r in kept.collect()) == sorted({normal(t) for _, t in ODD})


@pytest.mark.parametrize("bits", [256, 8])
def test_exact_salted(spark, monkeypatch, bits):
    monkeypatch.setattr(shared, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(shared, "hot_rows", lambda rows: 3)
    monkeypatch.setattr(exact_dedup, "hot_rows", lambda rows: 3)
    rows = [(k, f"copy  {k % 3}") for k in range(40)] + [(100 + k, f"t{k}") for k in range(30)] + ODD
    got = exact_dedup.exact_dedup(docs(spark, rows), digest_bits=bits).collect()
    sizes = {}
    for _, t in rows:
        sizes[normal(t)] = sizes.get(normal(t), 0) + 1
    by = {hashlib.sha256(t.encode()).hexdigest(): n for t, n in sizes.items()}
    assert len(got) == len(rows) and all(r.group_size == by[r.text_sha256] for r in got) and sum(r.kept for r in got) == len(sizes)


@pytest.mark.parametrize("trigger", [1, 16 << 30])
def test_exact_in_several_batches(spark, tmp_path, trigger, monkeypatch):
    rows = [(k, f"text {k * k % 17}") for k in range(80)] + ODD
    docs(spark, rows).repartition(9).write.parquet(f"{tmp_path}/d")
    queries = []
    start = DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **b: queries.append(start(self, *a, **b)) or queries[-1])
    got = exact_dedup.exact_dedup(spark.read.parquet(f"{tmp_path}/d"), bytes_per_trigger=trigger).collect()
    assert (queries[0].lastProgress["batchId"] > 0) == (trigger == 1)
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by[r.text_sha256]
        assert (r.group_size, r.keep_id) == (len(ids), min((i for i in ids if i is not None), default=None))
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)


@pytest.mark.parametrize("f", [exact_dedup.exact_dedup, ngram_join.near_groups, suffix_dedup.remove_repeats])
def test_empty_table(spark, f):
    assert f(docs(spark, [])).collect() == []


def shingles(t, words):
    w = [x.decode() for x in re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))]
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()


def brute_groups(rows, rule):
    sets = [shingles(t, rule.words) for _, t in rows]
    name = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= rule.similar * len(x | y):
                old, new = name[a], name[b]
                name = [new if n == old else n for n in name]
    ids = lambda n: [rows[k][0] for k in range(len(rows)) if name[k] == n and rows[k][0] is not None]
    return sorted((str(i), len(s), str(min(ids(n), default=None) if s else i)) for (i, _), s, n in zip(rows, sets, name, strict=True))


def family(seed, n, words=60, edits=4):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"v{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def test_large_cells_are_split(spark, monkeypatch):
    rng = random.Random(9)
    rule = ngram_join.Rule(1, 60)
    common = [f"c{k}" for k in range(40)]
    # a shared part that is always among the first shingles of a text, and families that pivots part
    texts = [" ".join(common[:30] + [f"f{g}x{rng.randrange(40)}" for _ in range(20)]) for g in range(4) for _ in range(25)]
    texts += [" ".join(rng.sample(common, 25) + [f"u{rng.randrange(5_000)}" for _ in range(10)]) for _ in range(40)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(ngram_join, "LARGE", 2)
    monkeypatch.setattr(ngram_join, "TOGETHER", 5)
    monkeypatch.setattr(ngram_join, "PIECE", 2)
    monkeypatch.setattr(ngram_join, "LISTED", 3)
    levels = []
    again = ngram_join._parts_again
    for leaf, groups in ((4, 100_000), (16, 0), (512, 100_000)):
        monkeypatch.setattr(ngram_join, "LEAF", leaf)
        monkeypatch.setattr(shared, "BROADCAST_GROUPS", groups)
        monkeypatch.setattr(ngram_join, "BROADCAST_PIVOTS", groups)
        monkeypatch.setattr(ngram_join, "_parts_again", lambda df, leaf=leaf: levels.append(leaf) or again(df))
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_groups(docs(spark, rows), rule=rule).collect())
        assert got == brute_groups(rows, rule)
    assert 4 in levels and 512 not in levels


def test_homes_and_guests_meet(spark, monkeypatch):
    """Every pair of regions that the folds allow is found, however a group is split."""
    monkeypatch.setattr(ngram_join, "LEAF", 6)
    rng = np.random.default_rng(3)
    rule = ngram_join.Rule(5, 85)
    sets = []
    for g in range(6):
        base = rng.integers(1, 1 << 62, 90, dtype=np.uint64)
        for _ in range(12):
            s = base.copy()
            s[rng.choice(90, rng.integers(0, 12), replace=False)] = rng.integers(1, 1 << 62, dtype=np.uint64)
            sets.append(np.unique(s))
    points = spark.createDataFrame([(k, len(s), bytearray(ngram_join.fold(s))) for k, s in enumerate(sets)], "key long, n long, fold binary")
    rows = spark.createDataFrame([(c, k, 0) for c in (1, 2) for k in range(len(sets))], "cell long, region long, r long")
    calls = []
    again = ngram_join._parts_again
    monkeypatch.setattr(ngram_join, "_parts_again", lambda df: calls.append([r.apart for r in df.select("apart").distinct().collect()]) or again(df))
    got = {(r.a, r.b) for r in ngram_join.large_cells(rows, rule, points, 3).collect()}
    expected = set()
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            na, nb = np.array([len(sets[a])]), np.array([len(sets[b])])
            diff = ngram_join.differences([ngram_join.fold(sets[a])], [ngram_join.fold(sets[b])], na, nb)
            if ngram_join.within(85, diff, na, nb)[0] and 55 * max(na[0], nb[0]) <= 100 * min(na[0], nb[0]):
                expected.add((a, b))
    assert got == expected and len(calls) > 1 and [True] in calls


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splits_end(spark, monkeypatch, seed):
    """A few small regions in the middle, that all others are guests of: parts that stay as large as their group become blocks."""
    monkeypatch.setattr(ngram_join, "LEAF", 32)
    rng = np.random.default_rng(seed)
    rule = ngram_join.Rule(5, 85)
    centre = rng.integers(1, 1 << 62, 80, dtype=np.uint64)
    sets = [np.unique(centre[rng.choice(80, 76, replace=False)]) for _ in range(40)]
    for _ in range(3):
        far = np.concatenate([centre, rng.integers(1, 1 << 62, 15, dtype=np.uint64)])
        sets += [np.unique(far[rng.choice(95, 93, replace=False)]) for _ in range(40)]
    points = spark.createDataFrame([(k, len(s), bytearray(ngram_join.fold(s))) for k, s in enumerate(sets)], "key long, n long, fold binary")
    rows = spark.createDataFrame([(1, k, 0) for k in range(len(sets))], "cell long, region long, r long")
    levels = []
    again = ngram_join._parts_again

    def counted(df):
        levels.append({(r.key, r.n) for r in df.where("apart").select("key", "n").distinct().collect()})
        assert len(levels) < 12
        return again(df)

    monkeypatch.setattr(ngram_join, "_parts_again", counted)
    got = {(r.a, r.b) for r in ngram_join.large_cells(rows, rule, points, 3).collect()}
    expected = set()
    for a in range(len(sets)):
        n = np.array([len(s) for s in sets])
        diff = ngram_join.differences_to(ngram_join.fold(sets[a]), n[a], [ngram_join.fold(s) for s in sets], n)
        expected |= {(a, int(b)) for b in np.flatnonzero(ngram_join.within(85, diff, n[a], n)) if a < b}
    assert got == expected


def test_blocks_go_by_size(spark, monkeypatch):
    """Regions that pivots don't part meet only where their sizes allow a link."""
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(1, 1 << 62, int(20 * 1.3**k), dtype=np.uint64)) for k in range(12) for _ in range(10)]
    sets += [np.append(s[:-1], s[-1] + np.uint64(1)) for s in sets[::7]]
    points = spark.createDataFrame([(k, len(s), bytearray(ngram_join.fold(s))) for k, s in enumerate(sets)], "key long, n long, fold binary")
    rows = spark.createDataFrame([(1, k, 0) for k in range(len(sets))], "cell long, region long, r long")
    dealt = []
    leaves = ngram_join._leaves
    monkeypatch.setattr(ngram_join, "_leaves", lambda df, *x: dealt.append(df.count()) or leaves(df, *x))
    got = {(r.a, r.b) for r in ngram_join.large_cells(rows, ngram_join.Rule(5, 85), points, 3).collect()}
    n = np.array([len(s) for s in sets])
    expected = set()
    for a in range(len(sets)):
        diff = ngram_join.differences_to(ngram_join.fold(sets[a]), n[a], [ngram_join.fold(s) for s in sets], n)
        expected |= {(a, int(b)) for b in np.flatnonzero(ngram_join.within(85, diff, n[a], n)) if a < b}
    assert got == expected
    assert sum(dealt) < len(sets) * (2 * len(sets) / 8) * 0.9


@pytest.mark.parametrize("rule, large", [(ngram_join.Rule(4, 85), 6), (ngram_join.Rule(), 2), (ngram_join.Rule(2, 60), 6)])
def test_near_groups(spark, monkeypatch, rule, large):
    monkeypatch.setattr(ngram_join, "LARGE", large)
    monkeypatch.setattr(ngram_join, "FIRST_PAIRS", 2)
    texts = family(1, 40) + family(2, 15, edits=9) + family(3, 5, words=9) + ["a b c d e f", "A b c D e f", "one", "One", "", None, " ", "a b c d e f g"]
    shared = " ".join(f"s{k}" for k in range(50))
    texts += [f"{shared} {t}" for t in family(4, 10, words=12, edits=12)]
    rows = [(k * 3, t) for k, t in enumerate(texts)] + [(1, texts[0]), (1, texts[0]), (None, texts[0]), (None, "alone in the world it is")]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_groups(docs(spark, rows), rule=rule).collect())
    assert got == brute_groups(rows, rule)


@pytest.mark.parametrize("words", [1, 2, 5])
@pytest.mark.parametrize("long", [1, 9, 64])
def test_long_texts_have_the_same_sets(monkeypatch, words, long):
    rng = random.Random(long)
    texts = [" ".join(rng.choice("a b cc ddd eeee".split()) + rng.choice(["", " ", "\n\t"]) for _ in range(n)).encode() for n in (0, 1, 3, 4, 5, 60)]
    texts += [b"", b"  ", b"one", b"x" * 200, b"x" * 100 + b" " + b"y" * 100, b" a b ", b"A a\x0bB b\x0c"]
    whole = ngram_join.shingle_sets(texts, words)
    monkeypatch.setattr(ngram_join, "LONG", long)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, ngram_join.shingle_sets(texts, words), strict=True))


def test_near_drop(spark, tmp_path):
    texts = family(1, 12) + ["alone at last in this world", "", None]
    docs(spark, [(9 - k, t) for k, t in enumerate(texts)] + [(9, texts[0])]).write.parquet(f"{tmp_path}/d")
    kept = ngram_join.drop_near(spark.read.parquet(f"{tmp_path}/d"), rule=ngram_join.Rule(5, 10)).collect()
    assert sorted(r.doc_id for r in kept) == sorted([9 - 11, 9 - 12, 9 - 13, 9 - 14])


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_near_without_ids(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", broadcast)
    rule = ngram_join.Rule(1, 80)
    words = [f"w{k}" for k in range(40)]
    # the two with ids link only through the one without
    chain = [(1, " ".join(["x1 x2 x3 x4", *words[4:]])), (None, " ".join(words)), (2, " ".join([*words[:36], "y1 y2 y3 y4"]))]
    rows = chain + [(None, t) for t in family(1, 6)] + [(None, t) for t in family(2, 3)] + [(5, family(2, 4)[-1]), (None, "alone"), (None, None)]
    docs(spark, rows).write.parquet(f"{tmp_path}/d")
    table = spark.read.parquet(f"{tmp_path}/d")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_groups(table, rule=rule).collect())
    assert got == brute_groups(rows, rule)
    kept = ngram_join.drop_near(table, rule=rule).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "5", "None", "None", "None"]


@given(st.lists(st.integers(0, 3), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(t):
    assert suffix_dedup.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("t", [[0, 1] * 40, [1] * 90, [2, 1, 0] * 30, [0, 0, 1] * 30 + [2], list(range(200)), list(range(200))[::-1]])
def test_suffix_array_of_patterns(t):
    assert suffix_dedup.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("kind", ["random", "periodic", "fibonacci", "falling"])
def test_suffix_array_takes_linear_time(kind):
    def text(n):
        if kind == "random":
            return random.Random(1).choices(range(256), k=n)
        if kind == "fibonacci":
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            return b[:n]
        return [k % 7 for k in range(n)] if kind == "periodic" else [(n - k) // (n // 200) for k in range(n)]

    def lines_run(n):
        count = 0

        def trace(frame, event, arg):
            nonlocal count
            count += event == "line"
            return trace if frame.f_code is suffix_dedup.suffix_array.__code__ else None

        t = text(n)
        before = sys.gettrace()
        sys.settrace(trace)
        try:
            suffix_dedup.suffix_array(t)
        finally:
            sys.settrace(before)
        return count

    few, many = lines_run(4_000), lines_run(32_000)
    assert many < 8.5 * few and many < 80 * 32_000


def brute_repeats(rows):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    seen, out = set(), []
    for k in order:
        b = (rows[k][1] or "").encode()
        cover = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                cover[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        spans = sum(1 for i in range(len(b)) if cover[i] and not (i and cover[i - 1]))
        out.append((str(rows[k][0]), len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("many", [2_000, 2])
def test_repeats(spark, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, other = word(250), word(130)
    texts = [word(rng.randrange(400)) + passage[rng.randrange(40) : rng.randrange(150, 250)] + word(rng.randrange(200)) for _ in range(12)]
    texts += [other, other, "x" * 500, "x" * 99, "xy" * 120, "", None, passage + passage, word(99), texts[0][:150] + texts[1][-150:], "long " * 9_000]
    rows = [(k * 2, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    got = sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect())
    assert got == brute_repeats(rows)


def test_repeats_of_a_very_common_passage(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrst"
    passage = "".join(rng.choices(letters, k=140))
    # over 2,000 different runs of one anchor: the passage, always between other bytes
    rows = [(k, "".join(rng.choices(letters, k=30)) + passage + "".join(rng.choices(letters, k=30))) for k in range(2_300)]
    assert len(rows) > suffix_dedup.MANY
    got = sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect())
    assert got == brute_repeats(rows)


def test_common_runs_are_combined_before_the_shuffle(spark, monkeypatch):
    """A run in every document gives its anchor's task a row or so of each task, and not of each piece of text or document."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2_000)
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh", k=240))
    rows = [(k, "".join(rng.choices("ijklmnop", k=150)) + passage + "".join(rng.choices("ijklmnop", k=150))) for k in range(400)]
    texts = docs(spark, rows).repartition(2).selectExpr("doc_id doc", "0L u", "CAST(text AS BINARY) __text")
    shared_rows = [r["count"] for r in suffix_dedup.anchor_runs(texts).where("what >= 0").groupBy("k", "what").count().where("count > 1").collect()]
    assert shared_rows and max(shared_rows) < 40


@pytest.mark.parametrize("pieces", [100_000, 500])
def test_large_anchors_are_sorted(spark, monkeypatch, pieces):
    """Anchors beyond MANY go through the suffix array, by cores, and what has one core too often by its windows."""
    monkeypatch.setattr(suffix_dedup, "PIECES", pieces)
    calls = []
    windows = suffix_dedup.spread_windows
    monkeypatch.setattr(suffix_dedup, "spread_windows", lambda df: calls.append(df.count()) or windows(df))
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrst"
    passage = "".join(rng.choices(letters, k=125))
    rows = [(k, "".join(rng.choices(letters, k=20)) + passage + "".join(rng.choices(letters, k=20))) for k in range(suffix_dedup.MANY + 100)]
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect()) == brute_repeats(rows)
    assert bool(calls) == (pieces == 500)


def test_scopes_of_threads(spark):
    """What another thread writes meanwhile isn't forgotten with the own tables."""
    made, other = [], []

    def elsewhere():
        other.append(shared.written(spark.range(3), "other"))

    with shared.scratch() as made:
        mine = shared.written(spark.range(2), "mine")
        thread = threading.Thread(target=elsewhere)
        thread.start()
        thread.join()
        with shared.scratch() as inner:
            deep = shared.written(spark.range(1), "deep")
        assert inner == [deep]
    assert made == [mine]
    shared.forget(*made)
    assert other[0].count() == 3


@pytest.mark.parametrize("groups", [100_000, 0])
def test_repeated_windows_spread(spark, monkeypatch, groups):
    monkeypatch.setattr(shared, "BROADCAST_GROUPS", groups)
    monkeypatch.setattr(suffix_dedup, "hot_rows", lambda rows: 2)
    monkeypatch.setattr(suffix_dedup, "MANY", 2)
    rng = random.Random(5)
    passage = "".join(rng.choices("abcd", k=160))
    rows = [(k, "".join(rng.choices("abcd", k=20)) + passage + str(k)) for k in range(9)]
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect()) == brute_repeats(rows)


def test_repeats_of_ids(spark):
    t = "".join(random.Random(7).choices("abcdefgh", k=150))
    rows = docs(spark, [(1, t), (1, t), (None, t), (2, None)])
    got = suffix_dedup.remove_repeats(rows, keep_text=True).collect()
    assert sorted(len(r.kept) for r in got) == [0, 0, 0, 150]
    assert [len(r.kept) for r in got if r.doc_id is None] == [150]


def test_repeats_by_shuffle(spark, monkeypatch):
    t = "".join(random.Random(7).choices("abcdefgh", k=150))
    rows = [(1, t), (2, "other " + t), (3, "plain")]
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect()) == brute_repeats(rows)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_IDS", 0)
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect()) == brute_repeats(rows)


def test_windows_are_sorted_with_their_common_bytes_as_one_symbol(monkeypatch):
    """A part of n windows gives the array n + CORE - 1 symbols, and the same windows as a plain comparison."""
    rng = random.Random(5)
    texts = []
    base = bytes(rng.choices(b"abcd", k=168))
    for doc in range(40):
        begin, end = rng.randrange(0, 30), rng.randrange(140, 169)
        text = bytearray(base[begin:end])
        if doc % 3:
            text[rng.choice((0, 3, -2, -1))] = 101
        texts.append((doc, 0, 7 * doc, len(text) - suffix_dedup.WINDOW + 1, 68 - begin, bytes(text)))
    lengths, array = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: lengths.append(len(text)) or array(text))
    parts = suffix_dedup.shared_parts(texts)
    got = sorted(map(tuple, suffix_dedup.later_windows(parts).tolist()))
    seen, later = set(), []
    for doc, u, s, n, _, body in texts:
        for k in range(n):
            window = body[k : k + suffix_dedup.WINDOW]
            later += [(doc, u, s + k)] * (window in seen)
            seen.add(window)
    assert got == sorted(later) and len(got) > 500
    assert lengths == [sum(part[3] + suffix_dedup.CORE - 1 for part in parts)]


def test_merged_spans_stay_within_their_texts():
    pa = suffix_dedup.pa
    kind = pa.list_(pa.struct([("s", pa.int64()), ("n", pa.int32())]))
    lists = pa.array([None, [{"s": 150, "n": 1}, {"s": 0, "n": 51}, {"s": 20, "n": 3}], [], [{"s": 0, "n": 1}, {"s": 101, "n": 2}]], kind)
    n, begin, end = suffix_dedup.merged_spans(np.array([0, 250, 7, 202]), lists)
    assert (n.tolist(), begin.tolist(), end.tolist()) == ([0, 1, 0, 2], [0, 0, 101], [250, 100, 202])
    n, begin, end = suffix_dedup.merged_spans(np.array([3]), pa.array([None], kind))
    assert n.tolist() == [0] and not len(begin) and not len(end)
