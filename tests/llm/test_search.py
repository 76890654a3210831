import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from sparkcurate.llm import lexical_search as ls

D = "doc_id long, text string, lang string, qno string, shard string, score string"
I = "item_id long, text string, score string, doc_id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "q", "s", "x") for i, t in rows], D)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "d") for i, t in rows], I)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text))


def brute(documents, asked, k=10):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in documents]
    n_docs, length = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in asked:
        scores = []
        for i, bag, n in bags:
            total = 0
            for t in terms(text):
                if t in bag:
                    m = 100 - 75 + (75 * n * n_docs) // length
                    total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if total > 0:
                scores.append((-total, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(found):
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str)


def corpus(seed, n):
    """Families of texts over vocabularies of their own and a common one, with copies and some long ones."""
    rng = random.Random(seed)
    words = [[f"f{g}w{k}" for k in range(60)] for g in range(6)] + [[f"c{k}" for k in range(30)]]
    out = []
    for i in range(n):
        own = rng.choice(words[:6])
        size = rng.choice([1, 5, 30, 60, 400])
        out.append((i, " ".join(rng.choice(own if rng.random() < 0.7 else words[6]) for _ in range(size))))
    return out + [(n + k, out[k % 3][1]) for k in range(n // 3)]


ODD = [(7, None), (8, ""), (9, " .,;\t"), (None, "Été c1 f0w1 x_y"), (3, "ÉTÉ c1 F0W1 x y"), (3, "c1 c1 c1"), (3, "c1 c1 c1"), (None, "c1 c1 c1"), (4, "été 😀 c2"), (5, "x" * 70_000 + " c3"), (6, "日本 c4 日本")]


@pytest.mark.parametrize("visits, shard, group", [((1, 3), 4, 40), ((4, 32), 128, 4096), ((2,), 16, 64)])
def test_search(spark, monkeypatch, visits, shard, group):
    monkeypatch.setattr(ls, "GROUP", group)
    monkeypatch.setattr(ls, "MOST_DOCS", 2 * group)
    monkeypatch.setattr(ls, "FIT_DOCS", 150)
    documents = corpus(1, 240) + [(1000 + k if i is not None else None, t) for k, (i, t) in enumerate(ODD)]
    asked = [(k, " ".join(t.split()[:40])) for k, (_, t) in enumerate(corpus(2, 12))] + [(50, "c1 C1 été"), (50, "c1"), (None, "日本 c3 x_y"), (51, None), (52, ""), (53, "nowhere")]
    index = ls.build_index(docs(spark, documents).repartition(5), shard=shard)
    found = ls.search(index, items(spark, asked), visits=visits)
    assert rows(found) == brute(documents, asked)
    shards = index.shards.collect()
    assert len({r.shard for r in shards}) == len(shards) and sum(len(r.ids) for r in shards) == sum(bool(terms(t)) for _, t in documents)
    assert all(len(r.ids) <= shard for r in shards)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(ls, "ITEMS", 3)
    documents, asked = corpus(3, 60), [(k, t) for k, t in corpus(4, 8)]
    assert rows(ls.search(ls.build_index(docs(spark, documents)), items(spark, asked))) == brute(documents, asked)


def test_nothing_to_find(spark):
    some = items(spark, [(1, "a b")])
    assert rows(ls.search(ls.build_index(docs(spark, [])), some)) == []
    assert rows(ls.search(ls.build_index(docs(spark, [(1, None), (2, "..")])), some)) == []
    index = ls.build_index(docs(spark, [(1, "a b"), (2, "b")]))
    assert rows(ls.search(index, items(spark, []))) == []
    assert rows(ls.search(index, some)) == brute([(1, "a b"), (2, "b")], [(1, "a b")])


def test_sql_is_the_same(spark):
    documents, asked = corpus(5, 80) + [x for x in ODD if x[0] is not None], [(k, t) for k, t in corpus(6, 5)] + [(90, "été C1 c1")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", documents)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", asked)
    assert sorted(con.sql(ls.OP13_SQL).fetchall(), key=str) == brute(documents, asked)


def test_long_texts_in_pieces(monkeypatch):
    text = ("Äb1 c2--" * 50 + "d" * 300 + " ").encode() * 3
    whole = ls.term_counts([text])[0]
    monkeypatch.setattr(ls, "LONG", 64)
    pieces = ls.term_counts([b"a b", text, b""])
    assert all((a == b).all() for a, b in zip(whole, pieces[1], strict=True)) and whole[1].tolist().count(150) == 2
    assert [len(t) for t, _ in pieces] == [2, 3, 0]


def test_bisection_gathers_what_is_alike():
    rng = np.random.default_rng(1)
    family = rng.permutation(np.repeat(np.arange(8), 32))
    sets = [np.unique(rng.integers(0, 40, 20) + 1000 * f).astype(np.uint64) for f in family]
    sets = [np.concatenate([[np.uint64(k % 7)], s]) for k, s in enumerate(sets)]  # the first term tells nothing
    sizes = np.array([len(s) for s in sets])
    runs = ls.bisected(sizes, np.concatenate(sets), 32)
    assert sorted(np.concatenate(runs).tolist()) == list(range(256)) and max(map(len, runs)) <= 32
    pure = sum(int(np.bincount(family[r]).max()) for r in runs) / 256
    assert pure > 0.9
    few = ls.bisected(np.array([5, 5, 5]), np.arange(15).astype(np.uint64), 128, 6)
    assert sorted(map(len, few)) == [1, 1, 1]


def test_impacts_are_whole():
    for corpus_, length in ((10, 400), (3_000_000_000_000, 10**15)):
        n, tf = np.array([1, 40, 1_000_000]), np.array([1, 3, 500])
        exact = [(10**9 * t) // (1000 * t + 8 * (25 + 75 * int(a) * corpus_ // length)) for a, t in zip(n, tf, strict=True)]
        assert ls.impacts(tf, n, corpus_, length).tolist() == exact
