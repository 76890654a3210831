import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkcurate.functions import text as tx
from sparkcurate.operators import draws, expand, keywords, sessions

RULES = "rule_id long, kind string, words array<string>, part string"


def texts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id long, text string")


def brute_hits(rows, rules):
    import re

    out = set()
    for k, t in enumerate(rows):
        if t is None:
            continue
        low = t.lower()
        own = {w for w in re.sub(r"[^\w\s]", " ", low.replace("'", " ").replace("’", " ")).split()}
        for rule, kind, bag, part in rules:
            if kind == "all" and {w.lower() for w in bag} <= own or kind == "anywhere" and part in low or kind == "pattern" and re.search(rf"\b(?:{part})\b", low):
                out.add((k, rule))
    return out


@pytest.mark.parametrize("most", [0, 100_000])
def test_rule_table(spark, monkeypatch, most):
    monkeypatch.setattr(keywords, "BROADCAST_WORDS", most)
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(40)] + ["che", "ora", "né", "C'è", "dell'ora"]
    rows = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 25))) + rng.choice(["", "?", " medievale.", "!"]) for _ in range(120)] + [None, "", " ", "w1 W2 w3"]
    rules = [(k, "all", [rng.choice(vocabulary[:43]) for _ in range(rng.randrange(1, 4))], None) for k in range(150)]
    rules += [(200 + k, "anywhere", None, p) for k, p in enumerate(["eval", "w1 w", "w1 w", "ora", "zz", "'è"])]
    rules += [(300 + k, "pattern", None, p) for k, p in enumerate(["w1|w2 w3", "or", "ora\\w*", "né"])]
    rules += [(400, "all", ["W1", "w1", "CHE"], None), (401, "all", ["w1", "nowhere"], None)]
    table = spark.createDataFrame(rules, RULES)
    monkeypatch.setattr(keywords.pattern_hits, "__defaults__", ("text", 3))
    monkeypatch.setattr(keywords.part_hits, "__defaults__", ("text", 5))
    found = keywords.rule_hits(texts(spark, rows).repartition(3), table)
    got = [tuple(r) for r in found.collect()]
    expected = brute_hits(rows, rules)
    assert set(got) == expected and len(got) == len(expected)
    hit = {r.id: r.hit for r in keywords.with_hit(texts(spark, rows), table).collect()}
    assert hit == {k: any(i == k for i, _ in expected) for k in range(len(rows))}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rule_totals_and_plain_patterns(spark):
    """Patterns that are words take no regular expression each, and totals are made where hits are found."""
    rows = ["C'è w1, e_2 w1!", "xw1 w12", None, "", "E_2 w1\u0301 né", "w1 w7 w12 w3"] * 3
    rules = [(k, "pattern", None, f"w{k}") for k in range(120)] + [(200, "pattern", None, "e_2"), (201, "pattern", None, "né"), (202, "pattern", None, "w[13]"), (203, "pattern", None, "w1")]
    rules += [(300, "all", ["w1", "W7"], None), (301, "all", ["w7", "w1", "w1"], None), (302, "all", ["w1", None], None), (303, "anywhere", None, "w1"), (304, "anywhere", None, "w1")]
    table = spark.createDataFrame(rules, RULES)
    expected = {}
    for k, rule in brute_hits(rows, [(r, kind, bag, part) for r, kind, bag, part in rules if r != 302]):
        if rows[k] and "\u0301" in rows[k] and rule in (1, 202, 203):
            continue  # Java takes the mark as a part of the word
        expected.setdefault(k, []).append(rule)
    found = keywords.rule_hits(texts(spark, rows), table)
    assert sorted(map(tuple, found.collect())) == sorted((k, r) for k, rs in expected.items() for r in rs)
    totals = {r.id: (r.hits, r.first_rule, r.rules) for r in keywords.hit_totals(texts(spark, rows).repartition(3), table).collect()}
    assert totals == {k: (len(rs), min(rs), sum(rs)) for k, rs in expected.items()}
    assert found._jdf.queryExecution().executedPlan().toString().count("RLIKE") == 1


def test_short_and_long_strings(spark, monkeypatch):
    """Strings of all lengths, at the ends of texts, over pieces of a long one, and none over two texts."""
    monkeypatch.setattr(keywords, "PIECE", 32)
    rng = random.Random(5)
    rows = ["".join(rng.choice("abé \U0001f600") for _ in range(n)) for n in [*range(0, 40), 200, 900]] + ["ab", "c", None, ""]
    parts = {t[k : k + n] for t in rows if t for n in (1, 2, 3, 5, 8, 9, 20) for k in rng.sample(range(len(t)), min(4, len(t)))} | {"abc", "bc", "zzzzz"}
    rules = [(k, "anywhere", None, p) for k, p in enumerate(sorted(parts) * 2)]
    got = [tuple(r) for r in keywords.rule_hits(texts(spark, rows).coalesce(2), spark.createDataFrame(rules, RULES)).collect()]
    expected = {(k, r) for k, t in enumerate(rows) if t for r, _, _, p in rules if p in t}
    assert set(got) == expected and len(got) == len(expected)


def test_rules_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    rows = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 12))) + rng.choice(["", " é", "."]) for _ in range(80)]
    rules = [(k, "all", [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 4))], None) for k in range(60)] + [(100 + k, "pattern", None, f"w{k}") for k in range(30)]
    monkeypatch.setattr(keywords, "BAGS", 40)
    got = [tuple(r) for r in keywords.rule_hits(texts(spark, rows), spark.createDataFrame(rules, RULES)).collect()]
    expected = brute_hits(rows, rules)
    assert set(got) == expected and len(got) == len(expected)


def test_a_text_is_cut_once_for_its_rules(spark, tmp_path, monkeypatch):
    """Rules are made, and bags and plain patterns looked up, without cutting texts for filters, for counts or for each block again."""
    from sparkcurate.plans import corpus_queries

    rng = random.Random(7)
    docs = [(k, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 20))), "en", "s", 1) for k in range(50)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(400).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    rules = corpus_queries.part_rules(spark, str(tmp_path))
    assert rules._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    cuts, numbered = [], keywords._numbered
    monkeypatch.setattr(keywords, "_numbered", lambda *a: cuts.append(numbered(*a)) or cuts[-1])
    keywords.hit_totals(spark.read.parquet(str(tmp_path / "documents.parquet")).select("doc_id", "text"), rules, "doc_id").collect()
    assert len(cuts) == 1 and cuts[0]._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2


def test_rules_point_to_places_by_ranges(spark, tmp_path, monkeypatch):
    from sparkcurate.plans import corpus_queries

    monkeypatch.setattr(corpus_queries, "RANGE", 7)
    ids = sorted({k * k * k - 500 for k in range(60)} | {2**62})
    spark.createDataFrame([(i, f"a{k} b{k} c{k}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(200).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    rules = corpus_queries.part_rules(spark, str(tmp_path))
    got = {r.rule_id: r["words"] or [r.part] for r in rules.collect()}
    own = lambda p: f"a{p * 7 % len(ids)} b{p * 7 % len(ids)} c{p * 7 % len(ids)}"
    assert got.keys() == {p for p in range(200) if p % 4 < 2 or p % 40 == 3 or own(p)[p % 50 :]}
    assert all(set(got[p]) <= set(own(p).split()) for p in got if p % 4 < 2 or p % 40 == 3)
    ranked = [w for w in rules._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in w and "Window" in w]
    assert ranked and all("range" in w.split("],", 1)[1] for w in ranked)


def test_bad_rules(spark):
    for bad in ([(1, "all", [], None)], [(1, "all", None, None)], [(1, "anywhere", None, "")], [(1, "some", ["a"], "a")], [(1, None, ["a"], "a")]):
        with pytest.raises(keywords.RuleError):
            keywords.rule_hits(texts(spark, ["a"]), spark.createDataFrame(bad, RULES))
    none = spark.createDataFrame([], RULES)
    assert keywords.rule_hits(texts(spark, ["a"]), none).collect() == []
    assert keywords.rule_hits(texts(spark, []), spark.createDataFrame([(1, "all", ["a"], None), (2, "anywhere", None, "a")], RULES)).collect() == []


def sequential(rounds, turns, avoid):
    """The rule as it is said: one group after another."""
    taken, out = set(avoid), set()
    for group, quota in turns:
        kept = []
        for k, rows in enumerate(rounds):
            for g, order, key in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
                if len(kept) < quota and key not in taken and key not in [x[3] for x in kept]:
                    kept.append((group, k, order, key))
        taken |= {x[3] for x in kept}
        out |= set(kept)
    return out


@pytest.mark.parametrize("groups, keys, held", [(200, 400, 500_000), (12, 30, 0), (5, 1, 500_000)])
def test_sessions(spark, monkeypatch, groups, keys, held):
    monkeypatch.setattr(sessions, "BROADCAST_HELD", held)
    rng = random.Random(groups)
    names = [f"g{k}" for k in rng.sample(range(1000), groups)]
    rounds = [[(rng.choice([*names, "other"]), n, rng.choice([None, *(f"k{rng.randrange(keys)}" for _ in range(9))])) for n in range(1500)] for _ in range(2)]
    turns = [(g, rng.randrange(0, 9)) for g in names]
    avoid = {f"k{k}" for k in range(0, keys, 11)}
    frames = [spark.createDataFrame(r, "g string, ord long, key string") for r in rounds]
    table = spark.createDataFrame([(g, k, q) for k, (g, q) in enumerate(turns)], "g string, turn long, quota long")
    found = sessions.sessions(frames, table, "g", "ord", avoid=spark.createDataFrame([(k,) for k in avoid], "key string"))
    expected = sequential(rounds, turns, avoid)
    got = [tuple(r) for r in found.collect()]
    assert set(got) == expected and len(got) == len(expected)
    report = {r.g: r for r in sessions.session_report(found, table, "g").collect()}
    counts = Counter(g for g, *_ in expected)
    assert {g: r.kept for g, r in report.items()} == {g: counts[g] for g in names}
    assert sum(r.topped_up for r in report.values()) == sum(k for _, k, _, _ in expected) and all(r.short == (r.kept < r.quota) for r in report.values())


def test_draws_are_a_permutation(spark):
    rows = spark.createDataFrame([(k, -3, -3 + k - 1, k) for k in range(0, 130)] + [(500, 7, 5, 3), (501, 0, 10, 0), (502, None, 4, 2)], "k long, lo long, hi long, n long")
    by = {}
    for r in draws.drawn(rows, "lo", "hi", "n", "k", seed=5).collect():
        by.setdefault(r.k, []).append(r.drawn)
    assert set(by) == set(range(1, 130)) and all(sorted(v) == list(range(-3, -3 + k)) for k, v in by.items())
    assert sum(v == sorted(v) for v in by.values()) < 10


def test_draws_of_wide_ranges(spark):
    rows = spark.createDataFrame([(k, 10**12 * k, 10**12 * (k + 1) + 3**k, 400) for k in range(20)] + [(99, 0, 2**62 - 1, 50)], "k long, lo long, hi long, n long")
    found = draws.drawn(rows, "lo", "hi", "n", "k")
    got = found.collect()
    assert len(got) == 20 * 400 + 50 and len({(r.k, r.drawn) for r in got}) == len(got) and all(r.lo <= r.drawn <= r.hi for r in got)
    middle = sum(r.drawn - r.lo > (r.hi - r.lo) / 2 for r in got) / len(got)
    assert 0.45 < middle < 0.55
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_frames_draw_from_ranges(spark):
    frames = spark.createDataFrame([("f", "wait {N} s in {P}", {"n": "{N}"}, 5), ("g", "{M} or {N}", {}, 3), ("h", "{Q}", {}, 3)], "frame_id string, text string, args map<string,string>, cap int")
    slots = spark.createDataFrame([("P", "rome", "R"), ("P", "oslo", "O")], "slot string, surface string, canonical string")
    ranges = spark.createDataFrame([("N", 10**12, 3 * 10**12), ("M", 4, 5)], "slot string, min long, max long")
    got = sorted(tuple(r) for r in expand.expand_frames(frames, slots, 3, ["frame_id"], ranges).select("frame_id", "i", "text", F.col("args")["n"]).collect())
    assert [(g[0], g[1]) for g in got] == [("f", k) for k in range(5)] + [("g", k) for k in range(3)]
    ns = [int(g[2].split()[1]) for g in got[:5]]
    assert len(set(ns)) == 5 and all(10**12 <= n <= 3 * 10**12 for n in ns) and [g[3] for g in got[:5]] == [str(n) for n in ns]
    assert {g[2].split()[0] for g in got[5:]} == {"4", "5"}
    assert sorted(r.slot for r in expand.undefined_slots(frames, slots, ["frame_id"], ranges).collect()) == ["Q"]


def test_values_with_braces_stay(spark):
    templates = spark.createDataFrame([("how {thing} {verb}",), ("{} {} {unknown}",)], "template string")
    entities = spark.createDataFrame([("a {verb} b", "RUN", "{thing}")], "thing string, verb string, entity string")
    got = {r.template: r.text for r in expand.template_cross(templates, entities).collect()}
    assert got == {"how {thing} {verb}": "how a {verb} b RUN", "{} {} {unknown}": "{thing} {thing} {unknown}"}


def test_words_of_rules_are_those_of_texts(spark):
    assert texts(spark, ["Un'ora, DUE"]).select(tx.words(F.col("text")).alias("w")).first().w == ["un", "ora", "due"]
