import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkcurate.functions import text
from sparkcurate.operators import ab, assemble, catalog, decontam, expand, metrics, ordering, publish

V = "source string, category string, conf double, expect string, pick string"


def verdicts(spark, rows):
    return spark.createDataFrame([(s, "c", c, e, p) for s, c, e, p in rows], V)


# Six cases, with what a gate tells of them at a floor of -0.10.
SIX = [("spine", -0.02, "current_time", "current_time"), ("spine", -0.03, "calculator", "open"), ("spine", -0.30, "calculator", "calculator"), ("spine", None, "greeting", None), ("spine", None, "NONE", None), ("spine", -0.04, "NONE", "open")]


def test_gate_metrics(spark):
    m = metrics.gate_metrics(verdicts(spark, SIX), -0.1).first()
    assert (m.fired, m.correct, m.precision, m.recall) == (2, 1, 0.5, 0.25)
    assert (m.abst_pass, m.abst_total, m.abstention, m.pos_total) == (1, 2, 0.5, 4)
    lower = metrics.gate_metrics(verdicts(spark, [(*x[:2], x[2].replace("NONE", "none"), x[3]) for x in SIX]), -0.1).first()
    assert lower == m


def test_vacuous_rates(spark):
    m = metrics.gate_metrics(verdicts(spark, [("spine", None, "a", None)]), 0.0).first()
    assert (m.precision, m.abstention, m.recall) == (1.0, 1.0, 0.0)
    m = metrics.gate_metrics(verdicts(spark, [("spine", None, "NONE", None)]), 0.0).first()
    assert (m.precision, m.abstention, m.recall) == (1.0, 1.0, 0.0)


def joint(source):
    good = [(source, -k / 100, "a", "a") for k in range(1, 13)]
    return good + [(source, None, "NONE", None)] * 8 + [(source, -0.11, "NONE", "a"), (source, -0.115, "NONE", "a")]


def test_sweep_is_each_floor(spark):
    v = verdicts(spark, joint("generated"))
    for row in metrics.floor_sweep(v).collect():
        alone = metrics.gate_metrics(v, row.floor).first()
        assert all(row[k] == alone[k] for k in ("fired", "correct", "abst_pass", "abst_total", "pos_total", "precision", "abstention", "recall"))


def lowest(spark, rows, **kw):
    return metrics.viable(metrics.floor_sweep(verdicts(spark, rows)), **kw).orderBy("floor").first()


def test_lowest_viable_floor(spark):
    m = lowest(spark, joint("generated"))
    assert (m.floor, m.abstention, m.precision, m.fired) == (-0.11, 0.9, 1.0, 11)
    good = [("generated", round(-0.01 * k, 4), "a", "a") for k in range(1, 16)] + [("generated", -0.6, "a", "a")] + [("generated", None, "NONE", None)] * 5
    m = lowest(spark, good)
    assert (m.floor, m.fired) == (-0.15, 15)
    few = [("generated", -0.01 * k, "a", "a") for k in range(1, 5)] + [("generated", None, "NONE", None)] * 20
    assert lowest(spark, few) is None
    assert metrics.floor_sweep(verdicts(spark, [("spine", None, "a", None)])).count() == 0


def test_sweep_of_skewed_confidences(spark):
    rows = [("generated", -1000.0, "a", "a")] + [("generated", -k / 1e6, "a" if k % 3 else "NONE", "a") for k in range(700)]
    v = verdicts(spark, rows)
    for row in metrics.floor_sweep(v).where("floor IN (-1000.0, -0.0003, -0.000699)").collect():
        alone = metrics.gate_metrics(v, row.floor).first()
        assert all(row[k] == alone[k] for k in ("fired", "correct", "abst_pass", "precision", "abstention", "recall"))


def test_derived_floors(spark):
    ok = [("spine", -0.05, "a", "a")] * 5 + [("spine", None, "NONE", None)] * 3
    derive = lambda rows: tuple(metrics.derive_floor(verdicts(spark, rows), -0.06).first())
    assert derive(ok + joint("generated")) == (-0.11, "derived")
    assert derive(ok + [("spine", -0.04, "a", "b")] + joint("generated")) == (-0.06, "fallback")
    assert derive(ok) == (-0.06, "fallback")
    assert derive(ok + [("generated", -0.01, "a", "b")] * 30) == (-0.06, "fallback")
    with pytest.raises(ValueError):
        derive(joint("generated"))


def test_negative_target(spark):
    cases = [(300, 1.0, 300), (130, 1.0, 130), (10, 1.0, 250), (130, 2.0, 260), (200, 0.5, 100), (49, 1.0, 250), (50, 1.0, 50), (125, 0.5, 62)]
    df = spark.createDataFrame(cases, "p long, r double, e long")
    assert df.where(assemble.negative_target(F.col("p"), F.col("r")) != F.col("e")).count() == 0


def expansion(spark, cap=12):
    frames = spark.sql(f"SELECT 'f' AS id, '{{A}} and {{B}}' AS text, map('k', '{{A}}') AS args, {cap} AS cap UNION ALL SELECT 'g', 'plain', map('k', 'v'), {cap}")
    slots = spark.sql("SELECT * FROM VALUES ('A','a1','A1'),('A','a2','A2'),('A','a3','A3'),('B','b1','B1'),('B','b2','B2') t(slot, surface, canonical)")
    return frames, slots


def test_expansion_zips_cyclically(spark):
    frames, slots = expansion(spark)
    rows = [r for r in expand.expand_frames(frames, slots, 1, ["id"]).orderBy("id", "i").collect()]
    assert [r.id for r in rows] == ["f", "f", "f", "g"]
    assert {r.text.split()[0] for r in rows[:3]} == {"a1", "a2", "a3"}
    assert rows[0].text.split()[2] == rows[2].text.split()[2] != rows[1].text.split()[2]
    assert all(r.args["k"] == r.text.split()[0].upper() for r in rows[:3])
    assert rows[3].text == "plain" and rows[3].args == {"k": "v"}
    assert expand.expand_frames(*expansion(spark, 2), 1, ["id"]).count() == 3


def test_expansion_ignores_order(spark):
    frames, slots = expansion(spark)
    a = set(map(str, expand.expand_frames(frames, slots, 1, ["id"]).collect()))
    assert a == set(map(str, expand.expand_frames(frames.repartition(3), slots.orderBy(F.desc("surface")), 1, ["id"]).collect()))


def test_undefined_slots(spark):
    frames, slots = expansion(spark)
    with pytest.raises(expand.BankError, match="B"):
        expand.check_slots(frames, slots.where("slot = 'A'"), ["id"])


def filtered(spark, texts, keep=30, avoid=(), corpus=(), hit=None):
    cands = spark.createDataFrame([("s", k, t) for k, t in enumerate(texts)], "g string, ord long, text string")
    keys = lambda x: spark.createDataFrame([(k,) for k in x], "key string")
    rows = decontam.judged(cands, keys(avoid), keys(corpus), F.lit(False) if hit is None else hit, text.normalize(F.col("text")), "g", "ord")
    kept = [r.text for r in decontam.filter_candidates(rows, keep, "g", "ord").orderBy("ord").collect()]
    return kept, decontam.filter_stats(cands, rows, keep, "g", "ord").first()


def test_candidates(spark):
    kept, stats = filtered(spark, ["  what   time is\tit in  Tokyo ", "what time is it in Tokyo", "", "   "])
    assert kept == ["what time is it in Tokyo"] and (stats.raw, stats.deduped) == (4, 1)
    kept, stats = filtered(spark, ["turn on", "fine"], hit=F.col("text") == "turn on")
    assert kept == ["fine"] and stats.keyword_hits == 1
    kept, stats = filtered(spark, ["Who painted Starry Night?"], avoid=["who painted starry night"])
    assert kept == [] and stats.eval_collisions == 1
    kept, stats = filtered(spark, ["what's the damage"], corpus=["what is the damage"])
    assert kept == [] and stats.corpus_collisions == 1
    kept, stats = filtered(spark, [f"text number {k}x" for k in range(30)] + ["bad"], keep=7, avoid=["bad"])
    assert kept == [f"text number {k}x" for k in range(7)] and stats.kept == 7 and stats.eval_collisions == 0
    assert len(filtered(spark, ["a", "b"], keep=0)[0]) == 1


def test_sessions_follow_one_another(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("b", 4, "x"), ("b", 5, "z"), ("b", 6, "w")]
    df = spark.createDataFrame(rows, "g string, ord long, key string")
    kept = decontam.sequential_sessions(df, ["a", "b"], 2, "g", "ord")
    assert sorted((r.g, r.key) for r in kept.collect()) == [("a", "x"), ("a", "y"), ("b", "w"), ("b", "z")]


def test_guard(spark):
    df, keys = spark.createDataFrame([("k",)], "key string"), spark.createDataFrame([("k",), ("l",)], "key string")
    with pytest.raises(decontam.HeldOutCollision):
        decontam.heldout_guard(df, keys)
    assert decontam.drop_keys(df, keys).count() == 0


def test_first_rows_of_null_keys(spark):
    rows = [(3, "a", "x"), (1, "a", "y"), (1, "a", "b"), (5, None, "z"), (4, None, "w"), (None, "c", "n"), (2, "c", "o")]
    df = spark.createDataFrame(rows, "id long, k string, v string")
    assert {(r.k, r.id) for r in ordering.keep_first_id(df, ["k"], "id").collect()} == {("a", 1), (None, 4), ("c", None)}
    got = ordering.keep_first_id(df, ["k"], "id", keep=("v",)).collect()
    assert {(r.k, r.id, r.v) for r in got} == {("a", 1, "b"), (None, 4, "w"), ("c", None, "n")} and len(got) == 3
    whole = ordering.keep_first(df, ["k"], ["id", "v"]).collect()
    assert {(r.k, r.id) for r in whole} == {(r.k, r.id) for r in got}


def test_large_samples(spark):
    df = spark.range(3000).repartition(5)
    for n in (0, 1, 700, 2999, 3000, 5000):
        a, b = ({r.id for r in ordering.sample_n(df, n, 2, "id", small=small).collect()} for small in (-1, 10_000))
        assert a == b and len(a) == min(n, 3000)


def test_splits_and_samples(spark):
    df = spark.range(1000).repartition(7)
    parts = {r.metadata: r["count"] for r in ordering.split_ratio(df, 0.9, 1, "id").groupBy("metadata").count().collect()}
    assert parts == {"train": 900, "eval": 100}
    a, b = ({r.id for r in ordering.sample_n(x, 50, 2, "id").collect()} for x in (df, df.repartition(2)))
    assert a == b and len(a) == 50
    ranks = ordering.global_rank(df, ordering.hash_order(3, "id"), ["id"], 1000, per_bucket=10)
    assert sorted(r["__rank"] for r in ranks.collect()) == list(range(1, 1001))


def test_catalogue(spark):
    s = spark.createDataFrame([("a.x", None), ("b.y", True), ("c.y", False)], "id string, router_eligible boolean")
    assert sorted(r.id for r in catalog.eligible(s).collect()) == ["a.x", "b.y"]
    assert {r.id: r.alias for r in catalog.assign_alias(s).collect()} == {"a.x": "x", "b.y": "b.y", "c.y": "c.y"}
    other = spark.createDataFrame([("a.x", True), ("d", True), ("d", False)], "id string, router_eligible boolean")
    assert sorted(r.id for r in catalog.merge_priority(s, other).collect()) == ["a.x", "b.y", "c.y", "d", "d"]
    ex = spark.sql("SELECT 's' AS skill_id, 0L AS ex_ord, map('b', '1') AS args UNION ALL SELECT 's', 1L, map('a', '2', 'b', '3') UNION ALL SELECT 't', 0L, CAST(map() AS map<string,string>)")
    got = {r.skill_id: (r.names, r.schema) for r in catalog.infer_params(ex).collect()}
    assert got["s"][0] == ["b", "a"] and '"required": ["b", "a"]' in got["s"][1]
    assert got["t"] == ([], '{"type": "object", "properties": {}}')


def test_drift(spark):
    skills = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")], "skill_id string, sha256 string")
    banked = spark.createDataFrame([("a",), ("b",), ("d",), ("z",)], "skill_id string")
    ledger = spark.createDataFrame([("a", "1"), ("b", "x")], "skill_id string, sha256 string")
    assert {r.skill_id: r.status for r in catalog.drift(skills, banked, ledger).collect()} == {"a": "ok", "b": "stale", "c": "missing", "d": "stale", "z": "orphaned"}


def test_banks_change(spark):
    bank = spark.createDataFrame([("s", "old", "a.json"), ("t", "keep", "a.json")], "skill_id string, text string, src_file string")
    draft = spark.createDataFrame([("s", "new", "draft-s.json")], "skill_id string, text string, src_file string")
    assert sorted(tuple(r) for r in catalog.activate_bank(bank, draft, "s", "auto.json").collect()) == [("s", "new", "auto.json"), ("t", "keep", "a.json")]


def test_calls(spark):
    known = spark.createDataFrame([("open",)], "name string")
    df = spark.createDataFrame([("<start_function_call>call:open{",), ("<start_function_call>call:made_up{",), ("none",), ("<start_function_call>call:a.b{",)], "raw string")
    assert [r.predicted for r in metrics.parse_call(df, known).orderBy("raw").collect()] == ["__none__", "__hallucinated:made_up__", "open", "__none__"]
    loose = metrics.parse_call(df, known, hallucination_abstains=True)
    assert [r.predicted for r in loose.orderBy("raw").collect()] == ["__none__", "__none__", "open", "__none__"]


def test_files(spark):
    listing = spark.createDataFrame([("a", '"beef"', 3106736256, b""), ("b", '"beef"', None, b"abc")], "name string, etag string, linked_size long, content binary")
    got = {r.name: (r.sha256[:8], r.size_bytes) for r in publish.file_meta(listing).collect()}
    assert got == {"a": ("beef", 3106736256), "b": ("ba7816bf", 3)}
    old = spark.createDataFrame([("g", "x", "AA")], "g string, name string, sha256 string")
    assert publish.manifest_diff(old, old.withColumn("sha256", F.lower("sha256")), "g").first().publish is False
    assert publish.manifest_diff(old.limit(0), old, "g").first().publish is True


def test_ab(spark):
    clips, models = spark.createDataFrame([("c1",), ("c2",)], "clip string"), spark.createDataFrame([("m",)], "model string")
    spoken = spark.createDataFrame([("m", "c1", "hi")], "model string, clip string, transcript string")
    side = spark.createDataFrame([("c1", "hi"), ("c2", "yo")], "clip string, device string")
    assert {r.clip: r.differs for r in ab.ab_compare(clips, spoken, side, models).collect()} == {"c1": False, "c2": True}
    cpu = spark.createDataFrame([("x", "a", 1, 1, 1234, 600, 100), ("x", "b", 1, 1, 2000, 600, 100), ("y", "a", 1, 2, 5, 600, 100)], "g string, label string, pid_before long, pid_after long, ticks long, elapsed long, clk_tck long")
    got = {r.g: (r.pct_first, r.pct_second, r.delta) for r in ab.cpu_delta(cpu, "g", "a", "b").collect()}
    assert got == {"x": (2.06, 3.33, -1.27), "y": (None, None, None)}


def test_cpu_rounds_as_sql_and_adds_in_order(spark, tmp_path):
    near = spark.createDataFrame([("x", "a", 1, 1, 1793, 40, 100), ("x", "b", 1, 1, 0, 40, 100)], "g string, label string, pid_before long, pid_after long, ticks long, elapsed long, clk_tck long")
    assert tuple(ab.cpu_delta(near, "g", "a", "b").first()) == ("x", 44.83, 0.0, 44.83)
    from sparkcurate.plans.queries import QUERIES

    rng, rows = random.Random(3), []
    for user in range(60):
        cents = [rng.randrange(1, 20_000) for _ in range(60)]
        cents[-2:] = [c + 100 - sum(cents[k::2]) % 100 for k, c in enumerate(cents[-2:])]  # both halves add up to whole numbers
        rows += [(user * 60 + k, user, c / 100) for k, c in enumerate(cents)]
    expected = {}
    for event, user, value in rows:
        total, n = expected.get((user, event % 2), (0.0, 0))
        expected[user, event % 2] = (total + value, n + 1)
    expected = {u: tuple(math.floor(math.floor(expected[u, half][0]) / 100 / expected[u, half][1] * 100 * 100 + 0.5) / 100 for half in (0, 1)) for u in range(60)}
    rng.shuffle(rows)
    spark.createDataFrame(rows, "event_id long, user_id long, value double").repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    got = {r.user_id: (r.pct_first, r.pct_second) for r in QUERIES["cpu_cost"](spark, str(tmp_path)).collect()}
    assert got == expected


def test_dataset(spark):
    pos = spark.sql("SELECT concat('text ', id) AS text, 'tool' AS name, map('a', 'b') AS args, id AS ord FROM range(60)")
    neg = spark.sql("SELECT concat('neg ', id % 90) AS text, id AS ord FROM range(200)")
    held = spark.createDataFrame([("neg 3",)], "key string")
    rows = assemble.dataset(pos, neg, held, 1.0, 4)
    assert {r.metadata: r["count"] for r in rows.groupBy("metadata").count().collect()} == {"train": 108, "eval": 12}
    assert rows.where("text = 'neg 3'").count() == 0
    again = assemble.dataset(pos.repartition(7), neg.repartition(3), held, 1.0, 4)
    assert rows.select("metadata", "text").exceptAll(again.select("metadata", "text")).count() == 0
    tools = spark.sql("SELECT array('t') AS tools")
    last = assemble.attach_tools(rows, tools, "dev", "sorry").select(F.col("messages")[2].alias("m")).collect()
    assert sum(r.m.content == "sorry" for r in last) == 60 and sum(r.m.tool_calls is not None for r in last) == 60


def test_dataset_shuffles_no_texts_to_choose_and_split(spark):
    """Only the join that fetches chosen texts deals texts out; equal hashes at the split's bound are ranked one by one."""
    pos = spark.sql("SELECT concat('text ', id) AS text, 'tool' AS name, map('a', 'b') AS args, id AS ord FROM range(60)")
    neg = spark.sql("SELECT IF(id = 7, NULL, concat('neg ', id % 90)) AS text, id AS ord FROM range(200)")
    rows = assemble.dataset(pos, neg, spark.createDataFrame([("neg 3",)], "key string"), 5.0, 4)
    got = rows.collect()
    assert Counter(r.metadata for r in got) == {"train": 135, "eval": 15} and len({r.text for r in got if r.name is None}) == 90
    hashes = {(r.name, r.text): hashlib.md5("|".join(["4", *([r.name, r.text.split()[1]] if r.name else ["-1"]), *([r.text] if r.text is not None else [])]).encode()).hexdigest() for r in got}
    assert {(r.name, r.text) for r in got if r.metadata == "train"} == set(sorted(hashes, key=hashes.get)[:135])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    same = spark.sql("SELECT id % 3 AS k FROM range(90)")
    for ratio, train in ((0.5, 45), (1 / 3, 30), (0.0, 0), (1.0, 90)):
        split = ordering.split_ratio(same, ratio, 4, "k")
        assert split.where("metadata = 'train'").count() == train and split.count() == 90
    assert ordering.split_ratio(same.limit(0), 0.5, 4, "k").count() == 0


def test_keyword_drop(spark):
    rows = [("a", "hit"), ("a", "a1"), ("b", "b1"), ("b", "hit"), ("c", "hit")]
    df = spark.createDataFrame(rows, "skill string, text string")
    kept, stats = decontam.drop_keyword_hits(df, F.col("text") == "hit", "skill")
    assert sorted(r.text for r in kept.collect()) == ["a1", "b1"]
    assert {r.skill: (r.dropped, r.emptied) for r in stats.collect()} == {"a": (1, False), "b": (1, False), "c": (1, True)}
    with pytest.raises(ValueError, match="c"):
        decontam.check_not_emptied(stats, "skill")
    with pytest.raises(ValueError):
        decontam.newline_guard(spark.createDataFrame([("a\nb",)], "t string"), "t")


def test_banks_of_skills(spark):
    skills, banks = spark.createDataFrame([("a",), ("b",)], "skill_id string"), spark.createDataFrame([("a", "t")], "skill_id string, text string")
    with pytest.raises(expand.BankError, match="b"):
        expand.with_banks(skills, banks)
    assert {tuple(r) for r in expand.with_banks(skills, banks, allow_missing=True).collect()} == {("a", True), ("b", False)}


def test_floors_of_cases(spark):
    groups = spark.createDataFrame([("a",), ("b",), ("c",), ("NONE",)], "g string")
    rows = spark.createDataFrame([("a",)] * 2 + [("b",)] * 9 + [("c",)] * 10 + [("NONE",)] * 19, "g string")
    status = lambda r: {x.g: x.status for x in metrics.per_group_floors(groups, r, "g").collect()}
    assert status(rows) == {"a": "fatal", "b": "thin", "c": "ok", "NONE": "fatal"}
    assert status(rows.unionByName(spark.createDataFrame([("NONE",)], "g string")))["NONE"] == "ok"


def test_templates(spark):
    t = spark.createDataFrame([("{a} or {b}",), ("say {}",)], "template string")
    e = spark.createDataFrame([("x", "y", "z")], "a string, b string, entity string")
    assert {r.text for r in expand.template_cross(t, e).collect()} == {"x or y", "say z"}
    assert expand.template_cross(t.limit(0), e).columns == ["a", "b", "entity", "template", "text"]


def test_content_hash(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "t string")
    first = publish.multiset_hash(df, "t").first()
    assert first == publish.multiset_hash(df.repartition(3), "t").first() != publish.multiset_hash(df.distinct(), "t").first()
    assert publish.multiset_hash(df.limit(0), "t").first().n == 0


def test_fingerprint(spark):
    import hashlib
    import json

    facts = {"id": "a.b", "description": 'q"é', "parameters": {"type": "object", "n": 1.5}, "examples": ["x", "y"]}
    df = spark.createDataFrame([("a.b", 'q"é', '{"type": "object", "n": 1.50}', ["y", "x"]), ("a", "d", "{", None)], "i string, d string, p string, t array<string>")
    got = [r[0] for r in df.select(catalog.fingerprint(F.col("i"), F.col("d"), F.col("p"), F.col("t"))).collect()]
    assert got == [hashlib.sha256(json.dumps(facts, sort_keys=True, ensure_ascii=False).encode()).hexdigest(), None]
