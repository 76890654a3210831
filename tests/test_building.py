import os
import struct
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcurate.functions.text import loose_key
from sparkcurate.operators import assemble, build, content, observed, oracle, publish, quarantine
from sparkcurate.sources import sinks, text_files, versions, wav_stream


def upper_or_wrong(extra):
    def start():
        return lambda texts: [t.upper() for t in texts] + ["x"] * extra if extra >= 0 else [t.upper() for t in texts][:extra]

    return start


def test_oracle_pairs_rows(spark):
    df = spark.createDataFrame([(k, f"t{k}" if k % 5 else None) for k in range(50)], "id long, text string").repartition(3)
    got = oracle.asked(df, "text", upper_or_wrong(0), "said", "string", batch=7).collect()
    assert {(r.id, r.said) for r in got} == {(k, f"T{k}" if k % 5 else None) for k in range(50)}
    assert oracle.normalized(df, "text", upper_or_wrong(0)).columns == ["id", "text"]
    for extra in (-1, 1):
        with pytest.raises(Exception, match="answers for"):
            oracle.asked(df, "text", upper_or_wrong(extra), "said", "string", batch=7).collect()
    with pytest.raises(Exception, match="line ends"):
        oracle.asked(spark.createDataFrame([("a\nb",)], "text string"), "text", upper_or_wrong(0), "said", "string", one_line=True).collect()
    assert oracle.asked(df.limit(0), "text", upper_or_wrong(0), "said", "string").collect() == []


def test_oracle_starts_once_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def start():
        import uuid

        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return lambda texts: [len(t) for t in texts]

    df = spark.range(200).selectExpr("repeat('a', CAST(id AS INT)) text").coalesce(1)
    assert sum(r.n for r in oracle.asked(df, "text", start, "n", "long", batch=10).collect()) == sum(range(200))
    assert len(os.listdir(folder)) == 1


def test_line_programs(spark):
    program = [sys.executable, "-c", "import sys\nfor line in sys.stdin: print(line.strip()[::-1])"]
    df = spark.createDataFrame([("abc",), ("é x",)], "text string")
    assert sorted(r.said for r in oracle.asked(df, "text", oracle.line_command(program), "said", "string").collect()) == ["cba", "x é"]
    short = [sys.executable, "-c", "print('one')"]
    with pytest.raises(Exception, match="answers for"):
        oracle.asked(df.coalesce(1), "text", oracle.line_command(short), "said", "string").collect()


def test_oracle_drops_hits(spark):
    df = spark.createDataFrame([("s", "play it"), ("s", "other"), ("t", "play")], "skill string, text string")
    kept, stats = oracle.drop_hits(df, "text", lambda: lambda texts: [t.startswith("play") for t in texts], "skill")
    assert [tuple(r) for r in kept.collect()] == [("s", "other")]
    assert {r.skill: (r.total, r.dropped, r.emptied) for r in stats.collect()} == {"s": (2, 1, False), "t": (1, 1, True)}


def test_guards_decide_after_one_pass(spark, tmp_path):
    df = spark.range(100).withColumn("text", F.concat(F.lit("t"), "id"))
    guards = observed.Guards()
    fine = guards.watch(df, {"negative ids": F.col("id") < 0, "null texts": F.col("text").isNull()}, F.col("text"))
    observed.write_guarded(guards.need(fine, "enough", F.col("id") > 50, 49), f"{tmp_path}/a", guards)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 100
    bad = observed.Guards()
    seen = bad.need(bad.watch(df, {"large ids": F.col("id") > 97, "fine": F.col("id") < 0}, F.col("text")), "many", F.col("id") < 10, 11)
    with pytest.raises(observed.GuardError) as e:
        observed.write_guarded(seen, f"{tmp_path}/b", bad)
    assert e.value.failures == {"large ids": "2 rows, such as 't98'", "many": "10 rows, 11 are needed"}
    assert sorted(os.listdir(tmp_path)) == ["a"]
    with pytest.raises(FileExistsError):
        observed.write_guarded(df, f"{tmp_path}/a", observed.Guards())


def test_rows_that_fail_are_kept_apart(spark, tmp_path):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, "assistant", "  "), (4, 0, "user", "a"), (4, 0, "assistant", "b"), (5, 0, None, "a"), (5, 1, "assistant", "b"), (6, None, "assistant", "b"), (7, 0, "assistant", None), (8, 0, "assistant", "only")]
    made = quarantine.training_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    good, bad = quarantine.write_apart(made, "reason", f"{tmp_path}/t")
    assert {r.conv_id: r.reason for r in bad.collect()} == {2: "end", 3: "blank", 4: "turn", 5: "role", 6: "turn", 7: "blank"}
    got = {r.conv_id: (r.prompt, r.completion) for r in good.collect()}
    assert got == {1: ("<start_of_turn>user\nhi<end_of_turn>\n<start_of_turn>assistant\n", "yes<end_of_turn>\n"), 8: ("<start_of_turn>assistant\n", "only<end_of_turn>\n")}
    assert "reason" not in good.columns and all(r.prompt is None and r.completion is None for r in bad.collect())
    one = spark.createDataFrame([(1,), (None,), (-5,)], "x int").select(quarantine.tried(F.col("x"), (F.col("x") < 0, "negative")).alias("t")).collect()
    assert [(r.t.value, r.t.reason) for r in one] == [(1, None), (None, "null"), (None, "negative")]


def test_ordered_digest(spark):
    rows = [(k // 3, k, f"line {k}" if k % 7 else None) for k in range(230)]
    df = spark.createDataFrame(rows, "a long, b long, text string")
    one = content.ordered_hash(df.repartition(1), ["a", "b"], "text", width=8, parts=1).first()
    assert one.n == 230
    for parts in (3, 9):
        assert content.ordered_hash(df.repartition(parts, "b"), ["a", "b"], "text", width=8, parts=parts).first() == one
    swapped = spark.createDataFrame([(a, {4: 5, 5: 4}.get(b, b), t) for a, b, t in rows], "a long, b long, text string")
    assert content.ordered_hash(swapped, ["a", "b"], "text", width=8).first().content_hash != one.content_hash
    tied = df.withColumn("a", F.lit(1)).withColumn("b", F.lit(None).cast("long"))
    assert content.ordered_hash(tied, ["a", "b"], "text").first() == content.ordered_hash(tied.repartition(5), ["a", "b"], "text", parts=2).first()
    assert content.ordered_hash(df.limit(0), ["a"], "text").first().n == 0


def test_versions_are_whole(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    assert versions.current_version(spark, root) == 0 and versions.publish_version(old, root) == 1
    # the next version is made from the one that it replaces
    assert versions.change_version(spark, root, lambda t: t.union(spark.createDataFrame([("b", 2)], t.schema))) == 2
    assert sorted(tuple(r) for r in versions.read_version(spark, root).collect()) == [("a", 1), ("b", 2)]
    assert [tuple(r) for r in versions.read_version(spark, root, 1).collect()] == [("a", 1)]


def test_ledgers_and_manifests(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    table = lambda rows: spark.createDataFrame(rows, "skill_id string, locale string, sha256 string")
    assert sinks.change_ledger(spark, root, table([("a", "en", "1"), ("a", "it", "2"), ("b", "en", "3")])) == 1
    assert sinks.change_ledger(spark, root, table([("a", "en", "9"), ("c", "en", "4")])) == 2
    back = text_files.ledger_of(versions.read_version(spark, root, form="text"))
    assert sorted(tuple(r) for r in back.collect()) == [("a", "en", "9"), ("a", "it", "2"), ("b", "en", "3"), ("c", "en", "4")]
    assert sinks.write_ledger(back.where("skill_id <> 'c'"), root) == 3
    with pytest.raises(versions.PublishConflict):
        sinks.write_ledger(back, root, 2)
    files = spark.createDataFrame([("m", "f", "u", "s", 1)], "tag string, name string, url string, sha256 string, size_bytes long")
    made = publish.manifest(files, "tag", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    assert sinks.write_manifests(made, f"{tmp_path}/manifests") == 1
    line = versions.read_version(spark, f"{tmp_path}/manifests", form="text").select(F.lit("m").alias("tag"), "value")
    assert publish.existing_manifest(line).first().files[0].sha256 == "s"


def test_two_writers(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    df = spark.createDataFrame([(1,)], "v int")
    versions.publish_version(df, root)
    versions.publish_version(df.union(df), root, 1)
    with pytest.raises(versions.PublishConflict):
        versions.publish_version(df, root, 1)
    assert versions.read_version(spark, root).count() == 2
    # the other writer comes between the look and the pointer, twice
    tries = []

    def change(old):
        tries.append(old.count())
        if len(tries) < 3:
            versions.publish_version(old.union(df), root)
        return old.union(df).union(df)

    assert versions.change_version(spark, root, change) == 5 and tries == [2, 3, 4]
    assert versions.read_version(spark, root).count() == 6
    assert len([x for x in os.listdir(root) if x.startswith("data-")]) == 5


def test_failure_in_between(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    df = spark.createDataFrame([(1,), (0,)], "v int")
    versions.publish_version(df, root)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|division"):
        versions.publish_version(df.select((1 / F.col("v")).alias("v"), F.when(F.col("v") == 0, F.raise_error(F.lit("division"))).alias("x")), root)
    assert versions.current_version(spark, root) == 1 and versions.read_version(spark, root).count() == 2


def wav(path, samples, rate=16_000, channels=1, bits=16, extra=b""):
    body = np.asarray(samples, "<i2").tobytes()
    form = struct.pack("<HHIIHH", 1, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    chunks = b"fmt " + struct.pack("<I", 16) + form + (b"LIST" + struct.pack("<I", len(extra)) + extra + b"\0" * (len(extra) % 2) if extra else b"") + b"data" + struct.pack("<I", len(body)) + body
    with open(path, "wb") as f:
        f.write(b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks)


def test_long_clips_are_ranges(spark, tmp_path):
    long = (np.arange(50_001) * 7 % 65_536 - 32_768).astype(np.int16)
    wav(f"{tmp_path}/long.wav", long, extra=b"abc")
    wav(f"{tmp_path}/short.wav", [1, -2, 3])
    wav(f"{tmp_path}/none.wav", [])
    clips = wav_stream.long_clips(spark, f"{tmp_path}/*.wav", part=8_000, row=1_000)
    assert clips.rdd.getNumPartitions() == 8
    rows = sorted((r.clip, r.position, r.samples) for r in clips.collect())
    assert [r[:2] for r in rows] == [("long", 1_000 * k) for k in range(51)] + [("short", 0)]
    assert np.allclose(np.concatenate([r[2] for r in rows[:-1]]), long / 32768) and rows[-1][2] == [1 / 32768, -2 / 32768, 3 / 32768]
    with open(f"{tmp_path}/cut.wav", "wb") as f:
        f.write(b"RIFF\0\0\0\0WAVE")
    wav(f"{tmp_path}/other.wav", [1, 2], rate=8_000)
    for name in ("cut", "other"):
        with pytest.raises(Exception, match="no samples|not 16 kHz"):
            wav_stream.long_clips(spark, f"{tmp_path}/{name}.wav").collect()


FRAME = "skill_id string, frame_ord int, target int, cap int, text string, args map<string,string>"


def banks(spark, **change):
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    parts = {
        "own": table([("music", True, 0), ("old.time", False, 1)], "id string, router_eligible boolean, ord int"),
        "other": table([("x.timer", None, 2), ("y.timer", True, 3), ("music", False, 4)], "id string, router_eligible boolean, ord int"),
        "examples": table([("music", 0, "Play, it!", {"a": "1"}), ("music", 1, "play it", None), ("x.timer", 0, "wake me", None), ("old.time", 0, "what time", None), ("y.timer", 0, "", None)], "skill_id string, ord int, text string, args map<string,string>"),
        "frames": table([("music", 0, 3, 5, "play {SONG}", {"s": "{SONG}"}), ("x.timer", 0, 4, 9, "wait {N} minutes", {}), ("y.timer", 0, 5, 5, "stop", {})], FRAME),
        "slots": table([("SONG", s, s.upper()) for s in ("it", "one", "two", "three", "four")], "slot string, surface string, canonical string"),
        "ranges": table([("N", 1, 10**12)], "slot string, min long, max long"),
        "negatives": table([(k, f"Fact {k % 30}") for k in range(40)], "ord int, text string"),
        "negative_frames": table([("-", 0, 2, 4, "who sang {SONG}", {})], FRAME),
        "heldout": table([("play two",), ("fact 3",), ("who sang one",)], "key string"),
        "rules": None,
    }
    return build.Banks(**(parts | change))


def test_whole_build(spark, tmp_path):
    state = build.build(banks(spark), build.Plan(seed=3, ratio=0.5))
    observed.write_guarded(state.rows, f"{tmp_path}/d", state.guards, ("metadata",))
    rows = spark.read.parquet(f"{tmp_path}/d").collect()
    named = {}
    for r in rows:
        named.setdefault(r.name, []).append(r.text)
    assert set(named) == {"music", "x.timer", "y.timer", None}
    # positives aren't made distinct after normalising; expansions avoid the skill's own keys and what is held out
    assert named["music"].count("play it") == 2 and len(named["music"]) == 5 and "play two" not in named["music"] and "what time" not in sum(named.values(), [])
    assert len(named["x.timer"]) == 5 and named["y.timer"] == ["stop"]
    assert sorted(named[None]) == sorted({f"fact {k}" for k in range(30) if k != 3} | {t for t in named[None] if t.startswith("who")})
    assert sum(t.startswith("who") for t in named[None]) == 2 and "who sang one" not in named[None]
    assert sum(r.metadata == "train" for r in rows) == int(len(rows) * 0.9)


def test_a_clean_expansion_may_still_be_fatal(spark, tmp_path):
    plan = build.Plan(seed=3, normal=lambda t: loose_key(F.replace(t, F.lit("minutes"), F.lit("min"))))
    frames = spark.createDataFrame([("music", 0, 5, 5, "play it for minutes", {}), ("x.timer", 0, 1, 1, "a", {}), ("y.timer", 0, 1, 1, "b", {})], FRAME)
    held = spark.createDataFrame([("play it for min",)], "key string")
    state = build.build(banks(spark, frames=frames, heldout=held), plan)
    with pytest.raises(observed.GuardError, match="held-out positives: 1 rows, such as 'play it for min'"):
        observed.write_guarded(state.rows, f"{tmp_path}/d", state.guards)
    assert not os.path.exists(f"{tmp_path}/d")


def test_guards_are_told_together(spark, tmp_path):
    rules = spark.createDataFrame([(1, "all", ["wake"], None), (2, "anywhere", None, "wait")], "rule_id long, kind string, words array<string>, part string")
    examples = spark.createDataFrame([("music", 0, "one\ntwo", None), ("x.timer", 0, "wake me", None), ("y.timer", 1, "go", None)], "skill_id string, ord int, text string, args map<string,string>")
    state = build.build(banks(spark, rules=rules, examples=examples), build.Plan(seed=3))
    with pytest.raises(observed.GuardError) as e:
        observed.write_guarded(state.rows, f"{tmp_path}/d", state.guards)
    assert set(e.value.failures) == {"no examples are left", "an example has a line end"} and "x.timer" in e.value.failures["no examples are left"]


def test_stages_say_what_they_need(spark):
    with pytest.raises(build.BuildError, match="guard needs normal first"):
        build.build(banks(spark), build.Plan(seed=1), (build.merge, build.guard))
    with pytest.raises(build.expand.BankError, match="undefined"):
        build.build(banks(spark, ranges=None), build.Plan(seed=1))
    none = banks(spark)
    with pytest.raises(build.expand.BankError, match="without frames"):
        build.build(build.Banks(**{**vars(none), "frames": none.frames.where("skill_id <> 'music'")}), build.Plan(seed=1))


def test_positives_keep_columns(spark):
    skills = spark.createDataFrame([("a.b", "b")], "id string, alias string")
    examples = spark.createDataFrame([("a.b", "t", {"k": "v"}, 4)], "skill_id string, text string, args map<string,string>, ord int")
    assert assemble.positives(examples, skills, ("ord",)).first().asDict() == {"text": "t", "name": "b", "args": {"k": "v"}, "ord": 4}


def test_live_windows_call_the_state_once_each_way():
    """A key's batch is one read and one write of its state, and a timer that runs is left alone; samples that came since put the flush off."""
    from pyspark.sql import Row

    from sparkcurate.streaming.live import SampleWindows

    class Handle:
        calls, held, timers = [], None, []

        def getValueState(self, name, schema):
            return self

        def get(self):
            self.calls.append("get")
            return self.held

        def update(self, value):
            self.calls.append("update")
            self.held = value

        def registerTimer(self, at):
            self.calls.append("timer")
            self.timers.append(at)

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    h, w = Handle(), SampleWindows(4, 2, 1_000)
    w.init(h)
    give = lambda *rows: [tuple(r) for r in w.handleInputRows(("u",), iter([Row(pos=p, value=v, ms=t) for p, v, t in rows]), At(0))]
    assert give((5, 6.0, 10), (1, 2.0, 20), (0, 1.0, 5)) == [] and h.calls == ["get", "timer", "update"]
    h.calls.clear()
    assert give((3, 4.0, 900), (2, 3.0, 30), (1, 9.0, 7)) == [("u", 0, 4, 10.0)] and h.calls == ["get", "update"]
    assert list(w.handleExpiredTimer(("u",), At(1_500), None)) == [] and h.timers == [1_020, 1_900]
    assert [tuple(r) for r in w.handleExpiredTimer(("u",), At(1_900), None)] == [("u", 1, 3, 6.0)]
    assert give((6, 7.0, 5_000), (7, 1.0, 5_000), (8, 1.0, 5_000), (9, 1.0, 5_000)) == [("u", 2, 4, 10.0)] and h.timers[-1] == 6_000
