import json
import wave

import numpy as np
import pytest

from sparkcurate.sources import audio, sinks, text_files
from sparkcurate.streaming import windows

BANK = {"s1": {"target": 3, "cap": 2, "frames": [{"text": "do {A}", "args": {"x": "{A}"}}, {"text": "plain"}]}}
SLOTS = {"A": [{"surface": "a1", "canonical": "A1"}, {"surface": "a2", "canonical": "A2"}], "N": {"type": "int", "min": 3, "max": 5}}


def put(folder, name, value):
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_banks(spark, tmp_path):
    put(tmp_path, "frames.auto.en.json", BANK)
    put(tmp_path, "draft-frames.x.en.json", BANK)
    put(tmp_path, "slots.auto.en.json", SLOTS)
    f = text_files.frames(spark, str(tmp_path), "en").orderBy("frame_ord").collect()
    assert [(r.skill_id, r.target, r.cap, r.text, r.args) for r in f] == [("s1", 3, 2, "do {A}", {"x": "{A}"}), ("s1", 3, 2, "plain", {})]
    s = text_files.slots(spark, str(tmp_path), "en").orderBy("slot", "val_ord").collect()
    assert [(r.slot, r.surface, r.canonical) for r in s] == [("A", "a1", "A1"), ("A", "a2", "A2"), ("N", "3", "3"), ("N", "4", "4"), ("N", "5", "5")]
    put(tmp_path, "frames.more.en.json", BANK)
    with pytest.raises(text_files.SourceError, match="s1"):
        text_files.frames(spark, str(tmp_path), "en")


def test_cases(spark, tmp_path):
    put(tmp_path, "e.jsonl", '// note\n\n{"utterance": "Hi!", "expect": "a"}\n{"utterance": "hi", "expect": "none"}\n')
    cases = text_files.eval_cases(spark, [f"{tmp_path}/e.jsonl", f"{tmp_path}/missing.jsonl"])
    assert cases.count() == 2 and [r.key for r in text_files.eval_keys(cases).collect()] == ["hi"]
    assert text_files.none_cases(cases).count() == 1
    assert text_files.eval_cases(spark, [f"{tmp_path}/missing.jsonl"]).count() == 0


def test_verdicts(spark, tmp_path):
    put(tmp_path, "log", "noise\nVERBOSE\tc\t-0.05\ta\ta\tsay\tit\nVERBOSE\tc\tNaN\tNONE\tNONE\tx\nVERBOSE\tc\t0.5\ta\tnone\ty\nthreshold:  MIN_ROUTER_CONFIDENCE = -0.01\nthreshold:  MIN_ROUTER_CONFIDENCE = -0.06\n")
    cases, threshold = text_files.verdicts(spark, f"{tmp_path}/log")
    rows = cases.orderBy("utterance").collect()
    assert threshold == -0.06 and rows[0].utterance == "say\tit" and (rows[1].conf, rows[1].pick) == (None, None)
    assert (rows[2].conf, rows[2].pick) == (0.5, "none")
    put(tmp_path, "bad", "VERBOSE\tc\t1\ta\n")
    with pytest.raises(text_files.SourceError):
        text_files.verdicts(spark, f"{tmp_path}/bad")


def test_front_matter(spark, tmp_path):
    def manifest(lang):
        return "---\n" + json.dumps({"description": "d", "metadata": {"skill": {"id": "x.y", "examples": [{"text": f"utterance-{lang}"}, {"text": " "}]}}}) + "\n---\nbody"

    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    put(tmp_path / "a", "SKILL.en.md", manifest("en"))
    put(tmp_path / "a", "SKILL.it.md", manifest("it"))
    put(tmp_path / "b", "SKILL.md", "no head")
    heads = text_files.front_matter(spark, str(tmp_path), parse=json.loads)
    first = lambda locale: text_files.skills_of(heads, locale).first()
    assert first("it").examples[0].text == "utterance-it" and first("de").examples[0].text == "utterance-en"
    assert [e.text for e in first("it").examples] == ["utterance-it", " "]
    put(tmp_path / "a", "SKILL.it.md", "---\n{broken\n---\n")
    assert first("it") is None and first("en") is not None


def test_yaml_front_matter(spark):
    pytest.importorskip("yaml")
    text = "---\ndescription: >\n  two\n  lines\nmetadata:\n  skill:\n    id: x.y\n    examples:\n    - text: go\n      args: {to: there}\n---\nbody\n---\n"
    files = spark.createDataFrame([("d", "SKILL.en.md", text), ("e", "SKILL.md", "none"), ("f", "SKILL.md", "---\n[1\n---\n")], "dir string, file_name string, value string")
    heads = text_files.heads_of(files)
    assert {r.dir: r["head"] is None for r in heads.collect()} == {"d": False, "e": True, "f": True}
    got = text_files.skills_of(heads, "it").collect()
    assert [(r.id, r.description, r.examples[0].args) for r in got] == [("x.y", "two lines\n", {"to": "there"})]


def test_audio_and_sidecars(spark, tmp_path):
    with wave.open(f"{tmp_path}/c.wav", "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(np.array([0, -32768, 16384], "<i2").tobytes())
    put(tmp_path, "c.txt", "device: x\ntranscript: hello: you\ntranscript: no\n")
    assert tuple(audio.clips(spark, f"{tmp_path}/*.wav").first()) == ("c", [0.0, -1.0, 0.5])
    assert tuple(text_files.sidecars(spark, str(tmp_path)).first()) == ("c", "hello: you")


def test_counters(spark):
    df = spark.createDataFrame([("1 (a b) c) S " + " ".join(map(str, range(1, 20))),)], "stat string")
    assert text_files.cpu_ticks(df).first().ticks == 11 + 12


def test_sinks(spark, tmp_path):
    cases = spark.createDataFrame([("u1", "b", 0), ("u2", "NONE", 0), ("u3", "a", 0)], "utterance string, expect string, ord long")
    sinks.write_eval(cases, ["one"], f"{tmp_path}/out")
    lines = [r.value for r in sinks.eval_lines(cases, ["one"]).collect()]
    assert lines == ["// one", '{"utterance":"u3","expect":"a"}', '{"utterance":"u1","expect":"b"}', '{"utterance":"u2","expect":"NONE"}']
    assert text_files.eval_cases(spark, [f"{tmp_path}/out"]).count() == 3


def test_drafts_stay_unseen(spark, tmp_path):
    drafts = spark.sql("SELECT 's1' AS skill_id, 3 AS target, 2 AS cap, 1 AS frame_ord, 'go {A}' AS text, map('x', '{A}') AS args UNION ALL SELECT 's1', 3, 2, 0, 'first', map()")
    sinks.write_drafts(drafts, "en", str(tmp_path))
    assert [p.name for p in tmp_path.glob("*.json")] == ["draft-frames.s1.en.json"]
    with pytest.raises(text_files.SourceError):
        text_files.frames(spark, str(tmp_path), "en").count()
    (tmp_path / "draft-frames.s1.en.json").rename(tmp_path / "frames.s1.en.json")
    assert [r.text for r in text_files.frames(spark, str(tmp_path), "en").orderBy("frame_ord").collect()] == ["first", "go {A}"]


def test_sample_lines(spark, tmp_path):
    df = spark.createDataFrame([("eval", "é", 0), ("train", "b", 1), ("train", "a", 0)], "metadata string, t string, ord long")
    sinks.write_sample_lines(df, ["ord"], f"{tmp_path}/out")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines() == ['{"metadata":"train","t":"a"}', '{"metadata":"train","t":"b"}', '{"metadata":"eval","t":"é"}']


def test_stream_windows(spark, tmp_path):
    rows = [("k", float(i), i == 6) for i in range(7)]
    spark.createDataFrame(rows, "key string, v double, last boolean").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("key string, v double, last boolean").parquet(f"{tmp_path}/in")
    q = windows.stream_count_windows(stream, "key", "v", 3, "last").writeStream.format("memory").queryName("w").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("w").collect()) == [("k", 0, 3, 3.0), ("k", 1, 3, 12.0), ("k", 2, 1, 6.0)]
