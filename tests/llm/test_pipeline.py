"""The stages against brute force on a small table, and the entry module."""

import re
import time

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from sparkcurate.llm import lexical_search, mixing, queries, shared
from sparkcurate.llm.shared import load

from .test_media_and_mix import on_the_line

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = load(spark, SF, "documents")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
    return out


def test_quality_keeps_the_good(spark, stages):
    kept = {r.doc_id for r in stages["quality"]}
    labels = {r.doc_id: r.quality for r in load(spark, SF, "labels").collect()}
    good = [i in kept for i, q in labels.items() if q == 1]
    bad = [i in kept for i, q in labels.items() if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_exact_is_brute_force(stages):
    first = {}
    for r in sorted(stages["quality"]):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r)
    assert sorted(stages["exact"]) == sorted(first.values())


def test_near_is_brute_force(stages):
    rows = sorted(stages["exact"])

    def shingles(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)}

    sets = [shingles(r.text) for r in rows]
    name = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                old, new = name[a], name[b]
                name = [min(old, new) if n in (old, new) else n for n in name]
    assert sorted(r.doc_id for r in stages["near"]) == [r.doc_id for k, r in enumerate(rows) if name[k] == k]


def test_mix_keeps_to_its_weights(stages):
    rows = stages["mix"]
    assert sorted(rows) == sorted(stages["near"])
    counts = {}
    for r in rows:
        counts[r.source] = counts.get(r.source, 0) + 1
    half = mixing.BLOCK_ROWS // 2
    units, parts = {x: -(-n // half) for x, n in counts.items()}, mixing.exact_parts(counts, None)
    rows_of, done, slot, now = dict.fromkeys(counts, 0), dict.fromkeys(counts, 0), 0, None
    for r in rows:
        unit = (r.source, rows_of[r.source] // half)
        rows_of[r.source] += 1
        if unit != now:  # a slot begins, and the one before is over
            if now:
                done[now[0]] += 1
            line = on_the_line(units, parts, slot)
            assert all(abs(done[x] - line[x]) < 2 for x in counts)  # less than two halves
            slot, now = slot + 1, unit
    assert rows_of == counts and slot == sum(units.values())


def test_encode_is_lossless(stages):
    import public_tokenizers
    import sentencepiece

    reference = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in stages["mix"]}
    assert sorted(texts) == sorted(r.doc_id for r in stages["encode"])
    for r in stages["encode"]:
        assert r.decoded_ok and r.parity and r.token_ids == reference.encode(texts[r.doc_id])


def test_names():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries()) and "pipeline" in __spark_entry__.queries()


CLASHING = ["score", "predicted", "n_tokens", "parity", "token_ids", "__file", "__row", "__text", "__id", "_metadata", "file", "at", "row", "key", "label", "u", "slot", "block", "n"]


def clashing(spark, folder, empty=False):
    docs = load(spark, SF, "documents").limit(0 if empty else 60)
    for k, c in enumerate(CLASHING):
        docs = docs.withColumn(c, F.lit(f"own {k}"))
    docs.write.parquet(f"{folder}/documents.parquet")
    load(spark, SF, "labels").withColumn("order", F.lit(1)).withColumn("text", F.lit("x")).write.parquet(f"{folder}/labels.parquet")
    load(spark, SF, "pages").withColumn("digest", F.lit(1)).withColumn("_metadata", F.lit("m")).withColumn("key", F.lit("k")).write.parquet(f"{folder}/pages.parquet")
    vectors = load(spark, SF, "embeddings").limit(0 if empty else 500)
    for c in ("x", "v", "id", "ids", "leaves", "tree", "component", "rank", "query_id", "n", "score"):
        vectors = vectors.withColumn(c, F.lit("own"))
    vectors.write.parquet(f"{folder}/embeddings.parquet")
    load(spark, SF, "benchmark").withColumn("id", F.lit("own")).withColumn("terms", F.lit("own")).withColumn("h", F.lit("own")).write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    docs = clashing(spark, tmp_path)
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "encode":
            assert docs.columns == columns
            assert docs.select(*(F.col(f"`{c}`") for c in CLASHING)).distinct().count() == 1
    assert 0 < docs.count() < n
    assert {"n_tokens", "n_tokens_1", "parity_1", "token_ids_1", "score", "_metadata"} <= set(docs.columns) and dict(docs.dtypes)["n_tokens"] == "bigint"
    assert docs.first()["n_tokens_1"] == f"own {CLASHING.index('n_tokens')}"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_operators_ignore_columns_of_any_name(spark, tmp_path, name):
    clashing(spark, tmp_path)
    table = lambda t: load(spark, str(tmp_path), t)
    expected = {
        "op1_warc": lambda: table("pages").count(),
        "op11_whitening": lambda: 16 * table("embeddings").count(),
        "op12_forest_search": lambda: 5 * table("embeddings").where("vec_id % 50 = 0").count(),
        "op13_lexical_search": lambda: lexical_search.search(lexical_search.build_index(table("documents").select("doc_id", "text")), table("benchmark").select("item_id", "text")).count(),
    }
    n = expected.get(name, lambda: table("documents").count())()
    assert n > 0 and queries.queries()[name](spark, str(tmp_path)).count() == n


def test_an_empty_table_goes_through(spark, tmp_path):
    clashing(spark, tmp_path, empty=True)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for name, query in queries.queries().items():
        if name != "op1_warc":
            assert query(spark, str(tmp_path)).collect() == []


def test_shared_folder_must_be_named(monkeypatch):
    from sparkcurate.llm import shared

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_root(Session())


def test_a_task_that_keeps_nothing_gives_memory_back(monkeypatch):
    """Also where no other operator's cache is let go: what the worker's last task has freed goes back first."""
    from sparkcurate.llm import shared

    trims = []
    monkeypatch.setattr(shared.ctypes, "CDLL", lambda name: type("C", (), {"malloc_trim": staticmethod(trims.append)}))
    monkeypatch.setattr(shared, "_kept", {})
    shared.kept("ngrams", None)
    assert trims == [0]
    assert shared.kept("codec", "a", lambda: 1) == 1 and shared.kept("codec", "a", lambda: 2) == 1 and trims == [0]
    shared.kept("ngrams", None)
    assert trims == [0, 0] and shared._kept == {}


def test_idle_workers_let_go_what_they_keep(monkeypatch):
    """After an operator's last task its cache goes; tasks that follow one another share it."""
    monkeypatch.setattr(shared, "_kept", {})
    monkeypatch.setattr(shared, "IDLE", 0.2)
    made = []

    def run(batches):
        for x in batches:
            yield shared.kept("test", "cache", lambda: made.append(1) or [x])[0] + x

    task = shared.lean(run)
    assert list(task(iter([1, 2]))) == [2, 3] and list(task(iter([5]))) == [6] and len(made) == 1
    slow = task(iter([7, 8]))
    assert next(slow) == 8
    time.sleep(0.4)  # a task that runs for longer keeps it
    assert shared._kept and next(slow) == 9 and len(made) == 1
    slow.close()
    time.sleep(0.6)
    assert not shared._kept
    assert list(task(iter([3]))) == [6] and len(made) == 2
