"""Exact deduplication with stateful streaming: keyed state on disk, without expiry."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import forget, hot_rows, join_groups, new_folder, placed, remove, salts, written

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    """Each run of the characters U+0020 and U+0009 to U+000D becomes one space; null counts as empty."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_replace(flat, " {2,}", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 256, bytes_per_trigger: int = 16 << 30) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Null text equals the empty text. A null id ranks after all others. Of rows that repeat both id and
    text just one is kept (the first by place). An empty table gives no rows. Other columns, of any
    name, are ignored. digest_bits below 256 makes collisions, for tests.
    """
    return _dedup(placed(docs.select(id_col, text_col), "located"), id_col, text_col, digest_bits, bytes_per_trigger).drop("file", "at")


def _dedup(rows: DataFrame, id_col: str, text_col: str, digest_bits: int = 256, bytes_per_trigger: int = 16 << 30) -> DataFrame:
    """exact_dedup() of placed() rows, with each row's place (file, at).

    A stream reads (digest, id, place) and keeps, per digest, the smallest id with its place, the content
    locator, and the number of rows, in RocksDB state without a watermark, so nothing expires and memory
    stays bounded. Every row of a digest seen more than once, a hit, then has its full text compared with
    that at the locator; digests that different texts share are split by text.
    """
    spark = rows.sparkSession
    base = rows.select(F.col("row")[id_col].alias("id"), normalised(F.col("row")[text_col]).alias("norm"), "file", "at")
    digest = F.sha2("norm", 256)
    # never null, so that no join tests for that and makes the digest twice
    key = F.coalesce(F.unhex(digest if digest_bits == 256 else F.substring(digest, 1, digest_bits // 4)), F.lit(b""))
    keyed = written(base.select("id", "file", "at", digest.alias("sha"), key.alias("key")), "keyed")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "at"))
    state = seen(keyed, first, bytes_per_trigger)

    hits = written(state.where("n > 1"), "hits")
    if hasattr(state, "_written_at"):
        forget(state)
    n_hits = hits.count()
    hot = hot_rows(keyed.count())
    out = join_groups(keyed, hits, n_hits, hot)
    mixed = None
    if n_hits:
        texts = join_groups(base.withColumn("key", key), hits, n_hits, hot, "inner")
        mixed = written(_different(texts, hot), "mixed")
        if not mixed.take(1):
            forget(mixed)
            mixed = None
    own = F.struct(F.col("id").isNull().alias("none"), "id", "file", "at")
    out = out.withColumn("first", F.coalesce("first", own)).withColumn("n", F.coalesce("n", F.lit(1)))
    if mixed is not None:
        again = base.withColumn("key", key).join(mixed, "key", "left_semi")
        split = written(again.groupBy("key", "norm").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "split")
        whole = again.join(split, ["key", "norm"]).select("key", "id", "file", "at", F.sha2("norm", 256).alias("sha"), "first", "n")
        out = out.join(mixed, "key", "left_anti").select(whole.columns).unionByName(whole)
    return out.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        ((F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "file",
        "at",
    )


def seen(keyed: DataFrame, first: Column, bytes_per_trigger: int) -> DataFrame:
    """(key, first, n): the state after the whole of keyed, a table of written(), went through the stream."""
    spark = keyed.sparkSession
    state = keyed.groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    if not keyed.take(1):  # a stream of nothing writes no state
        return state
    path = new_folder(spark, "state")
    with settings(spark, ROCKSDB):
        stream = spark.readStream.schema(keyed.schema).option("maxBytesPerTrigger", bytes_per_trigger).parquet(keyed._written_at)
        agg = stream.groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
        query = agg.writeStream.format("noop").outputMode("update").option("checkpointLocation", path).trigger(availableNow=True).start()
        query.awaitTermination()
        kept = spark.read.format("statestore").load(path)
        buffers = kept.schema["value"].dataType.fieldNames()
        kept = kept.select(F.col("key.key").alias("key"), F.col("value")[buffers[0]].alias("first"), F.col("value")[buffers[1]].alias("n"))
        table = written(kept.where("n > 1"), "seen")  # the others' rows tell all that the state has of them
    remove(spark, path)
    return table


def _different(hits: DataFrame, hot: int) -> DataFrame:
    """(key) of digests with a text that isn't the one at the digest's locator. Each task compares at most hot rows of a digest with it.

    The text at the locator goes to each part of its digest's rows, where it comes first.
    """
    here = (F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at"))
    part = F.pmod(F.xxhash64("file", "at"), salts(hot)).cast("int")
    hits = hits.select("key", "norm", here.alias("here"), F.explode(F.when(here, F.sequence(F.lit(0), salts(hot) - 1)).otherwise(F.array(part))).alias("part"))
    located = F.first("norm").over(Window.partitionBy("key", "part").orderBy(F.desc("here")))
    return hits.withColumn("located", located).where("norm <> located").select("key").distinct()


def drop_repeats(docs: DataFrame, limit: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns, whatever their names.

    Dropped rows' places are broadcast while they are at most limit, else joined by a shuffle.
    """
    rows = placed(docs, "located")
    gone = written(_dedup(rows, id_col, text_col).where("NOT kept").select("file", "at"), "gone")
    gone = F.broadcast(gone) if gone.count() <= limit else gone
    return rows.join(gone, ["file", "at"], "left_anti").select("row.*")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs)


OP8_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
