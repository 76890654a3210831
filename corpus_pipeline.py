"""A corpus pipeline: STAGES over documents, each written as Parquet and read again as the next one's input.

1. quality: documents that the line field rejects go; it is fitted on the documents' labels.
2. exact: of equal texts, the row with the smallest doc_id stays.
3. near: of each group of near copies, the row with the smallest doc_id stays.
4. mix: all rows, in the order that mixes the sources to their target weights.
5. encode: token ids of every text, with the proof that they decode to it.

The columns are those of documents until the last stage. Nulls: null texts count as empty and null
sources as ''; rows with null ids are kept or dropped by their texts as any other. An empty table
goes through all stages and stays empty. Further columns of the input, of any name, are kept; in the last
stage one that has the name of a new column gets _1 put to its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkcurate.llm import exact_dedup, mixing, ngram_join, quality_crf, sentencepiece_backend
from sparkcurate.llm.shared import load, new_folder, remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = quality_crf.fit_quality(docs, load(spark, sf_dir, "labels"))
    return quality_crf.keep_good(docs, field)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    keep = tuple(c for c in docs.columns if c != "text")
    return sentencepiece_backend.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=keep, ids=True)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

#: A trained model decides in the first stage, so that no SQL gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's table goes when the next one is written."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
