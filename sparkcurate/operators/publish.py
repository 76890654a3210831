"""Manifests of published files: content hashes, comparison with what was there, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import version_name


def file_meta(listing: DataFrame) -> DataFrame:
    """(name, sha256, size_bytes): the header's hash is trusted only where the header's size is there too, else the content's is taken."""
    both = F.col("etag").isNotNull() & F.col("linked_size").isNotNull()
    own = F.btrim("etag", F.lit('"'))
    return listing.select("name", F.when(both, own).otherwise(F.sha2("content", 256)).alias("sha256"), F.when(both, F.col("linked_size")).otherwise(F.octet_length("content")).cast("long").alias("size_bytes"))


def bundle_hash(files: DataFrame, group: str) -> DataFrame:
    """(group, bundle_sha): SHA-256 over 'name:sha,' of each file in order of name."""
    parts = F.array_sort(F.collect_list(F.struct("name", "sha256")))
    text = F.array_join(F.transform(parts, lambda f: F.concat(f["name"], F.lit(":"), f["sha256"], F.lit(","))), "")
    return files.groupBy(group).agg(F.sha2(text, 256).alias("bundle_sha"))


def same_sha(a: Column, b: Column) -> Column:
    return F.coalesce(F.lower(a) == F.lower(b), F.lit(False))


def manifest_diff(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """(group, added, removed, changed, unchanged, publish): files by name and hash in any case; nothing is published where all are the same and there were some before."""
    both = old.select(group, "name", F.col("sha256").alias("was")).join(new.select(group, "name", F.col("sha256").alias("now")), [group, "name"], "full")
    same = same_sha(F.col("was"), F.col("now"))
    agg = both.groupBy(group).agg(
        F.count_if(F.col("was").isNull()).alias("added"),
        F.count_if(F.col("now").isNull()).alias("removed"),
        F.count_if(F.col("was").isNotNull() & F.col("now").isNotNull() & ~same).alias("changed"),
        F.count_if(same).alias("unchanged"),
    )
    return agg.withColumn("publish", (F.col("added") + F.col("removed") + F.col("changed") > 0) | (F.col("unchanged") == 0))


def publish_single(new: DataFrame, old: DataFrame, tag: str) -> DataFrame:
    """Rows of new (tag, sha256, ...) whose hash differs from the one published under the tag, in any case."""
    both = new.join(old.select(tag, F.col("sha256").alias("__was")), tag, "left")
    return both.where(~same_sha(F.col("__was"), F.col("sha256"))).drop("__was")


def manifest(files: DataFrame, group: str, released: Column, min_confidence: Column | None = None) -> DataFrame:
    """(group, version, released_at, min_confidence, files): one manifest of each bundle."""
    from ..functions.text import iso_utc

    listed = files.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("name", "url", "sha256", "size_bytes"))).alias("files"))
    both = listed.join(bundle_hash(files, group), group)
    confidence = F.lit(None).cast("double") if min_confidence is None else min_confidence.cast("double")
    return both.select(group, version_name(released, F.col("bundle_sha")).alias("version"), iso_utc(released).alias("released_at"), confidence.alias("min_confidence"), "files")


def content_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    """(n, content_hash): rows and the order-free union of their hashes, so that nothing is gathered."""
    row = F.xxhash64(*columns)
    return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("content_hash"))


def multiset_hash(df: DataFrame, text: str, digits: int = 16) -> DataFrame:
    """(n, content_hash): rows and the first digits of a SHA-256 that doesn't depend on their order; every row counts, also where it repeats.

    Each row's SHA-256 is cut into four numbers of 60 bits, and these are added up over all rows: sums
    combine before the shuffle, so that nothing is gathered. A null text counts as empty.
    """
    h = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    parts = [F.sum(F.conv(F.substring(h, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")) for k in range(4)]
    agg = df.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(p, F.lit(0).cast("decimal(30,0)")).cast("string").alias(f"p{k}") for k, p in enumerate(parts)))
    whole = F.concat_ws(":", F.col("n").cast("string"), *(f"p{k}" for k in range(4)))
    return agg.select("n", F.left(F.sha2(whole, 256), F.lit(digits)).alias("content_hash"))


MANIFEST_FILE = "struct<version:string,released_at:string,min_confidence:double,files:array<struct<name:string,url:string,sha256:string,size_bytes:bigint>>>"


def existing_manifest(listing: DataFrame, tag: str = "tag", value: str = "value") -> DataFrame:
    """(tag, version, released_at, min_confidence, files) of published manifests, given as JSON texts; absent, corrupt or empty ones give no row, so that a clean one is published."""
    read = listing.select(tag, F.when(F.expr(f"try_parse_json({value})").isNotNull(), F.from_json(value, MANIFEST_FILE)).alias("m"))
    return read.where("m.files IS NOT NULL OR m.version IS NOT NULL").select(tag, "m.*")


def released_files(manifests: DataFrame, tag: str = "tag") -> DataFrame:
    """(tag, name, sha256) of manifests' files, as manifest_diff takes them."""
    return manifests.select(tag, F.explode("files").alias("f")).select(tag, "f.name", "f.sha256")
