"""Tables that are published whole or not at all: each version in a folder of its own, and a pointer that only one writer can make."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Pointers are files of these names, with the version's folder as their content.
POINTER = "current-"


class PublishConflict(RuntimeError):
    """Another writer has published since the version that this one began from."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, hadoop


def current_version(spark: SparkSession, root: str) -> int:
    """The number of the last version that was published, 0 where there is none."""
    fs, base, _ = _fs(spark, root)
    if not fs.exists(base):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(base)]
    return max((int(n.removeprefix(POINTER)) for n in names if n.startswith(POINTER) and n.removeprefix(POINTER).isdigit()), default=0)


def _folder(spark: SparkSession, root: str, version: int) -> str:
    fs, base, hadoop = _fs(spark, root)
    stream = fs.open(hadoop.Path(base, f"{POINTER}{version}"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{root.rstrip('/')}/{text.strip()}"


def read_version(spark: SparkSession, root: str, version: int | None = None, form: str = "parquet") -> DataFrame:
    """A published version, the last one unless told; it stays as it is while others are published."""
    version = current_version(spark, root) if version is None else version
    if version == 0:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.format(form).load(_folder(spark, root, version))


def publish_version(df: DataFrame, root: str, began_from: int | None = None, form: str = "parquet", partition_by: tuple[str, ...] = ()) -> int:
    """Writes df as the version after began_from (the last one unless told) and points to it; its number.

    df may read the version before: that stays. Until the pointer stands, readers see nothing of it, so a
    failure at any place leaves the last version in force. The pointer is created, never
    overwritten: of two writers from one version the later gets PublishConflict, and its folder goes. That needs a file
    system that creates exclusively, such as HDFS; its rename doesn't have to be atomic.
    """
    spark = df.sparkSession
    fs, base, hadoop = _fs(spark, root)
    last = current_version(spark, root)
    began_from = last if began_from is None else began_from
    if last != began_from:
        raise PublishConflict(f"{root} is at version {last}, not {began_from}")
    name = f"data-{began_from + 1}-{uuid.uuid4().hex}"
    folder = hadoop.Path(base, name)
    writer = df.write.format(form)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(folder.toString())
    try:
        try:
            out = fs.create(hadoop.Path(base, f"{POINTER}{began_from + 1}"), False)
        except Exception as e:
            raise PublishConflict(f"version {began_from + 1} of {root} is there already") from e
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()
    except BaseException:
        fs.delete(folder, True)
        raise
    return began_from + 1


def change_version(spark: SparkSession, root: str, change, tries: int = 5, form: str = "parquet") -> int:
    """Publishes change(last version, or None) as the next one; where another writer was first, the change is made anew from that one's version, so many times at most."""
    for left in range(tries - 1, -1, -1):
        began = current_version(spark, root)
        old = read_version(spark, root, began, form) if began else None
        try:
            return publish_version(change(old), root, began, form)
        except PublishConflict:
            if not left:
                raise
    raise ValueError("no tries")
