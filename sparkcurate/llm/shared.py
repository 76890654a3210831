"""Places that the driver and all executors see, and tables written there to cut lineage."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import json
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset it is an error, but in one process on one machine, where a temporary folder does."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        root = "file://" + tempfile.mkdtemp(prefix="sparkcurate-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", full).rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path for one run of an operator; unique, so that a repeated run never reads another's files."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: lineage ends there and survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    made = _made.get()
    if made is not None:
        made.append(table)
    return table


#: The tables of the innermost scratch() of this thread, so that operators that run side by side leave each other's alone.
_made: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def scratch():
    """A list that gets all tables of written() made within, for what isn't needed any more to be forgotten.

    Just a result that has been written down itself may outlive them; frames are read later.
    """
    made: list[DataFrame] = []
    outer = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(outer)


def forget(*tables: DataFrame) -> None:
    """Removes tables of written() that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t._written_at)


def fresh(name: str, taken: list[str]) -> str:
    """name, or the first of name_1, name_2, ... that isn't taken, in any case of letters."""
    have = {c.lower() for c in taken}
    out, k = name, 0
    while out.lower() in have:
        k += 1
        out = f"{name}_{k}"
    return out


def _plain_scan(df: DataFrame) -> bool:
    """Whether each row of df is one row of a file, and always the same one: a scan with projections and filters."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation"


def scanned(docs: DataFrame, parts: list[str], *columns: Column) -> DataFrame | None:
    """(row, columns, parts): each row of docs as one struct, so that no name in it can clash, and what its file's metadata say of it; None if docs isn't a plain scan."""
    try:
        if not _plain_scan(docs):
            return None
        place = docs.metadataColumn("_metadata")
        return docs.select(F.struct("*").alias("row"), *columns, *(place[p].alias(p) for p in parts))
    except AnalysisException:  # the files' format doesn't tell
        return None


def placed(docs: DataFrame, label: str, *columns: Column) -> DataFrame:
    """(row, columns, file, at): each row of docs as one struct, and its place. A frame that isn't a plain scan is written down first, once."""
    found = scanned(docs, ["file_path", "row_index"], *columns)
    if found is None:
        table = written(docs.select(F.struct("*").alias("row"), *columns), label)
        place = table.metadataColumn("_metadata")
        found = table.select("*", *(place[p].alias(p) for p in ("file_path", "row_index")))
    return found.withColumnsRenamed({"file_path": "file", "row_index": "at"})


def literal(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    """A small table from the driver, as a literal in the plan."""
    fields = [x.split() for x in schema.split(", ")]
    text = json.dumps([dict(zip((f[0] for f in fields), v, strict=True)) for v in values])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{','.join(':'.join(f) for f in fields)}>>")))


#: Up to so many groups of equal rows go to all tasks with what is known of them, some 200 bytes each.
BROADCAST_GROUPS = 100_000
#: Rows of a group that one task joins or compares; more where a table has over BROADCAST_GROUPS times so many rows.
HOT_ROWS = 250


def hot_rows(rows: int) -> int:
    """Groups of more rows than this are hot, in a table of so many rows; there are at most BROADCAST_GROUPS of them."""
    return max(HOT_ROWS, -(-rows // max(1, BROADCAST_GROUPS)))


def salts(hot: int) -> Column:
    """Over how many tasks a group's n rows are spread."""
    return F.ceil(F.col("n") / hot).cast("int")


def join_groups(rows: DataFrame, groups: DataFrame, n_groups: int, hot: int, how: str = "left", by: tuple[str, ...] = ("file", "at"), most: int | None = None) -> DataFrame:
    """rows (key, ...) with what groups (key, n, ...) has of their key; n is the number of the key's rows.

    More than most groups, BROADCAST_GROUPS unless given, are joined by a shuffle, in which the rows of hot
    ones are spread by salts, which follow from the columns in by.
    """
    if n_groups <= (BROADCAST_GROUPS if most is None else most):
        return rows.join(F.broadcast(groups), "key", how)
    large = F.broadcast(groups.where(F.col("n") > hot).select("key", salts(hot).alias("__salts")))
    spread = rows.join(large, "key", "left").withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("__salts")).cast("int"), F.lit(0))).drop("__salts")
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts(hot) - 1)))
    return spread.join(salted, ["key", "__salt"], how).drop("__salt")


def filesystem(uri: str):
    """pyarrow's file system and the path in it, for Python code on executors that needs ranges of a file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def remove(spark: SparkSession, uri: str) -> None:
    """Deletes a folder through Hadoop's file system API."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Bytes that go to Python at a time, about; texts are long, and both sides hold a whole batch.
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches to BATCH_BYTES. Frames run later, so the setting stays."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


_kept: dict = {}
_lock = threading.RLock()
#: Seconds that a worker may be without a task before it lets go what it keeps.
IDLE = 2.0
_waits: list[threading.Timer] = []


def kept(kind: str, key, make=None):
    """make()'s result, kept in this worker for later tasks of the same operator; what other kinds keep is let go.

    Workers go from one operator to the next, and their caches together would not fit an executor. A task that
    keeps nothing first gives back what its worker's last one has freed.
    """
    with _lock:
        others = [k for k in _kept if k[0] != kind or k != (kind, key) and make]
        for other in others:
            del _kept[other]
        if others:
            gc.collect()
        if others or not make:
            give_back()
        if make and (kind, key) not in _kept:
            _kept[kind, key] = make()
        return _kept.get((kind, key))


def give_back() -> None:
    """Memory that this worker has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc give memory back themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow: a task that ends gives back what it has freed, and a worker without a task for IDLE seconds also what it keeps.

    A worker isn't told when an operator ends, and the next one's tasks may go to others or run in the JVM alone.
    """

    def task(batches):
        _wait(False)
        try:
            yield from run(batches)
        finally:
            give_back()
            _wait(True)

    return task


def _wait(begins: bool) -> None:
    with _lock:
        while _waits:
            _waits.pop().cancel()
        if begins and _kept:
            timer = threading.Timer(IDLE, _let_go)
            timer.daemon = True
            _waits.append(timer)
            with contextlib.suppress(RuntimeError):  # the worker is ending
                timer.start()


def _let_go() -> None:
    with _lock:
        if threading.current_thread() not in _waits:  # a task has begun meanwhile
            return
        _kept.clear()
        gc.collect()
        give_back()
