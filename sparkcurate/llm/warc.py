"""WARC archives: an index of byte ranges first, then coalesced reads of the selected records."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import filesystem, forget, hot_rows, join_groups, load, new_folder, placed, written

#: Payloads of fewer bytes are always stored whole.
LEAST_REVISIT = 100
#: Reads are joined over gaps of up to GAP bytes, up to RANGE bytes.
GAP, RANGE = 64 << 10, 8 << 20
#: A reading task's share of the archives.
TASK_BYTES = 24 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"


def _uri(page_id: int) -> str:
    return f"<urn:sparkcurate:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header alone; what it refers to may have no id."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    head += [f"WARC-Record-ID: {_uri(page_id)}"] if page_id is not None else [f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}"] + ([f"WARC-Refers-To: {_uri(refers_to)}"] if refers_to is not None else [])
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's headers, in lower case, with the HTTP header's length of the payload and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    http, _, payload = rest[: int(out["content-length"])].partition(b"\r\n\r\n")
    out["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", http)[1])
    out["payload"] = payload
    return out


def _page(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:sparkcurate:page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = 6) -> DataFrame:
    """Writes one record per row, each a gzip member, one archive a task; returns the index of all records.

    Of rows with equal payloads of at least LEAST_REVISIT bytes just one is a response, that with the
    smallest id, and the others revisit it; a null id comes after all others, and of rows with equal ids
    the first by place is it. Null html is an empty payload, a null url is left out; no rows give no
    archives; other columns, of any name, are ignored. Archives have a new name for each attempt, so that
    a repeated task's index names its own file; a file no index names is never read.
    """
    rows = placed(pages.select(id_col, url_col, html_col), "located")
    payload = F.coalesce(F.col("row")[html_col], F.lit("")).cast("binary")
    rows = rows.select(F.col("row")[id_col].cast("long").alias("page_id"), F.col("row")[url_col].alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), "file", "at")
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= LEAST_REVISIT, F.unhex("digest")))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "at")).alias("first")
    many = rows.where("key IS NOT NULL").groupBy("key").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    many = written(many, "repeated")
    rows = join_groups(rows, many, many.count(), hot_rows(rows.count()))
    own = (F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at"))
    rows = rows.select("page_id", "url", "payload", "digest", F.coalesce(~own, F.lit(False)).alias("revisit"), F.col("first.page_id").alias("first"))

    def write(batches):
        out, name, at = None, "", 0
        for batch in batches:
            if out is None:
                fs, path = filesystem(folder)
                fs.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            index = []
            for row in batch.to_pylist():
                again, refers = row["revisit"], row["first"] if row["revisit"] else None
                packer = zlib.compressobj(level, wbits=31)
                data = packer.compress(record(row["page_id"], row["url"], row["payload"], row["digest"], again, refers)) + packer.flush()
                out.write(data)
                index.append((f"{folder}/{name}", at, len(data), row["url"], row["digest"], row["page_id"], "revisit" if again else "response", refers))
                at += len(data)
            yield pa.RecordBatch.from_pylist([dict(zip(INDEX_SCHEMA.names, x, strict=True)) for x in index], INDEX_SCHEMA)
        if out is not None:
            out.close()

    index = written(rows.mapInArrow(write, INDEX), "warc-index")
    forget(many)
    return index


INDEX_SCHEMA = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Joins neighbouring (file, offset, length), sorted, into reads of (file, [(offset, length)...])."""
    file, held = None, []
    for f, at, n in rows:
        if held and (f != file or at - (held[-1][0] + held[-1][1]) > GAP or at + n - held[0][0] > RANGE):
            yield file, held
            held = []
        file = f
        held.append((at, n))
    if held:
        yield file, held


def read_records(selected: DataFrame, payloads: bool = False) -> DataFrame:
    """The records that rows of an index name: page_id, payload_bytes, payload_digest, record_type, refers_to, url, and payload if asked for.

    The index is sorted by file and offset, dealt out by ranges of it, and neighbouring records are
    read at once. A response's digest is that of the payload read; one that differs from its header
    fails. A revisit tells the digest and length that its header states, and has no payload of its own
    (with_payloads() finds it). No rows give no rows.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * payloads

    def read(batches):
        wanted = ((f, a, n) for b in batches for f, a, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
        opened, handle = None, None
        for file, parts in ranges(wanted):
            if file != opened:
                if handle is not None:
                    handle.close()
                fs, path = filesystem(file)
                opened, handle = file, fs.open_input_file(path)
            start = parts[0][0]
            data = handle.read_at(parts[-1][0] + parts[-1][1] - start, start)
            out = []
            for at, n in parts:
                r = parse(zlib.decompress(data[at - start : at - start + n], wbits=31))
                stated = r["warc-payload-digest"].removeprefix("sha256:")
                if r["warc-type"] == "response" and hashlib.sha256(r["payload"]).hexdigest() != stated:
                    raise ValueError(f"the payload at {at} in {file} doesn't have its digest")
                row = [_page(r["warc-record-id"]), r["payload_bytes"], stated, r["warc-type"], _page(r.get("warc-refers-to")), r.get("warc-target-uri")]
                out.append(row + [r["payload"] if r["warc-type"] == "response" else None] * payloads)
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names[: len(out[0])])
        if handle is not None:
            handle.close()

    total = selected.agg(F.sum("length")).first()[0] or 0
    dealt = selected.select("file", "offset", "length").repartitionByRange(int(total // TASK_BYTES) + 1, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, schema)


def with_payloads(selected: DataFrame, index: DataFrame) -> DataFrame:
    """read_records() of selected rows of an index, with the payloads of all: a revisit's is that of the response with its digest.

    Only the responses in question are read for it; a digest's many revisits are spread over tasks.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    again = selected.where("record_type = 'revisit'").select(*index.columns, F.col("digest").alias("key"), F.col("offset").alias("at"))
    wanted = written(again.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "wanted")
    n = wanted.count()
    responses = index.where("record_type = 'response'").join(wanted.select(F.col("key").alias("digest")).hint("broadcast" if n <= 100_000 else "merge"), "digest", "left_semi")
    whole = written(read_records(responses, payloads=True).select(F.col("payload_digest").alias("key"), "payload").join(wanted, "key"), "payloads")
    own = read_records(selected, payloads=True)
    revisits = own.where("record_type = 'revisit'").select(*names, F.col("payload_digest").alias("key"), F.lit("").alias("file"), F.monotonically_increasing_id().alias("at"))
    hot = hot_rows(selected.count())
    # payloads have no bound, so that they are never broadcast
    found = join_groups(revisits, whole, n, hot, most=-1).select(*names, "payload")
    return own.where("record_type = 'response'").select(*names, "payload").unionByName(found)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(load(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return read_records(index)


OP1_SQL = """
WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""
