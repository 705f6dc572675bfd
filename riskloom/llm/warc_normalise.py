"""Monolithic gzip WARC normaliser.

Many crawls ship archives as one gzip stream over the whole file, which can only
be read from the start.  :func:`normalise_stream` inflates such a stream once,
in bounded memory (one record at a time), writes every record as a gzip member
of its own and reports where each member lies; the offsets go into a sidecar
file next to the archive, so a record can later be read with one seek.

Archives lie in the shared folder (``spark.checkpoint.dir``), reached from the
executors by Arrow's file systems.  Names carry the task attempt, and only names
returned by a committed attempt are read later, so a lost executor leaves at
most unread files.

While archives are normalised, records whose payload equals that of a record with
a larger page_id become ``revisit`` records: no payload, but its digest, its length
and the response they refer to.  The decision is made on the narrow index of
(page_id, digest, length), so payloads are never shuffled and a payload shared
by a third of all pages is pre-aggregated before its shuffle.

Defined results: a null payload is empty; pages with the group's largest page_id
are responses, also when that id is repeated; a null page_id is never a
referred-to record while its group has another id; null urls have no target
header; an empty table gives no archives and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

GZIP = 31                        # zlib window bits of a gzip stream
READ_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20         # an archive is closed after so many bytes before compression
ARCHIVE_RECORDS = 50_000         # ... or so many records
MAX_TASKS = 20_000
RAW_LEVEL, MEMBER_LEVEL = 1, 4
EPOCH = "1970-01-01T00:00:00Z"   # no capture time is known; a fixed one keeps archives reproducible
URN = "<urn:page:{}>"

RAW_SCHEMA = "archive string, rec long, page_id long, payload_bytes long, payload_digest string"
INDEX_SCHEMA = "archive string, rec long, offset long, length long"
RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                 "url string, payload binary")


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_bytes(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes) -> bytes:
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", URN.format(page_id)), ("WARC-Date", EPOCH)]
    if url is not None:
        headers.append(("WARC-Target-URI", " ".join(url.split())))
    headers += [("WARC-Payload-Digest", "sha1:" + digest(payload)), ("Content-Type", "text/html")]
    return record_bytes(headers, payload)


def parse_headers(head: bytes) -> list[tuple[str, str]]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:] if x)]


def inflated(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """Chunks of a gzip file's content, one member or many."""
    z = zlib.decompressobj(GZIP)
    while chunk := read(READ_BYTES):
        while chunk:
            if z.eof:
                z = zlib.decompressobj(GZIP)
            yield z.decompress(chunk, 8 * READ_BYTES)
            chunk = z.unused_data if z.eof else z.unconsumed_tail
    if not z.eof:
        raise ValueError("the gzip stream ends early")


def records(chunks: Iterator[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, payload) of each record of an inflated stream; holds one record at a time."""
    buf = bytearray()

    def fill(n: int) -> bool:
        while len(buf) < n:
            chunk = next(chunks, None)
            if chunk is None:
                return False
            buf.extend(chunk)
        return True

    while True:
        while (end := buf.find(b"\r\n\r\n")) < 0:
            if not fill(len(buf) + 1):
                if buf.strip():
                    raise ValueError("the archive ends inside a record header")
                return
        headers = parse_headers(bytes(buf[:end]))
        n = int(dict(headers)["Content-Length"])
        if not fill(end + 4 + n + 4):
            raise ValueError("the archive ends inside a record")
        payload = bytes(buf[end + 4: end + 4 + n])
        del buf[: end + 4 + n + 4]
        yield headers, payload


def normalise_stream(read: Callable[[int], bytes], write: Callable[[bytes], object], revisits: dict[int, int],
                     level: int = MEMBER_LEVEL) -> Iterator[tuple[int, str, int, int]]:
    """Rewrite a WARC gzip file record by record; yields (rec, record id, offset, length) of the members.

    ``revisits`` maps record numbers to the page they refer to.
    """
    offset = 0
    for rec, (headers, payload) in enumerate(records(inflated(read))):
        headers = [(k, v) for k, v in headers if k != "Content-Length"]
        if rec in revisits:
            headers = [(k, "revisit" if k == "WARC-Type" else v) for k, v in headers]
            headers += [("WARC-Refers-To", URN.format(revisits[rec])), ("WARC-Payload-Length", str(len(payload)))]
            payload = b""
        z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        member = z.compress(record_bytes(headers, payload)) + z.flush()
        write(member)
        yield rec, dict(headers).get("WARC-Record-ID", ""), offset, len(member)
        offset += len(member)


def write_monoliths(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                    archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """Write pages as whole-file gzip WARC archives; one narrow row per record."""
    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        tc = TaskContext.get()
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        out = z = name = None
        number, used, rec, rows = 0, 0, 0, []
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"raw-{tc.partitionId():06d}-{tc.taskAttemptId()}-{number:05d}.warc.gz"
                    out, z, used, rec = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(
                        RAW_LEVEL, zlib.DEFLATED, GZIP), 0, 0
                payload = (html or "").encode("utf-8", "surrogatepass")
                raw = page_record(page_id, url, payload)
                out.write(z.compress(raw))
                rows.append((name, rec, page_id, len(payload), digest(payload)))
                used, rec = used + len(raw), rec + 1
                if used >= archive_bytes or rec >= archive_records:
                    out.write(z.flush())
                    out.close()
                    out, number = None, number + 1
            yield _table(rows, RAW_SCHEMA)
            rows = []
        if out is not None:
            out.write(z.flush())
            out.close()

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string")).mapInArrow(run, RAW_SCHEMA)


def _table(rows: list[tuple], schema: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=kinds[k]) for c, (_, k) in zip(cols, fields)],
                                      names=[n for n, _ in fields])


def revisit_decisions(raw_index: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, rec, refers_to) of the records that revisit one with a larger page_id."""
    long_enough = raw_index.where(F.col("payload_bytes") >= min_bytes)
    groups = (long_enough.groupBy("payload_digest", "payload_bytes")
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return (long_enough.join(groups, ["payload_digest", "payload_bytes"])
            .where(F.coalesce(F.col("page_id") < F.col("refers_to"), F.col("refers_to").isNotNull()))
            .select("archive", "rec", "refers_to"))


def normalise(raw_index: DataFrame, revisits: DataFrame, folder: str) -> DataFrame:
    """Normalise every archive of ``raw_index``; returns the offset index (also written as sidecars)."""
    def run(key, archives, decided):
        fs, base = _file_system(folder)
        if archives.num_rows == 0:
            return _as_table([], INDEX_SCHEMA)
        from pyspark import TaskContext

        name = archives.column("name")[0].as_py()
        new = f"norm-{name.removeprefix('raw-').removesuffix('.warc.gz')}-{TaskContext.get().taskAttemptId()}.warc.gz"
        to = dict(zip(decided.column("rec").to_pylist(), decided.column("refers_to").to_pylist()))
        rows, side = [], []
        with fs.open_input_stream(f"{base}/{name}", compression=None) as source, \
                fs.open_output_stream(f"{base}/{new}", compression=None) as target:
            for rec, rid, offset, length in normalise_stream(source.read, target.write, to):
                rows.append((new, rec, offset, length))
                side.append(json.dumps({"rec": rec, "id": rid, "offset": offset, "length": length}))
        with fs.open_output_stream(f"{base}/{new}.idx", compression=None) as target:
            target.write("".join(x + "\n" for x in side).encode())
        return _as_table(rows, INDEX_SCHEMA)

    # the rows are narrow but each stands for a whole archive: partitions by number of archives, not by bytes
    parts = min(max(raw_index.select("archive").distinct().count(), 1), MAX_TASKS)
    archives = raw_index.select(F.col("archive").alias("name")).distinct().repartition(parts, "name")
    revisits = revisits.repartition(parts, "archive")
    return archives.groupBy("name").cogroup(revisits.groupBy("archive")).applyInArrow(run, INDEX_SCHEMA)


def _as_table(rows, schema):
    import pyarrow as pa

    return pa.Table.from_batches([_table(rows, schema)])


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Read records by the offset index: one seek and one member each; responses are verified by digest."""
    def run(batches):
        fs, base = _file_system(folder)
        name = source = None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, fs.open_input_file(f"{base}/{archive}")
                (headers, payload), = records(iter([zlib.decompress(source.read_at(length, offset), GZIP)]))
                h = dict(headers)
                page = h["WARC-Record-ID"][len("<urn:page:"):-1]
                known = h["WARC-Payload-Digest"].removeprefix("sha1:")
                kind, refers = h["WARC-Type"], None
                n = len(payload)
                if kind == "revisit":
                    refers, n = int(h["WARC-Refers-To"][len("<urn:page:"):-1]), int(h["WARC-Payload-Length"])
                elif digest(payload) != known:
                    raise ValueError(f"{archive} at {offset}: the payload does not match its digest")
                rows.append((None if page == "None" else int(page), n, known, kind, refers, h.get("WARC-Target-URI"),
                             payload if with_payload and kind != "revisit" else None))
                if len(rows) >= 2_000:
                    yield _table(rows, RECORD_SCHEMA)
                    rows = []
            yield _table(rows, RECORD_SCHEMA)
        if source is not None:
            source.close()

    return index.select("archive", "offset", "length").mapInArrow(run, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> tuple[DataFrame, str]:
    """Pages -> monolithic archives -> normalised archives; returns the offset index and the archives' folder."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    raw = materialize(write_monoliths(pages, folder), "warc-raw")
    return materialize(normalise(raw, revisit_decisions(raw, min_bytes), folder), "warc-index"), folder


def op3_warc(spark, sf_dir: str) -> DataFrame:
    index, folder = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_records(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    chars = " || ".join(
        f"substr('{alphabet}', 1 + ((('0x' || substr(h, {1 + 5 * k}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
        for k in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS top FROM p)
SELECT page_id, payload_bytes, {chars} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM g
"""
