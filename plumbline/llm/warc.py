"""WARC archives with a two-level capture index.

``write_archives`` appends a gzip member per capture to one archive file per task in the shared folder (a task that is
run again writes another file; only the file of the attempt that succeeds is in the returned rows). ``write_index``
sorts the captures by reversed-host URL key over range partitions and packs them into compressed blocks; the first key
of every block goes to a sparse directory of its shard. ``read_captures`` finds the shard from the shards' first keys
(one for each partition), binary-searches the shard's directory, opens one block, and range-reads the record.

Defined results: a null html is an empty payload; a null URL has the key of the empty URL; a null page_id sorts last
and is never the first of several equal payloads if another id exists; rows repeated in full get a record each, and
those with the smallest page_id of a payload are all responses; an empty table gives an empty index. Any file system
that pyarrow opens by URI can hold the archives. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import fresh_path, table, written

#: Payloads shorter than this are stored each time.
MIN_REVISIT = 100
BLOCK_LINES = 512
ARCHIVE_BYTES = 1 << 30
#: Entries of a shard of the index, about: its directory has one line for each BLOCK_LINES of them.
SHARD_ENTRIES = 1 << 22
NO_ID = (1 << 63) - 1
DATE = "2024-01-01T00:00:00Z"


def surt(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, ``www`` and default ports dropped, then path and query."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return "~" + (url or "")
    host = re.sub(r"^www\d*\.", "", host)
    port = "" if port in (None, 80, 443) else f":{port}"
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/").lower() + (f"?{parts.query.lower()}" if parts.query else "")


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a URI that every executor can open."""
    import pyarrow.fs as fs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def record_bytes(kind: str, url: str | None, page_id: int | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no payload and names the response it repeats."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url}|{page_id}|{digest}')}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url or '')}", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Page: {refers}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record's bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


ENTRY = "page_id long, url string, surt string, archive string, offset long, length long"


def plan_records(pages: DataFrame) -> DataFrame:
    """Each page with its payload, digest and kind: the smallest page_id of equal payloads answers, others revisit it."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("n_bytes"))
    # the first id of each digest that occurs twice; the hot digest is summed before it is dealt out
    first = rows.where(F.col("n_bytes") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first_id")
    # digests alone take part in the join; payloads stay with their page
    joined = rows.join(first, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns an index row for each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        context = TaskContext.get()
        stem = f"{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex[:8]}"
        out, name, at, made = None, "", 0, 0
        try:
            for batch in batches:
                rows: list[tuple] = []
                for r in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at, made = f"{stem}-{made:04d}.warc.gz", 0, made + 1
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    raw = gzip.compress(record_bytes(r["kind"], r["url"], r["page_id"], r["payload"], r["digest"], r["refers_to"]), 6, mtime=0)
                    out.write(raw)
                    rows.append((r["page_id"], r["url"], surt(r["url"]), name, at, len(raw)))
                    at += len(raw)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["page_id", "url", "surt", "archive", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return records.select("page_id", "url", "payload", "digest", "kind", "refers_to").mapInArrow(run, ENTRY)


def write_index(entries: DataFrame, folder: str, shards: int) -> DataFrame:
    """Index files of range shards; returns (shard file, first key, number of entries), a row for each shard.

    A shard file holds zlib blocks of ``BLOCK_LINES`` lines, then its directory (first key, offset, length of each
    block) and the directory's length in the last 8 bytes.
    """
    # the page id joins the key, so a URL that a third of all pages share still spreads over shards
    ordered = entries.withColumn("by_id", F.coalesce("page_id", F.lit(NO_ID))).repartitionByRange(shards, "surt", "by_id").sortWithinPartitions("surt", "by_id", "archive", "offset").drop("by_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.cdx"
        out, at, directory, first, total = None, 0, [], None, 0
        held: list[list] = []

        def flush() -> None:
            nonlocal at, out
            if out is None:
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            raw = zlib.compress("\n".join(map(json.dumps, held)).encode(), 6)
            out.write(raw)
            directory.append([held[0][0], held[0][1], at, len(raw)])
            at += len(raw)
            held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                key = [r["surt"], NO_ID if r["page_id"] is None else r["page_id"]]
                first = first or key
                held.append([*key, r["archive"], r["offset"], r["length"]])
                total += 1
                if len(held) >= BLOCK_LINES:
                    flush()
        if held:
            flush()
        if out is not None:
            raw = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(raw + len(raw).to_bytes(8, "little"))
            out.close()
            yield pa.RecordBatch.from_pylist([{"shard": name, "first_surt": first[0], "first_id": first[1], "n": total}], schema=pa.schema([("shard", pa.string()), ("first_surt", pa.string()), ("first_id", pa.int64()), ("n", pa.int64())]))

    return ordered.mapInArrow(run, "shard string, first_surt string, first_id long, n long")


def find_blocks(firsts: list[tuple[str, int]], key: tuple[str, int]) -> range:
    """Blocks that can hold ``key``, by binary search in their sorted first keys: repeated rows may run over several."""
    low, high = bisect.bisect_left(firsts, key), bisect.bisect_right(firsts, key)
    return range(max(0, low - 1), high)


def read_captures(wanted: DataFrame, shards: list[tuple[str, int, str]], index_folder: str, archive_folder: str, parts: int) -> DataFrame:
    """Looks up (url, page_id) rows and returns every capture found, parsed from its archive.

    ``shards``: (first surt, first id, file), sorted; one for each range partition of the index, a number the writer sets.
    """
    firsts = [(s[0], s[1]) for s in shards]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [(surt(u), NO_ID if i is None else i) for i, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            # a key equal to a shard's first may have begun in the shard before it
            spans = [range(max(0, bisect.bisect_left(firsts, k) - 1), bisect.bisect_right(firsts, k)) for k in keys]
            flat = [(s, *k) for k, span in zip(keys, spans, strict=True) for s in span]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.string()), pa.array([x[2] for x in flat], pa.int64())], names=["shard", "surt", "by_id"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, index = filesystem(index_folder)
        _, archives = filesystem(archive_folder)
        shard, directory, begins, file = None, [], [], None
        block, lines = None, {}
        opened: dict[str, pa.NativeFile] = {}

        def load(which: int) -> None:
            nonlocal shard, directory, begins, file, block
            shard, block = which, None
            file = fs.open_input_file(f"{index}/{shards[which][2]}")
            size = file.size()
            length = int.from_bytes(file.read_at(8, size - 8), "little")
            directory = json.loads(zlib.decompress(file.read_at(length, size - 8 - length)))
            begins = [(d[0], d[1]) for d in directory]

        for batch in batches:
            found = []
            for which, key, by_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if which != shard:
                    load(which)
                for b in find_blocks(begins, (key, by_id)):
                    if b != block:
                        block, lines = b, {}
                        for line in zlib.decompress(file.read_at(directory[b][3], directory[b][2])).decode().split("\n"):
                            e = json.loads(line)
                            lines.setdefault((e[0], e[1]), []).append(e[2:])
                    found += lines.get((key, by_id), [])
            rows = []
            for name, offset, length in found:
                if name not in opened:
                    if len(opened) >= 64:
                        opened.pop(next(iter(opened))).close()
                    opened[name] = fs.open_input_file(f"{archives}/{name}")
                fields, payload = parse_record(gzip.decompress(opened[name].read_at(length, offset)))
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].partition(":")[2]
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{name}: the payload at {offset} is not what its digest says")
                page = fields["X-Page-Id"]
                rows.append((int(page) if page else None, fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, kind, int(fields["WARC-Refers-To-Page"]) if kind == "revisit" else None, payload.decode() if kind == "response" else None))
            if rows:
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"])

    if not shards:
        return wanted.sparkSession.createDataFrame([], "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")
    keys = wanted.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(place, "shard int, surt string, by_id long").distinct()
    # the range partitioner spreads one hot URL by its ids
    keys = keys.repartitionByRange(parts, "shard", "surt", "by_id").sortWithinPartitions("shard", "surt", "by_id")
    return keys.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")


def archive(pages: DataFrame, folder: str | None = None) -> tuple[str, str, list[tuple[str, int, str]]]:
    """Writes archives and index of ``pages``; returns the archive folder, the index folder and the shards."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    # kept as a table, so the index names the files of one attempt only
    entries = written(write_archives(plan_records(pages), f"{folder}/archive"), "warc-entries")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // SHARD_ENTRIES))
    shards = written(write_index(entries, f"{folder}/index", parts), "warc-shards").collect()
    return f"{folder}/archive", f"{folder}/index", sorted((s.first_surt, s.first_id, s.shard) for s in shards)


def op9_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives, index, shards = archive(pages)
    found = read_captures(pages, shards, index, archives, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_id, count(*) AS copies FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN copies > 1 AND d.page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN copies > 1 AND d.page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
