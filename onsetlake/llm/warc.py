"""Web archives with a two-level capture index.

Pages become WARC records, each a gzip member of its own, so that a record can
be read by its range of the file.  The index sorts captures by a reversed-host
URL key into gzip blocks of ``BLOCK_LINES`` lines; a sparse directory holds one
row a block (its first and last key, file, place, size).  A lookup finds the
index shard by the shards' first keys, the blocks by binary search in that
shard's directory, the lines by binary search in the block, and then reads the
records by range.

Tasks write files under names of their own and return what they wrote; only
files that a committed table names are read, so lost or repeated tasks leave
nothing behind that counts.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote, urlsplit


import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BLOCK_LINES = 1000
LEAST_REVISIT = 100
RANGE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the UUID namespace of URLs


def url_key(url: str | None) -> str:
    """Sortable key: host names from the last to the first, then port, path and query; no scheme or fragment."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return quote(url, safe=_SAFE)
    if not host:
        return quote(url, safe=_SAFE)
    port = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return quote(",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + query, safe=_SAFE)


_SAFE = "!#$%&'()*+,/:;=?@[]~"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or a revisit (without payload) of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", date), ("WARC-Target-URI", quote(url or "", safe=_SAFE)),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
              ("X-Page-ID", "" if page_id is None else str(page_id))]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, rest


def parse_record(raw: bytes) -> dict:
    """Type, page, URL, digest, size and payload (None for revisits) of one record; raises on a broken one."""
    fields, rest = _fields(raw)
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
    http, payload = _fields(block)
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise ValueError(f"record {fields.get('warc-record-id')} does not match its digest")
    number = lambda v: int(v) if v else None
    return {"page_id": number(fields["x-page-id"]), "url": fields["warc-target-uri"], "record_type": fields["warc-type"],
            "payload_bytes": int(http["content-length"]), "payload_digest": digest,
            "refers_to": number(fields.get("x-refers-to-page-id")), "payload": None if revisit else payload}


CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()),
                     ("place", pa.int64()), ("size", pa.int64())])
_CAPTURE = "key string, page_id long, url string, file string, place long, size long"


def _store(folder: str):
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return store, path


def deduplicated(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, refers_to): payloads of ``least`` bytes or more point to their smallest page_id.

    Equal payloads meet as digests, counted before they are shuffled; rows that
    repeat the smallest page_id are all responses.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")) \
        .withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    first = own.where(F.octet_length("html") >= least).groupBy("digest") \
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return own.join(first, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def write_archives(pages: DataFrame, out: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes ``pages`` as archives under ``out`` and returns the captures (key, page_id, url, file, place, size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(f"{out}/archives")
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        sink, place = None, 0
        for batch in batches:
            rows = []
            for r in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]):
                page, url, html, digest, refers_to = r
                member = gzip.compress(record(page, url, html.encode(), digest, refers_to), 6, mtime=0)
                sink = sink or store.open_output_stream(f"{folder}/{name}", compression=None)
                sink.write(member)
                rows.append({"key": url_key(url), "page_id": page, "url": url, "file": name, "place": place, "size": len(member)})
                place += len(member)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=CAPTURE)
        if sink:
            sink.close()

    common.bounded_batches(pages.sparkSession)
    return common.stored(deduplicated(pages, least).select("page_id", "url", "html", "digest", "refers_to")
                         .mapInArrow(common.released(run), _CAPTURE), "captures")


BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.string()), ("last", pa.string()),
                   ("file", pa.string()), ("place", pa.int64()), ("size", pa.int64())])
_BLOCK = "shard int, block int, first string, last string, file string, place long, size long"


def write_index(captures: DataFrame, out: str, lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts captures by key into compressed blocks under ``out`` and returns the directory, one row a block.

    Captures of one key are also ordered by their place, so a key with very
    many of them spreads over blocks and shards.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(f"{out}/index")
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}.cdx.gz"
        sink, place = None, 0
        rows: list[dict] = []
        held: list[dict] = []

        def flush() -> None:
            nonlocal sink, place
            text = "".join(r["key"] + " " + json.dumps({k: r[k] for k in ("page_id", "url", "file", "place", "size")}) + "\n" for r in held)
            member = gzip.compress(text.encode(), 6, mtime=0)
            sink = sink or store.open_output_stream(f"{folder}/{name}", compression=None)
            sink.write(member)
            rows.append({"shard": shard, "block": len(rows), "first": held[0]["key"], "last": held[-1]["key"],
                         "file": name, "place": place, "size": len(member)})
            place += len(member)
            held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                held.append(r)
                if len(held) == lines:
                    flush()
        if held:
            flush()
        if sink:
            sink.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=BLOCK)

    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "file", "place"]
    return common.stored(captures.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(common.released(run), _BLOCK), "directory")


def block_lines(text: str, key: str) -> list[str]:
    """The lines of a block for a key, by binary search."""
    lines = text.split("\n")[:-1]
    return lines[bisect.bisect_left(lines, key + " "):bisect.bisect_left(lines, key + "!")]


def lookup(keys: DataFrame, directory: DataFrame, out: str) -> DataFrame:
    """Captures of the distinct ``keys`` (column key) by way of the directory and the index blocks.

    The first keys of the shards, one a shard, are all that is shipped to
    tasks; sorted keys and directory rows of a shard pass by each other once, and
    each block is read once.
    """
    spark = keys.sparkSession
    bounds = directory.groupBy("shard").agg(F.min("first").alias("first"), F.max("last").alias("last")) \
        .orderBy("shard").collect()
    shards, firsts, lasts = [r.shard for r in bounds], [r["first"] for r in bounds], [r["last"] for r in bounds]

    def shard_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key in batch.column(0).to_pylist():
            a, b = bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)
            rows += [(key, shards[i]) for i in range(a, b)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                                          ["key", "shard"])

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys with the blocks that may hold them, from one pass over both in order."""
        shard, held = None, []  # blocks that began and reach the key at hand or may reach later ones
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    shard, held = r["shard"], []
                if r["block"] is not None:
                    held.append(r)
                    continue
                held = [b for b in held if b["last"] >= r["key"]]
                rows += [{"key": r["key"], "shard": shard, **{n: b[n] for n in ("block", "file", "place", "size")}} for b in held]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("key", pa.string()), ("shard", pa.int32()), ("block", pa.int32()), ("file", pa.string()),
                    ("place", pa.int64()), ("size", pa.int64())]))

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(f"{out}/index")
        now, text = None, ""
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if (r["file"], r["place"]) != now:
                    now = r["file"], r["place"]
                    with store.open_input_file(f"{folder}/{r['file']}") as f:
                        f.seek(r["place"])
                        text = gzip.decompress(f.read(r["size"])).decode()
                rows += [{"key": r["key"], **json.loads(line.partition(" ")[2])} for line in block_lines(text, r["key"])]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=CAPTURE)

    shard_keys = common.mapped(keys.select("key").where("key is not null").distinct(), "key string, shard int", shard_of)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = ("last", "block", "file", "place", "size")
    no_facts = [F.lit(None).cast(directory.schema[c].dataType).alias(c) for c in facts]
    both = directory.select("shard", F.col("first").alias("key"), F.lit(0).alias("kind"), *facts) \
        .unionByName(shard_keys.select("shard", "key", F.lit(1).alias("kind"), *no_facts))
    blocks = both.repartition(n, "shard").sortWithinPartitions("shard", "key", "kind", "block") \
        .mapInArrow(common.released(matched), "key string, shard int, block int, file string, place long, size long")
    return blocks.repartition(n, "shard", "block").sortWithinPartitions("shard", "block", "key").mapInArrow(common.released(lines_of), _CAPTURE)


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read_records(captures: DataFrame, out: str, keep_payload: bool = True) -> DataFrame:
    """The records of captures (file, place, size), read by their ranges in order of place and checked against their digests."""
    schema = RECORD if keep_payload else pa.schema(list(RECORD)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(f"{out}/archives")
        name, source = None, None
        for batch in batches:
            rows, size = [], 0
            for r in batch.to_pylist():
                if r["file"] != name:
                    if source:
                        source.close()
                    name, source = r["file"], store.open_input_file(f"{folder}/{r['file']}")
                source.seek(r["place"])
                row = parse_record(gzip.decompress(source.read(r["size"])))
                rows.append({n: row[n] for n in schema.names})
                size += row["payload_bytes"]
                if size > RANGE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if source:
            source.close()

    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = captures.select("file", "place", "size", (F.col("place") / RANGE_BYTES).cast("long").alias("range"))
    return ranged.repartition(n, "file", "range").sortWithinPartitions("file", "place").select("file", "place", "size") \
        .mapInArrow(common.released(run), _RECORD + ", payload binary" * keep_payload)


def round_trip(pages: DataFrame, out: str | None = None, keep_payload: bool = True, lines: int = BLOCK_LINES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives with an index, and reads every record back through the index.

    Null html is empty, a null or odd URL has a key of its own text, a null
    page_id is written as such and is no one's original; repeated rows are
    records of their own; an empty table gives no rows; other columns are left
    out.
    """
    out = out or common.scratch_dir(pages.sparkSession, "warc")
    captures = write_archives(pages, out)
    directory = write_index(captures, out, lines)
    return read_records(lookup(captures.select("key"), directory, out), out, keep_payload)
