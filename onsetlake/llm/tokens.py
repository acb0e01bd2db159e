"""Token-id files: frequency-ranked ids, byte-aligned variable-length codes with
separate control bytes, decoded by table lookup.

A run writes, in ascending ``doc_id`` order, shards of blocks.  A block is::

    int64   number of documents d         int64   number of control bytes c
    d bytes 1 where doc_id is null        d x int64 doc_id (0 where null)
    d x uint32 ids of each document
    c control bytes, two bits an id: bytes of its code less one
    data bytes: the ids' frequency ranks, little-endian, 1 to 4 bytes each

Each document starts a control byte; up to three zeros fill its last one.  The
most frequent id has rank 0, so common ids take one byte.  ``ranks`` (Parquet:
rank, token) turns ranks into ids; ``manifest`` (Parquet) names each block's
file, place and size.  Only files that the committed manifest names are ever
read, so what a lost or repeated task left behind is ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

BLOCK_IDS = 1 << 18
SLICE_BYTES = 3 << 20
SHARD_BYTES = 32 << 20


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values, filled up with zeros to a multiple of four."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    padded[:len(ranks)] = ranks
    extra = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = extra.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = padded.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def length_table() -> np.ndarray:
    """Per control byte the code lengths of its four values."""
    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def decode_ranks(control: bytes, data: bytes) -> np.ndarray:
    """All values, fillers included: lengths by table lookup, then one gather and one mask."""
    lengths = length_table()[np.frombuffer(control, np.uint8)].reshape(-1)
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    masks = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
    wide = np.zeros(len(lengths), np.uint32)
    for k in range(4):
        wide |= raw[starts + k].astype(np.uint32) << np.uint32(8 * k)
    return wide & masks[lengths]


def write_block(ids: list[int | None], sizes: np.ndarray, ranks: np.ndarray) -> bytes:
    """A block of documents: their numbers of ids, and all their ranks one after the other."""
    counts = np.asarray(sizes, np.int64)
    padded = -(-counts // 4) * 4
    shift = (np.cumsum(padded) - padded) - (np.cumsum(counts) - counts)
    spread = np.zeros(int(padded.sum()), "<u4")
    spread[np.arange(len(ranks)) + np.repeat(shift, counts)] = ranks
    control, data = encode_ranks(spread)
    return b"".join([
        np.array([len(ids), len(control)], "<i8").tobytes(),
        bytes(i is None for i in ids),
        np.array([i or 0 for i in ids], "<i8").tobytes(),
        counts.astype("<u4").tobytes(),
        control, data,
    ])


def read_block(block: bytes, token_of: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, all ids, and each document's bounds in them."""
    d, c = np.frombuffer(block, "<i8", 2).tolist()
    at = 16
    nulls = np.frombuffer(block, np.uint8, d, at)
    ids = np.frombuffer(block, "<i8", d, at + d)
    sizes = np.frombuffer(block, "<u4", d, at + 9 * d).astype(np.int64)
    at += 13 * d
    values = decode_ranks(block[at:at + c], block[at + c:])
    padded = -(-sizes // 4) * 4
    inside = np.arange(len(values)) - np.repeat(np.cumsum(padded) - padded, padded) < np.repeat(sizes, padded)
    doc_ids = [None if null else i for null, i in zip(nulls.tolist(), ids.tolist())]
    return doc_ids, token_of[values[inside]], np.concatenate([[0], np.cumsum(sizes)])


def tokenize(docs: DataFrame, path: str, end_id: int | None, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, seen): the ids of each whole text, little-endian, with ``end_id`` appended.

    ``ids`` take two bytes each where all ids of the vocabulary fit, else four.

    Null and empty texts have no ids but the end id; repeated rows stay.  Each
    task adds a row with only ``seen``: the ids it met and how often, as pairs
    of int64.
    """
    common.bounded_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.tokenizer(path)
        kind = encoder.kind
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in common.sliced(batch, SLICE_BYTES):
                flat, sizes = encoder.encode_flat(common.texts_of(part.column("text")), end_id)
                here = np.bincount(flat, minlength=len(total))
                here[:len(total)] += total
                total = here
                ends = np.append(0, np.cumsum(sizes * kind.itemsize)).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype(kind))])
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_tokens": pa.array(sizes),
                                                  "ids": packed, "seen": pa.nulls(len(sizes), pa.binary())})
        met = np.flatnonzero(total)
        pairs = np.column_stack([met, total[met]]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(1, pa.int64()), "n_tokens": pa.nulls(1, pa.int64()),
                                          "ids": pa.nulls(1, pa.binary()), "seen": pa.array([pairs], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(common.released(run), "doc_id long, n_tokens long, ids binary, seen binary")


def token_counts(tokens: DataFrame) -> DataFrame:
    """(token, n) over all documents, from the rows that tasks add."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_pydict({"token": pa.array(pairs[:, 0]), "n": pa.array(pairs[:, 1])})

    return common.mapped(tokens.where("seen is not null").select("seen"), "token long, n long", run) \
        .groupBy("token").agg(F.sum("n").alias("n"))


def ids_of(column: pa.Array, n: int) -> np.ndarray:
    """All ids of a column of packed ids (two or four bytes each), without copying them."""
    if not n:
        return np.zeros(0, "<u2")
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], f"<u{(int(at[-1]) - int(at[0])) // n}", n, int(at[0]))


def write_tokens(tokens: DataFrame, out: str) -> None:
    """Writes ``ranks``, the shards and ``manifest`` under ``out``.

    Shards are cut by a range of ``doc_id`` (ties: by the ids, so that many
    rows of one doc_id spread out).
    The table of ranks is bounded by the vocabulary and shipped with the tasks.
    """
    spark = tokens.sparkSession
    ordered = token_counts(tokens).orderBy(F.desc("n"), "token").collect()
    token_of = np.array([r.token for r in ordered] or [0], np.int64)
    rank_of = np.zeros(token_of.max() + 1, np.uint32)
    rank_of[token_of] = np.arange(len(token_of))
    spark.createDataFrame([(k, int(t)) for k, t in enumerate(token_of.tolist())], "rank int, token long") \
        .coalesce(1).write.parquet(f"{out}/ranks")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        shard = TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(f"{out}/shards")
        store.create_dir(folder, recursive=True)
        name = f"{shard:06d}-{uuid.uuid4().hex}.ids"
        rows: list[dict] = []
        place = start = 0
        sink = None
        for batch in batches:
            keys, sizes = batch.column("doc_id").to_pylist(), np.asarray(batch.column("n_tokens"))
            ends = np.cumsum(sizes)
            flat = ids_of(batch.column("ids"), int(ends[-1]) if len(ends) else 0)
            first = 0
            while first < len(keys):  # blocks of whole documents
                done = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_IDS, "right")))
                mine = flat[done:int(ends[last - 1])]
                block = write_block(keys[first:last], sizes[first:last], rank_of[mine])
                sink = sink or store.open_output_stream(f"{folder}/{name}")
                sink.write(block)
                rows.append({"shard": shard, "block": len(rows), "file": name, "place": place, "n_bytes": len(block),
                             "start": start, "n_ids": len(mine)})
                place, start, first = place + len(block), start + len(mine), last
        if sink:
            sink.close()
        yield pa.RecordBatch.from_pylist(rows, schema=MANIFEST)

    n = common.partitions_for(spark, 2 * sum(r.n for r in ordered), SHARD_BYTES)
    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.xxhash64("ids")]
    tokens.where("seen is null").select("doc_id", "n_tokens", "ids").repartitionByRange(n, *order).sortWithinPartitions(*order) \
        .mapInArrow(common.released(write), "shard int, block int, file string, place long, n_bytes long, start long, n_ids long") \
        .write.parquet(f"{out}/manifest")


MANIFEST = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("file", pa.string()), ("place", pa.int64()),
                      ("n_bytes", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64())])


def shard_offsets(manifest: DataFrame, group: int = 1024) -> DataFrame:
    """(shard, base): ids in all shards before each one, from sums over groups of shards and sums inside a group."""
    sums = manifest.groupBy("shard").agg(F.sum("n_ids").alias("n")).withColumn("g", F.floor(F.col("shard") / group))
    earlier = (Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("shard").rowsBetween(*earlier)), F.lit(0))
    groups = sums.groupBy("g").agg(F.sum("n").alias("n"))  # few enough for one task
    whole = groups.select("g", F.coalesce(F.sum("n").over(Window.orderBy("g").rowsBetween(*earlier)), F.lit(0)).alias("all"))
    return sums.withColumn("inside", inside).join(whole, "g").select("shard", (F.col("all") + F.col("inside")).alias("base"))


def read_tokens(spark: SparkSession, out: str, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if kept, ids) of every document, decoded from the files under ``out``.

    ``start`` counts the ids of all documents before it.  Each block is read by
    its range of the file.
    """
    manifest = spark.read.parquet(f"{out}/manifest")
    ranks = spark.read.parquet(f"{out}/ranks").orderBy("rank").collect()
    token_of = np.array([r.token for r in ranks] or [0], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(f"{out}/shards")
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{folder}/{r['file']}") as f:
                    f.seek(r["place"])
                    doc_ids, ids, at = read_block(f.read(r["n_bytes"]), token_of)
                first = r["base"] + r["start"]
                raw = ids.astype("<u4").tobytes()
                texts = [raw[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                columns = {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": pa.array(first + at[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(at), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(texts, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.join(shard_offsets(manifest), "shard").repartition(n, "file", "block") \
        .mapInArrow(common.released(run), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)


def token_files(docs: DataFrame, path: str, end_id: int, out: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Encodes ``docs`` (doc_id, text), writes token files under ``out`` and returns what they hold.

    Null and empty texts hold the end id only; null doc_ids come first; repeated
    rows stay; an empty table gives an empty result; other columns are left out.  Texts are tokenized once; their ids
    wait in scratch, as the ranks need all of them counted first.
    """
    spark = docs.sparkSession
    out = out or common.scratch_dir(spark, "token-files")
    tokens = common.stored(tokenize(docs, path, end_id), "token-ids")
    write_tokens(tokens, out)
    return read_tokens(spark, out, keep_ids)
