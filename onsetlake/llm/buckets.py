"""Packing by powers of two: each document falls into pieces of binary length, and pieces of one length share a bucket.

A document of n ids gives ``n // capacity`` pieces of the whole capacity and then one
piece for each binary digit of the rest, long ones first.  Each piece is a sequence of
its own at offset 0, so no sequence crosses documents, and as every length is a power
of two, nothing is padded.  Sequences are numbered bucket by bucket by a range sort, which
deals a common length out over many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, packing, tokens

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def binary_pieces(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with so many ids."""
    digits = capacity >> np.arange(1, capacity.bit_length())
    whole = sizes // capacity
    held = (sizes[:, None] & digits) > 0
    n = whole + held.sum(1)
    doc = np.repeat(np.arange(len(sizes)), n)
    length = np.full(len(doc), capacity, np.int64)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) >= whole[doc]
    length[inner] = np.broadcast_to(digits, held.shape)[held]
    ends = np.cumsum(length)
    first = np.concatenate([[0], ends])[np.cumsum(n) - n]
    return doc, ends - length - first[doc], length


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """One row a piece of every whole text (null: empty), ``end_id`` appended; ``ids`` too where asked for."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two, not {capacity}")
    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.tokenizer(path)
        for batch in batches:
            for part in common.sliced(batch, tokens.SLICE_BYTES):
                flat, sizes = encoder.encode_flat(common.texts_of(part.column("text")), end_id)
                doc, start, length = binary_pieces(sizes, capacity)
                raw = memoryview(flat.astype("<u4").tobytes())
                ends = (4 * np.cumsum(length)).tolist()  # pieces follow one another as the ids do
                parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
                columns = [part.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                           pa.array(list(map(zlib.crc32, parts)), pa.int64()), pa.array(sizes[doc])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns.append(pa.array(list(map(bytes, parts)), pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(common.released(run), PIECE + ", ids binary" * keep_ids)


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Packs every text of ``docs`` (doc_id, text) into sequences whose lengths are powers of two up to ``capacity``.

    One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (always 0) and, where asked for, ``ids``.  Sequences of one length
    have successive numbers, short ones first.  Empty and null texts are one id, the end id; null
    doc_ids and repeated rows are packed like any other; an empty table gives
    no rows; other columns are left out.  doc_ids that are no whole numbers raise an error.
    """
    cut = common.stored(pieces(docs, path, end_id, capacity, keep_ids), "binary-pieces")  # the range sort reads them twice
    rows, counts, rank_of = packing.ranked(cut, "length", "doc_id", "start", "ids_crc32")
    lengths = np.array(sorted(counts) or [0], np.int64)  # as many as the capacity has digits
    names = cut.columns
    first = np.cumsum([0, *(counts[x] for x in sorted(counts))])

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = first[np.searchsorted(lengths, np.asarray(batch.column("length")))] + rank_of(batch)
        return batch.select(names).append_column("sequence_id", pa.array(at)) \
            .append_column("offset", pa.array(np.zeros(len(at), np.int64)))

    return common.mapped(rows, PIECE + ", ids binary" * keep_ids + ", sequence_id long, offset long", place)


def write_buckets(packed: DataFrame, out: str) -> None:
    """Writes rows packed with ``keep_ids`` as Parquet, a folder for each length, in the order of their numbers."""
    n = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed.repartitionByRange(n, "length", "sequence_id").sortWithinPartitions("length", "sequence_id") \
        .write.partitionBy("length").parquet(out)
