"""Line dedup by content-defined chunks.

A rolling hash over the last ``window`` line hashes ends a chunk wherever it
falls into one of ``divisor`` classes, so boundaries depend on the lines nearby
and survive lines put in or taken out before them.  A chunk of two lines or more
that occurs anywhere before (smaller key, then earlier place) is removed after
its bytes were compared with those of the first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, DIVISOR, LEAST_LINES = 2, 2, 2
_MIX = 0x9E3779B97F4A7C15


def chunk_ends(hashes: list[int], worded: list[bool], window: int, divisor: int, least: int) -> list[int]:
    """Line numbers, exclusive, at which chunks end; ``worded``: whether a line holds a word.

    The hash rolls: the line that leaves the window is taken out of it and the
    new one added.  Chunks have ``least`` lines with words or more, and a rest
    with fewer belongs to the chunk before, so only a text with fewer has such a chunk.
    """
    ends, rolling, n = [], 0, 0
    for i, h in enumerate(hashes):
        rolling = rolling * _MIX + h
        if i >= window:
            rolling -= hashes[i - window] * pow(_MIX, window, 1 << 64)
        rolling %= 1 << 64
        n += worded[i]
        if i + 1 >= window and n >= least and (rolling * _MIX >> 32) % divisor == 0:
            ends.append(i + 1)
            n = 0
    if ends and n < least:
        ends.pop()
    if hashes and (not ends or ends[-1] < len(hashes)):
        ends.append(len(hashes))
    return ends


def chunks(text: str, window: int = WINDOW, divisor: int = DIVISOR, least: int = LEAST_LINES) -> list[bytes]:
    """The chunks of a text, each its lines joined by line ends; joined by line ends they are the text."""
    import xxhash

    lines = text.encode().split(b"\n")
    at, out = 0, []
    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
    for end in chunk_ends(hashes, [bool(line.split()) for line in lines], window, divisor, least):
        out.append(b"\n".join(lines[at:end]))
        at = end
    return out


def removable(chunk: bytes, least: int) -> bool:
    """A chunk counts as multi-line if so many of its lines hold a word."""
    return sum(bool(line.split()) for line in chunk.split(b"\n")) >= least


CHUNKS = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("place", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])


def duplicates(keyed: DataFrame, key: str, window: int, divisor: int, least: int) -> DataFrame:
    """(_k1, _k2, gone: places of chunks to remove) of documents that repeat earlier chunks."""
    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        rows = [[], [], [], []]
        for k, text in enumerate(common.texts_of(batch.column("text"))):
            for place, chunk in enumerate(chunks(text, window, divisor, least)):
                if removable(chunk, least):
                    h = np.frombuffer(xxhash.xxh3_128_digest(chunk), "<i8")
                    for column, value in zip(rows, (k, place, int(h[0]), int(h[1]))):
                        column.append(value)
        row = pa.array(rows[0], pa.int64())
        ids = [batch.column(c).take(row) for c in ("_k1", "_k2", key)]
        return pa.RecordBatch.from_arrays([*ids, pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())],
                                          ["_k1", "_k2", key, "place", "h1", "h2"])

    texts = keyed.select("_k1", "_k2", key, F.col("text").cast("string").alias("text"))
    kind = keyed.schema[key].dataType.simpleString()
    found = common.stored(common.mapped(texts, f"_k1 long, _k2 long, `{key}` {kind}, place int, h1 long, h2 long", find).distinct(), "chunks")
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), "_k1", "_k2", "place")
    first = found.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(order).alias("first")).where("times > 1")
    again = found.join(first, ["h1", "h2"]).withColumn("is_first", order == F.col("first"))
    asked = again.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("place", "h1", "h2", "is_first")).alias("asked"))

    def fetch(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for k1, k2, text, wanted in zip(*[batch.column(c).to_pylist() for c in ("_k1", "_k2", "text", "asked")]):
            own = chunks(text or "", window, divisor, least)
            rows += [{"_k1": k1, "_k2": k2, **w, "bytes": own[w["place"]]} for w in wanted]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([*CHUNKS, ("is_first", pa.bool_()), ("bytes", pa.binary())]))

    bodies = common.mapped(texts.drop(key).dropDuplicates(["_k1", "_k2"]).join(asked, ["_k1", "_k2"]),
                           "_k1 long, _k2 long, place int, h1 long, h2 long, is_first boolean, bytes binary", fetch)
    bodies = common.stored(bodies, "chunk-bytes")
    originals = bodies.where("is_first").select("h1", "h2", F.col("bytes").alias("original"))
    same = bodies.where("not is_first").join(originals, ["h1", "h2"]).where("bytes = original")
    return same.groupBy("_k1", "_k2").agg(F.collect_list("place").alias("gone"))


def deduplicated(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, divisor: int = DIVISOR,
                 least: int = LEAST_LINES) -> DataFrame:
    """All rows and columns of ``docs``, with n_chunks, n_removed (chunks) and ``text`` without the removed chunks.

    Of equal multi-line chunks the one of the smallest key (nulls last; ties:
    by the text, then the place) stays.  Rows equal in key and text are one document
    here and share the outcome.  Null texts stay null, empty ones empty; an
    empty table gives no rows.  Columns named n_chunks or n_removed are replaced.
    """
    common.bounded_batches(docs.sparkSession)
    keyed = common.with_row_key(docs, key, "text")
    gone = duplicates(keyed, key, window, divisor, least)
    names = [c for c in docs.columns if c not in ("n_chunks", "n_removed")]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, sizes, removed = [], [], []
        for text, drop in zip(batch.column("text").to_pylist(), batch.column("_gone").to_pylist()):
            own = chunks(text, window, divisor, least) if text is not None else []
            if drop:
                drop = set(drop)
                text = b"\n".join(c for k, c in enumerate(own) if k not in drop).decode()
            texts.append(text)
            sizes.append(len(own))
            removed.append(len(drop or ()))
        columns = {n: batch.column(n) for n in names}
        columns["text"] = pa.array(texts, columns["text"].type)
        return pa.RecordBatch.from_pydict({**columns, "n_chunks": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64())})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    joined = keyed.join(gone.withColumnRenamed("gone", "_gone"), ["_k1", "_k2"], "left").select(*names, "_gone")
    return common.mapped(joined, kinds + ", n_chunks long, n_removed long", cut)
