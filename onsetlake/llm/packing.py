"""Best-fit packing of token sequences in bulk-synchronous rounds.

Pieces of one length are interchangeable, and so are open sequences with one
gap, so a round works on runs: (length, count) against (gap, first sequence,
count).  Both are range-sorted by size; a sweep over the sizes gives every
gap the longest unplaced piece that fits (its successor from the piece's side),
a piece run that meets a gap run is matched as far as the shorter one goes, and
gaps that were filled in part come back with their new size in the next round.
When no piece fits any gap, as many sequences are opened as the rest needs at
least, seeded with the longest pieces; long pieces go before short ones.

There are at most ``capacity`` lengths and gap sizes, so the runs are bounded by
a parameter and not by the data.  What grows with the data stays distributed:
counting lengths, ranking the pieces of one length (a range sort) and placing
each piece by its rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

_RANKS = 1 << 40  # pieces of one length that can be told apart
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than the capacity."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """One row a piece of every whole text (null: empty), ``end_id`` appended; ``ids`` too where asked for."""
    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.tokenizer(path)
        for batch in batches:
            for part in common.sliced(batch, tokens.SLICE_BYTES):
                rows: list[list] = [[], [], [], [], [], []]
                flat, sizes = encoder.encode_flat(common.texts_of(part.column("text")), end_id)
                whole, ends = memoryview(flat.astype("<u4").tobytes()), np.cumsum(sizes)
                for key, first, size in zip(part.column("doc_id").to_pylist(), (ends - sizes).tolist(), sizes.tolist()):
                    for k, (a, n) in enumerate(cut(size, capacity)):
                        ids = whole[4 * (first + a):4 * (first + a + n)]
                        for column, value in zip(rows, (key, k, a, n, zlib.crc32(ids), bytes(ids) if keep_ids else b"")):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
                columns = [pa.array(c, t) for c, t in zip(rows, kinds)]
                yield pa.RecordBatch.from_arrays(columns[:5 + keep_ids], names[:5 + keep_ids])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(common.released(run), PIECE + ", ids binary" * keep_ids)


def sweep(left: dict[int, int], placed: dict[int, int], gaps: list[tuple[int, int, int]],
          capacity: int, plan: list[tuple]) -> tuple[bool, list[tuple[int, int, int]]]:
    """One round: gaps in ascending order each take one piece, the longest left that fits.

    ``left``: pieces not yet placed, ``placed``: the next rank, both by length.
    Adds (length, first rank, count, first sequence, offset) to ``plan``.
    """
    lengths = sorted(length for length, n in left.items() if n)
    waiting: list[int] = []
    k, matched, after = 0, False, []
    for gap, first, count in sorted(gaps):
        while k < len(lengths) and lengths[k] <= gap:
            waiting.append(lengths[k])
            k += 1
        while count and waiting:
            length = waiting[-1]
            n = min(left[length], count)
            plan.append((length, placed[length], n, first, capacity - gap))
            placed[length] += n
            left[length] -= n
            if not left[length]:
                waiting.pop()
            if gap > length:
                after.append((gap - length, first, n))
            first, count, matched = first + n, count - n, True
        if count:
            after.append((gap, first, count))
    return matched, after


def plan_rounds(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """All rounds for so many pieces of each length: the plan and the number of sequences.

    Pieces longer than capacity / 2 go first, then those longer than
    capacity / 3, and so on: short pieces fill what long ones left.
    """
    left, placed = dict(counts), dict.fromkeys(counts, 0)
    plan: list[tuple] = []
    gaps: list[tuple[int, int, int]] = []
    n_sequences, share = 0, 1
    while any(left.values()):
        longest = max(length for length, n in left.items() if n)
        share = max(share, capacity // longest)  # so many of the longest fit into a sequence
        due = {length: n for length, n in left.items() if n and length * (share + 1) > capacity}
        matched = True
        while matched:
            before = dict(due)
            matched, gaps = sweep(due, placed, gaps, capacity, plan)
            for length in before:
                left[length] -= before[length] - due[length]
        opened = -(-sum(due.values()) // share)
        for length in sorted(due, reverse=True):
            n = min(due[length], opened)
            if n:
                plan.append((length, placed[length], n, n_sequences, 0))
                if length < capacity:
                    gaps.append((capacity - length, n_sequences, n))
                placed[length] += n
                left[length] -= n
                n_sequences += n
                opened -= n
        if not any(due.values()):
            share += 1
        smallest = min((length for length, n in left.items() if n), default=capacity + 1)
        gaps = [g for g in gaps if g[0] >= smallest]
    return plan, n_sequences


def ranked(df: DataFrame, length: str, *ties: str) -> tuple[DataFrame, dict[int, int], Callable[[pa.RecordBatch], np.ndarray]]:
    """``df`` numbered, the counts by length, and a function from a batch of it to each row's place among those of its length.

    A range sort deals a common length out over many tasks; one number a task reaches the driver.
    """
    spark = df.sparkSession
    order = [F.col(length), *[F.col(t).asc_nulls_first() for t in ties]]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            batch = batch.append_column("_task", pa.array(np.full(n, task, np.int32)))
            yield batch.append_column("_at", pa.array(np.arange(at, at + n)))
            at += n

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    numbered = common.stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                             .mapInArrow(common.released(number), schema + ", _task int, _at long"), "ranked")
    before, total = [], 0
    for r in numbered.groupBy("_task").count().orderBy("_task").collect():
        before.append((r["_task"], total))
        total += r["count"]
    counts = {r[0]: r[1] for r in numbered.groupBy(length).count().collect()}
    first, total = [], 0
    for value in sorted(counts):
        first.append((value, total))
        total += counts[value]
    tasks, lengths = np.array(before or [(0, 0)]), np.array(first or [(0, 0)])

    def rank(batch: pa.RecordBatch) -> np.ndarray:
        task, at = np.asarray(batch.column("_task")), np.asarray(batch.column("_at"))
        mine = np.asarray(batch.column(length))
        return tasks[np.searchsorted(tasks[:, 0], task), 1] + at - lengths[np.searchsorted(lengths[:, 0], mine), 1]

    return numbered, counts, rank


def assign(sized: DataFrame, capacity: int, *ties: str) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``length`` from 1 to ``capacity``."""
    rows, counts, rank_of = ranked(sized, "length", *ties)
    if max(counts.values(), default=0) >= _RANKS:
        raise ValueError(f"{max(counts.values())} pieces have one length; ranks tell {_RANKS} apart")
    plan, _ = plan_rounds(counts, capacity)
    runs = np.array(sorted(plan) or [(0, 0, 0, 0, 0)], np.int64)
    names = sized.columns
    keys = runs[:, 0] * _RANKS + runs[:, 1]

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        rank = rank_of(batch)
        k = np.searchsorted(keys, np.asarray(batch.column("length")) * _RANKS + rank, "right") - 1
        batch = batch.select(names)
        batch = batch.append_column("sequence_id", pa.array(runs[k, 3] + rank - runs[k, 1]))
        return batch.append_column("offset", pa.array(runs[k, 4]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema)
    return common.mapped(rows, schema + ", sequence_id long, offset long", place)


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Packs every text of ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids.

    One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and ``ids`` where asked for.  Empty and null texts are one id, the
    end id; null doc_ids and repeated rows are packed like any other; an empty
    table gives no rows; other columns are left out.
    """
    cut_up = common.stored(pieces(docs, path, end_id, capacity, keep_ids), "pieces")  # the range sort reads them twice
    return assign(cut_up, capacity, "doc_id", "ids_crc32", "piece")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from rows packed with ``keep_ids``; a group is at most one sequence.

    Pieces follow each other by offset; those without ids (ties at one offset can only be such) add nothing;
    an empty table gives no rows.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("parts")) \
        .select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
