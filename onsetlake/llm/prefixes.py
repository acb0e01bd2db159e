"""Prefix trie of conversations from hashes of blocks of turns.

1. Turns are numbered by a range sort: tasks number their own rows, and one count a
   task carries over to the next, so a conversation may span any number of tasks.
2. ``BLOCK`` turns are a block.  The digest of a block is the sum of its turns' digests
   times ``BASE`` to the power of their depth, modulo ``PRIME``; digests of the blocks of a
   conversation add up to the key of its prefix, again with one carry a task.
3. Conversations are grouped by their keys before and after a block.  Where one block follows
   a prefix, its turns are a chain of nodes with the members of the block.  Only where
   siblings diverge are blocks opened and grouped by turn.
4. Sums over a subtree are sums over its members, conversation by conversation: a
   node belongs to its smallest member, a conversation's own nodes are the
   last ones of its path, and so a conversation adds to each node on its path the same numbers, but
   for the smallest member, whose share follows from the code points before the node.

What meets in a group is at most a block; all else is partial aggregates and joins
with one row a key on one side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BLOCK = 4
SHARED = 5  # the most turns that a rebuilt conversation takes from another
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
ROOT = bytes(16)
CHUNK = 1 << 20


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, k, chars): a digest of role and text, whose nulls become empty, and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(named)).alias("k"), F.char_length(text).cast("long").alias("chars"))


def shared_turns(conv: F.Column) -> F.Column:
    """How many turns a conversation takes from the first of its hundred."""
    return F.crc32(conv.cast("string").cast("binary")) % (SHARED + 1)


def _order() -> list:
    return [F.col("conv_id"), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("k")]


def heads_of(turns: DataFrame) -> DataFrame:
    """(conv_id, h, given): every conversation with the first turns that it takes, at most ``SHARED``."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "k"))
    # Spark cuts each task's rows of a conversation down to SHARED before they are shuffled
    first = turns.where(F.col("conv_id") % 100 == 0).withColumn("i", place).where(F.col("i") <= SHARED) \
        .groupBy(F.col("conv_id").alias("giver")).agg(F.array_sort(F.collect_list(F.struct("i", "k", "chars"))).alias("first"))
    convs = turns.select("conv_id").distinct().withColumn("giver", F.col("conv_id") - F.col("conv_id") % 100) \
        .withColumn("h", shared_turns(F.col("conv_id")))
    given = F.expr("coalesce(filter(first, x -> x.i <= h), array())")
    return convs.join(first, "giver", "left").select("conv_id", "h", given.alias("given"))


def numbered(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """(conv_id, d, k, chars): the turns of the rebuilt conversations with their depths from 1."""
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = heads.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(b"").alias("k"),
                         F.lit(0).cast("long").alias("chars"), F.size("given").cast("long").alias("p"))
    rows = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "k", "chars", F.lit(None).cast("long").alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, p, i = TaskContext.get().partitionId(), None, 0  # turns given to the conversation at hand, rows of it so far
        for batch in batches:
            kind = np.asarray(batch.column("kind"))
            at = np.arange(len(kind))
            last = np.maximum.accumulate(np.where(kind == 0, at, -1))
            index = np.where(last >= 0, at - last - 1, i + at)
            given = np.asarray(batch.column("p").fill_null(0))
            own = np.where(last >= 0, given[np.maximum(last, 0)], -1 if p is None else p)
            p, i = (int(own[-1]) if own[-1] >= 0 else None), int(index[-1]) + 1
            kept = pa.array(kind == 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(kind), task, np.int32)).filter(kept), batch.column("conv_id").filter(kept),
                pa.array(own, mask=own < 0).filter(kept), pa.array(index).filter(kept),
                batch.column("k").filter(kept), batch.column("chars").filter(kept)], ["task", "conv_id", "p", "i", "k", "chars"])
        yield pa.RecordBatch.from_pylist([{"task": task, "p": p, "i": i}], _NUMBERED)

    found = common.stored(marks.unionByName(rows).repartitionByRange(n, *_order()).sortWithinPartitions(*_order())
                          .mapInArrow(common.released(run), "task int, conv_id long, p long, i long, k binary, chars long"), "turns")
    carried, p, i = [], 0, 0
    for r in found.where("conv_id is null").select("task", "p", "i").orderBy("task").collect():  # one row a task
        carried.append((r.task, p, i))
        p, i = (p, i + r.i) if r.p is None else (r.p, r.i)
    carry = spark.createDataFrame(carried, "task int, cp long, ci long")
    h = shared_turns(F.col("conv_id"))
    begun = F.col("p").isNotNull()
    own = found.where("conv_id is not null").join(F.broadcast(carry), "task") \
        .withColumn("i", F.when(begun, F.col("i")).otherwise(F.col("ci") + F.col("i"))) \
        .withColumn("p", F.coalesce("p", "cp")).where(F.col("i") >= h) \
        .select("conv_id", (F.col("p") + F.col("i") - h + 1).alias("d"), "k", "chars")
    given = heads.select("conv_id", F.explode("given").alias("x")) \
        .select("conv_id", F.col("x.i").cast("long").alias("d"), F.col("x.k").alias("k"), F.col("x.chars").alias("chars"))
    return own.unionByName(given)


_NUMBERED = pa.schema([("task", pa.int32()), ("conv_id", pa.int64()), ("p", pa.int64()), ("i", pa.int64()), ("k", pa.binary()),
                       ("chars", pa.int64())])


def blocks_of(turns: DataFrame) -> DataFrame:
    """One row a block: conv_id, b, m (its turns), prev and key (prefix keys), before and after (code points so far), inner.

    ``inner`` lists each turn's key and code points so far.
    """
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = turns.withColumn("b", F.floor((F.col("d") - 1) / BLOCK).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows: list[dict] = []
        at = None  # conversation and block at hand
        key = power = chars = 0
        loose = True  # whether the conversation began in an earlier task
        for batch in batches:
            for conv, b, d, k, c in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "b", "d", "k", "chars")]):
                if at is None or at[0] != conv:
                    key, chars, power, loose = 0, 0, pow(BASE, d, PRIME), d != 1
                if at != (conv, b):
                    at = conv, b
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, _BLOCKS)
                        rows = []
                    rows.append({"task": task, "loose": loose, "conv_id": conv, "b": b, "m": 0, "prev": key.to_bytes(16, "big"),
                                 "key": b"", "before": chars, "after": 0, "inner": []})
                key = (key + (1 + int.from_bytes(k, "big") % (PRIME - 1)) * power) % PRIME
                chars += c
                power = power * BASE % PRIME
                row, name = rows[-1], key.to_bytes(16, "big")
                row["m"] += 1
                row["key"], row["after"] = name, chars
                row["inner"].append({"h": name, "c": chars})
        rows.append({"task": task, "loose": loose, "b": 0, "m": 0, "prev": ROOT, "key": key.to_bytes(16, "big"), "before": 0,
                     "after": chars})
        yield pa.RecordBatch.from_pylist(rows, _BLOCKS)

    found = common.stored(placed.repartitionByRange(n, "conv_id", "b").sortWithinPartitions("conv_id", "d")
                          .mapInArrow(common.released(run), BLOCKS), "blocks")
    carried, key, chars = {}, 0, 0
    for r in found.where("conv_id is null").select("task", "loose", "key", "after").orderBy("task").collect():  # one row a task
        carried[r.task] = key, chars
        own = int.from_bytes(r.key, "big")
        key, chars = ((key + own) % PRIME, chars + r.after) if r.loose else (own, r.after)

    def shifted(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        for row in rows:
            key, chars = carried[row["task"]]

            def moved(name: bytes) -> bytes:
                return ((int.from_bytes(name, "big") + key) % PRIME).to_bytes(16, "big")

            row |= {"prev": moved(row["prev"]), "key": moved(row["key"]), "before": row["before"] + chars, "after": row["after"] + chars,
                    "inner": [{"h": moved(x["h"]), "c": x["c"] + chars} for x in row["inner"]]}
        return pa.RecordBatch.from_pylist(rows, _BLOCKS)

    whole = found.where("conv_id is not null")
    return whole.where("not loose").unionByName(common.mapped(whole.where("loose"), BLOCKS, shifted)).drop("task", "loose")


BLOCKS = "task int, loose boolean, conv_id long, b long, m int, prev binary, key binary, before long, after long, " \
         "inner array<struct<h: binary, c: bigint>>"
_BLOCKS = pa.schema([("task", pa.int32()), ("loose", pa.bool_()), ("conv_id", pa.int64()), ("b", pa.int64()), ("m", pa.int32()),
                     ("prev", pa.binary()), ("key", pa.binary()), ("before", pa.int64()), ("after", pa.int64()),
                     ("inner", pa.list_(pa.struct([("h", pa.binary()), ("c", pa.int64())])))])

PATH = ["prev", "key", "b", "m"]


def paths_of(blocks: DataFrame) -> DataFrame:
    """Different blocks after each prefix, with ``inner``, ``before`` and whether siblings diverge there."""
    paths = common.stored(blocks.groupBy(*PATH).agg(F.first("before").alias("before"), F.first("inner").alias("inner")), "paths")
    siblings = paths.groupBy("prev", "b").agg((F.count("*") > 1).alias("diverge"))
    return common.stored(paths.join(siblings, ["prev", "b"]), "sibling-paths")


def nodes_of(paths: DataFrame, folds: dict[str, Callable[[], F.Column]]) -> DataFrame:
    """(h, d, up, cex, c, ...) of every node but the root; ``folds``: how the other columns add up where blocks are opened."""
    inside = F.expr(f"inline(transform(inner, (x, i) -> named_struct('h', x.h, 'd', b * {BLOCK} + i + 1, "
                    "'up', if(i = 0, prev, get(inner, i - 1).h), 'cex', if(i = 0, before, get(inner, i - 1).c), 'c', x.c)))")
    chains = paths.where("not diverge").select(inside, *folds)
    opened = paths.where("diverge").select(inside, *folds).groupBy("h", "d").agg(
        F.first("up").alias("up"), F.first("cex").alias("cex"), F.first("c").alias("c"), *[f().alias(x) for x, f in folds.items()])
    return chains.unionByName(opened)


def members(blocks: DataFrame, heads: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each conversation adds to the nodes on its path, and how many children each node has.

    (conv_id, end_key, n_turns, total, own, shared, leaf): code points of all its turns, of those whose nodes
    belong to it and of the others, and 1 if it is the smallest of a childless node.
    """
    low = blocks.groupBy(*PATH).agg(F.min("conv_id").alias("low"))
    nodes = common.stored(nodes_of(paths.join(low, PATH), {"low": lambda: F.min("low")}), "nodes")
    kids = common.stored(nodes.groupBy(F.col("up").alias("h"), (F.col("d") - 1).alias("d")).agg(F.count("*").alias("n_children")), "children")
    own = nodes.join(kids, ["h", "d"], "left").groupBy(F.col("low").alias("conv_id")).agg(
        F.sum(F.col("c") - F.col("cex")).alias("own"), F.count_if(F.col("n_children").isNull()).alias("leaf"))
    ends = blocks.groupBy("conv_id").agg(F.max(F.struct("b", "m", "key", "after")).alias("e"))
    empty = F.lit(0).cast("long")
    found = heads.select("conv_id").join(ends, "conv_id", "left").join(own, "conv_id", "left").select(
        "conv_id", F.coalesce("e.key", F.lit(ROOT)).alias("end_key"),
        F.coalesce(F.col("e.b") * BLOCK + F.col("e.m"), empty).alias("n_turns"), F.coalesce("e.after", empty).alias("total"),
        F.coalesce("own", empty).alias("own"), F.coalesce("leaf", empty).alias("leaf")) \
        .withColumn("shared", F.col("total") - F.col("own"))
    return common.stored(found, "members"), kids


def end_digests(convs: DataFrame) -> DataFrame:
    """(h, d, ends_sha256): SHA-256 of the ids of the conversations that end at a node, in order, with commas between.

    Ids are range-sorted by node, and streamed.  What a task holds of its first
    and last node, and of long lists, goes on as pieces of text, which are then
    hashed in order as they stream by.
    """
    n = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["h", "d", "conv_id"]

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, node, ids, size, whole, part = TaskContext.get().partitionId(), None, [], 0, False, 0
        rows: list[dict] = []

        def closed(last: bool) -> dict:
            text = ",".join(ids).encode()
            if whole and not last:
                return {"h": node[0], "d": node[1], "sha": hashlib.sha256(text).hexdigest()}
            return {"h": node[0], "d": node[1], "task": task, "part": part, "piece": text}

        for batch in batches:
            for h, d, conv in zip(*[batch.column(c).to_pylist() for c in order]):
                if node != (h, d):
                    if node:
                        rows.append(closed(False))
                    whole, node, ids, size, part = node is not None, (h, d), [], 0, 0
                elif size > CHUNK:
                    whole = False
                    rows.append(closed(False))
                    ids, size, part = [], 0, part + 1
                ids.append(str(conv))
                size += len(ids[-1])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ENDS)
                rows = []
        if node:
            yield pa.RecordBatch.from_pylist([closed(True)], _ENDS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            for h, d, piece in zip(*[batch.column(c).to_pylist() for c in ("h", "d", "piece")]):
                if node != (h, d):
                    if node:
                        yield pa.RecordBatch.from_pylist([{"h": node[0], "d": node[1], "sha": digest.hexdigest()}], _ENDS).select([0, 1, 2])
                    node, digest = (h, d), hashlib.sha256(piece)
                else:
                    digest.update(b"," + piece)
        if node:
            yield pa.RecordBatch.from_pylist([{"h": node[0], "d": node[1], "sha": digest.hexdigest()}], _ENDS).select([0, 1, 2])

    found = common.stored(convs.select(F.col("end_key").alias("h"), F.col("n_turns").alias("d"), "conv_id")
                          .repartitionByRange(n, *order).sortWithinPartitions(*order)
                          .mapInArrow(common.released(gathered), "h binary, d long, sha string, task int, part int, piece binary"), "ends")
    pieces = found.where("piece is not null").repartition(n, "h", "d").sortWithinPartitions("h", "d", "task", "part")
    return found.where("sha is not null").select("h", "d", "sha") \
        .unionByName(pieces.mapInArrow(common.released(hashed), "h binary, d long, sha string")) \
        .withColumnRenamed("sha", "ends_sha256")


_ENDS = pa.schema([("h", pa.binary()), ("d", pa.int64()), ("sha", pa.string()), ("task", pa.int32()), ("part", pa.int32()),
                   ("piece", pa.binary())])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row a node of the trie of all rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  A conversation
    is rebuilt from the first turns of the first of its hundred and its own later
    ones.  Turns are ordered by ``turn``, null first, ties by the digest of role
    and text; repeated rows are turns like any other; null roles and texts are
    empty ones; rows without a conv_id are left out, and so are other columns.
    A table without a conversation gives no rows.
    """
    common.bounded_batches(conversations.sparkSession)
    turns = common.stored(turns_of(conversations), "turn-digests")
    heads = common.stored(heads_of(turns), "heads")
    blocks = blocks_of(numbered(turns, heads))
    paths = paths_of(blocks)
    convs, kids = members(blocks, heads, paths)
    adds = {"n": lambda: F.sum("n"), "total": lambda: F.sum("total"), "own": lambda: F.sum("own"), "leaf": lambda: F.sum("leaf"),
            "shared": lambda: F.min_by("shared", "low"), "low": lambda: F.min("low")}
    first = {**adds, "n": lambda: F.count("*"), "shared": lambda: F.min_by("shared", "conv_id"), "low": lambda: F.min("conv_id")}
    aggregates = [f().alias(x) for x, f in first.items()]
    sums = blocks.select("conv_id", *PATH).join(convs, "conv_id").groupBy(*PATH).agg(*aggregates)
    root = convs.groupBy().agg(*aggregates).where("n > 0").select(
        F.lit(ROOT).alias("h"), F.lit(0).cast("long").alias("d"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("cex"), *first)
    nodes = common.stored(nodes_of(paths.join(sums, PATH), adds).drop("c").unionByName(root), "node-sums")
    parents = nodes.select(F.col("h").alias("up"), (F.col("d") + 1).alias("d"), F.col("low").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    cex = F.col("cex")
    return nodes.join(parents, ["up", "d"], "left").join(kids, ["h", "d"], "left").join(end_digests(convs), ["h", "d"], "left").select(
        F.col("low").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), F.col("leaf").alias("n_leaves"),
        (F.col("total") - F.col("n") * cex - F.col("own") - F.col("shared") + cex).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
