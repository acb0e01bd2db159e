"""Removal of long byte strings that occur more than once, by a run-length index.

1. Every window of ``length`` bytes is given to the anchor in it: the place whose
   ``SEED``-byte hash is smallest (ties: the last).  Equal windows have equal
   anchors at equal offsets, so only windows with one anchor hash can be equal.
   The windows of one anchor form a stretch of text, its context; every window
   of the corpus lies in exactly one context.
2. Equal contexts are counted before anything is gathered; a context that
   occurs twice is repeated throughout, one whose anchor hash occurs in no other
   context is not.  What remains are contexts that share an anchor and differ.
   Of these the parts go on whose windows share the bytes around the anchor with another context.
3. Those are indexed by anchor in bounded batches: suffix order, Burrows-Wheeler
   transform in runs, and suffix positions sampled at run ends.  Within a run the
   longest match of a suffix with its neighbours shrinks by one a step, so only
   run ends are compared directly; streaming over the text gives the matching
   statistics, and places with matches of ``length`` or more are marked.
   An anchor with very many contexts is first split by the bytes that halves of
   its windows share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, SEED = 400, 32
SLICE_BYTES = 1 << 20
INDEX_BYTES = 2 << 20
PARTS = 8
MOST_CONTEXTS = 4096
_PLACE = 24


def anchors(buffer: np.ndarray, ends: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last): anchors of the windows of a buffer and the window starts that each one serves.

    ``ends``: per start the end of its text; windows that reach beyond are none.
    """
    n = len(buffer) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none
    h = buffer.astype(np.uint64) + np.uint64(1)
    width = 1
    multiplier = 0x9E3779B97F4A7C15
    while width < seed:
        step = min(width, seed - width)
        h = h[:-step] * np.uint64(multiplier) + h[step:]  # widths that are no powers of two hash overlapping halves
        multiplier = multiplier * 0xD1342543DE82EF95 % 2**64 | 1
        width += step
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    low = np.uint64((1 << _PLACE) - 1)
    least = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    done, window = 1, length - seed + 1
    while done < window:
        jump = min(done, window - done)
        least = np.minimum(least[:-jump], least[jump:])
        done += jump
    at = (low - (least & low)).astype(np.int64)
    inside = np.arange(n) + length <= ends[:n]
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1] | (ends[1:n] != ends[:n - 1])
    stop = inside.copy()
    stop[:-1] &= new[1:] | ~inside[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(stop)
    return h[at[first]], at[first], first, last


CONTEXTS = "_k1 long, _k2 long, anchor long, c1 long, c2 long, start long, size int, anchor_at int"


def contexts(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """One row a context of every whole text: its anchor's hash, its own 128-bit hash, its place in the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part in common.sliced(batch, SLICE_BYTES):
                buffer, at = common.text_buffer(part.column("text"))
                for a in range(0, len(buffer), 1 << (_PLACE - 1)):
                    piece = buffer[a:a + (1 << (_PLACE - 1)) + length - 1]
                    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[a:a + len(piece)]
                    hashes, place, first, last = anchors(piece, at[row + 1] - a, length, seed)
                    if not len(first):
                        continue
                    raw = piece.tobytes()
                    own = b"".join([digest(raw[x:y]) for x, y in zip(first.tolist(), (last + length).tolist())])
                    own = np.frombuffer(own, "<i8").reshape(-1, 2)
                    rows = pa.array(row[first])
                    yield pa.RecordBatch.from_pydict({
                        "_k1": part.column("_k1").take(rows), "_k2": part.column("_k2").take(rows),
                        "anchor": pa.array(hashes.view(np.int64)), "c1": pa.array(own[:, 0]), "c2": pa.array(own[:, 1]),
                        "start": pa.array(first + a - at[row[first]]),
                        "size": pa.array((last - first + length).astype(np.int32)),
                        "anchor_at": pa.array((place - first).astype(np.int32))})

    return keyed.select("_k1", "_k2", F.col("text").cast("string").alias("text")).mapInArrow(common.released(run), CONTEXTS)


def suffix_order(symbols: np.ndarray, n_separators: int) -> np.ndarray:
    """Start places of all suffixes in order.  Symbols below ``n_separators`` are separators, each its own symbol."""
    n, prefix = len(symbols), 7  # seven symbols of nine bits are one sort key; the last symbol is a separator
    separator = np.append(symbols < n_separators, np.ones(prefix, bool))
    small = np.where(separator, 0, np.append(symbols, np.zeros(prefix, symbols.dtype)) - n_separators + 1).astype(np.int64)
    key, tie = np.zeros(n, np.int64), np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for k in range(prefix):
        stop = separator[k:n + k] & ~ended
        tie[stop] = np.flatnonzero(stop) + k
        ended |= stop
        key = key * 512 + np.where(ended, 0, small[k:n + k])
    order = np.argsort(key)  # no order of equal keys is kept: further rounds settle them
    at = np.flatnonzero(ended[order])  # equal keys have all ended, after as many symbols, or none
    order[at] = order[at][np.lexsort((tie[order[at]], key[order[at]]))]
    # a rank is the first place of its suffixes in the order, so sorting the open ones leaves all others where they are
    fresh = np.append(True, (key[order[1:]] != key[order[:-1]]) | (tie[order[1:]] != tie[order[:-1]]))
    rank = np.empty(n + 1, np.int32 if n < 1 << 31 else np.int64)
    rank[-1] = -1  # beyond the last place
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    open_at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    places, step = order[open_at], prefix
    while len(open_at):
        two = rank[places].astype(np.int64) * (n + 1) + (rank[np.minimum(places + step, n)] + 1)
        sub = np.argsort(two)
        places, two = places[sub], two[sub]
        order[open_at] = places
        fresh = np.append(True, two[1:] != two[:-1])
        rank[places] = np.maximum.accumulate(np.where(fresh, open_at, 0))
        still = ~(fresh & np.append(fresh[1:], True))
        open_at, places = open_at[still], places[still]
        step *= 2
    return order


def common_lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of each pair of suffixes; separators differ from all else."""
    out = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    padded = np.append(symbols, np.full(16, -1, symbols.dtype))
    n = len(symbols)
    while len(active):
        x = a[active] + out[active]
        y = b[active] + out[active]
        same = np.ones(len(active), bool)
        grown = np.zeros(len(active), np.int64)
        for k in range(16):
            i, j = np.minimum(x + k, n), np.minimum(y + k, n)
            same &= (padded[i] == padded[j]) & (i < n) & (j < n)
            grown += same
        out[active] += grown
        active = active[same]
    return out


class RunIndex:
    """Burrows-Wheeler transform of some strings in runs, with suffix places sampled at both ends of each run."""

    def __init__(self, strings: list[bytes]):
        m = len(strings)
        sizes = np.fromiter(map(len, strings), np.int64, m)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.symbols = np.zeros(int(sizes.sum()) + m, np.int32)
        inside = np.ones(len(self.symbols), bool)
        inside[self.starts + sizes] = False
        self.symbols[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int32) + m
        self.symbols[~inside] = np.arange(m)
        order = suffix_order(self.symbols, m)
        before = self.symbols[order - 1]
        edge = before[1:] != before[:-1]
        self.heads = before[np.append(True, edge)]
        self.run_starts = order[np.append(True, edge)]
        self.run_ends = order[np.append(edge, True)]
        self.lengths = np.diff(np.append(np.flatnonzero(np.append(True, edge)), len(order)))

    def matching_statistics(self) -> np.ndarray:
        """Per place the length of its longest match with any other place, from comparisons at run ends alone."""
        shared = common_lengths(self.symbols, self.run_ends[:-1], self.run_starts[1:])
        n = len(self.symbols)
        best = np.zeros(n, np.int64)
        for places, values in ((self.run_starts, np.append(0, shared)), (self.run_ends, np.append(shared, 0))):
            reach = np.zeros(n, np.int64)
            reach[places] = places + values
            best = np.maximum(best, np.maximum.accumulate(reach) - np.arange(n))
        return best


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """Per string the places where ``length`` bytes start that also start elsewhere."""
    index = RunIndex(strings)
    marked = index.matching_statistics() >= length
    bounds = np.append(index.starts, len(index.symbols))
    return [np.flatnonzero(marked[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


RANGES = "array<struct<a: int, b: int>>"
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def ranges_of(starts: np.ndarray, length: int) -> list[dict]:
    """Bytes that the windows at ``starts`` cover, as ranges with exclusive ends (neighbouring starts joined)."""
    if not len(starts):
        return []
    edge = np.diff(starts) > 1
    first, last = starts[np.append(True, edge)], starts[np.append(edge, True)]
    return [{"a": a, "b": b} for a, b in zip(first.tolist(), (last + length).tolist())]


def _ids(*names: str) -> str:
    return ", ".join(f"{n} long" for n in names)


def shared_parts(rows: list[tuple[int, bytes, int]], length: int) -> list[tuple[int, int, int]]:
    """(row, start, end) of the parts of contexts whose windows may be elsewhere; ``rows``: anchor, context, place of the anchor in it.

    Windows that hold the anchor at nearly one offset share the bytes around it,
    and equal windows share them too.  Windows whose bytes no other context of the
    anchor has are thus alone.  A part has all windows that start in it, and no window is in two.
    """
    import xxhash

    width = max(length // PARTS, 1)
    seen: dict[tuple, int] = {}
    cores: list[list[tuple]] = []
    for anchor, text, place in rows:
        own = []
        for k in range((place - len(text) + length) // width, place // width + 1):  # offsets of the anchor, by ``width``
            a = place - k * width
            own.append((k, (anchor, k, xxhash.xxh3_64_intdigest(text[a:a - width + 1 + length]))))
        for _, core in own:
            seen[core] = seen.get(core, 0) + 1
        cores.append(own)
    out = []
    for row, ((_, text, place), own) in enumerate(zip(rows, cores)):
        begun = None  # the last of the neighbouring groups
        for k, core in reversed(own):  # from the context's start
            if seen[core] > 1:
                begun = k if begun is None else begun
            if begun is not None and (seen[core] == 1 or k == own[0][0]):
                last = k if seen[core] > 1 else k + 1
                out.append((row, max(place - (begun + 1) * width + 1, 0), min(place - last * width + length, len(text))))
                begun = None
    return out


def indexed(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, c1, c2, ranges) from (anchor, c1, c2, copies, bytes, anchor_at): index batches of whole anchors; no row without ranges."""
    def marks(rows: list[tuple]) -> pa.RecordBatch:
        parts = shared_parts([(r[0], r[4], r[5]) for r in rows], length)
        found = repeated_starts([rows[k][4][a:b] for k, a, b in parts], length) if parts else []
        starts: dict[int, list[np.ndarray]] = {}
        for (k, a, _), s in zip(parts, found):
            if len(s):
                starts.setdefault(k, []).append(s + a)
        ranges = {k: [{"a": 0, "b": len(r[4])}] if r[3] > 1 else ranges_of(np.concatenate(starts[k]), length)
                  for k, r in enumerate(rows) if r[3] > 1 or k in starts}
        ids = [pa.array([rows[k][i] for k in ranges], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*ids, pa.array(list(ranges.values()), _RANGES)], ["anchor", "c1", "c2", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "c1", "c2", "copies", "bytes", "anchor_at")]):
                if held and held[-1][:3] == row[:3]:
                    continue  # rows of repeated documents
                if size >= INDEX_BYTES and held[-1][0] != row[0]:
                    yield marks(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield marks(held)

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.select("anchor", "c1", "c2", "copies", "bytes", "anchor_at").repartition(n, "anchor") \
        .sortWithinPartitions("anchor", "c1", "c2").mapInArrow(common.released(run), f"{_ids('anchor', 'c1', 'c2')}, ranges {RANGES}")


def halves(texts: DataFrame, length: int) -> DataFrame:
    """Each context cut into those of its windows that hold the anchor late and those that hold it early.

    A half's new anchor is the hash of the bytes that all windows of the half
    share; ``at`` is its place in the context (p1, p2, p3) that it came from.
    """
    names = ("anchor", "c1", "c2", "copies", "bytes", "anchor_at", "low", "high")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        rows = []
        for anchor, c1, c2, copies, text, place, low, high in zip(*[batch.column(c).to_pylist() for c in names]):
            middle = (low + high + 1) // 2
            for a, b in ((low, middle), (middle, high)):  # offsets of the anchor in the window, end exclusive
                start, stop = place - min(b - 1, place), min(place - a, len(text) - length)
                if start > stop:
                    continue
                part = text[start:stop + length]
                core = text[place - a:place - (b - 1) + length]
                own = np.frombuffer(xxhash.xxh3_128_digest(part), "<i8").tolist()
                key = xxhash.xxh3_64_intdigest(core, seed=(anchor + a) % 2**63) - 2**63
                rows.append({"anchor": key, "c1": own[0], "c2": own[1], "copies": copies, "bytes": part,
                             "anchor_at": place - start, "low": a, "high": b, "p1": anchor, "p2": c1, "p3": c2, "at": start})
        return pa.RecordBatch.from_pylist(rows, schema=HALVES)

    return common.mapped(texts.select(*names), f"{TEXTS}, {_ids('p1', 'p2', 'p3')}, at int", run)


TEXTS = f"{_ids('anchor', 'c1', 'c2', 'copies')}, bytes binary, anchor_at int, low int, high int"
HALVES = pa.schema([*[(n, pa.int64()) for n in ("anchor", "c1", "c2", "copies")], ("bytes", pa.binary()),
                    *[(n, pa.int32()) for n in ("anchor_at", "low", "high")],
                    *[(n, pa.int64()) for n in ("p1", "p2", "p3")], ("at", pa.int32())])


def marks_of(texts: DataFrame, length: int, most: int) -> DataFrame:
    """(anchor, c1, c2, ranges) of distinct contexts; anchors with more than ``most`` are halved first, again and again."""
    ids = ["anchor", "c1", "c2"]
    kinds = texts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max(F.col("high") - F.col("low")).alias("wide"))
    small = texts.join(kinds.where((F.col("kinds") > 1) & (F.col("kinds") <= most)), "anchor", "left_semi")
    whole = texts.join(kinds.where("kinds = 1"), "anchor", "left_semi").where("copies > 1") \
        .select(*ids, F.array(F.struct(F.lit(0).alias("a"), F.length("bytes").alias("b"))).cast(RANGES).alias("ranges"))
    done = indexed(small, length).unionByName(whole)
    large = kinds.where(F.col("kinds") > most)
    if large.isEmpty():
        return done
    parts = common.stored(halves(texts.join(large, "anchor", "left_semi"), length), "halves")
    links = parts.select(*ids, "p1", "p2", "p3", "at")
    distinct = parts.groupBy(*ids).agg(F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in
                                                                        ("bytes", "anchor_at", "low", "high")])
    below = marks_of(common.stored(distinct, "half-contexts"), length, most)
    shift = F.transform("ranges", lambda r: F.struct((r.a + F.col("at")).alias("a"), (r.b + F.col("at")).alias("b")))
    up = links.join(below, ids).select(F.col("p1").alias("anchor"), F.col("p2").alias("c1"), F.col("p3").alias("c2"),
                                       shift.cast(RANGES).alias("ranges")) \
        .groupBy(*ids).agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return done.unionByName(up)


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def deduplicated(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", seed: int = SEED, most: int = MOST_CONTEXTS) -> DataFrame:
    """One row a document: key, n_bytes, spans (removed byte ranges, ends exclusive) and kept (the other bytes).

    A byte goes if it lies in a string of ``length`` bytes that also starts
    anywhere else in the corpus, overlaps included.  Null texts are empty and
    lose nothing; repeated rows are copies of each other and all stay as rows;
    an empty table gives no rows; other columns are left out.
    """
    common.bounded_batches(docs.sparkSession)
    ids = ["anchor", "c1", "c2"]
    keyed = common.with_row_key(docs.select(key, "text"), key, "text")
    found = common.stored(contexts(keyed, length, seed), "contexts")
    distinct = common.stored(found.groupBy(*ids).agg(
        F.count("*").alias("copies"), F.min(F.struct("_k1", "_k2", "start", "size", "anchor_at")).alias("place")), "distinct")
    shared = distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    asked = distinct.join(shared, "anchor", "left_semi") \
        .groupBy("place._k1", "place._k2").agg(F.collect_list(F.struct(*ids, "copies", "place.start", "place.size", "place.anchor_at")).alias("asked"))

    def fetch(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, wanted in zip(common.texts_of(batch.column("text")), batch.column("asked").to_pylist()):
            raw = text.encode()
            rows += [{**{n: w[n] for n in ("anchor", "c1", "c2", "copies", "anchor_at")},
                      "bytes": raw[w["start"]:w["start"] + w["size"]], "low": 0, "high": length - seed + 1} for w in wanted]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(HALVES)[:8]))

    texts = keyed.select("_k1", "_k2", F.col("text").cast("string").alias("text")).join(asked, ["_k1", "_k2"])
    texts = common.mapped(texts, TEXTS, fetch).dropDuplicates(ids)
    marks = marks_of(common.stored(texts, "shared-contexts"), length, most)
    alone = distinct.join(shared, "anchor", "left_anti").where("copies > 1").select(
        *ids, F.array(F.struct(F.lit(0).alias("a"), F.col("place.size").alias("b"))).cast(RANGES).alias("ranges"))
    ranged = marks.unionByName(alone).where(F.size("ranges") > 0)
    here = F.transform("ranges", lambda r: F.struct((r.a + F.col("start")).alias("a"), (r.b + F.col("start")).alias("b")))
    spans = found.join(ranged, ids).select("_k1", "_k2", here.alias("spans")) \
        .groupBy("_k1", "_k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, kept, gone = [], [], []
        for text, spans in zip(common.texts_of(batch.column("text")), batch.column("spans").to_pylist()):
            raw = text.encode()
            runs = merged(spans or [])
            bounds = [0, *(x for r in runs for x in r), len(raw)]
            sizes.append(len(raw))
            kept.append(b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            gone.append([{"a": a, "b": b} for a, b in runs])
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(sizes, pa.int64()), pa.array(gone, kind),
                                           pa.array(kept, pa.binary())], [key, "n_bytes", "spans", "kept"])

    name = docs.schema[key].dataType.simpleString()
    joined = keyed.join(spans, ["_k1", "_k2"], "left").select(key, F.col("text").cast("string").alias("text"), "spans")
    return common.mapped(joined, f"`{key}` {name}, n_bytes long, spans array<struct<a: long, b: long>>, kept binary", cut)
