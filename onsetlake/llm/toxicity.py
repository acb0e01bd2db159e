"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

1. Examples are a bounded sample of the labelled rows by the hash of their ids: of either
   class ``examples`` rows and ``example_bytes`` bytes of text at most (one text at
   least).  Votes are weighted back to the classes' true sizes.
2. Terms are the examples' words and the first ``beginning`` bytes of longer ones, known by 64-bit
   names; a term weighs ``1 + log(count)`` times its inverse frequency over all documents.
3. The index keeps the largest weight of every term in each block of ``BLOCK`` examples: rare
   terms have postings grouped by block, common ones a dense matrix, multiplied at once.  A query adds
   the rare terms' bounds of all blocks to the most that the common ones give there, scores the best
   blocks, and then all whose bound reaches its k-th best cosine, so the nearest examples are exact.
4. A neighbour's vote weighs by its distance and by the part of its cosine that comes from terms that
   go with the label (chi squared over the number of examples, so alike at any size).
   A monotone map turns votes into scores.  It is fitted on the examples, each voted on by the others,
   as if it had not been among them.

The examples are bounded by parameters, and so is their index; it is shipped as plain arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .decontam import word_table

BLOCK = 64
COMMON = 16
SLAB = 1 << 16
FIRST = 4
QUERIES = 16


@dataclass(frozen=True)
class Settings:
    """``prior``: weight of the base rate in a vote; ``evidence``: voters that are returned, those with the most weight."""

    examples: int = 2048
    example_bytes: int = 16 << 20
    neighbours: int = 100
    evidence: int = 10
    beginning: int = 7
    prior: float = 0.01


def names_of(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit names of byte strings: the bytes and their number where these fit, else a hash of eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
    shifts = np.arange(0, 64, 8, dtype=np.uint64)

    def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        # each shifted byte keeps its bits apart, so their sum is their union
        return (padded[at[:, None] + np.arange(8)].astype(np.uint64) << shifts).sum(1, dtype=np.uint64) & masks[np.minimum(left, 8)]

    out = eight(first, sizes) | (sizes.astype(np.uint64) << np.uint64(56)) if len(first) else np.zeros(0, np.uint64)
    long = np.flatnonzero(sizes > 7)
    if len(long):
        state = sizes[long].astype(np.uint64)
        more, at = np.arange(len(long)), 0
        while len(more):
            rows = long[more]
            x = (state[more] ^ eight(first[rows] + at, sizes[rows] - at)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            state[more] = x ^ (x >> np.uint64(32))
            at += 8
            more = more[sizes[long[more]] > at]
        out[long] = state | np.uint64(1 << 63)  # short names have their size there, below 128
    return out


def text_terms(column: pa.Array, beginning: int, known: np.ndarray | None = None):
    """(text, term, count) of the different terms of each text; terms are names, or places in ``known`` (others are left out)."""
    data, at = common.text_buffer(column)
    words, texts = _words(data, at)
    if not len(words):
        none = np.zeros(0, np.int64)
        return none, (none if known is not None else none.astype(np.uint64)), none
    numbered = words.dictionary_encode()
    raw, bounds = common.text_buffer(numbered.dictionary.cast(pa.large_binary()).view(pa.large_string()))
    first, sizes = bounds[:-1], np.diff(bounds)
    names = names_of(raw, first, sizes)
    longer = np.flatnonzero(sizes > beginning)
    heads = np.full(len(names), -1, np.int64)
    # a beginning and a word of the same bytes are two terms
    begun, heads[longer] = np.unique(~names_of(raw, first[longer], np.full(len(longer), beginning)), return_inverse=True)
    terms = np.concatenate([names, begun])
    if known is not None:
        place = np.searchsorted(known, terms)
        place[place == len(known)] = 0
        held = known[place] == terms if len(known) else np.zeros(len(terms), bool)
        terms = np.where(held, place, -1)
    index = np.asarray(numbered.indices).astype(np.int64)
    head = heads[index]
    text = np.concatenate([texts, texts[head >= 0]])
    term = np.concatenate([index, len(names) + head[head >= 0]])
    if known is not None:
        inside = terms[term] >= 0
        text, term = text[inside], terms[term[inside]]
        width = max(len(known), 1)
    else:
        width = len(terms)
    pair, n = np.unique(text * width + term, return_counts=True)
    text, term = np.divmod(pair, width)
    return text, (term if known is not None else terms[term]), n


def _words(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts (ASCII letters in lower case, digits, other characters), and the text of each."""
    clean = word_table()[data]
    letter = np.concatenate([[False], clean != 0, [False]])
    begin, end = letter[1:] & ~letter[:-1], letter[:-1] & ~letter[1:]
    inner = at[1:-1]  # a word ends with its text, too
    begin[inner[letter[inner] & letter[inner + 1]]] = True
    end[inner[letter[inner] & letter[inner + 1]]] = True
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end)
    offsets = np.append(0, np.cumsum(ends - begins))
    words = pa.Array.from_buffers(pa.large_binary(), len(begins),
                                  [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(clean[clean != 0])])
    return words, np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(begins, at)))


def document_frequencies(docs: DataFrame, known: np.ndarray, beginning: int) -> tuple[np.ndarray, int]:
    """In how many documents each known term occurs, and how many documents there are; a task counts its own rows first."""
    n_terms = len(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 1, np.int64)  # the last: rows
        for whole in batches:
            total[-1] += whole.num_rows
            for batch in common.sliced(whole, 4 << 20):
                total[:-1] += np.bincount(text_terms(batch.column("text"), beginning, known)[1], minlength=n_terms)
        starts = range(0, n_terms + 1, SLAB)
        kind = np.int32 if total.max() < 1 << 31 else np.int64
        yield pa.RecordBatch.from_pydict({"slab": pa.array(starts, pa.int32()),
                                          "n": pa.array([total[i:i + SLAB].astype(kind).tobytes() for i in starts], pa.binary()),
                                          "wide": pa.array([kind is np.int64 for _ in starts])})

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64 if wide else np.int32).astype(np.int64)
                    for x, wide in zip(table["n"].to_pylist(), table["wide"].to_pylist()))
        return pa.table({"slab": table["slab"][:1].combine_chunks(), "n": pa.array([total.tobytes()], pa.binary())})

    out = docs.select("text").mapInArrow(common.released(run), "slab int, n binary, wide boolean") \
        .groupBy("slab").applyInArrow(added, "slab int, n binary").toArrow().sort_by("slab")
    total = np.frombuffer(b"".join(out["n"].to_pylist()), np.int64)
    return total[:-1], int(total[-1])


def unit_weights(row: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """TF-IDF weights of vectors, each scaled to length one."""
    w = (1 + np.log(n)) * idf[term]
    return w / np.sqrt(np.maximum(np.bincount(row, w * w, rows), 1e-300))[row]


def association(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Chi squared over the number of examples, 0 to 1: how far a term in so many toxic and clean ones goes with the label."""
    other, rest = n_toxic - toxic, n_clean - clean
    return (toxic * rest - clean * other) ** 2 / np.maximum((toxic + clean) * (other + rest) * n_toxic * n_clean, 1.0)


def runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of runs that begin at ``first``, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int32)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(first - (ends - sizes), sizes)


class BlockMaxIndex:
    """Unit vectors in blocks of ``BLOCK``, with the largest weight of every term in each block.

    Rare terms have postings, grouped by term and block.  Common ones, in one of
    ``COMMON`` vectors or more, have a dense matrix.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.size, self.blocks = arrays["size"].tolist()
        self.column, self.dense = arrays["column"], arrays["dense"]  # a term's row in the matrix, or -1
        self.term, self.block, self.most = arrays["term"], arrays["block"], arrays["most"]  # of groups; terms as offsets
        self.first, self.ids, self.weights = arrays["first"], arrays["ids"], arrays["weights"]
        self.visited = 0

    @staticmethod
    def arrays(row: np.ndarray, term: np.ndarray, weights: np.ndarray, rows: int, n_terms: int) -> dict[str, np.ndarray]:
        """Plain arrays of the index of (row, term, weight) entries."""
        blocks = -(-max(rows, 1) // BLOCK)
        often = np.flatnonzero(np.bincount(term, minlength=n_terms) * COMMON >= max(rows, 1))
        column = np.full(n_terms, -1, np.int32)
        column[often] = np.arange(len(often))
        dense = np.zeros((max(len(often), 1), blocks * BLOCK), np.float32)
        inside = column[term] >= 0
        dense[column[term[inside]], row[inside]] = weights[inside]
        row, term, weights = row[~inside], term[~inside], weights[~inside]
        order = np.lexsort((row, term))
        row, term, weights = row[order], term[order], weights[order].astype(np.float32)
        first = np.flatnonzero(np.diff(term * blocks + row // BLOCK, prepend=-1))
        return {"size": np.array([rows, blocks]), "column": column, "dense": dense,
                "term": np.searchsorted(term[first], np.arange(n_terms + 1)).astype(np.int32),
                "block": (row[first] // BLOCK).astype(np.int32), "most": np.maximum.reduceat(weights, first) if len(first) else weights,
                "first": np.append(first, len(row)).astype(np.int32), "ids": row.astype(np.int32), "weights": weights}

    def nearest(self, query: np.ndarray, at: np.ndarray, q: np.ndarray, n: int, k: int, worth: np.ndarray, without: np.ndarray | None = None):
        """For each of ``n`` queries the numbers and cosines of its ``k`` nearest vectors with a cosine above 0 (ties: the first).

        ``query``, ``at``, ``q``: the queries' entries (query, term, weight), queries in order.  Third,
        for each vector the sum over shared terms of both weights and the term's ``worth``.
        ``without``: a vector of each query that is none of its neighbours.
        """
        q, width = q.astype(np.float32), self.blocks * BLOCK
        column = self.column[at]
        rare = np.flatnonzero(column < 0).astype(np.int32)
        known, entries = np.zeros((2, n, len(self.dense)), np.float32), column >= 0
        known[0, query[entries], column[entries]] = q[entries]
        known[1, query[entries], column[entries]] = (q * worth)[entries]
        often, often_shared = known[0] @ self.dense, known[1] @ self.dense  # the common terms' part of all vectors
        first = self.term[at[rare]]
        count = self.term[at[rare] + 1] - first
        groups = runs(first, count)
        of = np.repeat(rare, count)
        query = query.astype(np.int32)
        spot = query[of] * np.int32(self.blocks) + self.block[groups]
        bounds = often.reshape(n, self.blocks, BLOCK).max(2).astype(np.float64)
        bounds += np.bincount(spot, self.most[groups] * q[of], n * self.blocks).reshape(n, -1)
        scores = often.astype(np.float64)  # of blocks that are not visited yet: no more than their cosines
        done = np.zeros((n, self.blocks), bool)
        seen: list[tuple] = []
        here = query.astype(np.int64) * width

        def visit(wanted: np.ndarray) -> None:
            nonlocal scores
            mine = np.flatnonzero(wanted.ravel()[spot])
            g, e = groups[mine], of[mine]
            begin = self.first[g]
            size = self.first[g + 1] - begin
            places = runs(begin, size)
            e = np.repeat(e, size)
            cell = here[e] + self.ids[places]
            parts = self.weights[places] * q[e]
            scores += np.bincount(cell, parts, n * width).reshape(n, width)
            seen.append((cell, parts, e))
            if without is not None:
                scores[np.flatnonzero(without >= 0), without[without >= 0]] = 0
            done[wanted] = True
            self.visited += int(wanted.sum())

        def least() -> np.ndarray:
            return -np.partition(-scores, k - 1, 1)[:, k - 1] if k <= width else np.zeros(n)

        best = np.zeros((n, self.blocks), bool)
        np.put_along_axis(best, np.argsort(-bounds, 1, kind="stable")[:, :max(FIRST, -(-k // BLOCK))], True, 1)
        visit(best)
        visit(~done & (bounds > 0) & (bounds >= np.maximum(least(), 0)[:, None] - 1e-5))
        floor = np.maximum(least(), 0)
        found, chosen = [], np.zeros((n, width), bool)
        for row in range(n):
            own = scores[row]
            ids = np.flatnonzero((own > 0) & (own >= floor[row]))
            ids = ids[np.lexsort((ids, -own[ids]))[:k]]
            chosen[row, ids] = True
            found.append(ids)
        shared = np.zeros(n * width)
        for cell, parts, e in seen:
            inside = np.flatnonzero(chosen.ravel()[cell])
            shared += np.bincount(cell[inside], parts[inside] * worth[e[inside]], n * width)
        shared = shared.reshape(n, width)
        return [(ids, scores[row, ids], shared[row, ids] + often_shared[row, ids]) for row, ids in enumerate(found)]


def weights_of(cosines: np.ndarray, shared: np.ndarray, stands: np.ndarray) -> np.ndarray:
    """What neighbours' votes weigh, by distance and by what terms of the label add to the cosine; ``stands``: rows one stands for."""
    return shared / np.maximum(1.05 - cosines, 0.05) * stands


def vote(w: np.ndarray, toxic: np.ndarray, unit: float, base: float, prior: float) -> float:
    """Share of toxic neighbours by weight, with the base rate as one more of weight ``prior``."""
    return float((w @ toxic + prior * unit * base) / (w.sum() + prior * unit))


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit by pooling adjacent violators: knots and values."""
    pools: list[list[float]] = []
    for value in np.unique(x):
        here = x == value
        pools.append([float(w[here].sum()), float((w * y)[here].sum()), value, value])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            top = pools.pop()
            pools[-1] = [pools[-1][0] + top[0], pools[-1][1] + top[1], pools[-1][2], top[3]]
    knots = [v for p in pools for v in (p[2], p[3])]
    values = [p[1] / p[0] for p in pools for _ in (0, 1)]
    return np.array(knots or [0.0]), np.array(values or [0.0])


def held_out(key: str = "doc_id"):
    """True for the rows that labels are not learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def example_texts(docs: DataFrame, labels: DataFrame, sizes: dict[int, int], settings: Settings, key: str) -> DataFrame:
    """(key, toxic, text) of the examples; of a key with several texts one of them."""
    # the sample has a fixed size, so it may be broadcast
    sample = [labels.where(F.col("toxic") == c).orderBy(F.xxhash64(key), key).limit(settings.examples) for c in sizes]
    sample = common.stored(sample[0].unionByName(sample[1]), "examples")
    chosen = common.with_row_key(docs, key, "text").join(F.broadcast(sample), key)
    one = chosen.groupBy(key).agg(F.min(F.struct("_k1", "_k2")).alias("one")).select("one.*")
    texts = common.stored(chosen.join(F.broadcast(one), ["_k1", "_k2"]).dropDuplicates([key]), "example-texts")
    # at most ``examples`` rows of a class stand in a window, and without their texts
    so_far = F.sum("n").over(Window.partitionBy("toxic").orderBy(F.xxhash64(key), key).rowsBetween(Window.unboundedPreceding, -1))
    fits = texts.select(key, "toxic", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")) \
        .withColumn("before", F.coalesce(so_far, F.lit(0))) \
        .where((F.col("before") == 0) | (F.col("before") + F.col("n") <= settings.example_bytes)).select(key)
    return texts.join(F.broadcast(fits), key).select(key, "toxic", "text")


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """One row a document: key, held_out, score (0 to 1) and neighbours (key, label, cosine): the evidence, the nearest that weigh most.

    Documents without any term of the examples, empty and null texts among
    them, get the rate of toxic examples without terms.  Null labels are none;
    a key with several labels counts as toxic if one says so, a key with several
    texts as an example with one of them.  Without labels of both classes
    every score is the share of toxic ones (0 without labels).  Repeated rows all stay;
    an empty table gives no rows; other columns are left out.  Keys that are no whole numbers raise an error.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    docs = docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))
    known = labels.select(F.col(key).cast("long").alias(key), F.col("toxic").cast("int").alias("toxic")) \
        .where(~held_out(key)).where(F.col(key).isNotNull() & F.col("toxic").isin(0, 1)) \
        .groupBy(key).agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    flat = docs.select(key, held_out(key).alias("held_out"), F.lit(share).alias("score"), F.array().cast(EVIDENCE).alias("neighbours"))
    if len(sizes) < 2:
        return flat
    texts = example_texts(docs, known, sizes, settings, key)
    beginning = settings.beginning

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, term, n = text_terms(batch.column("text"), beginning)
        cuts = np.searchsorted(text, np.arange(1, batch.num_rows))
        parts = [[x.tobytes() for x in np.split(v, cuts)] for v in (term, n.astype(np.int32))]
        return pa.RecordBatch.from_arrays([batch.column(key), batch.column("toxic"), *[pa.array(p, pa.binary()) for p in parts]],
                                          [key, "toxic", "terms", "n"])

    own = common.mapped(texts, f"`{key}` long, toxic int, terms binary, n binary", vectors).toArrow()
    sampled = np.bincount(np.asarray(own["toxic"]), minlength=2)
    if not sampled.all():
        return flat
    own = own.sort_by(key)
    ids, toxic = np.asarray(own[key]), np.asarray(own["toxic"])
    stands = np.array([sizes[c] / sampled[c] for c in (0, 1)])[toxic]
    raw = own["terms"].to_pylist()
    row = np.repeat(np.arange(len(ids)), [len(x) // 8 for x in raw])
    names, term = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
    n = np.frombuffer(b"".join(own["n"].to_pylist()), np.int32)
    del raw, own
    frequency, n_docs = document_frequencies(docs, names, beginning)
    idf = (np.log((1 + n_docs) / (1 + frequency)) + 1).astype(np.float32)
    order = _alike(row, term, n, len(ids), len(names))
    ids, toxic, stands = ids[order], toxic[order], stands[order]
    row = np.argsort(order)[row]
    arrays = BlockMaxIndex.arrays(row, term, unit_weights(row, term, n, idf, len(ids)), len(ids), len(names))
    held = [np.bincount(term[toxic[row] == c], minlength=len(names)).astype(np.int32) for c in (1, 0)]
    bare = np.bincount(row, minlength=len(ids)) == 0
    rate = float((stands * toxic)[bare].sum() / stands[bare].sum()) if bare.any() else share
    del row, term, n
    # plain arrays, bounded by the settings
    state = spark.sparkContext.broadcast({**arrays, "names": names, "idf": idf, "held_toxic": held[0], "held_clean": held[1],
                                          "keys": ids, "toxic": toxic, "stands": stands})
    k, shown, prior, unit = settings.neighbours, settings.evidence, settings.prior, float(stands.mean())

    def voted(batches: Iterator[pa.RecordBatch], among: bool) -> Iterator[tuple]:
        """(batch, votes, neighbours) with a vote for each row that has terms; ``among``: the rows are examples themselves."""
        s = state.value
        index = BlockMaxIndex(s)
        labels, keys, counts = s["toxic"], s["keys"], np.bincount(s["toxic"], minlength=2)
        place = {int(x): i for i, x in enumerate(keys)} if among else {}
        plain = association(s["held_toxic"], s["held_clean"], counts[1], counts[0]).astype(np.float32)
        for whole in batches:
            for batch in common.sliced(whole, 1 << 20):
                rows, terms, n = text_terms(batch.column("text"), beginning, s["names"])
                weights = unit_weights(rows, terms, n, s["idf"], batch.num_rows)
                votes, found = np.full(batch.num_rows, np.nan), [[] for _ in range(batch.num_rows)]
                here, entry = np.unique(rows, return_inverse=True)  # rows with terms
                cuts = np.searchsorted(rows, here)
                for i in range(0, len(here), QUERIES):
                    some = here[i:i + QUERIES]
                    a, b = cuts[i], cuts[i + QUERIES] if i + QUERIES < len(here) else len(rows)
                    at, query = terms[a:b], entry[a:b] - i
                    if among:  # as if this example were not one
                        mine = np.array([place[x] for x in batch.column(key).take(pa.array(some)).to_pylist()])
                        label = labels[mine][query]
                        worth = association(s["held_toxic"][at] - label, s["held_clean"][at] - (1 - label),
                                            counts[1] - label, counts[0] - (1 - label))
                    else:
                        mine, worth = None, plain[at]
                    near = index.nearest(query, at, weights[a:b], len(some), k, worth, mine)
                    for row, (ids, cosines, shared) in zip(some.tolist(), near):
                        w = weights_of(cosines, shared, s["stands"][ids])
                        votes[row] = vote(w, labels[ids], unit, rate, prior)
                        most = np.argsort(-w, kind="stable")[:shown]
                        found[row] = ids[most], cosines[most]
                yield batch, votes, found

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, votes, _ in voted(batches, True):
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(votes)], [key, "vote"])

    got = texts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key) \
        .mapInArrow(common.released(tried), f"`{key}` long, vote double").toArrow()  # a row an example
    votes = dict(zip(got[key].to_pylist(), got["vote"].to_pylist()))
    x = np.array([votes[i] for i in ids.tolist()], float)
    some = ~np.isnan(x)
    knots, values = monotone(x[some], toxic[some].astype(float), stands[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, votes, found in voted(batches, False):
            s = state.value
            scores = np.where(np.isnan(votes), rate, np.interp(np.nan_to_num(votes), knots, values))
            near = [x[0] for x in found if len(x)]
            cosines = [x[1] for x in found if len(x)]
            flat = np.concatenate([np.zeros(0, np.int64), *near])
            ends = np.cumsum([0, *(len(x[0]) if len(x) else 0 for x in found)])
            evidence = pa.StructArray.from_arrays([pa.array(s["keys"][flat]), pa.array(s["toxic"][flat].astype(np.int32)),
                                                   pa.array(np.concatenate([np.zeros(0), *cosines]))], ["key", "label", "cosine"])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(scores),
                                              pa.ListArray.from_arrays(pa.array(ends, pa.int32()), evidence)], [key, "score", "neighbours"])

    scored = docs.mapInArrow(common.released(run), f"`{key}` long, score double, neighbours {EVIDENCE}")
    return scored.select(key, held_out(key).alias("held_out"), "score", "neighbours")


def _alike(row: np.ndarray, term: np.ndarray, n: np.ndarray, rows: int, n_terms: int) -> np.ndarray:
    """An order of the examples in which those that use common terms alike share blocks; it changes no result."""
    times = np.bincount(term, minlength=n_terms)
    common_terms = np.argsort(-times, kind="stable")[:64]
    column = np.full(n_terms, -1)
    column[common_terms] = np.arange(len(common_terms))
    at = column[term]
    use = np.zeros((rows, 64), np.float32)
    use[row[at >= 0], at[at >= 0]] = np.log1p(n[at >= 0]) / np.log1p(times[term[at >= 0]])
    top = np.argsort(-use, 1, kind="stable")[:, :3]
    return np.lexsort((np.arange(rows), top[:, 2], top[:, 1], top[:, 0]))


EVIDENCE = "array<struct<key: bigint, label: int, cosine: double>>"
