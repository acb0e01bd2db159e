"""SimHash near-duplicates: pigeonhole blocks, then exact Hamming distance.

A 64-bit fingerprint is split into ``distance + spare`` blocks.  Two
fingerprints that differ in at most ``distance`` bits agree in at least
``spare`` whole blocks, so each fingerprint is sent, for every choice of
``spare`` blocks, to the key made of their bits, and only fingerprints that
share a key are compared.  No link is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph

BITS = 64
TILE = 2048
FEW = 16
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """SimHash of a text: A-Z in lower case, words split at ASCII white space, shingles with repeats.

    Texts of fewer words are one shingle; texts without words have fingerprint 0.
    """
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, _CHUNK):
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[i:i + _CHUNK], stops[i:i + _CHUNK])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """(key, fp): the fingerprint of every whole text as a signed long; null texts have fingerprint 0."""
    common.bounded_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return common.mapped(docs.select(key, F.col("text").cast("string").alias("text")), f"`{key}` {kind}, fp long", run)


def block_masks(distance: int, spare: int) -> list[int]:
    """One mask for each choice of ``spare`` of ``distance + spare`` blocks of the 64 bits, signed."""
    n = distance + spare
    bounds = [BITS * k // n for k in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, spare)]
    return np.array(masks, np.uint64).view(np.int64).tolist()


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= distance


def links_in_group(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints of a group as all its close pairs would, at most one a fingerprint."""
    links, rest = [], fps
    while len(rest):
        seeds, rest = [rest[0]], rest[1:]
        while seeds and len(rest):
            seed = seeds.pop()
            near = _near(rest, seed, distance)
            if near.any():
                found = rest[near]
                links.extend((int(seed), x) for x in found.tolist())
                seeds.extend(found)
                rest = rest[~near]
    return links


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of each run of rows (table, bits, tile); rows come sorted by them."""
    names = ("table", "bits", "tile")
    held = None

    def linked(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        fp = rows["fp"]
        new = np.ones(len(fp), bool)
        new[1:] = np.any([rows[n][1:] != rows[n][:-1] for n in names], axis=0)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(fp)))
        group = np.repeat(np.arange(len(starts)), sizes)
        few = sizes[group] <= FEW
        us, vs = [], []
        for step in range(1, min(FEW, int(sizes.max()))):
            i = np.flatnonzero(few[:-step] & (group[step:] == group[:-step]))
            i = i[_near(fp[i], fp[i + step], distance)]
            us.append(fp[i])
            vs.append(fp[i + step])
        for k in np.flatnonzero(sizes > FEW).tolist():
            found = np.array(links_in_group(np.unique(fp[starts[k]:starts[k] + sizes[k]]), distance), np.int64)
            if len(found):
                us.append(found[:, 0])
                vs.append(found[:, 1])
        return (np.concatenate(us), np.concatenate(vs)) if us else (fp[:0], fp[:0])

    def batch_of(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        u, v = linked(rows)
        return pa.RecordBatch.from_pydict({"u": pa.array(np.maximum(u, v)), "v": pa.array(np.minimum(u, v))})

    for batch in batches:
        rows = {n: np.asarray(batch.column(n)) for n in (*names, "fp")}
        if not batch.num_rows:
            continue
        if held is not None:
            rows = {n: np.concatenate([held[n], rows[n]]) for n in rows}
        last = np.all([rows[n] == rows[n][-1] for n in names], axis=0)
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        held = {n: x[cut:] for n, x in rows.items()}  # the last run may go on in the next batch
        if cut:
            yield batch_of({n: x[:cut] for n, x in rows.items()})
    if held is not None:
        yield batch_of(held)


def links(fps: DataFrame, distance: int = 3, spare: int = 3, tile: int = TILE) -> DataFrame:
    """(u, v) with u > v: links between distinct fingerprints (column fp) at most ``distance`` bits apart.

    They connect what all such pairs connect: keys shared by up to ``FEW``
    fingerprints give every close pair, larger ones a spanning forest.  A key
    shared by more than ``tile`` fingerprints is dealt out as pairs of tiles,
    so no group is larger than two tiles and none is dropped.
    """
    masks = F.array(*[F.struct(F.lit(k).alias("table"), F.lit(m).alias("mask")) for k, m in
                      enumerate(block_masks(distance, spare))])
    keyed = fps.select("fp", F.explode(masks).alias("m")) \
        .select("fp", F.col("m.table").alias("table"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("bits"))
    large = keyed.groupBy("table", "bits").count().where(F.col("count") > tile) \
        .select("table", "bits", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = keyed.join(large, ["table", "bits"], "left").select(
        "fp", "table", "bits", F.coalesce("tiles", F.lit(1)).alias("tiles")) \
        .select("*", F.coalesce(mine, F.lit(0)).alias("mine")).select("*", other.alias("other")) \
        .where("tiles = 1 or mine != other") \
        .select("fp", "table", "bits", (F.least("mine", "other") * F.col("tiles") + F.greatest("mine", "other")).cast("long").alias("tile"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "table", "bits", "tile").sortWithinPartitions("table", "bits", "tile") \
        .mapInArrow(common.released(lambda batches: _links(batches, distance)), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, distance: int = 3, shingle: int = 3, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id, root) of every row of ``docs`` (key, text).

    ``component_id`` is the smallest key linked to the row by steps of at most
    ``distance`` bits, itself included; ``root`` names the component where all
    its keys are null (component_id is then null).  Exact copies share a
    fingerprint and are one node, however many they are.  Null, empty and blank
    texts have fingerprint 0 and are linked like any other; an empty table gives
    no rows; repeated rows stay; other columns are left out.
    """
    own = common.stored(fingerprints(docs, shingle, seed, key), "fingerprints")
    nodes = own.groupBy("fp").agg(F.min(key).alias("least"))
    found = common.stored(graph.components(links(nodes.select("fp"), distance)), "simhash-roots")
    rooted = nodes.join(found, nodes["fp"] == found["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(rooted.select("fp", "root").join(least, "root"), "fp").select(key, "fp", "component_id", "root")


def deduplicated(docs: DataFrame, distance: int = 3, shingle: int = 3, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key (nulls last; ties: by the text)."""
    keyed = common.with_row_key(docs.select(key, "text"), key, "text").select(
        F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), "_k1", "_k2").alias("row"), "text")
    found = near_duplicates(keyed, distance, shingle, seed, key="row")
    first = found.groupBy("root").agg(F.min("row").alias("row")).select("row._k1", "row._k2").distinct()
    kept = common.with_row_key(docs, key, "text").join(first, ["_k1", "_k2"], "left_semi")
    return kept.dropDuplicates(["_k1", "_k2"]).select(*docs.columns)
