"""Schulze election ranking over long-form votes.

Inputs, long form:

* ``votes(keys..., location, variant, r)``: one row per candidate and
  variant that hit it; ``r`` is the onset order (rank or date; only ``<``
  is used).
* ``candidates(keys..., location)``: everyone standing in the election,
  voted on or not (a location with only excluded variants still stands).

``keys`` identify the election (a continent, a target and scope, or a
constant for one global election).  Output: ``(keys..., location, wins,
rank)`` with ``rank`` the min-rank by wins descending, as a double.

Ranks are stored in tiles.  ``blocks`` and ``slices`` are plan
parameters that deal candidates out into blocks and variants into slices; they change
the layout only, never the result.

1. *Rank tiles* hold the onset orders of a block in a slice.
2. Up to ``WHOLE`` cells an election, one group takes its rank tiles and finds all wins (:func:`schulze_kernel.strongest_path_wins`).
   With larger ones, a pair of blocks meets in each slice, which gives *partial preferences*; those of
   all slices are added up, so no group holds all variants, and turned into the weights of won comparisons.
3. The strongest paths then take one round a pivot block, each in three phases: the pivot tile is
   closed once, then its row and column are updated from it, then all other tiles from
   those two.
4. Wins then come from pairs of tiles, and no group holds more than the tiles of two blocks beside its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_schema

from onsetlake.functions import schulze_kernel


def _as_number(col: F.Column, dtype: T.DataType) -> F.Column:
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def normalise_votes(votes: DataFrame, keys: Sequence[str]) -> DataFrame:
    r_type = votes.schema["r"].dataType
    return votes.select(*keys, "location", "variant", _as_number(F.col("r"), r_type).alias("r")).where(
        F.col("r").isNotNull()
    )


def combined_rank(votes: DataFrame, candidates: DataFrame, keys: Sequence[str], blocks: int = 2, slices: int = 1) -> DataFrame:
    keys = list(keys)
    tiles = stored(rank_tiles(_ballots(votes, candidates, keys), keys, blocks, slices))
    sizes = tiles.groupBy(*keys, "slice").agg(F.sum(F.size("rows").cast("long")).alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    if most * most <= WHOLE:
        return _with_rank(whole_wins(tiles, keys), keys)
    return ranked(summed_tiles(partial_preferences(tiles, keys, blocks), keys, slices), keys, blocks)


def ranked(tiles: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """``(keys..., location, wins, rank)`` of every candidate from the tiles of won comparisons."""
    return _with_rank(tiled_wins(widest_path_tiles(tiles, list(keys), blocks), keys), keys)


def _with_rank(wins: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("wins").desc())
    return wins.withColumn("rank", F.rank().over(w).cast("double"))


def _schema(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> str:
    return ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys] + list(fields))


_TILE = ["i int", "j int", "rows array<string>", "cols array<string>", "s binary"]


def stored(df: DataFrame) -> DataFrame:
    """Written to the checkpoint folder and read back: later rounds read each tile once, and lineage stays short."""
    from onsetlake.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tiles-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(table: pa.Table | pa.RecordBatch) -> list[SimpleNamespace]:
    return [SimpleNamespace(**row) for row in table.to_pylist()]


def grouped(df: DataFrame, by: Sequence[str], fn: Callable[[list], list[dict]], schema: str, keys: Sequence[str] = ()) -> DataFrame:
    """``fn`` of the few rows of each group, as dicts; ``keys`` are added from the group's first row."""
    kinds, keys = to_arrow_schema(T.StructType.fromDDL(schema)), list(keys)

    def run(table: pa.Table) -> pa.Table:
        rows = rows_of(table)
        own = {k: getattr(rows[0], k) for k in keys}
        return pa.Table.from_pylist([own | out for out in fn(rows)], schema=kinds)

    return df.groupBy(*by).applyInArrow(run, schema)


def mapped(df: DataFrame, fn: Callable[[SimpleNamespace], list[dict]], schema: str, keys: Sequence[str] = ()) -> DataFrame:
    """``fn`` of each row, as dicts; ``keys`` are added from the row."""
    kinds, keys = to_arrow_schema(T.StructType.fromDDL(schema)), list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                own = {k: getattr(row, k) for k in keys}
                if out := [own | x for x in fn(row)]:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return df.mapInArrow(run, schema)


_RANKS = ["block int", "slice int", "rows array<string>", "variants array<string>", "r binary"]
_PARTS = ["lo int", "hi int", "rows array<string>", "cols array<string>", "p binary", "q binary"]


def dealt(name: str, n: int) -> F.Column:
    return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")


def rank_tiles(ballots: DataFrame, keys: Sequence[str], blocks: int, slices: int) -> DataFrame:
    """``(keys..., block, slice, rows, variants, r)``: every block's candidates in order, with their ranks in one slice of variants."""
    keys = list(keys)
    spread = F.when(F.col("variant").isNull(), F.sequence(F.lit(0), F.lit(slices - 1))).otherwise(F.array(dealt("variant", slices)))
    rows = ballots.withColumn("block", dealt("location", blocks)).withColumn("slice", F.explode(spread))

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        labels, ranks = schulze_kernel.rank_matrix(pdf["location"].to_numpy(dtype=object), pdf["variant"], pdf["r"])
        voted = pdf["variant"].notna() & pdf["r"].notna()
        order = np.argsort(labels.astype(str), kind="stable")
        head = [pdf[c].iloc[0] for c in (*keys, "block", "slice")]
        return pd.DataFrame([(*head, list(labels[order]), list(pd.factorize(pdf["variant"][voted])[1]), schulze_kernel.packed(ranks[order]))],
                            columns=[*keys, "block", "slice", "rows", "variants", "r"])

    return rows.groupBy(*keys, "block", "slice").applyInPandas(tile, _schema(ballots, keys, _RANKS))


def ranks_of(tile, variants: Sequence[str]) -> np.ndarray:
    """The ranks of a tile with ``variants`` in columns."""
    own = schulze_kernel.unpacked(tile.r, len(tile.rows), len(tile.variants))
    out = np.full((len(tile.rows), len(variants)), np.nan)
    place = {v: k for k, v in enumerate(variants)}
    out[:, [place[v] for v in tile.variants]] = own
    return out


def all_codes(tiles: list) -> tuple[np.ndarray, np.ndarray]:
    """Labels and codes of all locations, from all tiles."""
    blocks = sorted({tile.block for tile in tiles})
    rows = {tile.block: tile.rows for tile in tiles}
    found = []
    for slice_ in sorted({tile.slice for tile in tiles}):
        at = {tile.block: tile for tile in tiles if tile.slice == slice_}
        variants = sorted({v for tile in at.values() for v in tile.variants})
        ranks = np.vstack([ranks_of(at[b], variants) for b in blocks])
        found += [schulze_kernel.coded(ranks[:, k:k + 16])[0] for k in range(0, len(variants), 16)]
    labels = np.array([x for b in blocks for x in rows[b]], object)
    return labels, np.concatenate(found, axis=1) if found else np.zeros((len(labels), 0), np.uint8)


def block_pairs(tiles: DataFrame, blocks: int) -> DataFrame:
    """Each tile once for every other block, with the pair as ``lo`` and ``hi``."""
    return tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other")


def partial_preferences(tiles: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """``(keys..., lo, hi, rows, cols, p, q)``: preferences between two blocks within one slice, both ways."""
    keys = list(keys)

    def pair(tiles: list) -> list[dict]:
        lo, hi, at = tiles[0].lo, tiles[0].hi, {tile.block: tile for tile in tiles}
        if lo not in at or hi not in at:
            return []
        variants = sorted(set(at[lo].variants) | set(at[hi].variants))
        a, b = ranks_of(at[lo], variants), ranks_of(at[hi], variants)
        return [{"lo": lo, "hi": hi, "rows": at[lo].rows, "cols": at[hi].rows, "p": schulze_kernel.preferences(a, b).tobytes(),
                 "q": schulze_kernel.preferences(b, a).tobytes()}]

    return grouped(block_pairs(tiles, blocks), [*keys, "lo", "hi", "slice"], pair, _schema(tiles, keys, _PARTS), keys)


_KINDS = {1: np.uint8, 2: np.uint16, 4: np.int32}


def cells(data: bytes, rows, cols) -> np.ndarray:
    """A tile's counts; how many bytes each one takes follows from the tile's size."""
    size = len(rows) * len(cols)
    return np.frombuffer(data, _KINDS[len(data) // size if size else 1]).reshape(len(rows), len(cols))


def summed_tiles(parts: DataFrame, keys: Sequence[str], slices: int, only_won: bool = True) -> DataFrame:
    """Partial preferences of all slices added up, as tiles ``(keys..., i, j, rows, cols, s)`` both ways.

    ``s`` holds the weights of won comparisons, or with ``only_won`` off all
    preferences, in the narrowest type for this tile (a byte each up to 255 variants).  The parts of a single slice are whole sums as they are.
    """
    keys = list(keys)

    def add(parts: list) -> list[dict]:
        one = parts[0]
        p = sum(cells(x.p, x.rows, x.cols).astype(np.int32) for x in parts)
        q = sum(cells(x.q, x.cols, x.rows).astype(np.int32) for x in parts)
        there, back = (schulze_kernel.strong(p, q), schulze_kernel.strong(q, p)) if only_won else (p, q)
        out = [_tile(one.lo, one.hi, one.rows, one.cols, there)]
        return out if one.lo == one.hi else [*out, _tile(one.hi, one.lo, one.cols, one.rows, back)]

    schema = _schema(parts, keys, _TILE)
    if slices == 1:
        return mapped(parts, lambda part: add([part]), schema, keys)
    return grouped(parts, [*keys, "lo", "hi"], add, schema, keys)


def _tile(i: int, j: int, rows: list, cols: list, s: np.ndarray) -> dict:
    return {"i": i, "j": j, "rows": rows, "cols": cols, "s": schulze_kernel.narrowed(s).tobytes()}


def strength_tiles(ballots: DataFrame, keys: Sequence[str], blocks: int, slices: int = 1, strong: bool = True) -> DataFrame:
    """Tiles of the strong edges' weights (0: none), or of all preferences, from ballots."""
    parts = partial_preferences(rank_tiles(ballots, keys, blocks, slices), keys, blocks)
    return summed_tiles(parts, keys, slices, only_won=strong)


def widest_path_tiles(tiles: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """Strongest-path strengths of the tiles: one round of three phases for each pivot block.

    Rounds are written but for the last, so that each reads its tiles once.
    """
    keys = list(keys)
    schema = _schema(tiles, keys, _TILE)
    copied = _schema(tiles, keys, ["role string", *_TILE])
    names = [*keys, "role", "i", "j", "rows", "cols", "s"]

    each = range(blocks)

    def closed(pivot) -> list[dict]:
        """Phase 1: the pivot tile, and a copy for each tile of its row and column."""
        k, s = pivot.i, schulze_kernel.closure(cells(pivot.s, pivot.rows, pivot.cols))
        places = [("own", k, k), *(("pivot", k, x) for x in each if x != k), *(("pivot", x, k) for x in each if x != k)]
        return [{"role": role, **_tile(i, j, pivot.rows, pivot.cols, s)} for role, i, j in places]

    def crossed(parts: list) -> list[dict]:
        """Phase 2: a tile of the pivot's row or column, and a copy for each tile that phase 3 updates from it."""
        by = {x.role: x for x in parts}
        if "own" not in by:
            return []
        own, copies = by["own"], []
        s = cells(own.s, own.rows, own.cols)
        if "pivot" in by:
            p = cells(by["pivot"].s, by["pivot"].rows, by["pivot"].cols)
            if own.down:  # in the pivot's column
                s = np.maximum(s, schulze_kernel.max_min(s, p))
                copies = [("column", own.i, x) for x in each if x != own.j]
            else:
                s = np.maximum(s, schulze_kernel.max_min(p, s))
                copies = [("row", x, own.j) for x in each if x != own.i]
        return [{"role": role, **_tile(i, j, own.rows, own.cols, s)} for role, i, j in [("own", own.i, own.j), *copies]]

    def updated(parts: list) -> list[dict]:
        """Phase 3: all other tiles, from one of the column and one of the row."""
        by = {x.role: x for x in parts}
        if "own" not in by:
            return []
        own = by["own"]
        s = cells(own.s, own.rows, own.cols)
        if "column" in by and "row" in by:
            left, right = (cells(by[x].s, by[x].rows, by[x].cols) for x in ("column", "row"))
            s = np.maximum(s, schulze_kernel.max_min(left, right))
        return [_tile(own.i, own.j, own.rows, own.cols, s)]

    now = stored(tiles)
    for k in range(blocks):
        in_row, in_column = F.col("i") == k, F.col("j") == k
        pivot = mapped(now.where(in_row & in_column), closed, copied, keys)
        line = now.where(in_row != in_column).withColumn("role", F.lit("own")).select(*names)
        cross = grouped(line.unionByName(pivot).withColumn("down", in_column), [*keys, "i", "j"], crossed, copied, keys)
        rest = now.where(~in_row & ~in_column).withColumn("role", F.lit("own")).select(*names)
        now = grouped(rest.unionByName(cross), [*keys, "i", "j"], updated, schema, keys)
        if k + 1 < blocks:
            now = stored(now)
    return now


def whole_wins(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., location, wins)`` from the rank tiles, all of an election in one group."""
    keys = list(keys)

    def wins(tiles: list) -> list[dict]:
        labels, codes = all_codes(tiles)
        won = schulze_kernel.strongest_path_wins(schulze_kernel.won_weights(codes))
        return [{"location": x, "wins": w} for x, w in zip(labels, won.tolist())]

    # ranks are few bytes, but much is computed from them: by a number of its own, so that groups are not put together into few tasks
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return grouped(tiles.repartition(tasks, *keys), keys, wins, _schema(tiles, keys, ["location string", "wins long"]), keys)


WHOLE = 1 << 28  # cells, a byte each up to 255 variants


def tiled_wins(strengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., location, wins)`` from the strength tiles; a tile meets the one with rows and columns exchanged."""
    keys = list(keys)

    def wins(tiles: list) -> list[dict]:
        at = {(x.i, x.j): (x.rows, cells(x.s, x.rows, x.cols)) for x in tiles}
        return [{"location": label, "wins": int(n)} for (i, j), (rows, s) in at.items()
                for label, n in zip(rows, (s > at[j, i][1].T).sum(axis=1))]

    pairs = strengths.withColumn("lo", F.least("i", "j")).withColumn("hi", F.greatest("i", "j"))
    return grouped(pairs, [*keys, "lo", "hi"], wins, _schema(strengths, keys, ["location string", "wins long"]), keys) \
        .groupBy(*keys, "location").agg(F.sum("wins").alias("wins"))


def _ballots(votes: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Votes and a row without a vote for every candidate, so that all of them stand."""
    return normalise_votes(votes, keys).unionByName(candidates.select(*keys, "location").distinct().select(
        *keys, "location", F.lit(None).cast("string").alias("variant"), F.lit(None).cast("double").alias("r")))


def _listed(tiles: DataFrame, keys: Sequence[str], name: str, zeros: bool) -> DataFrame:
    """One row a cell of the tiles, ``(keys..., a, b, name)`` with ``a != b``."""
    keys = list(keys)

    def rows(pdfs):
        for pdf in pdfs:
            for row in pdf.itertuples():
                s = cells(row.s, row.rows, row.cols)
                a, b = (x.ravel() for x in np.indices(s.shape)) if zeros else np.nonzero(s)
                out = pd.DataFrame({"a": np.asarray(row.rows, object)[a], "b": np.asarray(row.cols, object)[b],
                                    name: s[a, b].astype(np.int64)})
                for at, k in enumerate(keys):
                    out.insert(at, k, getattr(row, k))
                yield out[out["a"] != out["b"]]

    return tiles.mapInPandas(rows, _schema(tiles, keys, ["a string", "b string", f"{name} long"]))


def pairwise_preferences(votes: DataFrame, candidates: DataFrame, keys: Sequence[str], blocks: int = 2, slices: int = 1) -> DataFrame:
    """``(keys..., a, b, p)`` for every ordered pair of distinct candidates, from tiles of votes."""
    tiles = strength_tiles(_ballots(votes, candidates, keys), keys, blocks, slices, strong=False)
    return _listed(tiles, keys, "p", zeros=True)


def path_strengths(votes: DataFrame, candidates: DataFrame, keys: Sequence[str], blocks: int = 2, slices: int = 1) -> DataFrame:
    """Strongest-path strengths ``(keys..., a, b, s)``, zero paths and ``a = b`` omitted."""
    tiles = strength_tiles(_ballots(votes, candidates, keys), keys, blocks, slices)
    return _listed(widest_path_tiles(tiles, keys, blocks), keys, "s", zeros=False)
