"""Q2: on- and off-continent predictor locations for every early target.

For a target ``t`` (a top-five location of Q1), two elections run on the
onset-rank matrix with every cell *later* than the target's own onset for
that variant masked out (a tie is kept; a variant that never reached the
target masks nothing):

* on-continent: the other locations of ``t``'s continent;
* off-continent: every location whose continent is not ``t``'s (a null
  continent counts as "not ``t``'s").

A predictor keeps ``predictor_rank <= 5`` in its election (ties may give
more than five).  All targets' elections form one Spark job: the target is
a column of the election key, never a driver loop.

Scale: the ranks of all locations are stored once, as tiles of a block of locations in a
slice of variants.  A group sees all of them, which is little beside the preferences, and some targets, and
finds the leaders of their elections from the few comparisons that decide (:func:`schulze_kernel.leaders`).
Elections that need more than ``ROOM`` cells for that go through tiles of preferences: there a group
sees the tiles of two blocks and the ranks of some targets in one slice.  Which votes a target masks, and who stands in its elections, is
decided inside the group, target by target, so ballots are neither copied nor joined once a target.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlake.functions import schulze_kernel
from onsetlake.operators import election

TOP_N = 5
SEP = "\u0001"  # between continent and location in a label
PARTS = 64  # groups that targets are dealt out into
ROOM = 1 << 27  # cells
KEYS = ["t_continent", "t_location", "on_same_continent"]
_PARTS = "t_continent string, t_location string, on_same_continent boolean, lo int, hi int, rows array<string>, cols array<string>, " \
         "p binary, q binary, row_votes array<int>, col_votes array<int>"


def _continent(label: str) -> str:
    return label.partition(SEP)[0]


def masked_preferences(tiles: DataFrame, targets: DataFrame, blocks: int, strict: bool) -> DataFrame:
    """Partial preferences between two blocks in one slice for the two elections of every target.

    ``targets``: tiles of the targets' own ranks.  Votes later than the target's are
    masked; a continent in a label is empty where it is null.
    """
    def pair(tiles: list) -> list[dict]:
        lo, hi = tiles[0].lo, tiles[0].hi
        at = {tile.block: tile for tile in tiles if not tile.target}
        asked = next((tile for tile in tiles if tile.target), None)
        out: list[dict] = []
        if asked is None or lo not in at or hi not in at:
            return out
        variants = sorted({v for tile in tiles for v in tile.variants})
        *ranks, own_ranks = schulze_kernel.coded(*[election.ranks_of(tile, variants) for tile in (at[lo], at[hi], asked)])
        never = np.iinfo(own_ranks.dtype).max
        sides = []
        for tile, codes in zip((at[lo], at[hi]), ranks):
            labels = np.asarray(tile.rows, object)
            sides.append((labels, np.array([_continent(x) for x in labels], object), codes))
        for target, own in zip(asked.rows, own_ranks):
            continent, _, location = target.partition(SEP)
            latest = np.where(own == never, 0, own) if strict else own
            kept = [np.where(r < latest if strict else r <= latest, r, never) for _, _, r in sides]
            for on in (True, False):
                stand = [np.flatnonzero(((where == continent) == on) & (labels != target)) for labels, where, _ in sides]
                if all(map(len, stand)):
                    a, b = (r[s] for r, s in zip(kept, stand))
                    names = [list(labels[s]) for (labels, _, _), s in zip(sides, stand)]
                    out.append({"t_continent": continent, "t_location": location, "on_same_continent": on, "lo": lo, "hi": hi,
                                "rows": names[0], "cols": names[1], "p": schulze_kernel.preferences(a, b).tobytes(),
                                "q": schulze_kernel.preferences(b, a).tobytes(),
                                **{c: (x < never).sum(1).tolist() for c, x in (("row_votes", a), ("col_votes", b))}})
        return out

    locations = election.block_pairs(tiles, blocks).withColumn("target", F.lit(False)) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = F.expr(f"explode(flatten(transform(sequence(0, {blocks - 1}), i -> transform(sequence(i, {blocks - 1}), "
                   "j -> named_struct('lo', i, 'hi', j)))))")
    asked = targets.withColumn("pair", pairs).select("*", "pair.lo", "pair.hi").drop("pair") \
        .withColumn("target", F.lit(True)).withColumn("part", F.col("block"))
    # ranks are few bytes, but much is computed from them: by a number of its own, so that groups are not put together into few tasks
    by = ["lo", "hi", "slice", "part"]
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return election.grouped(locations.unionByName(asked).repartition(tasks, *by), by, pair, _PARTS)


def with_votes_only(parts: DataFrame) -> DataFrame:
    """Partial preferences without the candidates that have no vote left in any slice."""
    def drop(parts: list) -> list[dict]:
        rows, cols = (np.sum([getattr(x, c) for x in parts], axis=0) > 0 for c in ("row_votes", "col_votes"))
        if not rows.any() or not cols.any():
            return []
        out = []
        for x in parts:
            p = election.cells(x.p, rows, cols)[rows][:, cols]
            q = election.cells(x.q, cols, rows)[cols][:, rows]
            out.append({"lo": x.lo, "hi": x.hi, "rows": list(np.asarray(x.rows, object)[rows]), "cols": list(np.asarray(x.cols, object)[cols]),
                        "p": p.tobytes(), "q": q.tobytes()})
        return out

    schema = "t_continent string, t_location string, on_same_continent boolean, lo int, hi int, rows array<string>, " \
             "cols array<string>, p binary, q binary"
    return election.grouped(parts, [*KEYS, "lo", "hi"], drop, schema, KEYS)


def elected(tiles: DataFrame, asked: DataFrame, strict: bool) -> DataFrame:
    """``(t_continent, t_location, on_same_continent, location, rank, open)`` of the leaders of both elections of every target.

    ``asked``: the targets' labels as ``location``.  An election that takes too much room is one row with ``open`` set.
    """
    def solve(rows: list) -> list[dict]:
        tiles, targets = [x for x in rows if x.part_targets is None], [t for x in rows for t in x.part_targets or ()]
        out: list[dict] = []
        if not tiles:
            return out
        cells = sum(len(x.rows) for x in tiles if x.slice == tiles[0].slice) * len({v for x in tiles for v in x.variants})
        labels, codes = election.all_codes(tiles) if cells <= ROOM else (np.zeros(0, object), np.zeros((0, 0), np.uint8))
        where = np.array([_continent(x) for x in labels], object)
        place = {x: k for k, x in enumerate(labels)}
        never = np.iinfo(codes.dtype).max
        for target in targets:
            continent, _, location = target.partition(SEP)
            own = codes[place[target]] if target in place else np.full(codes.shape[1], never, codes.dtype)
            latest = np.where(own == never, 0, own) if strict else own
            kept = np.where(codes < latest if strict else codes <= latest, codes, never)
            for on in (True, False):
                head = {"t_continent": continent, "t_location": location, "on_same_continent": on}
                stand = np.flatnonzero(((where == continent) == on) & (labels != target))
                if strict:
                    stand = stand[(kept[stand] < never).any(1)]
                first = schulze_kernel.leaders(kept[stand], TOP_N, ROOM) if cells <= ROOM and len(stand) else None
                if first is not None:
                    out += [head | {"location": labels[stand[k]], "rank": r, "open": False} for k, r in zip(*first)]
                elif cells > ROOM or len(stand):
                    out.append(head | {"location": None, "rank": None, "open": True})
        return out

    part = election.dealt("location", PARTS)
    used = [r.part for r in asked.select(part.alias("part")).distinct().collect()]
    everywhere = tiles.withColumn("part", F.explode(F.array(*map(F.lit, used)).cast("array<int>")))         .withColumn("part_targets", F.lit(None).cast("array<string>"))
    dealt = asked.groupBy(part.alias("part")).agg(F.collect_list("location").alias("part_targets"))         .select(*[F.lit(None).cast(tiles.schema[c].dataType).alias(c) for c in tiles.columns], "part", "part_targets")
    return election.grouped(everywhere.unionByName(dealt).repartition(PARTS, "part"), ["part"], solve,
                            "t_continent string, t_location string, on_same_continent boolean, location string, rank double, open boolean")


def predictor_locations(ranks: DataFrame, targets: DataFrame, excluded: Column | None = None,
                        rank_col: str = "outbreak_rank_global", strict: bool = False,
                        blocks: int = 2, slices: int = 1) -> DataFrame:
    """Predictor table for all ``targets(continent, location)``.

    ``strict=True`` keeps only cells strictly before a known target onset and
    drops candidates left without votes.
    """
    def label(continent: str, location: str) -> Column:
        return F.concat_ws(SEP, F.coalesce(continent, F.lit("")), location)

    cand = ranks.select(label("continent", "location").alias("location")).distinct()
    votes = ranks if excluded is None else ranks.where(~F.coalesce(excluded, F.lit(False)))
    votes = votes.select(label("continent", "location").alias("location"), "variant", F.col(rank_col).alias("r"))
    asked = election.stored(targets.where(F.col("continent").isNotNull()).select(label("continent", "location").alias("location")).distinct())
    tiles = election.stored(election.rank_tiles(election._ballots(votes, cand, []), [], blocks, slices))
    ranked = election.stored(elected(tiles, asked, strict))
    left = ranked.where("open").select(*KEYS)
    ranked = ranked.where(~F.col("open")).select(*KEYS, "location", "rank")
    if not left.isEmpty():
        again = left.select(label("t_continent", "t_location").alias("location")).distinct()
        wanted = election.rank_tiles(election._ballots(votes.join(again, "location", "left_semi"), again, []), [], blocks, slices)
        masked = masked_preferences(tiles, wanted, blocks, strict)
        parts = with_votes_only(masked) if strict else masked.drop("row_votes", "col_votes")
        parts = parts.join(left, KEYS, "left_semi")
        ranked = ranked.unionByName(election.ranked(election.summed_tiles(parts, KEYS, slices), KEYS, blocks).select(*KEYS, "location", "rank"))

    label_parts = F.split(F.col("location"), SEP)
    on_flag = F.col("on_same_continent")
    top = F.col("rank") <= TOP_N
    return ranked.where(top).select(
        F.get(label_parts, 1).alias("predictor_location"),
        F.col("rank").alias("predictor_rank"),
        F.when(on_flag, F.col("t_continent")).otherwise(F.nullif(F.get(label_parts, 0), F.lit(""))).alias("predictor_continent"),
        on_flag.alias("on_same_continent"),
        (on_flag & top).alias("is_in_same_continent_top_5_predictors"),
        (~on_flag & top).alias("is_in_off_continent_top_5_predictors"),
        F.col("t_continent").alias("continent"),
        F.col("t_location").alias("location"),
    )
