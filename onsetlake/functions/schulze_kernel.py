"""Numpy kernels of one tile of an election, used inside grouped maps.

A tile is some candidates against some others; :mod:`onsetlake.operators.election` deals
elections out into tiles and puts them together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


def narrowed(x: np.ndarray) -> np.ndarray:
    """Counts of no less than 0 in the narrowest type that holds them all: a byte each where no count is above 255."""
    most = int(x.max(initial=0))
    kind = next(k for k in (np.uint8, np.uint16, np.int32) if most <= np.iinfo(k).max)
    return x.astype(kind, copy=False)


NONE = np.iinfo(np.uint16).max


def packed(ranks: np.ndarray) -> bytes:
    """Ranks (NaN: none) in two bytes each where they are whole numbers that fit, else in eight."""
    none = np.isnan(ranks)
    whole = np.where(none, 0, ranks)
    fits = (whole >= 0) & (whole < NONE) & (whole == np.floor(whole))
    return np.where(none, NONE, whole).astype(np.uint16).tobytes() if fits.all() else ranks.tobytes()


def unpacked(data: bytes, rows: int, variants: int) -> np.ndarray:
    if len(data) == 8 * rows * variants:
        return np.frombuffer(data, np.float64).reshape(rows, variants)
    ranks = np.frombuffer(data, np.uint16).reshape(rows, variants)
    return np.where(ranks == NONE, np.nan, ranks)


def coded(*ranks: np.ndarray) -> list[np.ndarray]:
    """Rank matrices over the same variants as places in each variant's order, counted from 1 over all of them; no rank: the type's largest."""
    both = np.vstack(ranks)
    order = np.argsort(both, axis=0, kind="stable")  # NaN last
    ordered = np.take_along_axis(both, order, 0)
    place = np.ones(both.shape, np.int64)
    place[1:] += np.cumsum(ordered[1:] > ordered[:-1], axis=0)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if len(both) < np.iinfo(k).max)
    codes = np.empty(both.shape, kind)
    np.put_along_axis(codes, order, place.astype(kind), 0)
    codes[np.isnan(both)] = np.iinfo(kind).max
    return np.split(codes, np.cumsum([len(r) for r in ranks])[:-1])


def preferences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """p[i, j] = #{v: a_i < b_j} + #{v: i has a rank, j has none}, for rank matrices with the same variants in columns, or their codes.

    NaN, or a code type's largest, stands for "not hit", which is later than any rank and not before another "not hit".
    """
    if a.dtype.kind == "f":
        a, b = coded(a, b)
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    out = np.zeros((a.shape[1], b.shape[1]), np.int32)
    before = np.empty(out.shape, bool)
    for first in range(0, len(a), 255):  # a byte holds the count of so many variants
        some = np.zeros(out.shape, np.uint8)
        for x, y in zip(a[first:first + 255], b[first:first + 255]):
            np.less(x[:, None], y, out=before)
            some += before.view(np.uint8)
        if len(a) <= 255:
            return some
        out += some
    return narrowed(out)


def duels(some: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the comparisons that ``some`` win over all ``ranks`` and that these win over them, both with ``some`` in rows; codes with variants in rows."""
    kind = next(k for k in (np.uint8, np.uint16, np.int32) if len(ranks) <= np.iinfo(k).max)
    won, lost = (np.empty((some.shape[1], ranks.shape[1]), kind) for _ in range(2))
    for first in range(0, ranks.shape[1], COLUMNS):
        part = slice(first, first + COLUMNS)
        width = len(range(*part.indices(ranks.shape[1])))
        before, after = (np.zeros((some.shape[1], width), kind) for _ in range(2))
        less = np.empty(before.shape, bool)
        for x, y in zip(some, ranks[:, part]):
            np.less(x[:, None], y, out=less)
            before += less.view(np.uint8)
            np.greater(x[:, None], y, out=less)
            after += less.view(np.uint8)
        won[:, part], lost[:, part] = before * (before > after), after * (after > before)
    return won, lost


def won_weights(codes: np.ndarray) -> np.ndarray:
    """The weights of won comparisons between all candidates (0: none), from their codes."""
    ranks = np.ascontiguousarray(codes.T)
    n = len(codes)
    weights = np.zeros((n, n), duels(ranks[:, :0], ranks[:, :0])[0].dtype)
    for first in range(0, n, ROWS):
        some = slice(first, first + ROWS)
        won, lost = duels(ranks[:, some], ranks[:, first:])
        weights[some, first:], weights[first:, some] = won, lost.T
    return weights


def preference_matrix(ranks: np.ndarray) -> np.ndarray:
    """Preferences between all candidates of one matrix."""
    return preferences(ranks, ranks)


def strong(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The weights of won comparisons: ``p`` where it beats its reverse in ``q`` (candidates exchanged), else 0."""
    return narrowed(np.where(p > q.T, p, 0))


def _alike(*tiles: np.ndarray) -> tuple[np.ndarray, ...]:
    """The tiles in the narrowest of their types; larger strengths in the others are cut to its largest."""
    kind = min((x.dtype for x in tiles), key=lambda d: d.itemsize)
    return tuple(x if x.dtype == kind else np.minimum(x, np.iinfo(kind).max).astype(kind) for x in tiles)


ROWS, COLUMNS = 128, 2048  # cells that are updated together, so that they stay in the processor's cache


def max_min(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-min product: the best of ``min(left[a, m], right[m, b])`` over ``m``.

    No minimum exceeds the largest strength of the other side, so both are used in the narrower one's type.
    """
    left, right = _alike(left, right)
    out = np.zeros((left.shape[0], right.shape[1]), left.dtype)
    buf = np.empty((min(ROWS, len(out)), min(COLUMNS, out.shape[1])), out.dtype)
    for first in range(0, len(out), ROWS):
        some = np.ascontiguousarray(left[first:first + ROWS].T)
        for at in range(0, out.shape[1], COLUMNS):
            best = out[first:first + ROWS, at:at + COLUMNS]
            least = buf[:best.shape[0], :best.shape[1]]
            for column, row in zip(some, right[:, at:at + COLUMNS]):
                np.minimum(column[:, None], row, out=least)
                np.maximum(best, least, out=best)
    return out


def closure(strong: np.ndarray) -> np.ndarray:
    """Strongest paths inside one block of candidates: ``n`` numpy steps of ``n^2``."""
    s = strong.copy()
    buf = np.empty_like(s)
    for k in range(s.shape[0]):
        np.minimum(s[:, k:k + 1], s[k:k + 1, :], out=buf)
        np.maximum(s, buf, out=s)
    return s


def widest_paths(pref: np.ndarray) -> np.ndarray:
    """Schulze strongest-path strengths; starts from the pairwise wins only (``p[a,b] > p[b,a]``)."""
    s = closure(strong(pref, pref))
    np.fill_diagonal(s, 0)
    return s


STEPS = 32  # of the next one that is reached, before all others are taken at once


def components(weights: np.ndarray, least: int, among: np.ndarray | None = None) -> list[list[int]]:
    """Strong components of the edges of at least ``least``, each before all that reach it (Tarjan's, with a row a step).

    ``among`` says which candidates count; all do by default.
    """
    n = len(weights)
    unseen = np.ones(n, bool) if among is None else among.copy()
    index, low, open_ = np.empty(n, np.int32), np.empty(n, np.int32), np.full(n, n, np.int32)  # open_: the index while on the stack, else n
    found: list[list[int]] = []
    stack: list[int] = []
    path: list[int] = []
    edge = np.empty(n, bool)
    seen = 0

    def enter(v: int) -> None:
        nonlocal seen
        unseen[v] = False
        index[v] = low[v] = open_[v] = seen
        seen += 1
        stack.append(v)
        path.append(v)

    for start in np.flatnonzero(unseen).tolist():
        if not unseen[start]:
            continue
        enter(start)
        while path:
            u = path[-1]
            np.greater_equal(weights[u], least, out=edge)
            edge &= unseen
            v = int(edge.argmax())
            if edge[v]:
                enter(v)
                continue
            path.pop()
            np.greater_equal(weights[u], least, out=edge)
            first = min(int(low[u]), int(open_.min(where=edge, initial=n)))
            if first < index[u]:
                low[path[-1]] = min(int(low[path[-1]]), first)
                continue
            part = [stack.pop()]
            while part[-1] != u:
                part.append(stack.pop())
            open_[part] = n
            found.append(part)
    return found


def reached_sizes(weights: np.ndarray, least: int, sizes: np.ndarray) -> np.ndarray:
    """The summed ``sizes`` of all that each node reaches over edges of at least ``least``, which have no cycle."""
    n = len(weights)
    order = np.array([u for (u,) in components(weights, least)], np.int64)  # who is reached comes first
    edges = weights[np.ix_(order, order)] >= least
    some = edges.any(1)
    reach, sums, ordered = np.zeros((n, -(-n // 8)), np.uint8), np.zeros(n, np.int64), sizes[order]
    for i in np.flatnonzero(some).tolist():
        got, todo = np.packbits(edges[i]), edges[i] & some
        for _ in range(STEPS):  # whom one of the later ones reaches need not be looked at again
            j = n - 1 - int(todo[::-1].argmax())
            if not todo[j]:
                break
            got |= reach[j]
            todo &= ~np.unpackbits(reach[j], count=n).view(bool)
            todo[j] = False
        else:
            got |= np.bitwise_or.reduce(reach[todo], axis=0)
        reach[i] = got
        sums[i] = ordered[np.unpackbits(got, count=n).view(bool)].sum()
    out = np.empty(n, np.int64)
    out[order] = sums
    return out


def strongest_path_wins(weights: np.ndarray) -> np.ndarray:
    """Wins of every candidate by strongest paths from the weights of won comparisons, which are used up.

    Edges are let in from the largest weight down.  Two candidates beat or tie each other by what they
    reached just before they came into one strong component, so components are found a weight, not paths a pair:
    no more than ``n^2`` steps a weight and, among those that join at one weight, what reaches what.
    """
    n = len(weights)
    np.fill_diagonal(weights, 0)
    wins, sizes = np.zeros(n, np.int64), np.ones(n, np.int64)
    members = [np.array([i]) for i in range(n)]
    alive = np.ones(n, bool)
    most = np.iinfo(weights.dtype).max
    levels = np.unique(np.concatenate([np.unique(row) for row in weights] or [np.zeros(0, weights.dtype)]))[::-1]
    above = most + 1  # no edge

    def settle(nodes: np.ndarray) -> None:
        beaten = reached_sizes(weights[np.ix_(nodes, nodes)], above, sizes[nodes])
        for u, more in zip(nodes.tolist(), beaten.tolist()):
            wins[members[u]] += more

    for level in levels[levels > 0].tolist():
        linked = alive & (weights.max(1, initial=0) >= level)
        for part in components(weights, level, linked):
            if len(part) == 1:
                continue
            nodes = np.array(part)
            settle(nodes)
            one, others = nodes[0], nodes[1:]
            weights[one] = weights[nodes].max(0)
            weights[:, one] = weights[:, nodes].max(1)
            weights[one, one] = 0
            weights[others] = 0
            weights[:, others] = 0
            sizes[one] = sizes[nodes].sum()
            members[one] = np.concatenate([members[u] for u in part])
            alive[others] = False
        above = level
        if alive.sum() < 0.8 * len(alive):
            weights, sizes, members = weights[np.ix_(alive, alive)], sizes[alive], [members[u] for u in np.flatnonzero(alive)]
            alive = np.ones(len(weights), bool)
    if above <= most:
        settle(np.flatnonzero(alive))
    return wins


def leaders(ranks: np.ndarray, top: int, room: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The candidates whose min-rank by wins is at most ``top``, and that rank, from codes; None if it takes more than ``room`` cells.

    Some candidates and all that get to them by a path of at least ``level`` are compared with each other, so
    their paths of that strength are known, and no other one has such a path to them.  A pair with such a path is
    decided.  Whoever surely loses to ``top`` others has as many above in wins.  The level is lowered until that
    goes for all but some whose pairs are all decided; at the last one every candidate is compared.
    Candidates with the same ranks tie and stand as one with their number.
    """
    _, first, alike, size = np.unique(ranks.view(f"V{ranks.itemsize * ranks.shape[1]}").ravel() if ranks.size else np.zeros(len(ranks)),
                                      return_index=True, return_inverse=True, return_counts=True)
    votes = (ranks[first] < np.iinfo(ranks.dtype).max).sum(1)  # no path from a candidate is stronger
    order = np.argsort(-votes, kind="stable")
    ranks, votes, size = np.ascontiguousarray(ranks[first[order]].T), votes[order], size[order]
    n, total = len(first), size.sum()
    seeds = np.arange(min(FEW, n))
    level = int(votes[FEW - 1]) if FEW < n else 0
    while True:
        if level < 1:
            seeds = np.arange(n)
        found = _upstream(ranks, votes, seeds, max(level, 1), room)
        if found is None:
            return None
        some, paths, below = found
        own = size[some]
        if len(some) < n:
            paths[paths < level] = 0
        paths = closure(paths)
        np.fill_diagonal(paths, 0)
        beats = paths > paths.T
        open_ = (paths == 0) & (paths.T == 0) & (len(some) < n)  # with all compared: a tie
        np.fill_diagonal(open_, False)
        front = np.flatnonzero(own @ beats < top)
        weight, outside = own[front], total - own.sum()
        least, undecided = beats[front] @ own, open_[front] @ own
        at_most = outside + least + undecided

        def not_out(least: np.ndarray) -> np.ndarray:
            return (least[None] > at_most[:, None]) @ weight < top

        done, missed = len(some) == n, np.zeros(0, np.int64)
        if not done and not ((undecided > 0) & not_out(least + outside)).any():
            others = np.delete(np.arange(n), some)
            over = paths[front] >= level
            over[np.arange(len(front)), front] = True
            vias = np.union1d(front, np.argsort(some)[:FEW // 4])
            ahead = _reached(ranks, over[:, vias], some[vias], others, level)
            missed = np.flatnonzero(~ahead[not_out(least + ahead @ size[others])].all(0) | (weight @ ahead < top))
            if len(missed) <= len(some):
                ahead[:, missed] = _reached(ranks, over, some, others[missed], level)
                least = least + ahead @ size[others]
                done = (weight @ ahead >= top).all() and (least == at_most)[not_out(least)].all()
                missed = others[~ahead[not_out(least)].all(0) | (weight @ ahead < top)]
            else:
                missed = missed[:0]
        kept = not_out(least)
        if done:
            least, weight = least[kept], weight[kept]
            rank = 1 + (least[None] > least[:, None]) @ weight
            found = np.zeros(n, np.int64)
            found[order[some[front[kept][rank <= top]]]] = rank[rank <= top]
            places = np.flatnonzero(found[alike] > 0)
            return places, found[alike][places].astype(np.float64)
        if len(missed):
            seeds = np.concatenate([some[front[kept]], missed])  # at the same level
        else:
            seeds, level = some[front[kept]], below


FEW = 256


def _upstream(ranks: np.ndarray, votes: np.ndarray, seeds: np.ndarray, level: int, room: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """``seeds`` and all that get to them by edges of at least ``level``, the weights between all these, and a bound on all lesser weights to them."""
    m = max(int((votes >= level).sum()), int(seeds.max(initial=-1)) + 1)  # the others have no such edge
    new, size, old = seeds, 0, np.zeros(m, bool)
    some, weights = [], []
    below = int(votes[m]) if m < len(votes) else 0
    while len(new):
        size += len(new)
        if size * m > room:
            return None
        some.append(new)
        weights.append(duels(ranks[:, new], ranks[:, :m])[1])
        below = max(below, int(weights[-1].max(where=weights[-1] < level, initial=0)))
        old[new] = True
        new = np.flatnonzero((weights[-1] >= level).any(0) & ~old)
    found = np.concatenate(some)
    return found, np.concatenate([w[:, found] for w in weights]).T.copy(), min(below, level - 1)


def _reached(ranks: np.ndarray, over: np.ndarray, vias: np.ndarray, to: np.ndarray, level: int) -> np.ndarray:
    """Which of ``to`` an edge of at least ``level`` reaches from those of ``vias`` that a row of ``over`` has."""
    edges = duels(ranks[:, vias], ranks[:, to])[0] >= level
    return over.astype(np.float32) @ edges.astype(np.float32) > 0


def wins_and_rank(strength: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Wins per candidate and the min-rank by wins descending (1 = earliest)."""
    wins = (strength > strength.T).sum(axis=1)
    rank = pd.Series(wins).rank(method="min", ascending=False).to_numpy(dtype=np.float64)
    return wins.astype(np.int64), rank


def rank_matrix(locations: np.ndarray, variant: pd.Series, r: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Long votes -> (candidate labels, n x v rank matrix).

    Rows with a null variant only declare a candidate (no vote).
    """
    loc_idx, labels = pd.factorize(locations)  # hash-based: no sort of Python strings
    labels = np.asarray(labels, dtype=object)
    has_vote = variant.notna().to_numpy() & r.notna().to_numpy()
    var_codes, var_labels = pd.factorize(variant[has_vote])
    ranks = np.full((len(labels), len(var_labels)), np.nan)
    ranks[loc_idx[has_vote], var_codes] = r[has_vote].to_numpy(dtype=np.float64)
    return labels, ranks
