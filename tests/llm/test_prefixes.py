import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from onsetlake.llm import prefixes

NONE = -10**9


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """The trie from lists of turns, node by node."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, digest(r or "", x or ""), r or "", x or ""))
    made, members, ends, kids = {}, defaultdict(list), defaultdict(list), defaultdict(list)
    for v in convs.values():
        v.sort(key=lambda y: y[:3])
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        giver = c - abs(c) % 100 * (1 if c >= 0 else -1)
        made[c] = [y[3:] for y in convs.get(giver, [])[:h]] + [y[3:] for y in v[h:]]
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        last = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * last + sum(saved[x] for x in kids[node])
        leaves[node] = sum(leaves[x] for x in kids[node]) if kids[node] else 1
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else NONE, len(m), len(kids[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def trie(df):
    return sorted((r.conv_id, r.depth, NONE if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in prefixes.prefix_trie(df).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_trie_equals_brute_force(spark):
    """Null turns, roles, texts and ids, ties, repeated rows, absent givers, negative ids, copies, and one conversation
    with a third of all rows, which several tasks share."""
    rng = random.Random(1)
    rows = [(c, rng.choice([t, t, t, None, 3]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é", None, "zzz"]))
            for c in (*range(40), *range(95, 130), 205, 300, 301, -3, -150) for t in range(rng.choice([0, 1, 3, 7, 9, 14]))]
    rows += [(7, t, "u", rng.choice(["x", "yy"])) for t in range(300)]
    rows += [(c, t, "u", "same") for c in range(1000, 1040) for t in range(11)]
    rows += [(None, 1, "u", "x"), *rows[:30]]
    df = frame(spark, rows).withColumn("depth", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("d", F.lit(2))
    assert trie(df) == brute(rows)


def test_long_lists_of_ends_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "CHUNK", 40)
    rows = [(100 * c, 0, "u", "hello") for c in range(500)] + [(100 * c, 1, "a", str(c % 3)) for c in range(0, 500, 2)]
    assert trie(frame(spark, rows)) == brute(rows)


def test_empty_and_turnless(spark):
    assert trie(frame(spark, [])) == []
    assert trie(frame(spark, [(None, 0, "u", "x")])) == []
    rows = [(c, 0, "u", "one") for c in range(101, 120)]  # no giver, and most lose their only turn
    assert trie(frame(spark, rows)) == brute(rows)
    long = [(1, t, "u", "w" * 50_000) for t in range(9)]
    assert trie(frame(spark, long)) == brute(long)
