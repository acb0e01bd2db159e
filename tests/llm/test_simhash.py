import random
import re

import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from onsetlake.llm import registry, simhash

SF = "/root/testdata/sf0.001"


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [(d, plain(t)) for d, t in rows]
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fp:016x}", least.get(find(i))) for i, (d, fp) in enumerate(fps)), key=str)


@given(st.text(st.sampled_from("aBZé \t\n\x0b\x1c\x85"), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3, 42) == plain(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c')").first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op3_simhash_near_dup(spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_odd_rows(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(None, None), (7, ""), (4, " \n"), (9, "one"), (2, "one"), (2, "one"), (None, "two words")]
    rows += [(100 + k, " ".join(words[:k] + ["new"] + words[k + 1:])) for k in range(0, 400, 7)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, root string")
    got = simhash.near_duplicates(df).collect()
    assert sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=str) == brute(rows)
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    n = len({(c, f if c is None else "") for _, f, c in brute(rows)})
    assert kept.count() == n
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [4, 2048])
def test_large_groups_are_dealt_out(spark, tile):
    rnd = random.Random(5)
    fps = {0}
    while len(fps) < 120:
        base = rnd.choice(sorted(fps))
        fps.add(base ^ sum(1 << b for b in rnd.sample(range(63), rnd.choice([1, 2, 3, 9]))))
    rows = sorted(fps)
    found = simhash.links(spark.createDataFrame([(f,) for f in rows], "fp long"), tile=tile).collect()
    assert all((r.u ^ r.v).bit_count() <= 3 for r in found)

    def classes(pairs):
        label = {f: f for f in rows}

        def find(x):
            while label[x] != x:
                x = label[x]
            return x

        for u, v in pairs:
            label[find(u)] = find(v)
        return {f: min(g for g in rows if find(g) == find(f)) for f in rows}

    assert classes([(r.u, r.v) for r in found]) == classes(
        [(a, b) for a in rows for b in rows if a > b and (a ^ b).bit_count() <= 3])
