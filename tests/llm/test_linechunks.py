import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from onsetlake.llm import linechunks, registry

SF = "/root/testdata/sf0.001"


@given(st.text(st.sampled_from("ab\né"), max_size=60))
def test_chunks_are_the_text(text):
    parts = linechunks.chunks(text)
    assert b"\n".join(parts).decode() == text
    assert all(p.count(b"\n") >= 1 for p in parts[:-1])


def test_boundaries_shift_with_the_text():
    rnd = random.Random(2)
    lines = [f"line {rnd.random()}" for _ in range(400)]
    a = linechunks.chunks("\n".join(lines))
    b = linechunks.chunks("\n".join(["new first line", *lines[:200], "put in", *lines[200:]]))
    assert len(set(a) & set(b)) >= len(a) - 8


def brute(rows):
    seen, out = {}, []
    for key, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for place, c in enumerate(linechunks.chunks(text or "")):
            if linechunks.removable(c, 2):
                seen.setdefault(c, (key, text, place))
    for key, text in rows:
        own = linechunks.chunks(text) if text is not None else []
        keep = [c for p, c in enumerate(own) if c not in seen or seen[c] == (key, text, p)]
        out.append((key, len(own), len(own) - len(keep), text if len(keep) == len(own) else b"\n".join(keep).decode()))
    return sorted(out, key=str)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op6_line_chunk_dedup(spark, SF).select("doc_id", "n_chunks", "n_removed", "text").collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=str) == want and any(r[2] for r in want)


BLOCK = "\n".join(f"shared line {k}" for k in range(40))


@pytest.mark.parametrize("rows", [[], [
    (None, None), (1, ""), (5, BLOCK), (3, "own\n" + BLOCK + "\nend"), (3, "own\n" + BLOCK + "\nend"), (9, BLOCK + "\n" + BLOCK),
    (4, "\n\n\n\n\n\n\n\n"), (6, "\n\n\n\n\n\n\n\n"), (7, "one line"), (8, "one line"), (None, BLOCK), (11, "x\n" * 30_000)]])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, 4, "h") for r in rows], "doc_id long, text string, n_chunks int, h1 string")
    got = linechunks.deduplicated(df)
    assert got.columns == ["doc_id", "text", "h1", "n_chunks", "n_removed"]
    assert sorted(map(tuple, got.select("doc_id", "n_chunks", "n_removed", "text").collect()), key=str) == brute(rows)
