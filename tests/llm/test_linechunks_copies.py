import pyarrow.parquet as pq
import pytest

from onsetlake.llm import linechunks

SF = "/root/testdata/sf0.01"


def kept_lines(rows):
    """Per text the numbers of the lines that stay, smallest key first."""
    seen = set()
    for _, text in sorted(rows):
        at, stay = 0, set()
        for c in linechunks.chunks(text):
            n = c.count(b"\n") + 1
            if not linechunks.removable(c, 2) or c not in seen:
                stay.update(range(at, at + n))
            if linechunks.removable(c, 2):
                seen.add(c)
            at += n
        yield text.split("\n"), stay


def test_later_copies_and_repeated_runs():
    rows = [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    texts, pairs, repeated, removed, copies = set(), set(), 0, 0, 0
    for lines, stay in kept_lines(rows):
        worded = [i for i, x in enumerate(lines) if x.split()]
        text = "\n".join(lines)
        if text in texts and len(worded) >= 2:
            copies += 1
            assert not any(i in stay for i in worded)
        texts.add(text)
        run, own = set(), set()
        for i, j in zip(worded, worded[1:]):
            if (lines[i], lines[j]) in pairs or (lines[i], lines[j]) in own:
                run |= {i, j}
            own.add((lines[i], lines[j]))
        pairs |= own
        repeated += sum(len(lines[i].split()) for i in run)
        removed += sum(len(lines[i].split()) for i in run - stay)
    assert copies > 50 and removed >= 0.9 * repeated


@pytest.mark.parametrize("n", range(2, 40))
def test_every_chunk_has_lines_with_words(n):
    for blank in ("", "\n"):
        parts = linechunks.chunks("\n".join(f"line {k * n}{blank}" for k in range(n)) + "\n")
        assert all(linechunks.removable(p, 2) for p in parts)


def test_exact_copies_leave_nothing(spark):
    text = "\n".join(f"line {k} of the text" for k in range(23))
    docs = spark.createDataFrame([(k, text[:-k or None].rstrip()) for k in (0, 0)] + [(9, text), (8, text), (7, "a\n\nb"), (10, "a\n\nb")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.text for r in linechunks.deduplicated(docs).collect()}
    assert got == {0: text, 8: "", 9: "", 7: "a\n\nb", 10: ""}
