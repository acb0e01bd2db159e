import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from onsetlake.llm import quality, registry

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


@given(st.text(st.sampled_from("ab#é \n\t\x1c\x0b漢1"), max_size=60))
def test_measures(text):
    assert tuple(quality.measure(text, 3)[n] for n in quality.MEASURES.names[5:10]) == base(text)


def key(line):
    return " ".join(WORD.findall(re.sub("[0-9]", "0", line.lower())))


def brute(rows, rules):
    texts, holders = {}, {}
    for _, host, text in rows:
        host = host or ""
        texts.setdefault(host, set()).add(text)
        for k in {key(x) for x in (text or "").split("\n")} - {""}:
            holders.setdefault((host, k), set()).add(text)
    bad = {hk for hk, t in holders.items() if len(t) > max(rules.min_texts, rules.max_share * len(texts[hk[0]]))}
    out = []
    for doc, host, text in rows:
        m = base(text)
        failed = m[0] < rules.min_words or 100 * m[4] > 100 * rules.max_repeat * m[0]
        gone = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if (host or "", key(x)) in bad)
        left = m[0] - gone
        out.append((doc, *m, gone, failed, not failed and not (gone and (left < rules.min_words or left < rules.min_left * m[0]))))
    return sorted(out, key=str), bad


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()]
    got = registry.op4_quality_rules(spark, SF).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_boilerplate", "base_failed", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, quality.Rules())[0]


@pytest.mark.parametrize("rows", [[], [
    (None, None, None), (1, "a", ""), (1, "a", ""), (2, "a", " \n\n"), (3, None, "# x\n# x\n" * 3000),
    *[(k, "a", f"Top line {k}\nown words number {k} are here\nmore of text {k * 7} x\nEnd") for k in range(10, 18)],
    *[(k, "b", "copy of\none text that is long enough") for k in range(20, 29)],
    (30, "a", "top  LINE 9\nend\nEND"), (31, "c", "end\nend")]])
def test_odd_rows_and_hosts(spark, rows):
    rules = quality.Rules(min_words=5, max_repeat=0.9, max_share=0.3, min_texts=3)
    df = spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id long, source string, text string, n_chars long, lines string")
    want, bad = brute(rows, rules)
    got = quality.quality(df, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                            "n_boilerplate", "base_failed", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == want
    kept = quality.cleaned(df, rules)
    assert kept.columns == df.columns
    alive = {r[0] for r in want if r[-1]}
    texts = sorted("\n".join(x for x in t.split("\n") if (h or "", key(x)) not in bad) for d, h, t in rows if d in alive)
    assert sorted(r.text for r in kept.collect()) == texts
    assert all(r.n_chars == len(r.text) for r in kept.collect())
