import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onsetlake.llm import registry, secrets

SF = "/root/testdata/sf0.01"
PLAIN = {
    "assign": re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}
LEAST = {"assign": (2, 8), "access": (0, 16), "hex": (0, 32)}


def brute(rows):
    out = []
    for key, text in rows:
        text = text or ""
        base = sorted((m.start(), i, kind, m.end()) for i, (kind, p) in enumerate(PLAIN.items())
                      for m in p.finditer(text) if len(m[LEAST[kind][0]]) >= LEAST[kind][1])
        more = [(a, 3 + i, r.kind, b) for i, r in enumerate(secrets.MORE_RULES) for a, b in secrets.spans(text, r)]
        join = lambda s: ",".join(f"{k}:{a}:{b}" for a, _, k, b in s)
        kinds = [k for _, _, k, _ in base]
        out.append((key, *map(kinds.count, PLAIN), hashlib.sha256(join(base).encode()).hexdigest(), join(sorted(base + more))))
    return sorted(out, key=str)


def test_queries():
    asked = secrets.queries_of(secrets.RULES)
    assert set(asked) == {"assign", "access", "key_block", "web_token", "prefixed", "address"}
    assert asked["access"] == {frozenset(["aki", "kia"])}
    assert frozenset(["tok", "oke", "ken"]) in asked["assign"] and len(asked["assign"]) == 6
    assert secrets.trigram_query(r"[0-9]+") == frozenset() and secrets.trigram_query(r"ab|x.") == frozenset()
    assert secrets.trigram_query(r"(abc)*d") == frozenset() and secrets.trigram_query(r"a(bc|de)+f?") == frozenset()


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([r.pattern for r in secrets.RULES] + [r"a(bcd|efg)+h?", r"(abc){2}x*yz[0-9]w", r"x?abcd$"]), st.data())
def test_every_match_satisfies_its_query(pattern, data):
    text = data.draw(st.from_regex(re.compile(pattern, re.ASCII)))
    query = secrets.trigram_query(pattern)
    low = text.encode().lower()
    assert not query or any(all(g.encode() in low for g in s) for s in query)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op8_secret_scan(spark, SF).collect()
    want = brute(rows)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want and any(r[5] for r in want)


@pytest.mark.parametrize("rows", [[], [
    (None, None), (1, ""), (1, ""), (2, "PassWord = 'short' token:longenough1 ſecret=abcdefghij toKen=abcdefghij"),
    (3, "é" * 5 + "AKIA" + "Q" * 20 + " deadbeef" * 9 + "0" * 40), (3, "é" * 5 + "AKIA" + "Q" * 20 + " deadbeef" * 9 + "0" * 40),
    (4, "x " * 60_000 + "api_key=" + "z" * 12 + "\n-----BEGIN RSA PRIVATE KEY-----"), (5, "ap"), (6, "pas\nsword=abcdefgh"),
    (7, "http://me:secretpw@host.example token=token=abcdefgh1")]])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, rules string, gram int")
    assert sorted((tuple(r)[:6] for r in registry.secret_digest(df).collect()), key=str) == brute(rows)
