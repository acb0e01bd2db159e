"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must contain (in lower case, so that letters of either case
agree).  The index holds, for each trigram that some rule asks for, the
documents that contain it; a rule's postings are intersected and united as its
query says, and only the candidates are searched with the expression itself.
Rules whose query is empty search every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as regex_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SLICE_BYTES = 2 << 20
MOST_STRINGS = 24  # per part of an expression; a part with more gives no trigrams


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (ASCII rules for letters) whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The kinds and expressions that the scan must report.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)

#: Further well-known forms: key blocks, signed web tokens, prefixed access tokens, passwords in addresses.
MORE_RULES = (
    Rule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("prefixed", r"(?:ghp|gho|ghs|ghu)_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"),
    Rule("address", r"[a-z][a-z0-9+]{1,15}://[^\s:@/]+:[^\s:@/]{3,}@[A-Za-z0-9.-]+"),
)
RULES = BASE_RULES + MORE_RULES


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """Trigrams in lower case that every match contains: one of the sets, with all of its trigrams.

    An empty result, or an empty set in it, says nothing: the rule must search every document.
    """
    _, choices = _strings(regex_parser.parse(pattern, re.ASCII))
    if frozenset() in choices:
        return frozenset()
    return frozenset(c for c in choices if not any(other < c for other in choices))


ANY = frozenset([frozenset()])


def _both(a: frozenset, b: frozenset) -> frozenset:
    """Alternatives of all of one choice and all of another, or the more telling one if these are too many."""
    if len(a) * len(b) > MOST_STRINGS:
        return max((a, b), key=lambda c: min(map(len, c)))
    return frozenset(x | y for x in a for y in b)


def _grams(strings: set[str]) -> frozenset:
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings) if strings else ANY


def _strings(parsed) -> tuple[set[str] | None, frozenset]:
    """The strings that a sequence can match, in lower case (None: too many), and its trigram alternatives."""
    exact: set[str] | None = {""}
    run: set[str] = {""}  # of the known strings since the last unknown part
    choices = ANY

    def unknown() -> None:
        nonlocal exact, run, choices
        choices, exact, run = _both(choices, _grams(run)), None, {""}

    for kind, value in parsed:
        inner_choices = ANY
        if kind is op.LITERAL:
            inner = {chr(value).lower()} if value < 128 else None
        elif kind is op.SUBPATTERN:
            inner, inner_choices = _strings(value[-1])
        elif kind is op.BRANCH:
            found = [_strings(branch) for branch in value[1]]
            inner = set().union(*[s for s, _ in found]) if all(s is not None for s, _ in found) else None
            inner_choices = frozenset().union(*[c if s is None else _grams(s) for s, c in found])
        elif kind is op.IN and len(value) <= 4 and all(k is op.LITERAL and v < 128 for k, v in value):
            inner = {chr(v).lower() for _, v in value}
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, body = value
            inner, inner_choices = _strings(body)
            if (least, most) == (0, 1) and inner is not None:
                inner, inner_choices = inner | {""}, ANY
            elif (least, most) != (1, 1):
                if least == 0:
                    inner_choices = ANY
                elif inner is not None:
                    inner_choices = _grams(inner)
                inner = None
        elif kind is op.AT:
            continue
        else:
            inner = None
        if inner is None:
            unknown()
            choices = _both(choices, inner_choices)
            continue
        joined = {a + b for a in run for b in inner}
        if len(joined) > MOST_STRINGS:
            unknown()
            joined = inner if len(inner) <= MOST_STRINGS else {""}
        run = joined
        if exact is not None:
            exact = run
    return exact, choices if exact is not None and not run else _both(choices, _grams(run))


def queries_of(rules: tuple[Rule, ...]) -> dict[str, frozenset[frozenset[str]]]:
    """Per rule its trigram alternatives; rules without are left out."""
    return {r.kind: q for r in rules if (q := trigram_query(r.pattern))}


def _codes(grams: list[str]) -> list[int]:
    return [int.from_bytes(g.encode(), "big") for g in grams]


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, _k1, _k2): the index, for the asked trigrams (ASCII) of every whole text in lower case."""
    codes = np.array(sorted(_codes(grams)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << 24, np.uint8)
        wanted[codes] = 1
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        for batch in batches:
            for part in common.sliced(batch, SLICE_BYTES):
                buffer, at = common.text_buffer(part.column("text"))
                if len(buffer) < 3:
                    continue
                b = low[buffer].astype(np.int32)
                here = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
                places = np.flatnonzero(wanted[here])
                row = np.searchsorted(at, places, "right") - 1
                inside = places + 3 <= at[row + 1]
                pairs = np.unique(row[inside] * len(codes) + np.searchsorted(codes, here[places[inside]]))
                row, gram = pairs // len(codes), codes[pairs % len(codes)]
                yield pa.RecordBatch.from_pydict({
                    "gram": pa.array(gram.astype(np.int32)),
                    "_k1": part.column("_k1").take(pa.array(row)), "_k2": part.column("_k2").take(pa.array(row))})

    return docs.select("_k1", "_k2", F.col("text").cast("string").alias("text")) \
        .mapInArrow(common.released(run), "gram int, _k1 long, _k2 long")


def candidates(index: DataFrame, queries: dict[str, frozenset[frozenset[str]]]) -> DataFrame:
    """(_k1, _k2, rules): per document the rules whose query its postings satisfy.

    A document has one row for each asked trigram at most, so groups are
    bounded by the rules.
    """
    grams = sorted({g for q in queries.values() for s in q for g in s})
    number = {g: i for i, g in enumerate(grams)}
    words = -(-len(grams) // 63)
    bits = []
    for w in range(words):
        mine = [F.lit(x) for g in grams if number[g] // 63 == w for x in (_codes([g])[0], 1 << number[g] % 63)]
        bit = F.element_at(F.create_map(*mine).cast("map<int, bigint>"), F.col("gram"))
        bits.append(F.bit_or(F.coalesce(bit, F.lit(0))).alias(f"_b{w}"))
    held = index.groupBy("_k1", "_k2").agg(*bits)

    def has(all_of: frozenset[str]):
        masks = [0] * words
        for g in all_of:
            masks[number[g] // 63] |= 1 << number[g] % 63
        return [F.col(f"_b{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m]

    def any_of(conditions):
        out = F.lit(False)
        for c in conditions:
            out = out | c
        return out

    def every(conditions):
        out = F.lit(True)
        for c in conditions:
            out = out & c
        return out

    found = [F.when(any_of(every(has(s)) for s in q), F.lit(kind)) for kind, q in sorted(queries.items())]
    return held.select("_k1", "_k2", F.array_compact(F.array(*found)).alias("rules")).where(F.size("rules") > 0)


def spans(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Spans of a rule's matches, leftmost and without overlap; those whose group is too short are dropped after matching."""
    return [m.span() for m in re.finditer(rule.pattern, text, re.ASCII) if len(m[rule.group]) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id") -> DataFrame:
    """One row a document: key, ``spans`` array of (kind, start, end), by start and then by the rules' order.

    Places are code points, ends exclusive.  Null and empty texts have no
    spans; repeated rows share their spans and all stay; an empty table gives
    no rows; other columns are left out.
    """
    common.bounded_batches(docs.sparkSession)
    keyed = common.with_row_key(docs.select(key, "text"), key, "text")
    asked = queries_of(rules)
    index = postings(keyed, sorted({g for q in asked.values() for s in q for g in s}))
    found = candidates(index, asked)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, chosen in zip(common.texts_of(batch.column("text")), batch.column("rules").to_pylist()):
            hits = [(a, i, b) for i, r in enumerate(rules) if r.kind not in asked or r.kind in (chosen or ())
                    for a, b in spans(text, r)]
            out.append([{"kind": rules[i].kind, "start": a, "end": b} for a, i, b in sorted(hits)])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, kind)], [key, "spans"])

    name = docs.schema[key].dataType.simpleString()
    joined = keyed.join(found, ["_k1", "_k2"], "left").select(key, F.col("text").cast("string").alias("text"), "rules")
    return common.mapped(joined, f"`{key}` {name}, spans array<struct<kind: string, start: long, end: long>>", run)
