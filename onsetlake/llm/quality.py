"""Quality rules: repetition within a text, and lines that many texts of a host share.

Lines are normalised and hashed, the distinct texts of each host that hold a
line are counted, and lines in more than a limit's share of them are boilerplate.
They are removed, and documents that lose too much are rejected.  Copies of one
text count once: how often a text itself is repeated is for deduplication.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SYMBOLS = frozenset("#*$%&|<>")
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rules:
    """``min_words`` and ``max_repeat`` (share of words in repeated windows) reject at once.

    A line is boilerplate where more than ``max_share`` of its host's distinct
    texts hold it, and more than ``min_texts``: a small count that tells repetition
    from chance, the same for hosts of every size.  A document that keeps fewer
    than ``min_words`` words, or less than ``min_left`` of them, is depleted.
    """

    min_words: int = 50
    max_repeat: float = 0.5
    window: int = 3
    max_share: float = 0.05
    min_texts: int = 2
    min_left: float = 0.5


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows that the text holds twice or more, the first included."""
    grams = list(zip(*[words[k:] for k in range(window)]))
    if len(set(grams)) == len(grams):
        return 0
    times = Counter(grams)
    total = end = 0
    for i, gram in enumerate(grams):
        if times[gram] > 1:
            total += i + window - max(end, i)
            end = i + window
    return total


def line_key(line: str) -> bytes:
    """Hash of a normalised line: lower case, digits as 0, white space as single spaces; empty for blank lines."""
    words = line.lower().encode().translate(_DIGITS).split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else b""


_DIGITS = bytes(48 if 48 <= b <= 57 else b for b in range(256))


def measure(text: str, window: int) -> dict:
    raw = text.encode()
    words = raw.split()
    lines = Counter()
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if n := len(line.encode().split()):
            dup += line in seen
            seen.add(line)
            lines[line_key(line)] += n
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, WHITE)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(words, window),
        "lines": [{"line": k, "words": n} for k, n in lines.items()],
    }


MEASURES = pa.schema([
    *[(n, pa.int64()) for n in ("_k1", "_k2")], ("_host", pa.string()), ("_t1", pa.int64()), ("_t2", pa.int64()),
    *[(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    ("lines", pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())])))])
_SQL = ("_k1 long, _k2 long, _host string, _t1 long, _t2 long, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lines array<struct<line: binary, words: long>>")


def measures(keyed: DataFrame, window: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [batch.column(n).to_pylist() for n in ("_k1", "_k2", "_host", "_t1", "_t2")]
        rows = [dict(zip(MEASURES.names, key)) | measure(text or "", window)
                for *key, text in zip(*own, batch.column("text").to_pylist())]
        return pa.RecordBatch.from_pylist(rows, schema=MEASURES)

    return common.mapped(keyed.select("_k1", "_k2", "_host", "_t1", "_t2", F.col("text").cast("string").alias("text")),
                         _SQL, run)


def _keyed(docs: DataFrame, key: str, host: str) -> DataFrame:
    texts = common.with_row_key(docs.select(key, host, "text"), "text") \
        .withColumnsRenamed({"_k1": "_t1", "_k2": "_t2"})
    return common.with_row_key(texts, key, host, "text").withColumn("_host", F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")))


def judged(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", host: str = "source") -> tuple[DataFrame, DataFrame]:
    """Verdicts (_k1, _k2, measures, n_boilerplate, base_failed, kept) of distinct rows, and (_k1, _k2, drop: line keys)."""
    common.bounded_batches(docs.sparkSession)
    measured = common.stored(measures(_keyed(docs, key, host), rules.window), "quality")
    lines = measured.select("_host", "_t1", "_t2", F.explode("lines").alias("l")).select("_host", "_t1", "_t2", "l.line")
    texts = measured.select("_host", "_t1", "_t2").distinct().groupBy("_host").agg(F.count("*").alias("_texts"))
    common_lines = lines.distinct().groupBy("_host", "line").agg(F.count("*").alias("n")) \
        .where(F.col("n") > rules.min_texts).join(texts, "_host") \
        .where(F.col("n") > rules.max_share * F.col("_texts")).select("_host", "line")
    common_lines = common.stored(common_lines, "boilerplate")
    held = measured.select("_k1", "_k2", "_host", F.explode("lines").alias("l")) \
        .select("_k1", "_k2", "_host", "l.line", "l.words").distinct().join(common_lines, ["_host", "line"])
    drop = common.stored(held.groupBy("_k1", "_k2").agg(
        F.sum("words").alias("n_boilerplate"), F.collect_set("line").alias("drop")), "drop")
    base = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > rules.max_repeat * 100 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_boilerplate")
    gone = (F.col("n_boilerplate") > 0) & ((left < rules.min_words) | (left < rules.min_left * F.col("n_words")))
    verdicts = measured.drop("lines", "_host", "_t1", "_t2").dropDuplicates(["_k1", "_k2"]) \
        .join(drop.select("_k1", "_k2", "n_boilerplate"), ["_k1", "_k2"], "left").fillna(0, ["n_boilerplate"]) \
        .withColumn("base_failed", base).withColumn("kept", ~base & ~gone)
    return verdicts, drop.select("_k1", "_k2", "drop")


def quality(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", host: str = "source") -> DataFrame:
    """One row a document: key, its measures, n_boilerplate (words in boilerplate lines), base_failed and kept.

    Null and empty texts have no words and fail; a null host is a host of its
    own; repeated rows share a verdict and all stay; an empty table gives no
    rows; other columns are left out.
    """
    verdicts, _ = judged(docs, rules, key, host)
    return _keyed(docs, key, host).select(key, "_k1", "_k2").join(verdicts, ["_k1", "_k2"]).drop("_k1", "_k2")


def cleaned(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", host: str = "source") -> DataFrame:
    """The kept rows of ``docs`` without their boilerplate lines; ``n_chars``, if there, follows the text."""
    verdicts, drop = judged(docs, rules, key, host)
    kept = _keyed(docs, key, host).select("_k1", "_k2").distinct().join(
        verdicts.where("kept").select("_k1", "_k2"), ["_k1", "_k2"]).join(drop, ["_k1", "_k2"], "left")
    own = common.with_row_key(docs, key, host, "text").join(kept, ["_k1", "_k2"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        for i, gone in enumerate(batch.column("drop").to_pylist()):
            if gone:
                gone = set(gone)
                texts[i] = "\n".join(line for line in texts[i].split("\n") if line_key(line) not in gone)
        columns = {n: batch.column(n) for n in names}
        columns["text"] = pa.array(texts, columns["text"].type)
        if "n_chars" in columns:
            sizes = [None if t is None else len(t) for t in texts]
            columns["n_chars"] = pa.array(sizes, pa.int64()).cast(columns["n_chars"].type)
        return pa.RecordBatch.from_pydict(columns)

    names = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return common.mapped(own.select(*names, "drop"), kinds, run)
