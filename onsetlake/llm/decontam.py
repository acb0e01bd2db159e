"""Benchmark decontamination by winnowing.

Words are hashed, k consecutive words make a gram, and of every ``w``
consecutive grams the smallest hash is kept (ties: the last).  With
``k + w - 1 = span`` every run of ``span`` words holds a kept gram, and equal
runs keep the same one, so joining the kept grams of documents and benchmark
items finds every shared run of that length.  Each hit is then extended word by
word on the texts themselves, so hash collisions add nothing.

An item shorter than ``span`` counts as one window of its own length; such
lengths are winnowed as spans of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPAN, GRAM = 13, 6
SLICE_BYTES = 1 << 20
_PLACE = 24
_KEYS = "_k1 long, _k2 long"


def word_table() -> np.ndarray:
    """Byte to byte: A-Z to lower case, word bytes (0-9, a-z, above 0x7F) to themselves, all others to 0."""
    b = np.arange(256)
    low = np.where((b >= 65) & (b <= 90), b + 32, b)
    word = (b >= 128) | ((b >= 48) & (b <= 57)) | ((low >= 97) & (low <= 122))
    return np.where(word, low, 0).astype(np.uint8)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(word_table().tobytes()).replace(b"\0", b" ").split(b" ") if text else []


def clean_words(text: str | None) -> list[bytes]:
    """The words of a text, in order, as bytes."""
    return [w for w in words_of(text) if w]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64, kept by the worker."""
    state = common.worker_state()
    if len(state.get("powers", ((),))[0]) < n:
        size = max(n, 1 << 16)
        p = 0x100000001B3
        both = []
        for base in (p, pow(p, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        state["powers"] = tuple(both)
    return state["powers"]


def word_hashes(buffer: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in a buffer, and each text's bounds among the words."""
    low = word_table()[buffer]
    inside = np.zeros(len(low) + 1, bool)
    inside[1:] = low != 0
    edge = inside[1:] & ~inside[:-1]
    firsts = at[:-1][at[:-1] < at[1:]]
    edge[firsts] = low[firsts] != 0
    starts = np.flatnonzero(edge)
    stop = inside[1:] & np.append(~inside[2:], True)
    stop[firsts[firsts > 0] - 1] = low[firsts[firsts > 0] - 1] != 0
    ends = np.flatnonzero(stop) + 1
    p, inverse = powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(low * p[:len(low)], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), np.searchsorted(starts, at)


def winnow(words: np.ndarray, at: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (among all words) and hashes of the grams that windows of ``span`` words keep."""
    gram = min(gram, span)
    window = span - gram + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = np.zeros(len(words) + 1, np.int64)  # windows must end before their text does
    sizes = np.diff(at)
    whole = np.repeat(at[1:], sizes)[:n] - np.arange(n) >= span
    hashes = np.zeros(len(words) - gram + 1, np.uint64)
    for k in range(gram):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + words[k:k + len(hashes)]
    hashes = mix(hashes)
    kept = []
    step, low = 1 << (_PLACE - 1), np.uint64((1 << _PLACE) - 1)
    for a in range(0, n, step):
        part = hashes[a:a + step + window - 1]
        least = (part & ~low) | (low - np.arange(len(part), dtype=np.uint64))
        done = 1
        while done < window:
            jump = min(done, window - done)
            least = np.minimum(least[:-jump], least[jump:])
            done += jump
        least = least[whole[a:a + step][:len(least)].nonzero()[0]]
        kept.append(np.unique(low - (least & low)).astype(np.int64) + a)
    places = np.unique(np.concatenate(kept))
    return places, hashes[places]


def spans_of(items: DataFrame) -> list[int]:
    """The window lengths that the benchmark needs: SPAN and those of shorter items; SPAN values at most."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [min(SPAN, len(clean_words(t))) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(n, pa.int32())], ["n"])

    found = common.mapped(items.select(F.col("text").cast("string")), "n int", run).distinct().where("n > 0")
    return sorted(r.n for r in found.collect())


def item_grams(items: DataFrame) -> DataFrame:
    """(span, gram, item_id, place, n, words): kept grams of every item with the words that a window may reach."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for key, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words = clean_words(text)
            if not words:
                continue
            span = min(SPAN, len(words))
            raw = " ".join(w.decode() for w in words).encode()
            hashes, at = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            places, grams = winnow(hashes, at, GRAM, span)
            for p, g in zip(places.tolist(), grams.view(np.int64).tolist()):
                a, b = reach(p, span, len(words))
                rows.append({"span": span, "gram": g, "item_id": key, "item_at": p - a, "item_words": b" ".join(words[a:b])})
        return pa.RecordBatch.from_pylist(rows, schema=ITEM_GRAMS)

    return common.mapped(items.select(F.col("item_id"), F.col("text").cast("string").alias("text")),
                         "span int, gram long, item_id long, item_at int, item_words binary", run).distinct()


ITEM_GRAMS = pa.schema([("span", pa.int32()), ("gram", pa.int64()), ("item_id", pa.int64()), ("item_at", pa.int32()),
                        ("item_words", pa.binary())])


def reach(place: int, span: int, n: int) -> tuple[int, int]:
    """The words that windows over the gram at ``place`` can cover."""
    gram = min(GRAM, span)
    return max(0, place - span + gram), min(n, place + span)


def document_grams(docs: DataFrame, spans: list[int]) -> DataFrame:
    """(_k1, _k2, span, place, gram): kept grams, and a row of span 0 with the number of words as its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.sliced(batch, SLICE_BYTES):
                words, at = word_hashes(*common.text_buffer(part.column("text")))
                keys = [np.asarray(part.column(k)) for k in ("_k1", "_k2")]
                every = np.arange(len(at) - 1)
                rows = [(every, np.zeros(len(every), np.int32), np.diff(at), keys[0])]
                for span in spans:
                    places, grams = winnow(words, at, GRAM, span)
                    row = np.searchsorted(at, places, "right") - 1
                    rows.append((row, np.full(len(row), span, np.int32), places - at[row], grams.view(np.int64)))
                row, span, place, gram = map(np.concatenate, zip(*rows))
                yield pa.RecordBatch.from_pydict({
                    "_k1": pa.array(keys[0][row]), "_k2": pa.array(keys[1][row]), "span": pa.array(span),
                    "place": pa.array(place, pa.int64()), "gram": pa.array(gram)})

    return docs.select("_k1", "_k2", F.col("text").cast("string").alias("text")) \
        .mapInArrow(common.released(run), f"{_KEYS}, span int, place long, gram long")


def document_words(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(_k1, _k2, span, place, at, words): the words round each place of ``places`` (_k1, _k2, found)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for k1, k2, text, found in zip(*[batch.column(c).to_pylist() for c in ("_k1", "_k2", "text", "found")]):
            words = clean_words(text)
            for f in found:
                a, b = reach(f["place"], f["span"], len(words))
                rows.append({"_k1": k1, "_k2": k2, **f, "at": f["place"] - a, "words": b" ".join(words[a:b])})
        return pa.RecordBatch.from_pylist(rows, schema=DOCUMENT_WORDS)

    texts = docs.select("_k1", "_k2", F.col("text").cast("string").alias("text")).join(places, ["_k1", "_k2"])
    return common.mapped(texts, f"{_KEYS}, span int, place long, at int, words binary", run) \
        .dropDuplicates(["_k1", "_k2", "span", "place"])


DOCUMENT_WORDS = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("span", pa.int32()), ("place", pa.int64()),
                            ("at", pa.int32()), ("words", pa.binary())])


def extended(hits: DataFrame) -> DataFrame:
    """(_k1, _k2, item_id, first, last): hits that extend to a whole window, in words of the document, end exclusive."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for r in batch.to_pylist():
            mine, theirs = r["words"].split(b" "), r["item_words"].split(b" ")
            i, j = r["at"], r["item_at"]
            left = 0
            while left < min(i, j) and mine[i - left - 1] == theirs[j - left - 1]:
                left += 1
            right = 0
            while i + right < len(mine) and j + right < len(theirs) and mine[i + right] == theirs[j + right]:
                right += 1
            if right >= min(GRAM, r["span"]) and left + right >= r["span"]:
                rows.append({"_k1": r["_k1"], "_k2": r["_k2"], "item_id": r["item_id"],
                             "first": r["place"] - left, "last": r["place"] + right})
        return pa.RecordBatch.from_pylist(rows, schema=HITS)

    return common.mapped(hits, f"{_KEYS}, item_id long, first long, last long", run)


HITS = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("item_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` rows' key with n_words, n_hit, n_items, items (sorted ids), hits (spans of words) and contaminated.

    A document is contaminated where a twentieth of its words or more lie in
    windows shared with items (and one at least).  Null, empty and wordless
    texts have no words and are clean, as are all where the benchmark is empty;
    an empty table gives no rows; repeated rows share a verdict and all stay;
    items with the same text all count, those
    without an id mark words but are not listed; other columns are left out.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    keyed = common.with_row_key(docs.select(key, "text"), key, "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    grams = item_grams(items)
    rows = document_grams(keyed, spans_of(items))
    # one pass over the texts gives both the hits and the word counts; Spark broadcasts the items' grams if they are small
    found = common.stored(rows.join(grams, ["span", "gram"], "left").where("span = 0 or item_at is not null"), "hits")
    counts = found.where("span = 0").select("_k1", "_k2", F.col("place").alias("n_words")).distinct()
    hits = found.where("span > 0").select("_k1", "_k2", "span", "place", "item_id", "item_at", "item_words").distinct()
    places = hits.select("_k1", "_k2", "span", "place").distinct() \
        .groupBy("_k1", "_k2").agg(F.collect_list(F.struct("span", "place")).alias("found"))
    around = document_words(keyed, places)
    spans = common.stored(extended(hits.join(around, ["_k1", "_k2", "span", "place"])).distinct(), "windows")
    by_doc = spans.select("_k1", "_k2", "first", "last").distinct().groupBy("_k1", "_k2") \
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("hits"))
    by_item = spans.groupBy("_k1", "_k2").agg(F.collect_set("item_id").alias("items"))
    n_hit = F.expr("""aggregate(hits, named_struct('n', 0L, 'end', 0L), (s, h) -> named_struct(
        'n', s.n + greatest(0L, h.last - greatest(s.end, h.first)), 'end', greatest(s.end, h.last))).n""")
    hit = by_doc.join(by_item, ["_k1", "_k2"]).withColumn("n_hit", n_hit)
    none = F.array().cast("array<string>")
    return keyed.select(key, "_k1", "_k2").join(counts, ["_k1", "_k2"]).join(hit, ["_k1", "_k2"], "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_sort(F.col("items").cast("array<string>")), none).alias("items"), "hits",
        (F.coalesce("n_hit", F.lit(0)) * 20 >= F.col("n_words")).alias("_share"), "_k1", "_k2") \
        .withColumn("n_items", F.size("items").cast("long")) \
        .withColumn("contaminated", (F.col("n_hit") > 0) & F.col("_share")).drop("_share")


def decontaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without its contaminated rows."""
    bad = contamination(docs, items, key).where("contaminated").select("_k1", "_k2").distinct()
    return common.with_row_key(docs, key, "text").join(bad, ["_k1", "_k2"], "left_anti").select(*docs.columns)
