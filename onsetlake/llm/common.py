"""Shared helpers: scratch tables, unique row keys, text batches and tokenizing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_FILE = "byte_bpe_50k.json"

# The code points that tokenizers' \s matches.
UNICODE_SPACE = "\t-\r \x85\xa0  -     　"

CACHED_WORDS = 150_000
LONGEST_CACHED = 64


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Only a local master may run without that setting (tests); it then gets a
    folder of its own, once per session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="onsetlake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch as Parquet and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small, so that a batch of very long texts fits into a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def partitions_for(spark: SparkSession, n_bytes: int | None, per_partition: int = 32 << 20) -> int:
    """Partitions of about ``per_partition`` bytes, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_bytes or 0) // per_partition))


def mapped(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """``mapInArrow`` for a function of one batch; it may return None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(released(run), schema)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which the worker gives the memory that it no longer needs back to the machine.

    Workers are used again by later stages, and would else keep each one's peak.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not every C library can
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def with_row_key(docs: DataFrame, *values: str) -> DataFrame:
    """Adds ``_k1``, ``_k2``: equal exactly for rows that agree in ``values`` (128 hash bits).

    Rows equal in all of ``values`` share one verdict in every operator, so
    they may share the key too.  Nulls are marked where other values have their
    length, so no value is like them.
    """
    cols = [F.col(v).cast("string") for v in values]
    named = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("null")) for c in cols]
    digest = F.md5(F.concat_ws("\x1f", *named))
    return docs.withColumn("_k1", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")) \
        .withColumn("_k2", F.conv(F.substring(digest, 16, 15), 16, 10).cast("long"))


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, whichever task runs in it."""
    return sys.__dict__.setdefault("_onsetlake_llm", {})


def byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


class WordTokenizer:
    """Token ids of whole texts, with the ids of words seen before taken from a cache.

    A byte-level BPE never merges across a space or line end that a word follows,
    nor between a letter or digit and the full stop or comma after it, so a text's ids
    are its words' ids in order.  Texts are split at spaces and before line ends.
    Arrow numbers the different words of a batch and finds them in the cache; only
    words that it lacks are encoded, many in one text, and the ids are gathered by
    number, so nothing here is done once a word in Python.  Texts with runs of white space take the
    general pattern instead, and texts that hold an added token's content are
    encoded whole.  The cache is bounded by ``CACHED_WORDS`` and a batch's own words.
    """

    #: Between words that are encoded together: what stands before each, and its one id.
    separator = "\n"
    #: A last full stop or comma that is a part of its own, whatever stands before the class.
    tail = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}][.,]$"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(sorted(added, key=len, reverse=True)) or r"(?!)").search
        s = UNICODE_SPACE
        self.rare = re.compile(f"[{s}]".replace(" ", "").replace("\t-\r", "\t\x0b-\r")).search
        self.parts = re.compile(f" ?[^{s}]+|[{s}]+(?![^{s}])|[{s}]+").findall
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.mark = self.ids(self.separator)[0]
        self.tails = {x: self.ids(x)[0] for x in ".,"}
        self.words = large([""])  # the cache: words, how often asked for, and where their ids are
        self.uses, self.first, self.sizes = np.array([[1 << 60], [0], [0]])
        self.known = np.zeros(0, "<u4")

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        ids, sizes = self.encode_flat(texts)
        ends, whole = (4 * np.cumsum(sizes)).tolist(), ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *ends], ends)]

    def encode_flat(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, each text followed by ``end_id`` if there is one, and how many each text has."""
        apart = {i: self.ids(t) for i, t in enumerate(texts) if self.added(t)}
        runs = [i for i, t in enumerate(texts) if i not in apart and self.irregular(t)]
        apart |= zip(runs, self.general([texts[i] for i in runs]))
        ids, sizes = self.gathered([t for i, t in enumerate(texts) if i not in apart])
        if apart:
            others = iter(np.split(ids, np.cumsum(sizes)))
            each = [apart[i] if i in apart else next(others) for i in range(len(texts))]
            ids, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
        if end_id is not None:
            ids, sizes = np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
        return ids, sizes

    def irregular(self, t: str) -> bool:
        """Whether words in their places do not give a text's ids."""
        return bool(not t or t[0] in " \n" or t[-1] in " \n" or "  " in t or "\n " in t or " \n" in t or "\n\n\n" in t or self.rare(t))

    def general(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts by the parts of the general pattern."""
        pieces = [self.parts(t) for t in texts]
        flat = [p for ps in pieces for p in ps]
        if not flat:
            return [np.zeros(0, "<u4") for _ in texts]
        blank = np.array([p.isspace() for p in flat])
        spaced = np.array([p[0] == " " for p in flat])
        spaces = {p: self.ids(p) for p in {p for p, b in zip(flat, blank) if b}}
        # a part with a space before it is a word in its place, and so is another one after a line end
        numbered = large(["" if b else p[1:] if s else "\n" + p for p, b, s in zip(flat, blank, spaced)]).dictionary_encode()
        ids, sizes = self.of_words(numbered.dictionary)
        at = np.asarray(numbered.indices)
        size, first = sizes[at], (np.cumsum(sizes) - sizes)[at]
        ended = ~blank & ~spaced
        size[ended] -= 1
        first[ended] += 1
        begin = dict(zip(spaces, len(ids) + np.cumsum([0, *map(len, spaces.values())])[:-1]))
        first[blank] = [begin[p] for p, b in zip(flat, blank) if b]
        size[blank] = [len(spaces[p]) for p, b in zip(flat, blank) if b]
        whole = gather(np.concatenate([ids, *spaces.values()]), first, size)
        ends = np.append(0, np.cumsum(size))[np.cumsum([len(ps) for ps in pieces])]
        return np.split(whole, ends[:-1])

    def in_places(self, texts: list[str]) -> pa.Array:
        """The words of each text; one that begins with a line end, as the first does here, has no space before it."""
        return pa.compute.split_pattern(pa.compute.replace_substring(large(["\n" + t for t in texts]),
                                                                     "\n", " \n"), " ")

    #: Whether ``in_places`` adds an empty word and an id before each text.
    ahead = True

    def gathered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts by the numbers of their words."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        split = self.in_places(texts)
        numbered = split.flatten().dictionary_encode()
        flat, sizes = self.of_words(numbered.dictionary)
        at = np.asarray(numbered.indices)
        size, first = sizes[at], (np.cumsum(sizes) - sizes)[at]
        bounds = np.asarray(split.offsets)
        if self.ahead:
            heads = bounds[:-1] - bounds[0]
            size[heads] = 0
            size[heads + 1] -= 1
            first[heads + 1] += 1
        ends = np.cumsum(size)
        return gather(flat, first, size), np.diff(ends[bounds[1:] - bounds[0] - 1], prepend=0)

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of different words, one after the other, and how many each has."""
        pc = pa.compute
        tailed = np.asarray(pc.match_substring_regex(words, self.tail))
        cores = words
        if tailed.any():
            cut = pc.utf8_slice_codeunits(words.filter(pa.array(tailed)), 0, -1)
            cores = pc.replace_with_mask(words, pa.array(tailed), cut)
        numbered = cores.dictionary_encode()
        at = self.places(numbered.dictionary)[np.asarray(numbered.indices)]
        sizes = self.sizes[at] + tailed
        flat = np.zeros(int(sizes.sum()), "<u4")
        ends = np.cumsum(sizes)
        inner = np.ones(len(flat), bool)
        inner[ends[tailed] - 1] = False
        flat[inner] = gather(self.known, self.first[at], self.sizes[at])
        if tailed.any():
            dots = np.asarray(pc.ends_with(words.filter(pa.array(tailed)), "."))
            flat[ends[tailed] - 1] = np.where(dots, self.tails["."], self.tails[","])
        return flat, sizes

    def places(self, words: pa.Array) -> np.ndarray:
        """Where the cache holds ``words``, which it learns first where it lacks them."""
        pc = pa.compute
        if len(self.words) > 2 * CACHED_WORDS:
            self.forget()
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        if len(new):
            ids, sizes = self.learnt(new)
            self.words = pa.concat_arrays([self.words, new])
            self.first = np.concatenate([self.first, len(self.known) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            self.known = np.concatenate([self.known, ids])
            fresh = np.arange(len(self.words) - len(new), len(self.words))
            filled = np.zeros(len(words), np.int64)
            missing = np.asarray(pc.is_null(at))
            filled[missing] = fresh
            filled[~missing] = np.asarray(at.drop_null())
            at = filled
        else:
            at = np.asarray(at).astype(np.int64)
        self.uses[at] += 1
        return at

    def forget(self) -> None:
        """Keeps the words that several batches asked for, half of the bound at most, and none that is long."""
        worth = np.where(np.asarray(pa.compute.binary_length(self.words)) > LONGEST_CACHED, 0, self.uses)
        kept = np.sort(np.argsort(-worth, kind="stable")[:CACHED_WORDS])
        kept = kept[worth[kept] > 1]
        self.words = self.words.take(pa.array(kept))
        self.known = gather(self.known, self.first[kept], self.sizes[kept])
        self.sizes = self.sizes[kept]
        self.first = np.cumsum(self.sizes) - self.sizes
        self.uses = self.uses[kept] // 2

    def written(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, Callable[[str], str]]:
        """Words as they are encoded together, how many of the marks before each are its own, and one word's own text."""
        pc = pa.compute
        begins = pc.starts_with(words, "\n")
        texts = pc.if_else(begins, words, pc.binary_join_element_wise(large("\n "), words, large("")))
        return texts, np.asarray(begins).astype(np.int64), lambda t: t if t[1:2] != " " else t[1:]

    def learnt(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the cache lacks."""
        texts, own, alone = self.written(words)
        bounds = np.append(np.arange(0, len(words), 200), len(words))
        joined = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), texts), large("")).to_pylist()
        flat, sizes = [], []
        for k, e in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            a, b = bounds[k], bounds[k + 1]
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == b - a:
                keep = np.ones(len(ids), bool)
                keep[cuts[own[a:b] == 0]] = False
                flat.append(ids[keep])
                sizes.append(np.diff(cuts, append=len(ids)) - 1 + own[a:b])
            else:  # a word holds the mark, or a word's part makes it
                each = [self.ids(alone(t)) for t in texts[a:b].to_pylist()]
                flat += each
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        return np.concatenate(flat), np.concatenate(sizes)


class LowerTokenizer(WordTokenizer):
    """The same for vocabularies that drop white space and mark the ends of words.

    Every word between white space has its own ids, whatever stands beside it.
    """

    separator = "\x01"
    ahead = False

    def irregular(self, t: str) -> bool:
        return bool(self.rare(t))

    def general(self, texts: list[str]) -> list[np.ndarray]:
        return list(map(self.ids, texts))

    def in_places(self, texts: list[str]) -> pa.Array:
        return pa.compute.split_pattern(pa.compute.replace_substring(large(texts), "\n", " "), " ")

    def written(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, Callable[[str], str]]:
        return (pa.compute.binary_join_element_wise(large(self.separator + " "), words, large(" "), large("")), np.zeros(len(words), np.int64),
                lambda t: t[2:])


def large(values: list[str] | str) -> pa.Array | pa.Scalar:
    return pa.scalar(values, pa.large_string()) if isinstance(values, str) else pa.array(values, pa.large_string())


def gather(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``first``, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)]


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file; its word cache outlives a task."""
    state = worker_state()
    if ("tokenizer", path) not in state:
        from tokenizers import Tokenizer

        marked = getattr(Tokenizer.from_file(path).model, "end_of_word_suffix", None)
        state["tokenizer", path] = (LowerTokenizer if marked else WordTokenizer)(path)
        gc.freeze()  # what is loaded by now stays, and need not be walked again
    return state["tokenizer", path]


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column in one array, and each text's bounds (n + 1 offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def sliced(batch: pa.RecordBatch, n_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``n_bytes`` of text each, one row at least."""
    sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()])
    a, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > a and total + size > n_bytes:
            yield batch.slice(a, i - a)
            a, total = i, 0
        total += size
    if a < batch.num_rows:
        yield batch.slice(a)
