"""Helpers of this subpackage: tables, folds, paths inside tasks, and word hashes of whole batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

HELD_OUT_FOLD = 2
FOLDS = 4

#: Odd multiplier of the rolling hash; odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str) -> Column:
    """crc32 of the key as text, modulo the folds; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % FOLDS


def is_held_out(key: str) -> Column:
    """A row without a key is not held out (and learners leave it alone all the same)."""
    return F.coalesce(fold(key) == HELD_OUT_FOLD, F.lit(False))


def may_learn(key: str) -> Column:
    return F.coalesce(fold(key) != HELD_OUT_FOLD, F.lit(False))


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, from inside a task."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with well spread bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((BASE, pow(BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


#: Objects of this worker with a cache (and ``forget``) that only some operators use. Workers are shared
#: by all, so the others give that memory back.
caches: list = []


class Words:
    """Words of a batch of texts as arrays: ``start``/``end`` byte positions, ``doc`` index, ``hash``.

    ``separator`` is a table of 256 flags by byte value; A-Z are lower-cased, so hashes are those of
    the lower-cased words. Null texts have no words. Only complete texts are taken, never a prefix.
    """

    def __init__(self, texts: pa.Array, separator: np.ndarray):
        for cache in caches:
            cache.forget()
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low = int(offsets[0]) if len(offsets) else 0
        size = int(offsets[-1]) - low if len(offsets) else 0
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[low : low + size] if size else np.zeros(0, np.uint8)
        self.bytes = LOWER[raw]
        self.bounds = offsets - low
        inside = ~separator[self.bytes]
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        first = np.zeros(size + 1, bool)
        first[self.bounds[:-1]] = True  # a text's first byte never continues a word of the text before
        first = first[:size]
        self.start = np.flatnonzero(inside & (~before | first))
        after = np.zeros(size, bool)
        after[:-1] = inside[1:] & ~first[1:]
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(self.bounds, self.start, "right") - 1
        self._sums: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the byte spans, equal for equal bytes of equal length."""
        forth, back = powers(len(self.bytes) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * forth[: len(self.bytes)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * back[start] + (end - start).astype(np.uint64))

    @property
    def hash(self) -> np.ndarray:
        return self.spans(self.start, self.end)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separators(ranges: list[tuple[int, int]]) -> np.ndarray:
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


#: White space of the shingle words.
BLANKS = separators([(0x20, 0x20), (0x09, 0x0D)])
#: ASCII characters that are neither digits nor letters.
SYMBOLS = separators([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def arrow_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type) for k, v in columns.items()],
        schema=schema,
    )


#: Bytes of texts worked on at a time: word hashes take some 60 times as much, and are faster while they
#: stay in the processor's cache.
PIECE_BYTES = 1 << 19
#: Bytes of texts given to a tokenizer at a time, each of their words once.
ENCODED_BYTES = 3 << 20


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES):
    """The batch in runs of rows whose texts hold about ``limit`` bytes, so working memory is bounded
    by that and the longest single text. Memory the last batch has left goes back to the system."""
    pa.default_memory_pool().release_unused()
    sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)
