"""Packing along a space-filling curve: similar documents share sequences, and no token is padding
but in the last sequence.

Each document's hashed bag of ids is projected to a few dimensions; the place of that point on a
Hilbert curve is its key. Documents are range-sorted by (key, row), laid end to end, and the stream
is cut every ``capacity`` ids. Only keys and lengths are sorted; the ids move once, on the row
number, to learn where in the stream they lie.

Equal documents have equal keys; the row number behind the key spreads them over the ranges, so a
group of copies of any size is no single task.

Defined cases: a null or empty text is a document of just the end id; repeated rows are documents of
their own; documents of any length are cut at sequence borders; an empty table gives no rows; other
columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sqlloom.llm.common import arrow_batch, mix, pieces
from sqlloom.llm.ordering import sums_in_front
from sqlloom.llm.tokens import encoder
from sqlloom.sources.scratch import RunScratch

CAPACITY = 4096
DIMENSIONS = 4
BITS = 8  # per dimension
ENCODED = pa.schema([("doc_id", pa.int64()), ("curve_key", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
PIECE = pa.schema([*((c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "curve_key")), ("ids", pa.binary())])
#: What the registered queries return: the ids by their digest.
DIGEST = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "curve_key"]
TEXT_BYTES = 1 << 20  # of texts encoded at a time
PIECE_BYTES = 4 << 20  # of ids in a batch of pieces


def projection(vocabulary: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Signs of a random projection by hash: one row an id, one column a dimension."""
    bits = mix(np.arange(vocabulary, dtype=np.uint64) + np.uint64(1))
    return ((bits[:, None] >> np.arange(dimensions, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, d) with ``bits`` bits a coordinate.

    Gray-code form: from the highest bit down, undo each cell's rotation, then decode the Gray code.
    """
    x = points.astype(np.uint64).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        q = np.uint64(1 << b)
        below = q - np.uint64(1)
        for i in range(d):
            turned = (x[i] & q) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(turned, below, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def curve_keys(ids: np.ndarray, lengths: np.ndarray, signs: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve keys of documents whose ids lie end to end. Sums of signs over sqrt(length) spread like
    a normal distribution, whatever the length; they are cut to +-4 and put on the grid."""
    n, dimensions = len(lengths), signs.shape[1]
    # How often each pattern of signs occurs in each document.
    number = ((signs > 0) @ (1 << np.arange(dimensions))).astype(np.uint8 if dimensions <= 8 else np.int64)
    at = np.repeat(np.arange(n) << dimensions, lengths)
    at += number[ids]
    counts = np.bincount(at, minlength=n << dimensions).reshape(n, 1 << dimensions)
    patterns = (np.arange(1 << dimensions)[:, None] >> np.arange(dimensions) & 1) * 2 - 1
    spread = (counts @ patterns) / np.sqrt(np.maximum(lengths, 1))[:, None]
    grid = np.clip((spread + 4) / 8 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    return hilbert(grid, bits)


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, curve_key, n and raw ids with the end id, of every row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        signs = projection(coder.tokenizer.get_vocab_size(with_added_tokens=True))
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                raw = coder.records(part.column("text").to_pylist(), end)
                _, offsets, ids = raw.buffers()
                lengths = np.diff(np.frombuffer(offsets, np.int64)) // coder.dtype.itemsize
                keys = curve_keys(np.frombuffer(ids, coder.dtype), lengths, signs)
                yield arrow_batch(ENCODED, doc_id=part.column("doc_id"), curve_key=keys, n=lengths, ids=raw.cast(pa.binary()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id long, curve_key long, n long, ids binary")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: which ids of which document lie where in which sequence. ``ids`` are those of the
    piece, in 4 bytes each, the least first; ``ids_crc32`` is their digest. A sequence is its pieces'
    ids in the order of ``offset``."""
    scratch = RunScratch(docs.sparkSession, "packing")
    # The row number is fixed once it is written.
    rows = scratch.write(encoded(docs, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id()), "encoded")
    starts = sums_in_front(rows.select("curve_key", "row", "n"), ["curve_key", "row"], scratch, "placed")
    found = rows.join(starts.hint("shuffle_hash"), "row").select("doc_id", "curve_key", "at", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer).dtype
        for part in (part for batch in batches for part in pieces(batch, "ids")):
            out, size = {name: [] for name in PIECE.names}, 0
            for doc, key, at, raw in zip(*(part.column(c).to_pylist() for c in ("doc_id", "curve_key", "at", "ids"))):
                ids = np.frombuffer(raw, dtype).astype("<u4")
                edges = [0, *range(capacity - at % capacity, len(ids), capacity), len(ids)]
                for a, b in zip(edges, edges[1:]):
                    values = (doc, a, b - a, len(ids), (at + a) // capacity, (at + a) % capacity, key, ids[a:b].tobytes())
                    for name, value in zip(PIECE.names, values):
                        out[name].append(value)
                    size += 4 * (b - a)
                    if size >= PIECE_BYTES:
                        yield arrow_batch(PIECE, **out)
                        out, size = {name: [] for name in PIECE.names}, 0
            yield arrow_batch(PIECE, **out)

    pieces_of = found.mapInArrow(cut, ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in PIECE.names))
    return pieces_of.withColumn("ids_crc32", F.crc32("ids")).select(*DIGEST, "ids")
