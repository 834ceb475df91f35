"""Token-id shards with a minimal perfect hash index: constant-time access by document key.

Documents are dealt by ranges of (key, hash of the text) and sorted, so the ids of all shards, one
shard after the other, are those of the documents in ascending key order. One task writes one shard
file in the shared folder: raw little-endian ids, then the index, then a footer. A retried or
doubled task writes a file of another name; the manifest, a Parquet table that Spark commits, names
the files that count. So a lost executor costs a repeated task and never a mixed file.

Index of a shard: levels of bit arrays (a key sits at its first level without a collision), the rank
of its bit is its slot among 0..n-1, and each slot holds the fingerprint of its key, its first
record and its number of records. The fingerprint is a bijection of the 64-bit key, so a key that
isn't stored is always told apart.

Defined cases: a null text counts as empty; rows with equal keys are records one after the other,
in the order of their texts, under one key; rows without a key come first and are read in sequence
only; an empty table gives no shard and no rows; other columns are left alone.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sqlloom.llm.common import ENCODED_BYTES, arrow_batch, mix, open_folder, pieces
from sqlloom.llm.tokens import encoder, id_type
from sqlloom.sources.scratch import RunScratch

MAGIC = b"SLIDS001"
LEVEL_SEED = 0x9E3779B97F4A7C15
MANIFEST = "shard int, file string, n_docs long, n_ids long, min_key long, max_key long, no_key long"
RECORD = pa.schema(
    [("shard", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, built and asked in whole arrays."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        words = np.bitwise_count(bits).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(words)])

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64(LEVEL_SEED * (level + 1) % 2**64)
        return (mix(keys + seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        parts, sizes, level = [], [], 0
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = cls.places(keys, level, size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            keys, level = keys[~alone[at]], level + 1
        return cls(np.concatenate(parts) if parts else np.zeros(0, "<u8"), np.array(sizes, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that no level holds. Other unknown keys get any slot."""
        out = np.full(len(keys), -1, np.int64)
        rest, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = self.places(keys[rest], level, size) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[rest[hit]] = (self.ranks[word] + below)[hit]
            rest, base = rest[~hit], base + size
        return out


class Shard:
    """One shard file, open for access by key."""

    def __init__(self, folder: str, name: str):
        system, path = open_folder(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        length, magic = struct.unpack("<Q8s", self.file.read_at(16, size - 16))
        if magic != MAGIC:
            raise ValueError(f"{name} is no id shard")
        self.header = json.loads(self.file.read_at(length, size - 16 - length))
        self.dtype = np.dtype(self.header["dtype"])
        self.offsets = self._array("offsets")
        self.hash = PerfectHash(self._array("bits"), self._array("sizes"))
        self.prints = self._array("prints")
        self.first, self.count = self._array("first"), self._array("count")

    def _array(self, name: str) -> np.ndarray:
        at, dtype, n = self.header["arrays"][name]
        dtype = np.dtype(dtype)
        return np.frombuffer(self.file.read_at(n * dtype.itemsize, at), dtype)

    def keys(self) -> np.ndarray:
        return self._array("keys")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; a key that isn't there has 0 records."""
        slots = self.hash.slots(keys.view(np.uint64))
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        there = (slots >= 0) & (self.prints[slots] == mix(keys.view(np.uint64)))
        return np.where(there, self.first[slots], 0), np.where(there, self.count[slots], 0)

    def payload(self, first: int, last: int) -> np.ndarray:
        """Ids of the records first..last-1, one after the other, as unsigned 32-bit."""
        a, b = int(self.offsets[first]), int(self.offsets[last])
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((b - a) * width, a * width), self.dtype).astype("<u4")

    def close(self) -> None:
        self.file.close()


def _write_shard(folder: str, tokenizer: str, end_id: int, batches: Iterator[pa.RecordBatch]):
    """Write the sorted rows of this task as one shard; its manifest row."""
    encode = encoder(tokenizer)
    dtype = id_type(max(encode.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1))
    end = np.array([end_id], dtype).tobytes()
    shard = TaskContext.get().partitionId()
    out, lengths, keys, no_key = None, [], [], 0
    for batch in batches:
        for part in pieces(batch, "text", ENCODED_BYTES):
            if out is None:
                system, path = open_folder(folder)
                system.create_dir(path, recursive=True)
                name = f"ids-{shard:06d}-{uuid.uuid4().hex}.bin"
                out = system.open_output_stream(f"{path}/{name}")
            raw = [x + end for x in encode.encode(part.column("text").to_pylist())]
            if dtype != encode.dtype:
                raw = [np.frombuffer(x[: -dtype.itemsize], encode.dtype).astype(dtype).tobytes() + end for x in raw]
            out.write(b"".join(raw))
            lengths += [len(x) // dtype.itemsize for x in raw]
            ids = part.column("doc_id")
            no_key += ids.null_count
            keys.append(np.asarray(ids.drop_null(), np.int64))
    if out is None:
        return
    keys = np.concatenate(keys)
    stored, first, count = np.unique(keys, return_index=True, return_counts=True)
    index = PerfectHash.build(stored.view(np.uint64))
    slots = index.slots(stored.view(np.uint64))
    prints = np.zeros(len(stored), "<u8")
    firsts, counts = np.zeros(len(stored), "<i8"), np.zeros(len(stored), "<i8")
    prints[slots] = mix(stored.view(np.uint64))
    firsts[slots], counts[slots] = first + no_key, count
    offsets = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype("<i8")
    at, places = int(offsets[-1]) * dtype.itemsize, {}
    arrays = {"offsets": offsets, "keys": keys.astype("<i8"), "bits": index.bits.astype("<u8"), "sizes": index.sizes.astype("<i8"), "prints": prints, "first": firsts, "count": counts}
    for label, values in arrays.items():
        places[label] = [at, values.dtype.str, len(values)]
        out.write(values.tobytes())
        at += values.nbytes
    header = json.dumps({"dtype": dtype.str, "no_key": no_key, "arrays": places}).encode()
    out.write(header + struct.pack("<Q8s", len(header), MAGIC))
    out.close()
    low, high = (int(stored[0]), int(stored[-1])) if len(stored) else (None, None)
    yield shard, name, len(lengths), int(offsets[-1]), low, high, no_key


def write_index(docs: DataFrame, tokenizer: str, end_id: int, scratch: RunScratch, shards: int | None = None) -> DataFrame:
    """Encode, append ``end_id`` to each document and write the shards; the manifest.

    ``shards`` defaults to the session's shuffle partitions: set them so that a shard fits a task.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch.table("shards")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _write_shard(folder, tokenizer, end_id, batches):
            yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST_ARROW.names, row))], schema=MANIFEST_ARROW)

    return scratch.write(rows.mapInArrow(write, MANIFEST), "manifest")


MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("min_key", pa.int64()), ("max_key", pa.int64()), ("no_key", pa.int64())]
)


def _one_shard_a_task(manifest: DataFrame) -> DataFrame:
    """Shards spread over the tasks of the session, some to each."""
    spark = manifest.sparkSession
    return manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """All records, read from the files: keys go through the index, rows without key in sequence."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(folder, row["file"])
                no_key, stored = row["no_key"], np.unique(shard.keys())
                first, count = shard.find(stored)
                records = np.repeat(first, count) + _steps(count)
                keys = pa.array([None] * no_key, pa.int64()), pa.array(np.repeat(stored, count), pa.int64())
                records = np.concatenate([np.arange(no_key), records])
                keys = pa.concat_arrays(keys)
                for at in range(0, len(records), 2_000):
                    some = records[at : at + 2_000]
                    crc = [zlib.crc32(shard.payload(r, r + 1).tobytes()) for r in some.tolist()]
                    start, end = shard.offsets[some], shard.offsets[some + 1]
                    yield arrow_batch(RECORD, shard=np.full(len(some), row["shard"], np.int32), doc_id=keys.slice(at, len(some)), local_start=start, n_tokens=end - start, ids_crc32=crc)
                shard.close()

    return _one_shard_a_task(manifest).mapInArrow(read, "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long")


def _steps(count: np.ndarray) -> np.ndarray:
    """0..count-1 for each count, one after the other."""
    total = np.cumsum(count)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - count, count)


def lookup(manifest: DataFrame, folder: str, keys: DataFrame, key: str) -> DataFrame:
    """Ids of the documents with the given keys: (key, ids), one row a stored record.

    A key's shards follow from the shards' key ranges (one row a file, so a table of the size of a
    file listing); each task opens a shard once for all its keys.
    """
    spark = keys.sparkSession
    listing = manifest.where("min_key IS NOT NULL").orderBy("shard").select("file", "min_key", "max_key").toPandas()
    files, low, high = listing["file"].to_numpy(), listing["min_key"].to_numpy(np.int64), listing["max_key"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((files, low, high))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, low, high = shared.value
        for batch in batches:
            key = np.asarray(batch.column("key"), np.int64)
            first, last = np.searchsorted(high, key, "left"), np.searchsorted(low, key, "right")
            n = np.maximum(last - first, 0)
            at = np.repeat(first, n) + _steps(n)
            yield arrow_batch(DEALT, file=files[at].tolist(), key=np.repeat(key, n))

    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    dealt = wanted.mapInArrow(deal, "file string, key long").repartition("file").sortWithinPartitions("file", "key")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = None, None
        for batch in batches:
            files = np.array(batch.column("file").to_pylist(), object)
            stored = np.asarray(batch.column("key"), np.int64)
            for at in np.unique(files):
                if at != name:
                    shard, name = Shard(folder, at), at
                mine = np.ascontiguousarray(stored[files == at])
                for k, first, n in zip(mine.tolist(), *(x.tolist() for x in shard.find(mine))):
                    for r in range(first, first + n):
                        yield arrow_batch(FOUND, key=[k], ids=[shard.payload(r, r + 1).tolist()])

    return dealt.mapInArrow(find, "key long, ids array<long>")


DEALT = pa.schema([("file", pa.string()), ("key", pa.int64())])
FOUND = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int64()))])


def id_records(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as shards, read them back: doc_id, start, n_tokens, ids_crc32."""
    scratch = RunScratch(docs.sparkSession, "ids")
    manifest = write_index(docs, tokenizer, end_id, scratch)
    # One row a shard; the sums over them are a window over as many rows as there are files.
    before = F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")
    starts = manifest.select("shard", before.alias("base"))
    records = read_records(manifest, scratch.table("shards"))
    # The broadcast side has one row a file.
    return records.join(F.broadcast(starts), "shard").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
