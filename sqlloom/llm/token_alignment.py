"""Cross-tokenizer alignment: which tokens of one vocabulary stand for which of another.

Every text is encoded twice without special tokens (their strings in a text are plain text): by
tokenizer A (byte-level BPE, of a space and the text) and by tokenizer B (sentencepiece, which adds
the space itself). A token's bytes are A's byte-level decoded entry, or B's piece in UTF-8 with
U+2581 as a space and ``<0xHH>`` as byte HH. Byte offsets where an A token and a B token both end cut
a text into groups; each such offset is a link between the A and the B token ending there (tokens
have at least one byte, so every group ends in exactly one link). An id pair's count is the number
of its links in the whole corpus. Per document: tokens, groups, links, the links whose count is the
highest of any pair with their B id (ties included), the sum of their counts, and the digest of its
groups ``a1,a2|b1;a3|b2,b3``.

Method: an identity map, A id to the B id of the same bytes, is built once from the vocabularies (a
vocabulary-length array). A group of one A and one B token related by that map is regular: tasks
count its links in a vocabulary-length vector by A id. Only the links of the other, irregular groups
go out as (A id, B id) pairs, counted per task before the shuffle. The corpus counts are the sum of
both; the highest count of each B id and the regular counts are vocabulary-length vectors, so they
are broadcast with a size bound. Each document's irregular links are joined to the pair counts (a
shuffle with hot pairs salted); its regular links are read off the vectors.

Tokenizer A encodes each distinct word of its pre-tokenizer's split once: byte-level BPE never merges
across words, so a text's ids are those of its words one after the other.

Defined cases: a null or empty text, or one whose joined A or B bytes differ from a space and the
text (sentencepiece normalises some texts), has no tokens: every count is 0 and the digest is ''.
Repeated rows are documents of their own, and count twice. Other columns pass through, and the
result's own columns replace columns of those names. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sqlloom.llm.common import ENCODED_BYTES, caches, pieces
from sqlloom.llm.tokens import id_type
from sqlloom.operators.joins import lookup
from sqlloom.options import JoinOptions
from sqlloom.sources.scratch import RunScratch

SPIECE_SPACE = "▁"

ROWS = T.StructType(
    [
        T.StructField("__row", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("regular", T.BinaryType()),
        T.StructField("irregular", T.ArrayType(T.LongType())),
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
        T.StructField("count", T.LongType()),
    ]
)
DOC, PAIRS = 0, 1


def _byte_decoder() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others are moved
    past 255 in byte order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, extra = {}, 0
    for byte in range(256):
        if byte in kept:
            chars[chr(byte)] = byte
        else:
            chars[chr(256 + extra)] = byte
            extra += 1
    return chars


@functools.lru_cache(maxsize=4)
def vocabularies(path_a: str, path_b: str):
    """(tokenizer A, processor B, A bytes by id, B bytes by id, identity map A id -> B id or -1)."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    decode = _byte_decoder()
    bytes_a = [b""] * a.get_vocab_size(with_added_tokens=True)
    for piece, i in a.get_vocab(with_added_tokens=True).items():
        bytes_a[i] = bytes(decode[c] for c in piece) if all(c in decode for c in piece) else piece.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_b = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            bytes_b.append(bytes([int(piece[3:5], 16)]))
        elif b.is_control(i) or b.is_unknown(i):
            bytes_b.append(b"")
        else:
            bytes_b.append(piece.replace(SPIECE_SPACE, " ").encode())
    by_bytes = {}
    for i, piece in enumerate(bytes_b):
        if piece and not b.is_byte(i):
            by_bytes.setdefault(piece, i)
    for i, piece in enumerate(bytes_b):
        if piece:
            by_bytes.setdefault(piece, i)
    same = np.array([by_bytes.get(piece, -1) if piece else -1 for piece in bytes_a], np.int64)
    return a, b, bytes_a, bytes_b, same


#: Characters whose classes are settled: Latin letters with what stands beside them, dashes and quotes.
COVERED = [*map(chr, range(0x250)), *map(chr, range(0x2010, 0x2028))]
UNCOVERED = re.compile("[^\\u0000-\\u024f\\u2010-\\u2027]")
WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def _word() -> re.Pattern:
    """The split of the byte-level pre-tokenizer, for covered characters."""

    def characters(kind: str) -> str:
        return "".join(f"\\u{ord(c):04x}" for c in COVERED if unicodedata.category(c)[0] == kind)

    letter, number = characters("L"), characters("N")
    white = "".join(f"\\u{ord(c):04x}" for c in WHITE)
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{white}{letter}{number}]+|[{white}]+(?![^{white}])|[{white}]+")


WORD = _word()
#: Words in a generation of the cache (see ``tokens.CACHED_WORDS``), and the characters of a word kept there.
CACHED_WORDS, CACHED_LENGTH = 100_000, 40


class ByteLevelWords:
    """Ids by a byte-level BPE tokenizer, each distinct word sent to the library once. Texts with other
    characters than the covered ones, and all texts of tokenizers of another kind, are sent whole."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.dtype = id_type(tokenizer.get_vocab_size(with_added_tokens=True))
        stated = json.loads(tokenizer.to_str())
        split, model = stated["pre_tokenizer"] or {}, stated["model"]
        self.by_word = (
            (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
            and (model["type"], model.get("dropout")) == ("BPE", None)
            and not (stated["normalizer"] or stated["truncation"] or stated["padding"])
            and tokenizer.encode_special_tokens
            and all(t["special"] for t in stated["added_tokens"])
        )
        caches.append(self)
        self.forget()

    def forget(self) -> None:
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) > CACHED_WORDS:
            self.old, self.cache = self.cache, {}
        cache, old = self.cache, self.old
        words = [WORD.findall(t) if self.by_word and not UNCOVERED.search(t) else None for t in texts]
        others = iter(self._whole([t for t, w in zip(texts, words) if w is None]))
        new = set().union(*filter(None, words)).difference(cache)
        cache.update((w, old[w]) for w in new.intersection(old))
        new = list(new.difference(old))
        cache.update(zip(new, self._whole(new)))
        ids = [next(others) if w is None else b"".join(map(cache.__getitem__, w)) for w in words]
        for word in new:
            if len(word) > CACHED_LENGTH:
                del cache[word]
        return [np.frombuffer(i, self.dtype) for i in ids]


@functools.lru_cache(maxsize=4)
def words_of(path_a: str, path_b: str) -> ByteLevelWords:
    return ByteLevelWords(vocabularies(path_a, path_b)[0])


class Pieces:
    """A vocabulary's token bytes as arrays: all bytes in one buffer, each id's start and size, and
    each id's decimal name with each separator behind it; a token sequence's bytes and names are
    gathered without a Python loop."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.names = {end: np.array([f"{i}{end}" for i in range(len(pieces))], dtype=object) for end in (",", "|", ";")}

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.start[ids] - before, sizes) + np.arange(int(sizes.sum()))]


@functools.lru_cache(maxsize=4)
def pieces_of(path_a: str, path_b: str) -> tuple[Pieces, Pieces]:
    _, _, bytes_a, bytes_b, _ = vocabularies(path_a, path_b)
    return Pieces(bytes_a), Pieces(bytes_b)


def encode_all(texts: list[str | None], a: ByteLevelWords, b) -> tuple[list, list]:
    """Ids of A and B of each text; None for no text."""
    present = [t for t in texts if t]
    ids_a = iter(a.encode([" " + t for t in present]))
    ids_b = iter(b.encode(present, num_threads=1) if present else [])
    pairs = [(next(ids_a), next(ids_b)) if t else (None, None) for t in texts]
    return [p[0] for p in pairs], [p[1] for p in pairs]


def align(text: str | None, ids_a, ids_b, pieces_a: Pieces, pieces_b: Pieces):
    """(ids A, ids B, group ends in A, group ends in B) of one text and its two encodings, or None
    without tokens."""
    if not text:
        return None
    want = np.frombuffer((" " + text).encode(), np.uint8)
    ids_a, ids_b = np.asarray(ids_a, np.int64), np.asarray(ids_b, np.int64)
    for ids, vocabulary in ((ids_a, pieces_a), (ids_b, pieces_b)):
        if int(vocabulary.size[ids].sum()) != len(want) or not np.array_equal(vocabulary.joined(ids), want):
            return None
    return group(ids_a, ids_b, pieces_a, pieces_b)


def group(ids_a: np.ndarray, ids_b: np.ndarray, pieces_a: Pieces, pieces_b: Pieces):
    ends_a, ends_b = np.cumsum(pieces_a.size[ids_a]), np.cumsum(pieces_b.size[ids_b])
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    last_a = np.searchsorted(ends_a, cuts)  # index of the A token ending at each cut
    last_b = np.searchsorted(ends_b, cuts)
    return ids_a, ids_b, last_a, last_b


def digest(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, pieces_a: Pieces, pieces_b: Pieces) -> str:
    """sha256 of ``a1,a2|b1;a3|b2,b3``: every id with the separator behind it, ordered by group, side
    (A before B) and place."""
    parts_a, parts_b = pieces_a.names[","][ids_a], pieces_b.names[","][ids_b]
    parts_a[last_a] = pieces_a.names["|"][ids_a[last_a]]
    parts_b[last_b] = pieces_b.names[";"][ids_b[last_b]]
    # Before an A token stand the B tokens of the groups before its own, before a B token the A tokens up to its own.
    before_a = np.repeat(np.concatenate([[0], last_b[:-1] + 1]), np.diff(last_a, prepend=-1))
    before_b = np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
    parts = np.empty(len(ids_a) + len(ids_b), dtype=object)
    parts[np.arange(len(ids_a)) + before_a] = parts_a
    parts[np.arange(len(ids_b)) + before_b] = parts_b
    return hashlib.sha256("".join(parts.tolist())[:-1].encode()).hexdigest()


def _encode(path_a: str, path_b: str):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, b, bytes_a, bytes_b, same = vocabularies(path_a, path_b)
        a = words_of(path_a, path_b)
        pieces_a, pieces_b = pieces_of(path_a, path_b)
        regular_counts = np.zeros(len(bytes_a), np.int64)
        pair_keys, pair_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in pieces(batch, "text", ENCODED_BYTES):
                rows, texts = part.column("__row").to_pylist(), part.column("text").to_pylist()
                out = {k: [] for k in ("__row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "regular", "irregular")}
                batch_keys = [pair_keys]
                all_a, all_b = encode_all(texts, a, b)
                for row, text, one_a, one_b in zip(rows, texts, all_a, all_b):
                    got = align(text, one_a, one_b, pieces_a, pieces_b)
                    if got is None:
                        values = (row, 0, 0, 0, 0, "", b"", [])
                    else:
                        ids_a, ids_b, last_a, last_b = got
                        la, lb = ids_a[last_a], ids_b[last_b]
                        first_a = np.concatenate([[0], last_a[:-1] + 1])
                        first_b = np.concatenate([[0], last_b[:-1] + 1])
                        one = (last_a == first_a) & (last_b == first_b) & (same[la] == lb)
                        np.add.at(regular_counts, la[one], 1)
                        keys = (la[~one] << 32) | lb[~one]
                        batch_keys.append(keys)
                        values = (row, len(ids_a), len(ids_b), len(last_a), len(last_a), digest(ids_a, ids_b, last_a, last_b, pieces_a, pieces_b), la[one].astype("<i4").tobytes(), keys.tolist())
                    for k, v in zip(out, values):
                        out[k].append(v)
                # The task's irregular pairs stay counted, never listed: memory grows with distinct pairs only.
                weights = np.concatenate([pair_counts, np.ones(sum(len(k) for k in batch_keys[1:]), np.int64)])
                pair_keys, inverse = np.unique(np.concatenate(batch_keys), return_inverse=True)
                pair_counts = np.bincount(inverse, weights=weights, minlength=len(pair_keys)).astype(np.int64)
                n = len(out["__row"])
                yield pa.RecordBatch.from_pydict(out | {"part": [DOC] * n, "a": [None] * n, "b": [None] * n, "count": [None] * n}, schema=_arrow())
        # This task's counts, before any shuffle: regular ones by A id, irregular ones by pair.
        at = np.flatnonzero(regular_counts)
        keys, counts = pair_keys, pair_counts
        a_ids = np.concatenate([at, keys >> 32])
        b_ids = np.concatenate([same[at], keys & 0xFFFFFFFF])
        n = len(a_ids)
        if n:
            none = [None] * n
            yield pa.RecordBatch.from_pydict(
                {"__row": none, "part": [PAIRS] * n, "n_a": none, "n_b": none, "n_groups": none, "n_links": none, "groups_sha256": none, "regular": none, "irregular": none, "a": a_ids.tolist(), "b": b_ids.tolist(), "count": np.concatenate([regular_counts[at], counts]).tolist()},
                schema=_arrow(),
            )

    return compute


def _arrow() -> pa.Schema:
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BinaryType: pa.binary()}
    return pa.schema([pa.field(f.name, pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else kinds[type(f.dataType)]) for f in ROWS.fields])


def _regular_figures(counts, best):
    @F.pandas_udf("n_best long, count_sum long")
    def figures(regular: pd.Series) -> pd.DataFrame:
        c, b = np.frombuffer(counts.value, np.int64), np.frombuffer(best.value, np.bool_)
        n_best, total = [], []
        for blob in regular:
            ids = np.frombuffer(blob or b"", "<i4")
            n_best.append(int(b[ids].sum()))
            total.append(int(c[ids].sum()))
        return pd.DataFrame({"n_best": n_best, "count_sum": total})

    return figures


def alignment(docs: DataFrame, path_a: str, path_b: str, text: str = "text", options: JoinOptions = JoinOptions()) -> DataFrame:
    """Every row of ``docs`` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark = docs.sparkSession
    scratch = RunScratch(spark, "alignment")
    rows = scratch.write(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    encoded = scratch.write(rows.select("__row", F.col(text).alias("text")).mapInArrow(_encode(path_a, path_b), ROWS), "encoded")
    pairs = encoded.where(F.col("part") == PAIRS).groupBy("a", "b").agg(F.sum("count").alias("count"))
    pairs = scratch.write(pairs, "pairs")
    _, _, bytes_a, bytes_b, same = vocabularies(path_a, path_b)
    # Vocabulary-length vectors: the highest count of each B id, and the count of each regular pair.
    highest = np.zeros(len(bytes_b), np.int64)
    for row in pairs.groupBy("b").agg(F.max("count").alias("m")).toLocalIterator():
        highest[row["b"]] = row["m"]
    identity = spark.createDataFrame(pd.DataFrame({"a": np.flatnonzero(same >= 0).astype(np.int64), "b": same[same >= 0]}))
    regular = np.zeros(len(bytes_a), np.int64)
    for row in pairs.join(F.broadcast(identity), ["a", "b"]).toLocalIterator():
        regular[row["a"]] = row["count"]
    is_best = np.zeros(len(bytes_a), np.bool_)
    known = same >= 0
    is_best[known] = regular[known] == highest[same[known]]
    counts_shared, best_shared = spark.sparkContext.broadcast(regular.tobytes()), spark.sparkContext.broadcast(is_best.tobytes())
    high = spark.createDataFrame(pd.DataFrame({"b": np.arange(len(highest), dtype=np.int64), "m": highest}))
    scored = pairs.join(F.broadcast(high), "b").select(((F.col("a") * F.lit(1 << 32)) + F.col("b")).alias("key"), "count", (F.col("count") == F.col("m")).cast("long").alias("best"))
    docs_part = encoded.where(F.col("part") == DOC)
    links = docs_part.select("__row", F.explode("irregular").alias("key"))
    judged = lookup(links, scored, "key", spread_by="__row", options=options)
    irregular = judged.groupBy("__row").agg(F.sum("best").alias("__ib"), F.sum("count").alias("__ic"))
    figures = docs_part.withColumn("__f", _regular_figures(counts_shared, best_shared)(F.col("regular"))).join(irregular, "__row", "left")
    figures = figures.select(
        "__row",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("__f.n_best") + F.coalesce("__ib", F.lit(0))).alias("n_best"),
        (F.col("__f.count_sum") + F.coalesce("__ic", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
    figures = scratch.write(figures, "figures")
    own = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return rows.drop(*own).join(figures, "__row").drop("__row")
